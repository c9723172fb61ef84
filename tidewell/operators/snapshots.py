"""Compare a table with its previous snapshot by content hash; keep versions of a table."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.operators.layout import folder_names, is_complete, remove_folder


def content_hashes(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
    return df.select(key, F.sha2(F.concat_ws("\x1f", *parts), 256).alias("content_hash"))


def changed_rows(current: DataFrame, previous_hashes: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Rows that are new or whose content differs from the snapshot: the ones to index again."""
    hashed = current.withColumn("content_hash", F.sha2(F.concat_ws("\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]), 256))
    return hashed.join(previous_hashes.select(key, "content_hash"), [key, "content_hash"], "left_anti")


def removed_keys(current: DataFrame, previous_hashes: DataFrame, key: str) -> DataFrame:
    return previous_hashes.select(key).join(current.select(key), key, "left_anti")


def row_hash(columns: Sequence[str]) -> Column:
    """A digest of the values; NULL differs from an empty text, and no two rows run together."""
    texts = [F.to_json(F.struct(F.col(f"`{c}`").alias("v"))) for c in columns]
    values = [F.concat(F.length(t), F.lit(":"), t) for t in texts]
    return F.sha2(F.concat(*values) if values else F.lit(""), 256)


@dataclass(frozen=True)
class SnapshotStore:
    """Versions of a table below one folder, kept by key buckets.

    A version writes the buckets in which a key was added, changed or removed, the list of these changes (removed keys are its
    tombstones), and last a manifest that names for each bucket the version that holds it: a version without a finished manifest does not
    exist, and its next run overwrites what is left of it. Unchanged buckets are not written again. Only manifests reach the
    driver: one number per bucket. Choose `buckets` so that one is a few files.

    A table is read twice, for its hashes and for the changed buckets: write it first if it comes from a join of long rows.
    Keys must be unique, a repeated key fails the commit; a NULL key is a key. All versions have the columns of the first.
    """

    spark: SparkSession
    path: str
    key: str
    buckets: int = 64

    def versions(self) -> list[int]:
        found = [int(n.removeprefix("version=")) for n in folder_names(self.spark, f"{self.path}/manifest")]
        return sorted(v for v in found if is_complete(self.spark, f"{self.path}/manifest/version={v}"))

    def _manifest(self, version: int) -> tuple[T.StructType, dict[int, int]]:
        rows = self.spark.read.schema("bucket int, held int, fields string").parquet(f"{self.path}/manifest/version={version}").collect()
        fields = next(r["fields"] for r in rows if r["fields"])
        return T.StructType.fromJson(json.loads(fields)), {r["bucket"]: r["held"] for r in rows if not r["fields"]}

    def _stored(self, version: int) -> DataFrame:
        """The rows of a version with their hashes. The filter names partitions only, so no other bucket is opened."""
        fields, held = self._manifest(version)
        whole = T.StructType([*fields.fields, T.StructField("tw_hash", T.StringType()), T.StructField("tw_version", T.IntegerType()), T.StructField("tw_bucket", T.IntegerType())])
        if not held or not folder_names(self.spark, f"{self.path}/data"):
            return self.spark.createDataFrame([], whole)
        chosen = [(F.col("tw_version") == v) & F.col("tw_bucket").isin([b for b, at in held.items() if at == v]) for v in sorted(set(held.values()))]
        return self.spark.read.schema(whole).parquet(f"{self.path}/data").where(reduce(Column.__or__, chosen))

    def read(self, version: int | None = None) -> DataFrame:
        """The table as of a version, the newest by default."""
        return self._stored(self.versions()[-1] if version is None else version).drop("tw_hash", "tw_version", "tw_bucket")

    def changes(self, version: int) -> DataFrame:
        """(key, change, content_hash): added, changed and removed keys; a removed key has no hash."""
        fields, _ = self._manifest(version)
        schema = T.StructType([fields[self.key], T.StructField("change", T.StringType()), T.StructField("content_hash", T.StringType())])
        return self.spark.read.schema(schema).parquet(f"{self.path}/changes/version={version}")

    def commit(self, current: DataFrame, version: int | None = None) -> int:
        """Store a table as the next version, or as `version`; a version that exists stays as it is. Returns its number."""
        done = self.versions()
        version = (done[-1] + 1 if done else 1) if version is None else version
        if version in done:
            return version
        if done and version < done[-1]:
            raise ValueError(f"version {version} is older than {done[-1]}")
        others = [c for c in current.columns if c != self.key]
        marked = current.withColumns({"tw_hash": row_hash(others), "tw_bucket": F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")})
        once = F.when(F.count("*") > 1, F.raise_error(F.lit("repeated key in a snapshot")).cast("string")).otherwise(F.first("tw_hash"))
        after = marked.groupBy(F.col(self.key).alias("k"), F.col("tw_bucket").alias("b")).agg(once.alias("new"))
        if done:
            fields, held = self._manifest(done[-1])
            if [(f.name, f.dataType) for f in fields] != [(f.name, f.dataType) for f in current.schema]:
                raise ValueError("all versions have the same columns")
            before = self._stored(done[-1]).select(F.col(self.key).alias("j"), F.col("tw_bucket").alias("c"), F.col("tw_hash").alias("old"))
        else:
            fields, held = current.schema, {}
            before = after.select(F.col("k").alias("j"), F.col("b").alias("c"), F.col("new").alias("old")).where(F.lit(False))
        kind = F.when(F.col("old").isNull(), "added").when(F.col("new").isNull(), "removed").when(F.col("old") != F.col("new"), "changed")
        met = after.join(before, F.col("k").eqNullSafe(F.col("j")) & (F.col("b") == F.col("c")), "full_outer")
        met = met.select(F.when(F.col("new").isNull(), F.col("j")).otherwise(F.col("k")).alias(self.key), kind.alias("change"), F.col("new").alias("content_hash"), F.coalesce("b", "c").alias("tw_bucket"))
        listed = f"{self.path}/changes/version={version}"
        met.where("change IS NOT NULL").write.mode("overwrite").parquet(listed)
        touched = sorted(r[0] for r in self.spark.read.schema("tw_bucket int").parquet(listed).distinct().collect())
        if touched:
            rows = marked.where(F.col("tw_bucket").isin(touched)).hint("rebalance", "tw_bucket")
            rows.write.mode("overwrite").option("compression", "zstd").partitionBy("tw_bucket").parquet(f"{self.path}/data/tw_version={version}")
        held = held | dict.fromkeys(touched, version)
        lines = [(b, v, None) for b, v in held.items()] + [(None, None, fields.json())]
        self.spark.createDataFrame(lines, "bucket int, held int, fields string").coalesce(1).write.mode("overwrite").parquet(f"{self.path}/manifest/version={version}")
        return version

    def forget(self, keep: int) -> list[int]:
        """Drop all but the newest `keep` versions and the buckets that only they held; returns the versions that went."""
        done = self.versions()
        gone, stay = done[:-keep], done[-keep:]
        needed = {(v, b) for version in stay for b, v in self._manifest(version)[1].items()}
        for version in gone:
            for part in ("manifest", "changes"):  # first the manifest: a half-dropped version does not exist
                remove_folder(self.spark, f"{self.path}/{part}/version={version}")
            for name in folder_names(self.spark, f"{self.path}/data/tw_version={version}"):
                if (version, int(name.removeprefix("tw_bucket="))) not in needed:
                    remove_folder(self.spark, f"{self.path}/data/tw_version={version}/{name}")
        return gone
