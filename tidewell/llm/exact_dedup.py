"""Exact duplicates by skew-safe combining: local, then salted, then global, on full content at every stage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import join_small, materialize


def exact_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = 512, hot: int = 16_384, digest=None) -> DataFrame:
    """One row per input row: key, keep_id, group_size, kept, text_sha256. Equal texts keep the row with the largest key.

    1. Digests are counted without their texts. Digests of more than max(least, rows / hot) rows are hot; there are
       fewer than `hot` of them, so their list may be broadcast. A hot digest gets a salt per such share of its rows.
    2. Rows are grouped by (digest, salt, full text): Spark combines within each task first, so copies leave a task once,
       with the list of their keys. A salted group holds about one share of rows, whatever the size of the whole group.
    3. Winners of the salts of hot digests are combined by (digest, full text) and handed back to their salts.

    NULL text counts as empty. NULL keys are the smallest; they form groups like others. Of repeated rows with the
    same key and text exactly one is kept. Other columns are ignored. An empty table gives an empty result.
    `digest` (a function of the text column) only decides where rows meet; colliding digests do no harm.
    """
    digest = digest or (lambda t: F.sha2(t, 256))
    base = docs.select(F.col(key).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("body")).withColumn("digest", digest(F.col("body")))
    sizes = base.groupBy("digest").count()
    total = docs.count()
    share = max(least, -(-total // hot))
    busy = materialize(sizes.where(F.col("count") > share).select("digest", F.ceil(F.col("count") / share).cast("int").alias("salts")), "hot-digests")
    salted = join_small(base, busy, "digest", "left", hot).withColumn("salt", F.coalesce(F.pmod(F.xxhash64("id"), F.col("salts")), F.lit(0)))
    merged = salted.groupBy("digest", "salt", "body", F.col("salts").isNotNull().alias("busy")).agg(
        F.max("id").alias("top"), F.count("*").alias("n"), F.sort_array(F.collect_list(F.struct("id")), asc=False).alias("ids")
    )
    merged = materialize(merged.withColumn("sha", F.sha2("body", 256)).withColumn("body", F.when(F.col("busy"), F.col("body"))), "salted-groups")
    calm = merged.where("NOT busy").select("sha", "top", "n", "ids")
    winners = merged.where("busy").select("digest", "salt", "body", "top", "n")
    best = winners.groupBy("digest", "body").agg(F.max("top").alias("top"), F.sum("n").alias("n"))
    back = winners.select("digest", "salt", "body").join(best, ["digest", "body"])
    loud = merged.where("busy").select("digest", "salt", "body", "sha", "ids").join(back, ["digest", "salt", "body"]).select("sha", "top", "n", "ids")
    rows = calm.unionByName(loud).select("sha", "top", "n", F.posexplode("ids").alias("at", "row"))
    return rows.select(
        F.col("row.id").alias(key),
        F.col("top").alias("keep_id"),
        F.col("n").alias("group_size"),
        (F.col("row.id").eqNullSafe(F.col("top")) & (F.col("at") == 0)).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )
