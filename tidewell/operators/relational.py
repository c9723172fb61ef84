"""Small relational operators: cleaning, joins, set operations, validation.

Grouping always happens before a shuffle-heavy join, so a key that holds a third of all rows is reduced on the
map side first; where rows themselves must be joined on such a key, adaptive execution splits the partition.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def require_columns(df: DataFrame, required: Iterable[str]) -> DataFrame:
    """Fail before any job starts when a required column is missing; extra columns are fine."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"Missing required columns: {missing}")
    return df


def drop_all_null_rows(df: DataFrame) -> DataFrame:
    return df.na.drop("all")


def dedup_keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key, the first in the given order.

    The row-number filter is pushed below the shuffle as a per-task group limit, so each task sends at most one
    row per key and a heavily repeated key costs nothing extra.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def scalar(df: DataFrame, value: Column) -> Column:
    """One aggregated value as a scalar subquery: computed once, never a join."""
    return df.agg(value.alias("v")).scalar()


def since(df: DataFrame, time_column: str, days: int, anchor: Column | None = None) -> DataFrame:
    """Rows of the last `days` days before the anchor (default: the newest row)."""
    newest = scalar(df, F.max(time_column)) if anchor is None else anchor
    return df.where(F.col(time_column) >= newest - F.make_dt_interval(F.lit(days)))


def share(df: DataFrame, value: str, alias: str) -> DataFrame:
    """value / grand total."""
    total = scalar(df, F.sum(value).cast("double"))
    return df.withColumn(alias, F.try_divide(F.col(value).cast("double"), total))


def null_fill(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})


def count_per_group(df: DataFrame, keys: Sequence[str], alias: str) -> DataFrame:
    """Attach the row count of each group to its rows: partial counts first, then one join.

    NULL keys form a group of their own, as in a window.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(alias))
    counts = counts.withColumnsRenamed({k: f"_group_{k}" for k in keys})
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_group_{k}")) for k in keys])
    return df.join(counts, same).drop(*[f"_group_{k}" for k in keys])


def group_members(df: DataFrame, key: str, member: str, alias: str, among: Column | None = None) -> DataFrame:
    """Per member: distinct members seen on any of its keys' group. Replaces a self join on the key.

    Pairs of members are never formed: distinct (key, member) pairs are counted per key, then the count is
    joined back. A NULL key belongs to no group and counts 0. `member` must be unique in `df`.
    """
    base = df if among is None else df.where(among)
    sizes = base.select(key, member).distinct().groupBy(key).agg(F.count(member).alias(alias))
    return df.select(member, key).join(sizes, key, "left").select(member, F.coalesce(alias, F.lit(0)).alias(alias))


def orphans(child: DataFrame, key: str, parent: DataFrame, parent_key: str | None = None) -> DataFrame:
    """Rows whose key has no match in the parent table."""
    ids = parent.select(F.col(parent_key or key).alias(key))
    return child.join(ids, key, "left_anti")


def split_valid(df: DataFrame, is_valid: Column) -> tuple[DataFrame, DataFrame]:
    """Rows that pass and rows that do not; an undecided (NULL) condition counts as not valid.

    The valid side takes the plain condition, so its parts can be pushed below joins and into scans.
    """
    return df.where(is_valid), df.where(~F.coalesce(is_valid, F.lit(False)))


def stack_rows(df: DataFrame, names: Sequence[str], columns: dict[str, Sequence[Column]]) -> DataFrame:
    """Turn a one-row frame into several labelled rows without scanning it again."""
    structs = [
        F.struct(F.lit(name).alias("_name"), *[values[i].alias(c) for c, values in columns.items()])
        for i, name in enumerate(names)
    ]
    return df.select(F.inline(F.array(*structs)))
