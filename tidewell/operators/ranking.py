"""Ranking operators: top-N, mode, latest, percentile ranks, exact quantiles, rolling baselines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell.session import materialize


def top_n(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, rank_name: str = "rank_no") -> DataFrame:
    """Best n rows per key. The order must end in a unique column so the result is stable.

    The rank filter becomes a per-task group limit before the shuffle: a task sends at most n rows per key.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    ranked = df.withColumn(rank_name, F.row_number().over(w))
    return ranked.where(F.col(rank_name) <= n).withColumn(rank_name, F.col(rank_name).cast("bigint"))


def mode_per_key(df: DataFrame, key: str, value: str, count_name: str = "cnt") -> DataFrame:
    """Most frequent value per key; ties go to the smallest value."""
    counts = df.groupBy(key, value).agg(F.count(F.lit(1)).alias(count_name))
    return top_n(counts, [key], [F.desc(count_name), F.asc(value)], 1).drop("rank_no")


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    return top_n(df, keys, order, 1).drop("rank_no")


def cumulative_histogram(df: DataFrame, values: Sequence[str], slice_values: int = 500_000) -> DataFrame:
    """Distinct non-NULL values of each column with their row count and the number of rows strictly below.

    Columns: `item` (column name), `value` (double), `n`, `below`, `total`. All columns are counted in one pass
    and equal values are added up before the shuffle, so a dominant value is one row. The counts are written
    once to the shared folder; the running sum is then taken inside value slices and shifted by the totals of
    the lower slices - `slices` numbers per column. Slices are cut at approximate quantiles of the distinct
    values, one per `slice_values` distinct values; they only steer the parallelism and never the result.
    """
    long = df.select(F.inline(F.array(*[F.struct(F.lit(v).alias("item"), F.col(v).cast("double").alias("value")) for v in values])))
    counted = long.where(F.col("value").isNotNull()).groupBy("item", "value").agg(F.count(F.lit(1)).alias("n"))
    hist = materialize(counted, "histogram")
    slices = max(2, -(-hist.count() // slice_values))
    cuts = [i / slices for i in range(1, slices)]
    bounds = hist.groupBy("item").agg(F.percentile_approx("value", cuts, 1000).alias("bounds"), F.sum("n").alias("total"))
    sliced = hist.join(F.broadcast(bounds), "item").withColumn("slice", F.size(F.filter("bounds", lambda b: b < F.col("value")))).drop("bounds")
    ladder = sliced.groupBy("item", "slice").agg(F.sum("n").alias("slice_n"))
    ladder = ladder.groupBy("item").agg(F.collect_list(F.struct("slice", "slice_n")).alias("ladder"))
    lower = F.filter("ladder", lambda s: s["slice"] < F.col("slice"))
    offset = F.aggregate(lower, F.lit(0).cast("bigint"), lambda acc, s: acc + s["slice_n"])
    w = Window.partitionBy("item", "slice").orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    return (
        sliced.withColumn("inside", F.coalesce(F.sum("n").over(w), F.lit(0)))
        .join(F.broadcast(ladder), "item")
        .select("item", "value", "n", (offset + F.col("inside")).alias("below"), "total")
    )


def pct_rank_average(df: DataFrame, aliases: dict[str, str]) -> DataFrame:
    """Attach average rank / number of non-NULL values per column; tied values share the mean of their ranks.

    `aliases` maps each value column to the name of its rank.
    """
    hist = cumulative_histogram(df, list(aliases))
    rank = (F.col("below") + (F.col("n") + 1) / F.lit(2.0)) / F.col("total")
    out = df
    for value, alias in aliases.items():
        ranks = hist.where(F.col("item") == value).select(F.col("value").alias("_value"), rank.alias(alias))
        out = out.join(ranks, F.col(value).cast("double") == F.col("_value"), "left").drop("_value")
    return out


def exact_quantiles(df: DataFrame, value: str, probabilities: dict[str, float]) -> DataFrame:
    """One row with exact linearly interpolated quantiles, without sorting the data in one task."""
    hist = cumulative_histogram(df, [value])
    picks = []
    for name, p in probabilities.items():
        position = (F.col("total") - 1).cast("double") * F.lit(p)
        for edge, at in (("lo", F.floor(position)), ("hi", F.ceil(position))):
            covers = (F.col("below") <= at) & (at < F.col("below") + F.col("n"))
            picks.append(F.max(F.when(covers, F.col("value"))).alias(f"{name}_{edge}"))
    edges = hist.agg(F.max("total").alias("total"), *picks)
    out = []
    for name, p in probabilities.items():
        position = (F.col("total") - 1).cast("double") * F.lit(p)
        lo, hi = F.col(f"{name}_lo"), F.col(f"{name}_hi")
        out.append((lo + (hi - lo) * (position - F.floor(position))).alias(name))
    return edges.select(*out)


def rolling_baseline(
    df: DataFrame, value: str, order: str, alias: str, keys: Sequence[str] = (), rows: int = 7, min_rows: int = 3
) -> DataFrame:
    """Mean of the previous `rows` rows, NULL until `min_rows` of them exist.

    Meant for daily metrics: a partition holds one row per day, so its size is bounded by the calendar.
    """
    w = Window.partitionBy(*(keys or [F.lit(0)])).orderBy(order).rowsBetween(-rows, -1)
    seen = F.count(value).over(w)
    mean = F.try_divide(F.sum(value).over(w).cast("double"), seen.cast("double"))
    return df.withColumn(alias, F.when(seen >= min_rows, mean))


def best_and_worst(df: DataFrame, key: str, value: str) -> DataFrame:
    """The key with the lowest and with the highest value; ties go to the smaller key, then the larger one."""
    order = F.struct(F.col(value), F.col(key))
    return df.agg(
        F.min_by(key, order).alias("worst_key"),
        F.min(value).alias("worst_value"),
        F.max_by(key, order).alias("best_key"),
        F.max(value).alias("best_value"),
        F.count(F.lit(1)).alias("key_cnt"),
    )
