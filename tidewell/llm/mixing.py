"""Mixing sources to target weights: whole copies by rate, one more by a seeded draw."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell.llm.common import WORD, join_small, materialize

MOST = 3


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def cyclic_weights(sources: DataFrame, cycle: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """(source, weight): sources by code point, NULL last, weigh by the repeating cycle. One row per source is ranked."""
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    return sources.select("source", F.element_at(F.array(*map(F.lit, cycle)), (place % len(cycle) + 1).cast("int")).cast("double").alias("weight"))


def source_rates(sizes: DataFrame, weights: DataFrame, most: int = MOST) -> DataFrame:
    """(source, source_size, target, rate) from (source, source_size) and (source, weight).

    Targets share the total size by weight; a target stops at `most` times its source, and what it leaves is shared
    again by weight until none is above. Each round only moves two sums to the driver. A source without words gets rate 0.
    """
    weights = weights.select(F.col("source").alias("weighed"), "weight")
    plan = sizes.join(weights, F.col("source").eqNullSafe(F.col("weighed"))).select("source", "source_size", "weight")
    plan = materialize(plan, "source-plan")
    total = plan.agg(F.sum("source_size")).first()[0] or 0
    level = 0.0
    full = F.lit(False)
    while True:
        left, weight = plan.agg(F.sum(F.when(full, F.col("source_size"))), F.sum(F.when(~full, F.col("weight")))).first()
        if not weight:
            break
        following = (total - most * (left or 0)) / weight
        if following <= level:
            break
        level = following
        full = F.col("weight") * F.lit(level) >= most * F.col("source_size")
    target = F.when(full, F.col("source_size") * float(most)).otherwise(F.col("weight") * F.lit(level))
    plan = plan.withColumn("target", target.cast("double"))
    return plan.select("source", "source_size", "target", F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(most)))).otherwise(0.0).alias("rate"))


def draw(key: str, text: str, seed: int) -> Column:
    """A number in [0, 1) from the seed, the key and the text: the same in every run and on every machine."""
    mark = F.md5(F.concat_ws("|", F.lit(str(seed)), F.coalesce(F.col(key).cast("string"), F.lit("")), F.md5(F.coalesce(F.col(text), F.lit("")))))
    return F.conv(F.substring(mark, 1, 13), 16, 10).cast("double") / float(16**13)


def repetitions(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", weights: DataFrame | None = None, seed: int = 7) -> DataFrame:
    """All rows and columns of `docs` with mix_size, mix_source_size, mix_target and mix_copies.

    A document is taken floor(rate) times and once more when its draw is below the fraction of the rate, so it never
    exceeds three times its size. NULL text has size 0; NULL is a source of its own. Repeated rows draw alike. Columns
    of the input that are called like the four new ones are replaced. Sizes are pre-aggregated per source in each
    task; the per-source table is attached by broadcast within its size bound, so a hot source moves no documents.
    """
    sizes = materialize(docs.select(F.col(source).alias("source"), word_count(text).alias("n")).groupBy("source").agg(F.sum("n").alias("source_size")), "source-sizes")
    rates = materialize(source_rates(sizes, weights if weights is not None else cyclic_weights(sizes)), "source-rates")
    rates = rates.select(F.struct("source").alias("mix_key"), F.col("source_size").alias("mix_source_size"), F.col("target").alias("mix_target"), F.col("rate").alias("mix_rate"))
    docs = docs.drop("mix_key", "mix_source_size", "mix_target", "mix_rate", "mix_size", "mix_copies")
    known = join_small(docs.withColumn("mix_key", F.struct(F.col(source).alias("source"))), rates, "mix_key")
    copies = F.floor("mix_rate") + (draw(key, text, seed) < F.col("mix_rate") - F.floor("mix_rate")).cast("long")
    return known.withColumn("mix_size", word_count(text)).withColumn("mix_copies", copies).drop("mix_key", "mix_rate")


def mix_sources(docs: DataFrame, **options) -> DataFrame:
    """The mixed documents: every row as often as it is taken (at most three times), with the columns of `docs`."""
    taken = repetitions(docs, **options)
    many = taken.where("mix_copies > 0").withColumn("mix_copy", F.explode(F.sequence(F.lit(1), F.col("mix_copies").cast("int"))))
    return many.select(*[F.col(f"`{c}`") for c in docs.columns])
