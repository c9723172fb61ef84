"""Data-quality checks: every check on a table is one aggregate of a single pass over it."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.operators.relational import orphans, stack_rows

REPORT_COLUMNS = ("check_item", "check_result", "detail")


@dataclass(frozen=True)
class Check:
    """A named check: an aggregate (number of bad rows unless said otherwise) and when it passes."""

    name: str
    measure: Column
    passes: str = "zero"  # zero | positive
    failure: str = "FAIL"
    severity: str = "high"


def not_null(name: str, *columns: str, severity: str = "high") -> Check:
    bad = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])
    return Check(name, _bad_rows(bad), severity=severity)


def non_negative(name: str, column: str, severity: str = "high") -> Check:
    return Check(name, _bad_rows(F.col(column) < 0), severity=severity)


def in_range(name: str, column: str, low: float, high: float, severity: str = "high") -> Check:
    return Check(name, _bad_rows((F.col(column) < low) | (F.col(column) > high)), severity=severity)


def at_most(name: str, column: str, limit: Column, severity: str = "medium") -> Check:
    return Check(name, _bad_rows(F.col(column) > limit), severity=severity)


def matches(name: str, column: str, pattern: str, severity: str = "medium") -> Check:
    """NULL is allowed, other values must match the pattern."""
    return Check(name, _bad_rows(~F.col(column).rlike(pattern)), severity=severity)


def row_count(name: str, severity: str = "high") -> Check:
    return Check(name, F.count(F.lit(1)), "positive", severity=severity)


def _bad_rows(bad: Column) -> Column:
    # NULL on an empty table, which then fails: an empty input is never reported as clean.
    return F.sum(F.when(bad, 1).otherwise(0))


def run_checks(df: DataFrame, *checks: Check, with_severity: bool = False) -> DataFrame:
    """All checks of one table in one scan: (check_item, check_result, detail)."""
    measured = df.agg(*[c.measure.alias(f"m{i}") for i, c in enumerate(checks)])
    columns: dict[str, list[Column]] = {"check_result": [], "detail": []}
    for i, check in enumerate(checks):
        m = F.col(f"m{i}")
        ok = m > 0 if check.passes == "positive" else m == 0
        columns["check_result"].append(F.when(ok, F.lit("PASS")).otherwise(F.lit(check.failure)))
        columns["detail"].append(m.cast("string"))
    if with_severity:
        columns["severity"] = [F.lit(c.severity) for c in checks]
    return stack_rows(measured, [c.name for c in checks], columns).withColumnRenamed("_name", "check_item")


def foreign_key(name: str, child: DataFrame, key: str, parent: DataFrame, parent_key: str | None = None, severity: str = "high", with_severity: bool = False) -> DataFrame:
    """Child rows without a parent. An anti join, so only the unmatched rows are counted."""
    bad = orphans(child.select(key), key, parent, parent_key)
    rows = child.agg(F.count(F.lit(1))).scalar()
    check = Check(name, F.when(rows > 0, F.count(F.lit(1))), severity=severity)
    return run_checks(bad, check, with_severity=with_severity)


def group_cardinality(name: str, df: DataFrame, key: str, expected: int, failure: str = "WARN", severity: str = "medium", with_severity: bool = False) -> DataFrame:
    """Smallest and largest group size must both equal the expected number."""
    spread = df.groupBy(key).agg(F.count(F.lit(1)).alias("cnt")).agg(F.min("cnt").alias("lo"), F.max("cnt").alias("hi"))
    ok = (F.col("lo") == expected) & (F.col("hi") == expected)
    columns = [
        F.lit(name).alias("check_item"),
        F.when(ok, F.lit("PASS")).otherwise(F.lit(failure)).alias("check_result"),
        F.concat(F.lit("min="), F.col("lo").cast("string"), F.lit(", max="), F.col("hi").cast("string")).alias("detail"),
    ]
    if with_severity:
        columns.append(F.lit(severity).alias("severity"))
    return spread.select(*columns)


def report(*parts: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def pass_rate(quality: DataFrame) -> DataFrame:
    passed, total = F.count_if(F.col("check_result") == "PASS"), F.count(F.lit(1))
    return quality.agg(
        passed.alias("pass_cnt"),
        total.alias("check_cnt"),
        F.try_divide(passed.cast("double"), total.cast("double")).alias("pass_rate"),
    )


def duplicate_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_cnt")).where("row_cnt > 1")


def distribution_drift(before: DataFrame, after: DataFrame, value: str, edges: list[float], floor: float = 1e-4) -> DataFrame:
    """Share per bin in two periods and the bin's part of the population stability index."""

    def binned(df: DataFrame, name: str) -> DataFrame:
        position = reduce(lambda acc, e: acc + F.when(F.col(value) >= e, 1).otherwise(0), edges, F.lit(0))
        return df.where(F.col(value).isNotNull()).groupBy(position.alias("bin")).agg(F.count(F.lit(1)).alias(name))

    a, b = binned(before, "before_cnt"), binned(after, "after_cnt")
    total_a = a.agg(F.sum("before_cnt").cast("double")).scalar()
    total_b = b.agg(F.sum("after_cnt").cast("double")).scalar()
    both = a.join(b, "bin", "full_outer").select(
        F.col("bin").cast("bigint").alias("bin"),
        F.coalesce("before_cnt", F.lit(0)).alias("before_cnt"),
        F.coalesce("after_cnt", F.lit(0)).alias("after_cnt"),
    )
    pa = F.greatest(F.try_divide(F.col("before_cnt").cast("double"), total_a), F.lit(floor))
    pb = F.greatest(F.try_divide(F.col("after_cnt").cast("double"), total_b), F.lit(floor))
    return both.withColumn("psi", (pb - pa) * F.log(pb / pa))
