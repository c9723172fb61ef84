"""Facts laid out by day: complete days are replaced, old days are dropped, and reads open the days they need."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DAY = "day"


def _open(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders below a path of any file system Spark reads; none if it does not exist."""
    files, place = _open(spark, path)
    return sorted(s.getPath().getName() for s in files.listStatus(place) if s.isDirectory()) if files.exists(place) else []


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether the write of a folder was finished."""
    files, place = _open(spark, f"{path}/_SUCCESS")
    return files.exists(place)


def remove_folder(spark: SparkSession, path: str) -> None:
    files, place = _open(spark, path)
    files.delete(place, True)


def write_days(facts: DataFrame, ts: str, path: str) -> None:
    """Replace the days that occur in `facts` and leave all others untouched; running it again changes nothing.

    Rows are rebalanced by day, so small days become one file and adaptive execution spreads a day that holds a third of all rows over several
    tasks. Rows without a time form a partition of their own. A column named `day` would clash and is refused.
    """
    if DAY in facts.columns:
        raise ValueError(f"a column named {DAY} is the partition of this layout")
    dated = facts.withColumn(DAY, F.col(ts).cast("date")).hint("rebalance", DAY)
    dated.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(DAY).parquet(path)


def stored_days(spark: SparkSession, path: str) -> list[dt.date]:
    """The days that are stored, from the folder names: no file is opened."""
    names = [n.removeprefix(f"{DAY}=") for n in folder_names(spark, path) if n.startswith(f"{DAY}=")]
    return [dt.date.fromisoformat(n) for n in names if n[:1].isdigit()]


def read_days(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(f"{schema}, {DAY} date").parquet(path)


def recent_facts(spark: SparkSession, path: str, schema: str, ts: str, days: int) -> DataFrame:
    """Facts of the last `days` days before the newest one. The newest time is looked up in the newest day alone; the result opens
    no folder of an earlier day than it needs. Rows without a time are left out; without any day the result is empty."""
    facts, stored = read_days(spark, path, schema), stored_days(spark, path)
    if not stored:
        return facts.where(F.lit(False))
    newest = facts.where(F.col(DAY) == F.lit(max(stored))).agg(F.max(ts).cast("string")).first()[0]
    start = F.lit(newest).cast(facts.schema[ts].dataType) - F.make_dt_interval(F.lit(days))  # a constant, so the day's part of the filter chooses folders
    return facts.where((F.col(DAY) >= start.cast("date")) & (F.col(ts) >= start))


def drop_days_before(spark: SparkSession, path: str, first: dt.date) -> list[dt.date]:
    """Drop the folders of earlier days, no file of another day is read or written; returns the days that went."""
    gone = [day for day in stored_days(spark, path) if day < first]
    for day in gone:
        remove_folder(spark, f"{path}/{DAY}={day.isoformat()}")
    return gone
