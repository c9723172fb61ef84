"""File sources and sinks."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.operators.relational import require_columns
from tidewell.session import scratch_path


def read_csv_table(spark: SparkSession, path: str, schema: str | T.StructType, date_format: str = "yyyy-MM-dd", required: Iterable[str] = ()) -> DataFrame:
    """CSV with header and a declared schema: one pass, no inference. Blank lines are skipped.

    The header decides the column order, columns of the file that the schema does not name are ignored, and a
    named column that is missing fails before any job starts.
    """
    wanted = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    header = spark.read.option("header", True).csv(path)
    require_columns(header, list(required) or wanted.fieldNames())
    present = T.StructType([wanted[c] if c in wanted.fieldNames() else T.StructField(c, T.StringType()) for c in header.columns])
    reader = spark.read.option("header", True).option("dateFormat", date_format)
    df = reader.option("mode", "FAILFAST").schema(present).csv(path)
    return df.select(*[c for c in wanted.fieldNames() if c in df.columns])


def read_documents(spark: SparkSession, folder: str, pattern: str = "*.{txt,md,TXT,MD}") -> DataFrame:
    """Every text file below the folder as one row: path, name, text."""
    files = spark.read.text(folder, wholetext=True, recursiveFileLookup=True, pathGlobFilter=pattern)
    path = F.url_decode(F.regexp_replace(F.input_file_name(), r"\+", "%2B"))
    return files.select(path.alias("path"), F.element_at(F.split(path, "/"), -1).alias("name"), F.col("value").alias("text"))


def write_csv_result(df: DataFrame, path: str, order: Sequence[Column | str] = ()) -> str:
    """Result as CSV with header; ordered across the part files when an order is given."""
    out = df.orderBy(*order) if order else df
    writer = out.write.mode("overwrite").option("header", True).option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    writer.csv(path)
    return path


def write_partitioned(df: DataFrame, column: str, name: str, path: str | None = None) -> str:
    """One folder per value of a low-cardinality column; returns the path."""
    target = path or scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").partitionBy(column).parquet(target)
    return target


def read_written(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def write_json_payload(df: DataFrame, path: str) -> str:
    """A frame with one JSON text column, written as JSON lines."""
    df.write.mode("overwrite").text(path)
    return path
