"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.session import materialize

#: Words between ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: Most rows of a small side that may be broadcast; larger sides are joined by a shuffle.
BROADCAST_ROWS = 50_000
#: Most bytes of a small side whose rows carry lists.
BROADCAST_BYTES = 64_000_000
#: Rows and Arrow bytes of a piece of a batch that a Python worker turns into texts at once; a single longer row is a piece of its own.
PIECE_ROWS = 256
PIECE_BYTES = 1 << 18


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fits_broadcast(side: DataFrame, row_bytes: Column) -> bool:
    """Whether the summed bytes of a written side stay within the bound for a broadcast."""
    return (side.agg(F.sum(row_bytes)).first()[0] or 0) <= BROADCAST_BYTES


def join_small(left: DataFrame, right: DataFrame, on, how: str = "inner", rows: int = BROADCAST_ROWS, row_bytes: Column | None = None) -> DataFrame:
    """Join with a written side: broadcast it when its counted size stays within the bound, else shuffle both.

    `right` must be cheap to count (a materialised table). Sides of short rows are bounded by their number; where rows carry lists
    or texts, `row_bytes` is summed and bounded instead. Beyond the bound adaptive execution splits hot keys.
    """
    small = right.count() <= rows if row_bytes is None else fits_broadcast(right, row_bytes)
    return left.join(F.broadcast(right) if small else right, on, how)


def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All rows of the batches in order, in pieces of bounded size: texts and what is made of them stay small in a worker's memory."""
    for batch in batches:
        at = 0
        while at < batch.num_rows:
            piece = batch.slice(at, PIECE_ROWS)
            while piece.num_rows > 1 and piece.nbytes > PIECE_BYTES:
                piece = piece.slice(0, piece.num_rows // 2)
            yield piece
            at += piece.num_rows


def running_offsets(counts: DataFrame, key: str, size: str) -> DataFrame:
    """(key, offset): sizes of all smaller keys; one row per written partition, so the window is bounded by their number."""
    from pyspark.sql import Window

    order = Window.orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    return counts.select(key, F.coalesce(F.sum(size).over(order), F.lit(0)).alias("offset"))


__all__ = ["BROADCAST_BYTES", "BROADCAST_ROWS", "PIECE_BYTES", "PIECE_ROWS", "WORD", "fits_broadcast", "join_small", "materialize", "pieces", "running_offsets", "table"]
