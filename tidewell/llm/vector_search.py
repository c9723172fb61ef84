"""Exact inner-product search over a vector-approximation file: bounds from quantised cells, then exact vectors in the order of the bounds."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.llm.common import materialize
from tidewell.operators.ranking import top_n

#: Vectors of a block of the approximation file, queries that meet it in one task, and queries of a tile of bounds.
VECTORS, QUERIES, TILE = 8_192, 8_192, 256


def whole_vectors(vectors: DataFrame, key: str, vector: str, scale: int) -> DataFrame:
    """(id, v): floor(scale * x) of every component as 64-bit numbers, one vector per key."""
    rows = vectors.select(F.col(key).alias("id"), F.col(vector).cast("array<double>").alias("x")).where("id IS NOT NULL AND size(x) > 0")
    fine = rows.where(F.forall("x", lambda e: F.coalesce(F.abs(e) < float("inf"), F.lit(False)) & ~F.isnan(e)))
    return fine.select("id", F.transform("x", lambda e: F.floor(e * float(scale))).alias("v")).groupBy("id").agg(F.min("v").alias("v"))


def equal_classes(whole: DataFrame, k: int) -> DataFrame:
    """(least, dim, v, ids): equal vectors as one row with their k + 1 smallest keys; no others can be among k results.

    Each task hands on k + 1 keys of a vector at most, so a vector that a third of all rows share is no large group.
    """
    few = top_n(whole, ["v"], [F.asc("id")], k + 1)
    return few.groupBy("v").agg(F.array_sort(F.collect_list("id")).alias("ids")).select(F.element_at("ids", 1).alias("least"), F.size("v").alias("dim"), "v", "ids")


def quantise(v: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(cells, low, high): the cell of each component, borders at its quantiles in the block, and the extremes found in each cell."""
    count = 1 << bits
    cells = np.empty(v.shape, dtype=np.uint8)
    low, high = np.zeros((count, v.shape[1]), dtype=np.int64), np.zeros((count, v.shape[1]), dtype=np.int64)
    for d in range(v.shape[1]):
        column = np.sort(v[:, d])
        borders = np.unique(column[(np.arange(1, count) * len(column)) // count])
        cells[:, d] = np.searchsorted(borders, v[:, d], side="right")
        ends = np.searchsorted(column, borders)
        used = np.flatnonzero(np.diff(np.concatenate(([0], ends, [len(column)]))))
        edges = np.concatenate(([0], ends, [len(column)]))
        low[used, d], high[used, d] = column[edges[used]], column[edges[used + 1] - 1]
    return cells, low, high


def approximation_file(found: DataFrame, blocks: Column, bits: int) -> DataFrame:
    """(dim, vb, n, ids, cells, low, high): one row per block of vectors, a byte per component."""

    def build(key: tuple, rows: pa.Table) -> pa.Table:
        v = np.array(rows.column("v").to_pylist(), dtype=np.int64)
        cells, low, high = quantise(v, bits)
        ids = rows.column("least").cast(pa.int64()).to_numpy()
        packed = [x.tobytes() for x in (ids, cells, low, high)]
        return pa.table({"dim": [key[0].as_py()], "vb": [key[1].as_py()], "n": [len(v)], "ids": packed[:1], "cells": packed[1:2], "low": packed[2:3], "high": packed[3:]}, schema=pa.schema([("dim", pa.int32()), ("vb", pa.int64()), ("n", pa.int64()), *((c, pa.binary()) for c in ("ids", "cells", "low", "high"))]))

    dealt = found.select("dim", F.pmod(F.xxhash64("least"), blocks).alias("vb"), "least", "v")
    return dealt.groupBy("dim", "vb").applyInArrow(build, "dim int, vb long, n long, ids binary, cells binary, low binary, high binary")


def bounds(q: np.ndarray, cells: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(lower, upper) bounds of the inner products of queries with vectors of which only the cells are known.

    A cell's centre gives the middle, its half width times |q| the reach. Halves of whole numbers are exact in
    doubles as far as sums stay below 2^52; beyond that the reach is widened by more than the rounding.
    """
    across = np.arange(cells.shape[1])
    small, large = low[cells, across].astype(np.float64), high[cells, across].astype(np.float64)
    centre, reach, q = (small + large) / 2, (large - small) / 2, q.astype(np.float64)
    middle, spread = q @ centre.T, np.abs(q) @ reach.T
    most = np.abs(q).max(initial=0) * max(np.abs(small).max(initial=0), np.abs(large).max(initial=0)) * q.shape[1]
    if most >= 2.0**51:
        spread += 8 * q.shape[1] * np.finfo(np.float64).eps * most
    return middle - spread, middle + spread


def scan(queries: DataFrame, file: DataFrame, blocks: Column, asked: Column, k: int) -> DataFrame:
    """(query, least, lower, upper): per block the vectors whose upper bound reaches the block's k-th lower bound of the query.

    Blocks of queries meet blocks of the file in cells of bounded size; the approximations move once per `QUERIES` queries, and
    exact vectors do not move at all.
    """
    q = queries.select("dim", F.pmod(F.xxhash64("least"), asked).alias("qb"), F.col("least").alias("query"), "v", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)).alias("vb"))
    f = file.withColumn("qb", F.explode(F.sequence(F.lit(0).cast("long"), asked - 1)))
    kind = pa.schema([("query", pa.int64()), ("least", pa.int64()), ("lower", pa.float64()), ("upper", pa.float64())])

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[pa.Table] = []
        if left.num_rows and right.num_rows:
            block = right.to_pylist()[0]
            low, high = (np.frombuffer(block[c], dtype=np.int64).reshape(-1, block["dim"]) for c in ("low", "high"))
            cells, ids = np.frombuffer(block["cells"], dtype=np.uint8).reshape(block["n"], -1), np.frombuffer(block["ids"], dtype=np.int64)
            names, v = left.column("query").cast(pa.int64()).to_numpy(), np.array(left.column("v").to_pylist(), dtype=np.int64)
            for at in range(0, len(v), TILE):
                lower, upper = bounds(v[at : at + TILE], cells, low, high)
                level = np.partition(lower, len(ids) - k, axis=1)[:, len(ids) - k] if len(ids) > k else np.full(len(lower), -np.inf)
                row, column = np.nonzero(upper >= level[:, None])
                out.append(pa.Table.from_arrays([pa.array(names[at : at + TILE][row]), pa.array(ids[column]), pa.array(lower[row, column]), pa.array(upper[row, column])], schema=kind))
        return pa.concat_tables(out) if out else kind.empty_table()

    return q.groupBy("dim", "qb", "vb").cogroup(f.groupBy("dim", "qb", "vb")).applyInArrow(meet, "query long, least long, lower double, upper double")


def exact(candidates: DataFrame, queries: DataFrame, found: DataFrame) -> DataFrame:
    """(query, least, score): the inner products of candidate vectors, which are read now."""
    asked = candidates.join(queries.select(F.col("least").alias("query"), F.col("v").alias("q")), "query")
    read = asked.join(found.select("least", "v"), "least")
    return read.select("query", "least", F.aggregate(F.zip_with("q", "v", lambda a, b: a * b), F.lit(0).cast("long"), lambda total, x: total + x).alias("score"))


def search_vectors(vectors: DataFrame, every: int = 50, key: str = "vec_id", vector: str = "embedding", k: int = 5, scale: int = 256, bits: int = 6) -> DataFrame:
    """query_id, rank, vec_id, score: the k vectors with the highest inner product of every query row, equal scores by smaller key.

    Queries are the rows whose key is divisible by `every`; all rows but the query's own are candidates. Components are floor(scale * x).

    1. Equal vectors become one class with their k + 1 smallest keys; what follows is done once per different vector, for queries as well.
    2. The approximation file holds a cell of 2^`bits` (8 at most) per component, borders at the quantiles of each block, together
       with the extremes found in every cell, so that bounds are true for all rows.
    3. A scan of the file gives bounds of every query and vector. A vector is left out when k + 1 others have lower bounds above its upper bound,
       in its block or in all.
    4. Exact vectors are read in the order of the upper bounds: first k + 1 per query; their lowest score then decides which of
       the others have to be read at all. What is not read has an upper bound below the result.

    Keys are whole numbers; rows without a key, and vectors that are NULL, empty or hold NULL or non-finite components take no part. Of rows that repeat a
    key the smallest vector counts. Vectors of different length are never compared. A score beyond 64 bits is an error. Other columns are
    ignored; an empty table, or one row alone, has no result.
    """
    kind = vectors.schema[key].dataType
    if not isinstance(kind, T.IntegralType) or not 1 <= bits <= 8:
        raise ValueError("keys must be whole numbers and cells must fit into a byte")
    whole = materialize(whole_vectors(vectors.withColumn(key, F.col(key).cast("long")), key, vector, scale), "whole-vectors")
    found = materialize(equal_classes(whole, k), "vector-classes")
    asking = materialize(whole.where(F.col("id") % every == 0).join(found.select("v", "least"), "v").select(F.col("id").alias("query_id"), "least"), "asking")
    queries = materialize(found.join(asking.select("least").distinct(), "least", "left_semi").select("least", "dim", "v"), "query-vectors")
    blocks, asked = (F.greatest(F.ceil(df.agg(F.count(F.lit(1))).scalar() / F.lit(float(size))), F.lit(1)).cast("long") for df, size in ((found, VECTORS), (queries, QUERIES)))
    file = materialize(approximation_file(found, blocks, bits), "approximations")
    near = materialize(scan(queries, file, blocks, asked, k + 1), "candidates")
    level = top_n(near, ["query"], [F.desc("lower"), F.asc("least")], k + 1).where(F.col("rank_no") == k + 1).select("query", F.col("lower").alias("level"))
    near = near.join(level, "query", "left").where(F.col("level").isNull() | (F.col("upper") >= F.col("level"))).select("query", "least", "upper")
    first = top_n(near, ["query"], [F.desc("upper"), F.asc("least")], k + 1)
    begun = materialize(exact(first, queries, found), "first-scores")
    certain = begun.groupBy("query").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("least_score")).where(F.col("n") == k + 1).drop("n")
    rest = near.join(certain, "query").where(F.col("upper") >= F.col("least_score")).join(begun, ["query", "least"], "left_anti")
    scores = begun.unionAll(exact(rest, queries, found).select(*begun.columns))
    best = top_n(scores, ["query"], [F.desc("score"), F.asc("least")], k + 1).select("query", "least", "score").join(found.select("least", "ids"), "least")
    listed = top_n(best.select("query", "score", F.explode("ids").alias("vec_id")), ["query"], [F.desc("score"), F.asc("vec_id")], k + 1).drop("rank_no")
    answers = asking.withColumnRenamed("least", "query").join(listed, "query").where("vec_id <> query_id")
    ranked = top_n(answers, ["query_id"], [F.desc("score"), F.asc("vec_id")], k, "rank")
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
