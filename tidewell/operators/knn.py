"""Exact nearest neighbours of many queries in one job."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.operators.ranking import top_n


def _distances(q: np.ndarray, v: np.ndarray, metric: str) -> np.ndarray:
    if metric == "cosine":
        norms = np.linalg.norm(q, axis=1)[:, None] * np.linalg.norm(v, axis=1)[None, :]
        return 1.0 - np.divide(q @ v.T, norms, out=np.zeros((len(q), len(v))), where=norms > 0)
    # Differences, not the expanded square: the expansion cancels badly for close vectors.
    return np.stack([((v - row) ** 2).sum(axis=1) for row in q])


def knn_topk(
    queries: DataFrame, vectors: DataFrame, k: int, query_keys: Sequence[str], vector_key: str, metric: str = "l2",
    digits: int = 6, query_block: int = 512, vector_block: int = 20000,
) -> DataFrame:
    """The k nearest vectors of every query with `distance` and `rank_no`; ties go to the smaller vector key.

    Both sides are hashed by their unique key into blocks of bounded size and every query block meets every
    vector block once; inside a task the distances are matrix operations and only the k best per query leave
    it. So pairs are never emitted, no side has to fit in one place, and no key can be hot. Exact search has to
    look at every pair once; the vectors move once per query block. Neighbours are chosen by
    the full distance; only the returned column is rounded to `digits`.
    """
    def blocks(df: DataFrame, size: int):
        return F.greatest(F.ceil(df.agg(F.count(F.lit(1))).scalar() / F.lit(float(size))), F.lit(1)).cast("int")

    nq, nv = blocks(queries, query_block), blocks(vectors, vector_block)
    q = queries.select(*query_keys, F.col("embedding").alias("qe")).withColumns(
        {"qb": F.pmod(F.xxhash64(*query_keys), nq), "vb": F.explode(F.sequence(F.lit(0).cast("bigint"), nv.cast("bigint") - 1))}
    )
    v = vectors.select(vector_key, F.col("embedding").alias("ve")).withColumns(
        {"vb": F.pmod(F.xxhash64(vector_key), nv), "qb": F.explode(F.sequence(F.lit(0).cast("bigint"), nq.cast("bigint") - 1))}
    )
    key_fields = [queries.schema[c] for c in query_keys] + [vectors.schema[vector_key]]
    schema = T.StructType([*key_fields, T.StructField("distance", T.DoubleType())])
    columns = schema.fieldNames()

    def best(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame(columns=columns)
        right = right.sort_values(vector_key, ignore_index=True)
        qm = np.array(left["qe"].tolist(), dtype=float)
        top_d, top_i = np.empty((len(qm), 0)), np.empty((len(qm), 0), dtype=int)
        for start in range(0, len(right), 4096):
            part = np.array(right["ve"].iloc[start : start + 4096].tolist(), dtype=float)
            d = np.concatenate([top_d, _distances(qm, part, metric)], axis=1)
            i = np.concatenate([top_i, np.broadcast_to(np.arange(start, start + len(part)), (len(qm), len(part)))], axis=1)
            order = np.argsort(d, axis=1, kind="stable")[:, :k]
            top_d, top_i = np.take_along_axis(d, order, 1), np.take_along_axis(i, order, 1)
        width = top_i.shape[1]
        out = {c: np.repeat(left[c].to_numpy(), width) for c in query_keys}
        out[vector_key] = right[vector_key].to_numpy()[top_i.ravel()]
        out["distance"] = top_d.ravel()
        return pd.DataFrame(out)[columns]

    local = q.groupBy("qb", "vb").cogroup(v.groupBy("qb", "vb")).applyInPandas(best, schema)
    best_rows = top_n(local, list(query_keys), [F.asc("distance"), F.asc(vector_key)], k)
    return best_rows.withColumn("distance", F.round("distance", digits))
