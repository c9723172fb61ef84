"""Ranked lexical search: posting lists cut into blocks of similar documents, blocks skipped by their coordinatewise-maximum summaries."""

from __future__ import annotations

import uuid
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.llm.common import join_small, materialize
from tidewell.llm.decontaminate import words_of
from tidewell.operators.ranking import top_n

#: Terms are runs of these ASCII characters and of all others beyond ASCII, A-Z lower-cased.
INSIDE = b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
_TO = bytes((c + 32 if 65 <= c <= 90 else c) if c > 127 or c in INSIDE else 32 for c in range(256))
#: (item, term) rows of a block of items: what the driver holds and broadcasts at a time.
ASKED = 1 << 18
#: Cells (documents x terms asked for) of a shard, documents of a block of a posting list, and postings a task gets.
CELLS, BLOCK, POSTINGS = 8_000_000, 64, 400_000
PLANES = 16
_HASHES: dict[bytes, int] = {}


def similarity_code(terms: list[bytes], counts: np.ndarray) -> int:
    """A number that is close for similar documents: the sides of 16 random planes, then the smallest term hash."""
    if len(_HASHES) > 1_000_000:
        _HASHES.clear()
    hashes = []
    for t in terms:
        h = _HASHES.get(t)
        if h is None:
            h = _HASHES[t] = zlib.crc32(t)
        hashes.append(h)
    h = np.array(hashes, dtype=np.uint64)
    signs = ((h[:, None] >> np.arange(PLANES, dtype=np.uint64)) & np.uint64(1)).astype(np.float64) * 2 - 1
    sides = (np.log1p(counts) @ signs) > 0
    least = int(((h * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)).min())
    return (int((sides << np.arange(PLANES)).sum()) << 32) | least


def postings(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(row, key, n, code, term, tf): a head without term for every document with terms, then one row per different term."""
    kind = docs.schema[key].dataType.simpleString()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            at, bodies = 0, batch.column(1).to_pylist()
            while at < len(bodies):
                own, rows, sizes, codes, terms, times = [], [], [], [], [], []
                while at < len(bodies) and len(terms) < 100_000:
                    words = (bodies[at] or "").encode().translate(_TO).split(b" ")
                    counted = Counter(words)
                    blank = counted.pop(b"", 0)
                    if counted:
                        some, tf = list(counted), list(counted.values())
                        own += [at] * (len(some) + 1)
                        rows += [row] * (len(some) + 1)
                        sizes += [len(words) - blank] * (len(some) + 1)
                        codes += [similarity_code(some, np.array(tf, dtype=np.float64))] * (len(some) + 1)
                        terms += [None, *some]
                        times += [0, *tf]
                        row += 1
                    at += 1
                columns = [pa.array(rows, pa.int64()), batch.column(0).take(pa.array(own, pa.int64())), pa.array(sizes, pa.int64()), pa.array(codes, pa.int64()), pa.array(terms, pa.binary()).cast(pa.string()), pa.array(times, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["row", "key", "n", "code", "term", "tf"])

    return docs.select(F.col(key).alias("key"), F.col(text).alias("body")).mapInArrow(read, f"row long, key {kind}, n long, code long, term string, tf long")


class Asked:
    """Items of a block by the numbers of their terms; for each term the terms it shares an item with (its summary's coordinates)."""

    def __init__(self, terms: list[np.ndarray], size: int):
        self.terms, self.size = terms, size
        of_term: list[list[int]] = [[] for _ in range(size)]
        for item, own in enumerate(terms):
            for t in own.tolist():
                of_term[t].append(item)
        self.near = [np.unique(np.concatenate([terms[i] for i in items])) if items else np.zeros(0, dtype=np.int64) for items in of_term]
        self.columns = [[np.searchsorted(self.near[t], own) for t in own.tolist()] for own in terms]


class Shard:
    """Documents of similar code with their posting lists; every list is cut into blocks of neighbours, each with a summary."""

    def __init__(self, bounds: np.ndarray, terms: np.ndarray, impacts: np.ndarray, asked: Asked, block: int, summaries: bytes | None = None):
        self.asked, self.docs, self.block = asked, len(bounds) - 1, block
        doc = np.repeat(np.arange(self.docs), np.diff(bounds))
        self.impact = np.zeros((self.docs, asked.size), dtype=np.int64)
        self.impact[doc, terms] = impacts
        order = np.argsort(terms, kind="stable")
        self.members, edges = doc[order], np.searchsorted(terms[order], np.arange(asked.size + 1))
        self.edges = edges
        self.summary: dict[int, np.ndarray] = {}
        stored = None if summaries is None else np.frombuffer(summaries, dtype=np.int64)
        at = 0
        for t in np.flatnonzero(np.diff(edges)).tolist():
            near, own = asked.near[t], self.members[edges[t] : edges[t + 1]]
            blocks = -(-len(own) // block)
            if stored is None:
                self.summary[t] = np.maximum.reduceat(self.impact[np.ix_(own, near)], np.arange(0, len(own), block), axis=0)
            else:
                self.summary[t] = stored[at : at + blocks * len(near)].reshape(blocks, -1)
                at += blocks * len(near)

    def stored(self) -> bytes:
        return b"".join(self.summary[t].tobytes() for t in sorted(self.summary))

    def blocks(self, item: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(bounds, first, last) of the blocks of an item's lists: no document of a block scores more than its bound."""
        found, first, last = [], [], []
        for t, columns in zip(self.asked.terms[item].tolist(), self.asked.columns[item]):
            if t in self.summary:
                found.append(self.summary[t][:, columns].sum(axis=1))
                first.append(np.arange(self.edges[t], self.edges[t + 1], self.block))
                last.append(np.minimum(first[-1] + self.block, self.edges[t + 1]))
        if not found:
            return (np.zeros(0, dtype=np.int64),) * 3
        return np.concatenate(found), np.concatenate(first), np.concatenate(last)

    def scores(self, item: int, docs: np.ndarray) -> np.ndarray:
        return self.impact[np.ix_(docs, self.asked.terms[item])].sum(axis=1)

    def pilot(self, item: int, k: int) -> np.ndarray:
        """Exact scores, k at most, of documents in the blocks with the highest bounds."""
        bound, first, last = self.blocks(item)
        order = np.argsort(-bound, kind="stable")
        order = order[: np.searchsorted(np.cumsum((last - first)[order]), 2 * k) + 1]
        docs = np.unique(np.concatenate([self.members[a:b] for a, b in zip(first[order], last[order])])) if len(order) else np.zeros(0, dtype=np.int64)
        found = self.scores(item, docs)
        return np.sort(found[found > 0])[::-1][:k]

    def search(self, item: int, level: int) -> tuple[np.ndarray, np.ndarray, int]:
        """(documents, scores, documents scored): all with `level` or more. A document in a block whose bound fails cannot be one."""
        bound, first, last = self.blocks(item)
        state = np.zeros(self.docs, dtype=np.int8)
        for a, b in zip(first[bound >= level], last[bound >= level]):
            state[self.members[a:b]] = 1
        for a, b in zip(first[bound < level], last[bound < level]):
            state[self.members[a:b]] = 0
        docs = np.flatnonzero(state)
        found = self.scores(item, docs)
        kept = found >= level
        return docs[kept], found[kept], len(docs)


_ASKED: dict[str, Asked] = {}


def asked_of(shared) -> Asked:
    """The broadcast block of items, prepared once per process."""
    name, terms, size = shared.value
    if name not in _ASKED:
        _ASKED.clear()
        _ASKED[name] = Asked(terms, size)
    return _ASKED[name]


def index_shards(posts: DataFrame, shared, kind: str, k: int, block: int) -> DataFrame:
    """One row per shard: keys, postings by document, stored summaries, and the pilot's (item, score) pairs."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = asked_of(shared)
        most = max(64, CELLS // max(asked.size, 1))
        held: pa.Table | None = None

        def shard(rows: pa.Table, starts: np.ndarray) -> pa.RecordBatch:
            bounds = np.append(starts, rows.num_rows)
            terms, impacts = rows.column("tid").to_numpy(), rows.column("impact").to_numpy()
            made = Shard(bounds, terms, impacts, asked, block)
            pilots = [(item, int(score)) for item in range(len(asked.terms)) for score in made.pilot(item, k)]
            pack = pa.Codec("zstd").compress
            raw = made.stored()
            columns = [
                pa.array([rows.column("key").take(pa.array(starts)).to_pylist()], keys_type), pa.array([bounds.astype(np.int64).tobytes()], pa.binary()), pa.array([terms.astype(np.int32).tobytes()], pa.binary()),
                pa.array([impacts.astype(np.int64).tobytes()], pa.binary()), pa.array([len(raw)], pa.int64()), pa.array([pack(raw, asbytes=True)], pa.binary()),
                pa.array([[{"item": i, "score": s} for i, s in pilots]], pa.list_(pa.struct([("item", pa.int32()), ("score", pa.int64())]))),
            ]
            return pa.RecordBatch.from_arrays(columns, names=["keys", "bounds", "terms", "impacts", "size", "summaries", "pilot"])

        keys_type = None
        for batch in batches:
            part = pa.Table.from_batches([batch])
            keys_type = keys_type or pa.list_(part.schema.field("key").type)
            held = part if held is None else pa.concat_tables([held, part])
            while True:
                rows = held.column("row").to_numpy()
                starts = np.flatnonzero(np.diff(rows, prepend=-1))
                if len(starts) <= most:
                    break
                yield shard(held.slice(0, starts[most]).combine_chunks(), starts[:most])
                held = held.slice(starts[most])
        if held is not None and held.num_rows:
            yield shard(held.combine_chunks(), np.flatnonzero(np.diff(held.column("row").to_numpy(), prepend=-1)))

    return posts.mapInArrow(build, f"keys array<{kind}>, bounds binary, terms binary, impacts binary, size long, summaries binary, pilot array<struct<item: int, score: long>>")


def search_shards(index: DataFrame, shared, levels, kind: str, k: int, block: int) -> DataFrame:
    """(item, key, score): of every shard the k best documents of an item that reach its level."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = asked_of(shared)
        for batch in batches:
            for at in range(batch.num_rows):
                row = {name: batch.column(name)[at] for name in batch.schema.names}
                raw = pa.Codec("zstd").decompress(row["summaries"].as_py(), decompressed_size=row["size"].as_py(), asbytes=True)
                made = Shard(*(np.frombuffer(row[c].as_py(), dtype=d) for c, d in (("bounds", np.int64), ("terms", np.int32), ("impacts", np.int64))), asked, block, raw)
                keys = row["keys"].values
                place = np.empty(len(keys), dtype=np.int64)
                place[pc.array_sort_indices(keys, null_placement="at_end").to_numpy()] = np.arange(len(keys))
                items, docs, scores = [], [], []
                for item in range(len(asked.terms)):
                    found, score, _ = made.search(item, levels.value.get(item, 1))
                    best = np.lexsort((place[found], -score))[:k]
                    items.append(np.full(len(best), item, dtype=np.int32))
                    docs.append(found[best])
                    scores.append(score[best])
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(items)), keys.take(pa.array(np.concatenate(docs))), pa.array(np.concatenate(scores))], names=["item", "key", "score"])

    return index.select("keys", "bounds", "terms", "impacts", "size", "summaries").mapInArrow(search, f"item int, key {kind}, score long")


def ranked_search(
    docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text", k: int = 50, block: int = BLOCK, postings_per_task: int = POSTINGS
) -> DataFrame:
    """item, rank, key, score: of all documents the k with the highest score above 0 for each item.

    With N documents that have terms, L terms in them, df documents with a term, and tf of it in a document of n terms:
    w = floor(1000 * ln((2N + 2) / (2df + 1))), m = 50 + (50 * n * N) div L, and a document's impact for a term is w * ((10^9 * tf) div (1000 * tf + 20 * m)).
    A score sums the impacts of the item's different terms.

    1. Whole texts become (document, term, tf) rows; those of terms that some item asks for are kept, statistics cover all documents.
    2. Documents are ordered by a similarity code and dealt by ranges of it into shards of bounded size. In a shard each
       term's posting list is cut into blocks of `block` neighbours in that order. A block's summary is the maximum impact, over its documents, of every
       term that shares an item with the list's term: the sum over an item's terms bounds the score of each document in the block.
    3. A pilot scores the blocks with the highest bounds of each shard; the k-th best score of an item over all shards is a level that its result reaches.
    4. All blocks whose bound is below the level are skipped, and so are documents that are in such a block: their score cannot reach the level.
       The rest is scored exactly; per shard the k best leave the task.

    Items are the query set: they are handled in blocks of about 2^18 (item, term) rows, the only thing that is broadcast. Items with
    equal ids are one item with the terms of all of them; NULL ids likewise. NULL and empty texts have no terms and never appear. Repeated documents
    are ranked each for itself; equal scores go by key, NULL last. Other columns are ignored; empty tables have no result.
    """
    spark = docs.sparkSession
    kind, item_type = docs.schema[key].dataType.simpleString(), items.schema[item_key].dataType
    asked = items.select(F.col(item_key).alias("item"), F.explode(words_of(F.col(item_text))).alias("term")).distinct()
    asked = materialize(asked, "asked-terms")
    blocks = max(1, -(-asked.count() // ASKED))
    raw = postings(docs, key, text)
    out = []
    for number in range(blocks):
        rows = asked.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == number).collect()
        own: dict = {}
        for item, term in rows:
            own.setdefault(item, set()).add(term)
        names, vocabulary = list(own), sorted({term for _, term in rows})
        of = {t: i for i, t in enumerate(vocabulary)}
        shared = spark.sparkContext.broadcast((uuid.uuid4().hex, [np.array(sorted(of[t] for t in own[name]), dtype=np.int64) for name in names], len(vocabulary)))
        terms = spark.createDataFrame(list(of.items()), "term string, tid int")
        met = materialize(join_small(raw, terms, "term", "left").where("term IS NULL OR tid IS NOT NULL").drop("term"), "asked-postings")
        total, words = met.where("tid IS NULL").agg(F.count(F.lit(1)), F.sum("n")).first()
        weights = materialize(met.where("tid IS NOT NULL").groupBy("tid").agg(F.floor(F.log(F.lit(2 * total + 2).cast("double") / (F.count(F.lit(1)) * 2 + 1)) * 1000.0).alias("w"), F.count(F.lit(1)).alias("df")), "term-weights")
        found = weights.agg(F.sum("df")).first()[0] or 0
        scored = join_small(met.where("tid IS NOT NULL"), weights.where("w > 0").drop("df"), "tid")
        scored = scored.withColumn("impact", F.expr(f"w * ((1000000000 * tf) div (1000 * tf + 20 * (50 + (50 * n * {total}L) div {words or 1}L)))")).where("impact > 0")
        dealt = scored.select("row", "key", "code", "tid", "impact").repartitionByRange(max(1, -(-found // postings_per_task)), "code", "row").sortWithinPartitions("code", "row")
        index = materialize(index_shards(dealt.select("row", "key", "tid", "impact"), shared, kind, k, block), "lexical-index")
        pilot = top_n(index.select(F.explode("pilot").alias("p")).select("p.item", "p.score"), ["item"], [F.desc("score")], k)
        levels = spark.sparkContext.broadcast({r["item"]: r["score"] for r in pilot.where(F.col("rank_no") == k).collect()})
        hits = search_shards(index, shared, levels, kind, k, block)
        known = spark.createDataFrame([(i, name) for i, name in enumerate(names)], T.StructType([T.StructField("item", T.IntegerType()), T.StructField("name", item_type)]))
        best = top_n(hits, ["item"], [F.desc("score"), F.asc_nulls_last("key")], k, "rank")
        out.append(best.join(F.broadcast(known), "item").select(F.col("name").alias(item_key), F.col("rank").cast("int").alias("rank"), F.col("key").alias(key), "score"))
    result = out[0]
    for part in out[1:]:
        result = result.unionAll(part)
    return result
