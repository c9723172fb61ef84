"""Repeated passages by recompression: runs and pairs of words get the same names everywhere, shared names find repeats."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import materialize
from tidewell.llm.words import BASE, mix, powers, word_names

#: Bytes of text in a block, and words of all blocks for each exchange bucket.
BLOCK_BYTES = 4_000_000
BUCKET_WORDS = 2_000_000
#: The smallest number stands for a NULL key: such documents come first.
NO_KEY = -(2**63)
U = np.uint64


def range_names(words: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Names of word ranges [start, end), equal for equal words at any place."""
    up, down = powers(len(words) + 1)
    sums = np.zeros(len(words) + 1, dtype=np.uint64)
    np.cumsum(words * up[: len(words)], dtype=np.uint64, out=sums[1:])
    return mix(((sums[ends] - sums[starts]) * down[starts]) ^ (ends - starts).astype(np.uint64))


def recompress(words: np.ndarray, bounds: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """(lo, hi) of the symbols after some rounds: the words that alone decide a symbol and where it stands.

    A round names maximal runs of equal symbols, then pairs of neighbours whose first is of the left and whose second
    is of the right class; classes are bits of the symbol's name, so pairs never overlap and every copy of a passage is
    parsed alike, but for the symbols at its rim. lo and hi track that rim exactly: a run needs to see that its neighbours differ, a single left
    symbol that no right one follows, a single right symbol that no left one precedes. Rims that touch the end of a
    text reach beyond it. Both are non-decreasing.
    """
    n = len(words)
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    below, above = bounds[:-1] - 1, bounds[1:] + 1
    names, lo, hi = words, np.arange(n), np.arange(1, n + 1)
    for turn in range(rounds):
        # runs
        new = np.ones(len(names), dtype=bool)
        new[1:] = (names[1:] != names[:-1]) | (owner[1:] != owner[:-1])
        at = np.flatnonzero(new)
        after = np.append(at[1:], len(names))
        size = after - at
        first = np.ones(len(at), dtype=bool)
        first[1:] = owner[at[1:]] != owner[at[:-1]]
        last = np.append(first[1:], True)
        who = owner[at]
        run_lo = np.where(first, below[who], lo[np.maximum(at - 1, 0)])
        run_hi = np.where(last, above[who], hi[np.minimum(after, len(names) - 1)])
        names = np.where(size > 1, mix(names[at] * U(BASE) + size.astype(np.uint64)), names[at])
        owner, lo, hi = who, run_lo, run_hi
        # pairs
        left = (mix(names + U(2 * turn + 1)) >> U(63)).astype(bool)
        same = np.zeros(len(names), dtype=bool)  # the next symbol is of the same text
        same[:-1] = owner[1:] == owner[:-1]
        right_next = np.zeros(len(names), dtype=bool)
        right_next[:-1] = ~left[1:]
        head = left & right_next & same
        second = np.zeros(len(names), dtype=bool)
        second[1:] = head[:-1]
        previous_same = np.zeros(len(names), dtype=bool)
        previous_same[1:] = same[:-1]
        following_hi = np.append(hi[1:], 0)
        previous_lo = np.append([0], lo[:-1])
        pair_lo = np.where(left, lo, np.where(previous_same, previous_lo, below[owner]))
        pair_hi = np.where(left, np.where(same, following_hi, above[owner]), hi)
        joined = mix(mix(names) * U(BASE) + np.append(names[1:], U(0)) + U(turn))
        stay = ~second
        names, owner, lo, hi = np.where(head, joined, names)[stay], owner[stay], pair_lo[stay], pair_hi[stay]
    return lo, hi


def least_in_ranges(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The least value of each non-empty range, by tables of power-of-two ranges."""
    size = ends - starts
    level = np.frexp(size.astype(np.float64))[1] - 1
    out = np.empty(len(starts), dtype=np.uint64)
    table = values
    for k in range(int(level.max(initial=-1)) + 1):
        if k:
            half = 1 << (k - 1)
            table = np.minimum(table[:-half], table[half:]) if len(table) > half else table
        at = level == k
        out[at] = np.minimum(table[starts[at]], table[ends[at] - (1 << k)])
    return out


def window_starts(bounds: np.ndarray, window: int) -> np.ndarray:
    """First words of all windows, in order."""
    count = np.maximum(np.diff(bounds) - window + 1, 0)
    shift = np.repeat(bounds[:-1] - np.concatenate(([0], np.cumsum(count)[:-1])), count)
    return np.arange(count.sum()) + shift


def anchors(words: np.ndarray, bounds: np.ndarray, window: int, rounds: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(window starts, anchor of each window, anchors that occur more than once here).

    The anchor of a window is the least name among its interior symbols, those decided by words of the window alone; the
    name covers all those words. Equal windows have equal anchors at equal places. A window without an interior symbol, as inside
    a long run, is its own anchor.
    """
    starts = window_starts(bounds, window)
    if not len(starts):
        return starts, np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.uint64)
    lo, hi = recompress(words, bounds, rounds)
    inside = (lo >= 0) & (hi <= len(words))
    keys = np.full(len(lo), 2**64 - 1, dtype=np.uint64)
    keys[inside] = range_names(words, lo[inside], hi[inside])
    first, beyond = np.searchsorted(lo, starts, "left"), np.searchsorted(hi, starts + window, "right")
    own = range_names(words, starts, starts + window)
    some = beyond > first
    chosen = own.copy()
    chosen[some] = least_in_ranges(keys, first[some], beyond[some])
    every = np.sort(np.concatenate((keys[inside], own[~some])))
    return starts, chosen, np.unique(every[1:][every[1:] == every[:-1]])


def packed(array: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(array).tobytes())


def unpacked(blob: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), dtype=kind)


def texts_of(blob: bytes, sizes: list[int]) -> list[bytes]:
    data = zstandard.ZstdDecompressor().decompress(blob)
    ends = np.cumsum(sizes)
    return [data[e - s : e] for s, e in zip(sizes, ends)]


def within(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    if not len(ordered):
        return np.zeros(len(values), dtype=bool)
    return ordered[np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)] == values


def pack_blocks(docs: DataFrame) -> DataFrame:
    """(block, keys, sizes, words, data): texts of a few megabytes in the order of their keys, compressed together."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece, held, size, number = TaskContext.get().partitionId(), [], 0, 0

        def block() -> pa.RecordBatch:
            held.sort(key=lambda row: row[0])
            texts = [t for _, t in held]
            data = zstandard.ZstdCompressor(level=3).compress(b"".join(texts))
            columns = {"block": [(piece << 32) + number], "keys": [[k for k, _ in held]], "sizes": [[len(t) for t in texts]], "words": [sum(len(t.split()) for t in texts)], "data": [data]}
            return pa.RecordBatch.from_pydict(columns, schema=BLOCK)

        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                held.append((NO_KEY if key is None else key, (text or "").encode()))
                size += len(held[-1][1]) + 16
                if size >= BLOCK_BYTES:
                    yield block()
                    held, size, number = [], 0, number + 1
        if held:
            yield block()

    return docs.mapInArrow(pack, "block bigint, keys array<bigint>, sizes array<int>, words bigint, data binary")


BLOCK = pa.schema([("block", pa.int64()), ("keys", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int32())), ("words", pa.int64()), ("data", pa.binary())])


def in_buckets(names: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """(bucket, places in their order) of names dealt by their value."""
    bucket = (names % U(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    edges = np.searchsorted(bucket[order], np.arange(buckets + 1))
    for b in range(buckets):
        if edges[b + 1] > edges[b]:
            yield b, order[edges[b] : edges[b + 1]]


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = 20, rounds: int = 2) -> DataFrame:
    """One row per row: key, n_words, n_removed, kept (the remaining words, joined by one blank).

    A word goes when it is covered by a window of `window` words whose sequence also starts earlier: in a document with a
    smaller key, or earlier in the same one. Windows are judged on the input.

    1. Texts are packed into blocks, written once. Each block recompresses its words; names are keyed hashes of what they
       stand for, so they agree on all machines without an exchange per round.
    2. The distinct anchors of each block are exchanged: those of a single place in the whole corpus are dropped with all their windows.
    3. Windows with shared anchors send their 96-bit names, once per block with the first key, to find the first
       block of each; the other blocks get back what starts earlier elsewhere.
    4. Blocks mark the words of such windows, and of those repeated within the block, and write what is left.
    Exchanges carry arrays per block and bucket, combined within the block first: a passage in every document sends one entry per
    block, and no task holds more than its bucket. The number of buckets follows the number of words.

    `key` is an integer column; NULL keys come first, rows with the same key are ordered by block and place. NULL and empty
    texts have no words. Other columns are ignored; an empty table gives an empty result.
    """
    kind = docs.schema[key].dataType.simpleString()
    base = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("body"))
    blocks = materialize(pack_blocks(base), "text-blocks")
    total = blocks.agg(F.sum("words")).first()[0] or 0
    buckets = max(1, -(-total // BUCKET_WORDS))

    def block_words(sizes: list[int], data: bytes) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        texts = texts_of(data, sizes)
        return texts, *word_names(texts)

    def send_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                _, words, bounds = block_words(row["sizes"], row["data"])
                _, chosen, repeated = anchors(words, bounds, window, rounds)
                distinct = np.unique(chosen)
                often = within(distinct, repeated)
                out = [(b, row["block"], packed(distinct[at]), packed(often[at])) for b, at in in_buckets(distinct, buckets)]
                yield pa.RecordBatch.from_pylist([dict(zip(("bucket", "block", "names", "flags"), r)) for r in out], schema=pa.schema([("bucket", pa.int32()), ("block", pa.int64()), ("names", pa.binary()), ("flags", pa.binary())]))

    def share_anchors(rows: pa.Table) -> pa.Table:
        names = [unpacked(b, "<u8") for b in rows.column("names").to_pylist()]
        flat = np.concatenate(names)
        flags = np.concatenate([unpacked(b, "?") for b in rows.column("flags").to_pylist()])
        ordered = np.sort(np.concatenate((flat, flat[flags])))
        shared = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
        mine = [n[within(n, shared)] for n in names]
        blocks = rows.column("block").to_pylist()
        return pa.table({"block": pa.array([b for b, m in zip(blocks, mine) if len(m)], pa.int64()), "names": pa.array([packed(m) for m in mine if len(m)], pa.binary())})

    def send_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                _, words, bounds = block_words(row["sizes"], row["data"])
                starts, chosen, _ = anchors(words, bounds, window, rounds)
                shared = np.sort(np.concatenate([unpacked(b, "<u8") for b in row["blobs"]]))
                starts = starts[within(chosen, shared)]
                names, checks = window_names(words, starts, window)
                _, first = np.unique(names, return_index=True)
                first.sort()
                owner = np.asarray(row["keys"], dtype=np.int64)[np.searchsorted(bounds, starts[first], "right") - 1]
                names, checks = names[first], checks[first]
                out = [(b, row["block"], packed(names[at]), packed(checks[at]), packed(owner[at])) for b, at in in_buckets(names, buckets)]
                yield pa.RecordBatch.from_pylist([dict(zip(("bucket", "block", "names", "checks", "keys"), r)) for r in out], schema=WINDOWS)

    def find_first(rows: pa.Table) -> pa.Table:
        blocks = rows.column("block").to_pylist()
        names = [unpacked(b, "<u8") for b in rows.column("names").to_pylist()]
        sizes = [len(n) for n in names]
        flat, checks = np.concatenate(names), np.concatenate([unpacked(b, "<u4") for b in rows.column("checks").to_pylist()])
        keys = np.concatenate([unpacked(b, "<i8") for b in rows.column("keys").to_pylist()])
        row_of = np.repeat(np.arange(len(blocks)), sizes)
        order = np.lexsort((np.asarray(blocks, dtype=np.int64)[row_of], keys, checks, flat))
        later = np.zeros(len(flat), dtype=bool)
        later[order[1:]] = (flat[order[1:]] == flat[order[:-1]]) & (checks[order[1:]] == checks[order[:-1]])
        out = []
        for n, end in enumerate(np.cumsum(sizes)):
            at = np.flatnonzero(later[end - sizes[n] : end]) + end - sizes[n]
            if len(at):
                out.append({"block": blocks[n], "names": packed(flat[at]), "checks": packed(checks[at])})
        return pa.Table.from_pylist(out, schema=pa.schema([("block", pa.int64()), ("names", pa.binary()), ("checks", pa.binary())]))

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                texts, words, bounds = block_words(row["sizes"], row["data"])
                starts = window_starts(bounds, window)
                names, checks = window_names(words, starts, window)
                order = np.argsort(names, kind="stable")
                gone = np.zeros(len(names), dtype=bool)
                gone[order[1:]] = names[order[1:]] == names[order[:-1]]
                if row["blobs"]:
                    known = np.concatenate([unpacked(b["names"], "<u8") for b in row["blobs"]])
                    marks = np.concatenate([unpacked(b["checks"], "<u4") for b in row["blobs"]])
                    ranked = np.argsort(known)
                    at = np.minimum(np.searchsorted(known[ranked], names), len(known) - 1)
                    gone |= (known[ranked][at] == names) & (marks[ranked][at] == checks)
                edge = np.zeros(len(words) + 1, dtype=np.int64)
                np.add.at(edge, starts[gone], 1)
                np.add.at(edge, starts[gone] + window, -1)
                stay = np.cumsum(edge[:-1]) == 0
                kept, removed = [], []
                for text, a, b in zip(texts, bounds, bounds[1:]):
                    mask = stay[a:b]
                    removed.append(int(b - a - mask.sum()))
                    kept.append((b" ".join(compress(text.split(), mask.tolist())) if removed[-1] else b" ".join(text.split())).decode())
                keys = [None if k == NO_KEY else k for k in row["keys"]]
                columns = [pa.array(keys, pa.int64()), pa.array(np.diff(bounds)), pa.array(removed, pa.int64()), pa.array(kept, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=["key", "n_words", "n_removed", "kept"])

    sent = blocks.select("block", "sizes", "data").mapInArrow(send_anchors, "bucket int, block bigint, names binary, flags binary")
    shared = sent.groupBy("bucket").applyInArrow(share_anchors, "block bigint, names binary")
    listed = shared.groupBy("block").agg(F.collect_list("names").alias("blobs"))
    windows = blocks.select("block", "keys", "sizes", "data").join(listed, "block").mapInArrow(send_windows, "bucket int, block bigint, names binary, checks binary, keys binary")
    later = windows.groupBy("bucket").applyInArrow(find_first, "block bigint, names binary, checks binary")
    earlier = later.groupBy("block").agg(F.collect_list(F.struct("names", "checks")).alias("blobs"))
    out = blocks.select("block", "keys", "sizes", "data").join(earlier, "block", "left").mapInArrow(finish, "key bigint, n_words bigint, n_removed bigint, kept string")
    return out.select(F.col("key").cast(kind).alias(key), "n_words", "n_removed", "kept")


WINDOWS = pa.schema([("bucket", pa.int32()), ("block", pa.int64()), ("names", pa.binary()), ("checks", pa.binary()), ("keys", pa.binary())])


def window_names(words: np.ndarray, starts: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """64 bits and another 32 bits of each window."""
    names = range_names(words, starts, starts + window)
    return names, (range_names(mix(words + U(1)), starts, starts + window) >> U(32)).astype(np.uint32)
