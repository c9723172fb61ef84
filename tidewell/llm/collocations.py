"""Phrase collocations: prefix-free parsing of all texts into a dictionary of chunks, n-grams counted once per distinct chunk."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import join_small, materialize
from tidewell.llm.words import BASE, mix, segment_names
from tidewell.operators.ranking import top_n

#: Characters that end a piece, and the blanks between words.
ENDS, BLANKS = b".,;:!?\n\x0b\x0c\r", b" \t"
_TO = bytes(10 if c in ENDS else 32 if c in BLANKS else c + 32 if 65 <= c <= 90 else c for c in range(256))
#: Bytes of text parsed and words counted at a time: bounds the memory of a task, not what it covers.
PARSED, COUNTED = 2_000_000, 700_000
#: Bits of the filter that is broadcast between two lengths, and bytes of the slices it is put together from.
BITS, SLICE = 1 << 26, 1 << 16
#: A language's candidates are ranked in so many shares first, so that its last task gets SHARES * top rows at most.
SHARES = 16
UNKNOWN = "und"


def parse(texts: list[bytes], overlap: int, modulus: int) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """(chunks, last, owner): chunks of whole texts, whether a chunk ends its piece, and the number of its text.

    A run of `overlap` words whose hash is 0 modulo `modulus` ends a chunk, and the next one begins with the same run: what is cut depends
    on the words alone, so equal passages give equal chunks wherever they stand. Chunks never leave their piece.
    """
    data = b"\n".join(t.translate(_TO) for t in texts)
    view = np.frombuffer(data, dtype=np.uint8)
    line = view == 10
    edges = np.flatnonzero(np.diff((line | (view == 32)).view(np.int8), prepend=1, append=1))
    starts, ends = edges[0::2], edges[1::2]
    if not len(starts):
        return [], np.zeros(0, dtype=bool), np.zeros(0, dtype=np.int64)
    lines = np.cumsum(line)
    piece = lines[starts]  # words of one piece have the same number of line ends before them
    names = segment_names(view)
    first = np.concatenate(([True], piece[1:] != piece[:-1]))
    runs = max(0, len(names) - overlap)
    total = np.zeros(runs, dtype=np.uint64)
    for step in range(overlap):
        total = total * np.uint64(BASE) + names[step : step + runs]
    begins = first.copy()
    begins[:runs] |= (mix(total) % np.uint64(modulus) == 0) & (piece[:runs] == piece[overlap : overlap + runs])
    at = np.flatnonzero(begins)
    after = np.append(at[1:], len(names))
    last = np.append(first[at[1:]], True)
    stop = ends[after + np.where(last, 0, overlap) - 1]
    sizes = np.cumsum([0] + [len(t) + 1 for t in texts])
    return [data[a:b] for a, b in zip(starts[at].tolist(), stop.tolist())], last, np.searchsorted(sizes, starts[at], side="right") - 1


def chunk_dictionary(docs: DataFrame, text: str, lang: str, overlap: int, modulus: int) -> DataFrame:
    """(lang, chunk, last, n): the distinct chunks of a language and how often the parse has them."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bodies, at = [(b or "").encode() for b in batch.column(1).to_pylist()], 0
            while at < len(bodies):
                end, held = at, 0
                while end < len(bodies) and (held == 0 or held + len(bodies[end]) <= PARSED):
                    held += len(bodies[end])
                    end += 1
                chunks, last, owner = parse(bodies[at:end], overlap, modulus)
                langs = batch.column(0).slice(at, end - at).take(pa.array(owner))
                yield pa.RecordBatch.from_arrays([langs, pa.array(chunks, pa.binary()).cast(pa.string()), pa.array(last)], names=["lang", "chunk", "last"])
                at = end

    rows = docs.select(F.coalesce(F.col(lang), F.lit(UNKNOWN)).alias("lang"), F.col(text).alias("text"))
    parsed = rows.mapInArrow(cut, "lang string, chunk string, last boolean")
    return parsed.groupBy("lang", "chunk", "last").agg(F.count(F.lit(1)).alias("n"))


def language_names(langs: list[str]) -> np.ndarray:
    return np.array([int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest(), "little") for x in langs], dtype=np.uint64)


def phrase_places(seed: np.ndarray, words: list[np.ndarray]) -> np.ndarray:
    """Places of phrases in the filter: of the language and the words, the same in every task."""
    total = seed
    for names in words:
        total = total * np.uint64(BASE) + names
    return mix(total) & np.uint64(BITS - 1)


def count_grams(langs: pa.Array, chunks: list[bytes], last: np.ndarray, times: np.ndarray, size: int, overlap: int, known: np.ndarray | None) -> pa.Table:
    """(lang, phrase, n) of the n-grams of `size` words in distinct chunks, each chunk weighted by how often it occurs.

    The last `overlap` words of a chunk that goes on begin the next chunk: n-grams that start there are counted there, so once.
    `known` is the filter of frequent phrases of one word less: an n-gram whose first or last words are not in it is left out.
    """
    nested = [c.split() for c in chunks]
    sizes = np.fromiter(map(len, nested), np.int64, len(nested))
    coded = pa.array(chain.from_iterable(nested), pa.binary()).dictionary_encode()
    codes, vocabulary = coded.indices.to_numpy().astype(np.int64), coded.dictionary
    spoken = langs.dictionary_encode()
    of_chunk = spoken.indices.to_numpy().astype(np.int64)
    chunk = np.repeat(np.arange(len(sizes)), sizes)
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(codes))  # words from here to the end of the chunk
    at = np.flatnonzero((left >= size) & (last[chunk] | (left > overlap)))
    if known is not None and len(at):
        names = segment_names(np.frombuffer(b"\n".join(vocabulary.to_pylist()), dtype=np.uint8))[codes]
        seed = language_names(spoken.dictionary.to_pylist())[of_chunk[chunk[at]]]
        for shift in (0, 1):
            places = phrase_places(seed, [names[at + shift + k] for k in range(size - 1)])
            found = (known[(places >> np.uint64(3)).astype(np.int64)] >> (places & np.uint64(7)).astype(np.uint8)) & 1 == 1
            at, seed = at[found], seed[found]
    key = of_chunk[chunk[at]]
    for step in range(size):  # distinct (words so far, next word), renumbered so that numbers stay small
        key = np.unique(key, return_inverse=True)[1] * len(vocabulary) + codes[at + step]
    _, where, same = np.unique(key, return_index=True, return_inverse=True)
    n = np.zeros(len(where), dtype=np.int64)
    np.add.at(n, same, times[chunk[at]])
    sample = at[where]
    parts = [vocabulary.take(pa.array(codes[sample + step])).cast(pa.string()) for step in range(size)]
    phrases = pc.binary_join_element_wise(*parts, " ") if size > 1 else parts[0]
    out = [spoken.dictionary.take(pa.array(of_chunk[chunk[sample]])), phrases, pa.array(n)]
    if size == 1:  # the number of all words of a language stands beside its words, under the empty phrase
        totals = np.zeros(len(spoken.dictionary), dtype=np.int64)
        np.add.at(totals, of_chunk[chunk[at]], times[chunk[at]])
        out = [pa.concat_arrays([a.combine_chunks() if isinstance(a, pa.ChunkedArray) else a, b]) for a, b in zip(out, [spoken.dictionary, pa.array([""] * len(totals)), pa.array(totals)])]
    return pa.Table.from_arrays(out, names=["lang", "phrase", "n"])


def frequent(chunks: DataFrame, size: int, overlap: int, least: int, known) -> DataFrame:
    """(lang, phrase, n): n-grams of `size` words that occur `least` times or more; the empty phrase holds all words of a language."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = None if known is None else np.frombuffer(known.value, dtype=np.uint8)
        held, words = [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            whole = pa.Table.from_batches(held).combine_chunks()
            body = whole.column("chunk").cast(pa.binary()).to_pylist()
            yield from count_grams(whole.column("lang").combine_chunks(), body, whole.column("last").to_numpy(), whole.column("n").to_numpy(), size, overlap, bits).to_batches()

        for batch in batches:
            for at in range(0, batch.num_rows, 65_536):
                held.append(batch.slice(at, 65_536))
                words += pc.sum(pc.count_substring(held[-1].column(1), " ")).as_py() + held[-1].num_rows
                if words >= COUNTED:
                    yield from flush()
                    held, words = [], 0
        if held:
            yield from flush()

    counted = chunks.select("lang", "chunk", "last", "n").mapInArrow(count, "lang string, phrase string, n long")
    total = counted.groupBy("lang", "phrase").agg(F.sum("n").alias("n"))
    return total.where((F.col("n") >= least) | (F.col("phrase") == ""))


def phrase_filter(found: DataFrame, size: int):
    """A broadcast bitmap with the places of all given phrases: of fixed size, whatever their number. It never lacks one."""

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(BITS // 8, dtype=np.uint8)
        for batch in batches:
            if batch.num_rows:
                spoken = batch.column(0).dictionary_encode()
                seed = language_names(spoken.dictionary.to_pylist())[spoken.indices.to_numpy()]
                names = segment_names(np.frombuffer("\n".join(batch.column(1).to_pylist()).encode(), dtype=np.uint8)).reshape(-1, size)
                places = phrase_places(seed, list(names.T))
                np.bitwise_or.at(bits, (places >> np.uint64(3)).astype(np.int64), np.left_shift(np.uint8(1), (places & np.uint64(7)).astype(np.uint8)))
        slices = bits.reshape(-1, SLICE)
        used = np.flatnonzero(slices.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array([slices[u].tobytes() for u in used], pa.binary())], names=["slice", "bits"])

    def unite(rows: pa.Table) -> pa.Table:
        whole = np.bitwise_or.reduce([np.frombuffer(b, dtype=np.uint8) for b in rows.column("bits").to_pylist()])
        return pa.table({"slice": rows.column("slice").slice(0, 1), "bits": pa.array([whole.tobytes()], pa.binary())})

    kind = "slice int, bits binary"
    marked = found.where(F.col("phrase") != "").select("lang", "phrase").mapInArrow(mark, kind).groupBy("slice").applyInArrow(unite, kind)
    out = bytearray(BITS // 8)
    for row in marked.collect():  # BITS / 8 bytes at most
        out[row["slice"] * SLICE : (row["slice"] + 1) * SLICE] = row["bits"]
    return found.sparkSession.sparkContext.broadcast(bytes(out))


def score() -> Column:
    """floor(1000000 * a * a / (l * r)), exact for counts below 10^15."""
    a, l, r = (f"cast({c} as decimal(15,0))" for c in "alr")
    return F.expr(f"(cast(1000000 as decimal(7,0)) * ({a} * {a})) div ({l} * {r})").cast("long")


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", longest: int = 3, least: int = 10, covered: int = 50, top: int = 2_000, modulus: int = 6) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the best phrases of 2 to `longest` words of each language.

    1. Texts, A-Z lower-cased, are cut into pieces and these into overlapping chunks (`parse`); the dictionary of distinct chunks with their
       parse frequencies is written once.
    2. For each length the n-grams of the distinct chunks are counted, weighted by frequency; n-grams inside an overlap belong to
       the later chunk. A phrase is only as frequent as its parts, so those whose parts of one word less are rare are left out early: by a
       bitmap of fixed size, which may let rare ones pass (they fall by their own count) but never loses a frequent one.
    3. Each candidate is cut after each word; the lowest floor(1000000*a*a/(l*r)) counts, ties to the first cut. Decimals of 38 digits are exact as
       long as a language has fewer than 10^15 words.
    4. A candidate goes when a longer one that contains its words has 100 * a(longer) >= `covered` * a. Each longer candidate names its parts with
       its own count, and the maximum per part is taken: links, not pairs. The best `top` stay, ranked by score, a (both falling) and phrase.

    Phrases are in UTF-8 byte order. NULL text is empty; NULL lang is `und`, together with that name. Repeated documents count again. Languages
    without candidates have no rows, as has an empty table. Other columns are ignored.
    """
    overlap = longest - 1
    chunks = materialize(chunk_dictionary(docs, text, lang, overlap, modulus), "chunks")
    levels, known = [], None
    for size in range(1, longest + 1):
        found = materialize(frequent(chunks, size, overlap, least, known), "frequent-phrases")
        levels.append(found.withColumn("size", F.lit(size)))
        known = phrase_filter(found, size) if size < longest else None
    every = levels[0]
    for level in levels[1:]:
        every = every.unionAll(level)
    totals = every.where("phrase = ''").select("lang", F.col("n").alias("total"))
    parts = every.where("phrase <> ''").select("lang", "phrase", "n")
    words = F.split("phrase", " ")
    candidates = every.where("size > 1").select("lang", "phrase", "size", F.col("n").alias("a"), words.alias("w"))

    def joined(start, length):
        return F.array_join(F.slice("w", start, length), " ")

    cuts = candidates.select("lang", "phrase", "size", "a", "w", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "size", "a", "k", joined(F.lit(1), F.col("k")).alias("head"), joined(F.col("k") + 1, F.col("size") - F.col("k")).alias("tail"))
    for part, name in (("head", "l"), ("tail", "r")):
        cuts = cuts.join(parts.select("lang", F.col("phrase").alias(part), F.col("n").alias(name)), ["lang", part])
    best = cuts.withColumn("score", score()).groupBy("lang", "phrase", "size", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    inner = candidates.where("size > 2").select("lang", "a", "w", "size", F.explode(F.sequence(F.lit(2), F.col("size") - 1)).alias("length"))
    inner = inner.select("lang", "a", "w", "length", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("length") + 1)).alias("start"))
    inner = inner.select("lang", joined(F.col("start"), F.col("length")).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    free = best.join(inner, ["lang", "phrase"], "left").where(F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * covered))
    flat = free.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    dealt = top_n(flat.withColumn("share", F.pmod(F.xxhash64("phrase"), F.lit(SHARES))), ["lang", "share"], order, top, "rank")
    ranked = top_n(dealt.drop("rank", "share"), ["lang"], order, top, "rank")
    return join_small(ranked, totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", F.col("total").alias("n"), "score")
