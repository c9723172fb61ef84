"""Token sequences in training order: a keyed permutation gives every sequence its slot, ranges of slots are shards."""

from __future__ import annotations

import base64
import hashlib
import posixpath
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm.common import materialize
from tidewell.session import scratch_path

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: how the public vocabulary splits a text before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: The pattern's white space, and a place where it ends a token whatever follows.
WHITE = r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
CUT = re.compile(r"(?<=\S)[ \t\n\r]")
RUN = re.compile(f"{WHITE}{{2}}")
#: White space of one byte, by byte; and the rest of it.
NARROW = np.isin(np.arange(256), [*range(9, 14), 32])
WIDE = "\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
#: A special token that no call asks for: with one, the tokenizer hands ids on as bytes, without looking at every character for specials.
UNUSED = "\0\0\0 unused \0\0\0"
END = 50_256
ROUNDS = 6
#: Most partitions that shards are written from; each writes a range of shards.
PARTITIONS = 20_000
_ENCODERS: dict[tuple[str, str], object] = {}


def encoder(vocabulary: str, pattern: str = PATTERN):
    """The tokenizer of a rank file, read once per process; no special token is ever asked for, so any text is ordinary text."""
    if (vocabulary, pattern) not in _ENCODERS:
        import tiktoken

        with open(vocabulary, "rb") as file:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
        _ENCODERS[vocabulary, pattern] = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={UNUSED: max(ranks.values()) + 1})
    return _ENCODERS[vocabulary, pattern]


def holds_run(text: str) -> bool:
    """Whether two characters of white space stand in a row. The pattern is only asked where there is wide white space: it is slow."""
    white = NARROW[np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)]
    return bool((white[1:] & white[:-1]).any()) or (any(c in text for c in WIDE) and RUN.search(text) is not None)


def ordinary(tokenizer, text: str) -> bytes:
    try:
        return bytes(tokenizer._core_bpe.encode_to_tiktoken_buffer(text, set()))
    except UnicodeEncodeError:  # a lone surrogate, which the library replaces
        return np.array(tokenizer.encode_ordinary(text), dtype=np.uint32).tobytes()


def token_ids(text: str, vocabulary: str, most: int = 200_000) -> list[int]:
    return np.frombuffer(packed_ids(text, vocabulary, most), dtype=np.uint32).tolist()


def packed_ids(text: str, vocabulary: str, most: int = 200_000) -> bytes:
    """Ids of a whole text, 4 bytes each. Longer texts are encoded in pieces that end where the split pattern ends a token whatever follows: before
    white space after other text, so the ids are those of the text in one piece. A piece without such a place is as long as it must be.

    Runs of `most` white space characters or more overflow the tokenizer's pattern: the pattern makes one token of all but the last
    of a run (of all at the end of the text), which is encoded directly.

    The pattern looks ahead only to leave the last character of a run of white space to what follows. Texts without two white space characters
    in a row are split alike without that, and faster.
    """
    tokenizer = encoder(vocabulary) if holds_run(text) else encoder(vocabulary, PATTERN.replace(r"\s+(?!\S)|", ""))
    if len(text) <= most:
        return ordinary(tokenizer, text)
    ids: list[bytes] = []
    at = 0
    for run in re.finditer(f"{WHITE}{{{most},}}", text):
        ids.append(pieces_ids(tokenizer, text[at : run.start()], most))
        at = run.end() if run.end() == len(text) else run.end() - 1
        if at > run.start():
            ids.append(np.array(tokenizer._encode_single_piece(text[run.start() : at]), dtype=np.uint32).tobytes())
    return b"".join([*ids, pieces_ids(tokenizer, text[at:], most)])


def pieces_ids(tokenizer, text: str, most: int) -> bytes:
    ids: list[bytes] = []
    at = 0
    while at < len(text):
        cut = CUT.search(text, at + most)
        end = cut.start() if cut else len(text)
        ids.append(ordinary(tokenizer, text[at:end]))
        at = end
    return b"".join(ids)


def half_bits(total: int) -> int:
    """Bits of each half: the smallest domain of two equal halves that holds `total` numbers."""
    return max(1, (max(total - 1, 1).bit_length() + 1) // 2)


def round_value(half: np.ndarray, turn: int, key: int) -> np.ndarray:
    """A keyed 64-bit mix of a half, for one round."""
    x = half ^ np.uint64((key * 0x9E3779B97F4A7C15 + turn * 0xD1B54A32D192ED03) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def feistel(values: np.ndarray, total: int, key: int, inverse: bool = False) -> np.ndarray:
    """One pass of the keyed Feistel network over the whole domain, forwards or backwards."""
    bits = np.uint64(half_bits(total))
    mask = (np.uint64(1) << bits) - np.uint64(1)
    left, right = values >> bits, values & mask
    if inverse:
        for turn in reversed(range(ROUNDS)):
            left, right = right ^ (round_value(left, turn, key) & mask), left
    else:
        for turn in range(ROUNDS):
            left, right = right, left ^ (round_value(right, turn, key) & mask)
    return (left << bits) | right


def permute(values: np.ndarray, total: int, key: int, inverse: bool = False) -> np.ndarray:
    """The permutation of 0..total-1 (or its inverse): results beyond the range walk on along their cycle until they are
    inside. The domain is less than four times the range, so a walk takes a few steps; it always ends, as cycles do."""
    out = feistel(values.astype(np.uint64), total, key, inverse)
    outside = np.flatnonzero(out >= total)
    while len(outside):
        out[outside] = feistel(out[outside], total, key, inverse)
        outside = outside[out[outside] >= total]
    return out


def fixed_texts(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, body) whose partitions hold the same rows in the same order whenever they are read: files are, anything that was shuffled is written first."""
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("body"))
    steps = re.findall(r"^[\s:+\-|*()0-9]*([A-Za-z]+)", rows._jdf.queryExecution().executedPlan().toString(), re.M)
    return rows if set(steps) <= {"Project", "Filter", "ColumnarToRow", "FileScan", "LocalTableScan"} else materialize(rows, "texts")


def count_sequences(rows: DataFrame, length: int, vocabulary: str) -> tuple[dict[int, tuple[int, int]], int]:
    """({partition: (number of its first sequence, count)}, total): one pair per input partition."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece, n = TaskContext.get().partitionId(), 0
        for batch in batches:
            n += sum(-(-(len(packed_ids(body, vocabulary)) // 4 + 1) // length) for body in batch.column(0).to_pylist() if body)
        yield pa.RecordBatch.from_pydict({"piece": pa.array([piece], pa.int32()), "n": pa.array([n], pa.int64())})

    first, total = {}, 0
    for piece, n in sorted(map(tuple, rows.select("body").mapInArrow(count, "piece int, n long").collect())):
        first[piece] = (total, n)
        total += n
    return first, total


def place_sequences(docs: DataFrame, key: str, text: str, length: int, per_shard: int, seed: int, vocabulary: str) -> tuple[DataFrame, int]:
    """(slot, key, part, n_tokens, tokens) in no order, and how many there are. Texts are tokenized twice, first to count: no token is stored on the way."""
    rows = fixed_texts(docs, key, text)
    kind = docs.schema[key].dataType.simpleString()
    width = "<u2" if END < 2**16 else "<u4"
    firsts, total = count_sequences(rows, length, vocabulary)
    shared = docs.sparkSession.sparkContext.broadcast(firsts)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, n = shared.value.get(TaskContext.get().partitionId(), (0, 0))
        at = first
        for batch in batches:
            owner, part, sizes, blobs = [], [], [], []
            for row, body in enumerate(batch.column(1).to_pylist()):
                if not body:
                    continue
                ids = np.append(np.frombuffer(packed_ids(body, vocabulary), dtype=np.uint32).astype(width), np.array(END, dtype=width))
                for number, start in enumerate(range(0, len(ids), length)):
                    some = ids[start : start + length]
                    owner.append(row)
                    part.append(number)
                    sizes.append(len(some))
                    blobs.append(some.tobytes() if len(some) == length else np.pad(some, (0, length - len(some)), constant_values=END).tobytes())
            if at + len(owner) > first + n:
                raise ValueError("the texts of a partition are not those that were counted")
            slots = permute(np.arange(at, at + len(owner)), total, seed).astype(np.int64)
            at += len(owner)
            keys = batch.column(0).take(pa.array(owner, pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(slots), keys, pa.array(part, pa.int64()), pa.array(sizes, pa.int32()), pa.array(blobs, pa.binary())], names=["slot", "key", "part", "n_tokens", "tokens"])
        if at != first + n:
            raise ValueError("the texts of a partition are not those that were counted")

    return rows.mapInArrow(cut, f"slot long, key {kind}, part long, n_tokens int, tokens binary"), total


def in_slot_order(placed: DataFrame, total: int, per_shard: int) -> DataFrame:
    """Ranges of whole shards as partitions, sorted within: a sequence's partition follows from its slot."""
    shards = max(1, -(-total // per_shard))
    ranges = min(shards, PARTITIONS)
    width = -(-shards // ranges) * per_shard
    return placed.repartitionById(ranges, F.floor(F.col("slot") / width).cast("int")).sortWithinPartitions("slot")


def addressed(ordered: DataFrame, key: str, length: int, per_shard: int) -> DataFrame:
    """slot, shard, row, byte_offset, key, and the other columns."""
    stride = length * (2 if END < 2**16 else 4)
    row = F.col("slot") % per_shard
    return ordered.select("slot", F.floor(F.col("slot") / per_shard).alias("shard"), row.alias("row"), (row * stride).alias("byte_offset"), F.col("key").alias(key), "part", "n_tokens", "tokens")


def training_order(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = 512, per_shard: int = 8_192, seed: int = 11, vocabulary: str = VOCABULARY) -> DataFrame:
    """One row per sequence: slot, shard, row (its place in the shard), byte_offset, key, part, n_tokens, tokens.

    A document's token ids, closed by the end token, are cut into sequences of `length`; the last is padded with the end
    token, so each record has the same stride (little-endian 16-bit ids). A first pass counts the sequences of each input partition, which numbers
    them densely; the keyed permutation turns the number into the global slot; shard = slot / per_shard. Rows come in slot order: ranges of
    shards form the partitions, sorted within, so a partition writes whole shards one after the other. The texts must come from files or are
    written first: a lost executor repeats tasks, not the order. A task that meets other texts than were counted fails.

    NULL and empty texts have no sequence; NULL and repeated keys are kept; other columns are ignored.
    """
    placed, total = place_sequences(docs, key, text, length, per_shard, seed, vocabulary)
    return addressed(in_slot_order(placed, total, per_shard), key, length, per_shard)


def shared_folder(spark: SparkSession, folder: str) -> str:
    """The folder with its scheme: a path without one belongs to Spark's default file system, not to an executor's disk."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()


def store_of(folder: str):
    """The pyarrow file system of a location and the path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(re.sub("^s3[an]:", "s3:", folder))


def written_records(ordered: DataFrame, folder: str, lead: list[str]) -> DataFrame:
    """Write the shards now; (lead columns, shard, row, bytes, file, sha256) of each record, from a written table.

    A shard is written under a name of its attempt and then moved, so repeated attempts replace it by the same bytes.
    """
    folder = shared_folder(ordered.sparkSession, folder)
    kinds = ", ".join(f"`{name}` {ordered.schema[name].dataType.simpleString()}" for name in lead)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = store_of(folder)
        store.create_dir(root, recursive=True)
        attempt, shard, rows, stream = TaskContext.get().taskAttemptId(), None, 0, None
        held: list[pa.RecordBatch] = []
        digest = hashlib.sha256()

        def close() -> Iterator[pa.RecordBatch]:
            if stream is not None:
                size = stream.tell()
                stream.close()
                name = f"shard-{shard:08d}.bin"
                store.move(posixpath.join(root, f"_{shard:08d}-{attempt}"), posixpath.join(root, name))
                whole = pa.Table.from_batches(held).combine_chunks()
                at = pa.array(np.arange(rows), pa.int64())
                ends = [pa.array([x] * rows, kind) for x, kind in ((size, pa.int64()), (f"{folder.rstrip('/')}/{name}", pa.string()), (digest.hexdigest(), pa.string()))]
                yield from pa.Table.from_arrays([*whole.columns, pa.array([shard] * rows, pa.int64()), at, *ends], names=[*lead, "shard", "row", "bytes", "file", "sha256"]).to_batches()

        for batch in batches:
            numbers, tokens = batch.column(0).to_numpy(), batch.column(1).to_pylist()
            edges = np.concatenate(([0], np.flatnonzero(np.diff(numbers)) + 1, [len(numbers)]))
            for a, b in zip(edges.tolist(), edges[1:].tolist()):
                if b > a and numbers[a] != shard:
                    yield from close()
                    shard, rows, held, digest = int(numbers[a]), 0, [], hashlib.sha256()
                    stream = store.open_output_stream(posixpath.join(root, f"_{shard:08d}-{attempt}"))
                for record in tokens[a:b]:
                    stream.write(record)
                    digest.update(record)
                rows += b - a
                held.append(pa.RecordBatch.from_arrays([c.slice(a, b - a) for c in batch.columns[2:]], names=lead))
        yield from close()

    return materialize(ordered.select(F.col("shard").alias("tw_shard"), "tokens", *lead).mapInArrow(write, f"{kinds}, shard long, row long, bytes long, file string, sha256 string"), "shard-records")


def write_shards(ordered: DataFrame, folder: str) -> DataFrame:
    """Write `shard-<number>.bin` files of records without headers; (shard, rows, bytes, file, sha256) of each file, written eagerly.

    `ordered` is the result of training_order. `folder` is any location that the installed pyarrow file systems reach (a
    path of Spark's default file system, file:, hdfs:, s3:, s3a:); it must be shared.
    """
    return written_records(ordered, folder, ["slot"]).groupBy("shard").agg(F.count(F.lit(1)).alias("rows"), F.first("bytes").alias("bytes"), F.first("file").alias("file"), F.first("sha256").alias("sha256"))


def read_from(records: DataFrame, slot: int, length: int = 512) -> DataFrame:
    """The records (columns slot, shard, byte_offset, file, handed and more) from a slot on, in slot order, with `tokens` and `sha256` as read from the files.

    A file whose digest is not that of the bytes handed to it fails the read, as does a place beyond its end.
    """
    stride = length * (2 if END < 2**16 else 4)
    names = [c for c in records.columns if c not in ("handed", "file")]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, data, digest = None, b"", ""
        for batch in batches:
            tokens, digests = [], []
            for file, handed, offset in zip(*(batch.column(c).to_pylist() for c in ("file", "handed", "byte_offset"))):
                if file != at:
                    store, path = store_of(file)
                    with store.open_input_stream(path) as stream:
                        at, data = file, stream.read()
                    digest = hashlib.sha256(data).hexdigest()
                    if digest != handed:
                        raise ValueError(f"{file} does not hold the bytes that were written")
                record = data[offset : offset + stride]
                if len(record) != stride:
                    raise ValueError(f"{file} ends before {offset + stride}")
                tokens.append(record)
                digests.append(digest)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(tokens, pa.binary()), batch.column("file"), pa.array(digests, pa.string())], names=[*names, "tokens", "file", "sha256"])

    kinds = ", ".join(f"`{name}` {records.schema[name].dataType.simpleString()}" for name in names)
    shards = records.where(F.col("slot") >= slot)
    spread = max(1, shards.select("shard").distinct().count())
    return shards.repartitionByRange(min(spread, PARTITIONS), "shard").sortWithinPartitions("slot").mapInArrow(read, f"{kinds}, tokens binary, file string, sha256 string")


def written_order(
    docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = 512, per_shard: int = 8_192, seed: int = 11, vocabulary: str = VOCABULARY, folder: str | None = None, start: int = 0
) -> DataFrame:
    """The rows of training_order from its written shards: the files are written now, and tokens are read back from them, from slot `start` on.

    Shards go to `folder`, by default a fresh one below the shared folder. Further columns are `file` and `sha256`, the digest of the
    file as it is read.
    """
    folder = folder or scratch_path(docs.sparkSession, "shards")
    placed, total = place_sequences(docs, key, text, length, per_shard, seed, vocabulary)
    ordered = addressed(in_slot_order(placed, total, per_shard), "key", length, per_shard)
    records = written_records(ordered, folder, ["slot", "byte_offset", "key", "part", "n_tokens"])
    found = records.select("slot", "shard", "row", "byte_offset", "key", "part", "n_tokens", "file", F.col("sha256").alias("handed"))
    return read_from(found, start, length).withColumnRenamed("key", key)
