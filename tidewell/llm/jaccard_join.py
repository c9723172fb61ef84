"""Near duplicates by word shingles: banded MinHash proposes, exact Jaccard similarity decides."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import join_small, materialize, pieces
from tidewell.llm.words import BASE, mix, run_names, word_names
from tidewell.operators.graph import member_components

#: Shingles of one verification cell; larger groups of candidates are dealt into pairs of blocks.
CELL = 300_000
#: Most distinct candidate texts whose list is broadcast (48 bytes each).
LISTED = 200_000


def prefix_depth(trees: int, depth: int, threshold: float, recall: float) -> int:
    """The longest common prefix with which a pair at the threshold meets in one of the trees with the target probability. It is
    fixed before any data is read: a tree is one band, its bucket key the prefix, and deeper values are not used."""
    while depth > 1 and 1 - (1 - threshold**depth) ** trees < recall:
        depth -= 1
    return depth


def shingle_sets(texts: list[bytes], size: int) -> list[np.ndarray]:
    """The distinct shingles of each text, sorted; a text of fewer words is one shingle, one without words has none."""
    words, bounds = word_names(texts)
    runs = run_names(words, size)
    out = []
    for a, b in zip(bounds, bounds[1:]):
        if b - a >= size:
            out.append(np.unique(runs[a : b - size + 1]))
        else:
            out.append(run_names(words[a:b], int(b - a), seed=int(b - a)) if b > a else np.zeros(0, dtype=np.uint64))
    return out


def signature(shingles: np.ndarray, scale: np.ndarray, shift: np.ndarray) -> np.ndarray:
    """The smallest value of each hash function over a set, in pieces of bounded size."""
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(len(scale), 2**32 - 1, dtype=np.uint32)
    for at in range(0, len(x), 2048):
        values = (x[at : at + 2048, None] ^ shift) * scale
        np.minimum(least, (values ^ (values >> np.uint32(15))).min(axis=0), out=least)
    return least


def branch_keys(least: np.ndarray, trees: int, depth: int, prefix: int) -> np.ndarray:
    """The node of each tree that the first `prefix` values of its branch lead to, as one 64-bit name."""
    branches = least.reshape(trees, depth)[:, :prefix].astype(np.uint64)
    total = np.arange(trees, dtype=np.uint64) + np.uint64(1)
    for level in range(prefix):
        total = mix(total * np.uint64(BASE) + branches[:, level])
    return total.astype(np.int64)


def forest(rows: DataFrame, size: int, trees: int, depth: int, prefix: int) -> DataFrame:
    """(mark, keys) from (mark, body); no keys for texts without words."""
    rng = np.random.default_rng(20)
    scale = rng.integers(0, 2**31, trees * depth, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    shift = rng.integers(0, 2**32, trees * depth, dtype=np.uint32)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            texts = [(t or "").encode() for t in batch.column(1).to_pylist()]
            keys = [branch_keys(signature(s, scale, shift), trees, depth, prefix) if len(s) else [] for s in shingle_sets(texts, size)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys, pa.list_(pa.int64()))], names=["mark", "keys"])

    return rows.select("mark", "body").mapInArrow(sign, "mark binary, keys array<bigint>")


def cell_links(sets: list[np.ndarray], sides: np.ndarray, threshold: float, two: bool) -> tuple[np.ndarray, np.ndarray]:
    """(number of links, root) of each set: links are pairs at the threshold, between the sides in a cell of `two` blocks, one of which may be empty.

    Postings of every shingle are laid out once; a set counts its intersections with all others by one bincount, so no
    pair is ever written down. Roots are the smallest numbers of connected sets.
    """
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    flat = np.concatenate(sets) if len(sets) else np.zeros(0, dtype=np.uint64)
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, ids = np.unique(flat, return_inverse=True)
    order = np.argsort(ids, kind="stable")
    posting = owner[order]
    starts = np.concatenate(([0], np.cumsum(np.bincount(ids)))) if len(ids) else np.zeros(1, dtype=np.int64)
    bounds = np.concatenate(([0], np.cumsum(sizes)))
    links, label = np.zeros(len(sets), dtype=np.int64), np.arange(len(sets))
    for a in range(len(sets)):
        mine = ids[bounds[a] : bounds[a + 1]]
        shared = np.zeros(len(sets), dtype=np.int64)
        for at in range(0, len(mine), 256):  # pieces, so that postings of a long text stay small in memory
            part = mine[at : at + 256]
            shared += np.bincount(np.concatenate([posting[starts[i] : starts[i + 1]] for i in part]), minlength=len(sets))
        near = shared * (1 + threshold) >= (sizes + sizes[a]) * threshold - 1e-9
        near &= shared > 0
        near[a] = False
        if two:
            near &= sides != sides[a]
        links[a] = near.sum()
        if links[a]:
            met = np.unique(np.append(label[near], label[a]))
            if len(met) > 1:
                label[np.isin(label, met)] = met[0]
    return links, label


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 5, threshold: float = 0.8, trees: int = 24, depth: int = 8, recall: float = 0.999) -> DataFrame:
    """One row per row: key, class_id (equal texts share it), links (other texts at the threshold), group_id.

    Equal texts form a class; similarity is the Jaccard similarity of the sets of `size`-word shingles (words between
    ASCII white space, unchanged). Texts that share a node of the forest are connected to candidate groups without
    writing pairs; within a group all pairs of texts are compared exactly, in cells of bounded size when the
    group is large, so groups holding a third of all texts are spread over many tasks. Only counts and roots leave a
    cell. `group_id` is the smallest class of the connected texts.

    Of pairs exactly at the threshold a share of at least `recall` meets in the forest; more of those above it. Shingles are
    compared by 64-bit names. NULL text is empty; texts without words have no links, a text of fewer than `size` words is one shingle.
    NULL and repeated keys pass through, other columns are ignored, an empty table gives an empty result.
    """
    prefix = prefix_depth(trees, depth, threshold, recall)
    base = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("body")).withColumn("mark", F.unhex(F.md5("body")))
    signed = materialize(forest(base, size, trees, depth, prefix).groupBy("mark").agg(F.first("keys").alias("keys")), "forest")
    entries = signed.select("mark", F.explode("keys").alias("node"))
    heads = materialize(entries.groupBy("node").agg(F.min("mark").alias("head"), F.count("*").alias("n")).where("n > 1").select("node", "head"), "nodes")
    stars = materialize(entries.join(heads, "node").select("mark", "head").distinct(), "stars")
    groups = materialize(member_components(stars, "mark", "head"), "candidates")
    picked = join_small(base.select("mark", "body"), groups, "mark", rows=LISTED).groupBy("mark", "component").agg(F.first("body").alias("body"))

    def shingle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            sets = shingle_sets([t.encode() for t in batch.column(2).to_pylist()], size)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([len(s) for s in sets], pa.int64()), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], names=["mark", "component", "n", "shingles"]
            )

    sets = materialize(picked.mapInArrow(shingle, "mark binary, component binary, n bigint, shingles array<bigint>"), "shingles")
    parts = materialize(sets.groupBy("component").agg(F.ceil(F.sum("n") / CELL).cast("int").alias("parts")).where("parts > 1"), "large-groups")
    dealt = join_small(sets, parts, "component", "left").withColumn("parts", F.coalesce("parts", F.lit(1))).withColumn("block", F.pmod(F.xxhash64("mark"), F.col("parts")).cast("int"))
    cells = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    cells = cells.select("mark", "component", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "shingles")

    def verify(rows: pa.Table) -> pa.Table:
        marks = rows.column("mark").to_pylist()
        order = sorted(range(len(marks)), key=marks.__getitem__)
        lists = rows.column("shingles").combine_chunks()
        found = [np.asarray(lists[i].values).view(np.uint64) for i in order]
        two = rows.column("low")[0].as_py() != rows.column("high")[0].as_py()
        links, root = cell_links(found, rows.column("block").to_numpy()[order], threshold, two)
        hit = np.flatnonzero(links)
        return pa.table([pa.array([marks[order[i]] for i in hit], pa.binary()), pa.array(links[hit]), pa.array([marks[order[root[i]]] for i in hit], pa.binary())], names=["mark", "links", "root"])

    verified = materialize(cells.groupBy("component", "low", "high").applyInArrow(verify, "mark binary, links bigint, root binary"), "links")
    counted = verified.groupBy("mark").agg(F.sum("links").alias("links"))
    connected = member_components(verified.select("mark", "root").union(verified.select(F.col("root").alias("mark"), "root")), "mark", "root")
    linked = materialize(counted.join(connected, "mark"), "linked")
    out = join_small(base.select("key", "mark"), linked, "mark", "left", LISTED)
    return out.select(F.col("key").alias(key), F.lower(F.hex("mark")).alias("class_id"), F.coalesce("links", F.lit(0)).alias("links"), F.lower(F.hex(F.coalesce("component", "mark"))).alias("group_id"))


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row of each group, with the columns of `docs`: the smallest key, then the smallest class, then any of equal ones.

    Rows are combined within each task before they are moved, so a hot group sends one row per task.
    """
    found = near_duplicates(docs.select(F.unhex(F.md5(F.coalesce(F.col(text), F.lit("")))).alias("tw_key"), F.col(text).alias("tw_text")), "tw_key", "tw_text", **options)
    groups = materialize(found.where("class_id <> group_id").select(F.unhex("class_id").alias("tw_mark"), F.unhex("group_id").alias("tw_group")).distinct(), "groups")
    marked = join_small(docs.withColumn("tw_mark", F.unhex(F.md5(F.coalesce(F.col(text), F.lit(""))))), groups, "tw_mark", "left", LISTED)
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    first = F.struct(F.col(key).isNull().alias("none"), F.col(key).alias("key"), F.col("tw_mark").alias("mark"))
    kept = marked.groupBy(F.coalesce("tw_group", "tw_mark").alias("tw_group")).agg(F.min_by(whole, first).alias("tw_row"))
    return kept.select("tw_row.*")
