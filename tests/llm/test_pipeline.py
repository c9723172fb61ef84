"""The stages of the pipeline against plain versions on the smallest tables."""

import re

import corpus_pipeline
from pyspark.sql import functions as F
from test_llm_operators import plain_links

from tidewell.llm.common import materialize, table
from tidewell.llm.language_id import held_out, keep_identified
from tidewell.llm.queries import QUERIES


def test_stages(spark, small):
    docs = table(spark, small, "documents")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "jaccard_join", "decontamination", "mix_sources", "training_order"]
    bench = [r["text"] for r in table(spark, small, "benchmark").collect()]
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if c.isascii() else c for c in t or ""))
    windows = {tuple(w[i : i + 13]) for w in map(split, bench) for i in range(max(1, len(w) - 12)) if w}
    for name, stage in corpus_pipeline.STAGES:
        before = docs.collect()
        docs = materialize(stage(spark, docs, small), f"test-{name}")
        after = docs.collect()
        if name != "training_order":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        ids = [r["doc_id"] for r in after]
        if name == "language_id":
            assert sorted(ids) == sorted(r["doc_id"] for r in before if any(c.isalpha() for c in r["text"] or ""))
            found = {r["doc_id"]: r["lang_pred"] for r in QUERIES["op2_language_id"](spark, small).collect()}
            given = {r["doc_id"]: r["lang"] for r in before}
            assert all(r["lang"] == (given[r["doc_id"]] or found[r["doc_id"]]) for r in after)
        elif name == "jaccard_join":
            near = plain_links([r["text"] for r in before])
            seen, want = set(), []
            for r in sorted(before, key=lambda r: r["doc_id"]):
                if r["text"] in seen:
                    continue
                want.append(r["doc_id"])
                todo = [r["text"]]
                while todo:
                    text = todo.pop()
                    if text not in seen:
                        seen.add(text)
                        todo += near[text]
            assert sorted(ids) == want
        elif name == "decontamination":
            want = []
            for r in before:
                w, hit = split(r["text"]), set()
                for n in {len(x) for x in windows}:
                    for i in range(len(w) - n + 1):
                        if tuple(w[i : i + n]) in windows:
                            hit |= set(range(i, i + n))
                if not hit or 20 * len(hit) < len(w):
                    want.append(r["doc_id"])
            assert sorted(ids) == sorted(want) and len(want) < len(before)
        elif name == "mix_sources":
            assert set(ids) <= {r["doc_id"] for r in before} and max(ids.count(i) for i in set(ids)) <= 3
        else:
            assert sorted(r["slot"] for r in after) == list(range(len(after)))
            assert set(ids) == {r["doc_id"] for r in before if r["text"]}


def test_missing_languages_are_filled(spark, small):
    """Where lang is NULL the language found stands in its place; a given one stays, right or wrong."""
    docs = table(spark, small, "documents")
    blank = docs.withColumn("lang", F.when(F.col("doc_id") % 3 == 0, F.lit(None)).when(F.col("doc_id") % 3 == 1, F.lit("given")).otherwise(F.col("lang")))
    rows = keep_identified(blank, docs.where(~held_out())).collect()
    truth = {r["doc_id"]: r["lang"] for r in docs.collect()}
    assert all(r["lang"] == "given" for r in rows if r["doc_id"] % 3 == 1)
    filled = [(r["lang"], truth[r["doc_id"]]) for r in rows if r["doc_id"] % 3 == 0 and truth[r["doc_id"]]]
    assert sum(a == b for a, b in filled) >= 0.97 * len(filled) > 10


def test_odd_rows_run_through(spark, odd, small):
    docs = odd
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, small), f"odd-{name}")
    assert docs.count() > 0
    empty = odd.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        empty = materialize(stage(spark, empty, small), f"none-{name}")
    assert empty.count() == 0
