import html

import pytest
from hypothesis import example, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidewell.functions import exprs as x
from tidewell.functions import pii
from tidewell.functions import text as tx
from tidewell.functions.splitter import split_recursive


def one(spark, value, expr):
    return spark.createDataFrame([(value,)], "t string").select(expr(F.col("t"))).first()[0]


def test_unescape_agrees_with_standard_library(spark):
    samples = [
        "a &amp;amp; b", "&lt;p&gt; &eacute;&copy; x", "&#8364;&#x20AC;&#X41;", "&notit; &ampfoo &unknown;", "&#128;&#0;&#55296;&#1114112;", "plain & simple", "&amp;lt;",
        "&;", "&#;", "tail &", "",
    ]
    df = spark.createDataFrame([(s,) for s in samples], "t string")
    got = [r[0] for r in df.select(tx.unescape_html("t")).collect()]
    assert got == [html.unescape(s) for s in samples]


def test_sanitize_keeps_lines(spark):
    raw = '﻿<h1 class="a">Title</h1>\n\n\n\nname = "v"  text\t\tend�\x07'
    assert one(spark, raw, tx.sanitize_document) == "Title \n\n text end"


def test_sanitize_flat(spark):
    assert one(spark, "# Head **bold**\n---\n`x` 　 y", tx.sanitize_flat) == "Head bold x y"


@pytest.mark.parametrize(
    "text, expected",
    [("\n  intro line\n## Real Heading ##\nmore", "Real Heading ##"), ("first line\nsecond", "first line"), ("  \n ", "unknown"), ("x" * 100, "x" * 80)],
)
def test_guess_section(spark, text, expected):
    assert one(spark, text, tx.guess_section) == expected


def test_answer_rules(spark):
    assert one(spark, "依据[C1] 年假 15 15 15 天天数天数", tx.normalize_answer) == "依据 年假 15 天天数。"
    assert one(spark, "  ", tx.normalize_answer) == tx.FALLBACK_ANSWER
    long = "字" * 100 + "。" + "文" * 300
    assert one(spark, long, tx.fit_answer) == "字" * 100 + "。"
    assert one(spark, "字" * 300, tx.fit_answer) == "字" * 239 + "。"
    assert one(spark, "短 答", tx.fit_answer) == "短 答"


@pytest.mark.parametrize(
    "question, answer, bad",
    [("why", "123 456", False), ("年假", "", True), ("年假", "有 1234 天", True), ("年假", "assistant 说", True), ("年假", "每年十五天", False),
     ("年假", "采购标准包括采购标准包括", True), ("年假", "15天或15天", True), ("年假", "mostly latin text 字", True)],
)
def test_low_quality(spark, question, answer, bad):
    row = spark.createDataFrame([(question, answer)], "q string, a string").select(tx.low_quality_answer("q", "a")).first()
    assert row[0] is bad


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="ab .\n。", max_size=400), st.integers(12, 40), st.integers(0, 10))
@example("a" * 13, 12, 0)
def test_split_is_bounded_and_covers(text, size, overlap):
    chunks = list(split_recursive(text, size, overlap))
    assert all(0 < len(c) <= size for c in chunks)
    squeezed = lambda s: "".join(s.split())
    position, body = 0, squeezed(text)
    for chunk in chunks:
        piece = squeezed(chunk)
        at = body.rfind(piece, 0, position + len(piece))  # the latest place that leaves no gap
        assert 0 <= at <= position
        position = max(position, at + len(squeezed(chunk)))
    assert position == len(body)


def test_fast_mail_pattern_finds_the_declared_matches(spark):
    import random

    rng = random.Random(2)
    texts = ["a@b.com_c@d.org", "a@b.com+c@d.org", "x%a@b.co%c@d.co.uk"] + ["".join(rng.choice("ab@.+%_- 1") for _ in range(40)) for _ in range(4000)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    declared = df.select(F.regexp_replace("t", pii.PATTERNS[0][1], "<email>").alias("a"), F.regexp_replace("t", pii.EMAIL_FROM_WORD_START, "<email>").alias("b"))
    assert declared.where("a <> b").count() == 0


def test_money_dates_masks(spark):
    df = spark.createDataFrame([("¥1,200", "2025/1/2"), (" ¥75 ", "20250103"), ("", "2025-01-04"), (None, "04.01.2025")], "m string, d string")
    rows = df.select(x.clean_money("m"), x.parse_mixed_date("d").cast("string")).collect()
    assert [tuple(r) for r in rows] == [(1200.0, "2025-01-02"), (75.0, "2025-01-03"), (0.0, "2025-01-04"), (0.0, None)]
    with pytest.raises(Exception):
        spark.createDataFrame([("junk",)], "m string").select(x.clean_money("m")).collect()
    assert one(spark, "13812345678", x.mask_middle) == "138****5678"
    assert one(spark, "12345", x.mask_middle) == "*****"
