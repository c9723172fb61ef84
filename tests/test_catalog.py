"""Every registered query agrees with its check SQL on the smallest shared tables."""

import duckdb
import pytest
from compare import connect, difference

from tidewell.checks.catalog import load

QUERIES, ORACLES = load()


@pytest.fixture(scope="module")
def con(small):
    return connect(small)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, small, con, name):
    assert difference(QUERIES[name](spark, small), con, ORACLES[name]) is None


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


STUTTERS = [
    "a 15 15 15 b", "1.5 1.5 1.5 days", "1.5 5", "15 155", "x15 15", "x,15 15天", "3 3 4 4 4", "2 2.5 2.5", "7 7", "天数天数天数", "年假年假 年假", "一二三四五六一二三四五六一二三四五六", "哈哈哈哈哈", "好的好的好的，，，谢谢谢谢！！", "完。。", "[C1] 7 [C2] 7",
    "*a* `b`", "", None, " \n ", "&lt;b&gt; 9 9 &amp; 9", "9\t9\n9", "a_5 5 5", "甲乙丙甲乙丙丁甲乙甲乙",
]


def test_stutters_match_sql(spark, tmp_path):
    """Numbers inside words, beside points and longer numbers; phrases that overlap; marks; empty answers."""
    turns = [(i, turn, role, text, "en") for i, answer in enumerate(STUTTERS) for turn, role, text in ((0, "user", "q"), (1, "assistant", answer))]
    spark.createDataFrame(turns, "conv_id long, turn long, role string, text string, lang string").write.parquet(f"{tmp_path}/conversations.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{tmp_path}/conversations.parquet/*.parquet')")
    assert difference(QUERIES["answer_normalize"](spark, str(tmp_path)), con, ORACLES["answer_normalize"]) is None


SHAPES = ["a" * 999, "a" * 1000, "a" * 2500, "word " * 900, "One. Two three. " * 300, "l\n" * 1200, ("p " * 300 + "\n\n") * 8, "。".join(["字" * 400] * 9), "x" * 1500 + "\n\n" + "y z. " * 500, "\n\n\n" * 700 + "end", " ", ". " * 700]


def test_chunk_shapes_match_sql(spark, tmp_path):
    """Texts of each separator alone, nested ones, pieces of just the size, and texts without any separator."""
    spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(SHAPES)], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    con = duckdb.connect()
    for name in ("documents", "pages"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{tmp_path}/{name}.parquet/*.parquet')")
    assert difference(QUERIES["chunk_documents"](spark, str(tmp_path)), con, ORACLES["chunk_documents"]) is None
