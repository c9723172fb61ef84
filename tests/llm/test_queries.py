"""The registered training-data queries against independent SQL or plain versions on the shared tables."""

import hashlib
import re

import pytest
from compare import connect, difference

from tidewell.llm import secret_scan as secrets
from tidewell.llm.html_text import blocks_of
from tidewell.llm.queries import ORACLES, QUERIES
from tidewell.llm.url_filter import RULES


@pytest.fixture(scope="module")
def con(small):
    return connect(small)


def test_all_queries_are_registered():
    assert [name.split("_")[0] for name in QUERIES] == [f"op{n}" for n in range(1, 14)]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, small, con, name):
    assert difference(QUERIES[name](spark, small), con, ORACLES[name]) is None


def test_urls(spark, small, con):
    """Hosts, paths and rules by plain string functions; mined rules by containment of their tokens."""
    got = {r["page_id"]: r for r in QUERIES["op1_url_filter"](spark, small).collect()}
    rows = con.execute("SELECT page_id, url FROM pages").fetchall()
    assert len(got) == len(rows)
    for page, url in rows:
        rest = url.partition("://")[2] if url and "://" in url else ""
        cut = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
        host, tail = "".join(c.lower() if c.isascii() else c for c in rest[:cut]), rest[cut:]
        path = re.split(r"[?#]", tail)[0]
        fits = [(h + p, v) for v, h, p in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        best = max(fits, key=lambda f: len(f[0]), default=None)
        row = got[page]
        assert (row["host"], row["path"], row["rule"]) == (host, path, best and best[0])
        assert row["verdict"] == (best[1] if best else "block" if row["mined_rule"] else "allow")


def test_language_of_held_out_documents(spark, small, con):
    got = {r["doc_id"]: r for r in QUERIES["op2_language_id"](spark, small).collect()}
    truth = con.execute("SELECT doc_id, lang FROM documents WHERE lang IS NOT NULL").fetchall()
    unseen = [(got[d]["lang_pred"], lang) for d, lang in truth if got[d]["held_out"]]
    assert sum(a == b for a, b in unseen) >= 0.97 * len(unseen) > 10
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_secrets(spark, small, con):
    """Base spans by the patterns as stated, matches that fail dropped afterwards."""
    assign = re.compile(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    got = {r["doc_id"]: r for r in QUERIES["op4_secret_scan"](spark, small).collect()}
    for doc, text in con.execute("SELECT doc_id, text FROM documents").fetchall():
        text = text or ""
        spans = [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m[2]) >= 6]
        spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
        spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
        line = ",".join(f"{('assign', 'access', 'hex')[k]}:{s}:{e}" for s, k, e in sorted(spans))
        assert got[doc]["base_sha256"] == hashlib.sha256(line.encode()).hexdigest()
        assert set(filter(None, line.split(","))) <= set(got[doc]["spans"].split(","))
        assert [got[doc][c] for c in ("n_assign", "n_access", "n_hex")] == [sum(k == n for _, k, _ in spans) for n in range(3)]
        assert got[doc]["spans"] == secrets.render(secrets.base_spans(text) + secrets.structural_spans(text))


def test_pages_show_their_documents(spark, small, con):
    """Pages are made from documents: their article is a heading and the document's lines."""
    got = {r["page_id"]: r for r in QUERIES["op8_html_text"](spark, small).collect()}
    rows = con.execute(r"SELECT page_id, d.text, html FROM pages JOIN documents d ON d.doc_id = regexp_extract(url, '://[^/]*/\w+/([0-9]+)', 1)::BIGINT").fetchall()
    assert rows
    for page, text, html in rows:
        lines = [" ".join(x.split()) for x in text.split("\n") if x.strip()]
        assert got[page]["text"].split("\n\n")[1:] == lines
        assert got[page]["text"] == "\n\n".join(t for t, core in blocks_of(html) if core)
        assert got[page]["n_chars"] == len(got[page]["text"])


def test_training_order_holds_every_text(spark, small, con):
    from tidewell.llm.token_output import END, VOCABULARY, encoder

    rows = QUERIES["op10_training_order"](spark, small).collect()
    assert [r["slot"] for r in rows] == list(range(len(rows)))
    parts = {}
    for r in rows:
        ids = memoryview(bytes(r["tokens"])).cast("H").tolist()
        assert len(ids) == 512 and all(i == END for i in ids[r["n_tokens"] :])
        parts.setdefault(r["doc_id"], {})[r["part"]] = ids[: r["n_tokens"]]
    decode = encoder(VOCABULARY).decode
    for doc, text in con.execute("SELECT doc_id, text FROM documents WHERE text <> ''").fetchall():
        ids = [i for part in sorted(parts[doc]) for i in parts[doc][part]]
        assert ids[-1] == END and decode(ids[:-1]) == text
