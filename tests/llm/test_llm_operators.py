"""Each operator on small inputs: NULLs, empty and long texts, ties, repeated rows, empty tables, clashing columns."""

import base64
import itertools
import json
import math
import os
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidewell.llm import decontaminate, exact_dedup, html_text, jaccard_join, language_id, mixing, secret_scan, substring_dedup, token_output, url_filter, words
from tidewell.llm.common import PIECE_BYTES, PIECE_ROWS, pieces


def lines(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# exact duplicates


@pytest.mark.parametrize("options", [{}, {"least": 1, "hot": 4}, {"least": 1, "digest": lambda t: F.length(t)}])
def test_exact_duplicates(odd, options):
    """The same rows for any salting, and when different texts share a digest."""
    rows = exact_dedup.exact_duplicates(odd, **options).collect()
    texts = [(r["doc_id"], r["text"] or "") for r in odd.select("doc_id", "text").collect()]
    import hashlib

    want = {}
    for doc, text in texts:
        want.setdefault(hashlib.sha256(text.encode()).hexdigest(), []).append(doc)
    assert len(rows) == len(texts)
    for sha, docs in want.items():
        mine = [r for r in rows if r["text_sha256"] == sha]
        top = max((d for d in docs if d is not None), default=None)
        assert {r["keep_id"] for r in mine} == {top} and {r["group_size"] for r in mine} == {len(docs)}
        assert [r["doc_id"] for r in mine if r["kept"]] == [top]
    assert exact_dedup.exact_duplicates(odd.limit(0)).count() == 0


# mixing


def test_mixing(odd, frame):
    rows = mixing.repetitions(odd).collect()
    sizes = {}
    for r in rows:
        assert r["mix_size"] == len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")) and 0 <= r["mix_copies"] <= 3
        sizes[r["source"]] = sizes.get(r["source"], 0) + r["mix_size"]
    order = sorted((s for s in sizes if s is not None)) + [None]
    weight, total, full = {s: i % 3 + 1 for i, s in enumerate(order)}, sum(sizes.values()), set()
    while True:
        level = (total - 3 * sum(sizes[s] for s in full)) / max(1, sum(w for s, w in weight.items() if s not in full))
        more = {s for s in order if s not in full and weight[s] * level > 3 * sizes[s]}
        if not more:
            break
        full |= more
    for r in rows:
        s = r["source"]
        assert r["mix_source_size"] == sizes[s] and r["mix_target"] == pytest.approx(3 * sizes[s] if s in full else weight[s] * level)
    assert lines(mixing.mix_sources(odd).select("doc_id", "text")) == lines(mixing.mix_sources(odd.repartition(3)).select("doc_id", "text"))
    assert mixing.mix_sources(odd).columns == odd.columns and mixing.mix_sources(odd.limit(0)).count() == 0
    many = frame([(i, "word " * 10, "en", "ab"[i % 2]) for i in range(2000)])
    taken = {r["source"]: (r["t"], r["w"]) for r in mixing.repetitions(many).groupBy("source").agg(F.sum(F.col("mix_size") * F.col("mix_copies")).alias("t"), F.max("mix_target").alias("w")).collect()}
    assert all(abs(t - w) < 0.08 * w for t, w in taken.values())


# URL rules


def test_mined_url_rules(spark):
    pages = spark.createDataFrame([(i, f"http://{'bad' if i % 3 == 0 else 'good'}.site.org/{'ads' if i % 2 else 'news'}/{i}", "x") for i in range(240)] + [(None, None, "x"), (999, "no scheme", "x"), (3, "HTTP://BAD.Site.org/ads/3?q=1#f", "x")], "page_id long, url string, tokens string")
    labels = spark.createDataFrame([(i, int(not (i % 3 == 0 and i % 2)), 0) for i in range(240)] + [(None, 0, 1), (1, None, None)], "doc_id long, quality int, toxic int")
    rows = url_filter.filter_urls(pages, labels, support=0.01, confidence=0.9).collect()
    assert len(rows) == pages.count()
    for r in rows:
        bad = r["host"] == "bad.site.org" and r["path"].startswith("/ads")
        assert r["verdict"] == ("block" if bad else "allow"), r
        if bad:
            assert set(r["mined_rule"].split()) == {"host:bad", "path:ads"}
    assert [(r["host"], r["path"]) for r in rows if r["page_id"] in (None, 999)] == [("", "")] * 2
    bare = url_filter.filter_urls(pages, labels.limit(0))
    assert bare.where("verdict = 'block'").count() == 0 and bare.count() == pages.count()
    assert url_filter.filter_urls(pages.limit(0), labels).count() == 0


def plain_rules(baskets, support, confidence, least, longest):
    """Every token set of every basket is counted; a class is all tokens seen in the same baskets."""
    places = {}
    for i, (tokens, _) in enumerate(baskets):
        for t in set(tokens):
            places.setdefault(t, set()).add(i)
    classes = {}
    for t, where in places.items():
        if len(where) >= least:
            classes.setdefault(frozenset(where), set()).add(t)
    found, bad = {}, {i for i, b in enumerate(baskets) if b[1]}
    for size in range(1, longest + 1):
        for chosen in itertools.combinations(classes, size):
            both = frozenset.intersection(*chosen)
            hits = len(both & bad)
            if both and hits >= max(least, support * len(baskets)) and hits >= confidence * len(both):
                found[frozenset(chosen)] = hits / len(both)
    lean = {c: sure for c, sure in found.items() if not any(d < c and found[d] >= sure for d in found)}
    return sorted((" ".join(sorted(t for where in c for t in classes[where])), round(sure, 9)) for c, sure in lean.items())


@pytest.mark.parametrize("least, longest", [(1, 3), (4, 2), (4, 4), (500, 4)])
def test_rules_equal_plain_version(spark, least, longest):
    """Rules by counting all sets, with tokens that always come together, a token of every basket and too few labels."""
    rng = random.Random(5)
    baskets = []
    for _ in range(60):
        tokens = ["host:com", *(t for t in ("a", "b", "c", "d") if rng.random() < 0.5)]
        tokens += ["pair1", "pair2", "pair3"] if rng.random() < 0.4 else []
        baskets.append((tokens, rng.random() < (0.9 if {"a", "b"} <= set(tokens) else 0.7 if "pair1" in tokens else 0.2)))
    df = spark.createDataFrame([(t + [url_filter.BAD] * bad,) for t, bad in baskets], "items array<string>")
    got = url_filter.mine_rules(df, 0.02, 0.6, least, longest).collect()
    assert sorted((r["mined_rule"], round(r["confidence"], 9)) for r in got) == plain_rules(baskets, 0.02, 0.6, least, longest)
    assert all(r["anchor"] in r["tokens"] for r in got) and bool(got) == (least < 500)


@pytest.mark.parametrize("url, verdict, rule", [("http://a.com/x", "allow", "com/"), ("http://example.com/en/1", "block", "example.com/en/"), ("http://www.example.com/en/1", "allow", "www.example.com/en/"), ("http://x.net/es/", "block", "net/es/"), ("http://x.net/de/", None, None), ("http://x.com", None, None), ("http://notexample.com/en/", "allow", "com/")])
def test_explicit_rules(spark, url, verdict, rule):
    df = spark.createDataFrame([(url,)], "url string")
    fit = df.select(url_filter.explicit_rule(url_filter.host_of(F.col("url")), url_filter.path_of(F.col("url"))).alias("f")).first()["f"]
    assert (fit and (fit["verdict"], fit["rule"])) == ((verdict, rule) if rule else None)


# language


def greedy(sample, text):
    count = at = 0
    while at < len(text):
        n = 1
        while at + n < len(text) and text[at : at + n + 1] in sample:
            n += 1
        at, count = at + n, count + 1
    return count


@settings(max_examples=80, deadline=None)
@given(st.text(alphabet="abc ", max_size=60), st.text(alphabet="abcd ", max_size=40))
def test_phrases_are_longest_matches(sample, text):
    assert language_id.phrases(language_id.automaton(sample), text) == greedy(sample, text)


def test_language_edges(odd, frame):
    taught = frame([(1, "the cat and the dog went home", "en", None), (2, "der hund und die katze gehen heim", "de", None), (3, None, "fr", None), (4, "???", None, None)])
    rows = language_id.identify_languages(odd, taught).collect()
    assert len(rows) == odd.count()
    for r in rows:
        assert (r["lang_pred"] == "und") == (not any(c.isalpha() for c in r["text"] or "")) and 0 <= r["lang_score"] <= 1
    assert {r["lang_pred"] for r in language_id.identify_languages(frame([(1, "Die Katze und der Hund!", None, None)]), taught).collect()} == {"de"}
    assert {r["lang_pred"] for r in language_id.identify_languages(odd, taught.limit(0)).collect()} == {"und"}
    assert language_id.identify_languages(odd.limit(0), taught).count() == 0
    kept = language_id.keep_identified(odd, taught)
    assert kept.columns == odd.columns and kept.count() == 8
    assert language_id.keep_identified(odd, taught.limit(0)).count() == 8


def test_numbers_are_no_letters(frame):
    """Fractions, superscripts, circled and Roman numbers, digits of other scripts; words around them count without them."""
    taught = frame([(1, "the cat and the dog went home", "en", None), (2, "der hund und die katze gehen heim", "de", None)])
    texts = ["½ ²", "①②", "Ⅷ ⅷ", "٣٤", "12_34", "der² hund½und", "ª"]
    rows = {r["doc_id"]: r["lang_pred"] for r in language_id.identify_languages(frame([(n, t, None, None) for n, t in enumerate(texts)]), taught).collect()}
    assert [rows[n] for n in range(6)] == ["und"] * 5 + ["de"] and rows[6] != "und"
    assert language_id.words_of("Ein² x½y 3D") == ["ein", "x", "y", "d"]


# secrets


def der(tag, body):
    size = len(body)
    head = bytes([size]) if size < 128 else bytes([0x82]) + size.to_bytes(2, "big")
    return bytes([tag]) + head + body


def b64(data, url=False):
    return (base64.urlsafe_b64encode(data).rstrip(b"=") if url else base64.b64encode(data)).decode()


def test_structural_secrets(frame, odd):
    rng = random.Random(1)
    key = der(0x30, der(2, b"\0") + der(2, rng.randbytes(129)) + der(2, b"\1\0\1") + der(2, rng.randbytes(128)))
    token = b64(json.dumps({"alg": "HS256"}).encode(), True) + "." + b64(b'{"sub":"1"}', True) + "." + b64(rng.randbytes(32), True)
    ssh = b"openssh-key-v1\0" + b"".join(len(x).to_bytes(4, "big") + x for x in (b"none", b"none", b"")) + rng.randbytes(60)
    pem = f"-----BEGIN RSA PRIVATE KEY-----\n{b64(key)}\n-----END RSA PRIVATE KEY-----"
    broken = b64(key[:-1] + b"")
    texts = [f"é {token} end", f"x {pem} y", f"é {b64(key)}", key.hex(), f"k {b64(ssh)}", broken, b64(rng.randbytes(90)), "a.b.c " + token.replace(".", " ")]
    kinds = ["signed_token", "pem_key", "der_key", "der_key", "ssh_key", None, None, None]
    rows = {r["doc_id"]: r for r in secret_scan.scan_secrets(frame([(i, t, None, None) for i, t in enumerate(texts)])).collect()}
    for i, kind in enumerate(kinds):
        found = {s["kind"] for s in rows[i]["spans"]} - {"hex"}
        assert (kind in found) if kind else not found & {"signed_token", "pem_key", "der_key", "ssh_key"}
    span = rows[0]["spans"][0]
    assert texts[0][span["start"] : span["end"]] == token
    assert secret_scan.scan_secrets(odd).where("size(spans) > 0").count() == 0 and secret_scan.scan_secrets(odd).count() == odd.count()
    assert secret_scan.scan_secrets(odd.limit(0)).count() == 0


def test_secrets_beside_other_text():
    """Keys after an equals sign or a separator, tokens after other dotted parts, headers with white space."""
    rng = random.Random(2)
    key = b64(der(0x30, der(2, b"\0") + der(2, rng.randbytes(129)) + der(2, b"\1\0\1") + der(2, rng.randbytes(128))))
    ssh = b64(b"openssh-key-v1\0" + b"".join(len(x).to_bytes(4, "big") + x for x in (b"none", b"none", b"")) + rng.randbytes(60))
    token = ".".join((b64(b'{"alg":"HS256"}', True), b64(b'{"sub":"1"}', True), b64(rng.randbytes(32), True)))
    for before in ("PRIVATE_KEY=", "key: ", "x==", "keys/", "my-old_", "a+bc/d-", "a/M/MA/MIIE/", ""):
        for secret, kind in ((key, 5), (ssh, 6)):
            assert secret_scan.structural_spans(f"é {before}{secret} end") == [(2 + len(before), kind, 2 + len(before) + len(secret))], before
    for before in ("response.body.", "aaaaaaaaaa.bbbbbbbb.", "x=", ""):
        assert secret_scan.structural_spans(f"é {before}{token} end") == [(2 + len(before), 3, 2 + len(before) + len(token))], before
    for head in (b'{\n "alg": "HS256"}', b'{\t"alg": "HS256"}', b'{\r\n"alg":"HS256"}', b' {"alg":"HS256"}'):
        other = b64(head, True) + token[token.index(".") :]
        assert secret_scan.structural_spans(other) == [(0, 3, len(other))], head
    assert secret_scan.structural_spans("long.dotted.names.everywhere.are.not.tokens.atall " + "MIIE/" * 40 + "x" * 50) == []


def test_wrapped_and_nested_keys():
    """Keys in escaped, quoted and indented armour, over several lines without armour, after letters, before other text, and an armoured key in base64."""
    rng = random.Random(3)
    rsa = der(0x30, der(2, b"\0") + der(2, rng.randbytes(129)) + der(2, b"\1\0\1") + der(2, rng.randbytes(128)))
    pkcs8 = der(0x30, der(2, b"\0") + der(0x30, der(6, bytes.fromhex("2a864886f70d010101")) + der(5, b"")) + der(4, rsa))
    for key in (rsa, pkcs8):
        plain = b64(key)
        lines = [plain[i : i + 64] for i in range(0, len(plain), 64)]
        head, tail = "-----BEGIN PRIVATE KEY-----", "-----END PRIVATE KEY-----"
        for glue in ("\n", "\r\n", "\\n", "\\\\n", "\n> ", "\n    ", '",\n  "', "\n# "):
            armoured = glue.join([head, *lines, tail])
            assert secret_scan.structural_spans(f"é {armoured} end") == [(2, 4, 2 + len(armoured))], glue
            assert secret_scan.structural_spans(f"é {armoured[:200]}{armoured[205:]} end") == [], glue
        for glue in ("\n", "\r\n", "\\n", "\n> ", "\n\t"):
            wrapped = glue.join(lines)
            for before, after in (("", ""), ("key:\n", "\nThe next line goes on"), ("\\n", "\\nThe"), ("KEY=", " end")):
                found = secret_scan.structural_spans(f"é {before}{wrapped}{after}")
                assert found == [(2 + len(before), 5, 2 + len(before) + len(wrapped))], (glue, before)
            assert secret_scan.structural_spans(wrapped[: len(wrapped) // 2]) == []
        for before in ("\\n", "key", "rsaMA"):
            assert secret_scan.structural_spans(f"{before}{plain}") == [(len(before), 5, len(before) + len(plain))]
        nested = b64("\n".join([head, *lines, tail]).encode())
        assert secret_scan.structural_spans(f"DATA={nested} x") == [(5, 4, 5 + len(nested))]
        assert secret_scan.structural_spans("\n".join([plain, plain])) == [(0, 5, len(plain)), (len(plain) + 1, 5, 2 * len(plain) + 1)]
    blob = b64(rng.randbytes(60_000))
    assert secret_scan.structural_spans("\n".join(blob[i : i + 76] for i in range(0, len(blob), 76))) == []


def test_short_values_still_consume():
    assert secret_scan.base_spans("password: token: abcdefgh") == []
    assert secret_scan.render(secret_scan.base_spans("ToKeN='abc123'")) == "assign:0:13"


# names of words


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab é\n\x0b\x1f", max_size=30), max_size=8), st.integers(2, 40))
def test_word_names(texts, segment):
    old, words.SEGMENT = words.SEGMENT, segment
    try:
        names, bounds = words.word_names([t.encode() for t in texts])
    finally:
        words.SEGMENT = old
    split = [t.encode().split() for t in texts]
    assert np.diff(bounds).tolist() == [len(s) for s in split]
    flat = [w for s in split for w in s]
    assert len({n: w for n, w in zip(names.tolist(), flat)}) == len(set(flat)) == len(set(zip(names.tolist(), flat)))


# repeated passages


def plain_removal(rows, window):
    seen, out = set(), {}
    for doc, text in rows:
        tokens = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        gone = set()
        for i in range(len(tokens) - window + 1):
            run = tuple(tokens[i : i + window])
            if run in seen:
                gone |= set(range(i, i + window))
            seen.add(run)
        out[doc] = (len(tokens), len(gone), " ".join(t for i, t in enumerate(tokens) if i not in gone))
    return out


@pytest.mark.parametrize("seed", range(3))
def test_removal_equals_plain_version(spark, monkeypatch, seed):
    """Random texts of few words, with runs, over many small blocks and buckets."""
    rng = random.Random(seed)
    pool = [[rng.choice("abcd") * rng.choice([1, 1, 2]) for _ in range(rng.randint(5, 60))] for _ in range(12)]
    rows = []
    for i in range(150):
        body = []
        for _ in range(rng.randint(0, 4)):
            body += rng.choice(pool) if rng.random() < 0.7 else ["x"] * rng.randint(1, 60)
            body += [rng.choice("efghij") for _ in range(rng.randint(0, 6))]
        rows.append((i * 3, " ".join(body)))
    monkeypatch.setattr(substring_dedup, "BUCKET_WORDS", 700)
    shuffled = rng.sample(rows, len(rows))
    df = spark.createDataFrame(shuffled, "doc_id long, text string").repartition(7)
    for window, rounds in ((20, 2), (6, 1), (20, 3)):
        got = {r["doc_id"]: tuple(r)[1:] for r in substring_dedup.remove_repeats(df, window=window, rounds=rounds).collect()}
        assert got == plain_removal(rows, window)


def test_interior_symbols_agree():
    """Equal windows have equal anchors wherever they stand."""
    rng = np.random.default_rng(3)
    passage = rng.integers(0, 5, 60).astype(np.uint64)
    anchors = []
    for before in range(6):
        text = np.concatenate((rng.integers(0, 5, before).astype(np.uint64), passage, rng.integers(0, 5, 9).astype(np.uint64)))
        starts, chosen, _ = substring_dedup.anchors(words.mix(text), np.array([0, len(text)]), 20, 2)
        anchors.append(chosen[before : before + 41].tolist())
    assert all(a == anchors[0] for a in anchors)


def test_removal_edges(odd):
    rows = substring_dedup.remove_repeats(odd).collect()
    assert len(rows) == odd.count()
    by = {r["doc_id"]: r for r in rows if r["doc_id"] in (2, 3, 6, 7)}
    assert by[2]["n_words"] == by[3]["n_words"] == 0 and by[6]["n_words"] == 120_000
    assert by[6]["n_removed"] == 120_000 - 9973 - 19 + 19 and by[7]["n_removed"] == 120_000
    assert substring_dedup.remove_repeats(odd.limit(0)).count() == 0


# Jaccard join


def plain_links(texts, threshold=0.8):
    sets = {}
    for t in set(texts):
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        sets[t] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    near = lambda a, b: a != b and bool(sets[a] & sets[b]) and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= threshold
    return {a: {b for b in sets if near(a, b)} for a in sets}


@pytest.mark.parametrize("cell", [300_000, 900])
def test_links_equal_plain_version(frame, monkeypatch, cell):
    """Near copies of a few texts, also when a group is dealt into many cells."""
    monkeypatch.setattr(jaccard_join, "CELL", cell)
    rng = random.Random(5)
    texts = []
    for _ in range(6):
        base = [f"v{rng.randint(0, 300)}" for _ in range(rng.randint(3, 90))]
        for _ in range(12):
            copy = list(base)
            for _ in range(rng.randint(0, 2)):
                copy[rng.randrange(len(copy))] = f"n{rng.randint(0, 9)}"
            texts.append(" ".join(copy))
    want = plain_links(texts)
    df = frame([(i, t, None, None) for i, t in enumerate(texts)])
    rows = jaccard_join.near_duplicates(df).collect()
    group = {r["class_id"]: r["group_id"] for r in rows}
    name = {texts[r["doc_id"]]: r["class_id"] for r in rows}
    for r in rows:
        text = texts[r["doc_id"]]
        assert r["links"] == len(want[text])
        assert all(group[name[b]] == r["group_id"] for b in want[text])
    parts = {}
    for t in want:  # connected texts, plainly
        reach, todo = {t}, [t]
        while todo:
            for b in want[todo.pop()] - reach:
                reach.add(b)
                todo.append(b)
        parts[t] = min(name[b] for b in reach)
    assert all(group[name[t]] == parts[t] for t in want)
    kept = [r["doc_id"] for r in jaccard_join.keep_one(df).collect()]
    assert sorted(kept) == sorted(min(i for i, t in enumerate(texts) if parts[t] == g) for g in set(parts.values()))


@pytest.mark.parametrize("copies", [2, 5])
def test_links_of_few_long_copies(frame, monkeypatch, copies):
    """Groups of more blocks than texts: a cell of two blocks, one of them empty, counts nothing again."""
    monkeypatch.setattr(jaccard_join, "CELL", 25)
    rows = [(g * 10 + i, " ".join(f"g{g}w{n}" for n in range(100)) + f" end{i}", None, None) for g in range(8) for i in range(copies)]
    assert {r["links"] for r in jaccard_join.near_duplicates(frame(rows)).collect()} == {copies - 1}


def test_join_edges(odd):
    rows = jaccard_join.near_duplicates(odd).collect()
    assert len(rows) == odd.count()
    assert {r["doc_id"]: r["links"] for r in rows if r["doc_id"] in (2, 4, 6, 7)} == {2: 0, 4: 0, 6: 1, 7: 1}
    assert len({r["class_id"] for r in rows if r["doc_id"] in (1, 2)}) == 1
    kept = jaccard_join.keep_one(odd)
    assert kept.columns == odd.columns
    assert sorted((r["doc_id"] for r in kept.collect())) == [1, 3, 4, 6, 8, 8]
    assert jaccard_join.near_duplicates(odd.limit(0)).count() == 0 and jaccard_join.keep_one(odd.limit(0)).count() == 0


def test_batches_are_worked_on_in_small_pieces():
    """A worker turns a bounded part of a batch into texts and shingles at once; all rows come through in order."""

    class Rows:
        def select(self, *_):
            return self

        def mapInArrow(self, sign, _):  # noqa: N802
            return sign

    texts = [f"text {i} " + "some words to fill it " * 60 for i in range(1500)] + ["long " * 200_000, None, ""]
    marks = [str(i).encode() for i in range(len(texts))]
    whole = pa.record_batch({"mark": marks, "body": texts})
    found = list(pieces([whole, whole.slice(0, 0)]))
    assert pa.Table.from_batches(found) == pa.Table.from_batches([whole])
    assert all(p.num_rows <= PIECE_ROWS and (p.nbytes <= PIECE_BYTES or p.num_rows == 1) for p in found)
    signed = list(jaccard_join.forest(Rows(), 5, 24, 8, 6)(iter([whole])))
    assert [m for b in signed for m in b.column(0).to_pylist()] == marks and max(b.num_rows for b in signed) <= PIECE_ROWS


def test_prefix_is_shortened_to_the_recall():
    assert jaccard_join.prefix_depth(24, 8, 0.8, 0.999) == 6
    assert jaccard_join.prefix_depth(24, 8, 0.8, 0.5) == 8
    assert jaccard_join.prefix_depth(1, 8, 0.8, 0.99) == 1


# decontamination


def test_contamination_equals_plain_version(spark, odd):
    rng = random.Random(9)
    word = lambda: rng.choice(["a", "B", "cc", "É", "é", "1", "x9"])
    items = [(i, " ".join(word() for _ in range(n))) for i, n in enumerate((0, 1, 3, 12, 13, 14, 30))] + [(7, None), (4, "zz zz zz"), (10, "zz ZZ zz")]
    docs = [(i, " -- ".join(word() for _ in range(rng.randint(0, 60)))) for i in range(60)] + [(i, f"pre {items[i % 7][1]}! post {items[6][1]}") for i in range(60, 80)] + [(80, "zz zz zz zz"), (81, None), (None, "zz zz zz")]

    def split(text):
        low = "".join(c.lower() if c.isascii() else c for c in text or "")
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)

    got = {r["doc_id"]: r for r in decontaminate.contamination(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    for doc, text in docs:
        w, hit, which = split(text), set(), set()
        for item, body in items:
            v = split(body)
            size = min(13, len(v))
            for i in range(len(v) - size + 1 if v else 0):
                for j in range(len(w) - size + 1):
                    if w[j : j + size] == v[i : i + size]:
                        hit |= set(range(j, j + size))
                        which.add(str(item))
        row = got[doc]
        assert (row["n_words"], row["n_hit"], row["n_items"], row["items"]) == (len(w), len(hit), len(which), sorted(which)), doc
        assert row["contaminated"] == (len(hit) > 0 and 20 * len(hit) >= len(w))
    bench = odd.select(F.col("doc_id").alias("item_id"), F.lit("in a copied text").alias("text"), "key", "word")
    assert decontaminate.contamination(odd, bench).where("contaminated").count() == 4
    kept = decontaminate.clean_documents(odd, bench)
    assert kept.columns == odd.columns and kept.count() == odd.count() - 4
    assert decontaminate.clean_documents(odd, bench.limit(0)).count() == odd.count()
    assert decontaminate.contamination(odd.limit(0), bench).count() == 0


def test_many_items_shuffle_rare_words_only(spark, monkeypatch):
    """Beyond the broadcast bound the same rows result, and only places of prefix tokens are shuffled."""
    docs = spark.createDataFrame([(i, " ".join(f"common{j % 5}" for j in range(200)) + f" rare{i} tail{i}") for i in range(40)], "doc_id long, text string")
    items = spark.createDataFrame([(i, f"common1 common2 common3 common4 rare{i} tail{i}") for i in range(0, 40, 2)], "item_id long, text string")
    want = lines(decontaminate.contamination(docs, items))
    assert sum(r[2] > 0 for r in want) == 20
    vocabulary = spark.createDataFrame([("common1",), ("rare3",), ("none",)], "word string")
    words = docs.select(F.col("doc_id").alias("mark"), decontaminate.words_of(F.col("text")).alias("w"))
    counts = lines(decontaminate.word_counts(words, vocabulary))
    monkeypatch.setattr("tidewell.llm.common.BROADCAST_BYTES", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert lines(decontaminate.contamination(docs, items)) == want
        assert lines(decontaminate.word_counts(words, vocabulary)) == counts == [("common1", 1600), ("rare3", 1)]
        monkeypatch.setattr(decontaminate, "fits_broadcast", lambda *a: False)
        monkeypatch.setattr("tidewell.llm.common.BROADCAST_BYTES", 1_000)
        prefixes = spark.createDataFrame([("rare3", 1)], "word string, off int")
        plan = decontaminate.prefix_places(words, prefixes)._jdf.queryExecution().executedPlan().toString()
        assert plan.index("BroadcastHashJoin") > plan.index("Exchange hashpartitioning") and "LeftSemi" in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_decontamination_stays_in_the_jvm(odd):
    plan = decontaminate.contamination(odd, odd.where("doc_id < 6").select(F.col("doc_id").alias("item_id"), "text"))._jdf.queryExecution().toString()
    plan += exact_dedup.exact_duplicates(odd)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|InArrow", plan)


# pages

PAGE = """<!doctype html><html><head><title>T</title><style>p{}</style><script>var t="</p><article>";</script></head><body class="menu-open"><header>Site</header><nav><a>Home</a></nav>
<div class="cookie-notice">We use <b>cookies</b></div><article><h1>Head&amp;line</h1><p>One &lt;b&gt;  two<br>three&nbsp;four<p>Fi<b>ve</b><div class="ad">Buy</div><ul><li>six</li><li>seven</li></ul><form>Name<input></form>
<section id="comments"><p>First!</p></section><aside>More</aside></article><footer>&copy; x</footer></body></html>"""


def test_blocks():
    assert [t for t, core in html_text.blocks_of(PAGE) if core] == ["Head&line", "One <b> two three four", "Five", "six", "seven"]
    assert html_text.blocks_of(None) == [] and html_text.blocks_of("a < b") == [("a < b", False)]
    assert html_text.blocks_of("<p>open <script>never closed") == [("open", False)]
    assert html_text.blocks_of("<p title='a>b'>x</p>") == [("x", False)]


@pytest.mark.parametrize(
    "inside, expected",
    [
        ('<p class="ad">Buy</p><p>kept</p>', ["kept"]),
        ('<p class="cookie-notice">We use<p>kept', ["kept"]),
        ('<ul><li class="comment">First <b>one</b><ul><li>reply</li></ul>more</li><li>kept</li></ul>', ["kept"]),
        ('<ul><li class="ad">x<li>kept</ul>', ["kept"]),
        ('<h2 class="related">See also</h2><p>kept', ["kept"]),
        ('<blockquote class="newsletter-signup"><p>Join</p><p>us</p></blockquote>kept', ["kept"]),
        ('<table><tr class="advert"><td>x<td>y<tr><td>kept</table>', ["kept"]),
        ('<dl><dt>kept<dd class="share-buttons">x<dt>too</dl>', ["kept", "too"]),
        ('<div class="related-work"><p>kept</p></div>', ["kept"]),
        ('<p class="notice-period">kept</p><section id="form-of-government">too</section>', ["kept", "too"]),
        ('<div class="ad_slot-2"><p>x</div><div id="user-comments"><p>y</p></div><p class="text">kept', ["kept"]),
        ('<p>one<span class="ad">x</span> two<hr>three</p>', ["one two", "three"]),
    ],
)
def test_names_on_any_block(inside, expected):
    """Whole names judge, on every block element, with the end tags that HTML lets out."""
    assert [t for t, core in html_text.blocks_of(f"<body><nav>menu</nav><article>{inside}</article><p>after") if core] == expected


def test_repeated_runs_are_removed(spark):
    """Without an article, what three pages of a host repeat goes and what is unique stays."""
    notice = "this long notice stands on every single page of the host"
    rows = [(i, f"http://h.org/{i}", f"<div>{notice}</div><p>unique text number {i} of page {i * 7} is kept</p>", "x") for i in range(5)]
    rows += [(None, None, None, "x"), (9, "http://other.org/", f"<p>{notice}</p>", "x"), (9, "http://other.org/", f"<p>{notice}</p>", "x"), (10, "http://h.org/a", PAGE, "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, host string")
    for size in (4_000_000, 10**9):
        got = {r["page_id"]: r["text"] for r in html_text.extract_text(pages, block_chars=size).collect()}
        assert all(got[i] == f"unique text number {i} of page {i * 7} is kept" for i in range(5))
        assert got[9] == notice and got[None] == "" and got[10].startswith("Head&line")
    assert html_text.extract_text(pages, block_chars=50).count() == len(rows) and html_text.extract_text(pages.limit(0)).count() == 0


def test_parts_of_a_host_count_together(spark):
    """A notice on fewer than three pages of every part goes as it does in one block; one on two pages of the host stays."""
    notice, rare = "this long notice stands on a few pages of the host", "only two pages of this host carry the other notice"
    rows = [(i, f"http://h.org/{i}", f"<div>{notice if i % 10 == 0 else f'page {i} has its own words here and {i * 7} no more'}</div><p>unique text number {i} of page {i * 3} is kept</p>") for i in range(60)]
    rows += [(i, f"http://h.org/{i}", f"<p>{rare}</p>") for i in (60, 61)] + [(62, "http://h.org/62", None), (63, "http://h.org/63", PAGE)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    whole, dealt = ({r["page_id"]: r["text"] for r in html_text.extract_text(pages, block_chars=size).collect()} for size in (10**9, 150))
    assert dealt == whole and len(dealt) == len(rows)
    assert dealt[10] == "unique text number 10 of page 30 is kept" and dealt[60] == rare


@settings(max_examples=40, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abc"), max_size=12), min_size=1, max_size=5), st.integers(1, 5), st.integers(1, 3))
def test_cover_equals_plain_version(streams, length, pages):
    got = html_text.repeated_cover(streams, length, pages)
    for n, s in enumerate(streams):
        want = [False] * len(s)
        for i in range(len(s) - length + 1):
            if sum(any(t[j : j + length] == s[i : i + length] for j in range(len(t) - length + 1)) for t in streams) >= pages:
                want[i : i + length] = [True] * length
        if sum(map(len, streams)) + len(streams) > length:
            assert got[n].tolist() == want


# training order


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 3000), st.integers(0, 2**40))
def test_permutation(total, key):
    index = np.arange(total)
    slots = token_output.permute(index, total, key)
    assert sorted(slots.tolist()) == index.tolist()
    assert (token_output.permute(slots, total, key, inverse=True) == index.astype(np.uint64)).all()


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab1'st .\n\t\u00a0\u3000é漢\x1f", max_size=80), st.integers(1, 12))
def test_pieces_have_the_ids_of_the_whole_text(text, most):
    whole = token_output.encoder(token_output.VOCABULARY).encode_ordinary(text)
    assert token_output.token_ids(text, token_output.VOCABULARY, most) == whole


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.characters(max_codepoint=0x260, exclude_categories=["Cs"]), max_size=60))
def test_ids_are_those_of_the_whole_pattern(text):
    """Texts with and without runs of white space."""
    for some in (text, token_output.RUN.sub(" ", text)):
        assert token_output.token_ids(some, token_output.VOCABULARY) == token_output.encoder(token_output.VOCABULARY).encode_ordinary(some)


def test_long_texts_are_not_cut_inside_words():
    for text in ("internationalization, " * 12_000, "x" * 250_000 + " end", "word " * 41_000 + "\n" * 300):
        assert token_output.token_ids(text, token_output.VOCABULARY) == token_output.encoder(token_output.VOCABULARY).encode_ordinary(text)
    blank = "a" + " " * 1_000_000 + "b"  # more than the tokenizer takes in one piece
    assert token_output.encoder(token_output.VOCABULARY).decode(token_output.token_ids(blank, token_output.VOCABULARY)) == blank


def test_shards(odd, tmp_path):
    """Records at fixed offsets: reading on from any slot gives the same sequences."""
    ordered = token_output.training_order(odd, length=16, per_shard=500)
    rows = ordered.collect()
    assert [r["slot"] for r in rows] == list(range(len(rows)))
    manifest = token_output.write_shards(ordered, str(tmp_path / "out")).collect()
    assert sum(m["rows"] for m in manifest) == len(rows) and sorted(os.listdir(tmp_path / "out")) == sorted(os.path.basename(m["file"]) for m in manifest)
    for r in rows[:: max(1, len(rows) // 50)]:
        with open(tmp_path / "out" / f"shard-{r['shard']:08d}.bin", "rb") as file:
            file.seek(r["byte_offset"])
            assert file.read(32) == bytes(r["tokens"])
    decode = token_output.encoder(token_output.VOCABULARY).decode
    for doc, text in ((7, odd.where("doc_id = 7").first()["text"]),):
        parts = sorted((r["part"], r) for r in rows if r["doc_id"] == doc)
        ids = [i for _, r in parts for i in memoryview(bytes(r["tokens"])).cast("H").tolist()[: r["n_tokens"]]]
        assert decode(ids[:-1]) == text
    assert {r["doc_id"] for r in rows} == {None, 3, 4, 5, 6, 7, 8}
    assert token_output.training_order(odd.limit(0)).count() == 0


def test_written_shards_hold_the_order(spark, odd, tmp_path):
    """The stage's rows point into files that exist, and hold what those files hold."""
    import hashlib

    import corpus_pipeline

    rows = corpus_pipeline.order(spark, odd, "").collect()
    plain = token_output.training_order(odd).collect()
    assert [r["slot"] for r in rows] == [r["slot"] for r in plain] == list(range(len(rows)))
    for r in rows:
        with open(r["file"].removeprefix("file:"), "rb") as file:
            data = file.read()
        assert data[r["byte_offset"] :][:1024] == bytes(r["tokens"]) and r["sha256"] == hashlib.sha256(data).hexdigest()
    some = token_output.written_order(odd, length=16, per_shard=500, folder=str(tmp_path / "out")).collect()
    assert [r["slot"] for r in some] == list(range(len(some))) and len({r["file"] for r in some}) == len(os.listdir(tmp_path / "out")) == -(-len(some) // 500)
    assert token_output.written_order(odd.limit(0)).count() == 0


# collocations


def plain_collocations(rows, longest=3, least=10, covered=50, top=2000):
    pieces, freq, total = [], {}, {}
    for lang, text in rows:
        low = "".join(c.lower() if c.isascii() else c for c in text or "")
        pieces += [(lang or "und", re.findall(r"[^\x20\x09]+", p)) for p in re.split(r"[.,;:!?\x0A-\x0D]", low)]
    for lang, w in pieces:
        total[lang] = total.get(lang, 0) + len(w)
        for size in range(1, longest + 1):
            for s in range(len(w) - size + 1):
                freq[lang, tuple(w[s : s + size])] = freq.get((lang, tuple(w[s : s + size])), 0) + 1
    found = {k: a for k, a in freq.items() if len(k[1]) > 1 and a >= least}
    out = {}
    for (lang, w), a in found.items():
        score, k = min((1000000 * a * a // (freq[lang, w[:k]] * freq[lang, w[k:]]), k) for k in range(1, len(w)))
        inside = [b for (other, x), b in found.items() if other == lang and len(x) > len(w) and any(x[i : i + len(w)] == w for i in range(len(x)))]
        if not any(100 * b >= covered * a for b in inside):
            out.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), a, freq[lang, w[:k]], freq[lang, w[k:]]))
    return sorted((lang, rank, p.decode(), a, l, r, total[lang], -score) for lang, v in out.items() for rank, (score, _, p, a, l, r) in enumerate(sorted(v)[:top], 1))


@pytest.mark.parametrize("options", [{}, {"longest": 4, "least": 3, "top": 7}, {"longest": 2, "modulus": 1}, {"least": 2, "covered": 101, "modulus": 2}])
def test_collocations_equal_plain_version(frame, options):
    from tidewell.llm.collocations import collocations

    rng = random.Random(4)
    words = ["a", "b", "Cd", "é", "x\x1cy", "İ", "d", "und"]
    texts = [("".join(rng.choice(words) + rng.choice([" ", " ", " ", "\t", "  ", ". ", "\n", ",", "\x0b"]) for _ in range(rng.randrange(60))), rng.choice(["en", "en", "fr", None, "und"])) for _ in range(120)]
    rows = [(n, t, lang, None) for n, (t, lang) in enumerate(texts)] + [(1, None, "en", None), (1, "", "xx", None), (2, " ... ", None, None), *[(3, "same words here " * 40, "en", None)] * 9]
    plain = {k: v for k, v in options.items() if k != "modulus"}
    got = [tuple(r) for r in collocations(frame(rows), **options).collect()]
    assert sorted(got) == plain_collocations([(r[2], r[1]) for r in rows], **plain)
    assert collocations(frame([]), **options).collect() == []


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text(alphabet="ab .\t\nB", max_size=40), max_size=5), st.integers(1, 3), st.integers(1, 4))
def test_chunks_put_together_are_the_pieces(texts, overlap, modulus):
    """Without the overlaps, the chunks of a text give its pieces word by word; every chunk but a last one ends in its overlap."""
    from tidewell.llm.collocations import parse

    chunks, last, owner = parse([t.encode() for t in texts], overlap, modulus)
    for n, text in enumerate(texts):
        mine = []
        for chunk, end, own in zip(chunks, last, owner):
            if own == n:
                w = chunk.decode().split()
                mine += w if end else w[: len(w) - overlap]
        assert mine == text.lower().replace(".", " ").split()


def test_large_collocation_products(frame):
    """Counts whose products pass 64 bits."""
    from tidewell.llm.collocations import score

    a, l, r = 3_000_000_000_000, 5_000_000_000_001, 4_000_000_000_003
    found = frame([]).sparkSession.range(1).select(F.lit(a).alias("a"), F.lit(l).alias("l"), F.lit(r).alias("r"))
    assert found.select(score()).first()[0] == 1_000_000 * a * a // (l * r)


# exact vector search


def plain_neighbours(rows, k, every=50):
    ok = {}
    for key, v in rows:
        if key is not None and v and all(x is not None and math.isfinite(x) for x in v):
            v = [math.floor(256 * float(x)) for x in v]
            ok[key] = min(v, ok.get(key, v))
    out = []
    for q, a in ok.items():
        if q % every == 0:
            found = sorted((-sum(x * y for x, y in zip(a, b)), key) for key, b in ok.items() if key != q and len(a) == len(b))
            out += [(q, rank, key, -score) for rank, (score, key) in enumerate(found[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("bits", [1, 6])
def test_vector_search_equals_brute_force(spark, monkeypatch, bits):
    """Several small blocks, a hot vector, ties, keys below zero, vectors of two lengths, large numbers, and rows that take no part."""
    from tidewell.llm import vector_search

    monkeypatch.setattr(vector_search, "VECTORS", 60)
    monkeypatch.setattr(vector_search, "QUERIES", 4)
    rng = random.Random(9)
    rows = [(n, [rng.gauss(0, 0.3) for _ in range(6)]) for n in range(-100, 260)]
    rows += [(n, [0.9, 0.1, 0.0, 0.0, 0.0, 0.2]) for n in range(300, 460)]
    rows += [(n, [rng.choice([-1e6, 3e6, 0.5]) for _ in range(3)]) for n in range(500, 560)]
    rows += [(600, None), (601, []), (602, [math.nan] * 6), (650, [math.inf] + [0.0] * 5), (604, [None] * 6), (None, [0.1] * 6), (50, [0.0] * 6), (50, [0.0] * 6), (700, [1.0])]
    table = spark.createDataFrame([(key, v, 1, "z", 0.5) for key, v in rows], "vec_id long, embedding array<double>, score int, v string, query double")
    got = vector_search.search_vectors(table, bits=bits)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, got.collect())) == plain_neighbours(rows, 5)
    assert vector_search.search_vectors(table.limit(0)).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 8), st.integers(1, 30), st.integers(1, 5), st.integers(0, 2**32), st.sampled_from([3, 300, 2**25, 2**40]))
def test_bounds_hold(bits, n, dim, seed, most):
    from tidewell.llm.vector_search import bounds, quantise

    rng = np.random.default_rng(seed)
    v, q = rng.integers(-most, most + 1, (n, dim)), rng.integers(-most, most + 1, (3, dim))
    cells, low, high = quantise(v, bits)
    across = np.arange(dim)
    assert (low[cells, across] <= v).all() and (v <= high[cells, across]).all() and cells.max() < 2**bits
    lower, upper = bounds(q, cells, low, high)
    for i in range(3):
        for j in range(n):
            true = sum(int(a) * int(b) for a, b in zip(q[i], v[j]))
            assert lower[i, j] <= true <= upper[i, j]


def test_few_vectors_are_read(spark, small, tmp_path):
    """Bounds leave out most vectors: the candidates of a query are a small part of all, exact reads still fewer."""
    from tidewell.llm import vector_search
    from tidewell.llm.common import table

    vectors = table(spark, small.replace("sf0.001", "sf0.1"), "embeddings")
    whole = vector_search.whole_vectors(vectors, "vec_id", "embedding", 256)
    found = vector_search.equal_classes(whole, 5).cache()
    queries = found.where("least % 50 = 0")
    one = F.lit(1).cast("long")
    file = vector_search.approximation_file(found, one, 6)
    near = vector_search.scan(queries, file, one, one, 6)
    assert near.count() < 0.1 * queries.count() * found.count()


# ranked lexical search


def plain_ranking(docs, items, k):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", "".join(c.lower() if c.isascii() else c for c in t or ""))
    texts = [(key, split(t)) for key, t in docs if split(t)]
    total, words, df = len(texts), sum(len(w) for _, w in texts), {}
    for _, w in texts:
        for t in set(w):
            df[t] = df.get(t, 0) + 1
    asked = {}
    for item, t in items:
        asked.setdefault(item, set()).update(split(t))
    out = []
    for item, terms in asked.items():
        found = []
        for key, w in texts:
            m = 50 + 50 * len(w) * total // words
            score = sum(math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * (10**9 * w.count(t) // (1000 * w.count(t) + 20 * m)) for t in terms if t in w)
            if score > 0:
                found.append((-score, key is None, key or 0, key))
        out += [(item, rank, key, -score) for rank, (score, _, _, key) in enumerate(sorted(found)[:k], 1)]
    return out


@pytest.mark.parametrize("options", [{"k": 5}, {"k": 50, "block": 1, "postings_per_task": 300}, {"k": 3, "block": 7, "postings_per_task": 50}])
def test_ranked_search_equals_plain_version(frame, spark, monkeypatch, options):
    from tidewell.llm import ranked_search

    monkeypatch.setattr(ranked_search, "ASKED", 12)  # several blocks of items
    rng = random.Random(2)
    words = ["The", "the", "é", "x1", "a-b", "İ", "of", "cat", "sat", "naïve", "q_r"]
    docs = [(n, " ".join(rng.choice(words) for _ in range(rng.randrange(1, 30))), "en", None) for n in range(150)]
    docs += [(n, "the cat sat of copies", None, None) for n in range(200, 260)] + [(None, "the cat sat of copies", "en", None)] * 2 + [(7, "the cat", "en", None)] * 2 + [(1, None, None, None), (2, "", None, None), (3, "... --", "en", None)]
    docs += [(300, "cat " * 50_000 + "sat", "en", None)]
    items = [("b", "The cat"), ("a", "é x1 x1 unknown"), (None, "sat of"), ("b", "naïve"), ("e", ""), ("n", None), ("z", "nowhere")]
    table = spark.createDataFrame([(i, t, 1, "s") for i, t in items], "item_id string, text string, score int, item string")
    got = ranked_search.ranked_search(frame(docs), table, **options)
    key = lambda r: (str(r[0]), r[1])
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=key) == sorted(plain_ranking([(d[0], d[1]) for d in docs], items, options["k"]), key=key)
    assert ranked_search.ranked_search(frame([]), table).collect() == []
    assert ranked_search.ranked_search(frame(docs), table.limit(0)).collect() == []


@settings(max_examples=40, deadline=None)
@given(st.integers(1, 40), st.integers(1, 12), st.integers(1, 9), st.integers(0, 2**32), st.integers(1, 6))
def test_blocks_skip_no_result(n, size, block, seed, k):
    """For any shard, level and block size, the search finds exactly the documents that reach the level, and stored summaries read back."""
    from tidewell.llm.ranked_search import Asked, Shard

    rng = np.random.default_rng(seed)
    rows = [np.flatnonzero(rng.random(size) < 0.4) for _ in range(n)]
    asked = Asked([np.flatnonzero(rng.random(size) < 0.5) for _ in range(3)], size)
    bounds, terms = np.cumsum([0, *map(len, rows)]), np.concatenate(rows).astype(np.int64)
    impacts = rng.integers(1, 50, len(terms))
    made = Shard(bounds, terms, impacts, asked, block)
    again = Shard(bounds, terms, impacts, asked, block, made.stored())
    for item in range(3):
        every = made.scores(item, np.arange(n))
        pilot = made.pilot(item, k)
        assert set(pilot) <= set(every) and len(pilot) <= k
        for level in (1, 30, int(pilot[-1]) if len(pilot) else 2):
            docs, scores, looked = again.search(item, level)
            assert docs.tolist() == np.flatnonzero(every >= level).tolist() and scores.tolist() == every[docs].tolist() and looked <= n


def test_reading_resumes_at_any_slot(odd, tmp_path):
    """What is read from a slot on equals the rest of a whole reading; a changed file fails."""
    whole = token_output.written_order(odd, length=16, per_shard=500, folder=str(tmp_path / "a")).collect()
    for start in (0, 1, 499, 500, len(whole) - 1, len(whole)):
        rest = token_output.written_order(odd, length=16, per_shard=500, folder=str(tmp_path / f"b{start}"), start=start)
        assert [(r["slot"], bytes(r["tokens"])) for r in rest.collect()] == [(r["slot"], bytes(r["tokens"])) for r in whole[start:]]


def test_folders_without_a_scheme_belong_to_the_default_file_system(spark):
    assert token_output.shared_folder(spark, "/some/folder") == "file:/some/folder"
    assert token_output.shared_folder(spark, "file:/some/folder") == "file:/some/folder"


def test_only_unmoved_files_are_read_twice(spark, small, monkeypatch):
    """Rows whose partitions could differ from one reading to the next are written before they are numbered."""
    from tidewell.llm.common import table

    written = []
    monkeypatch.setattr(token_output, "materialize", lambda df, name: written.append(name) or df)
    docs = table(spark, small, "documents")
    token_output.fixed_texts(docs.where("lang = 'en'"), "doc_id", "text")
    assert written == []
    token_output.fixed_texts(docs.repartition(3), "doc_id", "text")
    assert written == ["texts"]


def test_ids_come_as_bytes_and_are_those_of_the_whole_pattern():
    """Ids handed on as bytes, without Python numbers, whatever white space there is; the unused special token is ordinary text."""
    from tidewell.llm import token_output

    plain = token_output.encoder(token_output.VOCABULARY)
    for text in ["", "a b", "a  b", "a  b", "a 　 b\n", "café  olé", "x\t\ny", "\ud800 lone", f"a {token_output.UNUSED} b", "\U0001f600 \U0001f600"]:
        assert np.frombuffer(token_output.packed_ids(text, token_output.VOCABULARY), dtype=np.uint32).tolist() == plain.encode_ordinary(text), text
    assert token_output.holds_run("a \tb") and token_output.holds_run("a　 b") and not token_output.holds_run("a　b é c ")
