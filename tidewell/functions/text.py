"""Text expressions: entity decoding, markup removal, sections, answers.

`WS` lists the characters that count as white space in Unicode-aware text handling; it is spelled out because
the plain ``\\s`` class of the JVM covers ASCII only.
"""

from __future__ import annotations

import html
import json
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewell.functions.exprs import ColumnLike, as_col, let

WS = r"\t-\r\x1c-\x20\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
WS_CHARS = "".join(chr(c) for c in (*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000))
HAN = r"\x{4e00}-\x{9fff}"

NUMERIC_ENTITY = r"&#(?:[0-9]+|[xX][0-9a-fA-F]+);?"
NAMED_ENTITY = r"&[A-Za-z][A-Za-z0-9]*;?"
# The references nearly all texts are limited to, `&amp;` last.
EVERYDAY = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&nbsp;": "\xa0", "&amp;": "&"}
ENTITY_TOKEN = rf"{NUMERIC_ENTITY}|{NAMED_ENTITY}|[^&]+|&"


def entity_table() -> dict[str, str]:
    """Named character references of HTML, from the standard library's own table."""
    return {f"&{name}": text for name, text in html5.items()}


def low_numeric_table() -> dict[int, str]:
    """Code points below 160, where HTML remaps or drops control characters."""
    return {code: html.unescape(f"&#{code};") for code in range(160)}


def unescape_html(text: ColumnLike) -> Column:
    """Decode named and numeric character references in one pass over the text.

    Texts with nothing but the everyday references take a short way of plain replacements; `&amp;` comes last
    there, so nothing is decoded twice.
    """
    named = F.from_json(F.lit(json.dumps(entity_table())), "map<string,string>")
    low = F.from_json(F.lit(json.dumps([t for _, t in sorted(low_numeric_table().items())])), "array<string>")

    def numeric(token: Column) -> Column:
        digits = F.regexp_extract(token, r"^&#[xX]?([0-9a-fA-F]+);?$", 1)
        significant = F.regexp_replace(digits, "^0+(?=.)", "")
        radix16 = F.conv(significant, 16, 10).cast("long")
        radix10 = F.conv(significant, 10, 10).cast("long")
        code = F.when(F.length(significant) > 9, F.lit(0x110000)).otherwise(
            F.when(token.rlike("^&#[xX]"), radix16).otherwise(radix10)
        )
        wide = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
        bad = (code > 0x10FFFF) | code.between(0xD800, 0xDFFF)
        return F.when(bad, F.lit("�")).when(code < 160, F.try_element_at(low, (code + 1).cast("int"))).otherwise(wide)

    def decode(token: Column) -> Column:
        return (
            F.when(~token.startswith("&") | (F.length(token) == 1), token)
            .when(token.rlike("^&#"), numeric(token))
            .otherwise(F.coalesce(F.try_element_at(named, token), _longest_prefix(named, token)))
        )

    def choose(source: Column) -> Column:
        tokens = F.regexp_extract_all(source, F.lit(ENTITY_TOKEN), F.lit(0))
        full = F.array_join(F.transform(tokens, decode), "")
        short = source
        for token, plain in EVERYDAY.items():
            short = F.replace(short, F.lit(token), F.lit(plain))
        left_over = F.regexp_replace(source, "|".join(EVERYDAY), "")
        return F.when(~source.contains("&"), source).when(~left_over.rlike("&[#A-Za-z]"), short).otherwise(full)

    return let(as_col(text), choose)


def _longest_prefix(named: Column, token: Column) -> Column:
    """A reference written without its semicolon: decode the longest known prefix, keep the rest."""
    known = [f"&{name}" for name in html5 if not name.endswith(";")]
    pattern = "^(?:" + "|".join(sorted(known, key=lambda k: (-len(k), k))) + ")"
    prefix = F.regexp_extract(token, pattern, 0)
    decoded = F.concat(F.try_element_at(named, prefix), F.substr(token, F.length(prefix) + 1))
    return F.when(prefix == "", token).otherwise(decoded)


def strip_markup(text: Column) -> Column:
    """Tags and quoted attribute remains become single spaces.

    Texts without the marks skip the patterns, and attribute names never backtrack.
    """
    name = rf"(?U)\b[a-zA-Z_-]{{2,}}+[{WS}]*=[{WS}]*"

    def attributes(t: Column) -> Column:
        out = F.regexp_replace(t, rf'{name}"[^"]*"', " ")
        return F.when(t.contains("="), F.regexp_replace(out, rf"{name}'[^']*'", " ")).otherwise(t)

    tags = let(text, lambda t: F.when(t.contains("<"), F.regexp_replace(t, r"<[^>]+>", " ")).otherwise(t))
    return let(tags, attributes)


def strip_ws(text: Column) -> Column:
    return F.btrim(text, F.lit(WS_CHARS))


def squeeze_ws(text: Column) -> Column:
    return strip_ws(F.regexp_replace(text, rf"[{WS}]+", " "))


def sanitize_document(text: ColumnLike) -> Column:
    """Clean a document but keep its line structure."""
    out = strip_markup(F.replace(unescape_html(text), F.lit("﻿"), F.lit(" ")))
    out = F.regexp_replace(out, r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]", " ")
    out = F.regexp_replace(out, r"[\t\r]+", " ")
    out = F.regexp_replace(out, r" {2,}", " ")
    out = F.regexp_replace(out, r"\n{3,}", "\n\n")
    return strip_ws(F.replace(out, F.lit("�"), F.lit(" ")))


def sanitize_flat(text: ColumnLike) -> Column:
    """Clean a text down to one line without markdown marks."""
    out = strip_markup(unescape_html(F.coalesce(as_col(text), F.lit(""))))
    out = F.regexp_replace(out, r"[#*_`]+", " ")
    out = F.regexp_replace(out, r"={2,}|-{2,}|_{2,}", " ")
    out = F.regexp_replace(out, r"[\x00-\x1F\x7F]", " ")
    return squeeze_ws(F.replace(out, F.lit("�"), F.lit(" ")))


LINE_BREAK = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\x{2028}\x{2029}]"


def guess_section(text: ColumnLike, heading_lines: int = 8, width: int = 80) -> Column:
    """First heading among the leading non-empty lines, else the start of the first line."""

    def pick(lines: Column) -> Column:
        heads = F.filter(F.slice(lines, 1, heading_lines), lambda x: x.startswith("#"))
        heading = strip_ws(F.ltrim(F.try_element_at(heads, F.lit(1)), F.lit("#")))
        return (
            F.when(F.size(lines) == 0, F.lit("unknown"))
            .when(F.size(heads) > 0, heading)
            .otherwise(F.substring(F.try_element_at(lines, F.lit(1)), 1, width))
        )

    return let(F.filter(F.transform(F.split(as_col(text), LINE_BREAK), strip_ws), lambda x: x != ""), pick)


def markdown_to_plain(text: ColumnLike) -> Column:
    """Drop list bullets and emphasis, squeeze spaces, drop empty lines."""

    def tidy(line: Column) -> Column:
        line = F.regexp_replace(strip_ws(line), rf"^(?:[-*+][{WS}]+|[0-9]+[.)][{WS}]+)", "")
        return squeeze_ws(F.replace(F.replace(line, F.lit("**"), F.lit("")), F.lit("__"), F.lit("")))

    lines = F.split(as_col(text), LINE_BREAK)
    return F.array_join(F.filter(F.transform(lines, tidy), lambda x: x != ""), "\n")


# Fixed value: the sentence shown when no evidence was found.
FALLBACK_ANSWER = "当前检索到的证据不足，建议换一种问法，或补充文档后再试。"


def normalize_answer(text: ColumnLike) -> Column:
    """Drop citation marks and stuttered numbers, phrases and punctuation; close with a full stop."""
    return let(sanitize_flat(text), _normalize_flat)


def _normalize_flat(flat: Column) -> Column:
    out = F.regexp_replace(flat, r"\[C[0-9]+\]", "")
    out = squeeze_ws(F.regexp_replace(out, r"[#*_`]+", " "))
    out = F.regexp_replace(out, rf"(?U)(\b\d+(?:\.\d+)?\b)(?:[{WS}]+\1)+", "$1")
    out = F.regexp_replace(out, rf"([{HAN}]{{2,6}})\1+", "$1")
    out = F.regexp_replace(out, r"([。！？；，])\1+", "$1")
    closed = let(out, lambda o: F.when((o == "") | o.rlike("[。！？]$"), o).otherwise(F.concat(o, F.lit("。"))))
    return F.when(flat == "", F.lit(FALLBACK_ANSWER)).otherwise(closed)


def fit_answer(text: ColumnLike, max_len: int = 240, min_cut: int = 60) -> Column:
    """Cut after `max_len` visible characters, back to the last sentence end when one lies far enough in."""
    flat = squeeze_ws(F.coalesce(as_col(text), F.lit("")))
    visible = F.length(F.regexp_replace(flat, rf"[{WS}]+", ""))
    window = F.regexp_extract(flat, rf"^(?:[{WS}]*[^{WS}]){{{max_len}}}", 0)
    sentence = F.regexp_extract(window, r"^(?s:.*)[。！？；]", 0)
    closed = F.when(window.rlike("[。！？]$"), window).otherwise(F.concat(window, F.lit("。")))
    shortened = F.when(F.length(sentence) > min_cut, sentence).otherwise(closed)
    over = F.length(F.regexp_replace(shortened, rf"[{WS}]+", "")) > max_len
    clipped = F.regexp_extract(shortened, rf"^(?:[{WS}]*[^{WS}]){{{max_len}}}", 0)
    clipped = F.when(clipped.rlike("[。！？]$"), clipped).otherwise(F.concat(F.regexp_replace(clipped, r"(?s).$", ""), F.lit("。")))
    return F.when(visible <= max_len, flat).when(over, clipped).otherwise(shortened)


def low_quality_answer(question: ColumnLike, answer: ColumnLike) -> Column:
    """True for an empty answer, or one to a Chinese question that looks garbled."""
    q, a = F.coalesce(as_col(question), F.lit("")), F.coalesce(as_col(answer), F.lit(""))
    compact = F.regexp_replace(a, rf"[{WS}]+", "")
    latin = F.length(F.regexp_replace(compact, "[^A-Za-z]", ""))
    garbled = (
        (compact == "")
        | (F.try_divide(latin.cast("double"), F.length(compact).cast("double")) > 0.30)
        | a.rlike(rf"(?U)(\d+[{WS}]*天).{{0,6}}\1")
        | a.rlike(r"(?U)\d{3,}")
        | a.contains("助手")
        | F.lower(a).contains("assistant")
        | a.rlike(rf"(?U)\d[{WS}]*,[{WS}]*\d")
        | compact.rlike(r"(.{4,12})\1{1,}")
    )
    return (a == "") | (q.rlike(rf"[{HAN}]") & garbled)
