"""Secret scans: fixed patterns, and decoded base64 or hex candidates whose inner structure is confirmed."""

from __future__ import annotations

import base64
import binascii
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The base patterns, in the order of their kinds.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "signed_token", "pem_key", "der_key", "ssh_key")
#: Any dotted part that two others follow; matches overlap.
SIGNED = re.compile(r"(?<![A-Za-z0-9_-])(?=([A-Za-z0-9_-]{8,}+)\.([A-Za-z0-9_-]{2,}+)\.([A-Za-z0-9_-]*+))")
#: An armoured key; its lines may be escaped, quoted, indented or marked as a comment.
PEM = re.compile(r"-----BEGIN ([A-Z0-9 ]*PRIVATE KEY)-----((?:[A-Za-z0-9+/=\s>\"',;#*|]++|\\+[nrt])++)-----END \1-----")
MARKS = re.compile(r"\\+[nrt]|[^A-Za-z0-9+/=]+")
BASE64 = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{40,}+={0,2}")
#: Lines that carry a candidate on: a line break, written out or escaped, quote or indent marks, more base64.
MORE_LINES = re.compile(r"(?:(?:\\+[rn]|[\r\n])++[\x20\t>]*+[A-Za-z0-9+/]++)++={0,2}")
LINE_END = re.compile(r"(?:\\+[rn]|[\r\n])+[\x20\t>]*")
#: Where a key can begin in a candidate: the first bytes of a sequence, of the ssh magic, or of an armoured key.
KEY_START = re.compile(r"(?=M[A-P]|b3BlbnNzaC1rZXktdjEA|LS0tLS1CRUdJTi)")
HEX_ANY = re.compile(r"(?<![0-9A-Fa-f])[0-9A-Fa-f]{80,}")
SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")


def decode64(text: str) -> bytes | None:
    body = re.sub(r"\s+", "", text).rstrip("=").replace("-", "+").replace("_", "/")
    try:
        return base64.b64decode(body + "=" * (-len(body) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def der_element(data: bytes | memoryview, at: int, end: int) -> tuple[int, int, int] | None:
    """(tag, content start, content end) of the element at a place, if its length fits."""
    if at + 2 > end:
        return None
    tag, size, at = data[at], data[at + 1], at + 2
    if size & 0x80:
        width = size & 0x7F
        if not 1 <= width <= 4 or at + width > end:
            return None
        size, at = int.from_bytes(data[at : at + width], "big"), at + width
    return (tag, at, at + size) if at + size <= end else None


def is_der_key(data: bytes | memoryview) -> bool:
    """One outer sequence that fills the bytes, whose parts fill it, starting with a small version number and holding a
    large integer, an octet string or an algorithm sequence: the shapes of RSA, EC and PKCS#8 private keys."""
    outer = der_element(data, 0, len(data))
    if not outer or outer[0] != 0x30 or outer[2] != len(data):
        return False
    tags, at = [], outer[1]
    while at < outer[2]:
        part = der_element(data, at, outer[2])
        if not part:
            return False
        tags.append((part[0], part[2] - part[1]))
        at = part[2]
    if len(tags) < 3 or tags[0] != (0x02, 1):
        return False
    return tags[1][0] == 0x02 and tags[1][1] >= 32 or tags[1][0] == 0x04 and tags[1][1] >= 16 or tags[1][0] == 0x30 and tags[2][0] == 0x04


def is_ssh_key(data: bytes | memoryview) -> bool:
    """The magic of the format, then length-prefixed strings that stay inside."""
    magic = b"openssh-key-v1\0"
    if data[: len(magic)] != magic:
        return False
    at = len(magic)
    for _ in range(3):
        if at + 4 > len(data):
            return False
        at += 4 + int.from_bytes(data[at : at + 4], "big")
    return at <= len(data)


def is_signed_token(head: str, body: str) -> bool:
    try:
        first = json.loads(decode64(head) or b"")
        return isinstance(first, dict) and isinstance(first.get("alg"), str) and isinstance(json.loads(decode64(body) or b""), dict)
    except (ValueError, RecursionError):
        return False


def key_in(candidate: str) -> tuple[int, int, int] | None:
    """(start, end, kind number) of the first key inside a base64 candidate. Text before or after it may have joined the candidate, so
    every place with a key's first bytes is tried, and a key ends where its own length says; the candidate is decoded
    once for each of the four alignments."""
    decoded: dict[int, bytes | None] = {}
    body = candidate.rstrip("=")
    for found in KEY_START.finditer(body):
        at = found.start()
        if len(body) - at < 40:
            break
        shift = at % 4
        if shift not in decoded:
            whole = len(body) - (len(body) - shift) % 4
            decoded[shift] = decode64(body[shift:] if (len(body) - shift) % 4 != 1 else body[shift:whole])
        if not decoded[shift]:
            continue
        data = memoryview(decoded[shift])[(at - shift) // 4 * 3 :]
        size, kind = key_size(data)
        if size:
            end = at + (4 * size + 2) // 3
            while end < len(candidate) and candidate[end] == "=":
                end += 1
            return at, end, kind
    return None


def key_size(data: memoryview) -> tuple[int, int]:
    """(bytes, kind number) of the key that the bytes start with; no bytes if there is none."""
    outer = der_element(data, 0, len(data))
    if outer and outer[0] == 0x30 and is_der_key(data[: outer[2]]):
        return outer[2], 5
    if is_ssh_key(data):
        return len(data), 6
    if data[:10] == b"-----BEGIN":
        inner = PEM.match(bytes(data).decode("latin-1"))
        if inner and is_pem_key(inner[2]):
            return inner.end(), 4
    return 0, 0


def is_pem_key(body: str) -> bool:
    data = decode64(MARKS.sub("", body))
    return bool(data) and (is_der_key(data) or is_ssh_key(data))


def wrapped_key(text: str, start: int, end: int) -> tuple[int, int, int] | None:
    """The same for a candidate over several lines, with places in the text."""
    lines, at = [], start
    for cut in LINE_END.finditer(text, start, end):
        lines.append((at, cut.start()))
        at = cut.end()
    lines.append((at, end))
    found = key_in("".join(text[a:b] for a, b in lines))
    if not found:
        return None
    places, passed = [], 0
    for wanted in (found[0], found[1] - 1):
        passed = 0
        for a, b in lines:
            if wanted < passed + b - a:
                places.append(a + wanted - passed)
                break
            passed += b - a
    return places[0], places[1] + 1, found[2]


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the base patterns."""
    found = []
    low = text.lower()
    if any(k in low for k in KEYWORDS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def structural_spans(text: str) -> list[tuple[int, int, int]]:
    """Candidates that decode to a key or a signed token; all others are not reported."""
    found = []
    if "." in text:
        found += [(m.start(), 3, m.end(3)) for m in SIGNED.finditer(text) if is_signed_token(m[1], m[2])]
    if "-----BEGIN" in text:
        found += [(m.start(), 4, m.end()) for m in PEM.finditer(text) if is_pem_key(m[2])]
    armour = [(start, end) for start, kind, end in reversed(found) if kind == 4]  # the next one last
    joined = reported = 0  # ends of the last candidate of several lines, and of the last key
    for m in BASE64.finditer(text):
        while armour and armour[-1][0] <= m.start():
            reported = max(reported, armour.pop()[1])
        if m.start() < reported:
            continue
        more = MORE_LINES.match(text, m.end()) if m.start() >= joined and m.end() < len(text) and text[m.end()] in "\\\r\n" else None
        key = key_in(m[0])
        key = (m.start() + key[0], m.start() + key[1], key[2]) if key else None
        if more:
            joined = more.end()
            key = key or wrapped_key(text, m.start(), joined)
        if key:
            found.append((key[0], key[2], key[1]))
            reported = key[1]
    for m in HEX_ANY.finditer(text):
        if len(m[0]) % 2 == 0 and m[0].startswith("30") and is_der_key(bytes.fromhex(m[0])):
            found.append((m.start(), 5, m.end()))
    return sorted(set(found))


def render(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in sorted(spans))


def scan_secrets(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row: key, spans array<struct<kind,start,end>> (code points, end exclusive), base_spans and all_spans strings, counts.

    Row by row on Arrow batches, nothing is shuffled and the whole text is scanned; a candidate is decoded at most four times, and once more
    with the lines that continue it. NULL text
    is empty and has no span; NULL and repeated keys pass through; other columns are ignored.
    """
    kind = docs.schema[key].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: list[list] = [[], [], [], [], [], []]
            for body in batch.column(1).to_pylist():
                body = body or ""
                base = base_spans(body)
                every = sorted(base + structural_spans(body))
                counts = [sum(k == n for _, k, _ in base) for n in range(3)]
                for column, value in zip(columns, (*counts, render(base), render(every), [{"kind": KINDS[k], "start": s, "end": e} for s, k, e in every])):
                    column.append(value)
            arrays = [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), SPANS))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names=["key", "n_assign", "n_access", "n_hex", "base_spans", "all_spans", "spans"])

    schema = f"key {kind}, n_assign long, n_access long, n_hex long, base_spans string, all_spans string, spans array<struct<kind:string,start:long,end:long>>"
    found = docs.select(F.col(key).alias("key"), F.col(text).alias("body")).mapInArrow(scan, schema)
    return found.withColumnRenamed("key", key)
