"""Main text of web pages: structure marks the open blocks, a suffix array per host finds what pages repeat."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import join_small, materialize
from tidewell.llm.url_filter import host_of
from tidewell.llm.words import run_names, word_names

TOKEN = re.compile(r"""<!--|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>"']|"[^"]*"|'[^']*')*+)>|<[!?][^>]*>""")
ATTRIBUTE = re.compile(r"""(?:^|\s)(class|id|role|hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.IGNORECASE)
RAW = {t: re.compile(rf"</{t}\s*>", re.IGNORECASE) for t in ("script", "style", "title", "textarea", "noscript", "template", "iframe", "svg")}
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol p pre"
    " search section summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset({"hr"})
DROPPED = frozenset("nav footer aside form menu head button select dialog search fieldset object video audio canvas".split())
CORE = frozenset({"article", "main"})
CONTAINERS = frozenset("article main nav footer aside form menu head button select dialog search fieldset object video audio canvas header div section ul ol dl table figure details span".split())
#: Names of class, id or role that mark blocks outside the main text.
HINT = re.compile(
    r"ads?|advert\w*|sponsor\w*|promo\w*|banner\w*|cookies?|consent|gdpr|notices?|alerts?|popup\w*|modal\w*|overlay|side-?bar\w*|menu\w*|nav|navbar|navigation|bread-?crumbs?|footer\w*"
    r"|site-?header|page-?header|masthead|comments?|comment-?list|commentlist|disqus\w*|replies|respond|related\w*|share|sharing|social\w*|newsletter\w*|subscribe\w*|login|search\w*|contentinfo|complementary|form"
)
#: Parts that a longer name may have beside such a word; any other part (related-work, notice-period) makes it a name of content.
BESIDE = re.compile(
    r"[0-9x]*|area|articles?|author|bar|block|body|bottom|box|btn|button|buttons|container|content|entry|footer|global|google|group|head|header|holder|icons?|inline|inner|items?|js|label|large|law|left|links?|list"
    r"|main|media|mobile|module|outer|page|panel|posts?|primary|reader|reply|right|row|secondary|section|signup|site|slot|small|sticky|stories|story|text|thread|title|tools?|top|unit|user|widgets?|wrap|wrapper|js|c|u|m"
)
#: Elements that an opening tag closes without an end tag, and those that keep it from doing so.
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "tr": ({"tr"}, {"table"}),
}


def marks_boilerplate(name: str) -> bool:
    """Whether a name is such a word, or is made of nothing but such words and parts beside them."""
    if HINT.fullmatch(name):
        return True
    parts = name.split("-")
    return len(parts) > 1 and any(HINT.fullmatch(p) for p in parts) and all(HINT.fullmatch(p) or BESIDE.fullmatch(p) for p in parts)


def unwanted(tag: str, attributes: str, in_core: bool) -> bool:
    if tag in DROPPED or tag == "header" and not in_core:
        return True
    if not attributes or tag in ("html", "body", "article", "main"):
        return False
    for name, value in ATTRIBUTE.findall(attributes):
        name = name.lower()
        if name == "hidden" or name in ("class", "id", "role") and any(map(marks_boilerplate, value.strip("\"'").lower().replace("_", "-").split())):
            return True
    return False


def closes(stack: list[tuple[str, bool]], tag: str) -> int:
    """How many open elements an opening tag closes: a paragraph before any block, list items, cells and rows before the next one."""
    for n, (open_tag, _) in enumerate(reversed(stack), 1):
        if open_tag == "p":
            return n
        if open_tag != "span":
            break
    if tag in IMPLIED:
        same, limits = IMPLIED[tag]
        for n, (open_tag, _) in enumerate(reversed(stack), 1):
            if open_tag in same:
                return n
            if open_tag in limits or open_tag in CORE:
                break
    return 0


def blocks_of(page: str | None) -> list[tuple[str, bool]]:
    """(text, inside an article) of the visible blocks in page order, without structurally marked boilerplate."""
    page = page or ""
    out: list[tuple[str, bool]] = []
    parts: list[str] = []
    stack: list[tuple[str, bool]] = []  # open containers, and whether they are dropped
    dropped = core = 0

    def end_block() -> None:
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            parts.clear()
            if text:
                out.append((text, core > 0))

    at, size = 0, len(page)
    while at < size:
        found = TOKEN.search(page, at)
        if not found:
            if not dropped:
                parts.append(page[at:])
            break
        if found.start() > at and not dropped:
            parts.append(page[at : found.start()])
        at = found.end()
        tag = (found[2] or "").lower()
        if found[0] == "<!--":
            close = page.find("-->", at)
            at = size if close < 0 else close + 3
            continue
        if not tag:
            continue
        opening = not found[1]
        if tag == "br":
            if not dropped:
                parts.append(" ")
            continue
        if tag in BLOCKS:
            end_block()
        if opening and tag in RAW:
            close = RAW[tag].search(page, at)
            at = size if not close else close.end()
            continue
        if tag not in CONTAINERS and tag not in BLOCKS or tag in VOID:
            continue
        if opening:
            if tag in BLOCKS:
                for _ in range(closes(stack, tag)):
                    top, drop = stack.pop()
                    dropped -= drop
                    core -= top in CORE
            if found[3].endswith("/"):
                continue
            drop = unwanted(tag, found[3], core > 0)
            stack.append((tag, drop))
            dropped += drop
            core += tag in CORE
        elif any(t == tag for t, _ in stack):
            while True:
                top, drop = stack.pop()
                dropped -= drop
                core -= top in CORE
                if top == tag:
                    break
    end_block()
    return out


def ranks_of_length(stream: np.ndarray, length: int) -> np.ndarray:
    """Names of the `length`-token prefixes of all suffixes, by prefix doubling: equal names, equal prefixes. The last
    round of the doubling overlaps the one before, so any length is reached."""
    names, width = stream.astype(np.int64), 1
    while width < length:
        step = min(width, length - width)
        shifted = np.full(len(names), -1, dtype=np.int64)
        shifted[: len(names) - step] = names[step:]
        order = np.lexsort((shifted, names))
        a, b = names[order], shifted[order]
        fresh = np.zeros(len(names), dtype=np.int64)
        fresh[order] = np.concatenate(([0], np.cumsum((a[1:] != a[:-1]) | (b[1:] != b[:-1]))))
        names, width = fresh, width + step
    return names


def repeated_cover(streams: list[list[str]], length: int, pages: int) -> list[np.ndarray]:
    """For each page the tokens covered by substrings of `length` tokens or more that `pages` distinct pages contain."""
    flat, bounds, ids = [], [0], {}
    for n, tokens in enumerate(streams):
        flat.extend(ids.setdefault(t, len(ids)) for t in tokens)
        flat.append(-2 - n)  # a separator of its own: no substring spans two pages
        bounds.append(len(flat))
    stream = np.array(flat, dtype=np.int64)
    covered = np.zeros(len(stream) + 1, dtype=np.int64)
    if len(stream) > length:
        owner = np.repeat(np.arange(len(streams)), np.diff(bounds))
        names = ranks_of_length(stream - stream.min(), length)
        order = np.lexsort((owner, names))
        first = np.ones(len(order), dtype=bool)
        first[1:] = (names[order][1:] != names[order][:-1]) | (owner[order][1:] != owner[order][:-1])
        spread = np.bincount(names[order][first])
        inside = np.arange(len(names)) + length < np.array(bounds)[owner[: len(names)] + 1]  # a window ends before its page's separator
        starts = np.flatnonzero((spread[names] >= pages) & inside)
        np.add.at(covered, starts, 1)
        np.add.at(covered, starts + length, -1)
    mask = np.cumsum(covered)[:-1] > 0
    return [mask[a : b - 1] for a, b in zip(bounds, bounds[1:])]


def run_hashes(streams: list[list[str]], length: int) -> list[np.ndarray]:
    """For each page the 64-bit names of its runs of `length` tokens, by where they start: the same in every task."""
    words, bounds = word_names([" ".join(tokens).encode() for tokens in streams])
    names = run_names(words, length)
    return [names[a : max(a, b - length + 1)].view(np.int64) for a, b in zip(bounds, bounds[1:])]


def cover_of(hashes: list[np.ndarray], sizes: list[int], common: np.ndarray, length: int) -> list[np.ndarray]:
    """For each page the tokens covered by its runs whose names are in `common`."""
    out = []
    for names, size in zip(hashes, sizes):
        covered = np.zeros(size + 1, dtype=np.int64)
        starts = np.flatnonzero(np.isin(names, common))
        covered[starts] += 1
        np.add.at(covered, starts + length, -1)
        out.append(np.cumsum(covered)[:-1] > 0)
    return out


def choose(blocks: list[tuple[str, bool]], cover: np.ndarray, share: float) -> str:
    """The article's blocks where the page names one; elsewhere the blocks that are not covered by repeated substrings."""
    if any(core for _, core in blocks):
        return "\n\n".join(t for t, core in blocks if core)
    kept, at = [], 0
    for text, _ in blocks:
        n = len(text.split())
        if cover[at : at + n].sum() < share * n:
            kept.append(text)
        at += n
    return "\n\n".join(kept)


def extract_text(pages: DataFrame, key: str = "page_id", url: str = "url", page: str = "html", length: int = 8, copies: int = 3, share: float = 0.5, block_chars: int = 4_000_000) -> DataFrame:
    """One row per page: key, url, text (blocks joined by an empty line, empty if none).

    Blocks inside marked menus, headers, footers, asides, forms, adverts, notices and comments, scripts, styles and mark-up
    are dropped by structure. All blocks that structure leaves open (those outside an article) of the pages of a host are concatenated to one token stream,
    whose suffix array (sorted to `length` tokens) finds substrings that `copies` distinct pages repeat; a block outside any
    article is dropped when such substrings cover `share` of it, and the unique ones stay. Text inside an article is never
    dropped for being repeated, as pages may carry the same article. Where a page has an article, nothing outside is kept.

    A host with more than `block_chars` characters is dealt into parts of about that size by a hash of the page, so a hot host
    never meets in one task. Its runs are counted for the whole host all the same: each part hands on the 64-bit names of its
    distinct runs with their page counts, the sums decide, and the names that reach `copies` go back to the parts that hold
    them. NULL html is empty, NULL urls form the host ''. Repeated rows
    are separate pages. Other columns are ignored.
    """
    kind = pages.schema[key].dataType
    base = pages.select(F.col(key).alias("key"), F.col(url).alias("url"), F.col(page).alias("page"))
    sizes = base.groupBy(host_of(F.col("url")).alias("host")).agg(F.sum(F.length("page")).alias("chars"))
    large = materialize(sizes.where(F.col("chars") > block_chars).select("host", F.ceil(F.col("chars") / block_chars).cast("int").alias("parts")), "large-hosts")
    names = ["key", "url", "host", "part", "parts", "texts", "cores"]

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [blocks_of(p) for p in batch.column(2).to_pylist()]
            texts = pa.array([[t for t, _ in f] for f in found], pa.list_(pa.string()))
            cores = pa.array([[c for _, c in f] for f in found], pa.list_(pa.bool_()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *batch.columns[3:], texts, cores], names=names)

    def open_streams(rows: pa.Table) -> tuple[list, list[list[str]]]:
        blocks = [list(zip(t, c)) for t, c in zip(rows.column("texts").to_pylist(), rows.column("cores").to_pylist())]
        return blocks, [[w for t, core in b if not core for w in t.split()] for b in blocks]

    def count_runs(rows: pa.Table) -> pa.Table:
        hashes = [np.unique(h) for h in run_hashes(open_streams(rows)[1], length)]
        runs, pages_of = np.unique(np.concatenate(hashes), return_counts=True)
        host, part = rows.column("host")[0].as_py(), rows.column("part")[0].as_py()
        return pa.table([pa.array([host] * len(runs), pa.string()), pa.array([part] * len(runs), pa.int64()), pa.array(runs, pa.int64()), pa.array(pages_of, pa.int64())], names=["host", "part", "run", "pages"])

    def assemble(rows: pa.Table, common: pa.Table) -> pa.Table:
        blocks, streams = open_streams(rows)
        if rows.num_rows and rows.column("parts")[0].as_py():
            covers = cover_of(run_hashes(streams, length), [len(s) for s in streams], common.column("run").to_numpy(), length)
        else:
            covers = repeated_cover(streams, length, copies)
        texts = [choose(b, c, share) for b, c in zip(blocks, covers)]
        return pa.table([rows.column("key"), rows.column("url"), pa.array(texts, pa.string())], names=["key", "url", "text"])

    simple = kind.simpleString()
    hosted = join_small(base.withColumn("host", host_of(F.col("url"))), large, "host", "left").withColumn("part", F.coalesce(F.pmod(F.xxhash64("key", "url"), F.col("parts")), F.lit(0)))

    def parsed(rows: DataFrame) -> DataFrame:
        found = rows.select("key", "url", "page", "host", "part", "parts").mapInArrow(parse, f"key {simple}, url string, host string, part bigint, parts int, texts array<string>, cores array<boolean>")
        return found.select("host", "part", "parts", "key", "url", "texts", "cores")

    open_only = F.transform(F.filter(F.arrays_zip("texts", "cores"), lambda b: ~b["cores"]), lambda b: b["texts"])
    left_open = parsed(hosted.where("parts is not null")).select("host", "part", open_only.alias("texts")).where("size(texts) > 0").withColumn("cores", F.transform("texts", lambda _: F.lit(False)))
    runs = materialize(left_open.groupBy("host", "part").applyInArrow(count_runs, "host string, part bigint, run bigint, pages bigint"), "host-runs")
    frequent = runs.groupBy("host", "run").agg(F.sum("pages").alias("pages")).where(F.col("pages") >= copies).select("host", "run")
    common = runs.select("host", "part", "run").join(frequent, ["host", "run"]).select("host", "part", "run")
    pairs = parsed(hosted).groupBy("host", "part").cogroup(common.groupBy("host", "part"))
    out = pairs.applyInArrow(assemble, f"key {simple}, url string, text string")
    return out.withColumnRenamed("key", key).withColumnRenamed("url", url)
