"""Benchmark decontamination: a prefix-filtered join of item windows with whole documents, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.functions.exprs import let
from tidewell.llm.common import fits_broadcast, join_small, materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Fixed value: what stands between words, before A-Z are lower-cased.
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

#: Prefix tokens of a window.
PREFIX = 2


def words_of(text: Column) -> Column:
    """Words of a text with A-Z lower-cased; other letters stay as they are. Plain ASCII texts take the faster function."""
    text = F.coalesce(text, F.lit(""))
    low = F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    return F.array_remove(F.split(low, BETWEEN), "")


def item_windows(items: DataFrame, key: str, text: str, size: int) -> DataFrame:
    """(item, window, len, words): every run of `size` words of an item, or the whole of a shorter one, words joined by blanks."""
    worded = items.select(F.col(key).cast("string").alias("item"), words_of(F.col(text)).alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("w") - F.lit(size - 1)))
    cut = worded.select("item", "w", F.explode(starts).alias("s")).select("item", F.slice("w", F.col("s"), size).alias("words"))
    return cut.select("item", F.concat_ws(" ", "words").alias("window"), F.size("words").alias("len"), "words").distinct()


def covered(spans: Column) -> Column:
    """Number of places inside (start, len) spans: sorted, each adds what lies beyond the furthest end before it."""
    zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))

    def add(state: Column, span: Column) -> Column:
        end = span["start"] + span["len"]
        return F.struct((state["n"] + F.greatest(F.lit(0), end - F.greatest(state["end"], span["start"]))).alias("n"), F.greatest(state["end"], end).alias("end"))

    return F.aggregate(F.array_sort(spans), zero, add, lambda state: state["n"])


def word_counts(words: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(word, n) of the vocabulary's words in the rows of `words`. A vocabulary beyond the broadcast bound meets counts, which every
    task has combined before, never single places."""
    spread = words.select(F.explode("w").alias("word"))
    if fits_broadcast(vocabulary, F.octet_length("word") + 16):
        return spread.join(F.broadcast(vocabulary), "word").groupBy("word").agg(F.count("*").alias("n"))
    return spread.groupBy("word").agg(F.count("*").alias("n")).join(vocabulary, "word")


def prefix_places(words: DataFrame, prefixes: DataFrame) -> DataFrame:
    """(mark, n, at) of every place of a prefix token, with the columns of the token.

    Prefix tokens beyond the broadcast bound are met in two steps: words that are no prefix token go first, against the distinct
    tokens alone, so that of a document only places of its rare words are shuffled.
    """
    spread = words.select("mark", F.size("w").alias("n"), F.posexplode("w").alias("at", "word"))
    if fits_broadcast(prefixes, F.octet_length("word") + 48):
        return spread.join(F.broadcast(prefixes), "word")
    tokens = materialize(prefixes.select("word").distinct(), "prefix-words")
    return join_small(spread, tokens, "word", "left_semi", row_bytes=F.octet_length("word") + 16).join(prefixes, "word")


def contamination(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text", size: int = 13) -> DataFrame:
    """One row per document: key, n_words, n_hit, n_items, items (sorted ids as strings), contaminated.

    1. The words of all windows are counted over all documents; the rarest words of a window, two at most, are its prefix
       tokens (any order is right, this one meets fewest places). A window that occurs has all of them at their places.
    2. Document words are joined with the prefix tokens; length and position bounds drop places where the window
       would not fit into the document, and starts that do not meet all prefix tokens go before any text is fetched. The
       other side is broadcast within a bound of its summed bytes; beyond it only places of prefix tokens are shuffled.
    3. Candidates, once per distinct text (so copies cost nothing more), are checked word by word against the document.

    A document is contaminated when it has hits and 20 * n_hit >= n_words. NULL and empty texts have no words; an item
    without words has no window, one with fewer than `size` words is one window. NULL item ids are judged but not listed.
    Repeated items and documents count like any other; an empty benchmark hits nothing. Other columns are ignored.
    """
    owned = materialize(item_windows(items, item_key, item_text, size), "item-windows")
    numbered = owned.select("window", "len", "words").distinct().withColumn("id", F.monotonically_increasing_id())
    windows = materialize(numbered, "windows")
    places = windows.select("id", "len", F.posexplode("words").alias("off", "word"))
    vocabulary = materialize(places.select("word").distinct(), "item-words")
    base = docs.select(F.col(key).alias("key"), F.col(text).alias("body"), F.unhex(F.md5(F.coalesce(F.col(text), F.lit("")))).alias("mark"))
    words = base.select("mark", words_of(F.col("body")).alias("w"))
    counts = word_counts(words, vocabulary)
    known = places.join(counts, "word", "left").groupBy("id", "len").agg(F.array_sort(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "word", "off"))).alias("p"))
    rarest = known.where("p[0].n > 0").select("id", "len", F.least(F.col("len"), F.lit(PREFIX)).alias("need"), F.posexplode(F.slice("p", 1, PREFIX)).alias("rank", "p"))
    prefixes = materialize(rarest.select("id", "len", "need", F.expr("shiftleft(1, rank)").alias("bit"), F.col("p.word").alias("word"), F.col("p.off").alias("off")), "item-prefixes")
    fits = (F.col("at") >= F.col("off")) & (F.col("at") - F.col("off") + F.col("len") <= F.col("n"))
    met = prefix_places(words, prefixes).where(fits).groupBy("mark", (F.col("at") - F.col("off")).alias("start"), "id", "need").agg(F.bit_or("bit").alias("bits"))
    whole = met.where(F.col("bits") == F.expr("shiftleft(1, need) - 1")).select("mark", "start", "id")
    spans = join_small(whole, windows.select("id", "len", "window"), "id", row_bytes=F.octet_length("window") + 32)
    candidates = materialize(spans.groupBy("mark").agg(F.collect_list(F.struct("start", "len", "window")).alias("spans")), "item-candidates")
    weight = F.aggregate("spans", F.lit(0), lambda total, x: total + F.octet_length(x["window"]) + 24)
    suspects = join_small(base.select("mark", "body"), candidates, "mark", row_bytes=weight)
    true = let(words_of(F.col("body")), lambda w: F.filter("spans", lambda x: F.concat_ws(" ", F.slice(w, x["start"] + 1, x["len"])) == x["window"]))
    verified = suspects.select("mark", true.alias("spans")).where(F.size("spans") > 0).groupBy("mark").agg(F.first("spans").alias("spans"))
    verified = materialize(verified, "item-hits")
    found = verified.select("mark", F.explode(F.array_distinct(F.transform("spans", lambda x: x["window"]))).alias("window"))
    owners = join_small(found, owned.select("item", "window"), "window", row_bytes=F.octet_length("window") + F.coalesce(F.octet_length("item"), F.lit(0)) + 32).groupBy("mark").agg(F.count_distinct("item").alias("n_items"), F.array_sort(F.collect_set("item")).alias("items"))
    hits = materialize(verified.select("mark", covered(F.col("spans")).alias("n_hit")).join(owners, "mark", "left"), "documents-hit")
    n_words = F.size(F.array_remove(F.split(F.coalesce("body", F.lit("")), BETWEEN), "")).cast("long")
    out = join_small(base.select("key", "mark", n_words.alias("n_words")), hits, "mark", "left", row_bytes=F.size(F.coalesce("items", F.array().cast("array<string>"))) * 24 + 64)
    n_hit = F.coalesce(F.col("n_hit"), F.lit(0)).cast("long")
    return out.select(
        F.col("key").alias(key), "n_words", n_hit.alias("n_hit"), F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"), ((n_hit > 0) & (n_hit * 20 >= F.col("n_words"))).alias("contaminated"),
    )


def clean_documents(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of `docs` whose text is not contaminated, with their columns."""
    mark = F.md5(F.coalesce(F.col(text), F.lit("")))
    judged = contamination(docs.select(mark.alias("mark"), F.col(text).alias("body")).groupBy("mark").agg(F.first("body").alias("body")), items, key="mark", text="body", **options)
    bad = materialize(judged.where("contaminated").select(F.col("mark").alias("tw_mark")), "contaminated")
    return join_small(docs.withColumn("tw_mark", mark), bad, "tw_mark", "left_anti").drop("tw_mark")
