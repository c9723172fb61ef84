"""URL filters: explicit host and path rules first, association rules mined from labels for the rest."""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import join_small, materialize

#: Fixed values: (verdict, host, path prefix).
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
BAD = "label:bad"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; empty for NULL or no `://`."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def explicit_rule(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule (host and path together, then host) that fits, as a struct (verdict, rule); NULL if none does."""
    chosen = F.lit(None).cast("struct<verdict:string,rule:string>")
    for verdict, name, prefix in sorted(rules, key=lambda r: (len(r[1] + r[2]), len(r[1]))):
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(prefix)
        chosen = F.when(fits, F.struct(F.lit(verdict).alias("verdict"), F.lit(name + prefix).alias("rule"))).otherwise(chosen)
    return chosen


def url_tokens(url: str, host: Column, path: Column) -> Column:
    """Distinct tokens: scheme, host labels, path parts without numbers, query keys."""
    parts = F.concat(
        F.array(F.concat(F.lit("scheme:"), F.regexp_extract(F.col(url), r"(?s)^(.*?)://", 1))),
        F.transform(F.split(host, r"\."), lambda x: F.concat(F.lit("host:"), x)),
        F.transform(F.filter(F.split(path, "/"), lambda x: (x != "") & ~x.rlike(r"[0-9]")), lambda x: F.concat(F.lit("path:"), x)),
        F.transform(F.regexp_extract_all(F.col(url), F.lit(r"[?&]([^=&#]*)"), 1), lambda x: F.concat(F.lit("query:"), x)),
    )
    return F.array_distinct(F.coalesce(parts, F.array(F.lit("scheme:"))))


def merge_companions(baskets: DataFrame, least: int) -> tuple[DataFrame, DataFrame]:
    """(baskets of classes, (class, tokens, n)): tokens that occur in the very same baskets are one class, named by its smallest
    token, so k tokens that always come together are one item to mine and not 2**k sets. Tokens of fewer than `least` baskets
    can be in no rule and go before; the label stays alone."""
    rows = materialize(baskets.withColumn("basket", F.monotonically_increasing_id()), "baskets")
    spread = rows.select("basket", F.explode("items").alias("token"))
    place = F.xxhash64("basket")
    seen = spread.groupBy("token").agg(F.count("*").alias("n"), F.bit_xor(place).alias("one"), F.bit_xor(F.xxhash64(place)).alias("two")).where((F.col("n") >= least) | (F.col("token") == BAD))
    own = (F.col("token") == BAD).alias("label")
    classes = materialize(seen.groupBy("n", "one", "two", own).agg(F.min("token").alias("class"), F.array_sort(F.collect_list("token")).alias("tokens")).select("class", "tokens", "n"), "token-classes")
    kept = spread.join(classes.select(F.col("class").alias("token")), "token", "left_semi")
    return materialize(kept.groupBy("basket").agg(F.collect_list("token").alias("items")), "class-baskets"), classes


def parts_of(tokens: str) -> Column:
    """All non-empty proper subsets of a short sorted array, each sorted."""
    masks = F.sequence(F.lit(1), F.expr(f"shiftleft(1, size({tokens})) - 2"))
    return F.when(F.size(tokens) > 1, F.transform(masks, lambda m: F.filter(tokens, lambda x, i: F.getbit(m, i) == 1))).otherwise(F.array().cast("array<array<string>>"))


def mine_rules(baskets: DataFrame, support: float, confidence: float, least: int, longest: int) -> DataFrame:
    """(mined_rule, tokens, confidence, anchor): token sets that imply the bad label, none containing a smaller one
    of at least its confidence; the anchor is the set's least frequent token.

    FP-growth runs over every labelled URL. A rule needs `support` as a share of them and `least` of them as a number, and has at most
    `longest` classes of tokens on its left side, so that it is held against its own subsets by equality alone.
    """
    merged, classes = merge_companions(baskets, least)
    total = max(1, merged.count())
    share = min(1.0, max(support, least / total))
    model = FPGrowth(itemsCol="items", minSupport=share, minConfidence=confidence).fit(merged)
    rules = model.associationRules.where((F.size("consequent") == 1) & (F.col("consequent")[0] == BAD) & (F.size("antecedent") <= longest) & (F.col("support") * total >= least - 0.5))
    rules = materialize(rules.select(F.array_sort("antecedent").alias("classes"), "confidence"), "mined")
    smaller = rules.select(F.col("classes").alias("part"), F.col("confidence").alias("sure"))
    covered = rules.select("classes", "confidence", F.explode(parts_of("classes")).alias("part")).join(smaller, "part").where("sure >= confidence")
    lean = rules.join(covered.select("classes").distinct(), "classes", "left_anti")
    spelled = lean.select("classes", "confidence", F.explode("classes").alias("class")).join(classes, "class")
    whole = spelled.groupBy("classes", "confidence").agg(F.array_sort(F.flatten(F.collect_list("tokens"))).alias("tokens"), F.min(F.struct("n", "class")).alias("a"))
    return materialize(whole.select(F.concat_ws(" ", "tokens").alias("mined_rule"), "tokens", "confidence", F.col("a.class").alias("anchor")), "url-rules")


def bytes_of(tokens: str) -> Column:
    return F.aggregate(tokens, F.lit(64), lambda total, x: total + F.octet_length(x) + 16)


def filter_urls(pages: DataFrame, labels: DataFrame, key: str = "page_id", url: str = "url", label_key: str = "doc_id", item: Column | None = None, support: float = 0.002, confidence: float = 0.6, rules=RULES, least: int = 20, longest: int = 4) -> DataFrame:
    """One row per page: key, host, path, rule, verdict, mined_rule, confidence.

    Labels belong to `item`, by default the first number in the path: the document that the page shows. An explicit rule decides first. Otherwise the page is blocked if all tokens of a mined rule are in its URL. Labels
    with quality 0 or toxic 1 are bad; several labels of a key are bad if one is. Rules match by an inverted index: URLs meet a
    rule on its rarest token only, then the whole set is tested. Rules are mined from sets seen on at least `least` labelled URLs (fewer
    labels than that give no rule); tokens that always come together count as one. NULL URLs have empty host and path and are allowed unless
    mined rules fit; repeated keys are judged row by row; without labels nothing is mined and all the rest is allowed.
    """
    host, path = host_of(F.col(url)), path_of(F.col(url))
    item = F.try_to_number(F.regexp_extract(path, r"/([0-9]{1,18})(?:[/.]|$)", 1), F.lit("9" * 18)).cast("long") if item is None else item
    judged = pages.select(F.col(key).alias("key"), host.alias("host"), path.alias("path"), item.alias("item"), explicit_rule(host, path, rules).alias("fit"), url_tokens(url, host, path).alias("tokens"))
    marks = labels.where(F.col(label_key).isNotNull()).groupBy(F.col(label_key).alias("item")).agg(F.max((F.coalesce(F.col("quality") == 0, F.lit(False)) | F.coalesce(F.col("toxic") == 1, F.lit(False))).cast("int")).alias("bad"))
    baskets = judged.select("item", "tokens").join(marks, "item").select(F.when(F.col("bad") == 1, F.concat("tokens", F.array(F.lit(BAD)))).otherwise(F.col("tokens")).alias("items"))
    mined = mine_rules(baskets, support, confidence, least, longest)
    sets = judged.select("tokens").distinct()
    index = mined.select("mined_rule", "confidence", F.col("tokens").alias("need"), F.col("anchor").alias("token"))
    met = join_small(sets.select("tokens", F.explode("tokens").alias("token")), index, "token", row_bytes=bytes_of("need")).where(F.size(F.array_except("need", "tokens")) == 0)
    hits = materialize(met.groupBy("tokens").agg(F.max(F.struct("confidence", "mined_rule")).alias("hit")), "url-hits")
    out = join_small(judged, hits, "tokens", "left", row_bytes=bytes_of("tokens"))
    verdict = F.coalesce(F.col("fit.verdict"), F.when(F.col("hit").isNotNull(), F.lit("block")).otherwise(F.lit("allow")))
    return out.select(F.col("key").alias(key), "host", "path", F.col("fit.rule").alias("rule"), verdict.alias("verdict"), F.col("hit.mined_rule").alias("mined_rule"), F.col("hit.confidence").alias("confidence"))
