"""Question answering over chunks as a batch: expand, search, fuse, filter, cite."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell.functions.exprs import clamp, int_avg, let, round_n
from tidewell.functions.text import HAN, sanitize_flat, squeeze_ws
from tidewell.operators.ranking import top_n

Hints = Sequence[tuple[Sequence[str], Sequence[str]]]

# Question terms that name an intent, and the document terms that belong to it.
INTENT_HINTS: Hints = (
    (("年假", "带薪假", "假期"), ("annual leave", "paid leave", "vacation", "carry forward")),
    (("工作时间", "上班时间", "工时"), ("working hours", "Monday to Friday", "09:00 to 18:00")),
    (("报销", "差旅", "发票"), ("reimbursement", "travel", "receipt", "finance")),
    (("采购", "采购资金", "采购审批"), ("procurement", "purchase request", "approval", "quotation")),
    (("考核", "绩效", "评估"), ("performance review", "review", "twice per year")),
)

# Terms of which a chunk must mention enough when the question names an intent.
INTENT_FOCUS: Hints = (
    (("年假", "带薪假", "假期"), ("annual leave", "paid leave", "vacation", "carry", "next year")),
    (("工作时间", "上班时间", "工时"), ("working hours", "monday to friday", "09:00", "18:00")),
    (("报销", "差旅", "发票"), ("reimbursement", "travel", "receipt", "finance")),
    (("采购", "采购资金", "采购审批"), ("procurement", "quotation", "approval", "purchase request")),
)


def _contains_any(text: Column, terms: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [text.contains(t) for t in terms], F.lit(False))


def _hits(text: Column, terms: Sequence[str]) -> Column:
    return reduce(lambda a, b: a + b, [text.contains(t).cast("int") for t in terms], F.lit(0))


def expand_queries(questions: DataFrame, hints: Hints = INTENT_HINTS) -> DataFrame:
    """Search texts per question in order: reworded, original, and two per matching intent; no repeats."""
    q = F.col("question")
    texts = [F.array(F.trim("rewritten"), F.trim("question"))]
    for asked, related in hints:
        joined = " ".join(related)
        extra = F.array(F.concat_ws(" ", q, F.lit(joined)), F.lit(joined))
        texts.append(F.when(_contains_any(q, asked), extra).otherwise(F.array().cast("array<string>")))
    cleaned = F.filter(F.transform(F.concat(*texts), squeeze_ws), lambda t: t != "")
    variants = questions.select("query_id", F.posexplode(F.array_distinct(cleaned)).alias("variant", "search_text"))
    return variants.withColumn("variant", F.col("variant").cast("bigint"))


def rank_score(position: Column, total: Column) -> Column:
    """0.95 for the best place, falling evenly to 0.35; `position` counts from 0."""
    step = F.lit(0.6) / (total - 1).cast("double")
    return F.when(total <= 1, F.lit(0.95)).otherwise(F.greatest(F.lit(0.35), F.lit(0.95) - position.cast("double") * step))


def query_terms(question: Column, limit: int = 10) -> Column:
    return F.slice(F.regexp_extract_all(F.lower(question), F.lit(rf"[{HAN}]{{2,}}|[a-z0-9]{{3,}}"), F.lit(0)), 1, limit)


def lexical_bonus(question: Column, text: Column) -> Column:
    """0.04 per question term found, at most 0.18."""
    hits = F.size(F.filter(query_terms(question), lambda t: F.lower(text).contains(t)))
    return F.least(F.lit(0.18), F.lit(0.04) * hits)


def keyword_bonus(question: Column, text: Column, hints: Hints = INTENT_HINTS) -> Column:
    """0.06 + 0.03 per related term for the best intent the question names, at most 0.16."""
    lower_q, lower_t = F.lower(question), F.lower(text)
    scores = [F.lit(0.0)]
    for asked, related in hints:
        lowered = [r.lower() for r in related]
        named = _contains_any(question, asked) | _contains_any(lower_q, lowered)
        hits = _hits(lower_t, lowered)
        scores.append(F.when(named & (hits > 0), F.least(F.lit(0.16), F.lit(0.06) + F.lit(0.03) * hits)).otherwise(0.0))
    return F.greatest(*scores) if len(scores) > 1 else scores[0]


def fuse_results(candidates: DataFrame, top_k: int, hints: Hints = INTENT_HINTS) -> DataFrame:
    """Best adjusted score per (question, chunk), best `top_k` chunks per question.

    Expects query_id, question, chunk_id, text and score; the bonuses look at the whole chunk text. The base
    score is reduced to one per (question, chunk) before the texts are read, since the bonus is the same for
    all variants.
    """
    bonus = keyword_bonus(F.col("question"), F.col("text"), hints) + lexical_bonus(F.col("question"), F.col("text"))
    scored = candidates.withColumn("score", clamp(clamp(F.col("score")) + bonus))
    return top_n(scored, ["query_id"], [F.desc("score"), F.asc("chunk_id")], top_k)


def best_per_chunk(pool: DataFrame) -> DataFrame:
    """Several variants may find the same chunk: keep the best base score."""
    return pool.groupBy("query_id", "chunk_id").agg(F.max("score").alias("score"))


def threshold_relax(results: DataFrame, min_score: float, relax_by: float = 0.12, floor: float = 0.15) -> DataFrame:
    """Keep scores at or above the minimum; a question left without any gets the lower limit instead."""
    best = F.max("score").over(Window.partitionBy("query_id"))
    limit = F.when(best >= min_score, F.lit(min_score)).otherwise(F.lit(max(floor, min_score - relax_by)))
    return results.withColumn("_limit", limit).where(F.col("score") >= F.col("_limit")).drop("_limit")


def focus_filter(results: DataFrame, focus: Hints = INTENT_FOCUS) -> DataFrame:
    """Keep chunks that mention enough terms of the first intent the question names.

    Two terms are enough, or one where the intent lists fewer than six. When no intent is named, or no chunk
    qualifies, all chunks of the question stay.
    """
    q = F.col("question")

    def enough(text: Column) -> Column:
        verdict = F.lit(True)
        for asked, related in reversed(list(focus)):
            terms = [t.lower() for t in (*asked, *related)]
            named = _contains_any(q, asked) | _contains_any(F.lower(q), [r.lower() for r in related])
            verdict = F.when(named, _hits(text, terms) >= (2 if len(terms) >= 6 else 1)).otherwise(verdict)
        return verdict

    flagged = results.withColumn("_focused", let(F.lower(sanitize_flat("text")), enough))
    any_focused = F.bool_or("_focused").over(Window.partitionBy("query_id"))
    return flagged.withColumn("_any", any_focused).where(F.col("_focused") | ~F.col("_any")).drop("_focused", "_any")


def citations(results: DataFrame, width: int = 260) -> DataFrame:
    return results.select("query_id", "chunk_id", "source", "page", "section", "score", F.substring("text", 1, width).alias("snippet"))


def query_confidence(questions: DataFrame, cited: DataFrame) -> DataFrame:
    """Mean score of the kept citations per question, 0 without any."""
    exact = F.col("score").cast("decimal(18,12)")
    mean = cited.groupBy("query_id").agg((F.sum(exact).cast("double") / F.count("score").cast("double")).alias("mean"), F.count("score").alias("citation_cnt"))
    out = questions.select("query_id").join(mean, "query_id", "left")
    return out.select("query_id", F.coalesce(round_n("mean", 4), F.lit(0.0)).alias("confidence"), F.coalesce("citation_cnt", F.lit(0)).alias("citation_cnt"))


def render_context(cited: DataFrame) -> DataFrame:
    """One text per question: numbered blocks in score order. A list holds at most top_k blocks."""
    number = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "chunk_id"))
    head = F.concat(
        F.lit("[C"), F.col("n").cast("string"), F.lit("] source="), "source", F.lit(" page="), F.col("page").cast("string"), F.lit(" section="), "section",
        F.lit(" score="), round_n("score", 3).cast("decimal(6,3)").cast("string"),
    )
    blocks = cited.withColumn("n", number).select("query_id", "n", F.concat_ws("\n", head, sanitize_flat("text")).alias("block"))
    ordered = F.array_sort(F.collect_list(F.struct("n", "block")))
    return blocks.groupBy("query_id").agg(F.array_join(F.transform(ordered, lambda b: b["block"]), "\n\n").alias("context"))


HOURS = r"(?i)Monday\s+to\s+Friday[^\d]*(\d{2}:\d{2})\s*to\s*(\d{2}:\d{2})"
# Where each policy fact stands in a text, as patterns and the number of the group that holds the value.
POLICY_FACTS: dict[str, tuple[tuple[str, int], ...]] = {
    "annual_days": ((r"(?i)(\d+)\s*days\s+annual\s+leave", 1), (r"(?i)annual\s+leave[^\d]*(\d+)\s*days", 1)),
    "carry_days": ((r"(?i)carried\s+forward[^\d]*(\d+)\s*days", 1),),
    "work_start": ((HOURS, 1),),
    "work_end": ((HOURS, 2),),
    "head_approval_cny": ((r"(?i)above\s*([\d,]+)\s*cny\s*require\s*department\s+head\s+approval", 1),),
    "quotation_cny": ((r"(?i)at\s+least\s+three\s+vendor\s+quotations\s+are\s+required\s+for\s+purchases\s+above\s*([\d,]+)\s*cny", 1),),
    "legal_review_cny": ((r"(?i)legal\s+review\s+is\s+mandatory\s+for\s+all\s+contracts\s+above\s*([\d,]+)\s*cny", 1),),
    "net_days": ((r"(?i)standard\s+payment\s+terms\s+are\s+net\s*(\d+)", 1),),
    "advance_pct": ((r"(?i)advance\s+payments\s+above\s*(\d+)%\s+require\s+cfo\s+approval", 1),),
}


def policy_facts(text: str = "text") -> dict[str, Column]:
    """First match of each fact in the whole text, NULL without one."""
    found = {}
    for name, patterns in POLICY_FACTS.items():
        found[name] = F.coalesce(*[F.nullif(F.regexp_extract(text, p, group), F.lit("")) for p, group in patterns])
    return found


def qa_audit_metrics(audit: DataFrame) -> DataFrame:
    exact = F.sum(F.col("confidence").cast("decimal(18,6)")).cast("double")
    return audit.agg(
        F.count(F.lit(1)).alias("total_queries"),
        F.coalesce(round_n(int_avg("latency_ms"), 2), F.lit(0.0)).alias("avg_latency_ms"),
        F.coalesce(round_n(F.try_divide(exact, F.count("confidence").cast("double")), 4), F.lit(0.0)).alias("avg_confidence"),
    )
