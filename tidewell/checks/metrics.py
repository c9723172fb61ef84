"""Operating metrics with their check SQL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.checks import game as _game_checks  # noqa: F401  registers the comp layers
from tidewell.checks.catalog import query
from tidewell.checks.ctes import cte, rnd, sql
from tidewell.functions.exprs import round_n
from tidewell.functions.pii import PATTERNS, mask_pii, pii_counts
from tidewell.operators import graph, similarity, snapshots
from tidewell.operators.relational import scalar
from tidewell.plans import game, live, metrics
from tidewell.session import materialize, scratch_path
from tidewell.sources.star import Star

cte("user_day_layer", """
SELECT user_id, CAST(ts AS DATE) AS dt, COUNT(*) AS event_cnt, COALESCE(SUM(CAST(value AS DECIMAL(18,2))) FILTER (WHERE event_type = 'purchase'), 0) AS revenue FROM events GROUP BY 1, 2
""")
cte("daily_layer", """
SELECT d.*, COALESCE(new_user_cnt, 0) AS new_user_cnt FROM (
  SELECT dt, COUNT(*) AS dau, COUNT(*) FILTER (WHERE revenue > 0) AS payer_cnt, CAST(SUM(revenue) AS DOUBLE) AS revenue,
         CAST(COUNT(*) FILTER (WHERE revenue > 0) AS DOUBLE) / COUNT(*) AS pay_rate, CAST(SUM(revenue) AS DOUBLE) / COUNT(*) AS arpu,
         CAST(SUM(revenue) AS DOUBLE) / NULLIF(COUNT(*) FILTER (WHERE revenue > 0), 0) AS arppu, CAST(SUM(event_cnt) AS DOUBLE) / COUNT(*) AS events_per_user
  FROM user_day_layer GROUP BY 1) d
LEFT JOIN (SELECT dt, COUNT(*) AS new_user_cnt FROM (SELECT user_id, MIN(dt) AS dt FROM user_day_layer GROUP BY 1) GROUP BY 1) n ON d.dt = n.dt
""")


def days(s: Star):
    paid = F.when(F.col("event_type") == "purchase", F.col("value"))
    return metrics.user_days(s.table("events"), "user_id", F.col("ts").cast("date"), paid)


@query("daily_active", sql("SELECT * FROM daily_layer"))
def _(s: Star):
    return metrics.daily_active(days(s))


@query("retention", sql("""
SELECT f.dt AS cohort_dt, COUNT(*) AS cohort_size, CAST(COUNT(a.user_id) AS DOUBLE) / COUNT(*) AS d1_rate, CAST(COUNT(b.user_id) AS DOUBLE) / COUNT(*) AS d7_rate
FROM (SELECT user_id, MIN(dt) AS dt FROM user_day_layer GROUP BY 1) f
LEFT JOIN user_day_layer a ON f.user_id = a.user_id AND a.dt = f.dt + 1 LEFT JOIN user_day_layer b ON f.user_id = b.user_id AND b.dt = f.dt + 7 GROUP BY 1
"""))
def _(s: Star):
    return metrics.retention(days(s))


@query("returning_users", sql("""
SELECT user_id, COUNT(*) FILTER (WHERE gap > 2) AS return_cnt, DATE_DIFF('day', MAX(dt), (SELECT MAX(dt) FROM user_day_layer)) >= 2 AS is_lapsed
FROM (SELECT user_id, dt, DATE_DIFF('day', LAG(dt) OVER (PARTITION BY user_id ORDER BY dt), dt) AS gap FROM user_day_layer) GROUP BY 1
"""))
def _(s: Star):
    return metrics.returning_users(days(s), 2, scalar(s.table("events"), F.max(F.col("ts").cast("date"))))


@query("player_ltv", sql("SELECT user_id, dt, CAST(revenue AS DOUBLE) AS revenue, CAST(SUM(revenue) OVER (PARTITION BY user_id ORDER BY dt) AS DOUBLE) AS ltv FROM user_day_layer"))
def _(s: Star):
    return metrics.player_ltv(days(s))


@query("match_health", sql("""
SELECT patch_version, region, COUNT(*) AS start_cnt, CAST(COUNT(*) FILTER (WHERE rank_no < 7) AS DOUBLE) / COUNT(*) AS completion_rate,
       CAST(SUM(CASE WHEN rank_no < 7 THEN 1800 - rank_no * 60 END) AS DOUBLE) / COUNT(*) FILTER (WHERE rank_no < 7) AS avg_duration_sec,
       CAST(COUNT(*) FILTER (WHERE mode = 'ranked') AS DOUBLE) / COUNT(*) AS ranked_share FROM match_result GROUP BY 1, 2
"""))
def _(s: Star):
    rank = F.col("rank_no")
    games = s.match_result().withColumns({"completed": F.when(rank < 7, 1).otherwise(0), "duration_sec": F.lit(1800) - rank * 60})
    return metrics.match_health(games, ["patch_version", "region"])


@query("threshold_alerts", sql("""
SELECT dt, dau, dau_mean_7d, arpu, dau_alert, arpu_alert, surge_alert FROM (
  SELECT dt, dau, dau_mean_7d, arpu, COALESCE(dau < dau_mean_7d * 0.995::DOUBLE, FALSE) AS dau_alert, COALESCE((arpu - prev) / NULLIF(prev, 0) < -0.1::DOUBLE, FALSE) AS arpu_alert,
         COALESCE(event_cnt > event_mean_7d * 1.05::DOUBLE, FALSE) AS surge_alert
  FROM (SELECT *, CASE WHEN COUNT(*) OVER w >= 3 THEN CAST(SUM(dau) OVER w AS DOUBLE) / COUNT(*) OVER w END AS dau_mean_7d,
               CASE WHEN COUNT(*) OVER w >= 3 THEN CAST(SUM(event_cnt) OVER w AS DOUBLE) / COUNT(*) OVER w END AS event_mean_7d, LAG(arpu) OVER (ORDER BY dt) AS prev
        FROM (SELECT dt, COUNT(*) AS dau, CAST(SUM(event_cnt) AS BIGINT) AS event_cnt, CAST(SUM(revenue) AS DOUBLE) / COUNT(*) AS arpu FROM user_day_layer GROUP BY 1)
        WINDOW w AS (ORDER BY dt ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)))
WHERE dau_alert OR arpu_alert OR surge_alert
"""))
def _(s: Star):
    daily = days(s).groupBy("dt").agg(
        F.count(F.lit(1)).alias("dau"), F.sum("event_cnt").alias("event_cnt"), (F.sum("revenue").cast("double") / F.count(F.lit(1)).cast("double")).alias("arpu")
    )
    return metrics.activity_alerts(daily, 0.995, 0.1, 1.05)


@query("comp_alerts", sql("SELECT * FROM comp_perf_layer WHERE top4_rate > 0.58::DOUBLE AND pick_rate > 0.16::DOUBLE"))
def _(s: Star):
    return metrics.comp_alerts(game.comp_performance(s.match_result()), 0.58, 0.16)


@query("strategy_rates", sql("""
SELECT COUNT(*) AS case_cnt, CAST(COUNT(*) FILTER (WHERE bad AND NOT hit) AS DOUBLE) / COUNT(*) FILTER (WHERE bad) AS miss_rate,
       CAST(COUNT(*) FILTER (WHERE hit AND (appeal_result = 'overturned' OR review_result = 'normal')) AS DOUBLE) / COUNT(*) FILTER (WHERE hit) AS false_positive_rate,
       CAST(COUNT(*) FILTER (WHERE hit AND appeal_result <> 'not_appealed') AS DOUBLE) / COUNT(*) FILTER (WHERE hit) AS appeal_rate,
       CAST(COUNT(*) FILTER (WHERE appeal_result = 'overturned') AS DOUBLE) / COUNT(*) AS overturn_rate,
       CAST(COUNT(*) FILTER (WHERE hit AND bad) AS DOUBLE) / COUNT(*) FILTER (WHERE hit) AS hit_confirm_rate
FROM (SELECT *, review_result = 'violation' AS bad, target_id % 2 = 0 AS hit FROM review_event)
"""))
def _(s: Star):
    cases = s.review_event().withColumn("is_hit", F.when(F.pmod("target_id", F.lit(2)) == 0, 1).otherwise(0))
    return metrics.strategy_rates(cases)


@query("cohort_risk_rate", sql("""
SELECT date_trunc('hour', register_time) AS period, country, COUNT(*) AS account_cnt, COUNT(p.user_id) AS risky_cnt, CAST(COUNT(p.user_id) AS DOUBLE) / COUNT(*) AS risk_rate
FROM account_behavior a LEFT JOIN (SELECT DISTINCT user_id FROM punishment_event WHERE punish_type = 'ban') p ON a.user_id = p.user_id GROUP BY 1, 2
"""))
def _(s: Star):
    banned = s.punishment_event().where(F.col("punish_type") == "ban")
    return metrics.cohort_risk_rate(s.account_behavior(), banned, F.date_trunc("hour", "register_time").cast("timestamp_ntz"), "country")


@query("outlier_zscore_iqr", sql(f"""
SELECT txn_id, amount, {rnd('(amount - m) / sd', 6)} AS z_score, abs((amount - m) / sd) > 3 AS z_outlier, amount < q1 - (q3 - q1) * 1.5::DOUBLE OR amount > q3 + (q3 - q1) * 1.5::DOUBLE AS iqr_outlier
FROM fact_transaction, (SELECT AVG(amount) AS m, STDDEV_SAMP(amount) AS sd, quantile_cont(amount, 0.25) AS q1, quantile_cont(amount, 0.75) AS q3 FROM fact_transaction)
"""))
def _(s: Star):
    return metrics.outliers(s.fact_transaction().select("txn_id", "amount"), "amount")


@query("account_graph_components", sql("""
WITH link AS (SELECT DISTINCT user_id AS m, device_id AS k FROM account_behavior UNION SELECT DISTINCT user_id, ip FROM account_behavior),
pair AS (SELECT DISTINCT a.m AS a, b.m AS b FROM link a JOIN link b ON a.k = b.k),
reach AS (SELECT m AS a, m AS b FROM link UNION SELECT reach.a, pair.b FROM reach JOIN pair ON reach.b = pair.a)
SELECT a AS user_id, MIN(b) AS component FROM reach GROUP BY 1
""", recursive=True))
def _(s: Star):
    a = s.account_behavior()
    edges = a.select("user_id", F.col("device_id").alias("k")).union(a.select("user_id", F.col("ip")))
    return graph.contracted_components(edges, "user_id", "k")


# All pairs of texts that share a trigram are counted; the smallest reachable text names the group.
@query("template_similarity", r"""
WITH RECURSIVE contents AS (SELECT lower(regexp_replace(text, '[0-9]+', '<num>', 'g')) AS content, MIN(doc_id) AS doc_id, COUNT(*) AS copies FROM documents GROUP BY 1),
grams AS (SELECT DISTINCT doc_id, substr(padded, place, 3) AS gram
          FROM (SELECT doc_id, rpad(content, greatest(3, length(content))::INT, ' ') AS padded, unnest(range(1, greatest(3, length(content)) - 1)) AS place FROM contents)),
sizes AS (SELECT doc_id, COUNT(*) AS n FROM grams GROUP BY 1),
shared AS (SELECT a.doc_id AS one, b.doc_id AS other, COUNT(*) AS n FROM grams a JOIN grams b USING (gram) WHERE a.doc_id < b.doc_id GROUP BY ALL),
pairs AS (SELECT one, other FROM shared s JOIN sizes x ON x.doc_id = one JOIN sizes y ON y.doc_id = other WHERE s.n * 1.8::DOUBLE >= (x.n + y.n) * 0.8::DOUBLE),
links AS (SELECT one, other FROM pairs UNION ALL SELECT other, one FROM pairs),
reach(doc_id, seen) AS (SELECT doc_id, doc_id FROM contents UNION SELECT r.doc_id, l.other FROM reach r JOIN links l ON l.one = r.seen),
grouped AS (SELECT doc_id, MIN(seen) AS "group" FROM reach GROUP BY 1)
SELECT "group", COUNT(*) AS template_cnt, SUM(copies)::BIGINT AS text_cnt FROM grouped JOIN contents USING (doc_id) GROUP BY 1
""")
def _(s: Star):
    texts = s.texts("documents").groupBy(live.normalized_content("text").alias("content")).agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("copies"))
    groups = similarity.similar_groups(texts, "doc_id", "content", carry=["copies"])
    return groups.groupBy("group").agg(F.count(F.lit(1)).alias("template_cnt"), F.sum("copies").alias("text_cnt"))


@query("ab_test", sql(f"""
SELECT rate_a, rate_b, rate_b - rate_a AS difference, {rnd('(rate_b - rate_a) / sqrt(pooled * (1 - pooled) * (1 / n_a + 1 / n_b))', 9)} AS z,
       {rnd('rate_b - rate_a - 1.959963984540054::DOUBLE * se', 9)} AS ci_low, {rnd('rate_b - rate_a + 1.959963984540054::DOUBLE * se', 9)} AS ci_high,
       abs((rate_b - rate_a) / sqrt(pooled * (1 - pooled) * (1 / n_a + 1 / n_b))) > 1.959963984540054::DOUBLE AS significant
FROM (SELECT *, (x_a + x_b) / (n_a + n_b) AS pooled, sqrt(rate_a * (1 - rate_a) / n_a + rate_b * (1 - rate_b) / n_b) AS se FROM (
  SELECT *, x_a / n_a AS rate_a, x_b / n_b AS rate_b FROM (SELECT CAST(COUNT(*) FILTER (WHERE c_mktsegment = 'BUILDING') AS DOUBLE) AS n_a,
         CAST(COUNT(*) FILTER (WHERE c_mktsegment = 'BUILDING' AND c_acctbal > 5000) AS DOUBLE) AS x_a, CAST(COUNT(*) FILTER (WHERE c_mktsegment = 'MACHINERY') AS DOUBLE) AS n_b,
         CAST(COUNT(*) FILTER (WHERE c_mktsegment = 'MACHINERY' AND c_acctbal > 5000) AS DOUBLE) AS x_b FROM customer)))
"""))
def _(s: Star):
    groups = s.table("customer").groupBy(F.col("c_mktsegment").alias("group")).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("c_acctbal") > 5000).alias("converted"))
    out = metrics.ab_test(groups, "BUILDING", "MACHINERY")
    return out.withColumns({c: round_n(c, 9) for c in ("z", "ci_low", "ci_high")})


@query("activation_rate", sql("""
SELECT unit_id, COUNT(DISTINCT (match_id, player_id)) AS game_cnt, COUNT(DISTINCT (match_id, player_id)) / (SELECT CAST(COUNT(DISTINCT (match_id, player_id)) AS DOUBLE) FROM match_result) AS activation_rate
FROM match_result GROUP BY 1
"""))
def _(s: Star):
    m = s.match_result()
    return metrics.activation_rate(m, "unit_id", ["match_id", "player_id"], m)


@query("conversion_funnel", """
WITH RECURSIVE walk AS (
  SELECT user_id, 1 AS step_no, MIN(ts) AS at FROM events WHERE event_type = 'view' GROUP BY 1
  UNION ALL
  SELECT w.user_id, w.step_no + 1, MIN(e.ts) FROM walk w JOIN events e ON e.user_id = w.user_id AND e.ts >= w.at AND e.event_type = CASE w.step_no WHEN 1 THEN 'click' WHEN 2 THEN 'purchase' END
  GROUP BY w.user_id, w.step_no),
n AS (SELECT s.step_no, s.step, COUNT(w.user_id) AS user_cnt FROM (VALUES (1::BIGINT, 'view'), (2, 'private_message'), (3, 'payment')) s(step_no, step) LEFT JOIN walk w USING (step_no) GROUP BY ALL)
SELECT step_no, step, user_cnt, CAST(user_cnt AS DOUBLE) / NULLIF(COALESCE(LAG(user_cnt) OVER (ORDER BY step_no), user_cnt), 0) AS step_rate FROM n
""")
def _(s: Star):
    kind = F.col("event_type")
    steps = [("view", kind == "view"), ("private_message", kind == "click"), ("payment", kind == "purchase")]
    return metrics.conversion_funnel(s.table("events"), "user_id", "ts", steps)


# Estimates cannot be stated in SQL: the statement has the exact counts, and that every estimate is within four standard errors (or 2) of them.
@query("count_distinct_approx", """
WITH seen AS (SELECT DISTINCT ts::DATE AS day, user_id FROM events),
days AS (SELECT DISTINCT day FROM seen),
counts AS (
  SELECT d.day, COUNT(DISTINCT s.user_id) FILTER (WHERE s.day > d.day - 7) AS users_7d, COUNT(DISTINCT s.user_id) AS users_30d
  FROM days d JOIN seen s ON s.day <= d.day AND s.day > d.day - 30 GROUP BY d.day)
SELECT day, users_7d, users_30d, TRUE AS close_7d, TRUE AS close_30d FROM counts
""")
def _(s: Star):
    events = s.table("events")
    sketches = materialize(metrics.daily_sketches(events, "ts", "user_id"), "daily-sketches")
    seen = events.select(F.col("ts").cast("date").alias("day"), "user_id").distinct()
    out = seen.select("day").distinct()
    for days in (7, 30):
        exact = seen.select(F.explode(F.sequence("day", F.date_add("day", days - 1))).alias("day"), "user_id").distinct().groupBy("day").agg(F.count("user_id").alias(f"users_{days}d"))
        out = out.join(exact, "day").join(metrics.period_distinct(sketches, days).withColumnRenamed("distinct_cnt", f"near_{days}d"), "day")
        near = F.abs(F.col(f"near_{days}d") - F.col(f"users_{days}d")) <= F.greatest(F.lit(2.0), F.col(f"users_{days}d") * (4 * 1.04 / 64))
        out = out.withColumn(f"close_{days}d", near)
    return out.select("day", "users_7d", "users_30d", "close_7d", "close_30d")


def pii_sql() -> str:
    text, parts = "text", []
    for name, pattern, replacement in PATTERNS:
        parts.append(f"CAST(len(regexp_extract_all({text}, '{pattern}')) AS BIGINT) AS {name}_cnt")
        text = f"regexp_replace({text}, '{pattern}', '{replacement}', 'g')"
    return f"SELECT doc_id, {text} AS masked, {', '.join(parts)} FROM documents"


@query("pii_mask_text", sql(pii_sql()))
def _(s: Star):
    return s.texts("documents").select("doc_id", mask_pii("text").alias("masked"), *[c.alias(n) for n, c in pii_counts("text").items()])


@query("incremental_reindex", sql("""
SELECT d.doc_id, sha256(d.text) AS content_hash FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE l.doc_id IS NULL OR l.quality = 0
"""))
def _(s: Star):
    # The earlier snapshot: labelled documents, where those of low quality were indexed with another text.
    docs, labels = s.table("documents").select("doc_id", "text"), s.table("labels")
    old = docs.join(labels, "doc_id").select("doc_id", F.when(F.col("quality") == 0, F.concat("text", F.lit(" (old)"))).otherwise(F.col("text")).alias("text"))
    return snapshots.changed_rows(docs, snapshots.content_hashes(old, "doc_id", ["text"]), "doc_id", ["text"]).select("doc_id", "content_hash")


@query("snapshot_versions", sql("""
WITH v1 AS (SELECT d.doc_id, CASE WHEN quality = 0 THEN text || ' (old)' ELSE text END AS text, lang FROM documents d JOIN labels l ON d.doc_id = l.doc_id),
v2 AS (SELECT doc_id, text, lang FROM documents),
v3 AS (SELECT d.doc_id, CASE WHEN quality = 1 THEN text || ' (checked)' ELSE text END AS text, lang FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE toxic IS DISTINCT FROM 1),
steps AS (
  SELECT 1 AS version, doc_id, NULL AS old_text, NULL AS old_lang, FALSE AS old, text, lang, TRUE AS fresh FROM v1
  UNION ALL SELECT 2, COALESCE(a.doc_id, b.doc_id), a.text, a.lang, a.doc_id IS NOT NULL, b.text, b.lang, b.doc_id IS NOT NULL FROM v1 a FULL JOIN v2 b ON a.doc_id = b.doc_id
  UNION ALL SELECT 3, COALESCE(a.doc_id, b.doc_id), a.text, a.lang, a.doc_id IS NOT NULL, b.text, b.lang, b.doc_id IS NOT NULL FROM v2 a FULL JOIN v3 b ON a.doc_id = b.doc_id)
SELECT version, doc_id, CASE WHEN NOT old THEN 'added' WHEN NOT fresh THEN 'removed' ELSE 'changed' END AS change, sha256(text) AS text_sha256 FROM steps
WHERE NOT old OR NOT fresh OR text IS DISTINCT FROM old_text OR lang IS DISTINCT FROM old_lang
"""))
def _(s: Star):
    # Three versions of the documents: the labelled ones, those of low quality with another text; all; the ones that are not toxic, those of high quality marked.
    docs, labels = s.table("documents").select("doc_id", "text", "lang"), s.table("labels").select("doc_id", "quality", "toxic")
    marked = labels.withColumn("labelled", F.lit(True))
    labelled, quality = materialize(docs.join(marked, "doc_id", "left"), "labelled-documents"), F.col("quality")
    old = F.when(quality == 0, F.concat("text", F.lit(" (old)"))).otherwise(F.col("text"))
    checked = F.when(quality == 1, F.concat("text", F.lit(" (checked)"))).otherwise(F.col("text"))
    store = snapshots.SnapshotStore(s.spark, scratch_path(s.spark, "document-versions"), "doc_id")
    versions = [labelled.where("labelled").select("doc_id", old.alias("text"), "lang"), docs, labelled.where(~F.col("toxic").eqNullSafe(1)).select("doc_id", checked.alias("text"), "lang")]
    listed = []
    for number, rows in enumerate(versions, 1):
        store.commit(rows, number)
        stored = store.read(number).select("doc_id", F.sha2("text", 256).alias("text_sha256"))
        listed.append(store.changes(number).join(stored, "doc_id", "left").select(F.lit(number).alias("version"), "doc_id", "change", "text_sha256"))
    return reduce(DataFrame.unionAll, listed)
