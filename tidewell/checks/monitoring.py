"""Data-quality queries with their check SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewell.checks import bank as bank_checks
from tidewell.checks import charging as charging_checks
from tidewell.checks.catalog import query
from tidewell.checks.ctes import cte, sql
from tidewell.operators import quality as dq
from tidewell.operators.relational import scalar
from tidewell.plans import bank as bank_plans
from tidewell.plans import charging, metrics
from tidewell.sources.star import Star


def bad(name: str, condition: str, table: str) -> str:
    n = f"SUM(CASE WHEN {condition} THEN 1 ELSE 0 END)"
    return f"SELECT '{name}' AS check_item, CASE WHEN {n} = 0 THEN 'PASS' ELSE 'FAIL' END AS check_result, CAST({n} AS VARCHAR) AS detail FROM {table}"


def rows(name: str, table: str) -> str:
    return f"SELECT '{name}' AS check_item, CASE WHEN COUNT(*) > 0 THEN 'PASS' ELSE 'FAIL' END AS check_result, CAST(COUNT(*) AS VARCHAR) AS detail FROM {table}"


TOP3 = "(SELECT vehicle_id, ROW_NUMBER() OVER (PARTITION BY vehicle_id ORDER BY recommend_score DESC, station_id) AS r FROM pair_wide_layer)"
CARD = f"""
SELECT 'serving.charge_reco_topn each vehicle has 3 rows' AS check_item, CASE WHEN MIN(cnt) = 3 AND MAX(cnt) = 3 THEN 'PASS' ELSE 'WARN' END AS check_result,
       'min=' || MIN(cnt) || ', max=' || MAX(cnt) AS detail FROM (SELECT vehicle_id, COUNT(*) AS cnt FROM {TOP3} WHERE r <= 3 GROUP BY 1)
"""
cte("charge_quality_layer", " UNION ALL ".join([
    rows("dwd.fact_charge_order row_count > 0", "charge_fact_layer"),
    bad("dwd.fact_charge_order key not null", "order_id IS NULL OR vehicle_id IS NULL OR station_id IS NULL", "charge_fact_layer"),
    CARD,
]))


def charge_quality(s: Star):
    c = charging_checks.Charging(s)
    return dq.report(
        dq.run_checks(c.facts, dq.row_count("dwd.fact_charge_order row_count > 0"), dq.not_null("dwd.fact_charge_order key not null", "order_id", "vehicle_id", "station_id")),
        dq.group_cardinality("serving.charge_reco_topn each vehicle has 3 rows", charging.reco_topn(c.candidates()), "vehicle_id", 3),
    )


@query("dq_report", sql("SELECT * FROM bank_quality_layer UNION ALL SELECT * FROM charge_quality_layer"))
def _(s: Star):
    return dq.report(bank_checks.Bank(s).quality(), charge_quality(s))


@query("union_all_checks", sql("SELECT * FROM charge_quality_layer"))
def _(s: Star):
    return charge_quality(s)


@query("dq_not_null", sql(bad("order id or date missing", "order_id IS NULL OR order_date IS NULL", "order_raw")))
def _(s: Star):
    return dq.run_checks(s.order_raw(), dq.not_null("order id or date missing", "order_id", "order_date"))


@query("dq_non_negative", sql(bad("account balance >= 0", "balance < 0", "dim_account")))
def _(s: Star):
    return dq.run_checks(s.dim_account(), dq.non_negative("account balance >= 0", "balance"))


@query("dq_range", sql(bad("overdue days 0-45", "dpd_days < 0 OR dpd_days > 45", "fact_overdue")))
def _(s: Star):
    return dq.run_checks(s.fact_overdue(), dq.in_range("overdue days 0-45", "dpd_days", 0, 45))


@query("dq_foreign_key", sql(bad("payment receiver has an account", "u.user_id IS NULL", "payment_order p LEFT JOIN account_behavior u ON p.receiver_id = u.user_id")))
def _(s: Star):
    return dq.foreign_key("payment receiver has an account", s.payment_order(), "receiver_id", s.account_behavior(), "user_id")


@query("dq_row_count", sql(rows("messages not empty", "message_event")))
def _(s: Star):
    return dq.run_checks(s.message_event(), dq.row_count("messages not empty"))


@query("dq_group_cardinality", sql(CARD))
def _(s: Star):
    return dq.group_cardinality("serving.charge_reco_topn each vehicle has 3 rows", charging.reco_topn(charging_checks.Charging(s).candidates()), "vehicle_id", 3)


def with_severity(text: str, severity: str) -> str:
    return f"SELECT *, '{severity}' AS severity FROM ({text})"


SEGMENT_CARD = """
SELECT 'SEG_001' AS check_item, CASE WHEN MIN(cnt) = 1 AND MAX(cnt) = 1 THEN 'PASS' ELSE 'FAIL' END AS check_result, 'min=' || MIN(cnt) || ', max=' || MAX(cnt) AS detail
FROM (SELECT s.customer_id, COUNT(*) AS cnt FROM segment_layer s JOIN dim_customer c ON s.customer_id = c.customer_id GROUP BY 1)
"""
PHONE = "^[0-9]{3}[*0-9]{4}[0-9]{4}$"


@query("dq_rules_table", sql(" UNION ALL ".join([
    with_severity(bad("CUST_001", "customer_id IS NULL", "dim_customer"), "high"),
    with_severity(bad("CUST_002", f"NOT regexp_matches(name, '{PHONE}')", "dim_customer"), "medium"),
    with_severity(bad("ACCT_001", "c.customer_id IS NULL", "dim_account a LEFT JOIN dim_customer c ON a.customer_id = c.customer_id"), "high"),
    with_severity(bad("TXN_001", "txn_id IS NULL", "fact_transaction"), "high"),
    with_severity(bad("TXN_002", "amount < 0", "fact_transaction"), "high"),
    with_severity(bad("TXN_003", "txn_time > TIMESTAMP '2024-01-25'", "fact_transaction"), "medium"),
    with_severity(bad("RISK_001", "risk_score < 0 OR risk_score > 100", "risk_score_layer"), "high"),
    with_severity(SEGMENT_CARD, "medium"),
    with_severity(rows("MON_001", "bank_daily_layer"), "high"),
])))
def _(s: Star):
    b, sev = bank_checks.Bank(s, shared=True), {"with_severity": True}
    batch_time = F.lit("2024-01-25").cast("timestamp_ntz")
    # The shared customers have no phone column; the name stands in for it and fails the pattern.
    serving = bank_plans.segment_result(b.segments(), b.customers)
    return dq.report(
        dq.run_checks(b.customers, dq.not_null("CUST_001", "customer_id"), dq.matches("CUST_002", "name", PHONE), **sev),
        dq.foreign_key("ACCT_001", b.accounts, "customer_id", b.customers, **sev),
        dq.run_checks(b.transactions, dq.not_null("TXN_001", "txn_id"), dq.non_negative("TXN_002", "amount"), dq.at_most("TXN_003", "txn_time", batch_time), **sev),
        dq.run_checks(b.scores(), dq.in_range("RISK_001", "risk_score", 0, 100), **sev),
        dq.group_cardinality("SEG_001", serving, "customer_id", 1, "FAIL", **sev),
        dq.run_checks(b.daily_report(), dq.row_count("MON_001"), **sev),
    )


@query("dq_event_closure", sql("""
SELECT user_id, 'no_end' AS problem FROM (SELECT user_id FROM events WHERE event_type = 'signup' EXCEPT SELECT user_id FROM events WHERE event_type = 'purchase')
UNION ALL SELECT user_id, 'no_start' FROM (SELECT user_id FROM events WHERE event_type = 'purchase' EXCEPT SELECT user_id FROM events WHERE event_type = 'signup')
"""))
def _(s: Star):
    e, kind = s.table("events"), F.col("event_type")
    return metrics.event_closure(e.where(kind == "signup"), e.where(kind == "purchase"), "user_id")


@query("dq_round_sequence", sql("""
SELECT match_id, MIN(rank_no) AS first_no, MAX(rank_no) AS last_no, COUNT(DISTINCT rank_no) AS distinct_cnt FROM match_result GROUP BY 1
HAVING MAX(rank_no) - MIN(rank_no) + 1 <> COUNT(DISTINCT rank_no)
"""))
def _(s: Star):
    return metrics.sequence_gaps(s.match_result(), "match_id", "rank_no")


LAYERS = ("dim_customer", "dim_account", "fact_transaction", "fact_credit_snapshot", "fact_overdue", "behavior_layer", "risk_score_layer")


@query("layer_row_counts", sql(" UNION ALL ".join(f"SELECT '{n}' AS table_name, COUNT(*) AS row_cnt FROM {n}" for n in LAYERS)))
def _(s: Star):
    b = bank_checks.Bank(s, shared=True)
    frames = (b.customers, b.accounts, b.transactions, b.credit, b.overdue, b.behavior(), b.scores())
    return dq.report(*[df.agg(F.count(F.lit(1)).alias("row_cnt")).withColumn("table_name", F.lit(n)) for n, df in zip(LAYERS, frames)])


@query("dq_pass_rate", sql("""
SELECT COUNT(*) FILTER (WHERE check_result = 'PASS') AS pass_cnt, COUNT(*) AS check_cnt, CAST(COUNT(*) FILTER (WHERE check_result = 'PASS') AS DOUBLE) / COUNT(*) AS pass_rate FROM bank_quality_layer
"""))
def _(s: Star):
    return dq.pass_rate(bank_checks.Bank(s).quality())


@query("dq_duplicates", sql("SELECT l_orderkey, l_linenumber, COUNT(*) AS row_cnt FROM lineitem GROUP BY 1, 2 HAVING COUNT(*) > 1"))
def _(s: Star):
    return dq.duplicate_keys(s.table("lineitem"), "l_orderkey", "l_linenumber")


EDGES = [10.0, 25.0, 50.0, 100.0, 200.0]
BIN = " + ".join(f"CASE WHEN amount >= {e} THEN 1 ELSE 0 END" for e in EDGES)


@query("dq_distribution_drift", sql(f"""
SELECT bin, before_cnt, after_cnt, round((pb - pa) * ln(pb / pa) * 1e9) / 1e9 AS psi FROM (
  SELECT *, GREATEST(before_cnt / SUM(before_cnt) OVER (), 0.0001::DOUBLE) AS pa, GREATEST(after_cnt / SUM(after_cnt) OVER (), 0.0001::DOUBLE) AS pb FROM (
    SELECT CAST({BIN} AS BIGINT) AS bin, COUNT(*) FILTER (WHERE txn_time < TIMESTAMP '2024-01-16') AS before_cnt,
           COUNT(*) FILTER (WHERE txn_time >= TIMESTAMP '2024-01-16') AS after_cnt FROM fact_transaction GROUP BY 1))
"""))
def _(s: Star):
    cut, t = F.lit("2024-01-16").cast("timestamp_ntz"), s.fact_transaction()
    drift = dq.distribution_drift(t.where(F.col("txn_time") < cut), t.where(F.col("txn_time") >= cut), "amount", EDGES)
    return drift.withColumn("psi", F.round(F.col("psi") * F.lit(1e9)) / F.lit(1e9))
