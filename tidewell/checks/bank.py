"""Bank queries with their check SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewell.checks.catalog import query
from tidewell.checks.ctes import cte, money, ratio, rnd, sql
from tidewell.operators import quality as dq
from tidewell.plans import bank
from tidewell.session import materialize
from tidewell.sources.star import Star


def first_rule(rules: list[tuple[str, str]], otherwise: str) -> str:
    """The name of the first rule that holds, from a list of (name, condition)."""
    return "CASE " + " ".join(f"WHEN {condition} THEN '{name}'" for name, condition in rules) + f" ELSE '{otherwise}' END"


def any_of(conditions: list[str]) -> str:
    return " OR ".join(f"({condition})" for condition in conditions)


def when(condition: str, value: str) -> str:
    return f"CASE WHEN {condition} THEN {value} END"


cte("txn_customer", "SELECT t.*, owner.customer_id FROM fact_transaction t JOIN dim_account owner USING (account_id)")
# The same with the marks that all habits are counted from.
cte("txn_marked", """
SELECT *, txn_time >= (SELECT MAX(txn_time) FROM fact_transaction) - INTERVAL 30 DAY AS recent, hour(txn_time) < 6 AS night, txn_time::DATE AS day
FROM txn_customer
""")
cte("habit_layer", f"""
SELECT customer_id, COUNT(*) FILTER (recent) AS n, {money(when('recent', 'amount'))} AS total, COUNT(amount) FILTER (recent) AS paid,
       STDDEV_SAMP(amount) FILTER (recent) AS deviation, COUNT(DISTINCT day) FILTER (recent) AS days,
       COUNT(*) FILTER (recent AND night) AS nights, COUNT(*) FILTER (recent AND txn_status = 'FAILED') AS failures, MAX(day) FILTER (recent) AS last_day
FROM txn_marked GROUP BY ALL HAVING bool_or(recent)
""")
cte("txn_baseline_layer", f"SELECT customer_id, {rnd('total / paid', 2)} AS avg_amount_30d, COALESCE({rnd('deviation', 2)}, 0) AS std_amount_30d, n AS txn_cnt_30d FROM habit_layer")
cte("channel_layer", """
SELECT customer_id, best.channel AS most_used_channel, -best.less AS channel_cnt
FROM (SELECT customer_id, MIN({'less': -n, 'channel': channel}) AS best FROM (SELECT customer_id, channel, COUNT(*) AS n FROM txn_marked GROUP BY ALL) GROUP BY ALL)
""")
cte("behavior_layer", f"""
SELECT customer_id, n AS txn_cnt_30d, {rnd('total', 2)} AS txn_amount_30d, {rnd('total / paid', 2)} AS avg_txn_amount_30d, days AS active_days_30d,
       nights AS night_txn_cnt_30d, failures AS failed_txn_cnt_30d, (SELECT MAX(txn_time)::DATE FROM fact_transaction) - last_day AS days_since_last_txn
FROM habit_layer
""")
cte("latest_credit_layer", """
SELECT f.* FROM fact_credit_snapshot f
WHERE NOT EXISTS (SELECT 1 FROM fact_credit_snapshot g WHERE g.customer_id = f.customer_id AND (g.snapshot_date, g.credit_id) > (f.snapshot_date, f.credit_id))
""")
cte("overdue_layer", f"""
SELECT customer_id, COUNT(*) AS overdue_cnt_12m, MAX(dpd_days) AS max_dpd_days_12m, {rnd(money('is_current_overdue * overdue_amount'), 2)} AS current_overdue_amount
FROM fact_overdue WHERE due_date >= (SELECT MAX(due_date) FROM fact_overdue) - INTERVAL 365 DAY GROUP BY customer_id
""")
cte("inactive_layer", "SELECT DISTINCT customer_id, 1 AS non_active_account_flag FROM dim_account WHERE status <> 'ACTIVE'")
cte("risk_feature_layer", """
SELECT customer_id, COALESCE(txn_cnt_30d, 0) AS txn_cnt_30d, COALESCE(txn_amount_30d, 0) AS txn_amount_30d, COALESCE(night_txn_cnt_30d, 0) AS night_txn_cnt_30d,
       COALESCE(failed_txn_cnt_30d, 0) AS failed_txn_cnt_30d, COALESCE(utilization_rate, 0)::DOUBLE AS credit_utilization_rate, COALESCE(overdue_cnt_12m, 0) AS overdue_cnt_12m,
       COALESCE(max_dpd_days_12m, 0)::BIGINT AS max_dpd_days_12m, COALESCE(current_overdue_amount, 0) AS current_overdue_amount, COALESCE(non_active_account_flag, 0) AS non_active_account_flag
FROM (SELECT customer_id FROM dim_customer)
LEFT JOIN (SELECT customer_id, txn_cnt_30d, txn_amount_30d, night_txn_cnt_30d, failed_txn_cnt_30d FROM behavior_layer) USING (customer_id)
LEFT JOIN (SELECT customer_id, utilization_rate FROM latest_credit_layer) USING (customer_id)
LEFT JOIN overdue_layer USING (customer_id) LEFT JOIN inactive_layer USING (customer_id)
""")
# Fixed values: (weight, signal, value at which it is full) of the score, and the levels.
WEIGHTS = ((35, "credit_utilization_rate", 1), (25, "max_dpd_days_12m", 30), (20, "night_txn_cnt_30d", 5), (10, "failed_txn_cnt_30d", 3), (10, "non_active_account_flag", 1))
LEVELS = [("high", "risk_score >= 70"), ("medium", "risk_score >= 40")]
POINTS = " + ".join(f"{weight}e0 * LEAST({name} / {full}e0, 1e0)" for weight, name, full in WEIGHTS)
cte("risk_score_layer", f"""
SELECT *, {first_rule(LEVELS, 'low')} AS risk_level
FROM (SELECT * EXCLUDE (txn_cnt_30d, txn_amount_30d, non_active_account_flag), {rnd(POINTS, 2)} AS risk_score FROM risk_feature_layer)
""")
cte("balance_layer", f"SELECT customer_id, {money('balance')} AS balance FROM dim_account GROUP BY ALL")
cte("segment_base", f"""
SELECT customer_id, COALESCE(txn_cnt_30d, 0) AS txn_cnt_30d, COALESCE(txn_amount_30d, 0) AS txn_amount_30d, COALESCE(days_since_last_txn, 999) AS days_since_last_txn, COALESCE(balance, 0) AS balance,
       risk_score, risk_level, {rnd('LEAST(COALESCE(txn_amount_30d, 0) / 5000e0 * 1e2, 1e2)', 2)} AS value_score, {rnd('LEAST(COALESCE(txn_cnt_30d, 0) / 20e0 * 1e2, 1e2)', 2)} AS active_score
FROM (SELECT customer_id FROM dim_customer) LEFT JOIN behavior_layer USING (customer_id) LEFT JOIN balance_layer USING (customer_id)
LEFT JOIN (SELECT customer_id, risk_score, risk_level FROM risk_score_layer) USING (customer_id)
""")
# The first segment that fits.
SEGMENTS = [
    ("high_value_low_risk", "value_score >= 80 AND risk_score < 40"), ("high_value_high_risk", "value_score >= 80 AND risk_score >= 70"), ("silent_customer", "days_since_last_txn >= 30"),
    ("active_normal_customer", "active_score >= 40 AND risk_score < 70"),
]
cte("segment_layer", f"SELECT *, {first_rule(SEGMENTS, 'general_customer')} AS customer_segment FROM segment_base")
cte("abnormal_enriched", """
SELECT t.* EXCLUDE (night), t.night IS TRUE AS night, COALESCE(b.avg_amount_30d, t.amount) AS mean, t.channel <> COALESCE(m.most_used_channel, t.channel) AS unusual, t.txn_status = 'FAILED' AS failed,
       (SELECT COUNT(*) FROM txn_marked o WHERE o.customer_id = t.customer_id AND date_trunc('hour', o.txn_time) IS NOT DISTINCT FROM date_trunc('hour', t.txn_time)) AS hits
FROM txn_marked t LEFT JOIN txn_baseline_layer b USING (customer_id) LEFT JOIN channel_layer m USING (customer_id)
""")
# The first reason that holds, what is reported, and how severe it is.
REASONS = [
    ("amount_spike", "amount > mean * 3"), ("high_frequency", "hits >= 3"), ("night_large_txn", "night AND amount > mean * 2"), ("unusual_channel", "unusual AND amount > mean * 1.5e0"),
    ("failed_large_txn", "failed AND amount > mean"),
]
KEPT = ["amount > mean * 2", "hits >= 3", "(night OR unusual) AND amount > mean * 1.5e0", "failed AND amount > mean"]
SEVERITY = [("high", "amount > mean * 3 OR hits >= 4"), ("medium", "amount > mean * 2 OR hits >= 3")]


def abnormal_sql(source: str = "abnormal_enriched", reasons: tuple[tuple[str, str], ...] = (), kept: tuple[str, ...] = ()) -> str:
    return f"""
SELECT txn_id, customer_id, account_id, amount, txn_time, channel, txn_type, txn_status, {first_rule([*REASONS, *reasons], 'normal')} AS abnormal_reason, {first_rule(SEVERITY, 'low')} AS severity
FROM {source} WHERE {any_of([*KEPT, *kept])}
"""


cte("abnormal_layer", abnormal_sql())
# Name of the check, where it looks, and what a bad row is.
QUALITY = [
    ("dwd.dim_customer customer_id not null", "dim_customer", "customer_id IS NULL"),
    ("dwd.dim_account fk customer_id matched", "dim_account", "NOT EXISTS (SELECT 1 FROM dim_customer c WHERE c.customer_id = x.customer_id)"),
    ("dwd.fact_transaction amount >= 0", "fact_transaction", "amount < 0"),
    ("ads.customer_risk_score range 0-100", "risk_score_layer", "risk_score NOT BETWEEN 0 AND 100"),
]
cte("bank_quality_layer", " UNION ALL ".join(
    f"SELECT '{item}' AS check_item, IF(n = 0, 'PASS', 'FAIL') AS check_result, n::VARCHAR AS detail FROM (SELECT COUNT(*) AS n FROM {place} x WHERE {wrong})" for item, place, wrong in QUALITY
))


class Bank:
    """The layers over one set of tables, each a lazy frame."""

    # The shared tables hold small amounts; the reference divisor of 50,000 would leave every value score near 0.
    VALUE_DIVISOR = 5000.0

    def __init__(self, s: Star, shared: bool = False):
        """With `shared`, a layer with several readers is written once instead of being computed per reader."""
        self.shared, self._layers = shared, {}
        self.customers, self.accounts, self.transactions = s.dim_customer(), s.dim_account(), s.fact_transaction()
        self.credit, self.overdue = s.fact_credit_snapshot(), s.fact_overdue()

    def _layer(self, name: str, build):
        if not self.shared:
            return build()
        if name not in self._layers:
            self._layers[name] = materialize(build(), name)
        return self._layers[name]

    def behavior(self):
        return self._layer("behavior", lambda: bank.customer_behavior(self.transactions, self.accounts))

    def features(self):
        return bank.customer_risk_features(self.customers, self.behavior(), self.credit, self.overdue, self.accounts)

    def scores(self):
        return self._layer("scores", lambda: bank.customer_risk_score(self.features()))

    def segments(self):
        return bank.customer_segment(self.customers, self.behavior(), self.accounts, self.scores(), self.VALUE_DIVISOR)

    def abnormal(self):
        return self._layer("abnormal", lambda: bank.abnormal_transactions(self.transactions, self.accounts))

    def daily_report(self):
        return bank.risk_daily_report(self.transactions, self.customers, self.behavior(), self.scores(), self.abnormal(), self.overdue, self.credit, self.quality())

    def quality(self):
        return dq.report(
            dq.run_checks(self.customers, dq.not_null("dwd.dim_customer customer_id not null", "customer_id")),
            dq.foreign_key("dwd.dim_account fk customer_id matched", self.accounts, "customer_id", self.customers),
            dq.run_checks(self.transactions, dq.non_negative("dwd.fact_transaction amount >= 0", "amount")),
            dq.run_checks(self.scores(), dq.in_range("ads.customer_risk_score range 0-100", "risk_score", 0, 100)),
        )


@query("txn_baseline", sql("SELECT * FROM txn_baseline_layer"))
def _(s: Star):
    return bank.transaction_baseline(s.fact_transaction(), s.dim_account())


@query("most_used_channel", sql("SELECT * FROM channel_layer"))
def _(s: Star):
    return bank.most_used_channel(s.fact_transaction(), s.dim_account())


@query("customer_behavior_30d", sql("SELECT * FROM behavior_layer"))
def _(s: Star):
    return Bank(s).behavior()


@query("customer_risk_features", sql("SELECT * FROM risk_feature_layer"))
def _(s: Star):
    return Bank(s).features()


@query("customer_risk_score", sql("SELECT * FROM risk_score_layer"))
def _(s: Star):
    return Bank(s).scores()


@query("customer_segment", sql("SELECT * FROM segment_layer"))
def _(s: Star):
    return Bank(s, shared=True).segments()


@query("abnormal_transactions", sql("SELECT * FROM abnormal_layer"))
def _(s: Star):
    return Bank(s).abnormal()


STACKED = "utilization_rate >= 0.8::DOUBLE AND amount > mean * 1.5e0"


@query("risk_stack_rule", sql(abnormal_sql(
    "(SELECT * FROM abnormal_enriched LEFT JOIN (SELECT customer_id, utilization_rate FROM latest_credit_layer) USING (customer_id))", (("risk_stack", STACKED),), (STACKED,)
)))
def _(s: Star):
    b = Bank(s)
    return bank.abnormal_transactions(b.transactions, b.accounts, bank.AbnormalRule(stack_utilization=0.8), b.credit)


@query("high_risk_list", sql("""
SELECT s.customer_id, name, city, risk_score, risk_level, credit_utilization_rate, max_dpd_days_12m, night_txn_cnt_30d, failed_txn_cnt_30d
FROM risk_score_layer s JOIN dim_customer c ON s.customer_id = c.customer_id WHERE risk_level = 'high'
"""))
def _(s: Star):
    b = Bank(s)
    return bank.high_risk_list(b.scores(), b.customers)


@query("segment_result", sql("""
SELECT s.customer_id, name, city, customer_segment, value_score, active_score, risk_score, risk_level
FROM segment_layer s JOIN dim_customer c ON s.customer_id = c.customer_id
"""))
def _(s: Star):
    b = Bank(s, shared=True)
    return bank.segment_result(b.segments(), b.customers)


@query("abnormal_alerts", sql("""
SELECT txn_id, a.customer_id, name, city, amount, txn_time, channel, txn_status, abnormal_reason, severity
FROM abnormal_layer a JOIN dim_customer c ON a.customer_id = c.customer_id WHERE severity IN ('high', 'medium')
"""))
def _(s: Star):
    b = Bank(s)
    return bank.abnormal_alerts(b.abnormal(), b.customers)


@query("segment_distribution", sql("SELECT customer_segment, COUNT(*) AS customer_cnt FROM segment_layer GROUP BY 1"))
def _(s: Star):
    return bank.segment_distribution(Bank(s, shared=True).segments())


cte("bank_daily_layer", f"""
SELECT metric_date, total_customer_cnt, active_customer_cnt_30d, high_risk_customer_cnt, abnormal_txn_cnt, total_txn_cnt,
       {ratio('abnormal_txn_cnt', 'total_txn_cnt')} AS abnormal_txn_rate, {ratio('open_cnt', 'credit_cnt')} AS overdue_customer_rate, quality_pass_cnt, quality_check_cnt
FROM (SELECT MAX(txn_time)::DATE AS metric_date, COUNT(*) AS total_txn_cnt FROM fact_transaction), (SELECT COUNT(*) AS total_customer_cnt FROM dim_customer),
     (SELECT COUNT_IF(txn_cnt_30d > 0)::BIGINT AS active_customer_cnt_30d FROM behavior_layer), (SELECT COUNT_IF(risk_level = 'high')::BIGINT AS high_risk_customer_cnt FROM risk_score_layer),
     (SELECT COUNT(*) AS abnormal_txn_cnt FROM abnormal_layer), (SELECT COUNT_IF(is_current_overdue = 1) AS open_cnt FROM fact_overdue), (SELECT COUNT(*) AS credit_cnt FROM fact_credit_snapshot),
     (SELECT COUNT_IF(check_result = 'PASS')::BIGINT AS quality_pass_cnt, COUNT(*) AS quality_check_cnt FROM bank_quality_layer)
""")


@query("risk_daily_report", sql("SELECT * FROM bank_daily_layer"))
def _(s: Star):
    return Bank(s, shared=True).daily_report()
