"""Risk features, clusters and strategies of a live-streaming platform."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.functions.exprs import any_of, boundaries_crossed, int_avg, label, money_sum, rate, round_half_even, round_n, safe_ratio
from tidewell.operators.ranking import pct_rank_average, rolling_baseline, top_n
from tidewell.operators.relational import group_members, scalar


def _after(df: DataFrame, column: str, as_of: Column | None, window: str | None) -> DataFrame:
    """Rows not older than `window` (an interval text) before `as_of`; everything when no window is given."""
    return df if window is None else df.where(F.col(column) >= as_of - F.expr(f"INTERVAL {window}"))


def message_counts(messages: DataFrame) -> DataFrame:
    """Distinct messages and distinct private messages per user.

    One pass: rows are first reduced to one per (user, message), which also spreads a dominant user.
    """
    once = messages.groupBy("user_id", "message_id").agg(F.max(F.col("message_type") == "private_message").alias("private"))
    return once.groupBy("user_id").agg(F.count("message_id").alias("message_cnt_all"), F.count_if("private").alias("private_message_cnt"))


def distinct_per_user(df: DataFrame, user: str, item: str, alias: str) -> DataFrame:
    return df.groupBy(F.col(user).alias("user_id")).agg(F.count_distinct(item).alias(alias))


def payment_participants(payments: DataFrame, *columns: str) -> DataFrame:
    """Payer and receiver as participants of an order; a self-payment counts once."""
    sides = [payments.select(F.col(side).alias("user_id"), "order_id", "amount", *columns) for side in ("payer_id", "receiver_id")]
    return sides[0].union(sides[1]).distinct()


def account_risk_features(
    accounts: DataFrame, messages: DataFrame, reports: DataFrame, punishments: DataFrame, payments: DataFrame,
    as_of: Column, message_window: str | None = None, report_window: str | None = None,
    punish_window: str | None = None, register_window: str | None = None,
) -> DataFrame:
    """Account-level risk signals. `as_of` replaces the wall clock; windows (such as '24 HOUR') are optional."""
    recent = None if register_window is None else F.col("register_time") >= as_of - F.expr(f"INTERVAL {register_window}")
    paid = payment_participants(payments).groupBy("user_id").agg(
        F.count_distinct("order_id").alias("payment_order_cnt"), round_n(money_sum("amount"), 2).alias("payment_amount_sum")
    )
    parts = [
        message_counts(_after(messages, "send_time", as_of, message_window)),
        distinct_per_user(_after(reports, "report_time", as_of, report_window), "target_id", "report_id", "report_cnt_all"),
        distinct_per_user(_after(punishments, "punish_time", as_of, punish_window), "user_id", "punish_id", "punish_cnt_all"),
        group_members(accounts, "device_id", "user_id", "device_user_cnt", recent),
        group_members(accounts, "ip", "user_id", "ip_user_cnt", recent),
        paid,
    ]
    base = accounts.select("user_id", boundaries_crossed("HOUR", "register_time", as_of).alias("account_age_hours"))
    wide = reduce(lambda left, part: left.join(part, "user_id", "left"), parts, base)
    return wide.na.fill(0, [c for c in wide.columns if c not in ("user_id", "account_age_hours")])


WINDOWED_NAMES = {
    "message_cnt_all": "message_cnt_24h",
    "private_message_cnt": "private_message_cnt_24h",
    "report_cnt_all": "report_cnt_7d",
    "punish_cnt_all": "punish_cnt_30d",
    "device_user_cnt": "device_user_cnt_7d",
    "ip_user_cnt": "ip_user_cnt_7d",
}


def account_risk_features_windowed(accounts, messages, reports, punishments, payments, as_of: Column, registered: str = "7 DAY") -> DataFrame:
    """The last day of messages, week of reports and registrations, month of punishments."""
    wide = account_risk_features(accounts, messages, reports, punishments, payments, as_of, "24 HOUR", "7 DAY", "30 DAY", registered)
    return wide.withColumnsRenamed(WINDOWED_NAMES)


def user_facts(reports: DataFrame, punishments: DataFrame) -> DataFrame:
    """Distinct reports and punishments per user; users without either are absent, and so are facts without a user."""
    r = distinct_per_user(reports, "target_id", "report_id", "report_cnt")
    p = distinct_per_user(punishments, "user_id", "punish_id", "punish_cnt")
    return r.join(p, "user_id", "full_outer").where("user_id IS NOT NULL").na.fill(0, ["report_cnt", "punish_cnt"])


def room_risk_features(rooms: DataFrame, messages: DataFrame, reports: DataFrame, punishments: DataFrame) -> DataFrame:
    """Room-level counts without the messages x reports x punishments product.

    A report has one target, so distinct reports of a room are the sum over its distinct users; messages are
    counted per (room, message). Both reductions run before any join.
    """
    once = messages.groupBy("room_id", "message_id").agg(F.max(F.col("message_type") == "private_message").alias("private"))
    talk = once.groupBy("room_id").agg(F.count("message_id").alias("message_cnt"), F.count_if("private").alias("private_message_cnt"))
    presence = messages.groupBy("room_id", "user_id").agg(F.min("send_time").alias("first_message"))
    risk = presence.join(user_facts(reports, punishments), "user_id").groupBy("room_id").agg(
        F.sum("report_cnt").alias("report_cnt"),
        F.count_if(F.col("punish_cnt") > 0).alias("punished_user_cnt"),
        F.min(F.when(F.col("punish_cnt") > 0, F.col("first_message"))).alias("_first"),
    )
    wide = rooms.join(talk, "room_id", "left").join(risk, "room_id", "left")
    counts = ["message_cnt", "private_message_cnt", "report_cnt", "punished_user_cnt"]
    return wide.na.fill(0, counts).select(
        "room_id", "host_id", "room_type", "duration_seconds", *counts,
        boundaries_crossed("MINUTE", "start_time", "_first").alias("minutes_to_first_punished_message"),
    )


def normalized_content(content: str = "content") -> Column:
    return F.lower(F.regexp_replace(content, "[0-9]+", "<num>"))


def reused_templates(messages: DataFrame, min_senders: int = 2, min_messages: int = 3, as_of: Column | None = None, window: str | None = None) -> DataFrame:
    per_sender = _after(messages, "send_time", as_of, window).groupBy(normalized_content().alias("normalized_content"), "user_id").agg(
        F.count(F.lit(1)).alias("n"), F.min("send_time").alias("first"), F.max("send_time").alias("last")
    )
    return per_sender.groupBy("normalized_content").agg(
        F.count("user_id").alias("sender_cnt"),
        F.sum("n").alias("message_cnt"),
        F.min("first").alias("first_seen_time"),
        F.max("last").alias("last_seen_time"),
    ).where((F.col("sender_cnt") >= min_senders) & (F.col("message_cnt") >= min_messages))


def cluster_members(accounts: DataFrame, payments: DataFrame) -> DataFrame:
    """Distinct (cluster_type, cluster_key, user_id) edges over device, IP and payment subject."""

    def edges(df: DataFrame, kind: str, key: str, user: str) -> DataFrame:
        return df.select(F.lit(kind).alias("cluster_type"), F.col(key).alias("cluster_key"), F.col(user).alias("user_id"))

    return reduce(
        DataFrame.union,
        [
            edges(accounts, "device", "device_id", "user_id"),
            edges(accounts, "ip", "ip", "user_id"),
            edges(payments, "payment_subject", "payment_subject", "payer_id"),
            edges(payments, "payment_subject", "payment_subject", "receiver_id"),
        ],
    ).distinct()


def suspect_clusters(accounts: DataFrame, payments: DataFrame, reports: DataFrame, punishments: DataFrame, min_users: int = 2) -> DataFrame:
    """Clusters with enough members and at least one punished member; per-user facts are summed, never fanned out."""
    facts = user_facts(reports, punishments)
    c = cluster_members(accounts, payments).join(facts, "user_id", "left").groupBy("cluster_type", "cluster_key").agg(
        F.count("user_id").alias("user_cnt"),
        F.coalesce(F.sum("report_cnt"), F.lit(0)).alias("report_cnt"),
        F.coalesce(F.sum("punish_cnt"), F.lit(0)).alias("punish_cnt"),
        F.count_if(F.col("punish_cnt") > 0).alias("punished_user_cnt"),
    )
    kept = c.where((F.col("user_cnt") >= min_users) & (F.col("punished_user_cnt") >= 1))
    return kept.withColumn("punish_user_rate", safe_ratio("punished_user_cnt", "user_cnt"))


def behavior_chain(messages: DataFrame, payments: DataFrame) -> DataFrame:
    """Rooms touched, private messages and payments of every user who sent a message."""
    by_room = messages.groupBy("user_id", "room_id").agg(F.min("send_time").alias("first"))
    rooms = by_room.groupBy("user_id").agg(F.count("room_id").alias("touched_room_cnt"), F.min("first").alias("first_message_time"))
    private = message_counts(messages).select("user_id", "private_message_cnt")
    paid = payment_participants(payments, "order_time").groupBy("user_id").agg(
        F.count_distinct("order_id").alias("payment_order_cnt"),
        round_n(money_sum("amount"), 2).alias("payment_amount_sum"),
        F.min("order_time").alias("first_payment_time"),
    )
    wide = rooms.join(private, "user_id").join(paid, "user_id", "left").na.fill(0, ["payment_order_cnt", "payment_amount_sum"])
    return wide.select(
        "user_id", "touched_room_cnt", "private_message_cnt", "payment_order_cnt", "payment_amount_sum", "first_message_time", "first_payment_time"
    )


def payment_flow_risk(payments: DataFrame, min_orders: int = 2, min_refund_rate: float = 0.5) -> DataFrame:
    """Subjects with several orders or many refunds; distinct payers and receivers are counted in their own passes."""
    payers = payments.groupBy("payment_subject").agg(F.count_distinct("payer_id").alias("payer_cnt"))
    receivers = payments.groupBy("payment_subject").agg(F.count_distinct("receiver_id").alias("receiver_cnt"))
    flow = payments.groupBy("payment_subject").agg(
        F.count(F.lit(1)).alias("order_cnt"), round_n(money_sum("amount"), 2).alias("amount_sum"), int_avg("refund_flag").alias("_rate")
    )
    risky = flow.where((F.col("order_cnt") >= min_orders) | (F.col("_rate") >= min_refund_rate))
    wide = risky
    for part, key in ((payers, "_payer_subject"), (receivers, "_receiver_subject")):
        part = part.withColumnRenamed("payment_subject", key)
        wide = wide.join(part, F.col("payment_subject").eqNullSafe(F.col(key)))
    return wide.select("payment_subject", "payer_cnt", "receiver_cnt", "order_cnt", "amount_sum", round_n("_rate", 4).alias("refund_rate"))


@dataclass(frozen=True)
class StrategyRule:
    device_users: int = 3
    device_reports: int = 2
    private_messages: int = 3
    private_reports: int = 1
    payment_amount: float = 500.0


def strategy_candidates(features: DataFrame, rule: StrategyRule = StrategyRule(), names: dict[str, str] | None = None) -> DataFrame:
    """Accounts with any risk signal and the strategy their strongest signal calls for.

    `names` maps the plain feature names to other ones, for the windowed features.
    """
    col = lambda name: F.col((names or {}).get(name, name))
    reports, punished, devices = col("report_cnt_all"), col("punish_cnt_all"), col("device_user_cnt")
    rules = [
        ((devices >= rule.device_users) & (reports >= rule.device_reports), "device_cluster_review"),
        ((col("private_message_cnt") >= rule.private_messages) & (reports >= rule.private_reports), "new_account_private_message_limit"),
        ((F.col("payment_amount_sum") >= rule.payment_amount) & (punished >= 1), "payment_chain_review"),
    ]
    risky = any_of([reports >= 1, punished >= 1, devices >= rule.device_users, F.col("payment_amount_sum") >= rule.payment_amount])
    picked = features.where(risky).withColumn("strategy_name", label(rules, "manual_watchlist"))
    if names:
        return picked.select("user_id", "strategy_name")
    return picked.select(
        "user_id", "strategy_name", "account_age_hours", "private_message_cnt", "report_cnt_all", "punish_cnt_all",
        "device_user_cnt", "ip_user_cnt", "payment_amount_sum",
    )


def risk_metric_daily(punishments: DataFrame) -> DataFrame:
    kind = F.col("punish_type")
    return punishments.groupBy(F.col("punish_time").cast("date").alias("metric_date"), "risk_type").agg(
        F.count(F.lit(1)).alias("punish_cnt"),
        F.count_if(kind == "ban").alias("ban_cnt"),
        F.count_if(kind == "mute").alias("mute_cnt"),
        F.count_if(kind == "warning").alias("warning_cnt"),
    )


def bad_case_review(reviews: DataFrame, features: DataFrame) -> DataFrame:
    signals = ["report_cnt_all", "private_message_cnt", "device_user_cnt", "payment_amount_sum"]
    cases = reviews.join(features.select(F.col("user_id").alias("target_id"), *signals), "target_id", "left").na.fill(0, signals)
    cause = label(
        [
            (F.col("appeal_result") == "overturned", "possible_false_positive"),
            (F.col("device_user_cnt") >= 3, "cluster_abuse"),
            (F.col("private_message_cnt") >= 3, "private_message_abuse"),
        ],
        "single_case_review",
    )
    return cases.select("case_id", "target_id", "review_time", "review_result", "appeal_result", *signals, cause.alias("root_cause"))


def strategy_effect_snapshot(
    snapshot_date: Column, features: DataFrame, rooms: DataFrame, templates: DataFrame, clusters: DataFrame,
    payment_flows: DataFrame, candidates: DataFrame, reviews: DataFrame,
) -> DataFrame:
    rows = F.count(F.lit(1))
    cluster_rate = F.try_divide(F.sum(F.col("punish_user_rate").cast("decimal(18,4)")).cast("double"), F.count("punish_user_rate").cast("double"))
    head = reviews.agg(round_n(rate(F.col("appeal_result") == "overturned"), 4).alias("appeal_overturn_rate"))
    return head.select(
        snapshot_date.alias("snapshot_date"),
        scalar(features, rows).alias("account_feature_rows"),
        scalar(rooms, rows).alias("room_feature_rows"),
        scalar(templates, rows).alias("template_rows"),
        scalar(clusters, rows).alias("suspect_cluster_rows"),
        scalar(payment_flows, rows).alias("risky_payment_subject_rows"),
        scalar(candidates, rows).alias("strategy_candidate_rows"),
        scalar(clusters, round_n(cluster_rate, 4)).alias("avg_cluster_punish_rate"),
        "appeal_overturn_rate",
    )


@dataclass(frozen=True)
class AlertRule:
    metric_name: str
    threshold_ratio: float
    min_count: int


def metric_spike(daily: DataFrame, rule: AlertRule, keys: tuple[str, ...] = ()) -> DataFrame:
    """Days whose value is high in itself and against the mean of the seven previous rows.

    A baseline of zero counts as an infinite ratio. Without keys the metric is summed to one row per day.
    """
    m = rule.metric_name
    series = daily.groupBy(*keys, "metric_date").agg(F.sum(m).alias(m))
    based = rolling_baseline(series, m, "metric_date", "baseline_7d", keys)
    ratio = F.when(F.col("baseline_7d") == 0, F.lit(float("inf"))).otherwise(F.try_divide(F.col(m).cast("double"), F.col("baseline_7d")))
    spikes = based.withColumn("spike_ratio", ratio)
    return spikes.where((F.col(m) >= rule.min_count) & (F.col("spike_ratio") >= rule.threshold_ratio))


def rank_clusters(clusters: DataFrame) -> DataFrame:
    """Weighted percentile ranks of size, punished share and reports."""
    out = pct_rank_average(clusters, {"user_cnt": "_p0", "punish_user_rate": "_p1", "report_cnt": "_p2"})
    total = F.lit(0.4) * F.col("_p0") + F.lit(0.35) * F.col("_p1") + F.lit(0.25) * F.col("_p2")
    return out.withColumn("cluster_risk_score", total).drop("_p0", "_p1", "_p2")


def risk_event_ranking(cases: DataFrame) -> DataFrame:
    level = label(
        [
            (F.col("root_cause") == "cluster_abuse", "high"),
            ((F.col("root_cause") == "possible_false_positive") | (F.col("review_result") == "normal"), "low"),
            ((F.col("private_message_cnt") >= 3) | (F.col("report_cnt_all") >= 1), "medium"),
        ],
        "low",
    )
    out = cases.withColumn("risk_level", level)
    points = F.when(F.col("risk_level") == "high", 40.0).when(F.col("risk_level") == "medium", 20.0).otherwise(0.0)
    signals = ("report_cnt_all", "private_message_cnt", "device_user_cnt", "payment_amount_sum")
    out = pct_rank_average(out, {column: f"_p{i}" for i, column in enumerate(signals)})
    for i in range(len(signals)):
        points = points + F.lit(10.0) * F.col(f"_p{i}")
    return out.withColumn("risk_score", round_half_even(points, 2)).select(
        "case_id", "target_id", "risk_level", "risk_score", "review_result", "appeal_result", "root_cause",
        "report_cnt_all", "private_message_cnt", "device_user_cnt", "payment_amount_sum",
    )


def bad_case_summary(ranked: DataFrame) -> DataFrame:
    """One review-friendly row for the riskiest cluster."""
    top = ranked.orderBy(F.desc("cluster_risk_score"), "cluster_type", "cluster_key").limit(1)
    return top.select(
        F.lit("cluster_abuse").alias("risk_type"),
        F.coalesce("cluster_key", F.lit("unknown")).alias("actor"),
        F.lit("same device/ip -> reports -> punishment").alias("behavior_chain"),
        F.lit("multi-account cluster needs tighter gating").alias("suspected_root_cause"),
        F.lit("tighten new-account messaging limits for this cluster").alias("next_action"),
    )
