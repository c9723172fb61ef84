"""Customer behaviour, risk score, segments and abnormal transactions of a retail bank."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.functions.exprs import any_of, capped, hour_start, label, money_avg, money_sum, round_n, safe_ratio
from tidewell.operators.ranking import latest_per_key, mode_per_key
from tidewell.operators.relational import scalar, since
from tidewell.session import materialize


def with_customer(transactions: DataFrame, accounts: DataFrame) -> DataFrame:
    """Transactions of known accounts with their customer; unknown accounts drop out."""
    return transactions.join(accounts.select("account_id", "customer_id"), "account_id")


def _recent(transactions: DataFrame, days: int) -> DataFrame:
    return since(transactions, "txn_time", days)


def transaction_baseline(transactions: DataFrame, accounts: DataFrame, days: int = 30) -> DataFrame:
    spread = F.coalesce(round_n(F.stddev_samp("amount"), 2), F.lit(0.0))
    return with_customer(_recent(transactions, days), accounts).groupBy("customer_id").agg(
        round_n(money_avg("amount"), 2).alias("avg_amount_30d"),
        spread.alias("std_amount_30d"),
        F.count(F.lit(1)).alias("txn_cnt_30d"),
    )


def most_used_channel(transactions: DataFrame, accounts: DataFrame) -> DataFrame:
    modes = mode_per_key(with_customer(transactions, accounts), "customer_id", "channel", "channel_cnt")
    return modes.withColumnRenamed("channel", "most_used_channel")


def is_night(ts: Column) -> Column:
    return F.hour(ts).between(0, 5)


def customer_behavior(transactions: DataFrame, accounts: DataFrame, days: int = 30) -> DataFrame:
    """Activity of the last `days` days per customer.

    Rows are first reduced to one per customer and day; distinct active days are then a plain count, so no
    distinct aggregate is needed and a very active customer is spread over its days.
    """
    newest_day = scalar(transactions, F.max(F.col("txn_time").cast("date")))
    daily = with_customer(_recent(transactions, days), accounts).groupBy("customer_id", F.col("txn_time").cast("date").alias("day")).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("amount").cast("decimal(18,2)")).alias("amount"),
        F.count("amount").alias("n_amount"),
        F.count_if(is_night(F.col("txn_time"))).alias("night"),
        F.count_if(F.col("txn_status") == "FAILED").alias("failed"),
    )
    total = F.sum("amount").cast("double")
    return daily.groupBy("customer_id").agg(
        F.sum("n").alias("txn_cnt_30d"),
        round_n(total, 2).alias("txn_amount_30d"),
        round_n(F.try_divide(total, F.sum("n_amount").cast("double")), 2).alias("avg_txn_amount_30d"),
        F.count(F.lit(1)).alias("active_days_30d"),
        F.sum("night").alias("night_txn_cnt_30d"),
        F.sum("failed").alias("failed_txn_cnt_30d"),
        F.datediff(newest_day, F.max("day")).cast("bigint").alias("days_since_last_txn"),
    )


def latest_credit(credit: DataFrame) -> DataFrame:
    """Newest snapshot per customer; on the same day the highest credit id wins."""
    return latest_per_key(credit, ["customer_id"], [F.desc("snapshot_date"), F.desc("credit_id")])


def overdue_summary(overdue: DataFrame, days: int = 365) -> DataFrame:
    current = F.when(F.col("is_current_overdue") == 1, F.col("overdue_amount")).otherwise(0.0)
    newest = scalar(overdue, F.max("due_date"))
    return overdue.where(F.col("due_date") >= F.date_sub(newest, days)).groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("overdue_cnt_12m"),
        F.max("dpd_days").alias("max_dpd_days_12m"),
        round_n(money_sum(current), 2).alias("current_overdue_amount"),
    )


def account_flags(accounts: DataFrame) -> DataFrame:
    return accounts.groupBy("customer_id").agg(
        F.max(F.when(F.col("status") != "ACTIVE", 1).otherwise(0)).alias("non_active_account_flag"),
        money_sum("balance").alias("balance"),
    )


def customer_risk_features(customers: DataFrame, behavior: DataFrame, credit: DataFrame, overdue: DataFrame, accounts: DataFrame) -> DataFrame:
    parts = [
        behavior.select("customer_id", "txn_cnt_30d", "txn_amount_30d", "night_txn_cnt_30d", "failed_txn_cnt_30d"),
        latest_credit(credit).select("customer_id", F.col("utilization_rate").alias("credit_utilization_rate")),
        overdue_summary(overdue),
        account_flags(accounts).select("customer_id", "non_active_account_flag"),
    ]
    wide = customers.select("customer_id")
    for part in parts:
        wide = wide.join(part, "customer_id", "left")
    return wide.na.fill(0, [c for c in wide.columns if c != "customer_id"])


def risk_score(weights: tuple[float, float, float, float, float] = (35, 25, 20, 10, 10)) -> Column:
    use, dpd, night, failed, inactive = (F.lit(float(w)) for w in weights)
    return round_n(
        use * capped("credit_utilization_rate")
        + dpd * capped(F.col("max_dpd_days_12m") / F.lit(30.0))
        + night * capped(F.col("night_txn_cnt_30d") / F.lit(5.0))
        + failed * capped(F.col("failed_txn_cnt_30d") / F.lit(3.0))
        + inactive * F.col("non_active_account_flag"),
        2,
    )


def customer_risk_score(features: DataFrame, high: float = 70, medium: float = 40) -> DataFrame:
    level = label([(F.col("risk_score") >= high, "high"), (F.col("risk_score") >= medium, "medium")], "low")
    return features.withColumn("risk_score", risk_score()).withColumn("risk_level", level).select(
        "customer_id", "credit_utilization_rate", "overdue_cnt_12m", "max_dpd_days_12m", "current_overdue_amount",
        "night_txn_cnt_30d", "failed_txn_cnt_30d", "risk_score", "risk_level",
    )


def customer_segment(
    customers: DataFrame, behavior: DataFrame, accounts: DataFrame, scores: DataFrame,
    value_divisor: float = 50000.0, activity_divisor: float = 20.0,
) -> DataFrame:
    wide = (
        customers.select("customer_id")
        .join(behavior.select("customer_id", "txn_cnt_30d", "txn_amount_30d", "days_since_last_txn"), "customer_id", "left")
        .join(account_flags(accounts).select("customer_id", "balance"), "customer_id", "left")
        .join(scores.select("customer_id", "risk_score", "risk_level"), "customer_id", "left")
        .na.fill({"txn_cnt_30d": 0, "txn_amount_30d": 0.0, "days_since_last_txn": 999, "balance": 0.0, "risk_score": 0.0, "risk_level": "low"})
        .withColumns(
            {
                "value_score": round_n(capped(F.col("txn_amount_30d") / F.lit(value_divisor) * F.lit(100.0), 100), 2),
                "active_score": round_n(capped(F.col("txn_cnt_30d") / F.lit(activity_divisor) * F.lit(100.0), 100), 2),
            }
        )
    )
    value, active, risk = F.col("value_score"), F.col("active_score"), F.col("risk_score")
    rules = [
        ((value >= 80) & (risk < 40), "high_value_low_risk"),
        ((value >= 80) & (risk >= 70), "high_value_high_risk"),
        (F.col("days_since_last_txn") >= 30, "silent_customer"),
        ((active >= 40) & (risk < 70), "active_normal_customer"),
    ]
    return wide.withColumn("customer_segment", label(rules, "general_customer"))


@dataclass(frozen=True)
class AbnormalRule:
    """Multiples of the customer's mean amount, and transactions per hour, that trigger each rule."""

    spike: float = 3.0
    night: float = 2.0
    channel: float = 1.5
    hourly: int = 3
    hourly_high: int = 4
    stack_utilization: float | None = None


def abnormal_transactions(transactions: DataFrame, accounts: DataFrame, rule: AbnormalRule = AbnormalRule(), credit: DataFrame | None = None) -> DataFrame:
    """Transactions far above the customer's habit, with reason and severity.

    One reduction of the facts to (customer, hour, channel), written once, gives the mean amount, the usual channel and
    the hourly count; the facts are then joined once, on (customer, hour), which also spreads a dominant customer over its hours.
    With `rule.stack_utilization` set and credit given, large transactions of customers above that credit
    utilisation are reported as `risk_stack`.
    """
    no_time = F.lit("1900-01-01").cast("timestamp_ntz")  # transactions without a time share one group, as in a window
    recent = F.col("txn_time") >= scalar(transactions, F.max("txn_time")) - F.make_dt_interval(F.lit(30))
    facts = with_customer(transactions, accounts).withColumn("txn_hour", F.coalesce(hour_start("txn_time"), no_time))
    reduced = facts.groupBy("customer_id", "txn_hour", "channel").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.when(recent, F.col("amount").cast("decimal(18,2)"))).alias("amount"), F.count(F.when(recent, F.col("amount"))).alias("n_amount")
    )
    reduced = materialize(reduced, "hourly-habits")
    means = reduced.groupBy("customer_id").agg(round_n(F.try_divide(F.sum("amount").cast("double"), F.sum("n_amount").cast("double")), 2).alias("avg_amount_30d"))
    channels = reduced.groupBy("customer_id", "channel").agg(F.sum("n").alias("n"))
    usual_channels = channels.groupBy("customer_id").agg(F.min(F.struct((-F.col("n")).alias("less"), "channel"))["channel"].alias("most_used_channel"))
    habits = means.join(usual_channels, "customer_id", "left")
    if rule.stack_utilization is not None and credit is not None:
        habits = habits.join(latest_credit(credit).select("customer_id", "utilization_rate"), "customer_id", "left")
    hourly = reduced.groupBy("customer_id", "txn_hour").agg(F.sum("n").alias("hourly_txn_cnt")).join(habits, "customer_id", "left")
    t = facts.join(hourly, ["customer_id", "txn_hour"])

    amount, hits = F.col("amount"), F.col("hourly_txn_cnt")
    mean = F.coalesce("avg_amount_30d", "amount")
    usual = F.coalesce("most_used_channel", "channel")
    night, failed = is_night(F.col("txn_time")), F.col("txn_status") == "FAILED"
    reasons = [
        (amount > mean * rule.spike, "amount_spike"),
        (hits >= rule.hourly, "high_frequency"),
        (night & (amount > mean * rule.night), "night_large_txn"),
        ((F.col("channel") != usual) & (amount > mean * rule.channel), "unusual_channel"),
        (failed & (amount > mean), "failed_large_txn"),
    ]
    keep = [
        amount > mean * rule.night,
        hits >= rule.hourly,
        night & (amount > mean * rule.channel),
        (F.col("channel") != usual) & (amount > mean * rule.channel),
        failed & (amount > mean),
    ]
    if rule.stack_utilization is not None:
        stacked = (F.col("utilization_rate") >= rule.stack_utilization) & (amount > mean * rule.channel)
        reasons.append((stacked, "risk_stack"))
        keep.append(stacked)
    severity = label(
        [
            ((amount > mean * rule.spike) | (hits >= rule.hourly_high), "high"),
            ((amount > mean * rule.night) | (hits >= rule.hourly), "medium"),
        ],
        "low",
    )
    return t.where(any_of(keep)).select(
        "txn_id", "customer_id", "account_id", "amount", "txn_time", "channel", "txn_type", "txn_status",
        label(reasons, "normal").alias("abnormal_reason"), severity.alias("severity"),
    )


def high_risk_list(scores: DataFrame, customers: DataFrame) -> DataFrame:
    return scores.where("risk_level = 'high'").join(customers, "customer_id").select(
        "customer_id", "name", "city", "risk_score", "risk_level", "credit_utilization_rate", "max_dpd_days_12m",
        "night_txn_cnt_30d", "failed_txn_cnt_30d",
    ).orderBy(F.desc("risk_score"), "customer_id")


def segment_result(segments: DataFrame, customers: DataFrame) -> DataFrame:
    return segments.join(customers, "customer_id").select(
        "customer_id", "name", "city", "customer_segment", "value_score", "active_score", "risk_score", "risk_level"
    ).orderBy("customer_segment", F.desc("risk_score"), "customer_id")


def abnormal_alerts(abnormal: DataFrame, customers: DataFrame) -> DataFrame:
    """Severity sorts as text, so `medium` comes before `high`."""
    return abnormal.where(F.col("severity").isin("high", "medium")).join(customers, "customer_id").select(
        "txn_id", "customer_id", "name", "city", "amount", "txn_time", "channel", "txn_status", "abnormal_reason", "severity"
    ).orderBy(F.desc("severity"), F.desc("amount"), F.desc("txn_time"), "txn_id")


def segment_distribution(segments: DataFrame) -> DataFrame:
    return segments.groupBy("customer_segment").agg(F.count(F.lit(1)).alias("customer_cnt")).orderBy(F.desc("customer_cnt"), "customer_segment")


def risk_daily_report(
    transactions: DataFrame, customers: DataFrame, behavior: DataFrame, scores: DataFrame, abnormal: DataFrame,
    overdue: DataFrame, credit: DataFrame, quality: DataFrame,
) -> DataFrame:
    """One row of headline numbers; each table is aggregated once."""
    rows = F.count(F.lit(1))
    txn = transactions.agg(F.max(F.col("txn_time").cast("date")).alias("metric_date"), rows.alias("total_txn_cnt"))
    return txn.select(
        "metric_date",
        scalar(customers, rows).alias("total_customer_cnt"),
        scalar(behavior, F.count_if(F.col("txn_cnt_30d") > 0)).alias("active_customer_cnt_30d"),
        scalar(scores, F.count_if(F.col("risk_level") == "high")).alias("high_risk_customer_cnt"),
        scalar(abnormal, rows).alias("abnormal_txn_cnt"),
        "total_txn_cnt",
        scalar(overdue, F.count_if(F.col("is_current_overdue") == 1)).alias("_overdue"),
        scalar(credit, rows).alias("_credit"),
        scalar(quality, F.struct(F.count_if(F.col("check_result") == "PASS").alias("passed"), rows.alias("checks"))).alias("_quality"),
    ).select(
        "metric_date", "total_customer_cnt", "active_customer_cnt_30d", "high_risk_customer_cnt", "abnormal_txn_cnt", "total_txn_cnt",
        safe_ratio("abnormal_txn_cnt", "total_txn_cnt").alias("abnormal_txn_rate"),
        safe_ratio("_overdue", "_credit").alias("overdue_customer_rate"),
        F.col("_quality.passed").alias("quality_pass_cnt"), F.col("_quality.checks").alias("quality_check_cnt"),
    )
