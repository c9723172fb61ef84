"""Operating metrics: activity, retention, funnels, alerts, experiments, outliers, cohorts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell.functions.exprs import label, rate, round_n
from tidewell.operators.ranking import exact_quantiles, rolling_baseline
from tidewell.operators.relational import scalar


def _ratio(a: Column, b: Column) -> Column:
    return F.try_divide(a.cast("double"), b.cast("double"))


def user_days(events: DataFrame, user: str, day: Column, paid: Column) -> DataFrame:
    """One row per (user, day): events and exact revenue. Every activity metric starts from this reduction."""
    return events.groupBy(F.col(user).alias("user_id"), day.alias("dt")).agg(
        F.count(F.lit(1)).alias("event_cnt"), F.coalesce(F.sum(paid.cast("decimal(18,2)")), F.lit(0)).cast("decimal(28,2)").alias("revenue")
    )


def daily_active(days: DataFrame) -> DataFrame:
    """DAU, new users, revenue, pay rate, ARPU, ARPPU and events per user, per day."""
    first = days.groupBy("user_id").agg(F.min("dt").alias("dt")).groupBy("dt").agg(F.count(F.lit(1)).alias("new_user_cnt"))
    payers, dau = F.count_if(F.col("revenue") > 0), F.count(F.lit(1))
    revenue = F.sum("revenue").cast("double")
    active = days.groupBy("dt").agg(
        dau.alias("dau"), payers.alias("payer_cnt"), revenue.alias("revenue"), _ratio(payers, dau).alias("pay_rate"),
        _ratio(revenue, dau).alias("arpu"), F.try_divide(revenue, F.nullif(payers, F.lit(0)).cast("double")).alias("arppu"),
        _ratio(F.sum("event_cnt"), dau).alias("events_per_user"),
    )
    return active.join(first, "dt", "left").na.fill(0, ["new_user_cnt"])


def retention(days: DataFrame, offsets: Sequence[int] = (1, 7)) -> DataFrame:
    """Share of a first-day cohort that is active exactly n days later.

    A user's active days are flagged against their own first day; no user list is ever joined with itself.
    """
    flags = [F.max(F.when(F.col("dt") == F.date_add("first_dt", n), 1).otherwise(0)).alias(f"d{n}") for n in offsets]
    first = F.min("dt").over(Window.partitionBy("user_id"))
    per_user = days.withColumn("first_dt", first).groupBy("user_id", "first_dt").agg(*flags)
    cohort = F.count(F.lit(1))
    return per_user.groupBy(F.col("first_dt").alias("cohort_dt")).agg(
        cohort.alias("cohort_size"), *[_ratio(F.sum(f"d{n}"), cohort).alias(f"d{n}_rate") for n in offsets]
    )


def returning_users(days: DataFrame, gap_days: int, as_of: Column) -> DataFrame:
    """Per user: returns after at least `gap_days` days away, and whether the user has lapsed by `as_of`."""
    previous = F.lag("dt").over(Window.partitionBy("user_id").orderBy("dt"))
    gaps = days.withColumn("gap", F.datediff("dt", previous))
    return gaps.groupBy("user_id").agg(
        F.count_if(F.col("gap") > gap_days).alias("return_cnt"), (F.datediff(as_of, F.max("dt")) >= gap_days).alias("is_lapsed")
    )


def player_ltv(days: DataFrame) -> DataFrame:
    """Cumulative revenue per user and day."""
    w = Window.partitionBy("user_id").orderBy("dt").rowsBetween(Window.unboundedPreceding, 0)
    return days.select("user_id", "dt", F.col("revenue").cast("double").alias("revenue"), F.sum("revenue").over(w).cast("double").alias("ltv"))


def match_health(starts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Completion rate, mean duration of completed games and share of ranked games per group."""
    done = F.col("completed") == 1
    return starts.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("start_cnt"),
        rate(done).alias("completion_rate"),
        _ratio(F.sum(F.when(done, F.col("duration_sec"))), F.count_if(done)).alias("avg_duration_sec"),
        rate(F.col("mode") == "ranked").alias("ranked_share"),
    )


def activity_alerts(daily: DataFrame, dau_floor: float = 0.85, arpu_drop: float = 0.20, surge: float = 2.0) -> DataFrame:
    """Days with DAU below 85 % of the last week's mean, a falling ARPU, or more than twice the usual events."""
    based = rolling_baseline(daily, "dau", "dt", "dau_mean_7d")
    based = rolling_baseline(based, "event_cnt", "dt", "event_mean_7d")
    before = F.lag("arpu").over(Window.partitionBy(F.lit(0)).orderBy("dt"))
    flags = based.withColumns(
        {
            "dau_alert": F.coalesce(F.col("dau") < F.col("dau_mean_7d") * dau_floor, F.lit(False)),
            "arpu_alert": F.coalesce(F.try_divide(F.col("arpu") - before, before) < -arpu_drop, F.lit(False)),
            "surge_alert": F.coalesce(F.col("event_cnt") > F.col("event_mean_7d") * surge, F.lit(False)),
        }
    )
    return flags.where("dau_alert OR arpu_alert OR surge_alert").select("dt", "dau", "dau_mean_7d", "arpu", "dau_alert", "arpu_alert", "surge_alert")


def comp_alerts(comps: DataFrame, top4: float = 0.65, pick: float = 0.15) -> DataFrame:
    return comps.where((F.col("top4_rate") > top4) & (F.col("pick_rate") > pick))


def strategy_rates(cases: DataFrame) -> DataFrame:
    """Review outcomes: expects `review_result`, `appeal_result` and `is_hit` (a strategy acted on the case)."""
    hit, bad = F.col("is_hit") == 1, F.col("review_result") == "violation"
    appealed, overturned = F.col("appeal_result") != "not_appealed", F.col("appeal_result") == "overturned"
    n = F.count_if
    wrong = hit & (overturned | (F.col("review_result") == "normal"))
    return cases.agg(
        F.count(F.lit(1)).alias("case_cnt"),
        _ratio(n(bad & ~hit), n(bad)).alias("miss_rate"),
        _ratio(n(wrong), n(hit)).alias("false_positive_rate"),
        _ratio(n(hit & appealed), n(hit)).alias("appeal_rate"),
        _ratio(n(overturned), F.count(F.lit(1))).alias("overturn_rate"),
        _ratio(n(hit & bad), n(hit)).alias("hit_confirm_rate"),
    )


def cohort_risk_rate(accounts: DataFrame, punished: DataFrame, period: Column, *keys: str) -> DataFrame:
    """Share of punished accounts per registration period and further keys."""
    risky = punished.select("user_id").distinct().withColumn("risky", F.lit(1))
    joined = accounts.join(risky, "user_id", "left").groupBy(period.alias("period"), *keys)
    return joined.agg(F.count(F.lit(1)).alias("account_cnt"), F.sum(F.coalesce("risky", F.lit(0))).alias("risky_cnt"), rate(F.col("risky") == 1).alias("risk_rate"))


def outliers(df: DataFrame, value: str, z_limit: float = 3.0, whisker: float = 1.5) -> DataFrame:
    """z-score and inter-quartile flags against the whole column; quartiles are exact."""
    quartiles = exact_quantiles(df, value, {"q1": 0.25, "q3": 0.75})
    reach = (F.col("q3") - F.col("q1")) * whisker
    fence = scalar(quartiles, F.struct(F.max(F.col("q1") - reach).alias("low"), F.max(F.col("q3") + reach).alias("high")))
    moments = scalar(df, F.struct(F.avg(value).alias("mean"), F.stddev_samp(value).alias("spread")))
    low, high, mean, spread = fence["low"], fence["high"], moments["mean"], moments["spread"]
    v = F.col(value)
    return df.withColumns(
        {
            "z_score": round_n(F.try_divide(v - mean, spread), 6),
            "z_outlier": F.abs(F.try_divide(v - mean, spread)) > z_limit,
            "iqr_outlier": (v < low) | (v > high),
        }
    )


def ab_test(groups: DataFrame, control: str, treatment: str, z_value: float = 1.959963984540054) -> DataFrame:
    """Two-proportion test. Expects `group`, `n` and `converted`; one row with difference, z and interval."""
    g = F.col("group")
    pick = lambda name, c: F.sum(F.when(g == name, F.col(c))).cast("double")
    s = groups.agg(
        pick(control, "n").alias("n_a"), pick(control, "converted").alias("x_a"), pick(treatment, "n").alias("n_b"), pick(treatment, "converted").alias("x_b")
    ).withColumns({"rate_a": F.try_divide("x_a", "n_a"), "rate_b": F.try_divide("x_b", "n_b")})
    diff = F.col("rate_b") - F.col("rate_a")
    pooled = (F.col("x_a") + F.col("x_b")) / (F.col("n_a") + F.col("n_b"))
    se0 = F.sqrt(pooled * (F.lit(1.0) - pooled) * (F.lit(1.0) / F.col("n_a") + F.lit(1.0) / F.col("n_b")))
    part = lambda k: F.col(f"rate_{k}") * (F.lit(1.0) - F.col(f"rate_{k}")) / F.col(f"n_{k}")
    se1 = F.sqrt(part("a") + part("b"))
    z = F.try_divide(diff, se0)
    return s.select(
        "rate_a", "rate_b", diff.alias("difference"), z.alias("z"), (diff - F.lit(z_value) * se1).alias("ci_low"),
        (diff + F.lit(z_value) * se1).alias("ci_high"), F.coalesce(F.abs(z) > z_value, F.lit(False)).alias("significant"),
    )


def activation_rate(active: DataFrame, trait: str, game: Sequence[str], total: DataFrame) -> DataFrame:
    """Games in which a trait was active / all games. A game is one player's run of a match."""
    games = active.select(trait, *game).distinct().groupBy(trait).agg(F.count(F.lit(1)).alias("game_cnt"))
    all_games = total.select(*game).distinct().agg(F.count(F.lit(1)).cast("double")).scalar()
    return games.withColumn("activation_rate", F.try_divide(F.col("game_cnt").cast("double"), all_games))


def step_mask(steps: Sequence[tuple[str, Column]]) -> Column:
    """One bit per step that the row's event is."""
    mask = F.lit(0)
    for i, (_, cond) in enumerate(steps):
        mask = mask.bitwiseOR(F.when(cond, F.lit(1 << i)).otherwise(F.lit(0)))
    return mask


def advance(state: Column, mask: Column, steps: int) -> Column:
    """The state after an instant: the next step is taken if one of its events is there, then the one after it, and so on."""
    for i in range(steps):
        state = F.when((state == i) & (mask.bitwiseAND(F.lit(1 << i)) != 0), i + 1).otherwise(state)
    return state


def steps_reached(events: DataFrame, user: str, ts: str, steps: Sequence[tuple[str, Column]], part: str = "day") -> DataFrame:
    """(user, reached): how many steps, in order, a user's events contain as a subsequence in time; events of one instant count in any order.

    An automaton whose state is the number of steps taken reads the events in time order. A stretch of events is a function from
    the state before it to the state after it, and such functions compose: the instants of each `part` of time are folded into the function of that
    part, and a user's functions are then applied one after the other. So a user with a third of all events is spread over
    the parts, and equal instants are united before anything is sorted. Rows without user, time or matching step are ignored by the automaton; users are
    counted from their rows with a step.
    """
    n = len(steps)
    marked = events.select(F.col(user).alias("u"), F.col(ts).alias("t"), step_mask(steps).alias("m")).where("u IS NOT NULL AND t IS NOT NULL AND m <> 0")
    instants = marked.groupBy("u", "t").agg(F.bit_or("m").alias("m"))
    parts = instants.groupBy("u", F.date_trunc(part, "t").alias("part")).agg(F.array_sort(F.collect_list(F.struct("t", "m"))).alias("seen"))
    start = F.array(*[F.lit(i) for i in range(n + 1)])
    change = F.aggregate("seen", start, lambda states, e: F.transform(states, lambda s: advance(s, e["m"], n)))
    functions = parts.select("u", "part", change.alias("change")).groupBy("u").agg(F.array_sort(F.collect_list(F.struct("part", "change"))).alias("changes"))
    state = F.aggregate("changes", F.lit(0), lambda s, c: F.element_at(c["change"], s + 1))
    return functions.select(F.col("u").alias(user), state.alias("reached"))


def conversion_funnel(events: DataFrame, user: str, ts: str, steps: Sequence[tuple[str, Column]]) -> DataFrame:
    """Users reaching each step after the steps before it, in any stretch of their events (see `steps_reached`)."""
    reached = steps_reached(events, user, ts, steps)
    totals = reached.agg(*[F.count_if(F.col("reached") > i).alias(f"n{i}") for i in range(len(steps))])
    rows = [
        F.struct(
            F.lit(i + 1).cast("long").alias("step_no"), F.lit(name).alias("step"), F.col(f"n{i}").alias("user_cnt"),
            _ratio(F.col(f"n{i}"), F.nullif(F.col(f"n{max(i - 1, 0)}"), F.lit(0))).alias("step_rate"),
        )
        for i, (name, _) in enumerate(steps)
    ]
    return totals.select(F.inline(F.array(*rows)))


def daily_sketches(events: DataFrame, ts: str, item: str, precision: int = 12) -> DataFrame:
    """(day, sketch): a mergeable sketch of the distinct items of each day, of 2^`precision` registers, whatever the number of items."""
    timed = events.where(F.col(ts).isNotNull())
    return timed.groupBy(F.col(ts).cast("date").alias("day")).agg(F.hll_sketch_agg(item, F.lit(precision)).alias("sketch"))


def period_distinct(sketches: DataFrame, days: int) -> DataFrame:
    """(day, distinct_cnt): estimated distinct items of the `days` days that end with each day; only sketches are read.

    Days without events have no row but do not break a period. The relative standard error is about 1.04 / sqrt(2^precision), 1.6 % at 12.
    """
    last = sketches.agg(F.max("day")).scalar()
    spread = sketches.select(F.explode(F.sequence("day", F.least(F.date_add("day", days - 1), last))).alias("end"), "sketch")
    united = spread.groupBy("end").agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("distinct_cnt"))
    return united.join(sketches.select(F.col("day").alias("end")), "end").select(F.col("end").alias("day"), "distinct_cnt")


def event_closure(starts: DataFrame, ends: DataFrame, key: str) -> DataFrame:
    """Starts without an end and ends without a start."""
    open_starts = starts.select(key).distinct().join(ends.select(key).distinct(), key, "left_anti")
    lone_ends = ends.select(key).distinct().join(starts.select(key).distinct(), key, "left_anti")
    return open_starts.withColumn("problem", F.lit("no_end")).unionByName(lone_ends.withColumn("problem", F.lit("no_start")))


def sequence_gaps(rows: DataFrame, key: str, number: str) -> DataFrame:
    """Keys whose distinct numbers are not consecutive. Two aggregates suffice; nothing is sorted."""
    distinct = rows.select(key, number).distinct().groupBy(key).agg(
        F.min(number).alias("first_no"), F.max(number).alias("last_no"), F.count(number).alias("distinct_cnt")
    )
    return distinct.where(F.col("last_no") - F.col("first_no") + 1 != F.col("distinct_cnt"))


