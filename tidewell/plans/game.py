"""Meta, patch impact and churn features of an auto-battler game."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell.functions.exprs import int_avg, label_last_wins, money_avg, rate, round_n
from tidewell.operators.ranking import mode_per_key, top_n
from tidewell.operators.relational import scalar, share


def _outcomes() -> list[Column]:
    rank = F.col("rank_no")
    return [
        F.count(F.lit(1)).alias("play_cnt"),
        rate(rank <= 4).alias("top4_rate"),
        rate(rank == 1).alias("win_rate"),
        int_avg("rank_no").alias("avg_rank"),
    ]


def comp_performance(matches: DataFrame) -> DataFrame:
    """Ranked play per patch, region, tier and comp, with the comp's share of its group."""
    group = ["patch_version", "region", "rank_tier"]
    perf = matches.where(F.col("mode") == "ranked").groupBy(*group, "final_comp_id").agg(*_outcomes())
    total = F.sum("play_cnt").over(Window.partitionBy(*group))
    return perf.select(
        *group, "final_comp_id", "play_cnt",
        round_n(F.col("play_cnt").cast("double") / total.cast("double"), 4).alias("pick_rate"),
        round_n("top4_rate", 4).alias("top4_rate"),
        round_n("win_rate", 4).alias("win_rate"),
        round_n("avg_rank", 2).alias("avg_rank"),
    )


def unit_item_strength(matches: DataFrame, min_games: int = 100) -> DataFrame:
    rank = F.col("rank_no")
    return matches.groupBy("patch_version", "unit_id", "item_combo").agg(
        F.count(F.lit(1)).alias("appear_cnt"), round_n(rate(rank <= 4), 4).alias("top4_rate"), round_n(rate(rank == 1), 4).alias("win_rate")
    ).where(F.col("appear_cnt") >= min_games)


def econ_path_summary(econ: DataFrame) -> DataFrame:
    return econ.groupBy("patch_version", "region", "rank_tier").agg(
        money_avg("first_level8_round").alias("avg_level8_round"),
        money_avg("total_roll_cnt").alias("avg_roll_cnt"),
        money_avg("final_gold").alias("avg_final_gold"),
    )


def patch_comp_delta(matches: DataFrame, before: str, after: str) -> DataFrame:
    """Comp results in two patches side by side, from one scan: a comp missing in one patch counts 0 there."""
    rank, patch = F.col("rank_no"), F.col("patch_version")
    ranked = matches.where((F.col("mode") == "ranked") & patch.isin(before, after))

    def of(name: str) -> tuple[Column, Column, Column]:
        here = patch == name
        games = F.count_if(here)
        top4 = F.coalesce(F.try_divide(F.count_if(here & (rank <= 4)).cast("double"), games.cast("double")), F.lit(0.0))
        win = F.coalesce(F.try_divide(F.count_if(here & (rank == 1)).cast("double"), games.cast("double")), F.lit(0.0))
        return games, top4, win

    (n0, t0, w0), (n1, t1, w1) = of(before), of(after)
    return ranked.groupBy("final_comp_id").agg(
        n0.alias("play_cnt_before"),
        n1.alias("play_cnt_after"),
        round_n(t0, 4).alias("top4_before"),
        round_n(t1, 4).alias("top4_after"),
        round_n(t1 - t0, 4).alias("top4_delta"),
        round_n(w1 - w0, 4).alias("win_delta"),
    )


def patch_comp_compare(matches: DataFrame, before: str, after: str) -> DataFrame:
    """All modes, unrounded: play count, rates and mean rank per comp before and after, with deltas."""
    metric = matches.where(F.col("patch_version").isin(before, after) & F.col("final_comp_id").isNotNull())
    metric = metric.groupBy("patch_version", "final_comp_id").agg(*_outcomes())
    names = ["play_cnt", "top4_rate", "win_rate", "avg_rank"]
    wide = metric.groupBy("final_comp_id").agg(
        *[
            F.coalesce(F.max(F.when(F.col("patch_version") == patch, F.col(n))), F.lit(0)).alias(f"{n}_{suffix}")
            for suffix, patch in (("before", before), ("after", after))
            for n in names
        ]
    )
    deltas = {"top4_delta": "top4_rate", "win_delta": "win_rate", "pick_delta": "play_cnt"}
    return wide.withColumns({d: F.col(f"{n}_after") - F.col(f"{n}_before") for d, n in deltas.items()})


def meta_migration(matches: DataFrame, before: str, after: str) -> DataFrame:
    """Players by main comp before and after; ties between comps go to the smaller comp id."""
    sides = []
    for patch, name in ((before, "comp_before"), (after, "comp_after")):
        main = mode_per_key(matches.where(F.col("patch_version") == patch), "player_id", "final_comp_id")
        sides.append(main.select("player_id", F.col("final_comp_id").alias(name)))
    return sides[0].join(sides[1], "player_id").groupBy("comp_before", "comp_after").agg(F.count(F.lit(1)).alias("player_cnt"))


def comp_meta_summary(
    daily: DataFrame, strong: tuple[float, float] = (0.18, 0.58), weak: tuple[float, float] = (0.08, 0.48), hidden: tuple[float, float] = (0.10, 0.58)
) -> DataFrame:
    """Newest day of the newest patch: rates, shares and a flag (later rules overwrite earlier ones)."""
    patch = scalar(daily, F.max("patch_version"))
    in_patch = daily.where(F.col("patch_version") == patch)
    latest = in_patch.where(F.col("dt") == scalar(in_patch, F.max("dt")))
    wide = latest
    for count, alias in (("play_cnt", "pick_rate"), ("top4_cnt", "top4_share"), ("win_cnt", "win_share")):
        total = scalar(latest, F.sum(count).cast("double"))
        wide = wide.withColumn(alias, F.try_divide(F.col(count).cast("double"), total))
    plays = F.col("play_cnt").cast("double")
    wide = wide.withColumns({"top4_rate": F.col("top4_cnt").cast("double") / plays, "win_rate": F.col("win_cnt").cast("double") / plays})
    pick, top4 = F.col("pick_rate"), F.col("top4_rate")
    flag = label_last_wins(
        [
            ((pick >= strong[0]) & (top4 >= strong[1]), "overpowered"),
            ((pick <= weak[0]) & (top4 <= weak[1]), "underpowered"),
            ((pick <= hidden[0]) & (top4 >= hidden[1]), "hidden_strong"),
        ],
        "normal",
    )
    return wide.select(
        "dt", "patch_version", "region", "rank_tier", "comp_id", "comp_name", "tier", "play_cnt", "pick_rate", "top4_rate",
        "win_rate", "top4_share", "win_share", "avg_rank", flag.alias("meta_flag"),
    )


def patch_delta_reading(daily: DataFrame, before: str, after: str, top4_step: float = 0.035, play_step: int = 500, win_step: float = 0.025, rising_step: int = 800) -> DataFrame:
    """Patch totals per comp side by side with a verdict. The mean of `avg_rank` is not weighted by plays."""
    sums = {"play_cnt": F.sum, "top4_cnt": F.sum, "win_cnt": F.sum}
    keyed = daily.where(F.col("comp_id").isNotNull() & F.col("comp_name").isNotNull() & F.col("patch_version").isin(before, after))
    aggs = []
    for suffix, patch in (("before", before), ("after", after)):
        here = F.col("patch_version") == patch
        aggs += [F.coalesce(fn(F.when(here, F.col(n))), F.lit(0)).alias(f"{n}_{suffix}") for n, fn in sums.items()]
        aggs.append(F.coalesce(F.avg(F.when(here, F.col("avg_rank"))), F.lit(0.0)).alias(f"avg_rank_{suffix}"))
    wide = keyed.groupBy("comp_id", "comp_name").agg(*aggs)
    for suffix in ("before", "after"):
        for rate_name, count in (("top4_rate", "top4_cnt"), ("win_rate", "win_cnt")):
            value = F.try_divide(F.col(f"{count}_{suffix}").cast("double"), F.col(f"play_cnt_{suffix}").cast("double"))
            wide = wide.withColumn(f"{rate_name}_{suffix}", F.coalesce(value, F.lit(0.0)))
    deltas = {"play_delta": "play_cnt", "top4_delta": "top4_rate", "win_delta": "win_rate", "avg_rank_delta": "avg_rank"}
    wide = wide.withColumns({d: F.col(f"{n}_after") - F.col(f"{n}_before") for d, n in deltas.items()})
    top4, play, win = F.col("top4_delta"), F.col("play_delta"), F.col("win_delta")
    reading = label_last_wins(
        [
            ((top4 >= top4_step) & (play >= play_step), "buff_effective"),
            ((top4 <= -top4_step) & (play <= -play_step), "nerf_effective"),
            ((win >= win_step) & (play >= rising_step), "meta_rising"),
        ],
        "watch",
    )
    return wide.withColumn("patch_reading", reading)


def migration_share(migration: DataFrame) -> DataFrame:
    return share(migration, "player_cnt", "migration_share")


def unit_item_risk(units: DataFrame, strong: tuple[int, float] = (3500, 0.59), weak: tuple[int, float] = (2000, 0.49)) -> DataFrame:
    n, top4 = F.col("appear_cnt"), F.col("top4_rate")
    rules = [((n >= strong[0]) & (top4 >= strong[1]), "overpowered_item_binding"), ((n <= weak[0]) & (top4 <= weak[1]), "underpowered_core")]
    return units.withColumn("balance_flag", label_last_wins(rules, "normal"))


def flag_balance_risk(comps: DataFrame, strong=(0.15, 0.58), weak=(0.03, 0.45), hidden=(0.05, 0.58)) -> DataFrame:
    pick, top4 = F.col("pick_rate"), F.col("top4_rate")
    rules = [
        ((pick >= strong[0]) & (top4 >= strong[1]), "overpowered"),
        ((pick <= weak[0]) & (top4 <= weak[1]), "underpowered"),
        ((pick <= hidden[0]) & (top4 >= hidden[1]), "hidden_strong"),
    ]
    return comps.withColumn("balance_flag", label_last_wins(rules, "normal"))


def meta_overview(summary: DataFrame) -> DataFrame:
    return summary.agg(
        F.max("patch_version").alias("patch_version"), F.count(F.lit(1)).alias("comp_cnt"),
        F.sum("play_cnt").alias("play_cnt"), F.max("win_share").alias("max_win_share"),
    )


def migration_top(migration: DataFrame, n: int = 8) -> DataFrame:
    return migration.orderBy(F.desc("player_cnt"), "comp_before", "comp_after").limit(n)


def churn_features(player_daily: DataFrame, as_of: Column | None = None, days: int | None = None, low_login_days: int = 2) -> DataFrame:
    """Activity totals per player; a time window applies only when both `as_of` and `days` are given."""
    rows = player_daily.where(F.col("player_id").isNotNull())
    if as_of is not None and days is not None:
        rows = rows.where((F.col("dt") > F.date_sub(as_of, days)) & (F.col("dt") <= as_of))
    totals = rows.groupBy("player_id").agg(
        F.sum("login_flag").alias("login_days_7d"),
        F.sum("match_cnt").alias("match_cnt_7d"),
        F.sum(F.col("pay_amount").cast("decimal(18,2)")).cast("double").alias("pay_amount_7d"),
        F.max("dt").alias("last_login_date"),
    )
    return totals.withColumn("low_activity_flag", F.when(F.col("login_days_7d") <= low_login_days, 1).otherwise(0))


def topn_concentration(comps: DataFrame, keys: Sequence[str], n: int = 5) -> DataFrame:
    """Share of plays held by the n most played comps per group."""
    order = [F.desc("play_cnt"), F.asc("final_comp_id")]
    best = top_n(comps, list(keys), order, n)
    return best.groupBy(*keys).agg(F.sum(F.col("pick_rate").cast("decimal(18,4)")).cast("double").alias("topn_pick_rate"))
