"""Game queries with their check SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewell.checks.catalog import query
from tidewell.checks.ctes import cte, money, ratio, rnd, sql
from tidewell.functions.exprs import round_n
from tidewell.operators.relational import scalar
from tidewell.plans import game
from tidewell.sources.star import Star

BEFORE, AFTER = "S11.3", "S11.4"
TOP4, WIN = "CAST(COUNT(*) FILTER (WHERE rank_no <= 4) AS DOUBLE) / COUNT(*)", "CAST(COUNT(*) FILTER (WHERE rank_no = 1) AS DOUBLE) / COUNT(*)"
AVG_RANK = "CAST(SUM(rank_no) AS DOUBLE) / COUNT(rank_no)"

cte("comp_perf_layer", f"""
SELECT patch_version, region, rank_tier, final_comp_id, play_cnt,
       {rnd('play_cnt / CAST(SUM(play_cnt) OVER (PARTITION BY patch_version, region, rank_tier) AS DOUBLE)', 4)} AS pick_rate,
       {rnd('top4_rate', 4)} AS top4_rate, {rnd('win_rate', 4)} AS win_rate, {rnd('avg_rank', 2)} AS avg_rank
FROM (SELECT patch_version, region, rank_tier, final_comp_id, COUNT(*) AS play_cnt, {TOP4} AS top4_rate, {WIN} AS win_rate, {AVG_RANK} AS avg_rank
      FROM match_result WHERE mode = 'ranked' GROUP BY 1, 2, 3, 4)
""")
cte("unit_item_layer", f"""
SELECT patch_version, unit_id, item_combo, COUNT(*) AS appear_cnt, {rnd(TOP4, 4)} AS top4_rate, {rnd(WIN, 4)} AS win_rate
FROM match_result GROUP BY 1, 2, 3 HAVING COUNT(*) >= 100
""")


def side(patch: str) -> str:
    return f"SELECT final_comp_id, COUNT(*) AS n, {TOP4} AS top4, {WIN} AS win FROM match_result WHERE patch_version = '{patch}' AND mode = 'ranked' GROUP BY 1"


def full_side(patch: str) -> str:
    return f"SELECT final_comp_id, COUNT(*) AS play_cnt, {TOP4} AS top4_rate, {WIN} AS win_rate, {AVG_RANK} AS avg_rank FROM match_result WHERE patch_version = '{patch}' GROUP BY 1"


cte("migration_layer", f"""
SELECT comp_before, comp_after, COUNT(*) AS player_cnt FROM
  (SELECT player_id, final_comp_id AS comp_before, ROW_NUMBER() OVER (PARTITION BY player_id ORDER BY COUNT(*) DESC, final_comp_id) AS rn
   FROM match_result WHERE patch_version = '{BEFORE}' GROUP BY 1, 2) b
  JOIN (SELECT player_id, final_comp_id AS comp_after, ROW_NUMBER() OVER (PARTITION BY player_id ORDER BY COUNT(*) DESC, final_comp_id) AS rn
   FROM match_result WHERE patch_version = '{AFTER}' GROUP BY 1, 2) a ON a.player_id = b.player_id
WHERE a.rn = 1 AND b.rn = 1 GROUP BY 1, 2
""")
cte("latest_comp_day", """
SELECT * FROM comp_daily WHERE patch_version = (SELECT MAX(patch_version) FROM comp_daily)
  AND dt = (SELECT MAX(dt) FROM comp_daily WHERE patch_version = (SELECT MAX(patch_version) FROM comp_daily))
""")
cte("comp_meta_layer", """
SELECT dt, patch_version, region, rank_tier, comp_id, comp_name, tier, play_cnt, pick_rate, top4_rate, win_rate, top4_share, win_share, avg_rank,
       CASE WHEN pick_rate <= 0.02::DOUBLE AND top4_rate >= 0.58::DOUBLE THEN 'hidden_strong' WHEN pick_rate <= 0.02::DOUBLE AND top4_rate <= 0.48::DOUBLE THEN 'underpowered'
            WHEN pick_rate >= 0.025::DOUBLE AND top4_rate >= 0.58::DOUBLE THEN 'overpowered' ELSE 'normal' END AS meta_flag
FROM (SELECT *, play_cnt / (SELECT CAST(SUM(play_cnt) AS DOUBLE) FROM latest_comp_day) AS pick_rate, CAST(top4_cnt AS DOUBLE) / play_cnt AS top4_rate,
             CAST(win_cnt AS DOUBLE) / play_cnt AS win_rate, top4_cnt / (SELECT NULLIF(CAST(SUM(top4_cnt) AS DOUBLE), 0) FROM latest_comp_day) AS top4_share,
             win_cnt / (SELECT NULLIF(CAST(SUM(win_cnt) AS DOUBLE), 0) FROM latest_comp_day) AS win_share FROM latest_comp_day)
""")


def patch_totals(patch: str) -> str:
    return f"""SELECT comp_id, comp_name, CAST(SUM(play_cnt) AS BIGINT) AS play_cnt, CAST(SUM(top4_cnt) AS BIGINT) AS top4_cnt, CAST(SUM(win_cnt) AS BIGINT) AS win_cnt,
AVG(avg_rank) AS avg_rank FROM comp_daily WHERE patch_version = '{patch}' GROUP BY 1, 2"""


@query("comp_performance", sql("SELECT * FROM comp_perf_layer"))
def _(s: Star):
    return game.comp_performance(s.match_result())


@query("unit_item_strength", sql("SELECT * FROM unit_item_layer"))
def _(s: Star):
    return game.unit_item_strength(s.match_result())


@query("econ_path_summary", sql(f"""
SELECT patch_version, region, rank_tier, {money('first_level8_round')} / COUNT(*) AS avg_level8_round, {money('total_roll_cnt')} / COUNT(*) AS avg_roll_cnt,
       {money('final_gold')} / COUNT(*) AS avg_final_gold FROM player_econ GROUP BY 1, 2, 3
"""))
def _(s: Star):
    return game.econ_path_summary(s.player_econ())


@query("patch_comp_delta", sql(f"""
SELECT COALESCE(a.final_comp_id, b.final_comp_id) AS final_comp_id, COALESCE(b.n, 0) AS play_cnt_before, COALESCE(a.n, 0) AS play_cnt_after,
       {rnd('COALESCE(b.top4, 0)', 4)} AS top4_before, {rnd('COALESCE(a.top4, 0)', 4)} AS top4_after,
       {rnd('COALESCE(a.top4, 0) - COALESCE(b.top4, 0)', 4)} AS top4_delta, {rnd('COALESCE(a.win, 0) - COALESCE(b.win, 0)', 4)} AS win_delta
FROM ({side(BEFORE)}) b FULL OUTER JOIN ({side(AFTER)}) a ON a.final_comp_id = b.final_comp_id
"""))
def _(s: Star):
    return game.patch_comp_delta(s.match_result(), BEFORE, AFTER)


@query("patch_comp_compare", sql("""
SELECT *, top4_rate_after - top4_rate_before AS top4_delta, win_rate_after - win_rate_before AS win_delta, play_cnt_after - play_cnt_before AS pick_delta
FROM (SELECT COALESCE(a.final_comp_id, b.final_comp_id) AS final_comp_id, """
    + ", ".join(f"COALESCE({x}.{n}, 0) AS {n}_{y}" for x, y in (("b", "before"), ("a", "after")) for n in ("play_cnt", "top4_rate", "win_rate", "avg_rank"))
    + f" FROM ({full_side(BEFORE)}) b FULL OUTER JOIN ({full_side(AFTER)}) a ON a.final_comp_id = b.final_comp_id)"))
def _(s: Star):
    return game.patch_comp_compare(s.match_result(), BEFORE, AFTER)


@query("meta_migration", sql("SELECT * FROM migration_layer"))
def _(s: Star):
    return game.meta_migration(s.match_result(), BEFORE, AFTER)


def _summary(s: Star):
    # 36 groups share the newest month, so the flag limits are scaled to a mean share of 1/36.
    return game.comp_meta_summary(s.comp_daily(), (0.025, 0.58), (0.02, 0.48), (0.02, 0.58))


@query("comp_meta_summary", sql("SELECT * FROM comp_meta_layer"))
def _(s: Star):
    return _summary(s)


EXACT = [f"{n}_{y}" for y in ("before", "after") for n in ("play_cnt", "top4_cnt", "win_cnt")]
RATES = [f"{n}_{y}" for y in ("before", "after") for n in ("top4_rate", "win_rate")]
PAIRED = ", ".join(f"COALESCE({x}.{n}, 0) AS {n}_{y}" for x, y in (("b", "before"), ("a", "after")) for n in ("play_cnt", "top4_cnt", "win_cnt", "avg_rank"))
RATE_SQL = ", ".join(
    f"COALESCE(CAST({n}_cnt_{y} AS DOUBLE) / NULLIF(play_cnt_{y}, 0), 0) AS {n}_rate_{y}" for y in ("before", "after") for n in ("top4", "win")
)


@query("patch_delta_reading", sql(f"""
SELECT comp_id, comp_name, {', '.join(EXACT + RATES)}, play_delta, top4_delta, win_delta, {rnd('avg_rank_before', 6)} AS avg_rank_before,
       {rnd('avg_rank_after', 6)} AS avg_rank_after, {rnd('avg_rank_after - avg_rank_before', 6)} AS avg_rank_delta,
       CASE WHEN win_delta >= 0.002::DOUBLE AND play_delta >= 100 THEN 'meta_rising' WHEN top4_delta <= -0.005::DOUBLE AND play_delta <= -50 THEN 'nerf_effective'
            WHEN top4_delta >= 0.005::DOUBLE AND play_delta >= 50 THEN 'buff_effective' ELSE 'watch' END AS patch_reading
FROM (SELECT *, play_cnt_after - play_cnt_before AS play_delta, top4_rate_after - top4_rate_before AS top4_delta, win_rate_after - win_rate_before AS win_delta
      FROM (SELECT *, {RATE_SQL} FROM (SELECT COALESCE(a.comp_id, b.comp_id) AS comp_id, COALESCE(a.comp_name, b.comp_name) AS comp_name, {PAIRED}
            FROM ({patch_totals(BEFORE)}) b FULL OUTER JOIN ({patch_totals(AFTER)}) a ON a.comp_id = b.comp_id AND a.comp_name = b.comp_name)))
"""))
def _(s: Star):
    out = game.patch_delta_reading(s.comp_daily(), BEFORE, AFTER, 0.005, 50, 0.002, 100)
    # A mean of binary fractions depends on the order of addition in its last bits.
    return out.withColumns({c: round_n(c, 6) for c in ("avg_rank_before", "avg_rank_after", "avg_rank_delta")})


@query("migration_share", sql("SELECT *, player_cnt / (SELECT CAST(SUM(player_cnt) AS DOUBLE) FROM migration_layer) AS migration_share FROM migration_layer"))
def _(s: Star):
    return game.migration_share(game.meta_migration(s.match_result(), BEFORE, AFTER))


@query("unit_item_risk", sql("""
SELECT *, CASE WHEN appear_cnt <= 150 AND top4_rate <= 0.49::DOUBLE THEN 'underpowered_core' WHEN appear_cnt >= 200 AND top4_rate >= 0.59::DOUBLE THEN 'overpowered_item_binding'
               ELSE 'normal' END AS balance_flag FROM unit_item_layer
"""))
def _(s: Star):
    return game.unit_item_risk(game.unit_item_strength(s.match_result()), (200, 0.59), (150, 0.49))


@query("flag_balance_risk", sql("""
SELECT *, CASE WHEN pick_rate <= 0.165::DOUBLE AND top4_rate >= 0.58::DOUBLE THEN 'hidden_strong' WHEN pick_rate <= 0.16::DOUBLE AND top4_rate <= 0.57::DOUBLE THEN 'underpowered'
               WHEN pick_rate >= 0.15::DOUBLE AND top4_rate >= 0.58::DOUBLE THEN 'overpowered' ELSE 'normal' END AS balance_flag FROM comp_perf_layer
"""))
def _(s: Star):
    return game.flag_balance_risk(game.comp_performance(s.match_result()), (0.15, 0.58), (0.16, 0.57), (0.165, 0.58))


@query("meta_overview", sql("SELECT MAX(patch_version) AS patch_version, COUNT(*) AS comp_cnt, CAST(SUM(play_cnt) AS BIGINT) AS play_cnt, MAX(win_share) AS max_win_share FROM comp_meta_layer"))
def _(s: Star):
    return game.meta_overview(_summary(s))


@query("migration_top", sql("SELECT * FROM migration_layer ORDER BY player_cnt DESC, comp_before, comp_after LIMIT 8"))
def _(s: Star):
    return game.migration_top(game.meta_migration(s.match_result(), BEFORE, AFTER))


CHURN = f"""
SELECT player_id, CAST(SUM(login_flag) AS BIGINT) AS login_days_7d, CAST(SUM(match_cnt) AS BIGINT) AS match_cnt_7d, {money('pay_amount')} AS pay_amount_7d, MAX(dt) AS last_login_date,
       CASE WHEN SUM(login_flag) <= 2 THEN 1 ELSE 0 END AS low_activity_flag FROM player_daily WHERE {{where}} GROUP BY 1
"""


@query("churn_features", sql(CHURN.format(where="TRUE")))
def _(s: Star):
    return game.churn_features(s.player_daily())


@query("churn_features_last_week", sql(CHURN.format(where="dt > (SELECT MAX(dt) FROM player_daily) - INTERVAL 7 DAY")))
def _(s: Star):
    return game.churn_features(s.player_daily(), scalar(s.table("events"), F.max(F.col("ts").cast("date"))), 7)


@query("topn_concentration", sql(f"""
SELECT patch_version, region, rank_tier, {money('pick_rate', 4)} AS topn_pick_rate
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY patch_version, region, rank_tier ORDER BY play_cnt DESC, final_comp_id) AS rn FROM comp_perf_layer)
WHERE rn <= 3 GROUP BY 1, 2, 3
"""))
def _(s: Star):
    return game.topn_concentration(game.comp_performance(s.match_result()), ["patch_version", "region", "rank_tier"], 3)
