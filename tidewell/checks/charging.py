"""Charging queries with their check SQL. The check scores the whole vehicle x station product."""

from __future__ import annotations

from tidewell.checks.catalog import query
from tidewell.checks.ctes import cte, money, rnd, sql
from tidewell.plans import charging
from tidewell.sources.star import Star

cte("charge_fact_layer", "SELECT *, date_diff('minute', start_time, end_time) AS charge_minutes FROM charge_order WHERE status = 'COMPLETED'")
# A completed order once per successful payment, or once without; with the windows it falls into.
cte("charge_paid", """
SELECT f.*, pay.amount_cny, age <= INTERVAL 7 DAY AS week, age <= INTERVAL 30 DAY AS month
FROM (SELECT *, MAX(start_time) OVER () - start_time AS age FROM charge_fact_layer) f LEFT JOIN (SELECT order_id, amount_cny FROM charge_payment WHERE is_success = 1) pay USING (order_id)
""")


def mean(value: str, among: str) -> str:
    return rnd(f"{money(f'CASE WHEN {among} THEN {value} END')} / COUNT({value}) FILTER ({among})", 2)


cte("station_7d_layer", f"""
SELECT station_id, COUNT(*) FILTER (week) AS completed_orders_7d, {mean('energy_kwh', 'week')} AS avg_energy_kwh_7d, {rnd('AVG(charge_minutes) FILTER (week)', 2)} AS avg_charge_minutes_7d,
       {rnd(money('CASE WHEN week THEN amount_cny END'), 2)} AS total_revenue_cny_7d
FROM charge_paid GROUP BY ALL HAVING bool_or(week)
""")
cte("pair_30d_layer", f"""
SELECT vehicle_id, station_id, COUNT(*) FILTER (month) AS session_cnt_30d, {mean('energy_kwh', 'month')} AS avg_energy_kwh_30d, {mean('IFNULL(amount_cny, 0)', 'month')} AS avg_amount_cny_30d
FROM charge_paid GROUP BY ALL HAVING bool_or(month)
""")
cte("operability_parts", """
SELECT station_id, station_zone, available_ports, IFNULL(completed_orders_7d, 0) AS completed_orders_7d, IFNULL(online_rate, 0) AS online_rate, IFNULL(queue_minutes, 0) AS queue_minutes,
       IFNULL(fault_count, 0) AS fault_count
FROM dim_station LEFT JOIN (SELECT station_id, completed_orders_7d FROM station_7d_layer) USING (station_id)
LEFT JOIN (SELECT station_id, online_rate, queue_minutes, fault_count FROM station_ops) USING (station_id)
""")
cte("operability_layer", f"""
SELECT * EXCLUDE (up, quiet, sound), {rnd('0.45::DOUBLE * up + 0.30::DOUBLE * quiet + 0.25::DOUBLE * sound', 4)} AS station_operability_score
FROM (SELECT *, LEAST(online_rate, 1e0) AS up, 1e0 - LEAST(queue_minutes / 30e0, 1e0) AS quiet, 1e0 - LEAST(fault_count / 5e0, 1e0) AS sound FROM operability_parts)
""")


def score(sessions: str, zone: str, power: str) -> str:
    parts = ((0.35, f"LEAST({sessions} / 4e0, 1e0)"), (0.25, zone), (0.15, power), (0.15, "station_operability_score"), (0.10, "(1e0 - LEAST(tariff_cny_per_kwh / 2.2::DOUBLE, 1e0))"))
    return rnd(" + ".join(f"{weight}::DOUBLE * {part}" for weight, part in parts), 4)


cte("pair_base_layer", """
SELECT vehicle_id, station_id, IF(home_zone = station_zone, 1, 0) AS zone_match, IF(preferred_power_type = power_type, 1, 0) AS power_match, tariff_cny_per_kwh, station_operability_score,
       IFNULL(session_cnt_30d, 0) AS session_cnt_30d, IFNULL(avg_energy_kwh_30d, 0) AS avg_energy_kwh_30d, IFNULL(avg_amount_cny_30d, 0) AS avg_amount_cny_30d, home_zone, preferred_power_type
FROM (SELECT vehicle_id, home_zone, preferred_power_type, unnest((SELECT list(station_id) FROM dim_station)) AS station_id FROM dim_vehicle) JOIN dim_station USING (station_id)
LEFT JOIN (SELECT station_id, station_operability_score FROM operability_layer) USING (station_id) LEFT JOIN pair_30d_layer USING (vehicle_id, station_id)
""")
cte("pair_wide_layer", f"SELECT *, {score('session_cnt_30d', 'zone_match', 'power_match')} AS recommend_score FROM pair_base_layer")
cte("station_static_layer", f"""
SELECT s.station_id, s.station_zone, s.power_type, {score('0', '0', '0')} AS s00, {score('0', '1', '0')} AS s10, {score('0', '0', '1')} AS s01, {score('0', '1', '1')} AS s11
FROM dim_station s LEFT JOIN operability_layer a ON s.station_id = a.station_id
""")
cte("station_place_layer", """
SELECT station_id, ROW_NUMBER() OVER (ORDER BY s00 DESC, station_id) AS p00,
       ROW_NUMBER() OVER (PARTITION BY station_zone ORDER BY s10 DESC, station_id) AS p10,
       ROW_NUMBER() OVER (PARTITION BY power_type ORDER BY s01 DESC, station_id) AS p01,
       ROW_NUMBER() OVER (PARTITION BY station_zone, power_type ORDER BY s11 DESC, station_id) AS p11
FROM station_static_layer
""")


class Charging:
    def __init__(self, s: Star):
        self.facts, self.payments = charging.charge_fact(s.charge_order()), s.charge_payment()
        self.vehicles, self.stations, self.ops = s.dim_vehicle(), s.dim_station(), s.station_ops()

    def performance(self):
        return charging.station_performance(self.facts, self.payments)

    def preference(self):
        return charging.vehicle_station_preference(self.facts, self.payments)

    def operability(self):
        return charging.station_operability(self.stations, self.performance(), self.ops)

    def candidates(self, n: int = 3):
        return charging.candidate_features(self.vehicles, self.stations, self.preference(), self.operability(), n)


@query("charge_fact", sql("SELECT * FROM charge_fact_layer"))
def _(s: Star):
    return Charging(s).facts


@query("station_performance_7d", sql("SELECT * FROM station_7d_layer"))
def _(s: Star):
    return Charging(s).performance()


@query("vehicle_station_pref_30d", sql("SELECT * FROM pair_30d_layer"))
def _(s: Star):
    return Charging(s).preference()


@query("station_operability_score", sql("SELECT * FROM operability_layer"))
def _(s: Star):
    return Charging(s).operability()


@query("candidate_features", sql("""
SELECT w.* EXCLUDE (home_zone, preferred_power_type) FROM pair_wide_layer w JOIN station_place_layer r ON w.station_id = r.station_id
WHERE w.session_cnt_30d > 0 OR r.p00 <= 3 OR (w.zone_match = 1 AND r.p10 <= 3) OR (w.power_match = 1 AND r.p01 <= 3)
   OR (w.zone_match = 1 AND w.power_match = 1 AND r.p11 <= 3)
"""))
def _(s: Star):
    return Charging(s).candidates()


@query("reco_topn", sql("""
SELECT * FROM (SELECT vehicle_id, station_id, recommend_score,
       ROW_NUMBER() OVER (PARTITION BY vehicle_id ORDER BY recommend_score DESC, station_id) AS rank_no FROM pair_wide_layer) WHERE rank_no <= 3
"""))
def reco_topn(s: Star):
    return charging.reco_topn(Charging(s).candidates())
