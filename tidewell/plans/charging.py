"""Charging-station features and Top-N recommendation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.functions.exprs import boundaries_crossed, capped, int_avg, money_avg, money_sum, round_n
from tidewell.operators.ranking import top_n
from tidewell.operators.relational import since
from tidewell.session import materialize


def charge_fact(orders: DataFrame) -> DataFrame:
    """Completed orders with their length in minutes."""
    return orders.where(F.col("status") == "COMPLETED").withColumn("charge_minutes", boundaries_crossed("MINUTE", "start_time", "end_time"))


def paid(payments: DataFrame) -> DataFrame:
    return payments.where(F.col("is_success") == 1).select("order_id", "amount_cny")


def station_performance(facts: DataFrame, payments: DataFrame, days: int = 7) -> DataFrame:
    """Several payments of one order count several times; revenue stays NULL when nothing was paid."""
    recent = since(facts, "start_time", days).join(paid(payments), "order_id", "left")
    return recent.groupBy("station_id").agg(
        F.count(F.lit(1)).alias("completed_orders_7d"),
        round_n(money_avg("energy_kwh"), 2).alias("avg_energy_kwh_7d"),
        round_n(int_avg("charge_minutes"), 2).alias("avg_charge_minutes_7d"),
        round_n(money_sum("amount_cny"), 2).alias("total_revenue_cny_7d"),
    )


def vehicle_station_preference(facts: DataFrame, payments: DataFrame, days: int = 30) -> DataFrame:
    recent = since(facts, "start_time", days).join(paid(payments), "order_id", "left")
    return recent.groupBy("vehicle_id", "station_id").agg(
        F.count(F.lit(1)).alias("session_cnt_30d"),
        round_n(money_avg("energy_kwh"), 2).alias("avg_energy_kwh_30d"),
        round_n(money_avg(F.coalesce("amount_cny", F.lit(0.0))), 2).alias("avg_amount_cny_30d"),
    )


def station_operability(stations: DataFrame, performance: DataFrame, ops: DataFrame) -> DataFrame:
    """Supply score per station; several operation snapshots of a station give several rows."""
    wide = (
        stations.select("station_id", "station_zone", "available_ports")
        .join(performance.select("station_id", "completed_orders_7d"), "station_id", "left")
        .join(ops.select("station_id", "online_rate", "queue_minutes", "fault_count"), "station_id", "left")
        .na.fill(0, ["completed_orders_7d", "online_rate", "queue_minutes", "fault_count"])
    )
    score = (
        F.lit(0.45) * capped("online_rate")
        + F.lit(0.30) * (F.lit(1.0) - capped(F.col("queue_minutes") / F.lit(30.0)))
        + F.lit(0.25) * (F.lit(1.0) - capped(F.col("fault_count") / F.lit(5.0)))
    )
    return wide.withColumn("station_operability_score", round_n(score, 4))


def recommend_score(sessions: Column, zone_match: Column, power_match: Column) -> Column:
    return round_n(
        F.lit(0.35) * capped(sessions / F.lit(4.0))
        + F.lit(0.25) * zone_match
        + F.lit(0.15) * power_match
        + F.lit(0.15) * F.col("station_operability_score")
        + F.lit(0.10) * (F.lit(1.0) - capped(F.col("tariff_cny_per_kwh") / F.lit(2.2))),
        4,
    )


def station_profile(stations: DataFrame, operability: DataFrame) -> DataFrame:
    scores = operability.select("station_id", "station_operability_score")
    return stations.select("station_id", "station_zone", "power_type", "tariff_cny_per_kwh").join(scores, "station_id", "left")


def leader_pairs(vehicles: DataFrame, profile: DataFrame, n: int) -> DataFrame:
    """(vehicle, station) pairs that can reach a Top-n without any charging history.

    A station without history scores by zone match, power match and its own quality only, and the score never
    falls when a match or a session is added. So a station can be in a vehicle's Top-n only if it is among the
    n best of all stations scored without matches, or among the n best of its zone scored with a zone match,
    of its power type scored with a power match, or of both scored with both. Those four short lists replace
    the vehicle x station product: each vehicle meets at most 4n stations, however many stations there are.
    """
    none, one = F.lit(0), F.lit(1)

    def best(keys: list[str], zone: Column, power: Column) -> DataFrame:
        scored = profile.withColumn("_score", recommend_score(F.lit(0), zone, power))
        order = [F.desc("_score"), F.asc("station_id")]
        if not keys:
            return scored.orderBy(*order).limit(n).select("station_id")
        return top_n(scored, keys, order, n).select(*keys, "station_id")

    v = vehicles.select("vehicle_id", F.col("home_zone").alias("station_zone"), F.col("preferred_power_type").alias("power_type"))
    overall = best([], none, none).agg(F.collect_list("station_id").alias("ids")).scalar()
    lists = [
        v.select("vehicle_id", F.explode(overall).alias("station_id")),
        v.join(best(["station_zone"], one, none), "station_zone").select("vehicle_id", "station_id"),
        v.join(best(["power_type"], none, one), "power_type").select("vehicle_id", "station_id"),
        v.join(best(["station_zone", "power_type"], one, one), ["station_zone", "power_type"]).select("vehicle_id", "station_id"),
    ]
    return reduce(DataFrame.union, lists)


def candidate_features(vehicles: DataFrame, stations: DataFrame, preference: DataFrame, operability: DataFrame, n: int = 3) -> DataFrame:
    """Wide feature rows for every pair that can appear in a Top-n list: pairs with history and the leaders.

    All other pairs of the vehicle x station product are provably below n listed ones, so they are not built.
    The station profile (one short row per station) is read by the four leader lists and by the scoring, so it
    is written once.
    """
    profile = materialize(station_profile(stations, operability), "station-profile")
    pairs = leader_pairs(vehicles, profile, n).union(preference.select("vehicle_id", "station_id")).distinct()
    wide = (
        pairs.join(vehicles.select("vehicle_id", "home_zone", "preferred_power_type"), "vehicle_id")
        .join(profile, "station_id")
        .join(preference, ["vehicle_id", "station_id"], "left")
        .na.fill(0, ["session_cnt_30d", "avg_energy_kwh_30d", "avg_amount_cny_30d"])
        .withColumns(
            {
                "zone_match": F.when(F.col("home_zone") == F.col("station_zone"), 1).otherwise(0),
                "power_match": F.when(F.col("preferred_power_type") == F.col("power_type"), 1).otherwise(0),
            }
        )
    )
    return wide.select(
        "vehicle_id", "station_id", "zone_match", "power_match", "tariff_cny_per_kwh", "station_operability_score",
        "session_cnt_30d", "avg_energy_kwh_30d", "avg_amount_cny_30d",
        recommend_score(F.col("session_cnt_30d"), F.col("zone_match"), F.col("power_match")).alias("recommend_score", metadata={"exact_up_to": n}),
    )


def reco_topn(candidates: DataFrame, n: int = 3) -> DataFrame:
    """Best n stations per vehicle; ties go to the smaller station id. More than the candidates were built for is refused."""
    most = candidates.schema["recommend_score"].metadata.get("exact_up_to", n)
    if n > most:
        raise ValueError(f"candidates hold the best {most} stations of a vehicle; build them with n={n}")
    return top_n(candidates, ["vehicle_id"], [F.desc("recommend_score"), F.asc("station_id")], n).select(
        "vehicle_id", "station_id", "recommend_score", "rank_no"
    )


def candidate_grid(vehicles: DataFrame, stations: DataFrame) -> DataFrame:
    """Size of each vehicle's candidate grid: all stations, and those matching zone, power type or both.

    The vehicle x station product is only counted: stations are counted per zone and power type first.
    """
    per = stations.groupBy(F.col("station_zone").alias("home_zone"), F.col("power_type").alias("preferred_power_type")).agg(F.count(F.lit(1)).alias("both_match_cnt"))
    zones = per.groupBy("home_zone").agg(F.sum("both_match_cnt").alias("zone_match_cnt"))
    powers = per.groupBy("preferred_power_type").agg(F.sum("both_match_cnt").alias("power_match_cnt"))
    total = stations.agg(F.count(F.lit(1))).scalar()
    wide = (
        vehicles.select("vehicle_id", "home_zone", "preferred_power_type")
        .join(zones, "home_zone", "left")
        .join(powers, "preferred_power_type", "left")
        .join(per, ["home_zone", "preferred_power_type"], "left")
        .na.fill(0, ["zone_match_cnt", "power_match_cnt", "both_match_cnt"])
    )
    return wide.select("vehicle_id", total.alias("candidate_cnt"), "zone_match_cnt", "power_match_cnt", "both_match_cnt")
