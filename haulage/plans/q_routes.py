"""Route, cost and congestion queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from haulage.functions import round_half_up
from haulage.operators import freight, joins, routes
from haulage.plans import bindings as B
from haulage.plans.lanes import lane_quarters, observed_pairs, stored
from haulage.plans.catalog import query
from haulage.session import scratch_path
from haulage.sources import landed
from haulage.plans.sqlparts import (COORDS, FLOWS, LANDED, LATEST_FUEL, LATEST_YEAR as Y,
                                    NATION_SNAPS, ROUTES, SNAPS, haversine, rhu, with_)


LANES = (*freight.LANE_KEYS, "year", "tons")


def routing_landed(spark, sf):
    """The routing responses of the observed pairs, landed as lines and loaded
    once for all route queries; those of pairs in descending order arrive cut off too."""
    def make(path):
        answers = B.landed_routes(spark, sf, observed_pairs(spark, sf))
        response = F.struct("code", F.array(F.struct("distance", "duration")).alias("routes")).alias("response")
        line = F.to_json(F.struct("origin", "destination", response))
        cut = F.when(F.col("origin") > F.col("destination"), F.substring("payload", 1, 40))
        sent = answers.withColumn("payload", line).select(F.explode(F.array_compact(F.array("payload", cut))).alias("payload"))
        files = scratch_path(spark, "landing")
        landed.land(sent, files, [])
        routes.routing_landed(spark, files, path)

    return landed.read_ingested(spark, stored(spark, sf, "routing", make))


def route_table(spark, sf):
    """Routes for the observed (origin, destination) pairs."""
    routed = routes.routed_legs(routing_landed(spark, sf).rows)
    return routes.route_table(observed_pairs(spark, sf), routed, B.nation_coords(spark, sf))


def origin_diesel(spark, sf):
    """Diesel per origin from the latest nation snapshot."""
    return routes.latest_snapshot(B.nation_fuel_snapshots(spark, sf)).select("state", "diesel")


def route_costs(spark, sf):
    return routes.route_costs(route_table(spark, sf), origin_diesel(spark, sf))


def congested(spark, sf):
    return routes.congestion(route_costs(spark, sf))


_FUEL_LATEST = "fuel_latest AS (SELECT state, diesel FROM nsnaps WHERE scraped_at = (SELECT max(scraped_at) FROM nsnaps))"

_COSTS = f"""c0 AS (SELECT r.origin, r.destination, r.driving_mi AS mi, r.driving_hr AS hr,
    coalesce(f.diesel, 3.5) AS price FROM routes r LEFT JOIN fuel_latest f ON r.origin = f.state),
c1 AS (SELECT *, mi / 6.5 * price AS fuelc, hr * 35.0 AS driverc, mi * 0.15 AS maintc FROM c0),
c2 AS (SELECT *, fuelc + driverc + maintc AS total FROM c1),
costs AS (SELECT origin, destination,
    CASE WHEN mi = 0 THEN 0.0 ELSE {rhu('mi', 1)} END AS driving_mi,
    CASE WHEN mi = 0 THEN 0.0 ELSE {rhu('hr', 2)} END AS driving_hr,
    CASE WHEN mi = 0 THEN NULL ELSE {rhu('price', 2)} END AS diesel_price,
    CASE WHEN mi = 0 THEN 0.0 ELSE {rhu('fuelc', 2)} END AS fuel_cost,
    CASE WHEN mi = 0 THEN 0.0 ELSE {rhu('driverc', 2)} END AS driver_cost,
    CASE WHEN mi = 0 THEN 0.0 ELSE {rhu('maintc', 2)} END AS maint_cost,
    CASE WHEN mi = 0 THEN 0.0 ELSE {rhu('total', 2)} END AS total_cost,
    CASE WHEN mi = 0 THEN 0.0 ELSE {rhu('total / mi', 4)} END AS cost_per_mi,
    CASE WHEN mi = 0 THEN NULL WHEN total > 0 THEN {rhu('fuelc / total * 100', 1)} ELSE 0.0 END AS fuel_pct
  FROM c2)"""

_CONG = f"""cong AS (SELECT *, congestion_ratio_x AS congestion_ratio,
    CASE WHEN congestion_ratio_x > 0 AND congestion_ratio_x <= 1.1 THEN 'Low'
         WHEN congestion_ratio_x > 1.1 AND congestion_ratio_x <= 1.3 THEN 'Moderate'
         WHEN congestion_ratio_x > 1.3 THEN 'High' END AS congestion_tier
  FROM (SELECT *, coalesce({rhu('driving_hr / nullif(driving_mi / 55.0, 0)', 3)}, 0.0) AS congestion_ratio_x FROM costs))"""

ROUTE_BASE = [FLOWS, COORDS, LANDED, ROUTES]
COST_BASE = ROUTE_BASE + [SNAPS, NATION_SNAPS, _FUEL_LATEST, _COSTS]
CONG_BASE = COST_BASE + [_CONG]
CONG_COLS = ("origin, destination, driving_mi, driving_hr, diesel_price, fuel_cost, driver_cost, "
             "maint_cost, total_cost, cost_per_mi, fuel_pct, congestion_ratio, congestion_tier")


@query("r03_route_matrix", with_(*ROUTE_BASE) + "SELECT origin, destination, driving_mi, driving_hr FROM routes")
def r03_route_matrix(spark, sf):
    """Routes for every observed lane; routed values from
    the parsed JSON responses, same-place pairs zero."""
    return route_table(spark, sf)


@query("s06_parse_routing", with_(FLOWS, COORDS, LANDED) + f"""
SELECT origin, destination, {rhu('distance / 1609.34', 1)} AS routed_mi,
       {rhu('duration / 3600.0', 2)} AS routed_hr FROM landed""")
def s06_parse_routing(spark, sf):
    return routes.routed_legs(routing_landed(spark, sf).rows)


@query("r01_great_circle_miles", with_(FLOWS, COORDS, "lanes_seen AS (SELECT DISTINCT origin, destination FROM flows)") + f"""
SELECT l.origin, l.destination, {rhu('hav', 1)} AS gc_mi FROM (
  SELECT l.origin, l.destination, {haversine('o.lat', 'o.lon', 'd.lat', 'd.lon')} AS hav
  FROM lanes_seen l JOIN coords o ON l.origin = o.code JOIN coords d ON l.destination = d.code) l""")
def r01_great_circle_miles(spark, sf):
    from haulage.functions import haversine_miles
    seen = observed_pairs(spark, sf)
    c = B.nation_coords(spark, sf)
    o = c.select(F.col("code").alias("origin"), F.col("lat").alias("a"), F.col("lon").alias("b"))
    d = c.select(F.col("code").alias("destination"), F.col("lat").alias("x"), F.col("lon").alias("y"))
    return seen.join(o, "origin").join(d, "destination").select(
        "origin", "destination", round_half_up(haversine_miles("a", "b", "x", "y"), 1).alias("gc_mi"))


@query("j12_latest_snapshot_rows", with_(SNAPS, NATION_SNAPS, _FUEL_LATEST) + "SELECT state, diesel FROM fuel_latest")
def j12_latest_snapshot_rows(spark, sf):
    return origin_diesel(spark, sf)


@query("r04_route_costs", with_(*COST_BASE) + "SELECT * FROM costs")
def r04_route_costs(spark, sf):
    """Per-route fuel, driver, maintenance and total cost."""
    return route_costs(spark, sf)


@query("r05_congestion", with_(*CONG_BASE) + f"SELECT {CONG_COLS} FROM cong")
def r05_congestion(spark, sf):
    """Congestion ratio and right-closed tier bins."""
    return congested(spark, sf)


_LANES = f"""lanes AS (SELECT origin, destination, commodity, mode, SUM(tons) AS tons_latest,
  {rhu('SUM(tons) / 1000.0', 2)} AS tons_m FROM flows WHERE year = {Y}
  GROUP BY origin, destination, commodity, mode)"""

_EFF = f"""SELECT l.*, c.driving_mi, c.total_cost, c.cost_per_mi, c.fuel_pct, c.congestion_ratio, c.congestion_tier,
  {rhu('CASE WHEN c.total_cost = 0 THEN (CASE WHEN l.tons_m = 0 THEN NULL ELSE 0.0 END) ELSE l.tons_m / c.total_cost END', 6)} AS tons_per_dollar,
  {rhu('CASE WHEN c.driving_mi = 0 THEN (CASE WHEN l.tons_m = 0 THEN NULL ELSE 0.0 END) ELSE l.tons_m / c.driving_mi END', 2)} AS tons_per_mile
FROM lanes l JOIN cong c ON l.origin = c.origin AND l.destination = c.destination"""


@query("r06_lane_efficiency", with_(*CONG_BASE, _LANES) + _EFF)
def r06_lane_efficiency(spark, sf):
    """R6/J8/T8 on all lanes (not only the national top 100), by volume. The
    routes come from the stored lane table, one row per pair of places."""
    lanes = freight.lane_totals(B.flows(spark, sf, latest=True, columns=LANES), None, None)
    return routes.lane_efficiency(lanes, congested(spark, sf))


@query("r06_lane_efficiency_by_tons_per_dollar_top20", with_(*CONG_BASE, _LANES) + f"""
SELECT * FROM ({_EFF}) ORDER BY tons_per_dollar DESC, origin, destination, commodity, mode LIMIT 20""")
def r06_lane_efficiency_by_tons_per_dollar_top20(spark, sf):
    """Q8: the same table ordered by tons per dollar (most efficient first)."""
    lanes = freight.lane_totals(B.flows(spark, sf, latest=True, columns=LANES), None, None)
    return routes.lane_efficiency(lanes, congested(spark, sf), order_by_efficiency=True).limit(20)


@query("a44_cost_summary", with_(*CONG_BASE) + """
SELECT COUNT(*) AS routes,
  CAST(SUM(CAST(cost_per_mi AS DECIMAL(18,4))) AS DOUBLE) / COUNT(cost_per_mi) AS avg_cost_per_mi,
  CAST(SUM(CAST(fuel_pct AS DECIMAL(18,1))) AS DOUBLE) / COUNT(fuel_pct) AS avg_fuel_pct,
  (SELECT COUNT(*) FROM cong WHERE congestion_tier = 'High') AS high_congestion
FROM costs""")
def a44_cost_summary(spark, sf):
    c = route_costs(spark, sf)
    return routes.cost_summary(c, routes.congestion(c))


@query("a38_cost_components_by_origin", with_(*COST_BASE) + """
SELECT origin, component, cost FROM (
  SELECT origin,
    CAST(SUM(CAST(fuel_cost AS DECIMAL(18,2))) AS DOUBLE) / COUNT(fuel_cost) AS fuel_cost,
    CAST(SUM(CAST(driver_cost AS DECIMAL(18,2))) AS DOUBLE) / COUNT(driver_cost) AS driver_cost,
    CAST(SUM(CAST(maint_cost AS DECIMAL(18,2))) AS DOUBLE) / COUNT(maint_cost) AS maint_cost
  FROM costs GROUP BY origin)
UNPIVOT (cost FOR component IN (fuel_cost, driver_cost, maint_cost))""")
def a38_cost_components_by_origin(spark, sf):
    return routes.cost_components_by_origin(route_costs(spark, sf))


@query("a39_congestion_by_origin", with_(*CONG_BASE) + f"""
SELECT origin, {rhu('CAST(SUM(CAST(congestion_ratio AS DECIMAL(18,3))) AS DOUBLE) / COUNT(congestion_ratio)', 2)} AS avg_congestion
FROM cong GROUP BY origin""")
def a39_congestion_by_origin(spark, sf):
    return routes.congestion_by_origin(congested(spark, sf))


@query("a40_origin_route_summary", with_(*CONG_BASE) + """
SELECT origin,
  CAST(SUM(CAST(cost_per_mi AS DECIMAL(18,4))) AS DOUBLE) / COUNT(cost_per_mi) AS avg_cost_per_mi,
  CAST(SUM(CAST(fuel_pct AS DECIMAL(18,1))) AS DOUBLE) / COUNT(fuel_pct) AS avg_fuel_pct,
  CAST(SUM(CAST(driving_mi AS DECIMAL(18,1))) AS DOUBLE) / COUNT(driving_mi) AS avg_miles,
  CAST(SUM(CAST(driving_hr AS DECIMAL(18,2))) AS DOUBLE) / COUNT(driving_hr) AS avg_hours,
  CAST(SUM(CAST(congestion_ratio AS DECIMAL(18,3))) AS DOUBLE) / COUNT(congestion_ratio) AS avg_congestion,
  coalesce(string_agg(DISTINCT CASE WHEN congestion_tier = 'High' THEN destination END, ', '
                      ORDER BY CASE WHEN congestion_tier = 'High' THEN destination END), '') AS high_congestion_to
FROM cong GROUP BY origin""")
def a40_origin_route_summary(spark, sf):
    """Per-origin route summary with the high-congestion destinations."""
    return routes.origin_route_summary(congested(spark, sf))


@query("a07_avg_haul", with_(*ROUTE_BASE, f"""lt AS (SELECT origin, destination, SUM(tons) AS t FROM flows
  WHERE year = {Y} GROUP BY origin, destination)""") + f"""
SELECT lt.origin AS state, {rhu('SUM(lt.t * r.driving_mi) / nullif(SUM(lt.t), 0)', 1)} AS avg_miles
FROM lt JOIN routes r ON lt.origin = r.origin AND lt.destination = r.destination GROUP BY lt.origin""")
def a07_avg_haul(spark, sf):
    """A7 (Q6): ton-miles from lane tons x route miles, over tons, by origin."""
    stored = lane_quarters(spark, sf)
    lanes = freight.latest(stored).select("origin", "destination", F.col("t").alias("tons"))
    return freight.avg_haul(lanes, route_table(spark, sf), None)


@query("m06_cost_trend_line", with_(*COST_BASE) + f"""
SELECT {rhu('regr_slope(total_cost, driving_mi)', 6)} AS slope,
       {rhu('regr_intercept(total_cost, driving_mi)', 4)} AS intercept,
       COUNT(*) AS n FROM costs WHERE driving_mi > 0""")
def m06_cost_trend_line(spark, sf):
    """M6: degree-1 trend line of total cost on miles (one aggregate)."""
    c = route_costs(spark, sf).where(F.col("driving_mi") > 0)
    return c.agg(round_half_up(F.regr_slope("total_cost", "driving_mi"), 6).alias("slope"),
                 round_half_up(F.regr_intercept("total_cost", "driving_mi"), 4).alias("intercept"),
                 F.count(F.lit(1)).alias("n"))


@query("w04_latest_fuel_per_state", with_(SNAPS, LATEST_FUEL) + "SELECT * FROM fuel")
def w04_latest_fuel_per_state(spark, sf):
    """Latest non-null price of each kind per state (snapshots may carry
    nulls in the newer rows)."""
    return joins.latest_per_key(B.fuel_snapshots(spark, sf))
