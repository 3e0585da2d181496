"""Route distance, cost and congestion.

Routes are built for the lanes that carry freight (distinct origin /
destination pairs of the flow table), not as an all-pairs cross product:
the pair set comes from a ``distinct``, a pair and its reverse are worked out
once, and the coordinates come from two broadcast lookups of the (fixed-size)
centroid dimension.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from haulage import dims
from haulage.functions import (congestion_tier, haversine_miles, inf_to_zero_div, money_sum,
                               round_half_up, safe_div)
from haulage.sources.landed import Landed, ingest

ROUTING_SCHEMA = T.StructType([
    T.StructField("code", T.StringType()),
    T.StructField("routes", T.ArrayType(T.StructType([
        T.StructField("distance", T.DoubleType()),
        T.StructField("duration", T.DoubleType())]))),
])


def routing_payload(landed: DataFrame) -> DataFrame:
    """Serialise flat routing results to the raw JSON response form
    (origin, destination, payload)."""
    body = F.struct(F.col("code"), F.array(F.struct("distance", "duration")).alias("routes"))
    return landed.select("origin", "destination", F.to_json(body).alias("payload"))


def routing_landed(spark: SparkSession, path: str, out: str) -> Landed:
    """One response per line, in an envelope with its origin and destination;
    ``rows`` has (origin, destination, response) of the routed ones."""
    schema = T.StructType([T.StructField("origin", T.StringType()), T.StructField("destination", T.StringType()),
                           T.StructField("response", ROUTING_SCHEMA)])
    routed = (F.col("response.code") == "Ok") & (F.size("response.routes") > 0)
    return ingest(spark, path, out, schema, {"no_route": routed})


def parse_routing(raw: DataFrame, payload: str = "payload") -> DataFrame:
    """``routed_legs`` for responses in a string column."""
    return routed_legs(raw.select("origin", "destination", F.from_json(F.col(payload), ROUTING_SCHEMA).alias("response")))


def routed_legs(parsed: DataFrame) -> DataFrame:
    """Routing response -> miles (/1609.34, 1 dp) and hours (/3600, 2 dp),
    only for responses with code 'Ok' and at least one route."""
    leg = F.try_element_at(F.col("response.routes"), F.lit(1))
    return (parsed.select("origin", "destination", F.col("response.code").alias("code"), leg.alias("leg"))
            .where((F.col("code") == "Ok") & F.col("leg").isNotNull())
            .select("origin", "destination",
                    round_half_up(F.col("leg.distance") / 1609.34, 1).alias("routed_mi"),
                    round_half_up(F.col("leg.duration") / 3600.0, 2).alias("routed_hr")))


def route_table(pairs: DataFrame, routed: DataFrame, centers: DataFrame) -> DataFrame:
    """One row per (origin, destination) pair.

    A pair and its reverse are one unordered pair, worked out once and mirrored
    into the directions that were asked for, so both have equal miles and hours.
    Same-place pairs are 0 miles / 0 hours. The others take the routed values of
    the direction whose origin sorts first, else those of the other direction,
    else the great-circle distance (1 dp) at 55 mph (2 dp).
    """
    low, high = F.least("origin", "destination").alias("_a"), F.greatest("origin", "destination").alias("_b")
    ends = (pairs.select(low, high, (F.col("origin") <= F.col("destination")).alias("_f"))
            .groupBy("_a", "_b").agg(F.bool_or("_f").alias("_forward"), F.bool_or(~F.col("_f")).alias("_back")))
    legs = (routed.select(low, high, F.struct("routed_mi", "routed_hr").alias("_leg"), (F.col("origin") > F.col("destination")).alias("_r"))
            .groupBy("_a", "_b").agg(F.min_by("_leg", "_r").alias("_leg")))
    c = centers.select("code", "lat", "lon")
    o = c.select(F.col("code").alias("_a"), F.col("lat").alias("_olat"), F.col("lon").alias("_olon"))
    d = c.select(F.col("code").alias("_b"), F.col("lat").alias("_dlat"), F.col("lon").alias("_dlon"))
    gc = round_half_up(haversine_miles("_olat", "_olon", "_dlat", "_dlon"), 1)
    same, known = F.col("_a") == F.col("_b"), F.col("_leg").isNotNull()
    once = (ends.join(o, "_a").join(d, "_b").join(legs, ["_a", "_b"], "left")
            .select("_a", "_b", "_forward", "_back",
                    F.when(same, F.lit(0.0)).when(known, F.col("_leg.routed_mi")).otherwise(gc).alias("driving_mi"),
                    F.when(same, F.lit(0.0)).when(known, F.col("_leg.routed_hr"))
                     .otherwise(round_half_up(gc / dims.SPEED_BASELINE, 2)).alias("driving_hr")))
    directions = F.array(F.when(F.col("_forward"), F.struct(F.col("_a").alias("origin"), F.col("_b").alias("destination"))),
                         F.when(F.col("_back"), F.struct(F.col("_b").alias("origin"), F.col("_a").alias("destination"))))
    return (once.select(F.explode(F.array_compact(directions)).alias("_d"), "driving_mi", "driving_hr")
            .select("_d.origin", "_d.destination", "driving_mi", "driving_hr"))


def latest_snapshot(fuel: DataFrame, ts: str = "scraped_at") -> DataFrame:
    """Rows of the most recent snapshot (``ts = (SELECT max(ts) ...)``)."""
    return fuel.where(F.col(ts) == fuel.select(F.max(ts)).scalar())


def route_costs(routes: DataFrame, diesel: DataFrame | None = None,
                default_diesel: float = dims.DEFAULT_DIESEL) -> DataFrame:
    """Operating cost per route. ``diesel`` has (state, diesel), one row
    per state; the origin's price is used, else the default. Zero-mile routes
    get zero costs and null diesel_price / fuel_pct."""
    r = routes
    if diesel is not None:
        r = r.join(diesel.select(F.col("state").alias("origin"), F.col("diesel").alias("_diesel")),
                   "origin", "left")
    else:
        r = r.withColumn("_diesel", F.lit(None).cast("double"))
    mi, hr = F.col("driving_mi"), F.col("driving_hr")
    price = F.coalesce(F.col("_diesel"), F.lit(default_diesel))
    fuel = mi / dims.TRUCK_MPG * price
    driver = hr * dims.DRIVER_RATE
    maint = mi * dims.MAINTENANCE_PER_MI
    total = fuel + driver + maint
    zero = mi == 0

    def z(expr):
        return F.when(zero, F.lit(0.0)).otherwise(expr)

    return r.select(
        "origin", "destination",
        z(round_half_up(mi, 1)).alias("driving_mi"),
        z(round_half_up(hr, 2)).alias("driving_hr"),
        F.when(zero, F.lit(None).cast("double")).otherwise(round_half_up(price, 2)).alias("diesel_price"),
        z(round_half_up(fuel, 2)).alias("fuel_cost"),
        z(round_half_up(driver, 2)).alias("driver_cost"),
        z(round_half_up(maint, 2)).alias("maint_cost"),
        z(round_half_up(total, 2)).alias("total_cost"),
        z(round_half_up(safe_div(total, mi), 4)).alias("cost_per_mi"),
        F.when(zero, F.lit(None).cast("double"))
         .when(total > 0, round_half_up(fuel / total * 100, 1)).otherwise(F.lit(0.0)).alias("fuel_pct"),
    )


def congestion(costs: DataFrame) -> DataFrame:
    """Ratio of routed hours to free-flow hours (miles / 55), 3 dp, 0 when
    there is no distance; tier Low/Moderate/High (0 -> null)."""
    free_flow = F.try_divide(F.col("driving_mi"), F.lit(dims.SPEED_BASELINE))
    ratio = F.coalesce(round_half_up(safe_div(F.col("driving_hr"), F.nullif(free_flow, F.lit(0.0))), 3),
                       F.lit(0.0))
    return (costs.withColumn("congestion_ratio", ratio)
            .withColumn("congestion_tier", congestion_tier("congestion_ratio")))


def lane_efficiency(lanes: DataFrame, congested: DataFrame, volume: str = "tons_m",
                    order_by_efficiency: bool = False) -> DataFrame:
    """Lanes joined to route cost and congestion on (origin,
    destination); tons per dollar (6 dp) and per mile (2 dp), zero divisor
    -> 0. Ordered by volume (as published) or by tons per dollar."""
    cols = ["origin", "destination", "driving_mi", "total_cost", "cost_per_mi", "fuel_pct",
            "congestion_ratio", "congestion_tier"]
    m = lanes.join(congested.select(*cols), ["origin", "destination"])
    m = (m.withColumn("tons_per_dollar", round_half_up(inf_to_zero_div(volume, "total_cost"), 6))
         .withColumn("tons_per_mile", round_half_up(inf_to_zero_div(volume, "driving_mi"), 2)))
    keys = [c for c in ("origin", "destination", "commodity", "mode") if c in m.columns]
    first = "tons_per_dollar" if order_by_efficiency else volume
    return m.orderBy(F.desc(first), *keys)


def cost_summary(costs: DataFrame, congested: DataFrame) -> DataFrame:
    """Route count, high-congestion count, mean cost per mile (zero-mile
    routes count as 0, as published) and mean fuel share (nulls skipped)."""
    high = congested.select(F.count_if(F.col("congestion_tier") == "High")).scalar()
    return costs.agg(F.count(F.lit(1)).alias("routes"),
                     (F.sum(F.col("cost_per_mi").cast("decimal(18,4)")).cast("double")
                      / F.count("cost_per_mi")).alias("avg_cost_per_mi"),
                     (F.sum(F.col("fuel_pct").cast("decimal(18,1)")).cast("double")
                      / F.count("fuel_pct")).alias("avg_fuel_pct"),
                     high.alias("high_congestion"))


def cost_components_by_origin(costs: DataFrame) -> DataFrame:
    """Mean fuel / driver / maintenance cost per origin, melted to
    (origin, component, cost)."""
    means = costs.groupBy("origin").agg(
        *[(money_sum(c) / F.count(c)).alias(c)
          for c in ("fuel_cost", "driver_cost", "maint_cost")])
    return means.unpivot("origin", ["fuel_cost", "driver_cost", "maint_cost"], "component", "cost")


def congestion_by_origin(congested: DataFrame) -> DataFrame:
    """Mean congestion ratio per origin, 2 dp."""
    return congested.groupBy("origin").agg(
        round_half_up(F.sum(F.col("congestion_ratio").cast("decimal(18,3)")).cast("double")
                      / F.count("congestion_ratio"), 2).alias("avg_congestion"))


def origin_route_summary(congested: DataFrame) -> DataFrame:
    """Per origin mean cost per mile, fuel share, miles, hours,
    congestion, and the high-congestion destinations as a sorted list."""
    def mean(c, s):
        return F.sum(F.col(c).cast(f"decimal(18,{s})")).cast("double") / F.count(c)

    return congested.groupBy("origin").agg(
        mean("cost_per_mi", 4).alias("avg_cost_per_mi"),
        mean("fuel_pct", 1).alias("avg_fuel_pct"),
        mean("driving_mi", 1).alias("avg_miles"),
        mean("driving_hr", 2).alias("avg_hours"),
        mean("congestion_ratio", 3).alias("avg_congestion"),
        F.concat_ws(", ", F.sort_array(F.collect_set(
            F.when(F.col("congestion_tier") == "High", F.col("destination"))))).alias("high_congestion_to"),
    )


def headline_metrics(yearly: DataFrame, rates: DataFrame, costs: DataFrame,
                     congested: DataFrame) -> DataFrame:
    """Totals of one year (``yearly`` holds its row), mean truck rate, mean cost per mile, count of
    High congestion: four one-row aggregates side by side."""
    r = rates.select(F.sum(F.col("rate_per_mile").cast("decimal(18,4)")).cast("double")
                     / F.count("rate_per_mile")).scalar()
    c = costs.where(F.col("cost_per_mi") > 0).select(
        F.sum(F.col("cost_per_mi").cast("decimal(18,4)")).cast("double") / F.count("cost_per_mi")).scalar()
    h = congested.select(F.count_if(F.col("congestion_tier") == "High")).scalar()
    return yearly.select(
        "tons_m", "value_b", r.alias("avg_rate_per_mile"), c.alias("avg_cost_per_mi"),
        h.alias("high_congestion"))
