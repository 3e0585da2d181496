"""Bind the driver tables to the engine's freight concepts.

The driver data has no freight tables, so the engine's operators (generic
over column names) run on views derived here:

* flow row     = lineitem joined to orders, customer, supplier, part
                 origin/destination = supplier/customer nation name,
                 commodity = p_type, mode = o_orderpriority,
                 trade_type 1 (domestic) = l_linestatus 'F',
                 tons = l_quantity, value = l_extendedprice, year = ship year
* entity       = customer (the "state" of the shipping tables): population =
                 total order value, region = region name of its nation
* fuel snapshot= events per user and day; four event types are four prices
* coordinates  = derived from the nation key (same rule in the SQL oracle)

Every view reads whole tables; filters are predicates Catalyst pushes to the
parquet scan, and projections are pruned to the columns used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from haulage.functions import money_sum, round_half_up

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

# Event type that carries each fuel price in the events table (binding rule).
PRICE_EVENTS = {"regular": "view", "mid_grade": "click", "premium": "purchase", "diesel": "signup"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def nation_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """nation key -> name, region name. 25 rows at every scale: broadcast."""
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    return F.broadcast(n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey)
                       .select("n_nationkey", "n_name", "r_name"))


FLOW_COLUMNS = ("origin", "destination", "commodity", "mode", "year", "quarter", "trade_type", "tons", "value")


def ship_years(spark: SparkSession, sf_dir: str) -> list[int]:
    """All ship years from the first to the last (one min/max aggregate)."""
    lo, hi = table(spark, sf_dir, "lineitem").agg(F.year(F.min("l_shipdate")), F.year(F.max("l_shipdate"))).first()
    return [] if lo is None else list(range(lo, hi + 1))


def latest_year(spark: SparkSession, sf_dir: str) -> Column:
    """Last ship year of the domestic flows, as a scalar subquery."""
    return (table(spark, sf_dir, "lineitem").where(F.col("l_linestatus") == "F")
            .select(F.year(F.max("l_shipdate"))).scalar())


def flows(spark: SparkSession, sf_dir: str, domestic_only: bool = True, year: int | None = None,
          columns: tuple[str, ...] = FLOW_COLUMNS, read=table, bucketed: bool = False, latest: bool = False) -> DataFrame:
    """Long-form freight flows: origin, destination, commodity, mode, year,
    quarter, trade_type, tons, value (one row per line item).

    Only the sides that ``columns`` need are joined: supplier for the origin,
    orders for the mode, orders and customer for the destination, part for the
    commodity. This relies on every line item's foreign keys resolving (a test
    checks the tables); a row without its supplier would otherwise count in a
    total that does not read the origin.

    Join order keeps the fact stream narrow: orders pick up the customer's
    nation first (an orders-sized join), then line items join orders on the
    order key, then supplier and part. Nation names come from a 25-row
    broadcast. Small sides are broadcast by the size-checked threshold / AQE;
    large ones are sort-merge joined with AQE skew splitting.

    ``year`` restricts the rows to one ship year with a range predicate on the
    raw date column, which the parquet scan can use (row-group skipping, or
    partition pruning on a year-partitioned copy); ``year(date) = y`` cannot.
    ``latest`` restricts them to the last year that has any: the start of that
    year is a scalar subquery over two columns, whose value reaches the scan as a
    pushed filter when the query runs.
    ``read`` gives a table by name. With ``bucketed`` tables (see layout) the
    line items join the orders first, as both lie by the order key.
    """
    need = set(columns)
    out = read(spark, sf_dir, "lineitem")
    if domestic_only:
        out = out.where(F.col("l_linestatus") == "F")
    if year is not None:
        out = out.where((F.col("l_shipdate") >= F.lit(f"{year}-01-01").cast("timestamp_ntz"))
                        & (F.col("l_shipdate") < F.lit(f"{year + 1}-01-01").cast("timestamp_ntz")))
    if latest:
        start = out.select(F.date_trunc("year", F.max("l_shipdate")).cast("timestamp_ntz")).scalar()
        out = out.where(F.col("l_shipdate") >= start)
    nat = nation_names(spark, sf_dir)
    if need & {"destination", "mode"}:
        orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.col("o_orderpriority").alias("mode"))
        if "destination" in need:
            cust = (read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
                    .join(nat.select(F.col("n_nationkey").alias("c_nationkey"),
                                     F.col("n_name").alias("destination")), "c_nationkey"))
            if not bucketed:
                orders = orders.join(cust, F.col("o_custkey") == F.col("c_custkey"))
        out = out.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        if bucketed and "destination" in need:
            out = out.join(cust, F.col("o_custkey") == F.col("c_custkey"))
    if "origin" in need:
        supp = (read(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
                .join(nat.select(F.col("n_nationkey").alias("s_nationkey"),
                                 F.col("n_name").alias("origin")), "s_nationkey"))
        out = out.join(supp, F.col("l_suppkey") == F.col("s_suppkey"))
    if "commodity" in need:
        part = read(spark, sf_dir, "part").select("p_partkey", F.col("p_type").alias("commodity"))
        out = out.join(part, F.col("l_partkey") == F.col("p_partkey"))
    made = {"year": F.year("l_shipdate"), "quarter": F.quarter("l_shipdate"),
            "trade_type": F.when(F.col("l_linestatus") == "F", 1).otherwise(2),
            "tons": F.col("l_quantity"), "value": F.col("l_extendedprice")}
    return out.select(*[made[c].alias(c) if c in made else c for c in FLOW_COLUMNS if c in need])


def nation_coords(spark: SparkSession, sf_dir: str) -> DataFrame:
    """name, lat, lon from the nation key (binding rule, mirrored in SQL)."""
    k = F.col("n_nationkey")
    return F.broadcast(table(spark, sf_dir, "nation").select(
        F.col("n_name").alias("code"),
        (F.lit(25.0) + ((k * 7) % 25)).cast("double").alias("lat"),
        (F.lit(-120.0) + ((k * 11) % 50)).cast("double").alias("lon"),
        k.alias("nation_key")))


def entities(spark: SparkSession, sf_dir: str, with_rank: bool = True) -> DataFrame:
    """Shipping-stats view of customers with orders: state (customer key),
    population (total order value), region, nation, segment, rank (by
    population desc, key asc), population_per_rank."""
    pop = (table(spark, sf_dir, "orders")
           .groupBy(F.col("o_custkey").alias("state"))
           .agg(money_sum("o_totalprice").alias("population")))
    nat = nation_names(spark, sf_dir)
    cust = (table(spark, sf_dir, "customer")
            .select(F.col("c_custkey").alias("state"), "c_nationkey", "c_mktsegment")
            .join(nat, F.col("c_nationkey") == F.col("n_nationkey"))
            .select("state", F.col("n_name").alias("nation"), F.col("r_name").alias("region"),
                    F.col("c_mktsegment").alias("segment")))
    ent = cust.join(pop, "state")
    if not with_rank:
        return ent
    from haulage.operators.ranking import global_row_number
    ranked = global_row_number(ent, [F.desc("population"), F.asc("state")], out="rank")
    return ranked.withColumn("rank", F.col("rank").cast("int")).withColumn(
        "population_per_rank", F.col("population") / F.col("rank"))


def fuel_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Append-only fuel price snapshots: state, scraped_at (day), regular,
    mid_grade, premium, diesel (max of the day's readings; null if none)."""
    ev = table(spark, sf_dir, "events").select("user_id", "ts", "event_type", "value")
    aggs = [F.max(F.when(F.col("event_type") == et, F.col("value"))).alias(name)
            for name, et in PRICE_EVENTS.items()]
    snaps = (ev.where(F.col("event_type").isin(list(PRICE_EVENTS.values())))
             .groupBy(F.col("user_id").alias("state"),
                      F.date_trunc("day", F.col("ts")).cast("timestamp_ntz").alias("scraped_at"))
             .agg(*aggs))
    return snaps


def nation_fuel_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fuel snapshots rolled up to the customer's nation (route origins):
    state = nation name, highest reading of the day per price."""
    snaps = fuel_snapshots(spark, sf_dir)
    nat = nation_names(spark, sf_dir)
    cust = (table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
            .join(nat, F.col("c_nationkey") == F.col("n_nationkey"))
            .select(F.col("c_custkey").alias("state"), F.col("n_name").alias("nation")))
    return (snaps.join(cust, "state")
            .groupBy(F.col("nation").alias("state"), "scraped_at")
            .agg(*[F.max(c).alias(c) for c in PRICE_EVENTS]))


def landed_routes(spark: SparkSession, sf_dir: str, lanes: DataFrame) -> DataFrame:
    """Routing results as if landed from a routing service, one per observed
    lane: origin, destination, distance (m), duration (s), code. Road distance =
    1.18 x great circle; time = miles / 55 x factor, factor 1.05 + 0.1 *
    ((2 o + d) % 4) by nation keys, so the two directions of a pair differ. The
    code is 'NoRoute' for same-place pairs and for lanes with (o + 2 d) % 5 = 0:
    some pairs are routed in one direction only, and some in none."""
    from haulage.functions import haversine_miles
    c = nation_coords(spark, sf_dir)
    o = c.select(F.col("code").alias("origin"), F.col("lat").alias("olat"),
                 F.col("lon").alias("olon"), F.col("nation_key").alias("ok"))
    d = c.select(F.col("code").alias("destination"), F.col("lat").alias("dlat"),
                 F.col("lon").alias("dlon"), F.col("nation_key").alias("dk"))
    # No filter on the pairs here: same-place pairs get a 'NoRoute' status
    # instead, so the pair set stays one shared (reusable) subplan.
    pairs = lanes.join(o, "origin").join(d, "destination")
    miles = haversine_miles("olat", "olon", "dlat", "dlon")
    road_mi = miles * 1.18
    factor = F.lit(1.05) + F.lit(0.1) * ((F.col("ok") * 2 + F.col("dk")) % 4)
    return pairs.select(
        "origin", "destination",
        F.when((F.col("origin") != F.col("destination")) & ((F.col("ok") + F.col("dk") * 2) % 5 != 0), F.lit("Ok"))
         .otherwise(F.lit("NoRoute")).alias("code"),
        (road_mi * 1609.34).alias("distance"),
        (road_mi / 55.0 * factor * 3600.0).alias("duration"))


__all__ = ["table", "flows", "entities", "fuel_snapshots", "nation_fuel_snapshots",
           "nation_coords", "landed_routes", "nation_names", "PRICE_EVENTS",
           "round_half_up"]
