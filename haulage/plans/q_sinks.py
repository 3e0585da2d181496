"""Round trips through sinks and sources, lookups and the enriched dataset
(S1, S9-S14, S16, R7, K7, J2, J10, P4, P8, P14).

Sink queries write to a fresh folder under the session's shared checkpoint
folder and return what they read back, so the oracle checks both halves.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from haulage import dims
from haulage.functions import round_half_up
from haulage.operators import cleaning, features, freight, joins, kpis, marts, routes
from haulage.plans import batch, layout
from haulage.plans import bindings as B
from haulage.plans.catalog import ORACLE, query
from haulage.plans.q_cleaning import dirty_shipping
from haulage.plans.q_entities import ent, latest_fuel, shipping, plain
from haulage.plans.q_kpis import G_BASIC, G_EFF, GROUP_COLS
from haulage.plans.q_profile import s15_table_profile
from haulage.plans.q_sources import _WX, weather_landed
from haulage.plans.sqlparts import (COORDS, ENTITIES, FLOWS, LATEST_FUEL,
                                    NATION_SNAPS, SNAPS, rhu, with_)
from haulage.session import materialize
from haulage.session import scratch_path
from haulage.sources import apis, files
from haulage.streaming import snapshots

# The oracles of these queries are the ones of the tables they write.
from haulage.plans import q_freight, q_profile, q_routes  # noqa: F401  (register first)


def scratch(spark) -> str:
    return scratch_path(spark)


LANE_SCHEMA = (f"origin string, destination string, commodity string, mode string, "
               f"tons_latest double, tons_m double")


@query("s01_s11_csv_round_trip", ORACLE["a03_lane_totals"])
def s01_s11_csv_round_trip(spark, sf):
    """S11 then S1: write the top lanes as CSV with a header, read them back
    with an explicit schema."""
    path = scratch(spark)
    files.write_csv(freight.lane_totals(B.flows(spark, sf, latest=True, columns=(*freight.LANE_KEYS, "year", "tons")), None, 100), path)
    return files.read_csv(spark, path, LANE_SCHEMA)


@query("s09_s10_table_round_trip", ORACLE["a02_state_year_totals"])
def s09_s10_table_round_trip(spark, sf):
    """S10 replace + append into a year-partitioned parquet table, then S9."""
    path = scratch(spark)
    totals = materialize(freight.state_year_totals(B.flows(spark, sf, columns=("origin", "year", "tons", "value"))))
    last = freight.latest_year(totals)
    files.write_table(totals.where(F.col("year") < last), path, "overwrite", ["year"])
    files.write_table(totals.where(F.col("year") >= last), path, "append", ["year"])
    return files.read_table(spark, path)


@query("s12_s13_staging_view_sql", with_(ENTITIES) + """
SELECT state, nation AS postal, rank, population FROM ent
WHERE population > (SELECT avg(population) FROM ent)""")
def s12_s13_staging_view_sql(spark, sf):
    """S13 staging projection registered as a view (S12) and queried with SQL."""
    # a name of its own: two runs may share the session
    view = f"stg_shipping_stats_{uuid.uuid4().hex}"
    marts.register_view(shipping(spark, sf), view)
    return spark.sql(f"SELECT state, postal, rank, population FROM {view} "
                     f"WHERE population > (SELECT avg(population) FROM {view})")


@query("s12_layer_tables", ORACLE["k05_efficiency_mart_percent_rank_tier"])
def s12_layer_tables(spark, sf):
    """Staging, intermediate and mart tables written by layer and name;
    the efficiency mart read back."""
    path = scratch(spark)
    marts.store_layers(shipping(spark, sf), latest_fuel(spark, sf), path)
    fa = files.read_table(spark, f"{path}/marts/fct_efficiency_analysis")
    return fa.withColumn("fuel_burden_index", round_half_up("fuel_burden_index", 6)).withColumn(
        "efficiency_score", round_half_up("efficiency_score", 6))


WEATHER_SCHEMA = T.StructType([T.StructField("state", T.LongType()), T.StructField("temperature", T.DoubleType())])


@query("s14_optional_weather_table", with_(ENTITIES) + """
SELECT state, population, CAST(NULL AS DOUBLE) AS temperature FROM ent""")
def s14_optional_weather_table(spark, sf):
    """A missing weather table reads as an empty typed table, and the
    optional left join keeps every entity with null weather."""
    w = files.optional_table(spark, scratch(spark), WEATHER_SCHEMA)
    return joins.enrich_left(plain(spark, sf).select("state", "population"), w, "state", ["temperature"])


PROFILE_SCHEMA = "table_name string, column_name string, kind string, rows long, nulls long, null_pct double"


@query("s16_profile_json_round_trip", ORACLE["s15_table_profile"])
def s16_profile_json_round_trip(spark, sf):
    """S15 profile written as JSON lines (S16) and read back."""
    path = scratch(spark)
    files.write_json(s15_table_profile(spark, sf), path)
    return spark.read.schema(PROFILE_SCHEMA).json(path)


@query("a03_bucketed_layout", ORACLE["a03_lane_totals"])
def a03_bucketed_layout(spark, sf):
    """A3 from copies of the line items, orders and customers that are bucketed
    by the join key, so that the largest join reads matching buckets without a
    shuffle. The copies go to a database of their own in the shared folder."""
    name, path = f"freight_{uuid.uuid4().hex[:12]}", scratch(spark)
    spark.sql(f"CREATE DATABASE {name} LOCATION '{path}'")
    layout.write_bucketed(spark, sf, name, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return freight.lane_totals(freight.latest(layout.flows_bucketed(spark, sf, name)), None, 100)


@query("s10_streamed_snapshots", with_(SNAPS) + """
SELECT CAST(state AS VARCHAR) AS state, regular, mid_grade, premium, diesel, 'run-' || (state % 2) AS pipeline_run_id, 'AAA' AS data_source
FROM snaps""")
def s10_streamed_snapshots(spark, sf):
    """Snapshots landed as JSON lines in two loads, some of them
    delivered twice, appended to a table by a stream that drops the second ones
    and starts again where it stopped."""
    landing, out, name = scratch(spark), scratch(spark), f"snapshots-{uuid.uuid4().hex}"
    snaps = materialize(B.fuel_snapshots(spark, sf))
    for load in (0, 1):
        rows = files.stamp(snaps.where(F.col("state") % 2 == load).withColumn("state", F.col("state").cast("string")), f"run-{load}", "AAA")
        twice = rows.unionByName(rows.where(F.col("state").cast("long") % 5 == 0))
        twice.write.mode("append").json(landing)
        stream = snapshots.deduplicated(snapshots.read_snapshots(spark, landing), "3650 days")
        snapshots.append_to_table(stream, out, name).awaitTermination()
    return spark.read.schema(snapshots.SNAPSHOT_SCHEMA).parquet(out).drop("scraped_at")


@query("w04_streamed_latest", with_(SNAPS, LATEST_FUEL) + """
SELECT CAST(state AS VARCHAR) AS state, regular, mid_grade, premium, diesel FROM fuel""")
def w04_streamed_latest(spark, sf):
    """W4 as streaming state: the latest non-null price of each kind per state,
    published with every batch, from two loads."""
    landing, out, name = scratch(spark), scratch(spark), f"latest-{uuid.uuid4().hex}"
    snaps = materialize(B.fuel_snapshots(spark, sf).withColumn("state", F.col("state").cast("string")))
    for load in (0, 1):
        snaps.where(F.day("scraped_at") % 2 == load).write.mode("append").json(landing)
        snapshots.publish_latest(snapshots.read_snapshots(spark, landing), out, name).awaitTermination()
    return snapshots.read_published(spark, out).select("state", "regular", "mid_grade", "premium", "diesel")


@query("r07_cost_tables_round_trip", ORACLE["a44_cost_summary"])
def r07_cost_tables_round_trip(spark, sf):
    """A9 + R7: flows written once (by year), freight and cost tables written
    stage by stage, summary from the written tables."""
    out = scratch(spark)
    batch.store_freight_tables(spark, sf, out)
    batch.store_cost_tables(spark, sf, out)
    costs = files.read_table(spark, f"{out}/route_costs")
    return routes.cost_summary(costs, files.read_table(spark, f"{out}/route_congestion"))


_WXV = "wxv AS (SELECT * FROM wx WHERE humidity BETWEEN 0 AND 100 AND wind_speed >= 0 AND length(coalesce(condition, '')) >= 1)"


@query("k07_enriched_dataset", with_(ENTITIES, SNAPS, LATEST_FUEL, _WX, _WXV) + f"""
SELECT e.state, e.rank, e.population, e.region, f.regular, f.mid_grade, f.premium, f.diesel,
  w.temperature, w.condition, w.humidity, w.wind_speed,
  {rhu('e.population / (e.rank * 1000)', 6)} AS efficiency_score,
  {rhu('ln(e.population)', 9)} AS log_population,
  {rhu('avg(e.population) OVER (PARTITION BY e.region)', 4)} AS region_population_mean,
  {rhu('stddev_samp(e.population) OVER (PARTITION BY e.region)', 4)} AS region_population_std
FROM ent e LEFT JOIN fuel f ON e.state = f.state LEFT JOIN wxv w ON e.state = w.state""")
def k07_enriched_dataset(spark, sf):
    """K7: J1 latest fuel, J2 weather (valid rows only), P14 fixed column
    order, then F1 and F2 features."""
    order = ["state", "rank", "population", "region", "regular", "mid_grade", "premium", "diesel",
             "temperature", "condition", "humidity", "wind_speed", "visibility"]
    valid, _ = cleaning.apply_contract(apis.weather_flat(weather_landed(spark, sf).rows), cleaning.weather_contract())
    e = joins.enrich_left(ent(spark, sf), latest_fuel(spark, sf), "state",
                          ["regular", "mid_grade", "premium", "diesel"])
    e = joins.enrich_left(e, valid, "state", ["temperature", "condition", "humidity", "wind_speed"])
    e = cleaning.select_present(e, order)
    f = features.regional_features(features.basic_features(e))
    return f.select(*order[:-1], round_half_up("efficiency_score", 6).alias("efficiency_score"),
                    round_half_up("log_population", 9).alias("log_population"),
                    round_half_up("region_population_mean", 4).alias("region_population_mean"),
                    round_half_up("region_population_std", 4).alias("region_population_std"))


@query("k07_enriched_csv", ORACLE["k07_enriched_dataset"])
def k07_enriched_csv(spark, sf):
    """K7: the enriched dataset with its features as CSV, read back."""
    path = scratch(spark)
    out = k07_enriched_dataset(spark, sf)
    files.write_csv(out, path)
    return files.read_csv(spark, path, out.schema)


@query("k07_kpi_summary_csv", with_(ENTITIES, G_BASIC, G_EFF) + " UNION ALL ".join(
    f"SELECT '{c}' AS metric, CAST({c} AS DOUBLE) AS value FROM g_{g}" for g in ("basic", "efficiency") for c in GROUP_COLS[g]))
def k07_kpi_summary_csv(spark, sf):
    """The KPI summary (basic and efficiency metrics) as CSV, read back."""
    path = scratch(spark)
    e = materialize(ent(spark, sf))
    long = kpis.all_kpis({"basic": kpis.basic_kpis(e), "efficiency": kpis.efficiency_kpis(e)}).drop("category")
    files.write_csv(long, path)
    return files.read_csv(spark, path, "metric string, value double")


@query("j10_origin_lookup_with_defaults", with_(FLOWS, COORDS, SNAPS, NATION_SNAPS) + """
, ld AS (SELECT state, arg_max(diesel, scraped_at) FILTER (WHERE diesel IS NOT NULL) AS diesel FROM nsnaps GROUP BY state)
SELECT o.origin AS state, coalesce(ld.diesel, 0.0) AS diesel, coalesce(c.lat, 0.0) AS lat, coalesce(c.lon, 0.0) AS lon
FROM (SELECT DISTINCT origin FROM flows) o LEFT JOIN ld ON o.origin = ld.state LEFT JOIN coords c ON o.origin = c.code""".replace(
    "\n, ld AS", ",\nld AS", 1).replace(")\n,\nld", "),\nld"))
def j10_origin_lookup_with_defaults(spark, sf):
    """Each origin with its latest non-null diesel (default 0) and
    coordinates (default 0, 0)."""
    origins = B.flows(spark, sf, columns=("origin",)).select(F.col("origin").alias("state")).distinct()
    diesel = joins.latest_per_key(B.nation_fuel_snapshots(spark, sf), value_cols=["diesel"]).select("state", "diesel")
    c = B.nation_coords(spark, sf).select(F.col("code").alias("state"), "lat", "lon")
    out = joins.lookup_with_default(origins.join(diesel, "state", "left"), c, "state", {"lat": 0.0, "lon": 0.0})
    return out.select("state", F.coalesce("diesel", F.lit(0.0)).alias("diesel"), "lat", "lon")


def _values(name, cols, rows):
    def lit(x):
        if x is None:
            return "NULL"
        return f"CAST({x!r} AS DOUBLE)" if isinstance(x, float) else repr(x)

    vals = ", ".join("(" + ", ".join(lit(x) for x in r) + ")" for r in rows)
    return f"{name} AS (SELECT * FROM (VALUES {vals}) AS t({cols}))"


_P4_DIMS = [dims.state_index_sql(),
            _values("sd", "code, name, city", [(c, n, dims.STATE_CITIES.get(c)) for c, n in dims.STATE_NAMES.items()]),
            _values("ctr", "code, lat, lon", [(c, a, b) for c, (a, b) in dims.STATE_COORDINATES.items()])]


@query("p04_state_lookups", with_(*_P4_DIMS) + """
SELECT DISTINCT st.code AS state, coalesce(sd.name, st.code) AS name, coalesce(sd.city, st.code) AS city, ctr.lat, ctr.lon
FROM customer JOIN st ON st.k = c_custkey % 50 LEFT JOIN sd ON sd.code = st.code LEFT JOIN ctr ON ctr.code = st.code""")
def p04_state_lookups(spark, sf):
    """Name and city (default: the code) and coordinates (default: nulls)
    per state code found in the cleaned shipping rows (broadcast lookups of
    fixed dimensions)."""
    raw = cleaning.normalize_state(dirty_shipping(spark, sf).select(F.col("State").alias("state")))
    codes = raw.select("state").distinct()
    sd = dims.states_dim(spark).select(F.col("code").alias("state"), "name", "city")
    ctr = dims.state_coords_dim(spark).select(F.col("code").alias("state"), "lat", "lon")
    out = joins.lookup_with_default(codes, sd, "state", {}).join(ctr, "state", "left")
    return out.select("state", F.coalesce("name", "state").alias("name"),
                      F.coalesce("city", "state").alias("city"), "lat", "lon")


@query("p08_state_upper_variant", with_(dims.state_index_sql()) + """
SELECT c_custkey AS id, CASE WHEN c_custkey % 3 = 2 THEN upper(st.code) ELSE upper(st.name) END AS state
FROM customer JOIN st ON st.k = c_custkey % 50""")
def p08_state_upper_variant(spark, sf):
    """The strip + upper-case state variant (no name lookup)."""
    d = cleaning.normalize_names(dirty_shipping(spark, sf))
    return cleaning.normalize_state(d, "state", mode="upper").select("id", "state")
