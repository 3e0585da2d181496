"""Entity ("state") queries: ranks, enrichment joins, features, marts
(E0, J1, J2, J6, J5, J13, J14, J16, F1-F6, W1-W3, W5-W7, K1-K6, P17, P18, P22, P25-P27)."""

from __future__ import annotations

from pyspark.sql import functions as F

from haulage import dims
from haulage.functions import round_half_up
from haulage.operators import features, joins, kpis, marts
from haulage.plans import bindings as B
from haulage.plans.catalog import query
from haulage.plans.sqlparts import ENTITIES, LATEST_FUEL, SNAPS, rhu, with_


def ent(spark, sf):
    return B.entities(spark, sf)


def plain(spark, sf):
    """Entities without rank, for the queries that don't read it."""
    return B.entities(spark, sf, with_rank=False)


def coded(df):
    """Binding of entities to state codes: key modulo the number of codes picks
    one of the fixed codes, two of which are no state."""
    codes = F.array(*map(F.lit, CODES))
    return df.withColumn("postal", F.element_at(codes, (F.col("state") % len(CODES) + 1).cast("int")))


def latest_fuel(spark, sf):
    return joins.latest_per_key(B.fuel_snapshots(spark, sf))


def shipping(spark, sf):
    """shipping_stats view: entities with postal = nation name and the price
    columns staged as typed nulls (they are not in this table)."""
    e = ent(spark, sf).withColumn("postal", F.col("nation"))
    return marts.staging(e, marts.SHIPPING_COLS)


def rsql(cols: list[str], digits: int = 6) -> str:
    return ", ".join(f"{rhu(c, digits)} AS {c}" for c in cols)


_SHIP = """ship AS (SELECT state, nation AS postal, rank, population, population_per_rank,
  CAST(NULL AS DOUBLE) AS regular, CAST(NULL AS DOUBLE) AS mid_grade, CAST(NULL AS DOUBLE) AS premium,
  CAST(NULL AS DOUBLE) AS diesel, CAST(NULL AS VARCHAR) AS pipeline_run_id FROM ent)"""

_FA = """fa0 AS (SELECT coalesce(s.state, f.state) AS state, s.postal, s.rank, s.population, s.population_per_rank,
  coalesce(s.regular, f.regular) AS regular, coalesce(s.mid_grade, f.mid_grade) AS mid_grade,
  coalesce(s.premium, f.premium) AS premium, coalesce(s.diesel, f.diesel) AS diesel,
  s.pipeline_run_id, f.scraped_at
  FROM ship s FULL OUTER JOIN fuel f ON s.state = f.state),
fa AS (SELECT *, population / nullif(diesel * 100, 0) AS efficiency_score,
  population / (SELECT max(population) FROM fa0) * diesel AS fuel_burden_index FROM fa0)"""

BASE = [ENTITIES, SNAPS, LATEST_FUEL]

CODES = [*sorted(c for codes in dims.REGIONS.values() for c in codes), "PR", "XX"]
_CODE = f"list_value({', '.join(repr(c) for c in CODES)})[state % {len(CODES)} + 1]"
_REGION = lambda code, dc: "CASE " + " ".join(
    f"WHEN {code} IN ({', '.join(repr(c) for c in codes if dc or c != 'DC')}) THEN '{name}'"
    for name, codes in dims.REGIONS.items())


@query("e00_entity_rank", with_(ENTITIES) + "SELECT state, nation, region, segment, population, rank, population_per_rank FROM ent")
def e00_entity_rank(spark, sf):
    """Entity table with the distributed row number by population (desc, key)."""
    return ent(spark, sf)


@query("j01_enrich_with_latest_fuel", with_(*BASE) + """
SELECT e.state, e.population, e.rank, e.region, f.regular, f.mid_grade, f.premium, f.diesel, f.scraped_at
FROM ent e LEFT JOIN fuel f ON e.state = f.state""")
def j01_enrich_with_latest_fuel(spark, sf):
    """J1/J2 (Q3): entities LEFT JOIN the latest snapshot per state (not every
    snapshot, which would multiply rows)."""
    e = ent(spark, sf).select("state", "population", "rank", "region")
    return joins.enrich_left(e, latest_fuel(spark, sf), "state",
                             ["regular", "mid_grade", "premium", "diesel", "scraped_at"])


@query("j16_entities_without_fuel", with_(*BASE) + """
SELECT state, population FROM ent WHERE state NOT IN (SELECT state FROM fuel)""")
def j16_entities_without_fuel(spark, sf):
    return joins.anti(plain(spark, sf).select("state", "population"), latest_fuel(spark, sf), "state")


@query("j15_entities_with_fuel", with_(*BASE) + """
SELECT state, population FROM ent WHERE state IN (SELECT state FROM fuel)""")
def j15_entities_with_fuel(spark, sf):
    return joins.semi(plain(spark, sf).select("state", "population"), latest_fuel(spark, sf), "state")


@query("j06_freight_analysis", with_(*BASE, _SHIP, _FA) + f"""
SELECT state, postal, rank, population, population_per_rank, regular, mid_grade, premium, diesel,
  pipeline_run_id, scraped_at, {rhu('efficiency_score', 6)} AS efficiency_score,
  {rhu('fuel_burden_index', 6)} AS fuel_burden_index FROM fa""")
def j06_freight_analysis(spark, sf):
    """Shipping FULL OUTER JOIN latest fuel, coalesced."""
    fa = marts.freight_analysis(shipping(spark, sf), latest_fuel(spark, sf))
    return fa.withColumn("efficiency_score", round_half_up("efficiency_score", 6)).withColumn(
        "fuel_burden_index", round_half_up("fuel_burden_index", 6))


_SHIP_PART = """ship AS (SELECT state, nation AS postal, rank, population, population_per_rank,
  CASE WHEN region = 'ASIA' THEN 3.25 END AS regular, CAST(NULL AS DOUBLE) AS mid_grade, CAST(NULL AS DOUBLE) AS premium,
  CASE WHEN region = 'EUROPE' THEN 4.5 END AS diesel, CAST(NULL AS VARCHAR) AS pipeline_run_id
  FROM ent WHERE segment <> 'MACHINERY')"""


@query("j06_both_unmatched_sides", with_(*BASE, _SHIP_PART, _FA) + f"""
SELECT state, postal, rank, population, population_per_rank, regular, mid_grade, premium, diesel,
  pipeline_run_id, scraped_at, {rhu('efficiency_score', 6)} AS efficiency_score,
  {rhu('fuel_burden_index', 6)} AS fuel_burden_index FROM fa""")
def j06_both_unmatched_sides(spark, sf):
    """J6/P19 with rows on either side only and prices on both: the shipping
    table has no entities of one segment, so their fuel rows stand alone, and
    its own prices for two regions come before the readings."""
    e = ent(spark, sf).where("segment <> 'MACHINERY'").withColumns({
        "postal": F.col("nation"), "regular": F.when(F.col("region") == "ASIA", 3.25),
        "diesel": F.when(F.col("region") == "EUROPE", 4.5)})
    fa = marts.freight_analysis(marts.staging(e, marts.SHIPPING_COLS), latest_fuel(spark, sf))
    return fa.withColumn("efficiency_score", round_half_up("efficiency_score", 6)).withColumn(
        "fuel_burden_index", round_half_up("fuel_burden_index", 6))


@query("k05_efficiency_mart_percent_rank_tier", with_(*BASE, _SHIP, _FA) + f"""
SELECT state, postal, rank, population, regular, mid_grade, premium, diesel,
  {rhu('fuel_burden_index', 6)} AS fuel_burden_index, {rhu('efficiency_score', 6)} AS efficiency_score,
  CASE WHEN efficiency_score IS NULL THEN NULL
       WHEN percent_rank() OVER (ORDER BY efficiency_score) >= 0.75 THEN 'Top Tier'
       WHEN percent_rank() OVER (ORDER BY efficiency_score) >= 0.50 THEN 'Mid Tier'
       WHEN percent_rank() OVER (ORDER BY efficiency_score) >= 0.25 THEN 'Low Tier'
       ELSE 'Bottom Tier' END AS efficiency_tier, pipeline_run_id
FROM fa""")
def k05_efficiency_mart_percent_rank_tier(spark, sf):
    """K5/W1 (fct_efficiency_analysis) with the distributed percent rank."""
    fa = marts.freight_analysis(shipping(spark, sf), latest_fuel(spark, sf))
    m = marts.efficiency_mart(fa)
    return m.withColumn("efficiency_score", round_half_up("efficiency_score", 6)).withColumn(
        "fuel_burden_index", round_half_up("fuel_burden_index", 6))


@query("w02_efficiency_percentile_tier", with_(*BASE, _SHIP, _FA) + f"""
SELECT state, {rhu('efficiency_score', 6)} AS efficiency_score, efficiency_percentile,
  CASE WHEN efficiency_percentile IS NULL THEN NULL WHEN efficiency_percentile >= 75 THEN 'Top Tier'
       WHEN efficiency_percentile >= 50 THEN 'Mid Tier' WHEN efficiency_percentile >= 25 THEN 'Low Tier'
       ELSE 'Bottom Tier' END AS efficiency_tier
FROM (SELECT state, efficiency_score,
  CASE WHEN efficiency_score IS NULL THEN NULL ELSE
  {rhu('(rank() OVER (ORDER BY efficiency_score) + (count(*) OVER (PARTITION BY efficiency_score) - 1) / 2.0) / (SELECT count(efficiency_score) FROM fa) * 100', 1)}
  END AS efficiency_percentile FROM fa)""")
def w02_efficiency_percentile_tier(spark, sf):
    """W2/P22 (notebook form): average-tie percentile x 100, 1 dp, and tier."""
    fa = marts.freight_analysis(shipping(spark, sf), latest_fuel(spark, sf))
    p = marts.efficiency_percentiles(fa.select("state", "efficiency_score"))
    return p.withColumn("efficiency_score", round_half_up("efficiency_score", 6))


@query("w07_population_ecdf", with_(ENTITIES) + """
SELECT state, population, row_number() OVER (ORDER BY population, state) / (SELECT count(*) FROM ent) * 100 AS ecdf_pct
FROM ent""")
def w07_population_ecdf(spark, sf):
    return marts.ecdf(plain(spark, sf).select("state", "population"), "population", "state")


@query("p25_daily_costs", with_(*BASE, _SHIP) + f"""
SELECT s.state, s.population, f.regular, f.mid_grade, f.premium, f.diesel, f.scraped_at,
  {rhu('s.population / 1000000.0 * f.diesel', 2)} AS estimated_daily_diesel_cost_millions,
  {rhu('s.population / 1000000.0 * f.regular', 2)} AS estimated_daily_gas_cost_millions, s.pipeline_run_id
FROM ship s LEFT JOIN fuel f ON s.state = f.state""")
def p25_daily_costs(spark, sf):
    """J5/P25 (fct_daily_costs)."""
    return marts.daily_costs(shipping(spark, sf), latest_fuel(spark, sf))


@query("f01_basic_features", with_(ENTITIES) + f"""
SELECT state, population, rank, {rsql(['population_per_rank'], 6)},
  {rhu('rank / population', 12)} AS rank_per_population, {rhu('population / (rank * 1000)', 6)} AS efficiency_score,
  {rhu('CASE WHEN population > 0 THEN ln(population) END', 9)} AS log_population,
  {rhu('CASE WHEN rank > 0 THEN ln(rank) END', 9)} AS log_rank FROM ent""")
def f01_basic_features(spark, sf):
    f = features.basic_features(ent(spark, sf).select("state", "population", "rank"))
    return f.select("state", "population", "rank", round_half_up("population_per_rank", 6).alias("population_per_rank"),
                    round_half_up("rank_per_population", 12).alias("rank_per_population"),
                    round_half_up("efficiency_score", 6).alias("efficiency_score"),
                    round_half_up("log_population", 9).alias("log_population"),
                    round_half_up("log_rank", 9).alias("log_rank"))


@query("f02_regional_features", with_(ENTITIES) + f"""
SELECT state, region, population,
  {rhu('avg(population) OVER (PARTITION BY region)', 4)} AS region_population_mean,
  {rhu('stddev_samp(population) OVER (PARTITION BY region)', 4)} AS region_population_std FROM ent""")
def f02_regional_features(spark, sf):
    """Region mean and std mapped back to every row."""
    f = features.regional_features(plain(spark, sf).select("state", "region", "population"))
    return f.select("state", "region", "population",
                    round_half_up("region_population_mean", 4).alias("region_population_mean"),
                    round_half_up("region_population_std", 4).alias("region_population_std"))


@query("f03_fuel_features", with_(*BASE) + f"""
SELECT e.state, e.population, f.regular, f.diesel,
  {rhu('e.population / f.diesel', 6)} AS fuel_efficiency,
  {rhu('f.diesel / e.population * 1000', 12)} AS fuel_cost_per_capita,
  {rhu('e.population / f.diesel * 100', 6)} AS fuel_affordability_index
FROM ent e LEFT JOIN fuel f ON e.state = f.state""")
def f03_fuel_features(spark, sf):
    """Fuel ratios after a left join of (regular, diesel)."""
    f = features.fuel_features(plain(spark, sf).select("state", "population"), latest_fuel(spark, sf))
    return f.select("state", "population", "regular", "diesel",
                    round_half_up("fuel_efficiency", 6).alias("fuel_efficiency"),
                    round_half_up("fuel_cost_per_capita", 12).alias("fuel_cost_per_capita"),
                    round_half_up("fuel_affordability_index", 6).alias("fuel_affordability_index"))


@query("f04_statistical_features", with_(ENTITIES) + f"""
SELECT state, population, rank,
  (rank() OVER (ORDER BY population) + (count(*) OVER (PARTITION BY population) - 1) / 2.0) / count(population) OVER () AS population_percentile,
  (rank() OVER (ORDER BY rank) + (count(*) OVER (PARTITION BY rank) - 1) / 2.0) / count(rank) OVER () AS rank_percentile,
  {rhu('(population - avg(population) OVER ()) / stddev_samp(population) OVER ()', 9)} AS population_zscore,
  {rhu('(rank - avg(rank) OVER ()) / stddev_samp(rank) OVER ()', 9)} AS rank_zscore
FROM ent""")
def f04_statistical_features(spark, sf):
    """Distributed percentile ranks and z-scores."""
    f = features.statistical_features(ent(spark, sf).select("state", "population", "rank"))
    return f.select("state", "population", "rank", "population_percentile", "rank_percentile",
                    round_half_up("population_zscore", 9).alias("population_zscore"),
                    round_half_up("rank_zscore", 9).alias("rank_zscore"))


@query("f05_composite_features", with_(ENTITIES) + f"""
SELECT state, population, rank,
  {rhu('population / rank * 0.5 + (population / 1000000) * 0.3 + (100 - rank) * 0.2', 6)} AS logistics_index,
  {rhu('ln(population) * 0.6 + (100 - rank) * 0.4', 9)} AS development_score FROM ent""")
def f05_composite_features(spark, sf):
    f = features.composite_features(ent(spark, sf).select("state", "population", "rank"))
    return f.select("state", "population", "rank", round_half_up("logistics_index", 6).alias("logistics_index"),
                    round_half_up("development_score", 9).alias("development_score"))


_F06 = [("population_per_rank", "population / rank", 6), ("rank_per_population", "rank / population", 12),
        ("efficiency_score", "population / (rank * 1000)", 6), ("log_population", "ln(population)", 9), ("log_rank", "ln(rank)", 9),
        ("region_population_mean", "avg(population) OVER (PARTITION BY region)", 4),
        ("region_population_std", "stddev_samp(population) OVER (PARTITION BY region)", 4),
        ("population_percentile", "(rank() OVER (ORDER BY population) + (count(*) OVER (PARTITION BY population) - 1) / 2.0)"
                                  " / count(population) OVER ()", 12),
        ("rank_percentile", "rank / CAST(count(rank) OVER () AS DOUBLE)", 12),
        ("population_zscore", "(population - avg(population) OVER ()) / stddev_samp(population) OVER ()", 9),
        ("rank_zscore", "(rank - avg(rank) OVER ()) / stddev_samp(rank) OVER ()", 9),
        ("logistics_index", "population / rank * 0.5 + (population / 1000000) * 0.3 + (100 - rank) * 0.2", 6),
        ("development_score", "ln(population) * 0.6 + (100 - rank) * 0.4", 9),
        ("fuel_efficiency", "population / nullif(diesel, 0)", 6),
        ("fuel_cost_per_capita", "diesel / nullif(population, 0) * 1000", 12),
        ("fuel_affordability_index", "population / nullif(diesel, 0) * 100", 6)]


@query("f06_all_features", with_(*BASE) + "SELECT state, region, population, rank, regular, diesel, "
       + ", ".join(f"{rhu(sql, d)} AS {name}" for name, sql, d in _F06)
       + " FROM (SELECT e.*, f.regular, f.diesel FROM ent e LEFT JOIN fuel f ON e.state = f.state)")
def f06_all_features(spark, sf):
    """every feature of the chained table (basic -> regional ->
    statistical -> composite -> fuel), one row per entity."""
    f = features.all_features(ent(spark, sf).select("state", "region", "population", "rank"), latest_fuel(spark, sf))
    return f.select("state", "region", "population", "rank", "regular", "diesel",
                    *[round_half_up(name, d).alias(name) for name, _, d in _F06])


@query("k01_fuel_cost_index", with_(SNAPS, LATEST_FUEL) + f"""
SELECT state, diesel, {rhu('diesel / (SELECT avg(diesel) FROM fuel)', 9)} AS fuel_cost_index FROM fuel""")
def k01_fuel_cost_index(spark, sf):
    """Diesel against the global mean (scalar subquery)."""
    k = kpis.fuel_cost_index(latest_fuel(spark, sf).select("state", "diesel"))
    return k.withColumn("fuel_cost_index", round_half_up("fuel_cost_index", 9))


_KSEL = f"""kin AS (SELECT e.state, e.population, f.diesel FROM ent e JOIN fuel f ON e.state = f.state)"""


@query("k02_k04_demand_and_cost_efficiency", with_(*BASE, _KSEL) + f"""
SELECT state, population, diesel, {rhu('population * (population / 1000.0)', 2)} AS logistics_demand_score,
  {rhu('population * (population / 1000.0) / nullif(diesel, 0)', 2)} AS cost_efficiency_index FROM kin""")
def k02_k04_demand_and_cost_efficiency(spark, sf):
    """K2/K4: demand = population x density; cost efficiency = demand / diesel."""
    k = kpis.cost_efficiency(kpis.logistics_demand(
        plain(spark, sf).select("state", "population").join(latest_fuel(spark, sf).select("state", "diesel"), "state")))
    return k.select("state", "population", "diesel",
                    round_half_up("logistics_demand_score", 2).alias("logistics_demand_score"),
                    round_half_up("cost_efficiency_index", 2).alias("cost_efficiency_index"))


@query("k03_freight_opportunity", with_(*BASE, _KSEL, """mm AS (SELECT min(population) AS plo, max(population) AS phi,
  min(population / 1000.0) AS dlo, max(population / 1000.0) AS dhi, min(diesel) AS flo, max(diesel) AS fhi FROM kin)""") + f"""
SELECT state, population, diesel, {rhu('''(0.4 * CASE WHEN phi > plo THEN (population - plo) / (phi - plo) ELSE population / phi END
  + 0.3 * CASE WHEN dhi > dlo THEN (population / 1000.0 - dlo) / (dhi - dlo) ELSE (population / 1000.0) / dhi END
  + 0.3 * CASE WHEN fhi > flo THEN (fhi - diesel) / (fhi - flo) ELSE (fhi - diesel) / fhi END) * 100''', 6)} AS freight_opportunity_score
FROM kin, mm""")
def k03_freight_opportunity(spark, sf):
    """Weighted min-max scores (constant column falls back to x / max)."""
    k = kpis.freight_opportunity(
        plain(spark, sf).select("state", "population").join(latest_fuel(spark, sf).select("state", "diesel"), "state"))
    return k.withColumn("freight_opportunity_score", round_half_up("freight_opportunity_score", 6))


@query("p18_dim_state", with_(ENTITIES) + f"""
SELECT state, postal, rank, population, {_REGION('postal', False)} ELSE 'Unknown' END AS region
FROM (SELECT *, {_CODE} AS postal FROM ent)""")
def p18_dim_state(spark, sf):
    """P18 (dim_state): region CASE over the state code; DC and codes that are
    no state are 'Unknown'."""
    d = marts.dim_state(marts.staging(coded(ent(spark, sf)), marts.SHIPPING_COLS))
    return d.drop("loaded_at")


@query("p17_region_of_entities", with_(ENTITIES) + f"""
SELECT state, postal, {_REGION('postal', True)} ELSE 'Other' END AS region
FROM (SELECT state, {_CODE} AS postal FROM ent0)""")
def p17_region_of_entities(spark, sf):
    """Region of each entity's state code by the state dimension; DC is in
    the South, codes that are no state are 'Other'."""
    return features.assign_region(coded(plain(spark, sf)).select("state", "postal"))
