"""KPI group queries on the entity table."""

from __future__ import annotations

from pyspark.sql import functions as F

from haulage.operators import kpis
from haulage.plans.catalog import ORACLE, query
from haulage.plans.q_entities import ent, latest_fuel, plain
from haulage.plans.sqlparts import ENTITIES, LATEST_FUEL, SNAPS, rhu, with_
from haulage.session import materialize


def ms(c: str) -> str:
    return f"CAST(SUM(CAST({c} AS DECIMAL(30,2))) AS DOUBLE)"


G_BASIC = f"""g_basic AS (SELECT COUNT(*) AS total_states, {ms('population')} AS total_population,
  {rhu(ms('population') + ' / COUNT(population)', 4)} AS avg_population,
  {rhu('stddev_samp(population)', 4)} AS population_std, {rhu('avg(rank)', 6)} AS avg_rank,
  {rhu('stddev_samp(rank)', 6)} AS rank_std,
  {rhu('quantile_cont(population, 0.5)', 4)} AS median_population,
  {rhu('quantile_cont(rank, 0.5)', 4)} AS median_rank FROM ent HAVING COUNT(*) > 0)"""

G_EFF = f"""g_efficiency AS (SELECT {rhu('max(ppr)', 4)} AS max_efficiency, {rhu('min(ppr)', 4)} AS min_efficiency,
  {rhu('avg(ppr)', 4)} AS avg_efficiency, {rhu('avg(ppr)', 4)} AS avg_efficiency_score,
  {rhu('stddev_samp(ppr)', 4)} AS efficiency_std,
  {rhu('min(rpm)', 6)} AS best_rank_per_million, {rhu('max(rpm)', 6)} AS worst_rank_per_million
  FROM (SELECT population / rank AS ppr, rank / (population / 1000000.0) AS rpm FROM ent))"""

G_DIST = f"""g_distribution AS (SELECT {rhu('p90', 4)} AS population_90th_percentile, {rhu('p10', 4)} AS population_10th_percentile,
  {rhu('p90 / nullif(p10, 0)', 6)} AS population_ratio_90_10, {rhu('r90', 4)} AS rank_90th_percentile,
  {rhu('r10', 4)} AS rank_10th_percentile, {rhu('r90 / nullif(r10, 0)', 6)} AS rank_ratio_90_10,
  {rhu('top / nullif(tot, 0) * 100', 6)} AS top_10_percent_population_share
  FROM (SELECT quantile_cont(population, 0.9) AS p90, quantile_cont(population, 0.1) AS p10,
          quantile_cont(rank, 0.9) AS r90, quantile_cont(rank, 0.1) AS r10, {ms('population')} AS tot,
          CAST(SUM(CASE WHEN population >= (SELECT quantile_cont(population, 0.9) FROM ent)
                        THEN CAST(population AS DECIMAL(30,2)) END) AS DOUBLE) AS top FROM ent))"""


def ms6(c: str) -> str:
    return f"CAST(SUM(CAST({c} AS DECIMAL(30,6))) AS DOUBLE)"


def _fuel_cols(c):
    return (f"{rhu(ms6(c) + f' / COUNT({c})', 6)} AS avg_{c}_price, {rhu(f'quantile_cont({c}, 0.5)', 6)} AS median_{c}_price, "
            f"{rhu(f'stddev_samp({c})', 6)} AS {c}_price_std, {rhu(f'max({c}) - min({c})', 6)} AS {c}_price_range, "
            f"{rhu(f'stddev_samp({c}) / (' + ms6(c) + f' / COUNT({c}))', 6)} AS price_volatility_{c}")


G_FUEL = f"g_fuel AS (SELECT {_fuel_cols('regular')}, {_fuel_cols('diesel')} FROM fuel)"

G_COMP = f"""cs AS (SELECT state,
  ((population / (SELECT max(population) FROM ent)) * 0.4 + (1 - rank / (SELECT max(rank) FROM ent)) * 0.6) * 100 AS lpi,
  ((CASE WHEN population > 0 THEN ln(population) END) / ln((SELECT max(population) FROM ent)) * 0.5
    + (1 - rank / (SELECT max(rank) FROM ent)) * 0.5) * 100 AS dev FROM ent),
g_composite AS (SELECT (SELECT state FROM cs ORDER BY lpi DESC, state LIMIT 1) AS top_logistics_performer,
  {rhu('max(lpi)', 6)} AS top_logistics_score,
  (SELECT state FROM cs ORDER BY lpi ASC, state LIMIT 1) AS bottom_logistics_performer,
  {rhu('min(lpi)', 6)} AS bottom_logistics_score,
  (SELECT state FROM cs ORDER BY dev DESC, state LIMIT 1) AS top_developer,
  {rhu('max(dev)', 6)} AS top_development_score,
  (SELECT state FROM cs ORDER BY dev ASC, state LIMIT 1) AS bottom_developer,
  {rhu('min(dev)', 6)} AS bottom_development_score FROM cs)"""

G_QUAL = f"""qe AS (SELECT state, region, population, rank FROM ent),
fence AS (SELECT quantile_cont(population, 0.25) AS pq1, quantile_cont(population, 0.75) AS pq3,
  quantile_cont(rank, 0.25) AS rq1, quantile_cont(rank, 0.75) AS rq3 FROM qe),
g_quality AS (SELECT {rhu('(1.0 - (COUNT(*) FILTER (WHERE state IS NULL) + COUNT(*) FILTER (WHERE region IS NULL) + COUNT(*) FILTER (WHERE population IS NULL) + COUNT(*) FILTER (WHERE rank IS NULL)) / (COUNT(*) * 4)) * 100', 6)} AS data_completeness,
  COUNT(*) - COUNT(DISTINCT state) AS duplicate_states, COUNT(DISTINCT state) AS unique_states,
  COUNT(*) FILTER (WHERE population < pq1 - 1.5 * (pq3 - pq1) OR population > pq3 + 1.5 * (pq3 - pq1)) AS population_outliers,
  COUNT(*) FILTER (WHERE rank < rq1 - 1.5 * (rq3 - rq1) OR rank > rq3 + 1.5 * (rq3 - rq1)) AS rank_outliers,
  greatest(100 - CASE WHEN min(population) < 0 THEN 20 ELSE 0 END - CASE WHEN min(rank) < 1 THEN 20 ELSE 0 END
    - CASE WHEN COUNT(*) - COUNT(DISTINCT state) > 0 THEN 10 ELSE 0 END, 0) AS data_consistency_score
  FROM qe, fence)"""

GROUP_COLS = {
    "basic": ["total_states", "total_population", "avg_population", "population_std", "avg_rank", "rank_std",
              "median_population", "median_rank"],
    "efficiency": ["max_efficiency", "min_efficiency", "avg_efficiency", "avg_efficiency_score", "efficiency_std",
                   "best_rank_per_million", "worst_rank_per_million"],
    "distribution": ["population_90th_percentile", "population_10th_percentile", "population_ratio_90_10",
                     "rank_90th_percentile", "rank_10th_percentile", "rank_ratio_90_10",
                     "top_10_percent_population_share"],
    "fuel": ["avg_regular_price", "median_regular_price", "regular_price_std", "regular_price_range",
             "price_volatility_regular", "avg_diesel_price", "median_diesel_price", "diesel_price_std",
             "diesel_price_range", "price_volatility_diesel"],
    "composite": ["top_logistics_performer", "top_logistics_score", "bottom_logistics_performer",
                  "bottom_logistics_score", "top_developer", "top_development_score", "bottom_developer",
                  "bottom_development_score"],
    "quality": ["data_completeness", "duplicate_states", "unique_states", "population_outliers",
                "rank_outliers", "data_consistency_score"],
}

ALL_GROUPS = [ENTITIES, SNAPS, LATEST_FUEL, G_BASIC, G_EFF, G_DIST, G_FUEL, G_COMP, G_QUAL]


def _groups(spark, sf, e):
    """One-row KPI groups of the stored entities ``e``."""
    return {
        "basic": kpis.basic_kpis(e),
        "efficiency": kpis.efficiency_kpis(e),
        "distribution": kpis.distribution_kpis(e),
        "fuel": kpis.fuel_kpis(latest_fuel(spark, sf)),
        "composite": kpis.composite_kpis(e),
        "quality": kpis.quality_kpis(e.select("state", "region", "population", "rank")),
    }


@query("a10_basic_kpis", with_(ENTITIES, G_BASIC) + "SELECT * FROM g_basic")
def a10_basic_kpis(spark, sf):
    return kpis.basic_kpis(ent(spark, sf))


@query("a11_efficiency_kpis", with_(ENTITIES, G_EFF) + "SELECT * FROM g_efficiency")
def a11_efficiency_kpis(spark, sf):
    return kpis.efficiency_kpis(ent(spark, sf))


@query("a12_distribution_kpis", with_(ENTITIES, G_DIST) + "SELECT * FROM g_distribution")
def a12_distribution_kpis(spark, sf):
    return kpis.distribution_kpis(ent(spark, sf))


@query("a13_fuel_kpis", with_(SNAPS, LATEST_FUEL, G_FUEL) + "SELECT * FROM g_fuel")
def a13_fuel_kpis(spark, sf):
    return kpis.fuel_kpis(latest_fuel(spark, sf))


@query("a14_regional_kpis", with_(ENTITIES) + f"""
SELECT region, COUNT(*) AS state_count, {ms('population')} AS total_population,
  {rhu(ms('population') + ' / COUNT(population)', 4)} AS avg_population, {rhu('avg(rank)', 6)} AS avg_rank,
  {rhu(ms('population') + ' / (SELECT ' + ms('population') + ' FROM ent) * 100', 6)} AS population_share,
  arg_min(state, rank) AS best_state_rank, min(rank) AS best_rank_value
FROM ent GROUP BY region""")
def a14_regional_kpis(spark, sf):
    return kpis.regional_kpis(ent(spark, sf))


@query("a15_composite_kpis", with_(ENTITIES, G_COMP) + "SELECT * FROM g_composite")
def a15_composite_kpis(spark, sf):
    return kpis.composite_kpis(ent(spark, sf))


@query("a16_quality_kpis", with_(ENTITIES, G_QUAL) + "SELECT * FROM g_quality")
def a16_quality_kpis(spark, sf):
    return kpis.quality_kpis(ent(spark, sf).select("state", "region", "population", "rank"))


_REG = ORACLE["a14_regional_kpis"].split("SELECT region, COUNT(*) AS state_count", 1)[1]
G_REG = "g_regional AS (SELECT region, COUNT(*) AS state_count" + _REG + ")"
REG_COLS = ["state_count", "total_population", "avg_population", "avg_rank", "population_share", "best_state_rank", "best_rank_value"]

_LONG = " UNION ALL ".join(
    f"SELECT '{g}' AS category, '{c}' AS metric, CAST({c} AS DOUBLE) AS value FROM g_{g}"
    for g, cols in GROUP_COLS.items() for c in cols)
_LONG_REG = " UNION ALL ".join(f"SELECT 'regional' AS category, region || '.{c}' AS metric, CAST({c} AS DOUBLE) AS value FROM g_regional"
                               for c in REG_COLS)


@query("a17_all_kpis_long", with_(*ALL_GROUPS, G_REG) + _LONG + " UNION ALL " + _LONG_REG)
def a17_all_kpis_long(spark, sf):
    """Every KPI group as (category, metric, value) rows, the regional
    group with one set of metrics per region."""
    e = materialize(ent(spark, sf))
    return kpis.all_kpis(_groups(spark, sf, e), kpis.regional_kpis(e))


@query("a17_kpi_count_by_category", with_(*ALL_GROUPS, G_REG) + f"""
SELECT category, COUNT(DISTINCT split_part(metric, '.', 1)) AS kpis FROM ({_LONG} UNION ALL {_LONG_REG}) GROUP BY category""")
def a17_kpi_count_by_category(spark, sf):
    """Names per category; a region counts once, as one entry of the
    regional group."""
    e = materialize(ent(spark, sf))
    long = kpis.all_kpis(_groups(spark, sf, e), kpis.regional_kpis(e))
    return long.groupBy("category").agg(F.countDistinct(F.split_part("metric", F.lit("."), F.lit(1))).alias("kpis"))


@query("a20_population_outliers", with_(ENTITIES, """f AS (SELECT quantile_cont(population, 0.25) AS q1,
  quantile_cont(population, 0.75) AS q3 FROM ent)""") + """
SELECT state, population FROM ent, f WHERE population < q1 - 1.5 * (q3 - q1) OR population > q3 + 1.5 * (q3 - q1)""")
def a20_population_outliers(spark, sf):
    """Rows outside the 1.5 x IQR fences (exact distributed quartiles)."""
    return kpis.outliers_iqr(plain(spark, sf).select("state", "population"), "population")
