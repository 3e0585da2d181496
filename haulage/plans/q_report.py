"""Report and dashboard queries.

They read the entity table enriched with the latest fuel readings; every
global statistic is an aggregate or a scalar subquery, every top-k an
explicit sort with a tie key and a limit.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from haulage.functions import round_half_up
from haulage.operators import kpis, marts
from haulage.operators.ranking import quantile_scalars
from haulage.operators.selection import quantile_rows
from haulage.session import materialize
from haulage.plans.catalog import query
from haulage.plans.q_entities import _FA, _SHIP, ent, latest_fuel, plain, shipping
from haulage.plans.sqlparts import ENTITIES, LATEST_FUEL, SNAPS, rhu, with_

BASE = [ENTITIES, SNAPS, LATEST_FUEL]


def enriched(spark, sf, rank=False):
    """Entities that have fuel readings: state, region, population, four
    prices, and the rank if asked for."""
    e = ent(spark, sf).select("state", "region", "population", "rank") if rank else plain(spark, sf).select(
        "state", "region", "population")
    return e.join(
        latest_fuel(spark, sf).select("state", "regular", "mid_grade", "premium", "diesel"), "state")


_ENR = """enr AS (SELECT e.state, e.region, e.population, e.rank, f.regular, f.mid_grade, f.premium, f.diesel
  FROM ent e JOIN fuel f ON e.state = f.state)"""


@query("a28_fuel_price_summary", with_(SNAPS, LATEST_FUEL) + " UNION ALL ".join(
    f"SELECT '{c}' AS fuel_type, {rhu(f'avg({c})', 9)} AS mean_price, min({c}) AS min_price, max({c}) AS max_price, "
    f"{rhu(f'max({c}) - min({c})', 9)} AS price_range FROM fuel" for c in ("regular", "mid_grade", "premium", "diesel")))
def a28_fuel_price_summary(spark, sf):
    """Mean, min, max and range of each price."""
    long = latest_fuel(spark, sf).unpivot("state", ["regular", "mid_grade", "premium", "diesel"], "fuel_type", "p")
    return long.groupBy("fuel_type").agg(
        round_half_up(F.avg("p"), 9).alias("mean_price"), F.min("p").alias("min_price"), F.max("p").alias("max_price"),
        round_half_up(F.max("p") - F.min("p"), 9).alias("price_range"))


@query("a29_region_means", with_(*BASE, _ENR) + f"""
SELECT region, COUNT(*) AS states, {rhu('avg(diesel)', 9)} AS mean_diesel, {rhu('avg(population)', 4)} AS mean_population,
  {rhu('avg(premium - regular)', 9)} AS mean_spread, {rhu('avg(population / (diesel * 100))', 6)} AS mean_efficiency
FROM enr GROUP BY region""")
def a29_region_means(spark, sf):
    """Group size and per-region means of price, population,
    spread and efficiency score."""
    e = marts_spread(enriched(spark, sf))
    return e.groupBy("region").agg(
        F.count(F.lit(1)).alias("states"), round_half_up(F.avg("diesel"), 9).alias("mean_diesel"),
        round_half_up(F.avg("population"), 4).alias("mean_population"),
        round_half_up(F.avg("price_spread"), 9).alias("mean_spread"),
        round_half_up(F.avg("efficiency_score"), 6).alias("mean_efficiency"))


def marts_spread(df):
    return df.withColumns({"price_spread": F.col("premium") - F.col("regular"),
                           "efficiency_score": F.try_divide(F.col("population"), F.col("diesel") * 100)})


@query("a30_fuel_index_by_region", with_(*BASE, _ENR, f"""ix AS (SELECT region, state, diesel / (SELECT avg(diesel) FROM enr) AS idx FROM enr),
  rs AS (SELECT region, {rhu('avg(idx)', 3)} AS mean_idx, {rhu('stddev_samp(idx)', 3)} AS std_idx,
    {rhu('min(idx)', 3)} AS min_idx, {rhu('max(idx)', 3)} AS max_idx, avg(idx) AS raw_mean FROM ix GROUP BY region)""") + """
SELECT region, mean_idx, std_idx, min_idx, max_idx,
  (SELECT region FROM rs ORDER BY raw_mean DESC, region LIMIT 1) AS highest_region,
  (SELECT region FROM rs ORDER BY raw_mean ASC, region LIMIT 1) AS lowest_region FROM rs""")
def a30_fuel_index_by_region(spark, sf):
    """Fuel cost index per region (3 dp) with the arg-max and
    arg-min region (ties by name)."""
    ix = kpis.fuel_cost_index(enriched(spark, sf), out="idx")
    rs = ix.groupBy("region").agg(
        round_half_up(F.avg("idx"), 3).alias("mean_idx"), round_half_up(F.stddev_samp("idx"), 3).alias("std_idx"),
        round_half_up(F.min("idx"), 3).alias("min_idx"), round_half_up(F.max("idx"), 3).alias("max_idx"),
        F.avg("idx").alias("raw_mean"))
    hi = rs.orderBy(F.desc("raw_mean"), "region").limit(1).select("region").scalar()
    lo = rs.orderBy(F.asc("raw_mean"), "region").limit(1).select("region").scalar()
    return rs.select("region", "mean_idx", "std_idx", "min_idx", "max_idx",
                     hi.alias("highest_region"), lo.alias("lowest_region"))


_EFFP = with_(*BASE, _SHIP, _FA) + f"""SELECT efficiency_tier, COUNT(*) AS states FROM (SELECT
  CASE WHEN p IS NULL THEN NULL WHEN p >= 75 THEN 'Top Tier' WHEN p >= 50 THEN 'Mid Tier' WHEN p >= 25 THEN 'Low Tier'
       ELSE 'Bottom Tier' END AS efficiency_tier FROM (SELECT CASE WHEN efficiency_score IS NULL THEN NULL ELSE
  {rhu('(rank() OVER (ORDER BY efficiency_score) + (count(*) OVER (PARTITION BY efficiency_score) - 1) / 2.0) / (SELECT count(efficiency_score) FROM fa) * 100', 1)}
  END AS p FROM fa)) GROUP BY efficiency_tier"""


@query("a31_tier_frequency", _EFFP)
def a31_tier_frequency(spark, sf):
    """Number of entities per efficiency tier (null tier counted)."""
    fa = marts.freight_analysis(shipping(spark, sf), latest_fuel(spark, sf))
    p = marts.efficiency_percentiles(fa.select("state", "efficiency_score"))
    return p.groupBy("efficiency_tier").agg(F.count(F.lit(1)).alias("states"))


_PAIRS32 = [("population", "diesel"), ("population", "regular"), ("regular", "diesel"), ("rank", "diesel")]


@query("a32_correlation_direction", with_(*BASE, _ENR) + " UNION ALL ".join(
    f"SELECT '{a}' AS var1, '{b}' AS var2, {rhu(f'corr({a}, {b})', 9)} AS correlation, "
    f"CASE WHEN abs(corr({a}, {b})) < 0.3 THEN 'none' WHEN corr({a}, {b}) > 0 THEN 'up' ELSE 'down' END AS direction FROM enr"
    for a, b in _PAIRS32))
def a32_correlation_direction(spark, sf):
    """Pairwise correlation with a sign class (|r| < 0.3 none)."""
    e = enriched(spark, sf, rank=True)
    one = e.agg(*[F.corr(a, b).alias(f"{a}~{b}") for a, b in _PAIRS32])
    long = one.unpivot([], [f"{a}~{b}" for a, b in _PAIRS32], "pair", "r")
    return long.select(F.split("pair", "~")[0].alias("var1"), F.split("pair", "~")[1].alias("var2"),
                       round_half_up("r", 9).alias("correlation"),
                       F.when(F.abs("r") < 0.3, "none").when(F.col("r") > 0, "up").otherwise("down").alias("direction"))


@query("a33_cost_optimisation", with_(*BASE, _ENR) + f"""
SELECT {rhu('SUM(population * diesel)', 2)} AS actual_cost, {rhu('SUM(population) * avg(diesel)', 2)} AS cost_at_mean_price,
  {rhu('SUM(population * diesel) - SUM(population) * avg(diesel)', 2)} AS excess_cost FROM enr""")
def a33_cost_optimisation(spark, sf):
    """Cost at local prices against cost at the mean price (one aggregate)."""
    e = enriched(spark, sf)
    actual = F.sum(F.col("population") * F.col("diesel"))
    at_mean = F.sum("population") * F.avg("diesel")
    return e.agg(round_half_up(actual, 2).alias("actual_cost"), round_half_up(at_mean, 2).alias("cost_at_mean_price"),
                 round_half_up(actual - at_mean, 2).alias("excess_cost"))


def _opportunity(spark, sf):
    # stored once: the extremes and the scores read the joined rows
    return kpis.freight_opportunity(materialize(enriched(spark, sf)))


_OPP = f"""mm AS (SELECT min(population) AS plo, max(population) AS phi, min(population / 1000.0) AS dlo,
  max(population / 1000.0) AS dhi, min(diesel) AS flo, max(diesel) AS fhi FROM enr),
opp AS (SELECT state, region, diesel, (0.4 * CASE WHEN phi > plo THEN (population - plo) / (phi - plo) ELSE population / phi END
  + 0.3 * CASE WHEN dhi > dlo THEN (population / 1000.0 - dlo) / (dhi - dlo) ELSE (population / 1000.0) / dhi END
  + 0.3 * CASE WHEN fhi > flo THEN (fhi - diesel) / (fhi - flo) ELSE (fhi - diesel) / fhi END) * 100 AS score FROM enr, mm)"""


@query("a34_opportunity_segments", with_(*BASE, _ENR, _OPP, """q AS (SELECT quantile_cont(score, 0.25) AS q25,
  quantile_cont(score, 0.5) AS q50, quantile_cont(score, 0.75) AS q75 FROM opp)""") + f"""
SELECT segment, COUNT(*) AS states, {rhu('avg(score)', 6)} AS mean_score FROM (
  SELECT CASE WHEN score > q75 THEN 'High' WHEN score > q50 AND score <= q75 THEN 'Mid'
              WHEN score < q25 THEN 'Low' END AS segment, score FROM opp, q)
WHERE segment IS NOT NULL GROUP BY segment""")
def a34_opportunity_segments(spark, sf):
    """Segments by quartile of the opportunity score (> q75 High,
    (q50, q75] Mid, < q25 Low): count and mean per segment."""
    o = materialize(_opportunity(spark, sf).select("freight_opportunity_score"))
    q = quantile_scalars(o, "freight_opportunity_score", {"q25": 0.25, "q50": 0.5, "q75": 0.75})
    s = F.col("freight_opportunity_score")
    seg = F.when(s > q["q75"], "High").when((s > q["q50"]) & (s <= q["q75"]), "Mid").when(s < q["q25"], "Low")
    return (o.withColumn("segment", seg).where(F.col("segment").isNotNull())
            .groupBy("segment").agg(F.count(F.lit(1)).alias("states"), round_half_up(F.avg(s), 6).alias("mean_score")))


@query("a35_premium_and_advantage_states", with_(*BASE, _ENR, """ix AS (SELECT diesel, diesel / (SELECT avg(diesel) FROM enr) AS idx FROM enr)""") + f"""
SELECT COUNT(*) FILTER (WHERE idx > 1.15) AS premium_states, {rhu('avg(CASE WHEN idx > 1.15 THEN diesel END)', 9)} AS premium_mean_diesel,
  COUNT(*) FILTER (WHERE idx < 0.90) AS advantage_states, {rhu('avg(CASE WHEN idx < 0.90 THEN diesel END)', 9)} AS advantage_mean_diesel FROM ix""")
def a35_premium_and_advantage_states(spark, sf):
    """Fuel index > 1.15 (premium) and < 0.90 (advantage)."""
    ix = kpis.fuel_cost_index(enriched(spark, sf), out="idx")
    return ix.agg(F.count_if(F.col("idx") > 1.15).alias("premium_states"),
                  round_half_up(F.avg(F.when(F.col("idx") > 1.15, F.col("diesel"))), 9).alias("premium_mean_diesel"),
                  F.count_if(F.col("idx") < 0.90).alias("advantage_states"),
                  round_half_up(F.avg(F.when(F.col("idx") < 0.90, F.col("diesel"))), 9).alias("advantage_mean_diesel"))


@query("a36_percentile_breakdown", with_(*BASE, _ENR, _OPP) + " UNION ALL ".join(
    f"SELECT {p} AS percentile, {rhu(f'quantile_cont(score, {p / 100})', 6)} AS score FROM opp" for p in (25, 50, 75, 90)))
def a36_percentile_breakdown(spark, sf):
    """25/50/75/90th percentiles of the opportunity score (exact,
    distributed)."""
    score = "freight_opportunity_score"
    q = quantile_rows(_opportunity(spark, sf), [score], {f"p{p}": p / 100 for p in (25, 50, 75, 90)})
    long = q.unpivot([], [f"p{p}" for p in (25, 50, 75, 90)], "pname", "score")
    return long.select(F.substring("pname", 2, 2).cast("int").alias("percentile"), round_half_up("score", 6).alias("score"))


@query("a46_region_overview", with_(*BASE, _ENR) + f"""
SELECT region, COUNT(*) AS states, {rhu('avg(diesel)', 9)} AS mean_diesel FROM enr GROUP BY region""")
def a46_region_overview(spark, sf):
    return enriched(spark, sf).groupBy("region").agg(F.count(F.lit(1)).alias("states"),
                                                    round_half_up(F.avg("diesel"), 9).alias("mean_diesel"))


@query("t03_top10_regular", with_(SNAPS, LATEST_FUEL) + "SELECT state, regular FROM fuel ORDER BY regular DESC, state LIMIT 10")
def t03_top10_regular(spark, sf):
    """T3/T7 nlargest(10) with a tie key."""
    return latest_fuel(spark, sf).select("state", "regular").orderBy(F.desc("regular"), "state").limit(10)


@query("t03_bottom10_regular", with_(SNAPS, LATEST_FUEL) + "SELECT state, regular FROM fuel WHERE regular IS NOT NULL ORDER BY regular ASC, state LIMIT 10")
def t03_bottom10_regular(spark, sf):
    """T3 nsmallest(10) (nulls excluded, as pandas)."""
    return (latest_fuel(spark, sf).select("state", "regular").where(F.col("regular").isNotNull())
            .orderBy(F.asc("regular"), "state").limit(10))


@query("t03_top10_fuel_burden", with_(*BASE, _SHIP, _FA) + f"""
SELECT state, population, diesel, {rhu('fuel_burden_index', 6)} AS fuel_burden_index FROM fa
WHERE fuel_burden_index IS NOT NULL ORDER BY fuel_burden_index DESC, state LIMIT 10""")
def t03_top10_fuel_burden(spark, sf):
    """Ten highest fuel burden indices."""
    fa = marts.freight_analysis(shipping(spark, sf), latest_fuel(spark, sf))
    return (fa.where(F.col("fuel_burden_index").isNotNull())
            .orderBy(F.desc("fuel_burden_index"), "state").limit(10)
            .select("state", "population", "diesel", round_half_up("fuel_burden_index", 6).alias("fuel_burden_index")))


@query("t04_extreme_states", with_(SNAPS, LATEST_FUEL) + """
SELECT (SELECT state FROM fuel WHERE regular IS NOT NULL ORDER BY regular DESC, state LIMIT 1) AS most_expensive,
  (SELECT max(regular) FROM fuel) AS max_regular,
  (SELECT state FROM fuel WHERE regular IS NOT NULL ORDER BY regular ASC, state LIMIT 1) AS cheapest,
  (SELECT min(regular) FROM fuel) AS min_regular""")
def t04_extreme_states(spark, sf):
    """T4: idxmax / idxmin with max_by / min_by and a tie key."""
    f = latest_fuel(spark, sf).where(F.col("regular").isNotNull())
    return f.agg(F.min_by("state", F.struct(-F.col("regular"), F.col("state"))).alias("most_expensive"),
                 F.max("regular").alias("max_regular"),
                 F.min_by("state", F.struct(F.col("regular"), F.col("state"))).alias("cheapest"),
                 F.min("regular").alias("min_regular"))


@query("t01_sorted_by_population", with_(ENTITIES) + "SELECT state, population, rank FROM ent ORDER BY population DESC, state")
def t01_sorted_by_population(spark, sf):
    """Full sort by population desc (range-partitioned sort)."""
    return ent(spark, sf).select("state", "population", "rank").orderBy(F.desc("population"), "state")
