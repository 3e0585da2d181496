"""KPI tables and scores.

KPI groups are one-row aggregates (``agg``) so the whole table is reduced
with partial aggregation; a global statistic used per row (mean, max, min)
is a scalar subquery, evaluated once and inlined as a value. Exact
percentiles (linear interpolation, as pandas ``quantile``) are selected by
histogram refinement (``selection``).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulage.functions import exact, log_positive, money_sum, round_half_up, safe_div
from haulage.operators.ranking import column_quantiles


def r(c: Column, d: int = 6) -> Column:
    return round_half_up(c, d)


def basic_kpis(df: DataFrame, value: str = "population", rank: str = "rank") -> DataFrame:
    """A10: count, sum, mean, median, sample std of population and rank.
    An empty input gives an empty result (no row)."""
    q = column_quantiles(df, {value: {"m": 0.5}, rank: {"m": 0.5}})
    med_v, med_r = q[value]["m"], q[rank]["m"]
    out = df.agg(
        F.count(F.lit(1)).alias("total_states"),
        money_sum(value).alias("total_population"),
        r(money_sum(value) / F.count(value), 4).alias("avg_population"),
        r(F.stddev_samp(value), 4).alias("population_std"),
        r(F.avg(rank), 6).alias("avg_rank"),
        r(F.stddev_samp(rank), 6).alias("rank_std"))
    return (out.where(F.col("total_states") > 0)
            .withColumns({"median_population": r(med_v, 4), "median_rank": r(med_r, 4)}))


def efficiency_kpis(df: DataFrame, value: str = "population", rank: str = "rank") -> DataFrame:
    """Population per rank and rank per million population stats."""
    ppr = F.col(value) / F.col(rank)
    rpm = F.col(rank) / (F.col(value) / 1e6)
    d = df.select(ppr.alias("_ppr"), rpm.alias("_rpm"))
    return d.agg(r(F.max("_ppr"), 4).alias("max_efficiency"), r(F.min("_ppr"), 4).alias("min_efficiency"),
                 r(F.avg("_ppr"), 4).alias("avg_efficiency"), r(F.avg("_ppr"), 4).alias("avg_efficiency_score"),
                 r(F.stddev_samp("_ppr"), 4).alias("efficiency_std"),
                 r(F.min("_rpm"), 6).alias("best_rank_per_million"),
                 r(F.max("_rpm"), 6).alias("worst_rank_per_million"))


def distribution_kpis(df: DataFrame, value: str = "population", rank: str = "rank") -> DataFrame:
    """P90/P10 of population and rank, their ratios, and the share of
    population held by rows at or above P90 (threshold as scalar subquery)."""
    q = column_quantiles(df, {value: {"p90": 0.9, "p10": 0.1}, rank: {"r90": 0.9, "r10": 0.1}})
    pq, rq = q[value], q[rank]
    stats = (df.agg(money_sum(value).alias("_tot"),
                    F.sum(F.when(F.col(value) >= pq["p90"], exact(value)))
                    .cast("double").alias("_top"))
             .withColumns({"p90": pq["p90"], "p10": pq["p10"], "r90": rq["r90"], "r10": rq["r10"]}))
    return stats.select(
        r(F.col("p90"), 4).alias("population_90th_percentile"),
        r(F.col("p10"), 4).alias("population_10th_percentile"),
        r(safe_div("p90", "p10"), 6).alias("population_ratio_90_10"),
        r(F.col("r90"), 4).alias("rank_90th_percentile"),
        r(F.col("r10"), 4).alias("rank_10th_percentile"),
        r(safe_div("r90", "r10"), 6).alias("rank_ratio_90_10"),
        r(safe_div("_top", "_tot") * 100, 6).alias("top_10_percent_population_share"))


def fuel_kpis(fuel: DataFrame) -> DataFrame:
    """Mean, median, std, range and coefficient of variation of the
    regular and diesel prices."""
    out, meds = [], {}
    q = column_quantiles(fuel, {"regular": {"m": 0.5}, "diesel": {"m": 0.5}})
    for c in ("regular", "diesel"):
        meds[f"median_{c}_price"] = r(q[c]["m"], 6)
        out += [r(money_sum(c) / F.count(c), 6).alias(f"avg_{c}_price"),
                r(F.stddev_samp(c), 6).alias(f"{c}_price_std"),
                r(F.max(c) - F.min(c), 6).alias(f"{c}_price_range"),
                r(F.stddev_samp(c) / (money_sum(c) / F.count(c)), 6).alias(f"price_volatility_{c}")]
    return fuel.agg(*out).withColumns(meds)


def regional_kpis(df: DataFrame, region: str = "region", key: str = "state",
                  value: str = "population", rank: str = "rank") -> DataFrame:
    """Per region count, total, mean, mean rank, share of the grand total
    (scalar subquery) and the entity with the best (lowest) rank."""
    total = df.select(money_sum(value)).scalar()
    return df.groupBy(region).agg(
        F.count(F.lit(1)).alias("state_count"),
        money_sum(value).alias("total_population"),
        r(money_sum(value) / F.count(value), 4).alias("avg_population"),
        r(F.avg(rank), 6).alias("avg_rank"),
        r(money_sum(value) / total * 100, 6).alias("population_share"),
        F.min_by(key, F.struct(F.col(rank), F.col(key))).alias("best_state_rank"),
        F.min(rank).alias("best_rank_value"))


def composite_kpis(df: DataFrame, key: str = "state", value: str = "population",
                   rank: str = "rank") -> DataFrame:
    """Two weighted indices against the global maxima (scalar
    subqueries), with arg-max / arg-min entity and score (ties by key)."""
    mx = df.select(F.max(value).alias("v"), F.max(rank).alias("k"))
    max_v, max_k = mx.select("v").scalar(), mx.select("k").scalar()
    lpi = ((F.col(value) / max_v) * 0.4 + (1 - F.col(rank) / max_k) * 0.6) * 100
    dev = (log_positive(value) / F.log(max_v) * 0.5 + (1 - F.col(rank) / max_k) * 0.5) * 100
    s = df.select(key, lpi.alias("lpi"), dev.alias("dev"))
    return s.agg(
        F.min_by(key, F.struct(-F.col("lpi"), F.col(key))).alias("top_logistics_performer"),
        r(F.max("lpi"), 6).alias("top_logistics_score"),
        F.min_by(key, F.struct(F.col("lpi"), F.col(key))).alias("bottom_logistics_performer"),
        r(F.min("lpi"), 6).alias("bottom_logistics_score"),
        F.min_by(key, F.struct(-F.col("dev"), F.col(key))).alias("top_developer"),
        r(F.max("dev"), 6).alias("top_development_score"),
        F.min_by(key, F.struct(F.col("dev"), F.col(key))).alias("bottom_developer"),
        r(F.min("dev"), 6).alias("bottom_development_score"))


def iqr_fences(df: DataFrame, *values: str) -> list[tuple[Column, Column]]:
    """A20 helper: lower/upper 1.5 x IQR fences of each column as scalars, all
    from one pass."""
    q = column_quantiles(df, {v: {"q1": 0.25, "q3": 0.75} for v in values})
    out = []
    for v in values:
        q1, q3 = q[v]["q1"], q[v]["q3"]
        out.append((q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)))
    return out


def outliers_iqr(df: DataFrame, value: str) -> DataFrame:
    """Rows outside the 1.5 x IQR fences."""
    (lo, hi), = iqr_fences(df, value)
    return df.where((F.col(value) < lo) | (F.col(value) > hi))


def quality_kpis(df: DataFrame, key: str = "state", value: str = "population",
                 rank: str = "rank") -> DataFrame:
    """Completeness %, duplicate and distinct keys, IQR outlier counts and
    a consistency score (100, -20 negative population, -20 rank < 1, -10
    duplicate keys, floor 0)."""
    cols = df.columns
    nulls = reduce(lambda a, b: a + b, [F.count_if(F.col(c).isNull()) for c in cols])
    (plo, phi), (rlo, rhi) = iqr_fences(df, value, rank)
    agg = df.agg(
        (F.lit(1.0) - nulls / (F.count(F.lit(1)) * len(cols))).alias("_compl"),
        (F.count(F.lit(1)) - F.count_distinct(key)).alias("duplicate_states"),
        F.count_distinct(key).alias("unique_states"),
        F.count_if((F.col(value) < plo) | (F.col(value) > phi)).alias("population_outliers"),
        F.count_if((F.col(rank) < rlo) | (F.col(rank) > rhi)).alias("rank_outliers"),
        F.min(value).alias("_minv"), F.min(rank).alias("_minr"))
    score = (F.lit(100)
             - F.when(F.col("_minv") < 0, 20).otherwise(0)
             - F.when(F.col("_minr") < 1, 20).otherwise(0)
             - F.when(F.col("duplicate_states") > 0, 10).otherwise(0))
    return agg.select(r(F.col("_compl") * 100, 6).alias("data_completeness"), "duplicate_states",
                      "unique_states", "population_outliers", "rank_outliers",
                      F.greatest(score, F.lit(0)).alias("data_consistency_score"))


def to_metric_rows(one_row: DataFrame, category: str) -> DataFrame:
    """A17 form: a one-row KPI table -> (category, metric, value) rows."""
    cols = one_row.columns
    casted = one_row.select(*[F.col(c).cast("double").alias(c) for c in cols])
    return (casted.unpivot([], cols, "metric", "value")
            .select(F.lit(category).alias("category"), "metric", "value"))


def regional_metric_rows(regional: DataFrame, region: str = "region") -> DataFrame:
    """The regional table as (category, metric, value) rows, the metric
    named after its region ('ASIA.state_count'); the best entity's key is
    cast to double."""
    cols = [c for c in regional.columns if c != region]
    return (regional.select(region, *[F.col(c).cast("double").alias(c) for c in cols])
            .unpivot(region, cols, "_m", "value")
            .select(F.lit("regional").alias("category"), F.concat_ws(".", region, "_m").alias("metric"), "value"))


def all_kpis(groups: dict[str, DataFrame], regional: DataFrame | None = None) -> DataFrame:
    """Union of every KPI group in long form, with the regional table
    if given."""
    parts = [to_metric_rows(df, cat) for cat, df in groups.items()]
    if regional is not None:
        parts.append(regional_metric_rows(regional))
    return reduce(lambda a, b: a.unionByName(b), parts)


# ---- per-row scores (K1-K4, W3, W5, W6) -----------------------------------

def fuel_cost_index(df: DataFrame, diesel: str = "diesel", out: str = "fuel_cost_index") -> DataFrame:
    """Diesel / mean(diesel) (mean as a scalar subquery)."""
    mean = df.select(F.avg(diesel)).scalar()
    return df.withColumn(out, F.try_divide(F.col(diesel), mean))


def density(df: DataFrame, population: str = "population", density_col: str | None = None,
            land_area: str | None = None) -> Column:
    """K2 helper: given density, else population / land area, else population / 1000."""
    if density_col and density_col in df.columns:
        return F.col(density_col)
    if land_area and land_area in df.columns:
        return safe_div(population, land_area)
    return F.col(population) / 1000.0


def logistics_demand(df: DataFrame, population: str = "population", density_col: str | None = None,
                     land_area: str | None = None, out: str = "logistics_demand_score") -> DataFrame:
    """K2: population x density."""
    return df.withColumn(out, F.col(population) * density(df, population, density_col, land_area))


def extremes(df: DataFrame, values: dict[str, Column]) -> Column:
    """Smallest and largest of several expressions as one scalar subquery, so one
    pass over ``df``: a struct of (lo, hi) per name."""
    both = [F.struct(F.min(c).alias("lo"), F.max(c).alias("hi")).alias(name) for name, c in values.items()]
    return df.select(F.struct(*both)).scalar()


def min_max(c: Column, ends: Column) -> Column:
    """(x - min) / (max - min); a constant column falls back to x / max."""
    lo, hi = ends["lo"], ends["hi"]
    return F.when(hi > lo, (c - lo) / (hi - lo)).otherwise(F.try_divide(c, hi))


def freight_opportunity(df: DataFrame, weights: dict | None = None, population: str = "population",
                        density_col: str | None = None, land_area: str | None = None,
                        diesel: str = "diesel", out: str = "freight_opportunity_score") -> DataFrame:
    """K3: 100 x (w_p * norm(pop) + w_d * norm(density) + w_f * inverted diesel)."""
    w = weights or {"population": 0.4, "density": 0.3, "fuel_cost": 0.3}
    dens = density(df, population, density_col, land_area)
    d = F.col(diesel)
    ends = extremes(df, {"population": F.col(population), "density": dens, "diesel": d})
    lo, hi = ends["diesel"]["lo"], ends["diesel"]["hi"]
    inv = F.when(hi > lo, (hi - d) / (hi - lo)).otherwise(F.try_divide(hi - d, hi))
    score = (w["population"] * min_max(F.col(population), ends["population"])
             + w["density"] * min_max(dens, ends["density"]) + w["fuel_cost"] * inv) * 100
    return df.withColumn(out, score)


def cost_efficiency(df: DataFrame, population: str = "population", density_col: str | None = None,
                    land_area: str | None = None, diesel: str = "diesel",
                    out: str = "cost_efficiency_index") -> DataFrame:
    """K4: demand / diesel; zero or missing diesel -> null."""
    demand = F.col(population) * density(df, population, density_col, land_area)
    return df.withColumn(out, safe_div(demand, F.col(diesel)))


def zscores(df: DataFrame, outs: dict[str, str], source: DataFrame | None = None) -> DataFrame:
    """(x - mean) / sample std of several columns: column -> name of its score.
    The statistics are one scalar subquery over ``source`` (``df`` by default; give
    the table without later joins)."""
    each = [F.struct(F.avg(c).alias("m"), F.stddev_samp(c).alias("s")).alias(f"c{i}") for i, c in enumerate(outs)]
    st = (df if source is None else source).select(F.struct(*each)).scalar()
    return df.withColumns({o: F.try_divide(F.col(c) - st[f"c{i}"]["m"], st[f"c{i}"]["s"]) for i, (c, o) in enumerate(outs.items())})
