"""Feature engineering.

Every step adds columns with built-in expressions; the steps are chained with
``DataFrame.transform`` so each one builds on the previous result (the
published code restarts from the raw table at each step and keeps only the
last one).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulage import dims
from haulage.functions import log_positive
from haulage.operators.joins import group_stats_to_rows
from haulage.operators.kpis import zscores
from haulage.operators.ranking import pct_ranks

FEATURE_CATALOGUE = {
    "basic_features": ["population_per_rank", "efficiency_score", "log_population", "log_rank"],
    "regional_features": ["region", "region_population_mean", "region_population_std"],
    "statistical_features": ["population_percentile", "rank_percentile", "population_zscore", "rank_zscore"],
    "composite_features": ["logistics_index", "development_score"],
    "fuel_features": ["fuel_efficiency", "fuel_cost_per_capita", "fuel_affordability_index"],
}


def basic_features(df: DataFrame, population: str = "population", rank: str = "rank") -> DataFrame:
    """ratios, efficiency = pop / (rank x 1000), natural logs (null for <= 0)."""
    p, k = F.col(population), F.col(rank)
    return df.withColumns({
        "population_per_rank": F.try_divide(p, k),
        "rank_per_population": F.try_divide(k, p),
        "efficiency_score": F.try_divide(p, k * 1000),
        "log_population": log_positive(population),
        "log_rank": log_positive(rank),
    })


def assign_region(df: DataFrame, code: str = "postal", out: str = "region",
                  unknown: str = "Other") -> DataFrame:
    """Region of a state code; unknown -> ``unknown``. Uses a broadcast
    join on the fixed 51-row state dimension."""
    spark = df.sparkSession
    dim = F.broadcast(dims.states_dim(spark).select(F.col("code").alias("_code"),
                                                     F.col("region").alias("_region")))
    return (df.join(dim, F.col(code) == F.col("_code"), "left")
            .withColumn(out, F.coalesce(F.col("_region"), F.lit(unknown)))
            .drop("_code", "_region"))


def regional_features(df: DataFrame, region: str = "region", population: str = "population",
                      code: str | None = None) -> DataFrame:
    """region (assigned from ``code`` when given) and the region's mean and
    sample std of population mapped back to rows (J13)."""
    if code is not None:
        df = assign_region(df, code, region)
    return group_stats_to_rows(df, region, population, "region_population")


def fuel_features(df: DataFrame, fuel: DataFrame | None, key: str = "state",
                  population: str = "population") -> DataFrame:
    """Left join (regular, diesel) and fuel ratios; without fuel data
    the input comes back unchanged."""
    if fuel is None:
        return df
    j = df.join(fuel.select(key, "regular", "diesel"), key, "left")
    p, d = F.col(population), F.col("diesel")
    return j.withColumns({
        "fuel_efficiency": F.try_divide(p, d),
        "fuel_cost_per_capita": F.try_divide(d, p) * 1000,
        "fuel_affordability_index": F.try_divide(p, d) * 100,
    })


def statistical_features(df: DataFrame, population: str = "population", rank: str = "rank") -> DataFrame:
    """percentile ranks (average ties / non-null count, both columns in one
    distributed pass) and z-scores (sample std)."""
    cols = {"population": population, "rank": rank}
    ranked = pct_ranks(df, {c: f"{name}_percentile" for name, c in cols.items()})
    return zscores(ranked, {c: f"{name}_zscore" for name, c in cols.items()}, df)


def composite_features(df: DataFrame, population: str = "population", rank: str = "rank") -> DataFrame:
    """logistics_index (0.5 / 0.3 / 0.2) and development_score (0.6 / 0.4)."""
    p, k = F.col(population), F.col(rank)
    return df.withColumns({
        "logistics_index": F.try_divide(p, k) * 0.5 + (p / 1000000) * 0.3 + (100 - k) * 0.2,
        "development_score": log_positive(population) * 0.6 + (100 - k) * 0.4,
    })


def all_features(df: DataFrame, fuel: DataFrame | None = None, code: str | None = None) -> DataFrame:
    """basic -> regional -> statistical -> composite -> fuel, chained."""
    return (df.transform(basic_features)
            .transform(lambda d: regional_features(d, code=code))
            .transform(statistical_features)
            .transform(composite_features)
            .transform(lambda d: fuel_features(d, fuel)))


def feature_summary(spark, with_fuel: bool = True) -> DataFrame:
    """catalogue of features by type, and a count per type."""
    rows = [(t, f) for t, fs in FEATURE_CATALOGUE.items()
            if with_fuel or t != "fuel_features" for f in fs]
    cat = spark.createDataFrame(rows, "feature_type string, feature string")
    return cat.groupBy("feature_type").agg(F.count(F.lit(1)).alias("feature_count"),
                                           F.concat_ws(", ", F.sort_array(F.collect_list("feature"))).alias("features"))
