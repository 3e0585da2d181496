"""Profiling and exploratory statistics.

Column-wise statistics are computed by unpivoting the numeric columns into
(column, value) rows and running one ``groupBy("column")``: moments are
partial aggregates; quantiles of whole columns are selected by histogram
refinement (``selection``), those of groups by the distributed exact quantile
(``ranking.grouped_quantiles``), so no column is ever gathered in one task.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations
from math import isnan

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from haulage.functions import exact, jarque_bera_p, round_half_up
from haulage.operators.gram import gram
from haulage.operators.ranking import grouped_quantiles, quantile_scalars
from haulage.operators.selection import quantile_rows, select_quantiles
from haulage.session import materialize, small_side

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC)]


def to_long(df: DataFrame, cols: list[str], name: str = "column", value: str = "value") -> DataFrame:
    """Unpivot ``cols`` (cast to double) into (name, value) rows."""
    return (df.select(*[F.col(c).cast("double").alias(c) for c in cols])
            .unpivot([], cols, name, value))


def descriptive_statistics(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Per numeric column count, mean, median, std, var, min, max, q25,
    q75, iqr, skewness and excess kurtosis (population forms), cv (0 when the
    mean is 0). Nulls are skipped per column."""
    cols = cols or numeric_columns(df)
    stored = materialize(df.select(*cols))  # the moments and the quantiles read the same rows
    long = to_long(stored, cols).where(F.col("value").isNotNull())
    mom = long.groupBy("column").agg(
        F.count("value").alias("count"), F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"), F.var_samp("value").alias("var"),
        F.min("value").alias("min"), F.max("value").alias("max"),
        F.skewness("value").alias("skewness"), F.kurtosis("value").alias("kurtosis"))
    q = quantile_rows(stored, cols, {"median": 0.5, "q25": 0.25, "q75": 0.75}).drop("n")
    return (mom.join(F.broadcast(q), "column")
            .withColumn("iqr", F.col("q75") - F.col("q25"))
            .withColumn("cv", F.when(F.col("mean") != 0, F.col("std") / F.col("mean")).otherwise(F.lit(0.0))))


def correlation_pairs(df: DataFrame, cols: list[str] | None = None, threshold: float = 0.5,
                      strong: float = 0.7, keep_all: bool = False) -> DataFrame:
    """Pearson correlation for every column pair i < j (rows that have
    both), from one Gram matrix, as (var1, var2, correlation, strength); pairs
    with |r| > threshold unless ``keep_all``. Null for a constant column."""
    cols = cols or numeric_columns(df)
    r = gram(df, cols).correlation()
    rows = [(cols[i], cols[j], None if isnan(r[i, j]) else float(r[i, j])) for i, j in combinations(range(len(cols)), 2)]
    out = (df.sparkSession.createDataFrame(rows, "var1 string, var2 string, correlation double")
           .withColumn("strength", F.when(F.abs("correlation") > strong, "Strong").otherwise("Moderate")))
    return out if keep_all else out.where(F.abs("correlation") > threshold)


def value_counts(df: DataFrame, cols: list[str], group: list[str] | None = None) -> DataFrame:
    """(group, column, value, rows) of the distinct values, stored once: one
    scan serves the quantiles and the outlier counts, and a value that many
    rows share is one row from then on."""
    g = group or []
    long = (df.select(*g, *[F.col(c).cast("double").alias(c) for c in cols])
            .unpivot(g, cols, "column", "value").where(F.col("value").isNotNull()))
    return materialize(long.groupBy(*g, "column", "value").agg(F.count(F.lit(1)).alias("rows")))


def iqr_outlier_counts(df: DataFrame, cols: list[str], group: list[str] | None = None) -> DataFrame:
    """A20 in bulk: rows outside 1.5 x IQR fences per column (and group)."""
    if not group:
        return _column_outlier_counts(df, cols)
    g = group
    values = value_counts(df, cols, group)
    q = grouped_quantiles(values, [*g, "column"], "value", {"q1": 0.25, "q3": 0.75}, weight="rows")
    fences = q.select(*g, "column", (F.col("q1") - 1.5 * (F.col("q3") - F.col("q1"))).alias("lo"),
                      (F.col("q3") + 1.5 * (F.col("q3") - F.col("q1"))).alias("hi"), "n")
    outside = (F.col("value") < F.col("lo")) | (F.col("value") > F.col("hi"))
    return (values.join(small_side(fences), [*g, "column"])
            .groupBy(*g, "column")
            .agg(F.sum(F.when(outside, F.col("rows")).otherwise(0)).alias("outliers_count"),
                 F.first("n").alias("n")))


def _column_outlier_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    """(column, outliers_count, n): fences by selection, then one count per column in a single scan."""
    fences = select_quantiles(df, {c: {"q1": 0.25, "q3": 0.75} for c in cols})
    cols = [c for c in cols if fences[c]["n"]]
    if not cols:
        return df.sparkSession.createDataFrame([], "column string, outliers_count long, n long")
    counts = []
    for c in cols:
        v, q1, q3 = F.col(f"`{c}`").cast("double"), fences[c]["q1"], fences[c]["q3"]
        outside = (v < q1 - 1.5 * (q3 - q1)) | (v > q3 + 1.5 * (q3 - q1))
        counts.append(F.struct(F.lit(c).alias("column"), F.count_if(outside).alias("outliers_count"), F.count(v).alias("n")))
    return df.agg(F.array(*counts).alias("x")).select(F.explode("x").alias("x")).select("x.*")


def distribution_analysis(df: DataFrame, cols: list[str] | None = None, alpha: float = 0.05) -> DataFrame:
    """A21 (re-aimed): Jarque-Bera normality test from population skewness and
    excess kurtosis (p = exp(-JB / 2)), 'Insufficient data' when n <= 3, and
    IQR outlier count and percentage."""
    cols = cols or numeric_columns(df)
    stored = materialize(df.select(*cols))
    long = to_long(stored, cols).where(F.col("value").isNotNull())
    mom = long.groupBy("column").agg(F.count("value").alias("n"), F.skewness("value").alias("s"),
                                     F.kurtosis("value").alias("k"))
    out = iqr_outlier_counts(stored, cols).drop("n")
    p = jarque_bera_p("n", "s", "k")
    return (mom.join(out, "column")
            .select("column", "n",
                    F.when(F.col("n") <= 3, F.lit(None).cast("double")).otherwise(p).alias("jb_p_value"),
                    F.when(F.col("n") <= 3, "Insufficient data")
                     .when(p > alpha, "Normal").otherwise("Not Normal").alias("distribution_type"),
                    "outliers_count",
                    (F.col("outliers_count") / F.col("n") * 100).alias("outlier_percentage")))


def regional_analysis(df: DataFrame, region: str = "region", value: str = "population",
                      rank: str = "rank") -> DataFrame:
    """Per region count, means, total, std and best/worst rank."""
    return df.groupBy(region).agg(
        F.count(F.lit(1)).alias("count"), F.avg(value).alias("avg_population"),
        F.avg(rank).alias("avg_rank"), F.sum(exact(value)).cast("double").alias("total_population"),
        F.stddev_samp(value).alias("population_std"), F.min(rank).alias("best_rank"),
        F.max(rank).alias("worst_rank"))


def box_stats(df: DataFrame, group: list[str], value: str) -> DataFrame:
    """Min, quartiles, max and 1.5 x IQR outlier count per group."""
    values = value_counts(df, [value], group)
    q = small_side(grouped_quantiles(values, group, "value", {"q0": 0.0, "q1": 0.25, "median": 0.5, "q3": 0.75, "q4": 1.0},
                                     weight="rows"))
    outside = ((F.col("value") < F.col("q1") - 1.5 * (F.col("q3") - F.col("q1")))
               | (F.col("value") > F.col("q3") + 1.5 * (F.col("q3") - F.col("q1"))))
    out = values.join(q, group).groupBy(*group).agg(F.sum(F.when(outside, F.col("rows")).otherwise(0)).alias("outliers"))
    return q.join(out, group)


def histogram(df: DataFrame, value: str, bins: int = 30) -> DataFrame:
    """Equal-width histogram over [min, max] (the max lands in the last
    bin), with bin edges and, on every row, the mean and the median of all
    values; these and min and max are scalar subqueries."""
    v = F.col(value).cast("double")
    mm = df.select(F.min(v).alias("lo"), F.max(v).alias("hi"))
    lo, hi = mm.select("lo").scalar(), mm.select("hi").scalar()
    width = (hi - lo) / bins
    b = F.least(F.floor(F.try_divide(v - lo, hi - lo) * bins) + 1, F.lit(bins))
    b = F.when(hi == lo, F.lit(1)).otherwise(b)
    return (df.where(v.isNotNull()).groupBy(b.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("count"))
            .withColumn("bin_start", lo + (F.col("bin") - 1) * width)
            .withColumn("bin_end", lo + F.col("bin") * width)
            .withColumn("mean", df.select(F.avg(v)).scalar())
            .withColumn("median", quantile_scalars(df, value, {"m": 0.5})["m"]))


def table_profile(tables: dict[str, DataFrame]) -> DataFrame:
    """Per table and column: type, rows, null count and null %.
    One aggregate per table (count_if per column), unpivoted and unioned."""
    parts = []
    for name, df in tables.items():
        cols = df.columns
        agg = df.agg(F.count(F.lit(1)).alias("__rows"),
                     *[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
        types = F.create_map(*[x for f in df.schema.fields
                               for x in (F.lit(f.name), F.lit(f.dataType.simpleString()))])
        long = (agg.unpivot(["__rows"], cols, "column_name", "nulls")
                .select(F.lit(name).alias("table_name"), "column_name",
                        types[F.col("column_name")].alias("dtype"),
                        F.col("__rows").alias("rows"), "nulls",
                        F.when(F.col("__rows") > 0, F.col("nulls") / F.col("__rows") * 100)
                         .otherwise(F.lit(0.0)).alias("null_pct")))
        parts.append(long)
    return reduce(lambda a, b: a.unionByName(b), parts)


def insights(df: DataFrame, numeric: list[str], region: str = "region", value: str = "population",
             efficiency: str = "population_per_rank") -> DataFrame:
    """Findings as rows (insight_key, text) about a table with a region and
    numeric columns. Values are rounded before formatting, so the text does
    not depend on the formatter's own rounding rule."""
    fmt = lambda text, *cols: F.format_string(text, *cols)
    q = quantile_scalars(df, value, {"p90": 0.9, "p10": 0.1})
    stats = df.agg(F.min(value).alias("lo"), F.max(value).alias("hi"), F.avg(value).alias("m"),
                   (F.stddev_samp(value) / F.avg(value)).alias("cv"), F.avg(efficiency).alias("eff"))
    regions = regional_analysis(df, region, value, "rank").agg(
        F.max_by(region, F.struct("total_population", region)).alias("largest"),
        F.max_by(region, F.struct("avg_population", region)).alias("highest"))
    pairs = correlation_pairs(df, numeric)
    row = lambda src, key, text: src.select(F.lit(key).alias("insight_key"), text.alias("text"))
    r = round_half_up
    parts = [
        row(stats, "population_range", fmt("Population ranges from %.2f to %.2f", r("lo", 2), r("hi", 2))),
        row(stats, "population_mean", fmt("Average population is %.2f with CV of %.4f", r("m", 2), r("cv", 4))),
        row(pairs.agg(F.count(F.lit(1)).alias("n")).where("n > 0"), "strong_pairs",
            fmt("Found %d strong correlations between variables", F.col("n"))),
        pairs.select(F.concat(F.lit("pair_"), F.concat_ws("~", "var1", "var2")).alias("insight_key"),
                     fmt("Strong correlation: %s vs %s (%.4f)", F.col("var1"), F.col("var2"), r(r("correlation", 9), 4)).alias("text")),
        row(regions, "highest_average_region", fmt("Region with highest average population: %s", F.col("highest"))),
        row(stats, "average_efficiency", fmt("Average efficiency score: %.4f", r("eff", 4))),
        row(stats.select(r(q["p90"] / q["p10"], 4).alias("ratio")), "population_ratio_90_10",
            fmt("Population disparity: Top 10%% have %.4fx more population than bottom 10%%", F.col("ratio"))),
        row(regions, "largest_region", fmt("Largest region by population: %s", F.col("largest"))),
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)


def rounded_stats(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.select(*[round_half_up(F.col(f.name), digits).alias(f.name)
                       if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
                       for f in df.schema.fields])


def shape_rows(df: DataFrame, name: str) -> DataFrame:
    """Rows and columns of a table, and each column's kind, in long form."""
    numeric = set(numeric_columns(df))
    kinds = F.explode(F.array(*[F.struct(F.lit("column").alias("section"), F.lit(c).alias("item"),
                                         F.lit("numeric" if c in numeric else "categorical").alias("metric"),
                                         F.lit(1.0).alias("value")) for c in df.columns])).alias("k")
    size = df.agg(F.count(F.lit(1)).cast("double").alias("rows"), F.lit(float(len(df.columns))).alias("columns"))
    shape = (size.unpivot([], ["rows", "columns"], "metric", "value")
             .select(F.lit("shape").alias("section"), F.lit(name).alias("item"), "metric", "value"))
    return shape.unionByName(size.select(kinds).select("k.*"))


def regional_rows(regional: DataFrame, region: str = "region") -> DataFrame:
    """The regional table in long form."""
    cols = [c for c in regional.columns if c != region]
    return (regional.select(region, *[F.col(c).cast("double").alias(c) for c in cols])
            .unpivot(region, cols, "metric", "value")
            .select(F.lit("regional").alias("section"), F.col(region).alias("item"), "metric", "value"))


def eda_summary(stats: DataFrame, dist: DataFrame, corr: DataFrame, profile: DataFrame) -> DataFrame:
    """The descriptive, distribution, correlation and profile tables in
    one long form (section, item, metric, value)."""
    s_cols = [c for c in stats.columns if c != "column"]
    a = (stats.select("column", *[F.col(c).cast("double").alias(c) for c in s_cols])
         .unpivot("column", s_cols, "metric", "value")
         .select(F.lit("descriptive").alias("section"), F.col("column").alias("item"), "metric", "value"))
    d_cols = ["n", "jb_p_value", "outliers_count", "outlier_percentage"]
    b = (dist.select("column", *[F.col(c).cast("double").alias(c) for c in d_cols])
         .unpivot("column", d_cols, "metric", "value")
         .select(F.lit("distribution").alias("section"), F.col("column").alias("item"), "metric", "value"))
    c = corr.select(F.lit("correlation").alias("section"), F.concat_ws("~", "var1", "var2").alias("item"),
                    F.lit("correlation").alias("metric"), F.col("correlation").cast("double").alias("value"))
    p = profile.select(F.lit("profile").alias("section"), F.concat_ws(".", "table_name", "column_name").alias("item"),
                       F.lit("nulls").alias("metric"), F.col("nulls").cast("double").alias("value"))
    return a.unionByName(b).unionByName(c).unionByName(p)


def describe(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Per numeric column count, mean, sample std, min, quartiles and max.
    All are exact, the quartiles too (unlike ``DataFrame.summary``)."""
    cols = cols or numeric_columns(df)
    stored = materialize(df.select(*cols))
    long = to_long(stored, cols).where(F.col("value").isNotNull())
    q = F.broadcast(quantile_rows(stored, cols, {"q25": 0.25, "median": 0.5, "q75": 0.75}).drop("n"))
    stats = long.groupBy("column").agg(
        F.count("value").alias("count"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"))
    return stats.join(q, "column").select("column", "count", "mean", "std", "min", "q25", "median", "q75", "max")
