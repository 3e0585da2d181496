"""SQL-mart equivalents.

Marts are DataFrame transforms; ``register_view`` exposes any of them to
``spark.sql`` under a layer name (S12).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulage.functions import percentile_tier, region_case, round_half_up, safe_div
from haulage.operators.joins import full_outer_coalesce
from haulage.operators.ranking import global_row_number, value_ranks

SHIPPING_COLS = ["state", "postal", "rank", "population", "population_per_rank",
                 "regular", "mid_grade", "premium", "diesel", "pipeline_run_id"]
FUEL_COLS = ["state", "regular", "mid_grade", "premium", "diesel", "scraped_at", "pipeline_run_id"]


def staging(df: DataFrame, columns: list[str]) -> DataFrame:
    """Project a fixed column list; absent columns become typed nulls
    (strings for ids, doubles otherwise)."""
    out = []
    for c in columns:
        if c in df.columns:
            out.append(F.col(c))
        else:
            t = ("string" if c in ("postal", "pipeline_run_id", "data_source")
                 else "timestamp_ntz" if c in ("scraped_at", "updated_at") else "double")
            out.append(F.lit(None).cast(t).alias(c))
    return df.select(*out)


def register_view(df: DataFrame, name: str) -> DataFrame:
    """Named view for SQL access (staging layer)."""
    df.createOrReplaceTempView(name)
    return df


def store_layers(shipping: DataFrame, fuel: DataFrame, out_dir: str) -> None:
    """The staging, intermediate and mart tables under ``out_dir`` by
    layer and name. Each layer reads the written tables of the one below, so
    a join or a rank runs once however many marts use it."""
    spark = shipping.sparkSession

    def put(layer: str, name: str, df: DataFrame) -> DataFrame:
        path = f"{out_dir}/{layer}/{name}"
        df.write.mode("overwrite").parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    ship = put("staging", "stg_shipping_stats", staging(shipping, SHIPPING_COLS))
    prices = put("staging", "stg_fuel_prices", staging(fuel, FUEL_COLS))
    analysis = put("intermediate", "int_freight_analysis", freight_analysis(ship, prices))
    put("marts", "fct_efficiency_analysis", efficiency_mart(analysis))
    put("marts", "fct_daily_costs", daily_costs(ship, prices))
    put("marts", "dim_state", dim_state(ship))


def freight_analysis(shipping: DataFrame, fuel: DataFrame) -> DataFrame:
    """J6/P19/P20/P26/P27 (int_freight_analysis): shipping FULL OUTER JOIN fuel
    on state, prices coalesced (shipping first), efficiency score =
    population / (diesel x 100) and burden index = population / max(population)
    x diesel (max as a scalar subquery)."""
    s = staging(shipping, SHIPPING_COLS)
    f = staging(fuel, FUEL_COLS[:-1])
    m = full_outer_coalesce(s, f, "state", ["regular", "mid_grade", "premium", "diesel"])
    max_pop = m.select(F.max("population")).scalar()
    return m.withColumns({
        "efficiency_score": safe_div(F.col("population"), F.col("diesel") * 100),
        "fuel_burden_index": F.try_divide(F.col("population"), max_pop) * F.col("diesel"),
    })


def efficiency_mart(fa: DataFrame) -> DataFrame:
    """K5/W1 (fct_efficiency_analysis): tier from percent_rank of the score
    (>= .75 / .50 / .25), computed with the distributed rank; null score ->
    null tier; ordered by score desc."""
    ranked = value_ranks(fa, "efficiency_score", prefix="_e_", count_nulls_in_n=True)
    return (ranked.withColumn("efficiency_tier", percentile_tier("_e_percent_rank", scale=1.0))
            .select("state", "postal", "rank", "population", "regular", "mid_grade", "premium",
                    "diesel", "fuel_burden_index", "efficiency_score", "efficiency_tier",
                    "pipeline_run_id")
            .orderBy(F.desc_nulls_last("efficiency_score"), "state"))


def efficiency_percentiles(df: DataFrame, score: str = "efficiency_score") -> DataFrame:
    """K5 notebook form / W2 / P22: percentile = average-tie rank / n x 100
    (1 dp), tier from that percentile."""
    ranked = value_ranks(df, score, prefix="_p_")
    pct = round_half_up(F.try_divide(F.col("_p_avg_rank"), F.col("_p_n")) * 100, 1)
    return (ranked.withColumn("efficiency_percentile", pct)
            .withColumn("efficiency_tier", percentile_tier("efficiency_percentile"))
            .drop("_p_rank", "_p_avg_rank", "_p_percent_rank", "_p_cume_dist", "_p_n"))


def ecdf(df: DataFrame, value: str, key: str, out: str = "ecdf_pct") -> DataFrame:
    """Empirical CDF i / n x 100 over non-null values ordered by value then
    key (ties get increasing values), with a distributed row number."""
    nn = df.where(F.col(value).isNotNull())
    n = nn.select(F.count(F.lit(1))).scalar()
    return (global_row_number(nn, [F.asc(value), F.asc(key)], out="_i")
            .withColumn(out, F.col("_i") / n * 100).drop("_i"))


def daily_costs(shipping: DataFrame, fuel: DataFrame) -> DataFrame:
    """J5/P25 (fct_daily_costs): shipping LEFT JOIN fuel, population in
    millions x price, 2 dp."""
    f = staging(fuel, FUEL_COLS[:-1])
    j = staging(shipping, SHIPPING_COLS).select("state", "population", "pipeline_run_id").join(f, "state", "left")
    return j.select(
        "state", "population", "regular", "mid_grade", "premium", "diesel", "scraped_at",
        round_half_up(F.col("population") / 1000000.0 * F.col("diesel"), 2).alias("estimated_daily_diesel_cost_millions"),
        round_half_up(F.col("population") / 1000000.0 * F.col("regular"), 2).alias("estimated_daily_gas_cost_millions"),
        "pipeline_run_id")


def dim_state(shipping: DataFrame, code: str = "postal") -> DataFrame:
    """P18 (dim_state): region by CASE on the code ('Unknown' otherwise) and a
    load timestamp."""
    return shipping.select("state", "postal", "rank", "population",
                           region_case(code, "Unknown").alias("region"),
                           F.current_timestamp().alias("loaded_at"))


def population_update(master: DataFrame, new_pop: DataFrame, diesel: DataFrame,
                      run_id: str) -> DataFrame:
    """New population over old (coalesce), diesel joined,
    pop_per_dollar only where diesel is non-null and non-zero and population
    is known; lineage stamp."""
    m = (master.join(new_pop.select("state", "new_population"), "state", "left")
         .withColumn("population", F.coalesce("new_population", "population"))
         .drop("new_population")
         .join(diesel.select("state", "diesel"), "state", "left"))
    ok = F.col("diesel").isNotNull() & (F.col("diesel") != 0) & F.col("population").isNotNull()
    return m.withColumns({
        "pop_per_dollar": F.when(ok, F.col("population") / F.col("diesel")),
        "pipeline_run_id": F.lit(run_id),
        "updated_at": F.current_timestamp(),
    })
