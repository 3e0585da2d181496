"""Cleaning and row contracts.

A contract is a list of (reason, predicate) pairs evaluated as columns; a row
is valid when every predicate holds. ``apply_contract`` returns the valid
rows and the rejects with an array of failed reasons; ``write_valid`` writes
the valid rows and counts the rejects in the same pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from haulage import dims


def normalize_names(df: DataFrame) -> DataFrame:
    """Column names lower-cased, spaces -> underscores."""
    return df.toDF(*[c.lower().replace(" ", "_") for c in df.columns])


def trim_strings(df: DataFrame) -> DataFrame:
    """Trim every string column."""
    return df.select(*[F.trim(F.col(f.name)).alias(f.name) if isinstance(f.dataType, T.StringType)
                       else F.col(f.name) for f in df.schema.fields])


def normalize_state(df: DataFrame, col: str = "state", out: str | None = None,
                    mode: str = "code_or_name") -> DataFrame:
    """State text -> two-letter code. ``code_or_name``: longer than 2
    characters -> look the upper-cased name up in the state dimension
    (unknown -> null), else upper-case the code. ``upper``: strip + upper only.
    The dimension (51 rows) is broadcast."""
    out = out or col
    s = F.upper(F.trim(F.col(col).cast("string")))
    if mode == "upper":
        return df.withColumn(out, s)
    dim = F.broadcast(dims.states_dim(df.sparkSession)
                      .select(F.col("name_upper").alias("_name"), F.col("code").alias("_code")))
    j = df.withColumn("_s", s).join(dim, F.col("_s") == F.col("_name"), "left")
    return (j.withColumn(out, F.when(F.length("_s") > 2, F.col("_code")).otherwise(F.col("_s")))
            .drop("_s", "_name", "_code"))


def known_state(c: Column, spark) -> Column:
    """Predicate: the code is one of the 50 state codes (literal IN list)."""
    return c.isin(list(dims.STATE_NAMES))


def shipping_contract(spark) -> list[tuple[str, Column]]:
    """P5: rank >= 1, state and postal of length 2 (state known), population > 0."""
    return [
        ("rank", F.col("rank").isNotNull() & (F.col("rank") >= 1)),
        ("state", F.col("state").isNotNull() & (F.length("state") == 2) & known_state(F.col("state"), spark)),
        ("postal", F.col("postal").isNotNull() & (F.length("postal") == 2)),
        ("population", F.col("population").isNotNull() & (F.col("population") > 0)),
    ]


def fuel_contract(spark) -> list[tuple[str, Column]]:
    """Known state; all four prices present and > 0."""
    preds = [("state", F.col("state").isNotNull() & known_state(F.col("state"), spark))]
    for c in ("regular", "mid_grade", "premium", "diesel"):
        preds.append((c, F.col(c).isNotNull() & (F.col(c) > 0)))
    return preds


def weather_contract() -> list[tuple[str, Column]]:
    """Humidity in [0, 100], wind speed >= 0, condition not empty."""
    return [
        ("humidity", F.col("humidity").between(0, 100)),
        ("wind_speed", F.col("wind_speed") >= 0),
        ("condition", F.length(F.coalesce(F.col("condition"), F.lit(""))) >= 1),
    ]


def apply_contract(df: DataFrame, contract: list[tuple[str, Column]]) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejects with ``reasons`` array<string>)."""
    reasons = F.filter(F.array(*[F.when(~F.coalesce(p, F.lit(False)), F.lit(name)) for name, p in contract]),
                       lambda x: x.isNotNull())
    tagged = df.withColumn("reasons", reasons)
    valid = tagged.where(F.size("reasons") == 0).drop("reasons")
    rejects = tagged.where(F.size("reasons") > 0)
    return valid, rejects


def reject_counts(rejects: DataFrame) -> DataFrame:
    """Rejected rows per first failed reason."""
    return rejects.groupBy(F.element_at("reasons", 1).alias("reason")).agg(F.count(F.lit(1)).alias("rejected"))


def write_valid(df: DataFrame, contract: list[tuple[str, Column]], path: str) -> tuple[DataFrame, DataFrame]:
    """P9 in the same pass: write the valid rows of ``df`` and count the rejected
    ones by first failed reason while they go by. Returns (the written rows, counts
    as (reason, rejected)); ``df`` is computed once."""
    first = F.coalesce(*[F.when(~F.coalesce(p, F.lit(False)), F.lit(name)) for name, p in contract])
    seen = Observation()
    counted = df.withColumn("_reason", first).observe(
        seen, *[F.count_if(F.col("_reason") == name).alias(f"r{i}") for i, (name, _) in enumerate(contract)])
    counted.where("_reason is null").drop("_reason").write.parquet(path)
    counts = [(name, seen.get[f"r{i}"]) for i, (name, _) in enumerate(contract)]
    spark = df.sparkSession
    return (spark.read.schema(df.schema).parquet(path),
            spark.createDataFrame([c for c in counts if c[1]], "reason string, rejected long"))


def typed_shipping(raw: DataFrame) -> DataFrame:
    """Names normalised, strings trimmed, state normalised, typed with try_cast."""
    df = trim_strings(normalize_names(raw))
    df = normalize_state(df, "state")
    return df.select(F.col("rank").try_cast("int").alias("rank"), "state",
                     F.upper(F.col("postal")).alias("postal"),
                     F.col("population").try_cast("double").alias("population"))


def clean_shipping(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Names normalised, strings trimmed, state normalised, typed with
    try_cast, contract applied, population_per_rank added, exact duplicates
    dropped, null states dropped, sorted by population desc. Returns
    (clean, rejects)."""
    valid, rejects = apply_contract(typed_shipping(raw), shipping_contract(raw.sparkSession))
    clean = (valid.withColumn("population_per_rank", F.col("population") / F.col("rank"))
             .dropDuplicates().dropna(subset=["state"])
             .orderBy(F.desc("population"), "state"))
    return clean, rejects


def select_present(df: DataFrame, order: list[str]) -> DataFrame:
    """Keep the listed columns that exist, in that order."""
    return df.select(*[c for c in order if c in df.columns])


def price_spread(df: DataFrame) -> DataFrame:
    """Premium - regular."""
    return df.withColumn("price_spread", F.col("premium") - F.col("regular"))


def surplus_labels(df: DataFrame, net: str = "net_tons") -> DataFrame:
    """Surplus/Deficit and Net Exporter/Importer with absolute value."""
    return df.withColumns({
        "balance_label": F.when(F.col(net) >= 0, "Surplus").otherwise("Deficit"),
        "trade_role": F.when(F.col(net) >= 0, "Net Exporter").otherwise("Net Importer"),
        "abs_net": F.abs(F.col(net)),
    })


def require_rows(df: DataFrame, message: str) -> DataFrame:
    """Fail when ``df`` has no rows (one bounded ``isEmpty`` probe)."""
    if df.isEmpty():
        raise ValueError(message)
    return df


def ingest_fuel_pages(pages: DataFrame, run_id: str, source: str = "AAA") -> tuple[DataFrame, DataFrame]:
    """S7 + P3 + P6 + P10 + P13: parse the price tables of landed pages,
    normalise states, apply the fuel contract, fail if nothing is valid, and
    stamp run id, scrape time and source. Returns (valid, rejects)."""
    from haulage.sources.files import stamp
    from haulage.sources.html import fuel_price_table

    rows = normalize_state(fuel_price_table(pages), "state_raw", "state")
    valid, rejects = apply_contract(rows, fuel_contract(pages.sparkSession))
    require_rows(valid, "no valid fuel price rows after validation")
    out = stamp(valid.select("state", "regular", "mid_grade", "premium", "diesel"), run_id, source, "scraped_at")
    return out, rejects
