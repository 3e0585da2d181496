"""Landed API payloads -> typed rows.

The engine does not call services; it reads the JSON they returned with an
explicit schema and flattens it with column expressions. Responses landed as
files come through ``landed.ingest`` (``*_landed`` here), which keeps what
can't be used as counted rejects; responses in a string column are parsed by
``from_json``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from haulage import dims
from haulage.functions import round_half_up
from haulage.sources.landed import Landed, ingest

EIA_SCHEMA = T.StructType([T.StructField("response", T.StructType([
    T.StructField("data", T.ArrayType(T.StructType([
        T.StructField("value", T.StringType()),
        T.StructField("period", T.StringType()),
        T.StructField("area-name", T.StringType())])))]))])

RATE_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in
                            ("year", "quarter", "region", "destination", "rate_per_mile", "rate_per_truckload")])

WEATHER_SCHEMA = T.StructType([
    T.StructField("main", T.StructType([T.StructField("temp", T.DoubleType()),
                                        T.StructField("humidity", T.DoubleType()),
                                        T.StructField("feels_like", T.DoubleType())])),
    T.StructField("wind", T.StructType([T.StructField("speed", T.DoubleType())])),
    T.StructField("weather", T.ArrayType(T.StructType([T.StructField("description", T.StringType())])))])


def eia_landed(spark: SparkSession, path: str, out: str) -> Landed:
    """S3: one file per response, product and area code in the folder names;
    ``rows`` has (product_code, area_code, response)."""
    return ingest(spark, path, out, EIA_SCHEMA, {"no_data": F.col("response.data").isNotNull()}, multi_line=True)


def rates_landed(spark: SparkSession, path: str, out: str) -> Landed:
    """Files that hold an array of rate records each."""
    return ingest(spark, path, out, RATE_SCHEMA, {"no_region": F.col("region").isNotNull()}, multi_line=True)


def weather_landed(spark: SparkSession, path: str, out: str) -> Landed:
    """One response per line, in an envelope with its state."""
    schema = T.StructType([T.StructField("state", T.LongType()), T.StructField("response", WEATHER_SCHEMA)])
    return ingest(spark, path, out, schema, {"no_data": F.col("response.main").isNotNull()})


def eia_rows(raw: DataFrame, payload: str = "payload") -> DataFrame:
    """``eia_flat`` for responses in a string column."""
    return eia_flat(raw.select("product_code", "area_code", F.from_json(F.col(payload), EIA_SCHEMA)["response"].alias("response")))


def eia_flat(parsed: DataFrame) -> DataFrame:
    """One row per element of ``response.data`` of each parsed response
    (product_code, area_code, response); product code -> fuel type and area code
    -> state through broadcast dimension joins ('NUS' is 'US'; unknown areas keep
    their code); area-name defaults to the state; price cast to double."""
    spark = parsed.sparkSession
    prod = F.broadcast(spark.createDataFrame(list(dims.EIA_PRODUCTS.items()), "product_code string, fuel_type string"))
    areas = [("NUS", "US")] + [(a, s) for s, a in dims.EIA_STATE_AREAS.items()]
    area = F.broadcast(spark.createDataFrame(areas, "area_code string, state string"))
    rows = (parsed.select("product_code", "area_code", F.explode("response.data").alias("d"))
            .join(prod, "product_code").join(area, "area_code", "left")
            .withColumn("state", F.coalesce("state", "area_code")))
    return rows.select("state", "fuel_type", F.col("d.value").try_cast("double").alias("price"),
                       F.col("d.period").alias("period"), "product_code",
                       F.coalesce(F.col("d.`area-name`"), F.col("state")).alias("area_name"),
                       F.lit("EIA").alias("data_source"))


def latest_periods(df: DataFrame, keys: list[str], period: str = "period", n: int = 10) -> DataFrame:
    """The latest ``n`` periods per key (row_number per key group; a group
    keeps at most n rows)."""
    w = Window.partitionBy(*keys).orderBy(F.desc(period))
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def truck_rates(raw: DataFrame, year: int | Column, payload: str = "payload") -> DataFrame:
    """``typed_rates`` for records in a string column."""
    return typed_rates(raw.select(F.from_json(F.col(payload), RATE_SCHEMA).alias("r")).select("r.*"), year)


def typed_rates(records: DataFrame, year: int | Column) -> DataFrame:
    """Rate records (strings) -> typed rows: missing year ->
    ``year``, missing quarter -> 1, missing rates -> 0; destination trimmed and
    upper-cased; region mapped to state codes (unmapped keeps its name,
    'OTHER' -> null); filtered to ``year``."""
    spark = records.sparkSession
    regions = F.broadcast(spark.createDataFrame(
        [(k, v, True) for k, v in dims.RATE_REGIONS.items()],
        "region string, codes string, mapped boolean"))
    out = (records.join(regions, "region", "left")
           .select(F.coalesce(F.col("year").try_cast("int"), F.lit(year)).alias("year"),
                   F.coalesce(F.col("quarter").try_cast("int"), F.lit(1)).alias("quarter"),
                   F.when(F.col("mapped"), F.col("codes")).otherwise(F.col("region")).alias("origin_state"),
                   F.upper(F.trim(F.coalesce(F.col("destination"), F.lit("")))).alias("destination"),
                   round_half_up(F.coalesce(F.col("rate_per_mile").try_cast("double"), F.lit(0.0)), 4).alias("rate_per_mile"),
                   round_half_up(F.coalesce(F.col("rate_per_truckload").try_cast("double"), F.lit(0.0)), 2)
                   .alias("rate_per_truckload"),
                   F.col("region").alias("_region")))
    return out.where(F.col("year") == year)


def rates_by_state(rates: DataFrame) -> DataFrame:
    """P24 exploded view: one row per state code of a multi-state region."""
    return (rates.where(F.col("origin_state").isNotNull())
            .withColumn("origin_state", F.explode(F.split("origin_state", ","))))


def sorted_rates(rates: DataFrame, limit: int = 10000) -> DataFrame:
    """Ordered by quarter, region, destination, first ``limit`` rows. The
    remaining columns break ties, so the rows kept do not depend on the plan."""
    ties = ["origin_state", "rate_per_mile", "rate_per_truckload"]
    return rates.orderBy("quarter", "_region", "destination", *[F.asc_nulls_last(c) for c in ties]).limit(limit)


def weather_rows(raw: DataFrame, payload: str = "payload") -> DataFrame:
    """``weather_flat`` for responses in a string column."""
    return weather_flat(raw.select("state", F.from_json(F.col(payload), WEATHER_SCHEMA).alias("response")))


def weather_flat(parsed: DataFrame) -> DataFrame:
    """Nested weather response -> flat row (temperature, condition in
    title case from the first weather entry, humidity, wind speed, feels
    like), source stamped."""
    return parsed.select("state", F.col("response").alias("w")).select(
        "state", F.col("w.main.temp").alias("temperature"),
        F.initcap(F.try_element_at("w.weather", F.lit(1))["description"]).alias("condition"),
        F.col("w.main.humidity").alias("humidity"), F.col("w.wind.speed").alias("wind_speed"),
        F.col("w.main.feels_like").alias("feels_like"), F.lit("OpenWeatherMap").alias("data_source"))
