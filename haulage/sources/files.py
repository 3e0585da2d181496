"""File and table sources and sinks.

Reads always pass an explicit schema (no inference pass over the data) and
select only the columns a step uses, so CSV parsing and parquet scans are
pruned. Sinks are DataFrame writers; a run id / load time / source name
stamp (P13) is added by ``stamp``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SHIPPING_RAW = T.StructType([
    T.StructField("Rank", T.StringType()), T.StructField("State", T.StringType()),
    T.StructField("Postal", T.StringType()), T.StructField("Population", T.StringType())])

FLOW_YEARS = list(range(2018, 2025))
FLOW_KEYS = ["dms_origst", "dms_destst", "dms_mode", "sctg2", "trade_type"]


def flow_file_schema(years=FLOW_YEARS, extra_leading: list[str] | None = None) -> T.StructType:
    """Freight-flow file layout: optional leading columns, the five code
    columns, then tons_Y and value_Y (float32) for each year."""
    fields = [T.StructField(c, T.StringType()) for c in (extra_leading or [])]
    fields += [T.StructField(c, T.IntegerType()) for c in FLOW_KEYS]
    fields += [T.StructField(f"tons_{y}", T.FloatType()) for y in years]
    fields += [T.StructField(f"value_{y}", T.FloatType()) for y in years]
    return T.StructType(fields)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str, header: bool = True) -> DataFrame:
    """CSV with a header row and an explicit schema."""
    return spark.read.schema(schema).option("header", header).option("mode", "PERMISSIVE").csv(path)


def read_flow_csv(spark: SparkSession, path: str, years=FLOW_YEARS,
                  schema: T.StructType | None = None) -> DataFrame:
    """Freight-flow CSV (csv or csv.gz; Spark has no zip codec, so the zip
    member is landed first), keeping only the code and per-year measure
    columns (CSV column pruning skips parsing the rest)."""
    sch = schema or flow_file_schema(years)
    keep = FLOW_KEYS + [f"tons_{y}" for y in years] + [f"value_{y}" for y in years]
    return spark.read.schema(sch).option("header", True).csv(path).select(*keep)


def read_table(spark: SparkSession, path_or_name: str) -> DataFrame:
    """Table read by catalog name or parquet path."""
    if "/" in path_or_name:
        return spark.read.parquet(path_or_name)
    return spark.table(path_or_name)


def write_table(df: DataFrame, path: str, mode: str = "overwrite",
                partition_by: list[str] | None = None) -> None:
    """Parquet write, replace or append (optionally partitioned, e.g. by
    year so later reads prune partitions)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV sink with a header row (one part file per partition)."""
    df.write.mode(mode).option("header", True).csv(path)


def optional_table(spark: SparkSession, path_or_name: str, schema: T.StructType) -> DataFrame:
    """The table if it exists, else an empty table with the given schema."""
    try:
        if "/" in path_or_name:
            return spark.read.schema(schema).parquet(path_or_name)
        if spark.catalog.tableExists(path_or_name):
            return spark.table(path_or_name)
    except Exception as exc:  # missing path
        if "PATH_NOT_FOUND" not in str(exc) and "does not exist" not in str(exc):
            raise
    return spark.createDataFrame([], schema)


def read_snapshots(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Files whose columns changed over time, read as one table of the
    fixed ``schema``: the files' schemas are merged, a column that no file has is a
    typed null, one that some files lack is null in their rows, and columns beyond
    the schema are left out. Names are matched whatever their case."""
    merged = spark.read.option("mergeSchema", True).parquet(path)
    at = {c.lower(): c for c in merged.columns}
    return merged.select(*[
        (F.col(f"`{at[f.name.lower()]}`") if f.name.lower() in at else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema.fields])


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON-lines sink (e.g. the profile report)."""
    df.write.mode(mode).json(path)


def stamp(df: DataFrame, run_id: str | None, source: str | None = None,
          time_col: str | None = None) -> DataFrame:
    """Lineage columns: run id, load time, source name."""
    out = df
    if run_id is not None:
        out = out.withColumn("pipeline_run_id", F.lit(run_id))
    if time_col:
        out = out.withColumn(time_col, F.current_timestamp())
    if source:
        out = out.withColumn("data_source", F.lit(source))
    return out
