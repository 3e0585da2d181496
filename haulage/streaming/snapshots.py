"""Fuel price snapshots as a stream (S10 append, W4 latest per state).

The published flow appends one scrape per run to a snapshot table and later
reads "the latest" back. Here landed snapshot files are read with Structured
Streaming (explicit schema), re-delivered rows are dropped within a
watermark, and the rows are appended to a parquet table; a second stream
keeps the latest non-null price per state as streaming state and publishes
it per micro-batch. Checkpoints live under the session's reliable
checkpoint folder, so a restarted query resumes where it stopped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from haulage.operators.joins import PRICE_COLS, latest_per_key
from haulage.session import ensure_checkpoint_dir

SNAPSHOT_SCHEMA = T.StructType([
    T.StructField("state", T.StringType()),
    T.StructField("regular", T.DoubleType()), T.StructField("mid_grade", T.DoubleType()),
    T.StructField("premium", T.DoubleType()), T.StructField("diesel", T.DoubleType()),
    T.StructField("pipeline_run_id", T.StringType()),
    T.StructField("scraped_at", T.TimestampType()),
    T.StructField("data_source", T.StringType()),
])


def checkpoint_path(spark: SparkSession, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/streams/{name}"


def read_snapshots(spark: SparkSession, landing_dir: str, fmt: str = "json",
                   max_files_per_trigger: int = 1000) -> DataFrame:
    """Streaming read of landed snapshot files (json or csv)."""
    r = (spark.readStream.schema(SNAPSHOT_SCHEMA).option("maxFilesPerTrigger", max_files_per_trigger))
    if fmt == "csv":
        r = r.option("header", True)
    return r.format(fmt).load(landing_dir)


def deduplicated(stream: DataFrame, delay: str = "1 day") -> DataFrame:
    """Drop re-delivered (state, scraped_at) rows seen within the watermark."""
    return (stream.withWatermark("scraped_at", delay)
            .dropDuplicatesWithinWatermark(["state", "scraped_at"]))


def append_to_table(stream: DataFrame, table_path: str, name: str = "fuel_snapshots",
                    available_now: bool = True) -> StreamingQuery:
    """Append the rows to a parquet table (exactly-once via the checkpoint)."""
    w = (stream.writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", checkpoint_path(stream.sparkSession, name)))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start(table_path)


def publish_latest(stream: DataFrame, table_path: str, name: str = "fuel_latest",
                   available_now: bool = True) -> StreamingQuery:
    """Keep the latest non-null price per state (W4) as streaming aggregation
    state and publish the full current view each micro-batch (complete mode;
    one row per state) in a folder of its own under ``table_path``. A reader
    (``read_published``) takes the newest complete folder, so it never meets
    one that is being written; a repeated batch rewrites its own folder."""
    latest = latest_per_key(stream, "state", "scraped_at", PRICE_COLS)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{table_path}/batch={batch_id}")

    w = (latest.writeStream.outputMode("complete").foreachBatch(write)
         .option("checkpointLocation", checkpoint_path(stream.sparkSession, name)))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def read_published(spark: SparkSession, table_path: str) -> DataFrame:
    """The newest complete view that ``publish_latest`` wrote."""
    path = spark._jvm.org.apache.hadoop.fs.Path(table_path)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    done = [int(s.getPath().getName().split("=")[1]) for s in fs.listStatus(path)
            if s.getPath().getName().startswith("batch=")
            and fs.exists(spark._jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS"))]
    return spark.read.parquet(f"{table_path}/batch={max(done)}")


def latest_from_table(spark: SparkSession, table_path: str) -> DataFrame:
    """Batch read of the appended table reduced to the latest per state."""
    return latest_per_key(spark.read.schema(SNAPSHOT_SCHEMA).parquet(table_path).select(
        "state", *PRICE_COLS, "scraped_at"))
