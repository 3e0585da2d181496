"""The stored lane table: flows summed by (year, quarter, origin, destination).

The route queries, the truck-rate records and the headline metrics need no
more of the flows than this. It is made once, written to the shared folder and
read by all of them, so a run of many queries joins the line items a single
time. A change of any table that it is made of (path, bytes, number of files,
time of change) makes a new one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulage.functions import exact
from haulage.plans import bindings as B
from haulage.session import scratch_path

SOURCES = ("lineitem", "orders", "customer", "supplier", "nation", "region")

# Folder of a stored table by application, name and state of its sources.
_STORED: dict[tuple[str, str, str], str] = {}


def fingerprint(spark: SparkSession, sf_dir: str, tables=SOURCES) -> str:
    """Hash of the sources' paths, sizes and times of change; no data is read."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    seen = []
    for name in tables:
        path = jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/{name}.parquet")
        fs = path.getFileSystem(conf)
        total = fs.getContentSummary(path)
        seen.append((path.toString(), total.getLength(), total.getFileCount(), fs.getFileStatus(path).getModificationTime()))
    return hashlib.sha256(repr(seen).encode()).hexdigest()


def _exists(spark: SparkSession, path: str) -> bool:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)


def stored(spark: SparkSession, sf_dir: str, name: str, make: Callable[[str], None]) -> str:
    """Folder of a table that ``make(folder)`` writes, made once per state of the sources."""
    key = (spark.sparkContext.applicationId, name, fingerprint(spark, sf_dir))
    if key not in _STORED or not _exists(spark, _STORED[key]):
        path = scratch_path(spark, name)
        make(path)
        _STORED[key] = path
    return _STORED[key]


def lane_quarters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(year, quarter, origin, destination, t, v_dec, n): tons, exact value sum
    (decimal) and number of flow rows; read from the stored table."""
    def make(path):
        columns = ("origin", "destination", "year", "quarter", "tons", "value")
        (B.flows(spark, sf_dir, columns=columns).groupBy("year", "quarter", "origin", "destination")
         .agg(F.sum("tons").alias("t"), F.sum(exact("value")).alias("v_dec"),
              F.count(F.lit(1)).alias("n")).write.parquet(path))

    return spark.read.parquet(stored(spark, sf_dir, "lanes", make))


def observed_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct (origin, destination) pairs that carry freight."""
    return lane_quarters(spark, sf_dir).select("origin", "destination").distinct()
