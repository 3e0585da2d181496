"""A keyed master table that is updated by merges.

Rows lie in buckets by a hash of their key. A merge reads and rewrites the
buckets that hold a key of the update; the others stay where they are and are
named again by the new version's manifest (see ``versions``). Keys are taken to
be unique in the table and in an update.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from haulage.sources.versions import Versions


class MasterTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.versions = spark, Versions(spark, path)

    def _bucket(self, key: str, buckets: int):
        return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(buckets)).cast("int")

    def create(self, rows: DataFrame, key: str, buckets: int = 64) -> None:
        """Write the first version, or replace the table by ``rows``."""
        info = {"key": key, "buckets": buckets, "schema": rows.schema.jsonValue()}
        folders = self._write(rows, info, range(buckets))
        self.versions.commit(self.versions.current(), folders, info)

    def _write(self, rows: DataFrame, info: dict, buckets) -> dict[str, str]:
        """Write rows to new folders; returns the folder of each bucket that has rows."""
        folder = self.versions.new_folder()
        # one file per bucket: all rows of a bucket meet in one task
        (rows.withColumn("bucket", self._bucket(info["key"], info["buckets"])).repartition("bucket")
         .write.partitionBy("bucket").parquet(self.versions.full(folder)))
        return {str(b): f"{folder}/bucket={b}" for b in buckets if self.versions.exists(f"{folder}/bucket={b}")}

    def _read(self, folders: list[str], info: dict) -> DataFrame:
        schema = T.StructType.fromJson(info["schema"])
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[self.versions.full(f) for f in sorted(folders)])

    def read(self) -> DataFrame:
        """The rows of the current version."""
        now = self.versions.current()
        if not now.version:
            raise FileNotFoundError(f"no finished version in {self.versions.path}")
        return self._read(list(now.folders.values()), now.info)

    def merge(self, updates: DataFrame, derive: Callable[[DataFrame], DataFrame] = lambda df: df, insert: bool = False) -> list[int]:
        """Set the columns of ``updates`` (key and any others of the table) where they
        are not null; ``derive`` then works out further columns of the rows that were
        met. Other rows stay as they are. Keys that the table lacks are ignored, or
        added with ``insert``. Returns the buckets that were rewritten.
        """
        now = self.versions.current()
        key, buckets = now.info["key"], now.info["buckets"]
        names = T.StructType.fromJson(now.info["schema"]).names
        new = updates.withColumn("bucket", self._bucket(key, buckets))
        # at most one entry per bucket
        touched = sorted(new.agg(F.collect_set("bucket")).first()[0])
        if not touched:
            return []
        old = self._read([now.folders[str(b)] for b in touched if str(b) in now.folders], now.info)
        given = [c for c in updates.columns if c != key]
        both = old.withColumn("_old", F.lit(True)).join(
            updates.select(key, *[F.col(c).alias(f"_new_{c}") for c in given]).withColumn("_met", F.lit(True)), key, "full" if insert else "left")
        met = both.where("_met").select(
            *[F.coalesce(F.col(f"_new_{c}"), F.col(c)).alias(c) if c in given else F.col(c) for c in names])
        rest = both.where("_met is null").select(*names)
        schema = T.StructType.fromJson(now.info["schema"])
        done = derive(met).select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])
        written = self._write(done.unionByName(rest), now.info, touched)
        folders = {b: f for b, f in now.folders.items() if int(b) not in touched} | written
        self.versions.commit(now, folders, now.info)
        return touched
