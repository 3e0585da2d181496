"""Freight aggregates kept up to date file by file.

For every input file its partial aggregate (tons, value and rows by lane, mode,
commodity and year) is stored once. A refresh lists the files, reads the new ones
only, and names their states in a new version; a file that changed counts as gone
and new. The states of the files that are there make a flow table that the
freight operators sum as they would the rows themselves.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from haulage.functions import exact
from haulage.operators.freight import LANE_KEYS
from haulage.sources.versions import Versions


_LOCAL = "^file:/+"  # local places are written with one slash or with three


def input_files(spark: SparkSession, path: str) -> dict[str, str]:
    """Id (of place, size and time of change) -> place of each parquet file under ``path``."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    listing = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listFiles(at, True)
    out = {}
    while listing.hasNext():
        s = listing.next()
        place = s.getPath().toString()
        if place.endswith(".parquet") and not s.getPath().getName().startswith(("_", ".")):
            out[_hash(f"{re.sub(_LOCAL, 'file:/', s.getPath().toUri().toString())} {s.getLen()} {s.getModificationTime()}")] = place
    return out


def _hash(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def file_id() -> Column:
    """The same id for the file that a row comes from."""
    meta = F.col("_metadata")
    return F.sha2(F.concat_ws(" ", F.regexp_replace(meta["file_path"], _LOCAL, "file:/"), meta["file_size"].cast("string"),
                              F.unix_millis(meta["file_modification_time"]).cast("string")), 256)


class LaneStates:
    """The stored partial aggregates of a folder of flow files, in the folder ``states``."""

    def __init__(self, spark: SparkSession, flows: str, states: str):
        self.spark, self.flows, self.versions = spark, flows, Versions(spark, states)

    def refresh(self) -> list[str]:
        """Add the states of new files, forget those of files that are gone; returns the files read."""
        now = self.versions.current()
        known = now.info.get("files", {})
        files = input_files(self.spark, self.flows)
        new = {i: p for i, p in files.items() if i not in known}
        if not new and known.keys() == files.keys():
            return []
        folders, folder_of = dict(now.folders), {i: f for i, f in known.items() if i in files}
        if new:
            folder = self.versions.new_folder()
            rows = self.spark.read.parquet(*sorted(new.values()))
            (rows.withColumn("file", file_id()).groupBy("file", *LANE_KEYS, "year")
             .agg(F.sum("tons").alias("tons"), F.sum(exact("value")).alias("value"),
                  F.count(F.lit(1)).alias("rows")).write.parquet(self.versions.full(folder)))
            folders[folder] = folder
            folder_of |= dict.fromkeys(new, folder)
        used = set(folder_of.values())
        self.versions.commit(now, {k: f for k, f in folders.items() if f in used}, {"files": folder_of})
        return sorted(new.values())

    def table(self) -> DataFrame:
        """Flow rows (lane keys, year, tons, value) of the files that are there, one per file and lane."""
        now = self.versions.current()
        live = self.spark.createDataFrame([(i,) for i in now.info.get("files", {})], "file string")
        if not now.folders:
            raise FileNotFoundError(f"no states in {self.versions.path}")
        rows = self.spark.read.parquet(*[self.versions.full(f) for f in sorted(now.folders)])
        return rows.join(live, "file", "left_semi").select(*LANE_KEYS, "year", "tons", "value")
