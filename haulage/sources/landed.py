"""Landed service responses as JSON files: typed read, outcome per record, quarantine.

A response that was cut off, or that holds an error in place of data, must not
stop a load nor vanish. ``ingest`` parses the files once with an explicit schema
and a corrupt-record column, gives every record an outcome, and writes all of
them in one pass, a folder per outcome. Good rows and rejects are then read from
that table; the outcome is a folder, so neither reads the other's files.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

OK, MALFORMED = "ok", "malformed"
_RAW, _FILE, _OUTCOME = "_raw", "_file", "_outcome"


@dataclass
class Landed:
    """``rows``: the good records with the columns of the schema; ``rejects``: (file, reason, raw)."""
    rows: DataFrame
    rejects: DataFrame

    def reject_counts(self) -> DataFrame:
        """(reason, rejects) of the load."""
        return self.rejects.groupBy("reason").agg(F.count(F.lit(1)).alias("rejects"))


def land(raw: DataFrame, path: str, keys: list[str], payload: str = "payload") -> None:
    """Write response bodies as they came: a folder per request key, one response per
    file; without keys one response per line."""
    body = raw.select(*keys, F.col(payload).alias("value"))
    (body.write.partitionBy(*keys) if keys else body.write).text(path)


def classify(required: dict[str, Column]) -> Column:
    """Outcome of a parsed record: malformed, the first reason whose condition does not hold, or ok."""
    outcome = F.when(F.col(_RAW).isNotNull(), F.lit(MALFORMED))
    for reason, holds in required.items():
        outcome = outcome.when(~F.coalesce(holds, F.lit(False)), F.lit(reason))
    return outcome.otherwise(F.lit(OK))


def read_marked(spark: SparkSession, path: str, schema: T.StructType, required: dict[str, Column],
                multi_line: bool = False) -> DataFrame:
    """All records of the files under ``path`` with their file, raw text (malformed ones) and outcome.

    ``multi_line``: a file is one response (an object, or an array of records);
    else every line is one. Columns of folder names come along.
    """
    full = T.StructType([*schema.fields, T.StructField(_RAW, T.StringType())])
    df = (spark.read.schema(full).option("columnNameOfCorruptRecord", _RAW).option("mode", "PERMISSIVE")
          .option("multiLine", multi_line).json(path))
    return (df.withColumn(_FILE, F.col("_metadata.file_path")).withColumn(_OUTCOME, classify(required))
            .withColumn(_RAW, F.coalesce(_RAW, F.when(F.col(_OUTCOME) != OK, F.to_json(F.struct(*schema.names))))))


def ingest(spark: SparkSession, path: str, out: str, schema: T.StructType, required: dict[str, Column],
           multi_line: bool = False) -> Landed:
    """Parse the files under ``path`` once into the table ``out`` and return its good rows and its rejects."""
    marked = read_marked(spark, path, schema, required, multi_line)
    marked.write.partitionBy(_OUTCOME).parquet(out)
    return read_ingested(spark, out, marked.schema)


def read_ingested(spark: SparkSession, out: str, schema: T.StructType | None = None) -> Landed:
    """The good rows and rejects of a load that ``ingest`` wrote."""
    stored = (spark.read if schema is None else spark.read.schema(schema)).parquet(out)
    rows = stored.where(F.col(_OUTCOME) == OK).drop(_RAW, _FILE, _OUTCOME)
    rejects = stored.where(F.col(_OUTCOME) != OK).select(
        F.col(_FILE).alias("file"), F.col(_OUTCOME).alias("reason"), F.col(_RAW).alias("raw"))
    return Landed(rows, rejects)
