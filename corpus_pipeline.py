"""Corpus preparation in five stages, each on what its predecessor kept.

Language identification, near-duplicate removal, benchmark decontamination,
masking of secrets, and encoding. Every stage takes (spark, docs, sf_dir) and
returns a DataFrame; ``run`` writes it as Parquet to the shared folder and
reads it again as the next stage's documents.

All stages but the last return the columns of ``documents``; other columns of
their input are dropped, whatever their names. Null and empty texts: language
identification rejects a document without any evidence; the other stages keep
it. Null ids: such rows are kept and filtered like others. Of repeated rows one
stays, as of any group of near copies. Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulage.llm import op01_language_id, op02_secret_crf, op03_prefix_groups, op06_byte_bpe, op09_decontaminate
from haulage.session import scratch_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]

# Row keys that may be broadcast, at most: 8 bytes each, so some 2 MB.
BROADCAST_KEYS = 200_000


def _documents(docs: DataFrame) -> DataFrame:
    return docs.select(*COLUMNS)


def _sized(keys: DataFrame) -> DataFrame:
    """``keys`` marked for broadcast if they are counted to be few; else Spark joins by shuffle."""
    return F.broadcast(keys) if keys.count() <= BROADCAST_KEYS else keys


def _without(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """``docs`` (with row_key) less the rows whose key is listed."""
    return docs.join(_sized(keys), "row_key", "left_anti")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the known languages."""
    docs = _documents(docs)
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    rejected = op01_language_id.identify(docs, pages).where("not accepted").select("row_key").distinct()
    return _without(docs.withColumn("row_key", op01_language_id.row_key(docs)), rejected).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each link class of the shingle join: the one of smallest id."""
    docs = _documents(docs)
    classes = op03_prefix_groups.link_classes(docs)
    keyed = docs.withColumn("row_key", F.xxhash64("doc_id", "text"))
    goes = classes.where("not stays").select("row_key").distinct()
    again = classes.where("stays and n_shingles > 0").groupBy("row_key").agg(F.count("*").alias("c")).where("c > 1").select("row_key")
    kept = _without(keyed, goes)
    if again.isEmpty():
        return kept.select(*COLUMNS)
    again = _sized(again)
    once = kept.join(again, "row_key", "left_anti")
    repeated = kept.join(again, "row_key", "left_semi").dropDuplicates(["row_key"])
    return once.unionByName(repeated).select(*COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = op09_decontaminate.find_leaks(_documents(docs), benchmark)
    return found.where(F.size("leaks") == 0).select(*COLUMNS)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret found replaced by a mark."""
    docs = _documents(docs)
    found = op02_secret_crf.find_secrets(docs, op02_secret_crf.learn(docs))
    masked = found.withColumn("masked", op02_secret_crf.mask(F.col("text"), F.col("spans")))
    n_chars = F.when(F.size("spans") > 0, F.length("masked").cast("long")).otherwise(F.col("n_chars"))
    return masked.select("doc_id", F.col("masked").alias("text"), "lang", "source", n_chars.alias("n_chars"))


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document; ``intact`` says that they decode to the text."""
    encoder = op06_byte_bpe.public_encoder()
    back = op06_byte_bpe.round_trip(_documents(docs), encoder)
    text = F.coalesce("text", F.lit("")).cast("binary")
    return back.select("doc_id", "lang", "source", "n_chars", F.size("ids").cast("long").alias("n_tokens"), "ids",
                       (F.col("decoded") == text).alias("intact"))


STAGES = [
    ("language_id", language_id),
    ("ngram_jaccard_join", near_duplicates),
    ("benchmark_decontamination", decontamination),
    ("secret_scan", secret_scan),
    ("byte_bpe", byte_bpe),
]

# SQL expresses neither the trained models nor byte-pair merges; tests compare
# the rows with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
