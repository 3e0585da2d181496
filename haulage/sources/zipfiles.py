"""CSV members of zip archives as a Spark data source.

Spark's readers have no zip codec. This source reads each archive's central
directory (a few kilobytes at its end) to plan one partition per CSV member, and
a task streams its member through the decompressor block by block, so memory
depends on neither the archive's nor the member's size. Only the asked columns
are converted. Archives lie on any store that pyarrow opens (a shared mount,
hdfs, s3, gs); executors need this package and pyarrow.
"""

from __future__ import annotations

import posixpath
import zipfile
from fnmatch import fnmatch

import pyarrow as pa
import pyarrow.csv as pc
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from haulage.sources.files import FLOW_KEYS, FLOW_YEARS, flow_file_schema

BLOCK_BYTES = 1 << 20  # CSV text that a task holds at once


def open_store(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of ``path`` and the path inside it."""
    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    if path.startswith("/"):
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(path)


def archives(path: str) -> list[str]:
    """The zip files at ``path``: the file itself, or those directly in the folder."""
    store, at = open_store(path)
    info = store.get_file_info(at)
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    found = [info] if info.is_file else store.get_file_info(fs.FileSelector(at))
    return sorted(f.path for f in found if f.is_file and f.path.lower().endswith(".zip"))


class Member(InputPartition):
    """One CSV file inside an archive."""

    def __init__(self, archive: str, name: str):
        super().__init__((archive, name))
        self.archive, self.name = archive, name


class ZipCsvReader(DataSourceReader):
    def __init__(self, schema: T.StructType, options: dict):
        self.columns, self.path = schema.names, options["path"]
        self.pattern = options.get("member", "*.csv")

    def partitions(self) -> list[InputPartition]:
        store, _ = open_store(self.path)
        out = []
        for archive in archives(self.path):
            with store.open_input_file(archive) as f, zipfile.ZipFile(f) as z:
                out += [Member(archive, n) for n in z.namelist() if fnmatch(posixpath.basename(n).lower(), self.pattern)]
        return out

    def read(self, partition):
        if partition is None:  # no members at all
            return
        store, _ = open_store(self.path)
        convert = pc.ConvertOptions(include_columns=self.columns, include_missing_columns=True, strings_can_be_null=True,
                                    quoted_strings_can_be_null=False, column_types={c: pa.string() for c in self.columns})
        with store.open_input_file(partition.archive) as f, zipfile.ZipFile(f) as z, z.open(partition.name) as member:
            try:
                lines = pc.open_csv(member, read_options=pc.ReadOptions(block_size=BLOCK_BYTES, use_threads=False), convert_options=convert)
            except pa.ArrowInvalid as exc:
                if "Empty CSV" in str(exc):
                    return
                raise
            for batch in lines:
                if batch.num_rows:
                    yield batch


class ZipCsv(DataSource):
    """``spark.read.format("zipcsv")`` with the wanted columns as a schema of strings;
    option ``member`` is a pattern for member names (default ``*.csv``)."""

    @classmethod
    def name(cls) -> str:
        return "zipcsv"

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return ZipCsvReader(schema, self.options)


def read_zip_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The CSV members of the archives at ``path`` with the types of ``schema``: a
    value that does not fit its type is null, and so is a column that a member lacks."""
    spark.dataSource.register(ZipCsv)
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    df = spark.read.format("zipcsv").schema(text).load(path)
    return df.select(*[F.trim(F.col(f"`{f.name}`")).try_cast(f.dataType).alias(f.name) if f.dataType != T.StringType()
                       else F.col(f"`{f.name}`") for f in schema.fields])


def read_flow_zip(spark: SparkSession, path: str, years=FLOW_YEARS) -> DataFrame:
    """Freight-flow rows of all CSV members, only the code and per-year measure columns."""
    keep = [*FLOW_KEYS, *[f"tons_{y}" for y in years], *[f"value_{y}" for y in years]]
    return read_zip_csv(spark, path, T.StructType([flow_file_schema(years)[c] for c in keep]))


def write_zip_csv(df: DataFrame, path: str, member_rows: int = 1_000_000) -> int:
    """One archive per task with members of at most ``member_rows`` rows; returns the number of members.

    Rows are streamed into the archive. A repeated task writes the same file anew.
    """
    store, at = open_store(path)
    store.create_dir(at)
    schema = pa.schema([(c, pa.string()) for c in df.columns])

    def write(batches):
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        n = 0
        store_, at_ = open_store(path)
        with store_.open_output_stream(f"{at_}/part-{part:05d}.zip") as out, zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
            writer = member = None
            held = 0
            for batch in batches:
                for first in range(0, batch.num_rows, member_rows):
                    piece = batch.slice(first, member_rows)
                    if writer is None or held + piece.num_rows > member_rows:
                        if writer is not None:
                            writer.close()
                            member.close()
                        member = z.open(f"flows/part-{part:05d}-{n:04d}.csv", "w", force_zip64=True)
                        writer, held, n = pc.CSVWriter(member, schema), 0, n + 1
                    writer.write_batch(pa.RecordBatch.from_arrays(piece.columns, schema=schema))
                    held += piece.num_rows
            if writer is not None:
                writer.close()
                member.close()
        yield pa.RecordBatch.from_pydict({"members": pa.array([n], pa.int64())})

    text = df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])
    return text.mapInArrow(write, "members long").agg(F.sum("members")).first()[0] or 0
