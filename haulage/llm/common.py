"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import pathlib
import tempfile
import zipfile

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from haulage.session import scratch_path

# Rows in one Arrow batch. Texts can be long, so batches are kept small: the
# Python side holds one batch at a time.
ARROW_ROWS = 256

# Bytes of text that the vectorised functions take at once; they hold some 50
# bytes for each.
CHUNK_BYTES = 1 << 18

U64 = np.uint64


def prepare(spark: SparkSession) -> None:
    """Ready the session for Python tasks: small Arrow batches, so that a batch
    of long texts fits a worker, and this package sent to the executors."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) > ARROW_ROWS:
        spark.conf.set(key, str(ARROW_ROWS))
    sc = spark.sparkContext
    if sc.applicationId not in _SENT:
        root = pathlib.Path(__file__).resolve().parents[1]
        target = pathlib.Path(tempfile.mkdtemp(prefix="haulage-code-")) / "haulage_code.zip"
        with zipfile.ZipFile(target, "w") as z:
            for f in sorted(root.rglob("*.py")):
                z.write(f, f.relative_to(root.parent))
        sc.addPyFile(str(target))
        _SENT.add(sc.applicationId)


_SENT: set[str] = set()


def ddl(text: str) -> StructType:
    return StructType.fromDDL(text)


def store(df: DataFrame, kind: str, codec: str = "snappy") -> DataFrame:
    """Write ``df`` to the shared folder and read it back (cuts the lineage, so
    a lost executor costs a read and not a recomputation)."""
    path = scratch_path(df.sparkSession, kind)
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# What a Python worker remembers from task to task, by operator. Spark keeps a
# worker for later tasks of any kind, and its memory counts with the executor's.
_REMEMBERED: dict[str, dict] = {}


def remembered(owner: str) -> dict:
    """The dict in which ``owner`` keeps what outlives a task; emptied when the worker turns to other work."""
    return _REMEMBERED.setdefault(owner, {})


def forget(owner: str | None = None) -> None:
    """Empty what this worker remembers for others than ``owner``."""
    for name, held in _REMEMBERED.items():
        if name != owner:
            held.clear()


def give_back() -> None:
    """Return memory that this worker has freed to the system; else it stays with the idle worker."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


def lean(run, owner: str | None = None):
    """``run`` for mapInArrow, by a worker that holds no more than ``owner`` remembers before and after."""
    def inner(batches):
        forget(owner)
        try:
            yield from run(batches)
        finally:
            give_back()

    return inner


def annotate(df: DataFrame, text_col: str, make, added: str, keep: list[str] | None = None,
             owner: str | None = None) -> DataFrame:
    """``df`` plus the columns of the DDL string ``added``, computed from ``text_col``.

    ``make()`` runs once per task and returns a function that turns the text
    array of one batch into a list of pyarrow arrays, one per added column.
    ``keep`` names the columns that stay (all by default). A column of ``df``
    that has the name of an added column is replaced, whatever its case.
    ``owner`` names what the function remembers between tasks (``remembered``).
    No shuffle.
    """
    prepare(df.sparkSession)
    new = ddl(added)
    taken = {f.name.lower() for f in new.fields}
    kept = [c for c in (df.columns if keep is None else keep) if c.lower() not in taken]
    inputs = [F.col(f"`{c}`") for c in kept]
    if text_col in kept:
        at = kept.index(text_col)
    else:
        at = len(kept)
        inputs.append(F.col(f"`{text_col}`").alias("_input"))
    base = df.select(*inputs)
    n = len(kept)
    schema = StructType(base.schema.fields[:n] + new.fields)
    names = schema.names

    def run(batches):
        fn = make()
        for batch in batches:
            yield pa.RecordBatch.from_arrays(batch.columns[:n] + fn(batch.column(at)), names=names)

    return base.mapInArrow(lean(run, owner), schema)


def open_file(path: str):
    """A file of any store that the tasks reach: a shared mount, or what pyarrow opens (hdfs, s3, gs)."""
    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    if path.startswith("/"):
        return open(path, "rb")
    from pyarrow import fs
    store, name = fs.FileSystem.from_uri(path)
    return store.open_input_file(name)


def text_buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string array one after the other, and n+1 offsets; null counts as empty."""
    texts = texts.cast(pa.large_string()).fill_null("")
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    off = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    if len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, np.uint8)
    return data[off[0]:off[-1]], off - off[0]


def chunks(off: np.ndarray, limit: int = CHUNK_BYTES):
    """Row ranges (first, end) of about ``limit`` bytes; a longer row is a range of its own."""
    first, n = 0, len(off) - 1
    while first < n:
        end = int(np.searchsorted(off, off[first] + limit, side="right")) - 1
        end = min(max(end, first + 1), n)
        yield first, end
        first = end


# --- word hashes ------------------------------------------------------------

_RNG = np.random.default_rng(20240601)
_BYTE = _RNG.integers(0, 1 << 63, 256, dtype=np.uint64) * U64(2) + U64(1)
_BASE = 0x9E3779B97F4A7C13 | 3
_MASK = (1 << 64) - 1
_POW = [np.ones(1, U64)]
_INV = [np.ones(1, U64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least n of each."""
    if len(_POW[0]) < n:
        size = 1 << (n - 1).bit_length()
        for held, base in ((_POW, _BASE), (_INV, pow(_BASE, -1, 1 << 64))):
            out = np.ones(size, U64)
            have, step = 1, base
            while have < size:  # double: the second half is the first times base**have
                out[have:2 * have] = out[:have] * U64(step)
                step = step * step & _MASK
                have *= 2
            held[0] = out
    return _POW[0], _INV[0]


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser; spreads every input bit over the whole word."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
WHITE = np.zeros(256, bool)
WHITE[[0x20, 9, 10, 11, 12, 13]] = True


def words_of(data: np.ndarray, off: np.ndarray, is_word: np.ndarray):
    """Words of each row, a word being a longest run of bytes for which the table ``is_word`` is true.

    Returns (start, end, row, hash) arrays in text order. The hash covers the
    bytes with A-Z in lower case; equal words have equal hashes.
    """
    empty = np.zeros(0, np.int64)
    if len(data) == 0:
        return empty, empty, empty, np.zeros(0, U64)
    inside = is_word[data]
    first = np.zeros(len(data) + 1, bool)
    first[off] = True
    before = np.concatenate(([False], inside[:-1]))
    after = np.concatenate((inside[1:], [False]))
    start = np.flatnonzero(inside & (~before | first[:-1]))
    end = np.flatnonzero(inside & (~after | first[1:])) + 1
    power, inverse = _powers(len(data))
    total = np.zeros(len(data) + 1, U64)
    np.cumsum(_BYTE[_LOWER[data]] * power[:len(data)], out=total[1:])
    value = (total[end] - total[start]) * inverse[start]
    row = np.searchsorted(off, start, side="right") - 1
    return start, end, row, mix(value ^ (end - start).astype(U64))


_STEP = [U64(int(x)) for x in _RNG.integers(0, 1 << 63, 64, dtype=np.uint64) * U64(2) + U64(1)]


def shingles_of(row: np.ndarray, word: np.ndarray, n_rows: int, k: int = 5):
    """Hashes of each row's k-word shingles, in text order: (row, hash, first word).

    A row with fewer than k words, but at least one, has its whole sequence as
    its only shingle (its length enters the hash).
    """
    n = np.bincount(row, minlength=n_rows).astype(np.int64)
    begin = np.concatenate(([0], np.cumsum(n)))
    at = np.arange(len(word), dtype=np.int64)
    if len(word) == 0:
        return np.zeros(0, np.int64), np.zeros(0, U64), at
    full = at + k <= begin[row + 1]
    first = at[full]
    h = np.zeros(len(first), U64)
    for i in range(k):
        h += word[first + i] * _STEP[i]
    rows = row[first]
    short = np.flatnonzero((n > 0) & (n < k))
    if len(short):
        extra = np.zeros(len(short), U64)
        for i in range(k - 1):
            has = n[short] > i
            extra[has] += word[begin[short[has]] + i] * _STEP[i]
        extra += n[short].astype(U64) * _STEP[k]
        rows, h, first = np.concatenate((rows, short)), np.concatenate((h, extra)), np.concatenate((first, begin[short]))
        order = np.argsort(rows, kind="stable")
        rows, h, first = rows[order], h[order], first[order]
    return rows, mix(h), first
