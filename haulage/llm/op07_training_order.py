"""Training-order materialisation: token sequences in a keyed random order, in fixed-stride shards.

1. Texts are encoded, each followed by the end mark, and a task's stream of
   ids is cut into sequences of LENGTH ids. Nothing is left out; a task's last
   sequence is filled up with end marks. The sequences are stored in
   compressed packs, numbered by the task and by how many sequences of the
   task came before.
2. Offsets of the tasks (one row per task) turn that into a dense index 0..N-1.
3. A keyed Feistel permutation maps index to slot. Its domain is the next even
   power of two; a value beyond N is mapped again until it falls below N
   (cycle-walking), so the map is a bijection on 0..N-1 and needs no table.
4. Slots are range-partitioned: shard s holds slots s * shard_slots onwards, in
   order, and is written by one task through Spark's commit protocol.

A record is LENGTH + 6 little-endian 16-bit words: 1 or 0 for whether the
document in which the sequence begins has an id, that id (4 words), the ids, and
the word 65535. Slot t is at byte (t mod shard_slots) * stride of shard
t // shard_slots, so a reader can resume at any slot and reads on sequentially.
The manifest beside the shards holds what a reader needs to know.

Edge rows: null and empty texts give no ids and no end mark. A null document
id is read back as null, any other as it was. Repeated rows are all encoded. An empty
table gives no shards and an empty result. Other columns are not read. The
same input files, settings and key give the same order.
"""

from __future__ import annotations

import base64
import json

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from haulage.llm.common import mix, open_file, prepare, store
from haulage.llm.registry import query, table
from haulage.session import scratch_path

LENGTH = 2048          # ids in a sequence
SHARD_SLOTS = 4096     # sequences in a shard, some 17 MB
PACK = 512             # sequences in a stored pack
BROADCAST_TASKS = 1_000_000  # rows of the tasks' offsets that may be broadcast, 16 bytes each
ROUNDS = 6
KEY = 20240229
END_OF_RECORD = b"\xff\xff"
HEAD = 5               # words before the ids: has an id, the id
MANIFEST = "_order.json"
U64 = np.uint64


def stride(length: int) -> int:
    return 2 * (HEAD + length + 1)


def slots_of(index: np.ndarray, n: int, key: int) -> np.ndarray:
    """Slot of each index in 0..n-1: Feistel network with cycle-walking."""
    half = max(1, ((n - 1).bit_length() + 1) // 2)
    low = U64((1 << half) - 1)
    keys = mix(np.arange(1, ROUNDS + 1, dtype=np.uint64) * U64(0x9E3779B97F4A7C15) + U64(key & (1 << 64) - 1))
    out = index.astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        x = out[todo]
        left, right = x >> U64(half), x & low
        for k in keys:
            left, right = right, left ^ (mix(right + k) & low)
        out[todo] = left << U64(half) | right
        todo = todo[out[todo] >= U64(n)]
    return out.astype(np.int64)


class _Stream:
    """Cuts a stream of ids into records."""

    def __init__(self, length: int):
        self.length, self.ids, self.owner, self.size, self.records = length, [], [], 0, []

    def add(self, doc_id, ids: list[int]) -> None:
        self.ids.append(np.asarray(ids, np.uint16))
        self.owner.append((self.size, doc_id))
        self.size += len(ids)
        if self.size >= 64 * self.length:
            self.cut(self.size // self.length)

    def cut(self, n: int) -> None:
        flat = np.concatenate(self.ids)
        begins = np.array([b for b, _ in self.owner])
        docs = np.array([d or 0 for _, d in self.owner], np.int64)
        known = np.array([d is not None for _, d in self.owner], np.uint16)
        first = np.searchsorted(begins, np.arange(n) * self.length, side="right") - 1
        rows = np.concatenate((known[first].reshape(n, 1), docs[first].view(np.uint16).reshape(n, 4),
                               flat[:n * self.length].reshape(n, self.length)), axis=1)
        self.records.extend(r.tobytes() for r in rows)
        rest = flat[n * self.length:]
        self.ids, self.owner, self.size = [rest], [(0, self.owner[-1][1])], len(rest)

    def finish(self, fill: int) -> None:
        if self.size:
            self.ids.append(np.full(-self.size % self.length, fill, np.uint16))
            self.size += len(self.ids[-1])
            self.cut(self.size // self.length)


def sequences(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
              length: int = LENGTH) -> DataFrame:
    """Stored packs of records: (part, before, n, pack)."""
    prepare(docs.sparkSession)
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))

    def encode(batches):
        import tiktoken
        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        if max(ranks.values()) >= 65534:
            raise ValueError("ids of this vocabulary need more than 16 bits")
        end = max(ranks.values()) + 1
        encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        zstd = pa.Codec("zstd", compression_level=9)
        part = TaskContext.get().partitionId()
        stream, before = _Stream(length), 0

        def packs(least):
            nonlocal before
            while len(stream.records) >= least:
                taken, stream.records = stream.records[:PACK], stream.records[PACK:]
                yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([before]), pa.array([len(taken)], pa.int32()),
                                                  pa.array([zstd.compress(b"".join(taken), asbytes=True)], pa.binary())],
                                                 names=["part", "before", "n", "pack"])
                before += len(taken)
        for batch in batches:
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if text:
                    stream.add(i, encoding.encode_ordinary(text) + [end])
            yield from packs(PACK)
        stream.finish(end)
        yield from packs(1)

    made = rows.mapInArrow(encode, "part int, before long, n int, pack binary")
    return store(made, "sequences")


def write_shards(packs: DataFrame, path: str, key: int = KEY, length: int = LENGTH, shard_slots: int = SHARD_SLOTS) -> int:
    """Write the stored packs as shards under ``path``, and their manifest; returns the number of sequences."""
    n = packs.agg(F.sum("n")).collect()[0][0] or 0
    if n:
        _write_shards(packs, path, n, key, length, shard_slots)
    _write_manifest(packs.sparkSession, path, {"sequences": n, "length": length, "key": key, "shard_slots": shard_slots, "stride": stride(length)})
    return n


def _manifest_at(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{MANIFEST}")
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _write_manifest(spark: SparkSession, path: str, what: dict) -> None:
    """Written last: shards without a manifest are unfinished."""
    at, store_ = _manifest_at(spark, path)
    stream = store_.create(at, True)
    try:
        stream.write(bytearray(json.dumps(what).encode()))
    finally:
        stream.close()


def read_manifest(spark: SparkSession, path: str) -> dict:
    """sequences, length, key, shard_slots and stride of the shards under ``path``."""
    at, store_ = _manifest_at(spark, path)
    stream = store_.open(at)
    try:
        return json.loads(bytes(stream.readAllBytes()))
    finally:
        stream.close()


def _write_shards(packs: DataFrame, path: str, n: int, key: int, length: int, shard_slots: int) -> None:
    # one row per task of the encoding
    totals = packs.groupBy("part").agg(F.sum("n").alias("total"))
    base = F.sum("total").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    totals = totals.select("part", F.coalesce(base, F.lit(0)).alias("base"))
    if totals.count() <= BROADCAST_TASKS:  # else the packs are shuffled
        totals = F.broadcast(totals)
    indexed = packs.join(totals, "part").select((F.col("base") + F.col("before")).alias("first"), "n", "pack")
    width = 2 * (HEAD + length)

    def permute(batches):
        big, one = pa.Codec("zstd"), pa.Codec("zstd", compression_level=6)
        for batch in batches:
            for first, m, pack in zip(*(c.to_pylist() for c in batch.columns)):
                raw = big.decompress(pack, m * width, asbytes=True)
                slot = slots_of(np.arange(first, first + m), n, key)
                small = [one.compress(raw[i * width:(i + 1) * width], asbytes=True) for i in range(m)]
                yield pa.RecordBatch.from_arrays([pa.array((slot // shard_slots).astype(np.int32)), pa.array(slot), pa.array(small, pa.binary())],
                                                 names=["shard", "slot", "record"])

    def unpack(batches):
        zstd = pa.Codec("zstd")
        for batch in batches:
            raw = [zstd.decompress(r, width, asbytes=True) for r in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(raw, pa.binary())], names=["value"])

    shards = -(-n // shard_slots)
    (indexed.mapInArrow(permute, "shard int, slot long, record binary")
     .repartitionById(shards, F.col("shard")).sortWithinPartitions("slot").select("record")
     .mapInArrow(unpack, "value binary").select(F.col("value").cast("string").alias("value"))
     .write.option("encoding", "ISO-8859-1").option("lineSep", END_OF_RECORD.decode("latin-1")).text(path))


_ROWS = "slot long, shard int, at long, doc_id long, n_tokens int, ids binary"


def read_slots(spark: SparkSession, path: str, first: int = 0, last: int | None = None) -> DataFrame:
    """Records of slots first..last-1, read sequentially from the shards that hold them."""
    prepare(spark)
    order = read_manifest(spark, path)
    n, length, shard_slots = order["sequences"], order["length"], order["shard_slots"]
    last = n if last is None else min(last, n)
    if n == 0 or first >= last:
        return spark.createDataFrame([], _ROWS)
    step = stride(length)
    files = (spark.read.format("binaryFile").load(path)
             .select("path", F.regexp_extract("path", "part-([0-9]+)-[^/]*$", 1).cast("int").alias("shard"))
             .where(F.col("shard").between(first // shard_slots, (last - 1) // shard_slots)))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def read(batches):
        for batch in batches:
            for name, shard in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                low = max(first, shard * shard_slots)
                high = min(last, (shard + 1) * shard_slots)
                with open_file(name) as f:
                    f.seek((low - shard * shard_slots) * step)
                    for at in range(low, high, 512):
                        m = min(512, high - at)
                        raw = f.read(m * step)
                        if len(raw) != m * step:
                            raise ValueError(f"shard {shard} ends early")
                        rows = np.frombuffer(raw, np.uint16).reshape(m, HEAD + length + 1)
                        if (rows[:, -1] != 65535).any():
                            raise ValueError(f"shard {shard} is damaged")
                        docs = np.ascontiguousarray(rows[:, 1:HEAD]).view(np.int64)[:, 0]
                        ids = np.ascontiguousarray(rows[:, HEAD:-1])
                        slot = np.arange(at, at + m)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(slot), pa.array(np.full(m, shard), pa.int32()), pa.array((slot - shard * shard_slots) * step),
                             pa.array(docs, mask=rows[:, 0] == 0), pa.array(np.full(m, length), pa.int32()),
                             pa.array([r.tobytes() for r in ids], pa.binary())],
                            names=["slot", "shard", "at", "doc_id", "n_tokens", "ids"])

    return files.repartition(parts, "shard").mapInArrow(read, _ROWS)


@query("op7_training_order")
def op7_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    packs = sequences(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    path = scratch_path(spark, "shards")
    write_shards(packs, path)
    return read_slots(spark, path).select("slot", "shard", "at", "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"))
