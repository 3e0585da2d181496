import numpy as np
import public_tokenizers
import pytest
import tiktoken

from haulage.llm import op06_byte_bpe, op07_training_order as op
from haulage.session import scratch_path

from helpers import ROWS, docs

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=op06_byte_bpe.read_ranks(PATH), special_tokens={})


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 17, 1000, 65537])
def test_slots_are_a_bijection_that_depends_on_the_key(n):
    a = op.slots_of(np.arange(n), n, 1)
    assert sorted(a.tolist()) == list(range(n))
    if n > 100:
        assert (a != op.slots_of(np.arange(n), n, 2)).mean() > 0.9 and (a == np.arange(n)).mean() < 0.05


def _run(spark, rows, partitions=3, length=16, shard_slots=7, key=5):
    packs = op.sequences(docs(spark, rows).repartition(partitions), PATH, public_tokenizers.PATTERN, length=length)
    path = scratch_path(spark, "shards")
    n = op.write_shards(packs, path, key=key, length=length, shard_slots=shard_slots)
    assert op.read_manifest(spark, path) == {"sequences": n, "length": length, "key": key, "shard_slots": shard_slots, "stride": op.stride(length)}
    return path, n


def test_every_id_is_in_one_slot(spark):
    path, n = _run(spark, None)
    rows = op.read_slots(spark, path).collect()
    assert sorted(r.slot for r in rows) == list(range(n))
    assert all(r.shard == r.slot // 7 and r["at"] == r.slot % 7 * op.stride(16) for r in rows)
    got = np.concatenate([np.frombuffer(r.ids, np.uint16) for r in rows])
    want = [i for r in ROWS if r[1] for i in [*LIBRARY.encode_ordinary(r[1]), 50256]]
    got, want = np.bincount(got, minlength=50257), np.bincount(want, minlength=50257)
    assert (got[:50256] == want[:50256]).all() and 0 <= got[50256] - want[50256] < 3 * 16  # fill at three tasks' ends


def test_order_in_one_task_follows_the_permutation(spark):
    path, n = _run(spark, ROWS[:5], partitions=1)
    slots = op.slots_of(np.arange(n), n, 5)
    by_slot = {r.slot: r for r in op.read_slots(spark, path).collect()}
    stream = np.concatenate([np.frombuffer(by_slot[s].ids, np.uint16) for s in slots.tolist()]).tolist()
    begins = {r.doc_id for r in by_slot.values()}
    assert begins <= {r[0] for r in ROWS[:5]}
    texts = [r[1] for r in ROWS[:5] if r[1]]
    parts = {tuple(LIBRARY.encode_ordinary(t) + [50256]) for t in texts}
    got, start = [], 0
    for i, x in enumerate(stream):
        if x == 50256 and i >= start:
            got.append(tuple(stream[start:i + 1]))
            start = i + 1
    assert parts <= set(got)


def test_reading_resumes_at_any_slot(spark):
    path, n = _run(spark, None)
    whole = {r.slot: bytes(r.ids) for r in op.read_slots(spark, path).collect()}
    for first, last in ((0, 1), (5, 16), (n - 3, n + 10), (n, n + 1)):
        part = {r.slot: bytes(r.ids) for r in op.read_slots(spark, path, first, last).collect()}
        assert part == {s: x for s, x in whole.items() if first <= s < last}


def test_null_id_and_empty_table(spark):
    path, n = _run(spark, [(None, "only text here", "en", "a", 1), (1, None, "en", "a", 0), (2, "", "en", "a", 0)], partitions=1)
    rows = op.read_slots(spark, path).collect()
    assert n == 1 and rows[0].doc_id is None
    path, n = _run(spark, [])
    assert n == 0 and op.read_slots(spark, path).collect() == []


def test_ids_of_any_value_come_back(spark):
    ids = [-7, -1, 0, 65535, (1 << 63) - 1, -(1 << 63), None]
    path, _ = _run(spark, [(i, f"text number {k} " * 40, "en", "a", 1) for k, i in enumerate(ids)], partitions=1)
    assert {r.doc_id for r in op.read_slots(spark, path).collect()} == set(ids)


def test_damaged_shard_is_noticed(spark):
    import glob
    path, n = _run(spark, None)
    name = sorted(glob.glob(path.replace("file:", "") + "/part-*"))[0]
    raw = bytearray(open(name, "rb").read())
    raw[op.stride(16) - 1] = 0
    open(name, "wb").write(bytes(raw))
    with pytest.raises(Exception, match="damaged|Checksum"):
        op.read_slots(spark, path).collect()


def test_query_covers_the_documents(spark):
    rows = op.op7_training_order(spark, "/root/testdata/sf0.001").collect()
    assert sorted(r.slot for r in rows) == list(range(len(rows))) and len({r.ids_sha256 for r in rows}) > len(rows) // 2
