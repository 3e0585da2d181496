import random

import numpy as np
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from haulage.llm import op03_prefix_groups as op

from helpers import ROWS, classes, docs, shingles

SF = "/root/testdata/sf0.001"


def _got(spark, rows, extra=None):
    df = docs(spark, rows) if extra is None else extra
    return op.link_classes(df).collect()


def _check(spark, pairs):
    rows = [(i, t, "en", "a", 1) for i, t in pairs]
    out = _got(spark, rows)
    want = sorted(((i, len(shingles(t)), c) for (i, t), c in zip(pairs, classes(pairs))), key=str)
    assert sorted(((r.id, r.n_shingles, r.class_id) for r in out), key=str) == want


def test_sizes_and_classes_of_edge_rows(spark):
    _check(spark, [(r[0], r[1]) for r in ROWS])


def test_random_edits_around_the_threshold(spark):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(300)]
    passage = [rng.choice(vocabulary) for _ in range(60)]
    pairs, n = [], 0
    for _ in range(14):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([6, 20, 60, 120]))]
        if rng.random() < 0.6:  # a passage that many documents share
            base = base + passage
        for _ in range(rng.choice([1, 2, 6])):
            text = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                at = rng.randrange(len(text))
                kind = rng.random()
                if kind < 0.5:
                    text[at] = rng.choice(vocabulary)
                elif kind < 0.75:
                    text.insert(at, rng.choice(vocabulary))
                elif len(text) > 1:
                    del text[at]
            pairs.append((n, " ".join(text)))
            n += 1
    rng.shuffle(pairs)
    _check(spark, pairs)


def test_chain_of_links(spark):
    """Neighbours link, the ends don't: all are one class."""
    words = [f"c{i}" for i in range(130)]
    _check(spark, [(i, " ".join(words[4 * i:4 * i + 60])) for i in range(17)])


def test_link_at_exactly_the_threshold(spark):
    # 5-word shingles of 104 words: 100; replacing the last words changes as many shingles
    a = [f"a{i}" for i in range(94)]
    exact = a[:84] + [f"b{i}" for i in range(10)]  # 80 common of 100
    less = a[:83] + [f"c{i}" for i in range(11)]
    x, y = shingles(" ".join(a)), shingles(" ".join(exact))
    assert 100 * len(x & y) >= 80 * len(x | y) or len(x & y) == 80
    _check(spark, [(1, " ".join(a)), (2, " ".join(exact)), (3, " ".join(less)), (4, " ".join(a[:76])), (5, " ".join(a[:80]))])


def test_one_document_of_each_class_stays(spark):
    out = _got(spark, None)
    by_class = {}
    for r in out:
        if r.stays and r.n_shingles:
            by_class.setdefault((r.class_id, r.n_shingles if r.class_id is None else 0), set()).add(r.row_key)
    assert all(len(keys) == 1 for keys in by_class.values())
    assert all(r.stays for r in out if r.n_shingles == 0)


def test_repeated_rows_are_one_set(spark, monkeypatch):
    """Each set is exploded and verified once, however often its row is repeated."""
    stored = {}
    store = op.store

    def noted(df, kind, *args):
        out = store(df, kind, *args)
        stored[kind] = out
        return out
    monkeypatch.setattr(op, "store", noted)
    text = " ".join(f"r{i}" for i in range(60))
    # id 1 has a second text: its set has a row of its own to stand for it, or none
    _check(spark, [(1, text)] * 30 + [(2, text + " end")] * 20 + [(1, "other words that are not like those above at all")])
    sigs = [r.sig for r in stored["tokens"].select("sig").collect()]
    assert len(sigs) == len(set(sigs)) == 2


def test_rows_without_id_link_like_others(spark):
    """A set that only rows with a null id have links, joins classes and is thinned out."""
    chain, alone = [f"n{i}" for i in range(130)], [f"m{i}" for i in range(60)]
    part = lambda w, a: " ".join(w[a:a + 60])
    rows = [(5, part(chain, 0)), (None, part(chain, 5)), (9, part(chain, 10)), (None, part(alone, 0)), (None, part(alone, 0) + " end")]
    out = _got(spark, [(i, t, "en", "a", 1) for i, t in rows])
    assert sorted(((r.id, r.class_id) for r in out), key=str) == sorted([(5, 5), (9, 5), (None, 5), (None, None), (None, None)], key=str)
    assert sum(r.stays for r in out if r.class_id == 5) == 1 and sum(r.stays for r in out if r.class_id is None) == 1


def test_empty_table_and_clashing_columns(spark):
    assert _got(spark, []) == []
    extra = docs(spark).withColumn("sig", F.lit("x")).withColumn("token", F.lit(1)).withColumn("row_key", F.lit(2))
    assert len(_got(spark, None, extra)) == len(ROWS)


def test_local_counts_give_the_same_shared_tokens():
    """A token counted within a batch and a token looked up afterwards count alike."""
    import pyarrow as pa
    texts = [" ".join(f"x{i}" for i in range(20)) + f" y{j}" for j in range(op.LOCAL + 3)] + [" ".join(f"z{i}" for i in range(30))]
    batches = lambda size: [pa.RecordBatch.from_arrays([pa.array(texts[i:i + size])], names=["text"])
                            for i in range(0, len(texts), size)]
    sums = []
    for size in (1, 4, len(texts)):
        rows = pa.Table.from_batches(list(op._prefix_rows(iter(batches(size))))).sort_by("token")
        total = {}
        for part in (1, 3, 1000):
            total = {}
            for b in op._shared_rows(iter(rows.to_batches(max_chunksize=part))):
                for s, w in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                    total[s] = total.get(s, 0) + w
            sums.append(total)
    assert all(s == sums[0] for s in sums) and len(sums[0]) == op.LOCAL + 3


def test_query_against_brute_force(spark):
    t = pq.read_table(f"{SF}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    pairs = [(r["doc_id"], r["text"]) for r in t]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in op.op3_jaccard_classes(spark, SF).collect()}
    assert got == {i: (len(shingles(x)), c) for (i, x), c in zip(pairs, classes(pairs))}


def test_needed_overlap_is_exact():
    n = np.arange(1, 500)
    assert all(100 * k >= 80 * x > 100 * (k - 1) for x, k in zip(n.tolist(), op.needed(n).tolist()))
