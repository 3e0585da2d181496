import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from haulage.llm import op12_substring_dedup as op

from helpers import LONG, ROWS

SF = "/root/testdata/sf0.001"


def _plain(rows, width):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    count = Counter(tuple(w[i:i + width]) for w in words for i in range(len(w) - width + 1))
    out = []
    for (i, _), w in zip(rows, words):
        gone = {j for p in range(len(w) - width + 1) if count[tuple(w[p:p + width])] > 1 for j in range(p, p + width)}
        out.append((i, len(w), len(gone), " ".join(x for j, x in enumerate(w) if j not in gone)))
    return sorted(out, key=str)


def _got(spark, rows, **kw):
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("batch", F.lit(1)).withColumn("KEPT", F.lit("x"))
    out = op.remove_repeats(df, **kw).collect()
    for r in out:
        assert sum(s.end - s.first for s in r.spans) == r.n_removed
    return sorted(((r.id, r.n_words, r.n_removed, r.kept) for r in out), key=str)


def _texts(seed, n=60):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(300)] + ["É", "日本", "A", "a", " ", " x"]
    shared = [" ".join(rng.choices(vocab, k=rng.randint(3, 30))) for _ in range(6)]
    out = []
    for _ in range(n):
        parts = [rng.choice(shared) if rng.random() < .3 else "".join(w + rng.choice([" ", "\n", "  ", "\t"]) for w in rng.choices(vocab, k=rng.randint(0, 40)))
                 for _ in range(rng.randint(0, 4))]
        out.append(" ".join(parts))
    return out + out[:3] + [None, "", " \n "]


@pytest.mark.parametrize("width,batch,segment", [(3, 200, 50), (8, 1 << 20, 1 << 20), (1, 500, 7), (5, 1, 100)])
def test_against_brute_force(spark, width, batch, segment):
    rows = [(i if i % 9 else None, t) for i, t in enumerate(_texts(width))]
    assert _got(spark, rows, width=width, batch_bytes=batch, segment=segment) == _plain(rows, width)


def test_overlap_with_itself_and_exact_length(spark):
    rows = [(1, "a " * 36), (2, " ".join(f"x{i}" for i in range(35))), (3, "z " + " ".join(f"x{i}" for i in range(35)) + " q"),
            (4, " ".join(f"x{i}" for i in range(34))), (5, "a " * 35)]
    assert _got(spark, rows) == _plain(rows, 35)
    assert {r[0]: r[2] for r in _got(spark, rows)} == {1: 36, 2: 35, 3: 35, 4: 0, 5: 35}


def test_case_counts(spark):
    rows = [(1, "One " * 10), (2, "one " * 5 + "two"), (3, "ONE " * 5)]
    assert _got(spark, rows, width=5) == _plain(rows, 5)


def test_edge_rows_and_a_very_long_text(spark):
    rows = [(r[0], r[1]) for r in ROWS] + [(99, LONG.replace("word1 ", "other "))]
    assert _got(spark, rows, batch_bytes=1 << 16) == _plain(rows, 35)


def test_hot_passage_over_many_partitions(spark):
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(i, f"u{i} {passage} v{i}" if i % 3 else f"u{i} v{i}") for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(20)
    out = {r.id: (r.n_removed, r.kept) for r in op.remove_repeats(df).collect()}
    assert out == {i: (60 if i % 3 else 0, f"u{i} v{i}") for i in range(300)}


def test_empty_table(spark):
    assert _got(spark, []) == [] and _got(spark, [(1, None), (None, "a b")]) == [(1, 0, 0, ""), (None, 2, 0, "a b")]


def test_sketch_never_underestimates_and_spares_most(monkeypatch):
    monkeypatch.setattr(op, "CELL_BITS", 12)
    rng = np.random.default_rng(2)
    batches = [rng.integers(0, 2000, 900).astype(np.uint64) for _ in range(2)]
    every = np.concatenate(batches)
    made = []
    for i, b in enumerate(batches):
        h, n = np.unique(op.mix(b), return_counts=True)
        w = op.Windows(np.zeros(0, np.int64), np.zeros(0, np.int64), h, h, n)
        made.append((b, w, op.Sketch(w, 4, 2), f"b{i}"))
    rows = [r for _, _, s, name in made for r in s.parts(name)]
    answers = {name: {} for _, _, _, name in made}
    for seg in {r["bucket"] for r in rows}:
        t = pa.Table.from_pylist([r for r in rows if r["bucket"] == seg])
        for r in op.merge_sketches(t).to_pylist():
            answers[r["batch"]][seg] = r["bits"]
    value, times = np.unique(every, return_counts=True)
    again = set(op.mix(value[times > 1]).tolist())
    for _, w, s, name in made:
        flagged = s.repeated(answers[name])
        truly = np.array([h in again for h in w.h1.tolist()])
        assert flagged[truly].all() and flagged[~truly].mean() < 0.15


def test_query_against_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    want = [(i, n, g, hashlib.sha256(k.encode()).hexdigest()) for i, n, g, k in _plain(rows, 35)]
    assert sorted((tuple(r) for r in op.op12_substring_dedup(spark, SF).collect()), key=str) == sorted(want, key=str)
