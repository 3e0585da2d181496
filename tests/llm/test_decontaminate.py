import collections
import random

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import regex
from pyspark.sql import functions as F

from haulage.llm import op09_decontaminate as op

from helpers import ROWS, docs

SF = "/root/testdata/sf0.001"
BENCH = "item_id long, text string"


def _words(text):
    return regex.findall(r"[0-9a-z\u0080-\U0010ffff]+", (text or "").lower())


def _bag(words, k):
    return collections.Counter(tuple(words[i:i + k]) for i in range(len(words) - k + 1))


def brute(text, items):
    """Best similarity of each item with any window of its size."""
    w, out = _words(text), {}
    for i, t in items:
        v = _words(t)
        if not v or not w:
            continue
        size, k = min(len(v), len(w)), min(5, len(v))
        if size < k:
            continue
        bag = _bag(v, k)
        best = max(op.weighted_similarity(_bag(w[s:s + size], k), bag) for s in range(len(w) - size + 1))
        if best >= 0.8:
            out[i] = max(best, out.get(i, 0))
    return out


def test_random_passages_with_edits():
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(200)]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([1, 3, 4, 5, 8, 30, 50, 60])))) for i in range(25)]
    items += [(100, items[3][1]), (101, ""), (102, None), (103, "rep " * 40)]
    index = op.Items([i for i, _ in items], [t for _, t in items])
    texts = [None, "", "w1", "rep " * 39, "rep " * 200]
    for _ in range(60):
        words = [rng.choice(vocabulary) for _ in range(rng.choice([0, 3, 40, 200]))]
        for _ in range(rng.choice([1, 2])):
            passage = _words(rng.choice(items)[1])
            for _ in range(rng.choice([0, 0, 1, 2])):
                if passage:
                    passage[rng.randrange(len(passage))] = "changed"
            at = rng.randrange(len(words) + 1)
            words[at:at] = passage
        texts.append(rng.choice([" ", ", ", "\n"]).join(words).upper())
    got = op.leaks_in(index, pa.array(texts, pa.string()))
    for text, found in zip(texts, got):
        want = brute(text, items)
        have = {x["item_id"]: x["similarity"] for x in found}
        long = {i for i, t in items if len(_words(t)) >= 20}
        assert set(have) <= set(want)
        assert all(abs(have[i] - want[i]) < 1e-12 or have[i] <= want[i] for i in have)
        # every passage of full size is found; a fingerprint of a handful of shingles may lie beyond the radius
        assert {i for i, s in want.items() if s == 1.0 or i in long} <= set(have)


def test_multi_index_finds_all_within_the_radius():
    rng = np.random.default_rng(8)
    prints = rng.integers(0, 1 << 63, 50, dtype=np.uint64)
    probes = prints.repeat(20)
    for i in range(len(probes)):
        for b in rng.choice(64, int(rng.integers(0, 25)), replace=False):
            probes[i] ^= np.uint64(1) << np.uint64(b)
    far = np.bitwise_count(probes[:, None] ^ prints[None, :])
    assert sorted(map(tuple, op.MultiIndex(prints).within(probes).tolist())) == sorted(zip(*np.nonzero(far <= op.RADIUS)))


def test_blocks_of_items_change_nothing(spark):
    bench = spark.createDataFrame([(i, r[1]) for i, r in enumerate(ROWS[:10])] + [(None, None)], BENCH)
    results = []
    for size in (1, 3, 1000):
        out = op.find_leaks(docs(spark), bench, block_items=size).collect()
        results.append(sorted((str(r.doc_id), str(r.text)[:50], sorted((x.item_id, round(x.similarity, 9)) for x in r.leaks)) for r in out))
    assert results[0] == results[1] == results[2] and len(results[0]) == len(ROWS)


def test_empty_tables_and_clashing_columns(spark):
    bench = spark.createDataFrame([], BENCH)
    assert all(r.leaks == [] for r in op.find_leaks(docs(spark), bench).collect())
    assert op.find_leaks(docs(spark, []), bench).collect() == []
    out = op.find_leaks(docs(spark).withColumn("Leaks", F.lit(1)), bench)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "leaks"]


def test_query_against_brute_force(spark):
    d = pq.read_table(f"{SF}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    b = pq.read_table(f"{SF}/benchmark.parquet").to_pylist()
    items = [(r["item_id"], r["text"]) for r in b]
    got = collections.defaultdict(dict)
    for r in op.op9_decontaminate(spark, SF).collect():
        got[r.doc_id][r.item_id] = round(r.similarity, 9)
    seeds = {g: i for i, t in items for g in _bag(_words(t), 5)}
    for row in d:
        near = any(g in seeds for g in _bag(_words(row["text"]), 5))
        want = brute(row["text"], items) if near else {}
        assert got[row["doc_id"]] == {i: round(s, 9) for i, s in want.items()}


def test_private_names_of_the_caller_stay(spark):
    item = "one two three four five six seven eight nine ten eleven twelve"
    d = docs(spark, [(1, item, "en", "a", 1)]).withColumns({"_leaks0": F.lit("x"), "leaks_0": F.lit("y"), "LEAKS": F.lit("z")})
    row, = op.find_leaks(d, spark.createDataFrame([(5, item), (6, item + " x")], BENCH), block_items=1).collect()
    assert (row._leaks0, row.leaks_0) == ("x", "y") and 5 in {x.item_id for x in row.leaks}
