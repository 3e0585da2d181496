import hashlib
import random
import re
from collections import Counter

import public_tokenizers as public
import pyarrow.parquet as pq
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from haulage.llm import op11_token_alignment as op

from helpers import ROWS, docs

SF = "/root/testdata/sf0.001"
A_PATH, B_PATH = public.path("byte_bpe_50k.json"), public.path("piece_bpe_32k.model")
LIB_A, LIB_B = Tokenizer.from_file(A_PATH), sentencepiece.SentencePieceProcessor(model_file=B_PATH)
LIB_A.encode_special_tokens = True


def _bytes_a(i):
    letters = {}
    n = 0
    for b in range(256):
        if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255:
            letters[chr(b)] = b
        else:
            letters[chr(256 + n)] = b
            n += 1
    return bytes(letters[c] for c in LIB_A.id_to_token(i))


def _bytes_b(i):
    p = LIB_B.id_to_piece(i)
    m = re.fullmatch("<0x(..)>", p)
    return bytes([int(m[1], 16)]) if m else p.replace("▁", " ").encode()


def _ends(ids, of):
    out, n = [], 0
    for i in ids:
        n += len(of(i))
        out.append(n)
    return out


def _document(text):
    """(groups, links) of a whole text, token by token."""
    if not text:
        return [], []
    a, b = LIB_A.encode(" " + text, add_special_tokens=False).ids, LIB_B.encode(text)
    raw = (" " + text).encode()
    if b"".join(map(_bytes_a, a)) != raw or b"".join(map(_bytes_b, b)) != raw:
        return [], []
    ea, eb = _ends(a, _bytes_a), _ends(b, _bytes_b)
    groups, links, i, j, ga, gb = [], [], 0, 0, [], []
    while i < len(a):  # two fingers over both sequences
        links.append((a[i], b[j]))
        x, y = ea[i], eb[j]
        if x <= y:
            ga.append(a[i])
            i += 1
        if y <= x:
            gb.append(b[j])
            j += 1
        if x == y:
            groups.append((ga, gb))
            ga, gb = [], []
    return groups, links


def _want(rows):
    found = [(i, *_document(t)) for i, t in rows]
    count = Counter(p for _, _, links in found for p in links)
    top = {}
    for (_, b), n in count.items():
        top[b] = max(top.get(b, 0), n)
    out = []
    for i, groups, links in found:
        text = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)
        out.append((i, sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups), len(links),
                    sum(count[p] == top[p[1]] for p in links), sum(count[p] for p in links), text))
    return sorted(out, key=str), {b: n for b, n in top.items()}


def _got(spark, rows, **kw):
    found = op.alignment(spark.createDataFrame(rows, "doc_id long, text string").withColumn("batch", F.lit(1)), A_PATH, B_PATH, **kw)
    return sorted((tuple(r) for r in found.rows.collect()), key=str), {r.b_id: r.n for r in found.best.collect()}


TEXTS = ["a  b", " lead and trail ", "x\n y \n\n z\t w", "a▁b ▁ c", "<|endoftext|> </s> <unk> <s>x", "日本語 🙂👍🏽 ｆｕｌｌ", "\x00 \x01 a\x1c b",
         "a　b c  d ​ e", "é ﬁ Å İ", "don't we'll 'S", "aaaa " * 50, "=" * 70 + " x", "no" * 3000, "\r\n\r\n a", "1 2 3 4.5,6", " ", "   ",
         "᠎ a ᠎ b", "tab\there \v x", "end\n"]


@pytest.mark.parametrize("text", TEXTS)
def test_chunks_keep_both_tokenizations(text):
    t = op.Tokenizers(A_PATH, B_PATH)
    chunks = op.chunks_of(text)
    a, b = t.encode(chunks)
    assert a[1].tolist() == LIB_A.encode(" " + text, add_special_tokens=False).ids and b[1].tolist() == LIB_B.encode(text)


def test_random_texts_keep_both_tokenizations():
    t, rng = op.Tokenizers(A_PATH, B_PATH), random.Random(5)
    alphabet = list("  \n\t.,'-aZ9é日🙂  ​́▁<>\x1c\x85") + [" the", " of", "ing ", " 12 ", "\n  "]
    for _ in range(3000):
        text = "".join(rng.choices(alphabet, k=rng.randint(1, 30)))
        a, b = t.encode(op.chunks_of(text))
        assert a[1].tolist() == LIB_A.encode(" " + text, add_special_tokens=False).ids and b[1].tolist() == LIB_B.encode(text), repr(text)


def test_every_latin_character_is_encoded_alike():
    """The faster encoder of A is used for text below U+0250; on all of it, in several places, it gives what the library gives."""
    t = op.Tokenizers(A_PATH, B_PATH)
    assert t.fast is not None
    for c in range(1, 0x250):
        c = chr(c)
        text = f"a{c}b {c}{c} 1{c}2 -{c}! {c} '{c}s {c}'ll"
        n, ids = t._a_ids(op.chunks_of(text))
        assert ids.tolist() == LIB_A.encode(" " + text, add_special_tokens=False).ids and len(n) == len(op.chunks_of(text)), repr(c)


def test_identity_map_holds_equal_bytes():
    t = op.Tokenizers(A_PATH, B_PATH)
    held = [a for a in range(len(t.identity)) if t.identity[a] >= 0]
    assert len(held) > 10_000
    assert all(_bytes_a(a) == _bytes_b(int(t.identity[a])) for a in held)


@pytest.mark.parametrize("batch,buckets", [(1, 3), (1 << 20, 1)])
def test_against_brute_force(spark, batch, buckets):
    rows = [(r[0], r[1]) for r in ROWS] + [(100 + i, x) for i, x in enumerate(TEXTS)] + [(300, TEXTS[0]), (300, TEXTS[0])]
    assert _got(spark, rows, batch_bytes=batch, buckets=buckets) == _want(rows)


def test_empty_table(spark):
    assert _got(spark, []) == ([], {})
    assert _got(spark, [(1, None), (None, "")]) == _want([(1, None), (None, "")])


def test_query_against_brute_force(spark):
    t = pq.read_table(f"{SF}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    want, _ = _want([(r["doc_id"], r["text"]) for r in t])
    digest = lambda g: hashlib.sha256(g.encode()).hexdigest() if g else ""
    out = op.op11_token_alignment(spark, SF)
    assert out.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted((tuple(r) for r in out.collect()), key=str) == sorted(((*w[:-1], digest(w[-1])) for w in want), key=str)


def test_rows_of_the_test_tables(spark):
    assert op.alignment(docs(spark), A_PATH, B_PATH).rows.count() == len(ROWS)
