import pyarrow as pa
import pyarrow.parquet as pq

from haulage.llm import op01_language_id as op

from helpers import docs

SF = "/root/testdata/sf0.001"
PAGES = "page_id long, url string, html string"


def _identify(spark, rows, pages=()):
    out = op.identify(docs(spark, rows), spark.createDataFrame(list(pages), PAGES)).collect()
    return {r.doc_id: (r.language, r.accepted) for r in out}, out


def test_text_alone_on_held_out_rows(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    languages = op.languages_of(d, "lang")
    assert set(languages) == {"en", "de", "fr", "es"}
    model = op.fit(d.where("doc_id % 2 = 0"), "lang", "doc_id", "text", languages)
    held = d.where("doc_id % 2 = 1").toArrow()
    best = op.text_scores(model, held["text"].combine_chunks()).argmax(axis=1)
    right = sum([*languages, "und"][b] == l for b, l in zip(best, held["lang"].to_pylist()))
    assert right >= 0.95 * len(best)


def test_declared_language_settles_short_texts(spark):
    rows = [(i, "the of and with this is that on " * 4, "en", "a", 1) for i in range(40)]
    rows += [(100 + i, "der die das und ist nicht mit von " * 4, "de", "b", 1) for i in range(40)]
    rows += [(500, "ok", "de", None, 2), (501, "ok", "en", None, 2), (502, "okay", None, "b", 4), (503, "okay", None, "a", 4),
             (504, "ok", None, "a", 2)]
    got, _ = _identify(spark, rows)
    assert [got[i][0] for i in (500, 501)] == ["de", "en"]
    assert [got[i][0] for i in (502, 503)] == ["de", "en"]  # by the host's prior
    assert got[504] == ("und", False)  # too short for a trigram, and a host alone is no evidence
    assert all(got[i] == ("en", True) for i in range(40))


def test_page_markup_counts_for_the_document(spark):
    rows = [(i, "the of and with this is that on " * 4, "en", "a", 1) for i in range(40)]
    rows += [(100 + i, "der die das und ist nicht mit von " * 4, "de", "b", 1) for i in range(40)] + [(500, "", None, None, 0)]
    pages = [(1, "http://x.example.org/de/500", '<html lang="de">'), (2, None, None), (3, "http://x.example.org/de/500", "<html>")]
    got, out = _identify(spark, rows, pages)
    assert got[500] == ("de", True) and len(out) == len(rows)


def test_rare_language_is_fitted(spark):
    """The bounded sample holds rows of every language, however rare its label and whatever form it has."""
    rows = [(i, f"the of and with this is that on a{i} " * 4, "en-US", "a", 1) for i in range(600)]
    rows += [(1000 + i, "der die das und ist nicht mit von " * 4, "DE", "a", 1) for i in range(3)]
    rows += [(2000, "die und das ist mit der nicht von " * 3, None, None, 1)]
    model = op.fit(docs(spark, rows), "lang", "doc_id", "text", ["en", "de"], sample_docs=20)
    held = pa.array(["nicht mit der und das ist von die " * 3, "this is the that with and of on " * 3])
    assert op.text_scores(model, held).argmax(axis=1).tolist() == [1, 0]
    got, _ = _identify(spark, rows)
    assert got[2000] == ("de", True) and got[0] == ("en", True)


def test_repeated_rows_and_null_ids_do_not_fill_the_sample(spark):
    rows = [(None, "xx yy zz", "de", "a", 1)] * 200 + [(None, f"der die das und ist nicht mit von b{i}", "de", "a", 1) for i in range(10)]
    model = op.fit(docs(spark, rows), "lang", "doc_id", "text", ["en", "de"], sample_docs=11)
    assert op.text_scores(model, pa.array(["der die das und ist nicht mit von"])).argmax() == 1


def test_evidence_of_all_pages_of_a_document(spark):
    """Host and language each come from the page of smallest id that has one; null ids come last."""
    pages = [(3, "http://c.example.org/de/7", '<html lang="fr">'), (2, "http://b.example.org/de/7", '<html lang="de">'),
             (1, "http://a.example.org/de/7", "<html>"), (None, "http://n.example.org/de/7", '<html lang="es">'),
             (None, "http://n.example.org/de/8", '<html lang="es">'), (4, "http://d.example.org/de/9", None)]
    got = {r.doc_id: (r.page_host, r.page_language) for r in op.page_evidence(spark.createDataFrame(pages, PAGES)).collect()}
    assert got == {7: ("a.example.org", "de"), 8: ("n.example.org", "es"), 9: ("d.example.org", None)}


def test_edge_rows(spark):
    got, out = _identify(spark, None)
    assert len(out) == docs(spark).count()
    assert got[4] == ("und", False)  # neither text nor anything declared
    assert all(0 <= r.confidence <= 1 for r in out)


def test_empty_tables(spark):
    assert _identify(spark, [])[1] == []


def test_query_agrees_with_the_labels(spark):
    out = {r.doc_id: r for r in op.op1_language_id(spark, SF).collect()}
    t = pq.read_table(f"{SF}/documents.parquet", columns=["doc_id", "lang"]).to_pylist()
    assert len(out) == len(t)
    assert sum(out[r["doc_id"]].language == r["lang"] for r in t) >= 0.99 * len(t)
    assert all(r.accepted for r in out.values())


def test_languages_come_from_the_labels(spark):
    rows = [(i, f"il gatto che non era della casa per questo sono anche a{i} " * 4, "it", "a", 1) for i in range(100)]
    rows += [(200 + i, f"the of and with this is that on a{i} " * 4, "en-GB", "a", 1) for i in range(50)]
    rows += [(300 + i, "xx", "12?", "a", 1) for i in range(9)] + [(400, "ab", "zz", "a", 1), (401, "ab", "und", "a", 1)]
    assert op.languages_of(docs(spark, rows), "lang") == ["it", "en", "zz"]
    assert op.languages_of(docs(spark, rows), "lang", 2) == ["it", "en"]
    got, _ = _identify(spark, rows)
    assert all(got[i] == ("it", True) for i in range(100)) and all(got[200 + i] == ("en", True) for i in range(50))


def test_unknown_literal_label_and_no_labels(spark):
    from pyspark.sql import functions as F
    rows = [(i, "the of and with this is that on " * 4, "en", "a", 1) for i in range(5)]
    d = docs(spark, rows).withColumn("lang", F.lit("xx"))
    assert {(r.language, r.accepted) for r in op.identify(d, spark.createDataFrame([], PAGES), ["en"]).collect()} <= {("und", False), ("en", True)}
    none = docs(spark, rows).withColumn("lang", F.lit(None).cast("string"))
    assert {(r.language, r.confidence, r.accepted) for r in op.identify(none, spark.createDataFrame([], PAGES)).collect()} == {("und", 0.0, False)}


def _by_hand(rows, text_log_p, languages):
    """The fusion, row by row, in plain Python: rows of (host, declared, suffix)."""
    import math
    from collections import Counter
    n_l, out = len(languages), []
    domain = lambda h: ".".join(h.split(".")[-2:]) if h and "." in h else None
    best = [max(range(n_l + 1), key=lambda c: (t[c], -c)) if any(t) else None for t in text_log_p]
    keys = [{"host": h, "domain": domain(h), "declared": d, "suffix": s} for h, d, s in rows]
    count, every = Counter(), Counter()
    for k, b in zip(keys, best):
        if b is not None and b < n_l:
            every[b] += 1
            count.update((kind, v, b) for kind, v in k.items() if v is not None)
    total = sum(every.values())
    whole = [(every[c] + op.SMOOTH / n_l) / (total + op.SMOOTH) for c in range(n_l)]
    for k, t in zip(keys, text_log_p):
        def smooth(kind, above):
            n = [count[kind, k[kind], c] for c in range(n_l)]
            return [(n[c] + op.SMOOTH * above[c]) / (sum(n) + op.SMOOTH) for c in range(n_l)]
        prior = [*smooth("host", smooth("domain", whole)), op.UND_PRIOR]

        def likelihood(kind):
            n = [count[kind, k[kind], c] for c in range(n_l)]
            if k[kind] is None or sum(n) == 0:
                return [0.0] * (n_l + 1)
            return [*(math.log((n[c] + 0.5) / (every[c] + op.SMOOTH)) for c in range(n_l)), math.log((sum(n) + 0.5) / (total + op.SMOOTH))]
        d, s = likelihood("declared"), likelihood("suffix")
        score = [t[c] + math.log(prior[c]) + d[c] + s[c] for c in range(n_l + 1)]
        top = max(score)
        known = k["declared"] in languages or any(t)
        out.append(([*languages, "und"][score.index(top)] if known else "und", 1 / sum(math.exp(x - top) for x in score) if known else 0.0))
    return out


def test_fusion_against_plain_python(spark):
    import random
    rng, languages = random.Random(11), ["en", "de", "fr"]
    rows, text = [], []
    for _ in range(300):
        lang = rng.randrange(3)
        rows.append((rng.choice([f"{languages[lang]}.site.org", "x.site.org", "other.net", "plain", None]),
                     rng.choice([languages[lang], languages[rng.randrange(3)], "xx", None]), rng.choice(["org", "net", None])))
        text.append([0.0] * 4 if rng.random() < 0.2 else [round(-rng.random() * 4 - (c != lang) * 2, 3) for c in range(3)] + [-6.0])
    frame = spark.createDataFrame([(i, *r, t) for i, (r, t) in enumerate(zip(rows, text))],
                                  "i int, host string, declared string, suffix string, text_log_p array<double>")
    got = {r.i: (r.language, r.confidence) for r in op.fuse(frame, [*languages, "und"]).collect()}
    for i, (language, confidence) in enumerate(_by_hand(rows, text, languages)):
        assert got[i][0] == language and abs(got[i][1] - confidence) < 1e-9, i
