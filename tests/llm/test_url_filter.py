import re

import pytest
from pyspark.sql import functions as F

from haulage.llm import op10_url_filter as op

PAGES = "page_id long, url string"
URLS = [None, "", "no scheme", "http://", "http:///path", "HTTP://EXAMPLE.org/es/a", "https://a.example.org/en/1?x#y", "https://example.org/en/2",
        "http://badexample.org/es/", "http://x.com/fr/1", "http://x.com/de/1", "http://com/de/", "http://xcom/de/", "ftp://h.net/a://b", "x://y#z/../",
        "http://ÄB.org", "http://example.org:80/es/", "http://a.net/listed/", "https://www.A.net/listed?q=1", "http://a.net/Listed", "http://org/", "http://a.org?x"]


def plain(url, listed):
    """Host, path, rule, verdict as the contract words them."""
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host):])[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), h + p, kind) for kind, h, p in op.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    rule = max(fits) if fits else None
    canon = re.sub("^(www|m)[.]", "", host) + path.rstrip("/") if host else None
    return host, path, rule and rule[1], rule[2] if rule else "block" if canon in listed else "allow"


@pytest.mark.parametrize("blocks", [1, 64, op.FILTER_BLOCKS])
def test_against_plain_rules(spark, blocks):
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(URLS * 2)], PAGES).withColumn("HOST", F.lit("x")).withColumn("rule", F.lit(1))
    listed = spark.createDataFrame([("https://m.a.net/listed",), (None,), ("https://m.a.net/listed/",), ("x://h.net/a:",)], "url string")
    out = op.judge(pages, listed, op.RULES, blocks=blocks).collect()
    assert len(out) == 2 * len(URLS)
    for r in out:
        assert (r.host, r.path, r.rule, r.verdict) == plain(r.url, {"a.net/listed", "h.net/a:"}), r.url


def test_empty_list_and_empty_table(spark):
    none = spark.createDataFrame([], "url string")
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(URLS)], PAGES)
    assert all(r.verdict == plain(r.url, set())[3] and not r.listed for r in op.judge(pages, none, op.RULES).collect())
    assert op.judge(spark.createDataFrame([], PAGES), none, []).collect() == []


def test_filter_passes_every_listed_key_and_few_others(spark):
    from haulage.llm.blocked_bloom import may_hold
    keys = spark.range(3000).select(F.concat(F.lit("k"), "id").alias("k"))
    probe = spark.range(20000).select(F.concat(F.lit("k"), "id").alias("k"))
    hits = [int(r.k[1:]) for r in probe.where(may_hold(F.col("k"), keys, "k", 1024)).collect()]
    assert set(range(3000)) <= set(hits) and len(hits) < 3000 + 17000 * 0.05


def test_plan_runs_no_python(spark):
    plan = op.op10_url_filter(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def test_private_names_of_the_caller_stay(spark):
    pages = spark.createDataFrame([(1, "http://a.net/x", "u", "v", "w", 5)], PAGES + ", canonical string, _MAYBE string, key string, maybe int")
    row, = op.judge(pages, spark.createDataFrame([("http://a.net/x",)], "url string"), []).collect()
    assert (row.canonical, row._MAYBE, row.key, row.maybe, row.listed) == ("u", "v", "w", 5, True)


def test_document_numbers_are_whole(spark):
    paths = ["/en/12", "/en/12/", "/en/12/x", "/en/12abc", "/en/9223372036854775807", "/en/9223372036854775808", "/en/1234567890123456789", "/EN/1", "/en/", ""]
    got = spark.createDataFrame([(p,) for p in paths], "p string").select("p", op.document_of(F.col("p")).alias("d")).collect()
    assert [r.d for r in got] == [12, 12, 12, None, 9223372036854775807, None, 1234567890123456789, None, None, None]
