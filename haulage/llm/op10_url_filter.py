"""URL filter: rules by host and path, then a list of canonical URLs.

The list is looked up in two steps. A blocked Bloom filter (one 64-bit word
per block, so a probe reads one word) lets through every listed URL and a few
others; only those rows reach the exact hash join on the canonical URL, which
removes the false positives. DataFrame functions only.

Edge rows: a null URL, or one without ``://``, has empty host and path and is
never listed; an empty list blocks nothing; repeated URLs and repeated rows
are judged row by row; an input column named like a result column is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from haulage.llm.blocked_bloom import may_hold
from haulage.llm.registry import query, table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Blocks (64-bit words) of the filter. This is the bound of what is sent to
# every task: 2**17 words are 1 MiB, good for some 500,000 listed URLs at one
# false hit in a hundred or better. A longer list only lets more rows through
# to the exact join; raise the parameter for it.
FILTER_BLOCKS = 1 << 17

DOCUMENT = "^/[a-z]+/([0-9]+)(/|$)"  # the path of a page that shows a document

# The rules of the query, (verdict, host, path).
RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]


def lower_ascii(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return lower_ascii(F.regexp_extract(_after_scheme(F.coalesce(url, F.lit(""))), "^[^/?#]*", 0))


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_after_scheme(F.coalesce(url, F.lit(""))), "^[^/?#]*([^?#]*)", 1)


def canonical(url: Column) -> Column:
    """Host without ``www.`` or ``m.`` and path without trailing slashes; null if there is no host.

    Scheme, query and fragment are left out: they don't name another document.
    """
    host = F.regexp_replace(host_of(url), "^(www|m)\\.", "")
    path = F.regexp_replace(path_of(url), "/+$", "")
    return F.when(host != "", F.concat(host, path))


def matching_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, both null if none does."""
    rule = verdict = None
    for kind, rule_host, rule_path in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        fits = ((host == rule_host) | F.endswith(host, F.lit("." + rule_host))) & F.startswith(path, F.lit(rule_path))
        name, what = F.lit(rule_host + rule_path), F.lit(kind)
        rule = F.when(fits, name) if rule is None else rule.when(fits, name)
        verdict = F.when(fits, what) if verdict is None else verdict.when(fits, what)
    none = F.lit(None).cast("string")
    return (none, none) if rule is None else (rule, verdict)


def judge(pages: DataFrame, listed: DataFrame, rules: list[tuple[str, str, str]], url_col: str = "url",
          blocks: int = FILTER_BLOCKS) -> DataFrame:
    """``pages`` plus host, path, rule, verdict and listed.

    ``listed`` has a column ``url`` with the URLs to block (any spelling). A
    row takes the verdict of its longest fitting rule, else block if its
    canonical URL is listed, else allow.
    """
    added = ["host", "path", "rule", "verdict", "listed"]
    kept = [c for c in pages.columns if c.lower() not in added]
    own, maybe, key = (free_name(c, kept) for c in ("canonical", "maybe", "key"))
    rows = pages.select(*[F.col(f"`{c}`") for c in kept],
                        host_of(F.col(f"`{url_col}`")).alias("host"), path_of(F.col(f"`{url_col}`")).alias("path"),
                        canonical(F.col(f"`{url_col}`")).alias(own))
    keys = listed.select(canonical(F.col("url")).alias(key)).where(F.col(key).isNotNull()).distinct()
    rows = rows.withColumn(maybe, F.when(may_hold(F.col(own), keys, key, blocks), F.col(own)))
    # the exact join, for possible hits only; rows that the filter stopped are not shuffled
    hits = rows.where(F.col(maybe).isNotNull()).join(keys, F.col(maybe) == F.col(key), "left")
    rows = rows.where(F.col(maybe).isNull()).withColumn(key, F.lit(None).cast("string")).unionByName(hits)
    rule, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    hit = F.col(key).isNotNull()
    return (rows.withColumn("rule", rule)
            .withColumn("verdict", F.coalesce(verdict, F.when(hit, F.lit("block")).otherwise(F.lit("allow"))))
            .withColumn("listed", hit).drop(own, maybe, key))


def free_name(name: str, taken: list[str]) -> str:
    """A column name that none of ``taken`` has, in any case."""
    held = {c.lower() for c in taken}
    while name in held:
        name = "_" + name
    return name


def document_of(path: Column) -> Column:
    """Number of the document that a page at ``/<language>/<number>`` shows; null for other paths and numbers beyond a long."""
    return F.nullif(F.regexp_extract(path, DOCUMENT, 1), F.lit("")).try_cast("long")


_SQL_CANON = ("case when {h} <> '' then regexp_replace({h}, '^(www|m)\\.', '') || regexp_replace({p}, '/+$', '') end")
_SQL_HOST = ("translate(regexp_extract(case when instr({u}, '://') > 0 then substr({u}, instr({u}, '://') + 3) else '' end, "
             f"'^[^/?#]*'), '{UPPER}', '{LOWER}')")
_SQL_PATH = ("regexp_extract(case when instr({u}, '://') > 0 then substr({u}, instr({u}, '://') + 3) else '' end, "
             "'^[^/?#]*([^?#]*)', 1)")

SQL = f"""
with p as (select page_id, coalesce({_SQL_HOST.format(u="coalesce(url, '')")}, '') host,
                  coalesce({_SQL_PATH.format(u="coalesce(url, '')")}, '') path from pages),
c as (select *, {_SQL_CANON.format(h='host', p='path')} canon from p),
toxic as (select distinct canon from c join labels l on l.toxic = 1
          and l.doc_id = try_cast(nullif(regexp_extract(c.path, '{DOCUMENT}', 1), '') as bigint)
          where canon is not null),
f as (select c.page_id, c.host, c.path, toxic.canon is not null as listed,
      case when (host = 'example.org' or host like '%.example.org') and starts_with(path, '/en/1') then 'example.org/en/1'
           when (host = 'example.org' or host like '%.example.org') and starts_with(path, '/es/') then 'example.org/es/'
           when (host = 'com' or host like '%.com') and starts_with(path, '/fr/') then 'com/fr/'
           when (host = 'com' or host like '%.com') and starts_with(path, '/de/') then 'com/de/'
           when (host = 'org' or host like '%.org') and starts_with(path, '/') then 'org/' end as rule
      from c left join toxic on toxic.canon = c.canon)
select page_id, host, path, rule,
       case when rule in ('org/', 'com/fr/') then 'allow' when rule is not null then 'block'
            when listed then 'block' else 'allow' end as verdict, listed
from f"""


def toxic_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The list of the query: URLs of pages that show a document labelled toxic.

    A page's path is ``/<language>/<document>``. The list grows with pages and labels.
    """
    pages = table(spark, sf_dir, "pages").select("url", document_of(path_of(F.col("url"))).alias("doc_id"))
    toxic = table(spark, sf_dir, "labels").where("toxic = 1").select("doc_id").distinct()
    return pages.join(toxic, "doc_id", "left_semi").select("url")


@query("op10_url_filter", SQL)
def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return judge(pages, toxic_urls(spark, sf_dir), RULES).select("page_id", "host", "path", "rule", "verdict", "listed")
