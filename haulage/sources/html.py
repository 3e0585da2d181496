"""HTML tables in landed web pages -> rows.

A Spark job over a pages DataFrame (page_id, html). Tidy pages are taken apart
with ``regexp_extract_all`` and ``posexplode`` in the JVM: tags inside a cell
are stripped and the usual entities decoded. Pages that the patterns don't fit
(closing tags left out, a nested table, other character references) go through
the standard library's HTML parser instead, in Arrow batches. Only the first
table of each page is used, as the scrapers did.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

from haulage.functions import currency_to_double, number_text_to_double, strip_footnotes

_TABLE = r"(?is)<table\b.*?</table>"
_ROW = r"(?is)<tr\b[^>]*>(.*?)</tr>"
_CELL = r"(?is)<t[hd]\b[^>]*>(.*?)</t[hd]>"
_HEAD = r"(?is)^\s*<th\b"


_NAMED = {"&nbsp;": " ", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&apos;": "'", "&#39;": "'", "&#36;": "$", "&amp;": "&"}


def _clean_cell(c):
    text = F.regexp_replace(c, r"(?s)<[^>]+>", "")
    for entity, char in _NAMED.items():
        text = F.replace(text, F.lit(entity), F.lit(char))
    return F.trim(text)


def _tidy(html):
    """Every row and cell is closed, there is one table, and all references are known ones."""
    count = lambda rx: F.regexp_count(html, F.lit(rx))
    known = "|".join(e[1:] for e in _NAMED)
    return ((count(r"(?i)<tr\b") == count(r"(?i)</tr\s*>")) & (count(r"(?i)<t[hd]\b") == count(r"(?i)</t[hd]\s*>"))
            & (count(r"(?i)<table\b") <= 1) & (count(r"(?i)<table\b") == count(r"(?i)</table\s*>"))
            & (count(r"(?i)<!--|<script\b|<style\b") == 0)
            & (count(rf"&(?!(?:{known}))#?\w+;") == 0))


def _parsed_rows(pages: DataFrame, html: str, key: str) -> DataFrame:
    """The same rows by an HTML parser: an open cell ends at the next cell or
    row, an open row at the next row or the table's end; rows of a nested
    table are rows of their own."""
    fields = StructType([pages.schema[key]] + StructType.fromDDL(
        "row_idx int, is_header boolean, cells array<string>").fields)
    key_type = to_arrow_type(pages.schema[key].dataType)

    def run(batches):
        from html.parser import HTMLParser

        import pyarrow as pa

        class Table(HTMLParser):
            def __init__(self):
                super().__init__(convert_charrefs=True)
                self.depth, self.done, self.rows, self.open = 0, False, [], False

            def handle_starttag(self, tag, attrs):
                if self.done:
                    return
                if tag == "table":
                    self.depth += 1
                    self.open = False
                elif self.depth and tag == "tr":
                    self.rows.append([])
                    self.open = False
                elif self.depth and tag in ("td", "th"):
                    if not self.rows:
                        self.rows.append([])
                    self.rows[-1].append([tag, ""])
                    self.open = True

            def handle_endtag(self, tag):
                if self.done or not self.depth:
                    return
                if tag in ("td", "th", "tr"):
                    self.open = False
                elif tag == "table":
                    self.depth -= 1
                    self.open, self.done = False, self.depth == 0

            def handle_data(self, data):
                if self.open and not self.done:
                    self.rows[-1][-1][1] += data

        schema = pa.schema([(fields[0].name, key_type), ("row_idx", pa.int32()), ("is_header", pa.bool_()),
                            ("cells", pa.list_(pa.string()))])
        for batch in batches:
            out = []
            for k, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                table = Table()
                table.feed(page)
                table.close()
                out += [{fields[0].name: k, "row_idx": i, "is_header": bool(r) and r[0][0] == "th",
                         "cells": [c[1].replace("\xa0", " ").strip() for c in r]} for i, r in enumerate(table.rows)]
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    return pages.where(F.col(html).isNotNull()).select(key, html).mapInArrow(run, fields)


def table_rows(pages: DataFrame, html: str = "html", key: str = "page_id") -> DataFrame:
    """S7 core: (key, row_idx, is_header, cells array<string>) for the first
    <table> of every page."""
    tidy = _tidy(F.col(html))
    first = F.regexp_extract(F.col(html), _TABLE, 0)
    rows = (pages.where(tidy)
            .select(key, F.posexplode(F.regexp_extract_all(first, F.lit(_ROW), 1)).alias("row_idx", "tr")))
    strict = rows.select(
        key, "row_idx",
        F.col("tr").rlike(_HEAD).alias("is_header"),
        F.transform(F.regexp_extract_all("tr", F.lit(_CELL), 1), _clean_cell).alias("cells"))
    return strict.unionByName(_parsed_rows(pages.where(~tidy), html, key))


def fuel_price_table(pages: DataFrame, html: str = "html", key: str = "page_id") -> DataFrame:
    """Price table with positional names (state, regular, mid_grade,
    premium, diesel); '$' and ',' stripped; unparsable prices -> null."""
    rows = table_rows(pages, html, key).where(~F.col("is_header"))
    cell = lambda i: F.try_element_at("cells", F.lit(i))  # noqa: E731  (ragged rows -> null)
    return rows.select(
        key, "row_idx", F.upper(F.trim(cell(1))).alias("state_raw"),
        *[currency_to_double(cell(i + 2)).alias(n)
          for i, n in enumerate(["regular", "mid_grade", "premium", "diesel"])])


def population_table(pages: DataFrame, html: str = "html", key: str = "page_id") -> DataFrame:
    """Header sniffing: the first header cell containing 'state' or
    'name' is the name column, the first containing 'population' or 'pop' is
    the value column; without a match, columns 2 and 3. Names lose bracketed
    footnotes and are upper-cased; numbers lose commas (bad -> null)."""
    rows = table_rows(pages, html, key)
    head = (rows.where(F.col("is_header"))
            .groupBy(key).agg(F.min_by("cells", "row_idx").alias("hdr")))
    lower = F.transform("hdr", lambda c: F.lower(c))
    name_pos = F.array_position(F.transform(lower, lambda c: c.contains("state") | c.contains("name")), True)
    pop_pos = F.array_position(F.transform(lower, lambda c: c.contains("population") | c.contains("pop")), True)
    both = (name_pos > 0) & (pop_pos > 0)
    pos = head.select(key, F.when(both, name_pos).otherwise(F.lit(2)).alias("_ni"),
                      F.when(both, pop_pos).otherwise(F.lit(3)).alias("_pi"))
    body = rows.where(~F.col("is_header")).join(pos, key, "left")
    ni = F.coalesce("_ni", F.lit(2)).cast("int")
    pi = F.coalesce("_pi", F.lit(3)).cast("int")
    return body.select(key, "row_idx",
                       strip_footnotes(F.try_element_at("cells", ni)).alias("state"),
                       number_text_to_double(F.try_element_at("cells", pi)).alias("new_population"))
