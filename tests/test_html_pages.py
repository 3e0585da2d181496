"""Pages that are not tidy: open cells, nested tables, character references."""

from haulage.sources.html import fuel_price_table, population_table, table_rows


def _rows(spark, html):
    pages = spark.createDataFrame([(1, html)], "page_id int, html string")
    return [(r.is_header, r.cells) for r in sorted(table_rows(pages).collect(), key=lambda r: r.row_idx)]


def test_tidy_and_open_markup_give_the_same_rows(spark):
    tidy = "<table><tr><th>State</th><th>Regular</th></tr><tr><td>Ohio</td><td>$3.10</td></tr></table>"
    loose = "<table><tr><th>State<th>Regular<tr><td>Ohio<td>$3.10</table>"
    want = [(True, ["State", "Regular"]), (False, ["Ohio", "$3.10"])]
    assert _rows(spark, tidy) == want and _rows(spark, loose) == want


def test_character_references(spark):
    page = "<table><tr><td>A &amp; B&nbsp;C</td><td>&#36;3.50</td><td>2&lt;3</td><td>&quot;x&quot;</td></tr></table>"
    assert _rows(spark, page) == [(False, ["A & B C", "$3.50", "2<3", '"x"'])]
    other = "<table><tr><td>caf&eacute;</td><td>&#x24;3.50</td></tr></table>"
    assert _rows(spark, other) == [(False, ["café", "$3.50"])]


def test_nested_table_and_later_tables(spark):
    page = ("<table><tr><td>a</td><td><table><tr><td>inner</td></tr></table></td></tr><tr><td>b</td></tr></table>"
            "<table><tr><td>second</td></tr></table>")
    assert [c for _, c in _rows(spark, page)] == [["a", ""], ["inner"], ["b"]]


def test_escaped_prices_reach_the_price_table(spark):
    pages = spark.createDataFrame([(1, "<table><tr><th>State<tr><td>Ohio<td>&#36;3.10<td>3.2<td>x<td>4</table>"), (2, None)],
                                  "page_id int, html string")
    r = fuel_price_table(pages).collect()
    assert [(x.state_raw, x.regular, x.mid_grade, x.premium, x.diesel) for x in r] == [("OHIO", 3.1, 3.2, None, 4.0)]


def test_population_without_matching_header_uses_columns_two_and_three(spark):
    pages = spark.createDataFrame([(1, "<table><tr><th>#<th>x<th>y<tr><td>1<td>Texas[b]<td>29,145,505</table>")],
                                  "page_id int, html string")
    r = population_table(pages).collect()
    assert [(x.state, x.new_population) for x in r] == [("TEXAS", 29145505.0)]
