"""Code tables in HTML pages."""

import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from helpers import plan_of, rows_of
from tallybook.schemas import columns
from tallybook.sources.html import first_table, html_code_table, html_table_rows, read_pages, table_rows

CODES = columns("code string, label string")


@pytest.mark.parametrize("html, rows", [
    ("no table at all <p>", []),
    ("", []),
    ("<table><tr><th>a<th>b<tr><td>1<td>2</table>", [["a", "b"], ["1", "2"]]),
    ("<table></table><table><tr><td> </td></tr></table><table><tr><td>x</td></tr></table>", [["x"]]),
    ("<table><tr><td>&lt;b&gt; &amp;\n<i>c</i><br>d</td></tr></table>", [["<b> & c d"]]),
    ("<table><tr><td rowspan=2>a</td><td>b</td></tr><tr><td>c</td></tr></table>", [["a", "b"], ["a", "c"]]),
    ("<table><tr><td>a</td><td rowspan=3>b</td></tr><tr><td>c</td></tr><tr><td>d</td></tr></table>",
     [["a", "b"], ["c", "b"], ["d", "b"]]),
    ("<table><tr><td>a</td><td rowspan='3'>b</td></tr></table>", [["a", "b"], ["b", ""], ["b", ""]]),
    ("<table><tr><td title='1 > 0' colspan=0>a</td><td data-rowspan>b</table>", [["a", "b"]]),
    ("<table><tr><td colspan=1500>a</table>", [["a"] * 1500]),
    ("<table><tr><td colspan=2>a</td><td>b</td></tr><tr><td>c</td></tr></table>", [["a", "a", "b"], ["c", "", ""]]),
    ("<table><tr><td rowspan=2 colspan=2>a</td><td>b</td></tr><tr><td>c</td></tr></table>",
     [["a", "a", "b"], ["a", "a", "c"]]),
    ("<table><tr><td>a<table><tr><td>in</td></tr></table></td><td>b</td></tr></table>", [["ain", "b"]]),
    ("<script>'<table><tr><td>no</td></tr></table>'</script><table><tr><td>x<script>y</script></td></tr></table>", [["x"]]),
    ("<!-- <table><tr><td>no</td></tr></table> --><TABLE><TR><TD>x</TD></TR></TABLE>", [["x"]]),
    ("<table><thead><tr><th>h</th></tr></thead><tbody><tr><td>x</td></tr></tbody></table>", [["h"], ["x"]]),
    ("<table><tr><td>never closed", [["never closed"]]),
    ("<table><tfoot><tr><td>f</td></tr></tfoot><tr><td>b</td></tr><thead><tr><td>h</td></tr></thead></table>",
     [["h"], ["b"], ["f"]]),
    ("<table><thead><tr><th rowspan=2>h</th></tr></thead><tbody><tr><td>x</td></tr></tbody></table>",
     [["h"], ["h"], ["x"]]),
    ("<table><thead><th>a</th><th>b</th></thead><tr><td>1</td><td>2</td></tr></table>", [["a", "b"], ["1", "2"]]),
    ("<table><tr><td>a\u00a0b\tc  d \n e</td></tr></table>", [["a\u00a0b\tc d e"]]),
])
def test_first_table(html, rows):
    assert first_table(html) == rows


@pytest.mark.parametrize("part", ["<a ", "<td '", '<td title="x>', "<table><tr><td>x", "<script>", "<!--", "<br", "< ", "\"'>"])
def test_broken_pages_take_no_long_time(part):
    started = time.perf_counter()
    first_table("<table><tr><td>" + part * 50_000)
    assert time.perf_counter() - started < 10


def test_rows_that_a_span_makes_are_made_as_they_are_taken():
    rows = table_rows("<table><tr><td rowspan=70000>a</table>")
    assert sum(row == ["a"] for row in rows) == 70000


@pytest.mark.parametrize("span", ["colspan=900000000", "rowspan=900000000", "colspan=900000000 rowspan=900000000"])
def test_a_span_of_any_size_is_a_run(span):
    started = time.perf_counter()
    rows = table_rows(f"<table><tr><td {span}>a<td>b<tr><td>c</table>")
    first, second = next(rows), next(rows)
    wide = "colspan" in span
    assert (first[0], first[-1]) == ("a", "b") and len(first) == len(second) == (900_000_001 if wide else 2)
    assert (second[0], second[1]) == {"c": ("c", ""), "r": ("a", "c"), "b": ("a", "a")}["b" if "rows" in span and wide else span[0]]
    assert first[1:3] == (["a", "a"] if wide else ["b"])
    assert time.perf_counter() - started < 1


def plain_grid(rows):
    """Cell by cell, as (text, down, across) per row: every cell is put at the next free place, those from above first."""
    grid, above = [], {}

    def lay(cells):
        row, below = [], {}

        def put(text, more):
            if more > 0:
                below[len(row)] = (text, more)
            row.append(text)

        def fill():
            while len(row) in above:
                text, more = above.pop(len(row))
                put(text, more - 1)

        fill()
        for text, down, across in cells:
            for _ in range(across):
                put(text, down - 1)
            fill()
        return row, below

    for cells in rows:
        row, above = lay(cells)
        grid.append(row)
    while above:
        grid.append([text for _, (text, _) in sorted(above.items())])
        above = {i: (text, more - 1) for i, (text, more) in above.items() if more > 1}
    width = max((len(row) for row in grid), default=0)
    return [row + [""] * (width - len(row)) for row in grid if row]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.tuples(st.sampled_from("abcdef"), st.integers(1, 4), st.integers(1, 4)), max_size=4), max_size=5))
def test_runs_are_the_cells(rows):
    html = "".join("<tr>" + "".join(f"<td rowspan={down} colspan={across}>{text}</td>" for text, down, across in row) + "</tr>"
                   for row in rows)
    assert [list(row) for row in first_table(f"<table>{html}</table>")] == plain_grid(rows)


def test_a_wide_span_costs_a_column_reader_nothing(spark):
    page = "<table><tr><th colspan=900000000>names<tr><td>007<td colspan=800000000>x<tr><td colspan=3>y</table>"
    codes = html_code_table(spark.createDataFrame([(1, page)], "page int, html string"), "page", "html", CODES)
    assert rows_of(codes) == [(1, "007", "x"), (1, "y", "y")]


def test_rows_and_columns_by_position(spark):
    pages = spark.createDataFrame(
        [(1, "<table><tr><th>Code</th><th>Text</th><th>More</th></tr><tr><td>007</td><td>x</td><td>y</td></tr></table>"),
         (2, "<p>nothing"), (3, None), (4, "<table><tr><th>Code</th></tr><tr><td>A</td></tr></table>")],
        "page int, html string")
    assert rows_of(html_table_rows(pages, "page", "html").where("row_no = 0")) == [
        (1, 0, ["Code", "Text", "More"]), (4, 0, ["Code"])]
    assert rows_of(html_code_table(pages, "page", "html", CODES)) == [(1, "007", "x"), (4, "A", None)]


def test_saved_pages_are_read_whole(spark, tmp_path):
    (tmp_path / "codes.html").write_text("<table>\n<tr><th>c</th><th>l</th></tr>\n<tr>\n<td>A</td>\n<td>b\nc</td></tr></table>\n")
    pages = read_pages(spark, str(tmp_path))
    assert rows_of(html_code_table(pages, "page", "html", CODES).select("code", "label")) == [("A", "b c")]


def test_pages_without_tables_give_no_rows_and_no_failure(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    rows = html_table_rows(pages, "page_id", "html")
    assert rows_of(rows) == []
    assert "ReadSchema: struct<page_id:bigint,html:string>" in plan_of(rows)
