"""Code tables published as HTML pages.

The input is a DataFrame of pages, so pages are parsed where they lie, in
parallel. Only the parsing of one page at a time is Python; the rows go back to
Spark as runs of equal cells and are picked apart by position there.
"""

import re
from bisect import bisect_right
from collections import deque
from collections.abc import Iterator, Sequence
from html import unescape
from itertools import chain, islice, repeat

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROWS_PER_BATCH = 10_000


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Saved pages, one row per file."""
    pages = spark.read.text(path, wholetext=True)
    return pages.select(F.col("_metadata.file_path").alias("page"), F.col("value").alias("html"))


def html_table_runs(pages: DataFrame, key: str, html: str) -> DataFrame:
    """(key, row_no, runs) for the first table of each page; row 0 holds the names.

    A run is a text with the first column it covers and the number of columns: a span of many columns is one run, and only
    a reader of a column looks into it (``cell``). A page without a table gives no rows.
    """
    run = T.StructType([T.StructField("text", T.StringType()), T.StructField("start", T.LongType()),
                        T.StructField("width", T.LongType())])
    schema = T.StructType([pages.schema[key], T.StructField("row_no", T.IntegerType()),
                           T.StructField("runs", T.ArrayType(run))])

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = ((page, row_no, row.runs) for page, text in zip(batch[key], batch[html])
                    for row_no, row in enumerate(table_rows(text)))
            while part := list(islice(rows, ROWS_PER_BATCH)):
                yield pd.DataFrame(part, columns=schema.fieldNames())

    with_table = pages.select(key, html).where(F.col(html).rlike("(?i)<table"))
    return with_table.mapInPandas(parse, schema)


def cell(runs: str, column: int) -> Column:
    """The text of one column of a row given as runs, null beyond its last."""
    covers = F.filter(runs, lambda run: (run["start"] <= column) & (column < run["start"] + run["width"]))
    return F.get(covers, F.lit(0))["text"]


def html_table_rows(pages: DataFrame, key: str, html: str) -> DataFrame:
    """(key, row_no, cells) for the first table of each page, every column with a cell of its own."""
    cells = F.flatten(F.transform("runs", lambda run: F.array_repeat(run["text"], run["width"].cast("int"))))
    return html_table_runs(pages, key, html).select(key, "row_no", cells.alias("cells"))


def html_code_table(pages: DataFrame, key: str, html: str, schema: T.StructType) -> DataFrame:
    """Data rows of each page's first table, with columns taken by position."""
    rows = html_table_runs(pages, key, html).where(F.col("row_no") > 0)
    cells = [F.nullif(cell("runs", i), F.lit("")).cast(f.dataType).alias(f.name) for i, f in enumerate(schema)]
    return rows.select(key, *cells)


# What matters in a page: comments, text that is not shown, the tags of tables, line breaks, and any other tag.
_TOKEN = re.compile(r"""
      <!--.*?(?:-->|\Z)
    | <(?P<unshown>script|style|title)\b.*?(?:</(?P=unshown)\s*>|\Z)
    | <(?P<end>/?)(?P<tag>table|thead|tbody|tfoot|tr|td|th|br)\b(?P<attributes>(?:"[^"]*"|'[^']*'|[^'"<>])*)>
    | </?[a-z][^<>]*>
    """, re.IGNORECASE | re.DOTALL | re.VERBOSE)
# Fixed value: the spaces that count as one.
_SPACES = re.compile(r"[\r\n]+|\s{2,}")
_SPAN = re.compile(r"""\b(rowspan|colspan)\s*=\s*["']?(\d+)""", re.IGNORECASE)


Run = tuple[str, int, int]


class Cells(Sequence):
    """A row of cell texts, held as runs (text, first column, number of columns)."""

    def __init__(self, runs: list[Run]):
        self.runs = runs

    def __len__(self) -> int:
        return self.runs[-1][1] + self.runs[-1][2] if self.runs else 0

    def __getitem__(self, column):
        if isinstance(column, slice):
            return [self[i] for i in range(*column.indices(len(self)))]
        if not -len(self) <= column < len(self):
            raise IndexError(column)
        return self.runs[bisect_right(self.runs, column % len(self), key=lambda run: run[1]) - 1][0]

    def __iter__(self) -> Iterator[str]:
        return chain.from_iterable(repeat(text, width) for text, _, width in self.runs)

    def __eq__(self, other) -> bool:
        if isinstance(other, Cells):
            return len(self) == len(other) and all(self[at] == other[at] for row in (self, other) for _, at, _ in row.runs)
        return isinstance(other, list) and len(self) == len(other) and all(a == b for a, b in zip(self, other))

    def __repr__(self) -> str:
        return f"Cells({self.runs!r})"


def first_table(html: str) -> list[Cells]:
    """All rows of the page's first table that has any text."""
    return list(table_rows(html))


def table_rows(html: str) -> Iterator[Cells]:
    """Cell texts of the first table that has any text, head first and foot last; spans are filled in as rows are taken.

    End tags may be missing, and a table inside a cell counts as text of the cell.
    """
    parts, part, cell, depth, seen = _parts(), "tbody", None, 0, 0
    for token in _TOKEN.finditer(html):
        if cell:
            cell["texts"].append(html[seen:token.start()])
        seen, tag, opens = token.end(), (token["tag"] or "").lower(), not token["end"]
        if tag == "br" and cell:
            cell["texts"].append("\n")
        elif tag == "table":
            depth = max(0, depth + (1 if opens else -1))
            if depth == opens:  # the outermost table begins or ends
                if not opens and _any_text(parts):
                    return _grid(parts)
                parts, part, cell = _parts(), "tbody", None
        elif depth == 1 and tag in parts:
            part, cell = tag if opens else "tbody", None
        elif depth == 1 and tag in ("tr", "td", "th"):
            cell = None
            if opens and (tag == "tr" or not parts[part]):
                parts[part].append([])
            if opens and tag != "tr":
                spans = {name.lower(): int(n) for name, n in _SPAN.findall(token["attributes"])}
                cell = {"texts": [], "down": spans.get("rowspan", 1), "across": max(1, spans.get("colspan", 1))}
                parts[part][-1].append(cell)
    if cell:
        cell["texts"].append(html[seen:])
    return _grid(parts) if _any_text(parts) else iter(())


def _parts() -> dict[str, list[list[dict]]]:
    return {"thead": [], "tbody": [], "tfoot": []}


def _any_text(parts: dict[str, list[list[dict]]]) -> bool:
    return any(_text(cell) for part in parts.values() for row in part for cell in row)


def _text(cell: dict) -> str:
    return _SPACES.sub(" ", unescape("".join(cell["texts"])).strip())


def _grid(parts: dict[str, list[list[dict]]]) -> Iterator[Cells]:
    """The rows of all parts, of equal width. A first pass takes the width, so that no row is held."""
    width = 0
    for part in parts.values():
        above = deque()
        for row in _fill_spans(part, above):
            width = max(width, _width(row))
        width = max(width, sum(run[1] for run in above))  # the widest row that spans make below the last
    for part in parts.values():
        above = deque()
        for row in chain(_fill_spans(part, above), _below(above)):
            if row:
                end = _width(row)
                yield Cells(row + [("", end, width - end)] if end < width else row)


def _width(row: list[Run]) -> int:
    return row[-1][1] + row[-1][2] if row else 0


def _fill_spans(part: list[list[dict]], above: deque) -> Iterator[list[Run]]:
    """Rows of runs, with each cell repeated in the rows it spans.

    ``above`` has (first column, columns, text, rows to go) of the cells that reach into the next row.
    """
    for cells in part:
        row, below = [], []

        def put(text: str, width: int, more_rows: int) -> None:
            if more_rows > 0:
                below.append((_width(row), width, text, more_rows))
            row.append((text, _width(row), width))

        def take_from_above() -> None:
            while above and above[0][0] < _width(row):  # covered by a wider cell of this row
                start, width, text, more_rows = above.popleft()
                if start + width > _width(row):
                    above.appendleft((_width(row), start + width - _width(row), text, more_rows))
            while above and above[0][0] == _width(row):
                _, width, text, more_rows = above.popleft()
                put(text, width, more_rows - 1)

        take_from_above()
        for cell in cells:
            put(_text(cell), cell["across"], cell["down"] - 1)
            take_from_above()
        yield row
        above.clear()
        above.extend(below)


def _below(above: deque) -> Iterator[list[Run]]:
    """The rows that cells spanning beyond the last row make, closed up to the left."""
    while above:
        row = []
        for _, width, text, _ in above:
            row.append((text, _width(row), width))
        yield row
        left = [(start, width, text, more_rows - 1) for start, width, text, more_rows in above if more_rows > 1]
        above.clear()
        above.extend(left)
