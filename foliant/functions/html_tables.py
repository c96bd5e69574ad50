"""The cells of HTML tables as a table function: nested tables, spans and unclosed tags."""

from __future__ import annotations

import re
from html.parser import HTMLParser

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCHEMA = "table_no int, parent_no int, row_idx int, col_idx int, rowspan int, colspan int, text_raw string"
#: The most rows or columns that a span may claim, as browsers have it.
MOST_SPAN = 1000


class _Table:
    def __init__(self, number: int, parent: int | None):
        self.number, self.parent, self.row, self.col, self.cell = number, parent, -1, 0, None
        self.taken: dict[int, int] = {}  # column -> the first row that is free of spans from above


class _Reader(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack: list[_Table] = []
        self.count, self.cells = 0, []

    def _end_cell(self) -> None:
        t = self.stack[-1]
        if t.cell is not None:
            place, parts = t.cell
            self.cells.append((t.number, t.parent, *place, re.sub(r"\s+", " ", "".join(parts)).strip()))
            t.cell = None

    def handle_starttag(self, tag, attrs):
        if tag == "table":
            self.stack.append(_Table(self.count, self.stack[-1].number if self.stack else None))
            self.count += 1
        elif self.stack and tag == "tr":
            self._end_cell()
            self.stack[-1].row, self.stack[-1].col = self.stack[-1].row + 1, 0
        elif self.stack and tag in ("td", "th"):
            self._end_cell()
            t, spans = self.stack[-1], dict(attrs)
            t.row = max(t.row, 0)
            size = lambda name: min(MOST_SPAN, max(1, int(m[0]))) if (m := re.match(r"\d{1,9}", spans.get(name) or "")) else 1
            while t.taken.get(t.col, 0) > t.row:
                t.col += 1
            rows, cols = size("rowspan"), size("colspan")
            t.cell = ((t.row, t.col, rows, cols), [])
            for c in range(t.col, t.col + cols):
                t.taken[c] = t.row + rows
            t.col += cols
        elif self.stack and tag in ("br", "p", "div", "li"):
            self.handle_data(" ")

    def handle_endtag(self, tag):
        if self.stack and tag in ("td", "th", "tr"):
            self._end_cell()
        elif self.stack and tag == "table":
            self._end_cell()
            self.stack.pop()

    def handle_data(self, data):
        if self.stack and self.stack[-1].cell is not None:
            self.stack[-1].cell[1].append(data)

    def done(self) -> list[tuple]:
        self.close()
        while self.stack:
            self._end_cell()
            self.stack.pop()
        return sorted(self.cells, key=lambda c: (c[0], c[2], c[3]))


class HtmlCells:
    """eval(html): a row for each cell, by table in order of appearance, row and column."""

    def eval(self, html: str):
        if html:
            reader = _Reader()
            reader.feed(html)
            yield from reader.done()


def html_cells(df: DataFrame, key: str, html: str = "html") -> DataFrame:
    """The cells of all tables in `html`: key, table_no, parent_no, row_idx, col_idx, rowspan, colspan, text_raw.

    A cell's column is the first that no span from above or from its left holds. Tables inside cells are tables of their own with the
    outer one as parent; their text does not count for the outer cell. Missing end tags end with the next cell, row or table; a cell
    before any row is in row 0. White space is one space. Rows without tables give nothing. A table function joined laterally:
    each page is read once, where it lies.
    """
    spark = df.sparkSession
    spark.udtf.register("foliant_html_cells", F.udtf(HtmlCells, returnType=SCHEMA))
    x = df.select(F.col(key).alias("key"), F.col(html).alias("html"))
    return spark.sql("SELECT p.key, c.* FROM {pages} AS p, LATERAL foliant_html_cells(p.html) AS c", pages=x).withColumnRenamed("key", key)
