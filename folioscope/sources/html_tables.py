"""Table grids from HTML, as a pandas function and a query source."""

from __future__ import annotations

import re
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

GRID = ArrayType(ArrayType(StringType()))


class _Cells(HTMLParser):
    """Collects (row, text, colspan, rowspan) of every closed cell of a closed row."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.rows: list[list[tuple[str, int, int]]] = []
        self.now: list[tuple[str, int, int]] | None = None
        self.parts: list[str] | None = None
        self.span = (1, 1)

    def handle_starttag(self, tag, attrs):
        if tag == "tr":
            self.now = []
        elif tag in ("td", "th") and self.now is not None:
            given = dict(attrs)
            self.parts = []
            self.span = tuple(int(v) if (v := (given.get(name) or "").strip()).isdigit() and int(v) > 0 else 1 for name in ("colspan", "rowspan"))
        elif tag == "br" and self.parts is not None:
            self.parts.append(" ")

    def handle_data(self, data):
        if self.parts is not None:
            self.parts.append(data)

    def handle_endtag(self, tag):
        if tag in ("td", "th") and self.parts is not None and self.now is not None:
            self.now.append((re.sub(r"\s+", " ", "".join(self.parts)).strip(), *self.span))
            self.parts = None
        elif tag == "tr" and self.now is not None:
            self.rows.append(self.now)
            self.now = None


def html_grid(html: str | None) -> list[list[str]]:
    """Rows of equal width. Places that a spanning cell covers are empty strings, and so is what short rows lack."""
    parser = _Cells()
    parser.feed(html or "")
    grid: list[list[str]] = []
    covered: dict[int, int] = {}  # column to rows still covered from above
    for cells in parser.rows:
        row: list[str] = []

        def skip(row=row):
            while covered.get(len(row), 0) > 0:
                covered[len(row)] -= 1
                row.append("")

        skip()
        for text, colspan, rowspan in cells:
            skip()
            first = len(row)
            row += [text, *[""] * (colspan - 1)]
            if rowspan > 1:
                covered |= {c: rowspan - 1 for c in range(first, len(row))}
        skip()
        if row:
            grid.append(row)
    width = max(map(len, grid), default=0)
    return [row + [""] * (width - len(row)) for row in grid]


@F.pandas_udf(GRID)
def html_grids(html: pd.Series) -> pd.Series:
    return html.map(html_grid)
