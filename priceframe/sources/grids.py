"""Tables of web pages as grids of cell texts.

A page's tags are read once, with a stack of open tables: cells belong to the innermost one, so nested tables have rows of
their own, and their text is no part of the cell around them. A cell stands in every row and column that its spans cover. Tags
need not be closed: a new cell, row or table end closes what is open; cells outside a row begin one.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

GRID = "array<struct<table:int,rows:array<array<string>>>>"
_TYPE = pa.list_(pa.struct([("table", pa.int32()), ("rows", pa.list_(pa.list_(pa.string())))]))
_TAG = re.compile(r"<!--.*?(?:-->|$)|<(script|style)\b.*?(?:</\1\s*>|$)|<(/?)(table|tr|td|th|br|p|div|li)\b((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[^>]*>", re.S | re.I)
_SPAN = {k: re.compile(rf"\b{k}\s*=\s*[\"']?\s*(\d+)", re.I) for k in ("rowspan", "colspan")}
#: The largest spans that browsers take.
_MOST = {"rowspan": 65534, "colspan": 1000}


class _Table:
    def __init__(self, number: int):
        self.number = number
        self.rows: list[list[tuple[str, int, int]]] = []
        self.cell: list[str] | None = None
        self.spans = (1, 1)

    def end_cell(self) -> None:
        if self.cell is not None:
            text = re.sub(r"\s+", " ", html.unescape("".join(self.cell)).replace("\xa0", " ")).strip()
            self.rows[-1].append((text, *self.spans))
            self.cell = None

    def begin_cell(self, attributes: str) -> None:
        self.end_cell()
        if not self.rows:
            self.rows.append([])
        found = {k: p.search(attributes) for k, p in _SPAN.items()}
        self.spans = tuple(min(int(m[1]), _MOST[k]) if m and (int(m[1]) or k == "rowspan") else 1 for k, m in found.items())
        self.cell = []

    def grid(self) -> list[list[str]]:
        """Rows of texts; a span of rows ends with the table, a span of no rows goes on to it."""
        self.end_cell()
        out, hanging = [], {}
        for r, cells in enumerate(self.rows):
            row, waiting, place = [], list(reversed(cells)), 0
            while waiting or any(k >= place for k in hanging):
                if place in hanging:
                    text, left = hanging.pop(place)
                    row.append(text)
                    if left > 1:
                        hanging[place] = text, left - 1
                    place += 1
                elif waiting:
                    text, down, across = waiting.pop()
                    down = down or len(self.rows) - r
                    for _ in range(across):
                        if place in hanging:  # the row above reaches into this span
                            break
                        row.append(text)
                        if down > 1:
                            hanging[place] = text, -(down - 1)
                        place += 1
                else:
                    row.append("")
                    place += 1
            # spans that begin in this row count from the next one on
            hanging = {k: (text, abs(left)) for k, (text, left) in hanging.items()}
            out.append(row)
        return [row for row in out if any(row)]


def grids_of(page: str | None) -> list[dict]:
    """The tables of a page that have text, in the order in which they begin: number and rows."""
    stack: list[_Table] = []
    found: list[_Table] = []
    at = 0
    for m in _TAG.finditer(page or ""):
        if stack and stack[-1].cell is not None:
            stack[-1].cell.append(page[at : m.start()])
        at = m.end()
        end, name = m[2], (m[3] or "").lower()
        if name == "table" and not end:
            stack.append(_Table(len(found)))
            found.append(stack[-1])
        elif not stack:
            continue
        elif name == "table":
            stack.pop().end_cell()
        elif name == "tr":
            stack[-1].end_cell()
            if not end:
                stack[-1].rows.append([])
        elif name in ("td", "th"):
            stack[-1].end_cell() if end else stack[-1].begin_cell(m[4])
        elif name and stack[-1].cell is not None:
            stack[-1].cell.append(" ")
    if stack and stack[-1].cell is not None:
        stack[-1].cell.append((page or "")[at:])
    return [{"table": t.number, "rows": rows} for t in found if (rows := t.grid())]


def grids(page: Column) -> Column:
    """The tables of a page, as an array of GRID."""
    return F.arrow_udf(lambda pages: pa.array(map(grids_of, pages.to_pylist()), _TYPE), GRID)(page)
