"""Table extraction for pages the expression form reads wrongly.

That form goes by tags alone.  Pages with tables inside cells, end tags inside
scripts or rare character references need a real HTML parser; the standard
library's runs here on Arrow batches, page by page, and only on pages that
mention the section.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_LINES = T.ArrayType(
    T.StructType(
        [
            T.StructField("row_no", T.IntegerType()),
            T.StructField("cells", T.ArrayType(T.StringType())),
        ]
    )
)
_ARROW_LINES = pa.list_(pa.struct([("row_no", pa.int32()), ("cells", pa.list_(pa.string()))]))


class _FirstTable(HTMLParser):
    """Header texts and row cell texts of the first table of one section."""

    def __init__(self, section_id: str):
        super().__init__(convert_charrefs=True)
        self.section_id = section_id
        self.section_depth = 0
        self.table_depth = 0
        self.done = False
        self.headers: list[list[str]] = []
        self.rows: list[list[list[str]]] = []
        self.cell: list[str] | None = None

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if self.done:
            return
        if tag == "section" and (self.section_depth or dict(attrs).get("id") == self.section_id):
            self.section_depth += 1
        if not self.section_depth:
            return
        if tag == "table":
            self.table_depth += 1
        if self.table_depth != 1:
            return
        if tag == "tr":
            self.rows.append([])
            self.cell = None
        elif tag == "th":
            self.cell = []
            self.headers.append(self.cell)
        elif tag == "td":
            self.cell = []
            if self.rows:
                self.rows[-1].append(self.cell)

    def handle_endtag(self, tag: str) -> None:
        if self.done or not self.section_depth:
            return
        if tag == "table" and self.table_depth:
            self.table_depth -= 1
            self.done = self.table_depth == 0
        elif tag == "section":
            self.section_depth -= 1
            self.done = self.section_depth == 0 and bool(self.table_depth)
        elif tag in ("td", "th", "tr") and self.table_depth == 1:
            self.cell = None

    def handle_data(self, data: str) -> None:
        if self.cell is not None and not self.done and self.cdata_elem is None:
            self.cell.append(data)


def _read(html: str, section_id: str) -> tuple[list[str], list[list[str]]]:
    parser = _FirstTable(section_id)
    parser.feed(html)
    parser.close()
    headers = ["".join(h).strip() or f"Column_{i}" for i, h in enumerate(parser.headers)]
    return headers, [["".join(c).strip() for c in row] for row in parser.rows[1:]]


def tolerant_tables(pages: DataFrame, section_id: str, carry: Sequence[str]) -> DataFrame:
    """``headers`` and ``lines`` (``row_no, cells`` of each body row) per page with a table."""
    fields = [pages.schema[c] for c in carry]
    fields.append(T.StructField("headers", T.ArrayType(T.StringType())))
    fields.append(T.StructField("lines", _LINES))
    names = [f.name for f in fields]

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_read(html, section_id) for html in batch.column("html").to_pylist()]
            lines = [
                [{"row_no": i, "cells": row} for i, row in enumerate(rows)] for _, rows in found
            ]
            columns = [batch.column(c) for c in carry]
            columns.append(pa.array([h for h, _ in found], pa.list_(pa.string())))
            columns.append(pa.array(lines, _ARROW_LINES))
            yield pa.RecordBatch.from_arrays(columns, names=names)

    # in a generator: a filter would be pushed below whatever made the page, to make it twice
    named = F.filter(F.array("html"), lambda h: F.contains(h, F.lit(section_id)))
    return pages.select(*carry, F.explode(named).alias("html")).mapInArrow(parse, T.StructType(fields))
