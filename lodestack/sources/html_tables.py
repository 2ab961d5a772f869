"""The first table of HTML pages, as browsers build it.

Tags may be left out in tables: a row opens a body, a cell opens a row, a cell or row ends where the
next begins, and a table in a cell is a part of that cell. Pages hold no more structure than
that here: the builder keeps a stack of open tables, sections, rows and cells, and lets all other
elements pass as carriers of text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

# The elements that make up a table, by the part that each plays.
SECTIONS, CELLS = {"tbody", "thead", "tfoot"}, {"td", "th"}
TEXTS = CELLS | {"caption"}
PARTS = SECTIONS | CELLS | {"caption", "colgroup", "col", "tr"}
#: Tags that need no more than their name, and elements whose content is no markup.
PLAIN_TAG = re.compile(r"""<(/?)([A-Za-z][A-Za-z0-9]*)((?:\s+[A-Za-z-]+(?:=(?:"[^"<>]*"|'[^'<>]*'))?)*)\s*>""")
RAW = {"script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes", "noscript", "plaintext", "math", "svg"}


class _Cell:
    """The texts of a cell; ``tables`` has the places where its open tables stand among them."""

    def __init__(self):
        self.texts: list[str] = []
        self.tables: list[int] = []


class FirstTable(HTMLParser):
    """The rows within bodies of a page's first table: lists of cells, with those of nested tables."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.rows: list[list[_Cell]] = []
        self.open: list[str] = []
        self.cells: list[_Cell] = []  # of open td
        self.into: list[list[_Cell] | None] = []  # rows of open tr; None outside of bodies
        self.over = False

    def _inner(self) -> str:
        return self.open[-1] if self.open else ""

    def _in_table(self, tag: str) -> bool:
        """Whether the innermost table has ``tag`` open."""
        for name in reversed(self.open):
            if name == tag:
                return True
            if name == "table":
                return False
        return False

    def _pop(self) -> None:
        tag = self.open.pop()
        if tag == "td":
            self.cells.pop()
        elif tag == "tr":
            self.into.pop()
        elif tag == "table":
            for cell in self.cells:
                cell.tables.pop()
            self.over = not self.open

    def _pop_until(self, *tags: str) -> None:
        """Close what is open down to and with the first of ``tags``."""
        while self.open:
            tag = self._inner()
            self._pop()
            if tag in tags:
                return

    def _back_to(self, *tags: str) -> None:
        while self._inner() not in tags:
            self._pop()

    def _start_table(self) -> None:
        # only a cell or a caption holds a table; elsewhere a second one ends the first
        if self.open and self._inner() not in TEXTS:
            self._pop_until("table")
        if not self.over:
            for cell in self.cells:
                cell.tables.append(len(cell.texts))
            self.open.append("table")

    def _start_part(self, tag: str) -> None:
        inner = self._inner()
        if inner in CELLS or inner == "caption":
            self._pop()
        if self._inner() == "colgroup" and tag != "col":
            self._pop()
        if tag in CELLS:
            if self._inner() == "table":
                self.open.append("tbody")
            if self._inner() in SECTIONS:
                self._start_row()
            self.open.append(tag)
            if tag == "td":
                cell = _Cell()
                self.cells.append(cell)
                for row in self.into:
                    if row is not None:
                        row.append(cell)
        elif tag == "tr":
            if self._inner() == "tr":
                self._pop()
            if self._inner() == "table":
                self.open.append("tbody")
            self._start_row()
        elif tag != "col" or self._inner() != "colgroup":
            self._back_to("table")
            self.open.append("colgroup" if tag == "col" else tag)

    def _start_row(self) -> None:
        cells = None
        if "tbody" in self.open:
            cells = []
            self.rows.append(cells)
        self.open.append("tr")
        self.into.append(cells)

    def handle_starttag(self, tag, attrs):
        if self.over:
            return
        if tag == "table":
            self._start_table()
        elif self.open and tag in PARTS:
            self._start_part(tag)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)  # a slash does not end an element

    def handle_endtag(self, tag):
        if self.over or not self.open or (tag not in PARTS and tag != "table"):
            return
        inner = self._inner()
        if tag == "col" or (tag in CELLS and inner != tag) or (inner == "caption" and tag not in ("caption", "table")):
            return
        if inner == tag:
            self._pop()
        elif self._in_table(tag):
            self._pop_until(tag)

    def handle_data(self, data):
        text = data.strip()
        if self.over or not text:
            return
        if self._inner() in TEXTS:
            for cell in self.cells:
                cell.texts.append(text)
            return
        # text between the parts of a table stands before that table
        for cell in self.cells:
            cell.texts.insert(cell.tables[-1], text)
            cell.tables[-1] += 1


def _feed(parser: FirstTable, page: str) -> None:
    """Hand ``page`` to the builder. Where all its tags are plain, they are cut by one expression; other pages go to the library's parser."""
    pieces = PLAIN_TAG.split(page)
    names = [name.lower() for name in pieces[2::4]]
    ends = pieces[1::4]
    if any("<" in text for text in pieces[0::4]) or not RAW.isdisjoint(names) or any(end and attrs for end, attrs in zip(ends, pieces[3::4])):
        parser.feed(page)
        parser.close()
        return
    for end, name, text in zip(ends, names, pieces[4::4]):
        if name in PARTS or name == "table":
            if end:
                parser.handle_endtag(name)
            else:
                parser.handle_starttag(name, None)
            if parser.over:
                return
        if parser.open and text and not text.isspace():
            parser.handle_data(unescape(text) if "&" in text else text)


def first_table(page: str | None) -> list[list[str]]:
    parser = FirstTable()
    _feed(parser, page or "")
    return [[" ".join(cell.texts) for cell in row] for row in parser.rows]


def _regular() -> str:
    """Pages of which the first table is a list of rows of td with plain text, after a head that may be left out: what these say, the builder need not tell."""
    attrs = r"""(?:\s+[A-Za-z-]+(?:=(?:"[^"<>]*"|'[^'<>]*'))?)*\s*"""
    carrier = "(?:html|head|body|div|p|span|h[1-6]|section|main|header|footer|nav|ul|ol|li|a|b|i|em|strong|br|hr|meta|link)"
    start, text = lambda name: f"<{name}{attrs}>", "[^<>]*"
    row = lambda cell: rf"{start('tr')}\s*(?:{start(cell)}{text}</{cell}>\s*)*</tr>\s*"
    head = rf"(?:{start('thead')}\s*(?:{row('th')})*</thead>\s*)?"
    body = rf"(?:{start('tbody')}\s*(?:{row('td')})*</tbody>\s*)+"
    return rf"^(?:{text}(?:{start(carrier)}|</{carrier}>))*{text}{start('table')}\s*{head}{body}</table>"


REGULAR = _regular()


def _regular_cells(pages: pa.Array) -> tuple[np.ndarray, pa.ListArray]:
    """(how many rows each page has, their cells) of regular pages, cut in Arrow without an object per cell."""
    piece = lambda a, mark, i, **how: pc.list_element(pc.split_pattern(a, mark, max_splits=1, **how), i)

    def cut(a: pa.Array, mark: str) -> tuple[pa.Array, np.ndarray]:
        """The pieces before a mark, and how many each text has; what is behind the last mark is left out."""
        lists = pc.split_pattern(a, mark)
        n = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        kept = np.ones(int(n.sum()), bool)
        kept[np.cumsum(n) - 1] = False
        return lists.flatten().filter(pa.array(kept)), n - 1

    rows, n_rows = cut(piece(piece(pages, "<tbody", 1), "</table>", 0), "</tr>")
    cells, n_cells = cut(rows, "</td>")
    texts = pc.utf8_trim_whitespace(piece(cells, ">", 1, reverse=True)) if len(cells) else cells
    coded = pc.match_substring(texts, "&")
    if pc.any(coded).as_py():
        texts = pc.replace_with_mask(texts, coded, pa.array([unescape(x).strip() for x in texts.filter(coded).to_pylist()], pa.string()))
    return n_rows, pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(n_cells)], pa.int32()), texts)


def table_cells(pages: DataFrame, key: str, html: str, every_page: bool = False) -> DataFrame:
    """(key, row_index, cells) of the rows in bodies of each page's first table; rows of nested tables are rows as well.

    A page without a table has no rows, nor has a null or empty one. With ``every_page`` each page has one row more, with nulls.
    """
    schema = StructType([StructField(key, pages.schema[key].dataType), StructField("row_index", IntegerType()), StructField("cells", ArrayType(StringType()))])

    def rows_of(keys: pa.Array, n_rows: np.ndarray, lists: pa.ListArray) -> pa.RecordBatch:
        index = np.arange(n_rows.sum()) - np.repeat(np.cumsum(n_rows) - n_rows, n_rows)
        return pa.RecordBatch.from_arrays([keys.take(pa.array(np.repeat(np.arange(len(keys)), n_rows), pa.int64())), pa.array(index, pa.int32()), lists], [key, "row_index", "cells"])

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, html = batch.column(0), batch.column(1)
            regular = pc.fill_null(pc.match_substring_regex(html, REGULAR), False)
            yield rows_of(keys.filter(regular), *_regular_cells(html.filter(regular)))
            others = pc.invert(regular)
            found = [first_table(page.as_py()) for page in html.filter(others)]
            ends = np.cumsum([0, *(len(row) for rows in found for row in rows)])
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array([text for rows in found for row in rows for text in row], pa.string()))
            yield rows_of(keys.filter(others), np.array([len(rows) for rows in found], np.int64), lists)
            if every_page:
                yield pa.RecordBatch.from_arrays([keys, pa.nulls(len(keys), pa.int32()), pa.nulls(len(keys), pa.list_(pa.string()))], [key, "row_index", "cells"])

    # plain names for the batches, as a name with a dot could not be passed on
    return pages.select(F.col(f"`{key}`").alias("key"), F.col(f"`{html}`").alias("html")).mapInArrow(cells, schema)
