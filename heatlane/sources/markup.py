"""HTML pages as rows: a small per-page helper, run by Spark over a page table.

``page_cells`` gives one row per table cell with its grid position and the
marked-up pieces inside it; ``page_elements`` gives one row per chosen element.
Everything after that is DataFrame work (see ``racing.py``).
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOID = {"img", "br", "hr", "meta", "link", "input", "col", "wbr", "source", "area", "base", "embed", "track"}
SILENT = {"script", "style"}
_SIBLINGS = {"p": ("p",), "li": ("li",), "tr": ("tr",), "option": ("option",), "td": ("td", "th"), "th": ("td", "th")}
_BOUNDS = {"table", "ul", "ol", "div", "body", "article", "section"}
PAGES_PER_BATCH = 64
#: Pages of nothing but text and plain tags, cut by one pattern; all others (comments, references, scripts, unquoted attributes
#: ...) go through the HTML parser. Both call the same handlers.
_RAW = "script|style|textarea|title|iframe|noembed|noframes|noscript|xmp|plaintext"
_TAG = rf'<(/?)((?!(?:{_RAW})[ >])[a-z][a-z0-9]*)((?: [a-z]+="[^"&<>]*")*)>'
_PLAIN = re.compile(rf"(?:{_TAG}|[^<&]++)*+")
_TOKEN = re.compile(rf"{_TAG}|([^<&]+)")
_ATTRIBUTE = re.compile(r' ([a-z]+)="([^"]*)"')
PIECE = "struct<tag:string,classes:array<string>,ref:string,text:string>"
CELL_FIELDS = {
    "page_id": "string", "table_no": "int", "table_classes": "array<string>", "section": "string", "body_no": "int",
    "row_no": "int", "body_row": "int", "cell_no": "int", "grid_col": "int", "colspan": "int", "rowspan": "int",
    "tag": "string", "classes": "array<string>", "text": "string", "pieces": f"array<{PIECE}>",
}
ELEMENT_FIELDS = {
    "page_id": "string", "seq": "int", "tag": "string", "classes": "array<string>", "ref": "string", "id": "string",
    "text": "string", "table_no": "int", "row_no": "int", "cell_no": "int",
}


def _ddl(fields: dict) -> str:
    return ", ".join(f"{name} {kind}" for name, kind in fields.items())


class _Open:
    __slots__ = ("tag", "attrs", "texts", "seq", "place")

    def __init__(self, tag, attrs, seq, place):
        self.tag, self.attrs, self.seq, self.place, self.texts = tag, attrs, seq, place, []

    def piece(self):
        a = self.attrs
        return {
            "tag": self.tag,
            "classes": (a.get("class") or "").split(),
            "ref": a.get("href") or a.get("src"),
            "text": " ".join("".join(self.texts).split()) or (a.get("alt") or ""),
        }


class _Walker(HTMLParser):
    """Collects elements in document order, and cells with their grid place."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open, self.done, self.cells, self.silent = [], [], [], 0
        self.tables, self.table_count = [], 0

    def handle_starttag(self, tag, attrs):
        attrs = dict(attrs)
        if tag in SILENT:
            self.silent += 1
            return
        table = self.tables[-1] if self.tables else None
        if tag in _SIBLINGS:
            self._close_open(tag)
        if tag == "table":
            table = {"no": self.table_count, "classes": (attrs.get("class") or "").split(), "section": "",
                     "body": -1, "row": -1, "body_row": -1, "cell": -1, "col": 0, "held": {}}
            self.table_count += 1
            self.tables.append(table)
        elif table is not None and tag in ("thead", "tbody", "tfoot"):
            table["section"], table["body_row"] = tag, -1
            table["body"] += tag == "tbody"
        elif table is not None and tag == "tr":
            table["row"] += 1
            table["body_row"] += 1
            table["cell"], table["col"] = -1, 0
            table["held"] = {c: n - 1 for c, n in table["held"].items() if n > 1}
        place = (table["no"], table["row"], table["cell"]) if table else (None, None, None)
        if table is not None and tag in ("td", "th"):
            place = self._place_cell(table, attrs)
        if tag == "br":
            self.handle_data(" ")
        item = _Open(tag, attrs, len(self.done) + len(self.open), place)
        if tag in VOID:
            self._finish(item)
        else:
            self.open.append(item)

    def _place_cell(self, table, attrs):
        span, down = _number(attrs.get("colspan")), _number(attrs.get("rowspan"))
        while table["held"].get(table["col"], 0) > 0:
            table["col"] += 1
        table["cell"] += 1
        table["here"] = {"grid_col": table["col"], "colspan": span, "rowspan": down, "cell_no": table["cell"]}
        for c in range(table["col"], table["col"] + span):
            table["held"][c] = down
        table["col"] += span
        return table["no"], table["row"], table["cell"]

    def _close_open(self, tag):
        """``<p>``, ``<li>``, ``<td>`` ... end an open sibling of their kind."""
        kinds = _SIBLINGS[tag]
        for i in range(len(self.open) - 1, -1, -1):
            name = self.open[i].tag
            if name in kinds:
                while len(self.open) > i:
                    self._finish(self.open.pop())
                return
            if name in _BOUNDS:
                return

    def _finish(self, item):
        self.done.append(item)
        if item.tag in ("td", "th") and self.tables:
            t = self.tables[-1]
            self.cells.append((t, dict(t.get("here") or {}), t["section"], t["body"], t["row"], t["body_row"], item))
        if item.tag == "table" and self.tables:
            self.tables.pop()

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag in SILENT:
            self.silent = max(0, self.silent - 1)
            return
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i].tag == tag:
                while len(self.open) > i:
                    self._finish(self.open.pop())
                return

    def handle_data(self, data):
        if not self.silent:
            for item in self.open:
                item.texts.append(data)

    def finish(self):
        self.close()
        while self.open:
            self._finish(self.open.pop())
        return self


def _number(text) -> int:
    return int(text) if text and text.isdigit() and int(text) > 0 else 1


def walk(html) -> _Walker:
    w = _Walker()
    text = html.decode("utf-8", "replace") if isinstance(html, (bytes, bytearray)) else (html or "")
    if not _PLAIN.fullmatch(text):
        w.feed(text)
        return w.finish()
    for end, tag, attrs, data in _TOKEN.findall(text):
        if data:
            w.handle_data(data)
        elif end:
            w.handle_endtag(tag)
        else:
            w.handle_starttag(tag, _ATTRIBUTE.findall(attrs) if attrs else ())
    return w.finish()


def _cells_of(page_id, html, pieces: bool = True) -> list[dict]:
    w = walk(html)
    inside: dict = {}
    for item in sorted(w.done, key=lambda x: x.seq) if pieces else ():
        if item.tag not in ("td", "th", "table", "thead", "tbody", "tr"):
            inside.setdefault(item.place, []).append(item.piece())
    rows = []
    for t, here, section, body, row, body_row, item in w.cells:
        piece = item.piece()
        rows.append(
            {
                "page_id": page_id, "table_no": t["no"], "table_classes": t["classes"], "section": section,
                "body_no": body, "row_no": row, "body_row": body_row, **here, "tag": item.tag,
                "classes": piece["classes"], "text": piece["text"], "pieces": inside.get(item.place, []),
            }
        )
    return rows


def _elements_of(page_id, html, tags) -> list[dict]:
    rows = []
    for item in sorted(walk(html).done, key=lambda x: x.seq):
        if item.tag in tags:
            p = item.piece()
            table, row, cell = item.place
            rows.append(
                {"page_id": page_id, "seq": len(rows), "tag": item.tag, "classes": p["classes"], "ref": p["ref"],
                 "id": item.attrs.get("id"), "text": p["text"], "table_no": table, "row_no": row, "cell_no": cell}
            )
    return rows


_LIST = pa.list_(pa.string())
_KINDS = {
    "string": pa.string(), "int": pa.int32(), "array<string>": _LIST,
    f"array<{PIECE}>": pa.list_(pa.struct([("tag", pa.string()), ("classes", _LIST), ("ref", pa.string()), ("text", pa.string())])),
}


def _batch(rows: list[dict], fields: dict) -> pa.RecordBatch:
    made = [pa.array([r.get(name) for r in rows], _KINDS[kind]) for name, kind in fields.items()]
    return pa.RecordBatch.from_arrays(made, list(fields))


def _over_pages(pages: DataFrame, page_id: str, html: str, rows_of, fields: dict) -> DataFrame:
    """Parse pages in parallel, page by page; small output batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, PAGES_PER_BATCH):
                part = batch.slice(i, PAGES_PER_BATCH)
                yield _batch([r for k, h in zip(*[c.to_pylist() for c in part.columns]) for r in rows_of(k, h)], fields)

    return pages.select(F.col(page_id).cast("string").alias("k"), F.col(html).alias("h")).mapInArrow(run, _ddl(fields))


def page_cells(pages: DataFrame, page_id: str = "page_id", html: str = "html", fields: Sequence[str] = tuple(CELL_FIELDS)) -> DataFrame:
    """One row per table cell with the named fields, in parallel over pages; whole pages are read."""
    kinds = {name: CELL_FIELDS[name] for name in fields}
    return _over_pages(pages, page_id, html, lambda k, h: _cells_of(k, h, "pieces" in kinds), kinds)


def page_elements(pages: DataFrame, tags: Sequence[str], page_id: str = "page_id", html: str = "html") -> DataFrame:
    """One row per element with one of the tags, in document order."""
    wanted = frozenset(tags)
    return _over_pages(pages, page_id, html, lambda k, h: _elements_of(k, h, wanted), ELEMENT_FIELDS)
