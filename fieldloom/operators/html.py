"""Tables and sections of HTML pages (S23, N35-N37), parsed where the pages are, in Arrow batches."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from fieldloom.operators.columns import q

#: Characters of pages whose rows are gathered before they go on.
PIECE_CHARS = 4_000_000
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}


class Node:
    """An element: tag, attributes, and children that are elements or text."""

    __slots__ = ("tag", "attributes", "children")

    def __init__(self, tag: str, attributes: dict[str, str]):
        self.tag, self.attributes, self.children = tag, attributes, []

    def find_all(self, *tags: str) -> Iterator[Node]:
        """Elements of these tags below this one, in page order."""
        left = self.children[::-1]
        while left:
            c = left.pop()
            if type(c) is not str:
                if c.tag in tags:
                    yield c
                left += c.children[::-1]

    def find(self, *tags: str) -> Node | None:
        return next(self.find_all(*tags), None)

    def text(self) -> str:
        parts = [c if type(c) is str else " " if c.tag == "br" else c.text() for c in self.children]
        return " ".join("".join(parts).split())


_TOKEN = re.compile(r"<(?:!--.*?(?:-->|\Z)|[!?][^>]*+>|(/?)([a-z][^\s/>]*+)((?:[^>=]++|=\s*+\"[^\"]*+\"|=\s*+'[^']*+'|=)*+)>)", re.S | re.I)
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
#: Elements whose content is text up to their end tag.
_RAW = {tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*+>?", re.I) for tag in ("script", "style")}
_CLOSED = {"tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "li": ("li",)}


def parse(html: str | None) -> Node:
    """A page as a tree: one pass over its tags, in time that grows with the page. An end tag without its start is left out."""
    root, page, position = Node("", {}), html or "", 0
    path, count, top = [root], {}, root  # top: the last of path
    end = page.rfind(">") + 1  # behind it there is no tag

    while m := _TOKEN.search(page, position, end):
        start, stop = m.span()
        if start > position:
            data = page[position:start]
            top.children.append(unescape(data) if "&" in data else data)
        position = stop
        ending, tag, told = m.groups()
        if tag is None:
            continue
        tag = tag.lower()
        if not ending:
            if tag in _CLOSED:
                while top.tag in _CLOSED[tag]:
                    count[top.tag] -= 1
                    path.pop()
                    top = path[-1]
            found = {k.lower(): unescape(v or w or x) for k, v, w, x in _ATTRIBUTE.findall(told)} if told else {}
            node = Node(tag, found)
            top.children.append(node)
            if tag in _VOID or told.endswith("/"):
                continue
            if tag in _RAW:
                closing = _RAW[tag].search(page, position)
                raw = page[position : closing.start() if closing else len(page)]
                if raw:
                    node.children.append(raw)
                position = closing.end() if closing else len(page)
                continue
            path.append(node)
            top = node
            count[tag] = count.get(tag, 0) + 1
        elif count.get(tag):
            closed = ""
            while closed != tag:
                closed = path.pop().tag
                count[closed] -= 1
            top = path[-1]
    if len(page) > position:
        data = page[position:]
        top.children.append(unescape(data) if "&" in data else data)
    return root


def table_rows(table: Node) -> tuple[list[str], list[list[Node]]]:
    """Header names and the cells of the other rows."""
    rows = [[c for c in r.children if isinstance(c, Node) and c.tag in ("td", "th")] for r in table.find_all("tr")]
    rows = [r for r in rows if r]
    return ([c.text() for c in rows[0]], rows[1:]) if rows else ([], [])


def from_pages(pages: DataFrame, key: str, html: str, rows_of: Callable[[Node], list[tuple]], columns: str) -> DataFrame:
    """Rows that a function makes of each page; columns are typed after the key."""
    kinds = dict(pages.dtypes)
    return _rows(pages, key, html, rows_of, f"`{key}` {kinds[key]}, {columns}")


def _rows(pages: DataFrame, key: str, html: str, rows_of: Callable[[Node], list[tuple]], schema: str) -> DataFrame:
    """Pages are taken one by one and rows go on whenever the pages behind them come to PIECE_CHARS, so that long pages can't fill a worker."""
    out_type = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def told() -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True)) or [()] * len(out_type)
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, out_type, strict=True)], schema=out_type)

        rows, chars = [], 0
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1)
            for i in range(batch.num_rows):
                page = texts[i].as_py()
                k = keys[i].as_py()
                rows += [(k, *r) for r in rows_of(parse(page))]
                chars += len(page or "")
                if chars >= PIECE_CHARS:
                    yield told()
                    rows, chars = [], 0
        yield told()

    return pages.select(q(key), q(html)).mapInArrow(run, schema)


def html_tables(pages: DataFrame, key: str, html: str) -> DataFrame:
    """The first table of each page as (row_no, cells): cells by header name."""

    def rows_of(page: Node) -> list[tuple]:
        table = page.find("table")
        header, rows = table_rows(table) if table else ([], [])
        return [(i, dict(zip(header, (c.text() for c in r), strict=False))) for i, r in enumerate(rows)]

    return _mapped(pages, key, html, rows_of)


def _mapped(pages: DataFrame, key: str, html: str, rows_of: Callable[[Node], list[tuple]]) -> DataFrame:
    return _rows(pages, key, html, rows_of, f"`{key}` {dict(pages.dtypes)[key]}, row_no int, cells map<string,string>")


def html_table_rules(pages: DataFrame, key: str, html: str, links: dict[str, str] | None = None, prefixes: dict[str, str] | None = None) -> DataFrame:
    """Rows of the first table by header rules: cells of ``links`` headers give their address by link text, those of
    ``prefixes`` get the prefix before it, others their text; digits with commas lose them (N35)."""
    links, prefixes = links or {}, prefixes or {}

    def value(name: str, cell: Node) -> dict[str, str]:
        if name in links:
            return {f"{links[name]}{a.text()}": a.attributes.get("href", "") for a in cell.find_all("a")}
        if name in prefixes:
            a = cell.find("a")
            return {name: prefixes[name] + a.attributes.get("href", "") if a else ""}
        text = cell.text()
        return {name: text.replace(",", "") if re.fullmatch(r"[\d,]+", text) else text}

    def rows_of(page: Node) -> list[tuple]:
        table = page.find("table")
        header, rows = table_rows(table) if table else ([], [])
        out = []
        for i, r in enumerate(rows):
            cells: dict[str, str] = {}
            for name, cell in zip(header, r, strict=False):
                cells |= value(name, cell)
            out.append((i, cells))
        return out

    return _mapped(pages, key, html, rows_of)


def html_sections(pages: DataFrame, key: str, html: str, heading: str = "h3") -> DataFrame:
    """(section, item_no, label, value) of labelled sections: what follows a heading up to the next; list items and table
    rows are items, a bold or header part in front is the label (N36)."""

    def rows_of(page: Node) -> list[tuple]:
        out, section, no = [], None, 0

        def item(node: Node) -> None:
            nonlocal no
            first = node.find("strong", "b", "th", "dt")
            label = first.text().rstrip(":") if first else None
            text = node.text()
            out.append((section, no, label, text[len(first.text()) :].lstrip(": ") if first and text.startswith(first.text()) else text))
            no += 1

        def walk(node: Node) -> None:
            nonlocal section, no
            for c in node.children:
                if not isinstance(c, Node):
                    continue
                if c.tag == heading:
                    section, no = c.text(), 0
                elif section is not None and c.tag in ("li", "tr", "p", "dd"):
                    item(c)
                else:
                    walk(c)

        walk(page)
        return out

    return from_pages(pages, key, html, rows_of, "section string,item_no int,label string,value string")


def section_values(sections: DataFrame, key: str, names: dict[str, str], sep: str = "|") -> DataFrame:
    """{column: section}: the items of a section joined in order, one row a page."""

    def joined(name: str):
        items = F.array_sort(F.collect_list(F.when(F.col("section") == name, F.struct("item_no", "value"))))
        return F.array_join(F.transform(items, lambda x: x["value"]), sep)

    return sections.groupBy(key).agg(*[joined(s).alias(c) for c, s in names.items()])


def html_table_with_link(pages: DataFrame, key: str, html: str, heading: str) -> DataFrame:
    """Rows of the table below a named heading, with the address in the second cell as 'link' (N37)."""

    def rows_of(page: Node) -> list[tuple]:
        order = list(page.find_all("h1", "h2", "h3", "h4", "table"))
        at = next((i for i, n in enumerate(order) if n.tag != "table" and n.text() == heading), None)
        table = next((n for n in order[at:] if n.tag == "table"), None) if at is not None else None
        header, rows = table_rows(table) if table else ([], [])
        out = []
        for i, r in enumerate(rows):
            a = r[1].find("a") if len(r) > 1 else None
            out.append((i, dict(zip(header, (c.text() for c in r), strict=False)) | {"link": a.attributes.get("href", "") if a else ""}))
        return out

    return _mapped(pages, key, html, rows_of)


def cells_to_columns(rows: DataFrame, names: dict[str, str]) -> DataFrame:
    """{column: header}: named cells as columns."""
    return rows.select(*[q(c) for c in rows.columns if c != "cells"], *[F.try_element_at("cells", F.lit(h)).alias(c) for c, h in names.items()])
