"""HTML documents to element rows, run in Arrow batches by ``mapInPandas``."""

from __future__ import annotations

import html
import itertools
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ELEMENTS = "element_id int, element_type string, content string, page_no int"

# Tags without readable text, tags that end a paragraph, cells that belong to a number.
HIDDEN = "head|script|style|title|ix:header"
BREAKING = frozenset(
    ("p", "div", "br", "hr", "ul", "ol", "section", "article", "blockquote", "pre", "center", "body"))
BEFORE_NUMBER = ("$", "US$", "NT$", "€", "£", "¥", "(")
AFTER_NUMBER = (")", "%", ")%", "%)")

# Fixed values of mail bodies: blocks without readable text; tags whose end is a line end; tags
# that are one by themselves; cells; ends that a cell end right behind them takes back.
MAIL_HIDDEN = frozenset(("head", "style", "script", "title", "xml"))
LINE_END = frozenset(("p", "div", "tr", "li", "h1", "h2", "h3", "h4", "h5", "h6", "table", "ul", "ol", "blockquote"))
LINE_BREAK = frozenset(("br", "hr"))
CELLS = frozenset(("td", "th"))
TAKEN_BACK = frozenset(("p", "div", "br"))

_HIDDEN_SPAN = re.compile(rf"<({HIDDEN})\b.*?(?:</\1\s*>|\Z)|<!--.*?(?:-->|\Z)", re.S | re.I)
# A quote opens a value only right after '='; anywhere else it is a plain character. Outside
# of values a tag ends at the next '<' at the latest, so an open tag costs its own length.
_TAG = re.compile(r"<(/?)([A-Za-z][\w:]*)((?:=\s*\"[^\"]*\"|=\s*'[^']*'|[^<>])*+)>|<[!?][^<>]*>")
_ATTRIBUTE = re.compile(r"([^\s=/]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|(\S*))")
_NEW_PAGE = re.compile(r"page-break-(?:before|after)\s*:\s*always", re.I)
_SPAN = re.compile(r"\s*(\d+)")
_WRAPPED = re.compile(r"\A\s*<(?:SEC-)?DOCUMENT>.*?<TEXT>(.*?)(?:</TEXT>|\Z)", re.S | re.I)


def decoded(raw: bytes) -> str:
    """UTF-8, else Windows-1252 with replacement characters."""
    try:
        return raw.decode("utf-8")
    except UnicodeDecodeError:
        return raw.decode("cp1252", errors="replace")


def _attribute(payload: str, name: str) -> str:
    """Value of the first attribute of this name, '' without one."""
    if name not in payload.lower():
        return ""
    return next((a[2] or a[3] or a[4] or "" for a in _ATTRIBUTE.finditer(payload) if a[1].lower() == name), "")


def _one_line(text: str) -> str:
    return " ".join(html.unescape(text).replace("​", " ").split())


def grid_markdown(rows: list[list[tuple[str, int]]]) -> str:
    """Cells (text, colspan) → markdown table, '' when nothing is left.

    Spans are widened, currency and percent cells join their number, a spanning
    header moves over the first column that has data, empty rows and columns go.
    """
    width = max((sum(span for _, span in row) for row in rows), default=0)
    if not width:
        return ""
    grid = np.full((len(rows), width), "", dtype=object)
    wide = []
    for r, row in enumerate(rows):
        starts = itertools.accumulate((span for _, span in row), initial=0)
        for (text, span), c in zip(row, starts):
            grid[r, c] = text
            if text and span > 1:
                wide.append((r, c, c + span))
    for row in grid:
        for c in np.flatnonzero(np.isin(row, (*BEFORE_NUMBER, *AFTER_NUMBER))):
            filled = np.flatnonzero(row != "")
            if row[c] in BEFORE_NUMBER:
                target = filled[filled > c][:1]
                joined = [row[c] + row[k] for k in target]
            else:
                target = filled[filled < c][-1:]
                joined = [row[k] + row[c] for k in target]
            if len(target):
                row[target[0]], row[c] = joined[0], ""
    for r, start, stop in wide:
        others = (np.delete(grid, r, axis=0) != "").any(axis=0)
        if grid[r, start] and not others[start]:
            better = [c for c in range(start + 1, min(stop, width)) if others[c]]
            if better:
                grid[r, better[0]], grid[r, start] = grid[r, start], ""
    solid = grid != ""
    grid = grid[solid.any(axis=1)][:, solid.any(axis=0)]
    if not grid.size:
        return ""
    lines = ["| " + " | ".join(str(v).replace("|", "\\|") for v in row) + " |" for row in grid]
    return "\n".join([lines[0], "|" + "---|" * grid.shape[1], *lines[1:]])


def _pieces(markup: str) -> Iterator[tuple[str, str, str]]:
    """(kind, name, payload) of text runs, opening and closing tags in order."""
    at = 0
    for tag in _TAG.finditer(markup):
        if tag.start() > at:
            yield "text", "", markup[at:tag.start()]
        at = tag.end()
        if tag[2]:
            yield ("close" if tag[1] else "open"), tag[2].lower(), tag[3] or ""
    if at < len(markup):
        yield "text", "", markup[at:]


def _table_rows(pieces: list[tuple[str, str, str]]) -> list[list[tuple[str, int]]]:
    """Rows of the outermost table; nested tables give their text to the outer cell."""
    rows: list[list[tuple[str, int]]] = []
    cell: list[str] | None = None
    span, depth, in_row = 1, 0, False

    def put():
        nonlocal cell
        if cell is not None:
            rows[-1].append((_one_line("".join(cell)), span))
        cell = None

    for kind, name, payload in pieces:
        if name == "table":
            depth += 1 if kind == "open" else -1
        elif depth == 0 and name == "tr":
            put()
            in_row = kind == "open"
            if in_row:
                rows.append([])
        elif depth == 0 and name in ("td", "th"):
            put()
            if kind == "open":
                if not in_row:
                    rows.append([])
                    in_row = True
                found = _SPAN.match(_attribute(payload, "colspan"))
                span, cell = max(1, min(int(found[1]), 50)) if found else 1, []
        elif kind == "text" and cell is not None:
            cell.append(payload)
        if cell is not None and kind == "open" and (depth or name in BREAKING or name == "li"):
            cell.append(" ")
    put()
    return rows


def elements(raw: bytes) -> list[tuple[str, str, int]]:
    """(type, content, page) of a document in reading order."""
    text = decoded(raw)
    wrapped = _WRAPPED.match(text)
    markup = _HIDDEN_SPAN.sub(" ", wrapped[1] if wrapped else text)
    out: list[tuple[str, str, int]] = []
    buffer: list[str] = []
    table: list[tuple[str, str, str]] = []
    mark, kind_now, page, depth = "", "text", 0, 0

    def put(kind: str, content: str):
        if content:
            out.append((kind, content, page))

    def end_block():
        line = _one_line("".join(buffer))
        buffer.clear()
        put(kind_now, mark + line if line else "")

    for kind, name, payload in _pieces(markup):
        if depth == 0 and kind == "open" and _NEW_PAGE.search(_attribute(payload, "style")):
            end_block()
            page += bool(out) and out[-1][2] == page
        if name == "table":
            depth = max(0, depth + (1 if kind == "open" else -1))
            if kind == "open" and depth == 1:
                end_block()
                table = []
                continue
            if kind == "close" and depth == 0:
                put("table", grid_markdown(_table_rows(table)))
                table = []
                continue
        if depth:
            table.append((kind, name, payload))
        elif kind == "text":
            buffer.append(payload)
        elif re.fullmatch(r"h[1-6]|li", name):
            end_block()
            opened = kind == "open"
            mark = ("" if not opened else "- " if name == "li" else "#" * int(name[1]) + " ")
            kind_now = "section_header" if opened and name != "li" else "text"
        elif name in BREAKING:
            end_block()
    if table:
        put("table", grid_markdown(_table_rows(table)))
    end_block()
    return out


def element_rows(docs: DataFrame, key: str, content: str) -> DataFrame:
    """One row per element of every document; a document without text gives one empty row
    so that its status can be told. ``content`` may be text or bytes."""
    fields = f"{key} {docs.schema[key].dataType.simpleString()}, {ELEMENTS}"

    def extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [key, "element_id", "element_type", "content", "page_no"]
        for batch in batches:
            rows = []
            for doc, raw in zip(batch[key], batch[content]):
                data = raw.encode("utf-8") if isinstance(raw, str) else bytes(raw or b"")
                found = elements(data)
                rows += [(doc, i, k, c, p) for i, (k, c, p) in enumerate(found)] or [(doc, None, None, None, None)]
            yield pd.DataFrame(rows, columns=names)

    return docs.select(key, content).mapInPandas(extract, fields)


_MAIL_TAG = re.compile(r"<!--(\[if)?|<(/?)([A-Za-z][A-Za-z0-9]*)[^<>]*>|<[^<>]+>", re.I)
_HIDDEN_END = {name: re.compile(rf"</{name}\s*>", re.I) for name in MAIL_HIDDEN} | {
    "<!--": re.compile("-->"), "<!--[if": re.compile(re.escape("<![endif]-->"), re.I)}
_SOFT_BREAK = re.compile(r"[ \t]*\n[ \t]*")


def _mail_tokens(markup: str) -> Iterator[tuple[str, str, str]]:
    """(kind, name, content) of a mail body: text, open, close. A hidden block or comment, closed or not, is a blank text.

    Of nested and overlapping hidden blocks the one that opens first decides where it ends.
    """
    at = 0
    while tag := _MAIL_TAG.search(markup, at):
        if tag.start() > at:
            yield "text", "", markup[at:tag.start()]
        at, name = tag.end(), (tag[3] or "").lower()
        hidden = tag[0].lower() if tag[0].startswith("<!--") else name if name in MAIL_HIDDEN and not tag[2] else ""
        if hidden:
            end = _HIDDEN_END[hidden].search(markup, at)
            at = end.end() if end else len(markup)
            yield "text", "", " "
        elif name:
            yield ("close" if tag[2] else "open"), name, tag[0]
    if at < len(markup):
        yield "text", "", markup[at:]


def mail_text(markup: str) -> str:
    """Readable text of a mail body: a table row is a line '| a | b |', a line break in the source is a blank.

    The end of a paragraph right before that of its cell is no line end; it is held back
    until the next token tells.
    """
    out: list[str] = []
    held = False
    for kind, name, content in _mail_tokens(markup.replace("\r\n", "\n").replace("\r", "\n")):
        if kind == "text":
            if held and content.strip():
                out.append("\n")
                held = False
            out.append(_SOFT_BREAK.sub(" ", content))
            continue
        cell_end = kind == "close" and name in CELLS
        if held and not cell_end:
            out.append("\n")
        held = False
        if cell_end:
            out.append(" | ")
        elif kind == "open" and name == "tr":
            out.append("\n| ")
        elif kind == "open" and name == "img" and "data:image" in content.lower():
            out.append("[image]")
        elif (name in LINE_END and kind == "close") or (name in LINE_BREAK and kind == "open"):
            held = name in TAKEN_BACK
            out.append("" if held else "\n")
    text = html.unescape("".join(out) + "\n" * held).replace("\xa0", " ")
    lines = (re.sub(r"[ \t]{2,}", " ", line).strip() for line in text.split("\n"))
    return re.sub(r"\n{3,}", "\n\n", "\n".join(lines)).strip()


def payloads(rows: DataFrame, key: str) -> DataFrame:
    """Element rows of a document folded to one payload text per document.

    The group is one document, whose size the source file bounds.
    """
    item = F.struct(F.col("element_id").alias("id"), F.col("element_type").alias("type"), "content", F.col("page_no").alias("page_id"))
    folded = rows.groupBy(key).agg(
        F.array_sort(F.collect_list(F.when(F.col("element_id").isNotNull(), item))).alias("elements"),
        F.coalesce(F.max("page_no"), F.lit(0)).alias("last_page"))
    pages = F.transform(F.sequence(F.lit(0), F.col("last_page")), lambda i: F.struct(i.alias("id")))
    error = F.when(F.size("elements") == 0, F.array(F.struct(F.lit("no text extracted from HTML").alias("error_message"))))
    body = F.struct(F.struct(pages.alias("pages"), F.col("elements")).alias("document"), error.alias("error_status"))
    return folded.select(key, F.to_json(body).alias("payload"))


PAYLOAD = (
    "document struct<pages:array<struct<id:int>>,"
    "elements:array<struct<id:int,type:string,content:string,description:string,page_id:int>>>"
)


def full_text(items: Column) -> Column:
    """Elements joined by a blank line; the description stands in for missing content."""
    pieces = F.transform(items, lambda e: F.coalesce(
        F.nullif(F.trim(e["content"]), F.lit("")), F.nullif(F.trim(e["description"]), F.lit(""))))
    text = F.concat_ws("\n\n", F.filter(pieces, lambda x: x.isNotNull()))
    return F.when(items.isNotNull(), text)


def parse_status(payload: Column, parsed: Column) -> Column:
    """No payload or document: failed. Any error content: partial. Else success."""
    err = F.get_json_object(payload, "$.error_status")
    return (
        F.when(payload.isNull() | parsed["document"].isNull(), F.lit("failed"))
        .when(err.isNotNull() & ~err.isin("null", "[]", "{}", ""), F.lit("partial"))
        .otherwise(F.lit("success"))
    )


def parse_results(docs: DataFrame, key: str) -> DataFrame:
    """(key, payload) → status, error and size columns beside the untouched payload."""
    p = docs.withColumn("p", F.from_json("payload", PAYLOAD))
    status = parse_status(F.col("payload"), F.col("p"))
    items, pages = F.col("p.document.elements"), F.col("p.document.pages")
    return p.select(
        key, status.alias("status"),
        F.when(status == "failed", F.lit("no document in parser output")).when(
            status == "partial", F.substring(F.get_json_object("payload", "$.error_status"), 1, 2000)).alias("error"),
        F.when(pages.isNotNull(), F.size(pages)).alias("page_count"),
        F.when(items.isNotNull(), F.size(items)).alias("element_count"),
        F.length(full_text(items)).cast("long").alias("text_chars"))


def document_elements(docs: DataFrame, key: str) -> DataFrame:
    """One row per element of a payload; the id is the given one, else the position."""
    items = docs.select(F.col(key).alias("_doc"), F.posexplode(F.from_json("payload", PAYLOAD)["document"]["elements"]).alias("seq", "e"))
    return items.select(F.col("_doc").alias("doc_key"), F.coalesce("e.id", "seq").alias("element_id"), "seq", F.col("e.page_id").alias("page_id"),
                        F.col("e.type").alias("element_type"), F.col("e.content").alias("content"))
