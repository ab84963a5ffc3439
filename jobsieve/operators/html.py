"""Page snapshots -> visible text, links, cards and posted dates, in one Arrow stage.

This is the only Python stage. One page is one row in and one row out, so it needs no shuffle. Everything that
can be said with native columns (which links count, titles, locations, caps per company) is left to
the operators that read its output.
"""

from __future__ import annotations

import json
import re
import sys
from bisect import bisect_right
from collections.abc import Iterator
from html import escape
from html.parser import HTMLParser
from itertools import accumulate
from urllib.parse import urljoin

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame

from jobsieve import constants as C

EXTRACT_SCHEMA = (
    "url string, render_pass int, final_url string, fetch_ok boolean, body_text string, "
    "links array<struct<href:string,text:string,outer_html:string>>, blocks array<string>, "
    "cards array<struct<href:string,link_text:string,card_title:string,block:int>>, "
    "dates array<struct<date:string,source:string>>"
)
_STRINGS = pa.list_(pa.string())
ARROW_SCHEMA = pa.schema([
    ("url", pa.string()), ("render_pass", pa.int32()), ("final_url", pa.string()), ("fetch_ok", pa.bool_()),
    ("body_text", pa.string()),
    ("links", pa.list_(pa.struct([("href", pa.string()), ("text", pa.string()), ("outer_html", pa.string())]))),
    ("blocks", _STRINGS),
    ("cards", pa.list_(pa.struct([("href", pa.string()), ("link_text", pa.string()),
                                  ("card_title", pa.string()), ("block", pa.int32())]))),
    ("dates", pa.list_(pa.struct([("date", pa.string()), ("source", pa.string())]))),
])
#: A batch of results is closed by so many rows, or by so many characters of the pages they come from. Spark bounds what comes in by bytes.
OUTPUT_ROWS, OUTPUT_CHARS = 64, 8 << 20

# The code travels to the executors with the job, so they need no copy of this package.
for _module in (C, sys.modules[__name__]):
    cloudpickle.register_pickle_by_value(_module)

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HEAD_ONLY = frozenset("base link meta noscript script style template title".split())
UNSEEN = frozenset("head noscript script style template".split())
HEADINGS = frozenset("b h1 h2 h3 h4 h5 h6 strong".split())
BLOCKS = frozenset(
    "address article aside blockquote body dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr html li main nav ol option p pre section summary table tr ul".split()
)
ENDS_PARAGRAPH = BLOCKS - frozenset("body dd dt html li option tr".split())
# Opening the key closes the nearest open element of the first set, unless one of the second set is in between.
CLOSES = {
    "li": ({"li"}, {"ul", "ol"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
    "a": ({"a"}, {"td", "th", "table"}),
    "button": ({"button"}, {"td", "th", "table"}),
}
SPACE_RUN = re.compile(r"[ \t\n\r\f]+")
JS_TRIM = "﻿"


class Node:
    __slots__ = ("tag", "attrs", "parent", "children", "order", "last")

    def __init__(self, tag: str, attrs: dict, parent: Node | None, order: int):
        self.tag, self.attrs, self.parent, self.order = tag, attrs, parent, order
        self.children: list[Node | str] = []
        self.last = order


class Page(HTMLParser):
    """Builds the element tree; unclosed and wrongly nested tags end where a browser would end them."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.nodes: list[Node] = []
        self.root = self._node("html", {}, None)
        self.head: Node | None = None
        self.body: Node | None = None
        self.open = [self.root]
        try:
            self.feed(html)
            self.close()
        except AssertionError:  # markup the parser gives up on: keep what came before it
            pass
        for node in reversed(self.nodes):
            if node.parent is not None and node.last > node.parent.last:
                node.parent.last = node.last

    def _node(self, tag: str, attrs: dict, parent: Node | None) -> Node:
        node = Node(tag, attrs, parent, len(self.nodes))
        self.nodes.append(node)
        if parent is not None:
            parent.children.append(node)
        return node

    def _enter_body(self) -> None:
        if self.body is None:
            self.body = self._node("body", {}, self.root)
            self.open = [self.root, self.body]

    def _close_nearest(self, tags: frozenset | set, stop: frozenset | set) -> None:
        for i in range(len(self.open) - 1, 0, -1):
            tag = self.open[i].tag
            if tag in tags:
                del self.open[i:]
                return
            if tag in stop:
                return

    def handle_starttag(self, tag: str, attrs: list) -> None:
        values = {k: v or "" for k, v in attrs}
        if tag == "html":
            return
        if tag in ("head", "body"):
            if tag == "body":
                self._enter_body()
            elif self.head is None and self.body is None:
                self.head = self._node("head", values, self.root)
                self.open.append(self.head)
            return
        if self.body is None:
            if tag not in HEAD_ONLY:
                self._enter_body()
            elif self.head is None:
                self.head = self._node("head", {}, self.root)
                self.open.append(self.head)
        if tag in ENDS_PARAGRAPH:
            self._close_nearest({"p"}, {"button", "td", "th", "table"})
        if tag in CLOSES:
            self._close_nearest(*CLOSES[tag])
        node = self._node(tag, values, self.open[-1])
        if tag not in VOID:
            self.open.append(node)

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        if tag in ("html", "body"):
            return
        if tag == "head":
            self.open = [self.root] if self.body is None else self.open
            return
        stop = set() if tag in ("table", "td", "th", "tr") else {"td", "th", "table"}
        self._close_nearest({tag}, stop)

    def handle_data(self, data: str) -> None:
        if self.body is None and self.open[-1].tag in ("html", "head"):
            if not data.strip():
                return
            self._enter_body()
        self.open[-1].children.append(data)

    def parse_marked_section(self, i: int, report: int = 1) -> int:
        return self.rawdata.find(">", i) + 1 or -1  # ``<![...`` is a comment up to the next ``>``

    def updatepos(self, i: int, j: int) -> int:
        return j  # line numbers are not used


def _unseen(node: Node) -> bool:
    return node.tag in UNSEEN or "hidden" in node.attrs


def inner_text(top: Node) -> str:
    """Text as shown: blanks collapsed, line breaks at block elements."""
    out: list[str] = []
    breaks, blank = 0, True
    todo: list[Node | str | int] = list(reversed(top.children))
    while todo:
        item = todo.pop()
        if isinstance(item, int):
            breaks = max(breaks, item)
        elif isinstance(item, str):
            shown = SPACE_RUN.sub(" ", item)
            if blank or breaks:
                shown = shown.lstrip(" ")
            if not shown:
                continue
            if breaks and out:
                out[-1] = out[-1].rstrip(" ")
                out.append("\n" * breaks)
            breaks, blank = 0, shown.endswith(" ")
            out.append(shown)
        elif item.tag == "br":
            if out:
                out[-1] = out[-1].rstrip(" ")
            out.append("\n" * (breaks + 1) if out else "")
            breaks, blank = 0, True
        elif not _unseen(item):
            if item.tag in BLOCKS:
                lines = 2 if item.tag == "p" else 1
                todo.append(lines)
                todo.extend(reversed(item.children))
                todo.append(lines)
            else:
                if item.tag in ("td", "th"):
                    todo.append("\t")
                todo.extend(reversed(item.children))
    return "".join(out).strip().strip(JS_TRIM).strip()


def outer_html(node: Node) -> str:
    out: list[str] = []
    todo: list[Node | str | tuple] = [node]
    while todo:
        item = todo.pop()
        if isinstance(item, tuple):
            piece = item[0]
        elif isinstance(item, str):
            piece = escape(item, quote=False)
        else:
            attrs = "".join(f' {k}="{escape(v, quote=False)}"' for k, v in item.attrs.items())
            piece = f"<{item.tag}{attrs}>"
            if item.tag not in VOID:
                todo.append((f"</{item.tag}>",))
                todo.extend(reversed(item.children))
        out.append(piece)
    return "".join(out)


def squeeze(value: str) -> str:
    return " ".join(value.split())


def resolve(base: str, href: str) -> str:
    try:
        return urljoin(base, href.strip())
    except ValueError:
        return href


def label(node: Node) -> str:
    shown = inner_text(node) or node.attrs.get("aria-label") or node.attrs.get("title") or ""
    return shown.strip().strip(JS_TRIM).strip()


def json_dates(data: object) -> list[dict]:
    """T3 on one JSON value: dated keys in document order. The value of a dated key is not searched."""
    found = []
    todo = [(None, data)]
    while todo:
        key, value = todo.pop()
        if key is not None and value and "".join(key.lower().split()).replace("_", "") in C.DATE_KEYS:
            found.append({"date": str(value), "source": C.DATE_JSON_PREFIX + key})
        elif isinstance(value, dict):
            todo.extend(reversed(list(value.items())))
        elif isinstance(value, list):
            todo.extend((None, item) for item in reversed(value))
    return found


def posted_dates(page: Page) -> list[dict]:
    """Dates in ld+json scripts, then in meta tags."""
    from_json, from_meta = [], []
    for node in page.nodes:
        if node.tag == "script" and "ld+json" in node.attrs.get("type", "").lower():
            raw = "".join(c for c in node.children if isinstance(c, str)).strip()
            try:
                from_json.extend(json_dates(json.loads(raw)))
            except (ValueError, RecursionError):
                continue
        elif node.tag == "meta":
            name = node.attrs.get("name") or node.attrs.get("property") or ""
            content = node.attrs.get("content") or ""
            if name and content and squeeze(name.lower()) in C.DATE_META_NAMES:
                from_meta.append({"date": content, "source": C.DATE_META_PREFIX + name})
    return from_json + from_meta


def links_and_cards(page: Page, page_url: str, final_url: str) -> tuple[list, list, list]:
    """T1 and the raw links of T2; a card names its block of text by number."""
    base = final_url
    for node in page.nodes:
        if node.tag == "base" and "href" in node.attrs:
            base = resolve(final_url, node.attrs["href"])
            break
    headings = [n for n in page.nodes if n.tag in HEADINGS]
    orders = [n.order for n in headings]
    shown: dict[int, str] = {}

    def first_heading(top: Node) -> str:
        for i in range(bisect_right(orders, top.order), len(headings)):
            if orders[i] > top.last:
                break
            if i not in shown:
                shown[i] = inner_text(headings[i])
            if shown[i]:
                return shown[i]
        return ""

    links, cards, blocks = [], [], []
    block_of: dict[int, tuple[int, str]] = {}
    for node in page.nodes:
        anchor = node.tag == "a" and "href" in node.attrs
        if not anchor and node.tag != "button" and node.attrs.get("role") != "button":
            continue
        text = label(node)
        href = resolve(base, node.attrs["href"]) if anchor else ""
        if anchor:
            links.append({"href": href, "text": text, "outer_html": outer_html(node)})
        if not anchor and node.tag != "button":
            href = node.attrs.get("href", "").strip()
            href = resolve(page_url, href) if href.startswith("/") else href
        top = node
        for _ in range(6):
            top = top.parent or top
        if top.order not in block_of:
            block_of[top.order] = (len(blocks), first_heading(top))
            blocks.append(squeeze(inner_text(top)))
        block, title = block_of[top.order]
        cards.append({"href": href.strip().rstrip("/"), "link_text": text, "card_title": title, "block": block})
    return links, blocks, cards


def extract(row: dict) -> dict:
    """One snapshot row; ``body_text``, where given, replaces the text derived from the HTML."""
    url, ok = row["url"] or "", bool(row["fetch_ok"])
    final_url = row["final_url"] or url
    body = row["body_text"]
    if not row["html"]:
        return {
            "url": url, "render_pass": row["render_pass"], "final_url": final_url, "fetch_ok": ok,
            "body_text": squeeze(body or ""), "links": [], "blocks": [], "cards": [], "dates": [],
        }
    page = Page(row["html"])
    if body is None:
        body = inner_text(page.body) if page.body is not None else ""
    links, blocks, cards = links_and_cards(page, url, final_url)
    return {
        "url": url, "render_pass": row["render_pass"], "final_url": final_url, "fetch_ok": ok,
        "body_text": squeeze(body), "links": links, "blocks": blocks, "cards": cards,
        "dates": posted_dates(page),
    }


def as_array(values: list, kind: pa.DataType) -> pa.Array:
    """The values as an array. Lists and their structs are laid out field by field, which costs a fraction of handing Arrow a dict per link."""
    if pa.types.is_list(kind):
        ends = pa.array(accumulate(map(len, values), initial=0), pa.int32())
        return pa.ListArray.from_arrays(ends, as_array([item for value in values for item in value], kind.value_type), type=kind)
    if pa.types.is_struct(kind):
        return pa.StructArray.from_arrays([as_array([value[field.name] for value in values], field.type) for field in kind], fields=list(kind))
    return pa.array(values, kind)


def as_batch(done: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([as_array([row[field.name] for row in done], field.type) for field in ARROW_SCHEMA], schema=ARROW_SCHEMA)


def _extract_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        done, size = [], 0
        columns = dict(zip(batch.schema.names, batch.columns))
        for at in range(batch.num_rows):
            row = {name: values[at].as_py() for name, values in columns.items()}
            done.append(extract(row))
            size += len(row["html"] or "") + len(row["body_text"] or "")
            if len(done) >= OUTPUT_ROWS or size >= OUTPUT_CHARS:
                yield as_batch(done)
                done, size = [], 0
        if done:
            yield as_batch(done)


def extract_pages(snapshots: DataFrame) -> DataFrame:
    columns = ("url", "render_pass", "final_url", "html", "body_text", "fetch_ok")
    return snapshots.select(*columns).mapInArrow(_extract_batches, EXTRACT_SCHEMA)
