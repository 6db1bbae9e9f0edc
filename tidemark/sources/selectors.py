"""List and detail pages read by the selectors that a source's settings name.

A selector is a list (commas) of chains of simple selectors (tag, .class, #id, [attribute], with =, ^=,
$=, *= or ~= a value) joined by descent (white space) or by > for a child. Pages are parsed where they
are read; one row comes out per item.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from html.parser import HTMLParser
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .html import LEAST_TITLE, LINK, day_of

# The selectors of a source that names none.
ITEMS = ("article", "li", ".post", ".item")
BODY, TIME = "article, main, .content, .view_cont", "time, .date, .datetime"
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
_SILENT = {"script", "style", "template"}
_PART = re.compile(r"([.#])([\w-]+)|\[\s*([\w-]+)\s*(?:([\^$*~]?=)\s*(\"[^\"]*\"|'[^']*'|[^\]\s]+)\s*)?\]|([a-zA-Z][\w-]*|\*)")


class Node:
    """An element, and which of the page's strings stand inside it."""

    __slots__ = ("tag", "given", "parent", "first", "last")

    def __init__(self, tag: str, given: dict[str, str], parent: Node | None, first: int) -> None:
        self.tag, self.given, self.parent, self.first, self.last = tag, given, parent, first, first


class Tree(HTMLParser):
    """All elements of a page in order; what is open at the end is closed there."""

    def __init__(self, source: str) -> None:
        super().__init__(convert_charrefs=True)
        self.nodes: list[Node] = []
        self.strings: list[str] = []
        self._open: list[Node] = []
        self.feed(source)
        self.close()
        for node in self._open:
            node.last = len(self.strings)

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        node = Node(tag, {k: v or "" for k, v in attrs}, self._open[-1] if self._open else None, len(self.strings))
        self.nodes.append(node)
        if tag not in _VOID:
            self._open.append(node)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in _VOID:
            self._open.pop()

    def handle_endtag(self, tag: str) -> None:
        for n in range(len(self._open) - 1, -1, -1):
            if self._open[n].tag == tag:
                for node in self._open[n:]:
                    node.last = len(self.strings)
                del self._open[n:]
                return

    def handle_data(self, data: str) -> None:
        if (said := " ".join(data.split())) and not (self._open and self._open[-1].tag in _SILENT):
            self.strings.append(said)

    def text(self, node: Node) -> str:
        return " ".join(self.strings[node.first : node.last])


class Selector:
    """A selector, ready to be tried on nodes."""

    def __init__(self, source: str) -> None:
        self.chains = [self._chain(part) for part in re.split(r",(?![^\[]*\])", source)]

    @staticmethod
    def _chain(source: str) -> list[tuple[bool, list[tuple]]]:
        """From the last simple selector to the first: its tests, and whether the one before it must be the parent."""
        parts = re.findall(r">|(?:\[[^\]]*\]|[^\s>\[])+", source)
        chain, child = [], False
        for part in parts:
            if part == ">":
                child = True
                continue
            found = list(_PART.finditer(part))
            if "".join(m[0] for m in found) != part:
                raise ValueError(f"not a selector: {source.strip()}")
            chain.append((child, [m.groups() for m in found]))
            child = False
        if not chain or child or chain[0][0]:
            raise ValueError(f"not a selector: {source.strip()}")
        return chain[::-1]

    @staticmethod
    def _fits(node: Node, tests: list[tuple]) -> bool:
        for sign, name, attribute, how, value, tag in tests:
            if sign == "." and name not in node.given.get("class", "").split():
                return False
            if sign == "#" and node.given.get("id") != name:
                return False
            if tag and tag != "*" and tag.lower() != node.tag:
                return False
            if attribute:
                if attribute.lower() not in node.given:
                    return False
                has, wanted = node.given[attribute.lower()], (value or "").strip("\"'")
                if how and not {"=": has == wanted, "^=": has.startswith(wanted), "$=": has.endswith(wanted), "*=": wanted in has, "~=": wanted in has.split()}[how]:
                    return False
        return True

    def _leads(self, node: Node, chain: list[tuple[bool, list[tuple]]]) -> bool:
        """Whether a node that fits the chain's first entry has the ancestors for the others."""
        if len(chain) == 1:
            return True
        above = node.parent
        while above is not None:
            if self._fits(above, chain[1][1]) and self._leads(above, chain[1:]):
                return True
            if chain[0][0]:
                return False
            above = above.parent
        return False

    def __call__(self, node: Node) -> bool:
        return any(self._fits(node, chain[0][1]) and self._leads(node, chain) for chain in self.chains)


def _address(base: str, href: str) -> str | None:
    try:
        return urljoin(base, html.unescape(href))
    except ValueError:
        return None


def items(pages: DataFrame, *, selectors: tuple[str, ...] = ITEMS, link: str = LINK, least: int = LEAST_TITLE, now: str | None = None) -> DataFrame:
    """page_id, place, url, title, body, day: the first link of every selected node, selector by selector.

    The title is the link's text, else the node's, of ``least`` characters or more; the body is the
    node's text and the day the first full date in it (or, seen from now, the day that it is); each
    address stays once per page, where it came first. pages: page_id, url, html.
    """
    chosen = [Selector(s) for s in selectors]  # a wrong one fails here

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fits, anchor = re.compile(link, re.I), Selector("a[href]")
        for batch in batches:
            rows = []
            for page_id, base, source in zip(*[c.to_pylist() for c in batch.columns]):
                tree, seen = Tree(source or ""), set()
                links = [n for n in range(len(tree.nodes)) if anchor(tree.nodes[n])]
                for select in chosen:
                    for at, node in enumerate(tree.nodes):
                        if not select(node):
                            continue
                        first = next((tree.nodes[n] for n in links if n > at and _inside(tree.nodes[n], node)), None)
                        url = _address(base or "", first.given["href"]) if first else None
                        title = (tree.text(first) or tree.text(node)) if first else ""
                        if url and fits.search(url) and len(title) >= least and url not in seen:
                            seen.add(url)
                            rows.append((page_id, len(seen), url, title, tree.text(node)))
            columns = list(zip(*rows)) or [[]] * 5
            kinds = [pa.int64(), pa.int32(), pa.string(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["page_id", "place", "url", "title", "body"])

    made = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html").mapInArrow(run, "page_id long, place int, url string, title string, body string")
    return made.withColumn("day", day_of(F.col("body"), now))


def _inside(node: Node, outer: Node) -> bool:
    above = node.parent
    while above is not None:
        if above is outer:
            return True
        above = above.parent
    return False


def details(pages: DataFrame, *, body: str = BODY, time: str = TIME, now: str | None = None) -> DataFrame:
    """page_id, body (the text of the first node that ``body`` selects, null without one), day (the first full date in that of ``time``, or the day that it is). pages: page_id, html."""
    wanted = Selector(body), Selector(time)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            said: list[list[str | None]] = [[], []]
            for source in batch.column(1).to_pylist():
                tree = Tree(source or "")
                for select, out in zip(wanted, said):
                    node = next((n for n in tree.nodes if select(n)), None)
                    out.append(tree.text(node) if node else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(s, pa.string()) for s in said]], names=["page_id", "body", "time"])

    made = pages.select(F.col("page_id").cast("long").alias("page_id"), "html").mapInArrow(run, "page_id long, body string, time string")
    return made.select("page_id", "body", day_of(F.col("time"), now).alias("day"))


def followed(listed: DataFrame, fetched: DataFrame, *, body: str = BODY, time: str = TIME, now: str | None = None) -> DataFrame:
    """Listed items with the body of their own page, and its day where the list names none; an item whose page is missing or says nothing keeps what the list says.

    fetched: url, html of the items' pages, each address once (as of ``fetch``).
    """
    pages = listed.select("url").distinct().join(fetched.select("url", "html"), "url").select(F.xxhash64("url").alias("page_id"), "url", "html")
    read = details(pages, body=body, time=time, now=now).withColumnsRenamed({"body": "_body", "day": "_day"})
    known = pages.select("page_id", "url").join(read, "page_id").drop("page_id")
    return listed.join(known, "url", "left").select("page_id", "place", "url", "title", F.coalesce(F.nullif("_body", F.lit("")), "body").alias("body"), F.coalesce("day", "_day").alias("day"))
