"""Links, titles and texts of HTML pages. Pages are parsed where they are read; rows come out through Arrow."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from html.parser import HTMLParser
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.freedates import free_date
from ..functions.text import canonical_url, filled
from ..operators.scan import first_per

LINK = r"(notice|newsroom|news|report|post|detail)"
LEAST_TITLE = 4
# Fixed value: a full date in a page's text.
DAY = r"(20\d{2})[.\-/년]\s*(\d{1,2})[.\-/월]\s*(\d{1,2})"
_SILENT = {"script", "style", "noscript", "template"}
_ITEMS = {"article", "li"}
_ITEM_CLASSES = {"post", "item"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}


class _Page(HTMLParser):
    """Collects the title, heading, declared title and date, text outside scripts, and every link with its text and the item it stands in."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.title, self.heading, self.og_title, self.published, self.text, self.links = "", "", "", "", [], []
        self._open: list[tuple[str, bool]] = []
        self._item, self._items = 0, 0

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        given = {k: v or "" for k, v in attrs}
        if tag == "meta":
            if given.get("property") == "og:title":
                self.og_title = self.og_title or given.get("content", "")
            if given.get("property") == "article:published_time":
                self.published = self.published or given.get("content", "")
        if tag == "time":
            self.published = self.published or given.get("datetime", "")
        if tag in _VOID:
            return
        is_item = tag in _ITEMS or bool(_ITEM_CLASSES & set(given.get("class", "").split()))
        self._open.append((tag, is_item))
        if is_item:
            self._items += 1
        if tag == "a" and given.get("href"):
            self.links.append([given["href"], "", self._items if any(i for _, i in self._open) else 0])

    def handle_endtag(self, tag: str) -> None:
        for n in range(len(self._open) - 1, -1, -1):
            if self._open[n][0] == tag:
                del self._open[n:]
                return

    def handle_data(self, data: str) -> None:
        tags = {t for t, _ in self._open}
        if tags & _SILENT:
            return
        if "title" in tags:
            self.title += data
            return
        if "h1" in tags:
            self.heading += data
        if "a" in tags and self.links:
            self.links[-1][1] += data
        self.text.append(data)


def _space(text: str) -> str:
    return " ".join(text.split())


_ROW = pa.schema(
    [
        ("page_id", pa.int64()),
        ("url", pa.string()),
        ("title", pa.string()),
        ("published", pa.string()),
        ("text", pa.string()),
        ("links", pa.list_(pa.struct([("href", pa.string()), ("said", pa.string()), ("item", pa.int32())]))),
    ]
)


def parsed(pages: DataFrame) -> DataFrame:
    """page_id, url, title (declared, else heading, else title tag), published (as declared), text, links (address, text, number of the list item, 0 outside). pages: page_id, url, html."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for page_id, url, source in zip(*[c.to_pylist() for c in batch.columns]):
                page = _Page()
                page.feed(source or "")
                page.close()
                title = next((t for t in map(_space, (page.og_title, page.heading, page.title)) if t), "")
                links = [{"href": urljoin(url or "", html.unescape(h)) if _joins(h) else h, "said": _space(s), "item": i} for h, s, i in page.links]
                rows.append({"page_id": page_id, "url": url, "title": title, "published": page.published, "text": _space(" ".join(page.text)), "links": links})
            yield pa.RecordBatch.from_pylist(rows, schema=_ROW)

    kinds = "page_id long, url string, title string, published string, text string, links array<struct<href:string,said:string,item:int>>"
    return pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html").mapInArrow(run, kinds)


def day_of(said: Column, now: str | None = None) -> Column:
    """The first day of this century that a text names as year, month and day; with now (a time stamp), else the day that the text as a whole is, as people write days."""
    found = F.regexp_extract_all(filled(said), F.lit(DAY), F.lit(0))
    parts = [F.regexp_extract(F.try_element_at(found, F.lit(1)), DAY, g) for g in (1, 2, 3)]
    full = F.try_to_date(F.concat_ws("-", parts[0], F.lpad(parts[1], 2, "0"), F.lpad(parts[2], 2, "0")), "yyyy-MM-dd")
    return full if now is None else F.coalesce(full, free_date(said, F.to_timestamp(F.lit(now))))


def _joins(href: str) -> bool:
    try:
        urljoin("http://x/", href)
    except ValueError:
        return False
    return not re.match(r"(?i)(javascript|mailto|tel):", href)


def listed(pages: DataFrame, *, link: str = LINK, least: int = LEAST_TITLE, items_only: bool = True) -> DataFrame:
    """page_id, url, title of the first matching link of each list item; titles of ``least`` characters or more; each address once per page."""
    links = parsed(pages).select("page_id", F.posexplode("links").alias("place", "l")).select("page_id", "place", F.col("l.href").alias("url"), F.col("l.said").alias("title"), F.col("l.item").alias("item"))
    fit = links.filter(F.col("url").rlike(f"(?iuU){link}") & (F.length(filled("title")) >= least))
    if items_only:
        fit = first_per(fit.filter("item > 0"), ["page_id", "item"], ["place"])
    return first_per(fit.withColumn("_url", canonical_url("url")), ["page_id", "_url"], ["place"]).drop("_url", "item")


def notices(pages: DataFrame, *, link: str) -> DataFrame:
    """page_id, url of every distinct link that matches, by address."""
    return parsed(pages).select("page_id", F.explode("links.href").alias("url")).filter(F.col("url").rlike(link)).distinct()
