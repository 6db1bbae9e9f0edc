"""A news search API as a data source, and its items as articles.

Register ``SearchApi`` and read ``format("news_search")``: one input partition per query, pages
read in order until one is short or reaches behind the window. The address and the credentials are
options. Offline, give ``as_articles`` the items of saved answers instead.
"""

from __future__ import annotations

import json
import os
import urllib.parse
import urllib.request
from collections.abc import Iterator
from email.utils import parsedate_to_datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions.text import clean_markup, filled, host
from ..operators.resolve import publisher_score
from ..vocabulary import OTHER_PUBLISHER, PUBLISHERS

MOST_SHOWN, LAST_START, TIMEOUT = 100, 1000, 25
SCHEMA = "searched_id string, search_query string, page int, place int, title string, originallink string, link string, description string, pubDate string"


class _Query(InputPartition):
    def __init__(self, searched_id: str, query: str) -> None:
        self.searched_id, self.query = searched_id, query


def _pages(options: dict, query: str) -> Iterator[tuple[int, list[dict]]]:
    shown = min(MOST_SHOWN, max(1, int(options.get("display", MOST_SHOWN))))
    since = float(options["since"]) if options.get("since") else None
    for page in range(int(options.get("pages", 3))):
        start = min(LAST_START, 1 + page * shown)
        asked = urllib.parse.urlencode({"query": query, "display": shown, "start": start, "sort": options.get("sort", "date")})
        headers = {options.get("idheader", "X-Client-Id"): options["clientid"], options.get("secretheader", "X-Client-Secret"): options["clientsecret"]}
        with urllib.request.urlopen(urllib.request.Request(f"{options['endpoint']}?{asked}", headers=headers), timeout=TIMEOUT) as answer:
            items = json.load(answer).get("items", [])
        yield page, items
        if len(items) < shown:
            return
        if since is not None:
            try:
                oldest = min(parsedate_to_datetime(i["pubDate"]).timestamp() for i in items if i.get("pubDate"))
            except (ValueError, TypeError):
                continue
            if oldest < since:
                return


class _Reader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.options = {k.lower(): v for k, v in options.items()}
        self.options.setdefault("clientid", os.environ.get("SEARCH_CLIENT_ID", ""))
        self.options.setdefault("clientsecret", os.environ.get("SEARCH_CLIENT_SECRET", ""))
        missing = [k for k in ("endpoint", "queries", "clientid", "clientsecret") if not self.options.get(k)]
        if missing:
            raise ValueError(f"news_search needs the options {', '.join(missing)}")

    def partitions(self) -> list[_Query]:
        return [_Query(q["searched_id"], q["query"]) for q in json.loads(self.options["queries"])]

    def read(self, partition: _Query) -> Iterator[tuple]:
        for page, items in _pages(self.options, partition.query):
            for place, i in enumerate(items):
                yield partition.searched_id, partition.query, page, place, i.get("title"), i.get("originallink"), i.get("link"), i.get("description"), i.get("pubDate")


class SearchApi(DataSource):
    """Options: endpoint, queries (JSON list of searched_id and query), clientid, clientsecret, display, pages, sort, since (seconds)."""

    @classmethod
    def name(cls) -> str:
        return "news_search"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> _Reader:
        return _Reader(dict(self.options))


def published(text) -> Column:
    """An RFC 2822 date; null if it is none. The weekday is not read."""
    bare = F.regexp_replace(F.trim(filled(text)), r"^[A-Za-z]{3},\s*", "")
    zoned = F.regexp_replace(bare, r"\s+(GMT|UT|UTC|Z)$", " +0000")
    return F.try_to_timestamp(zoned, F.lit("d MMM yyyy HH:mm:ss xx"))


def as_articles(items: DataFrame, fetched: str, *, publishers: dict[str, int] = PUBLISHERS, other: int = OTHER_PUBLISHER) -> DataFrame:
    """Items (seq, searched_id, search_query and the API's fields) as articles. fetched: a time stamp text."""
    link = F.when(filled("originallink") != "", F.col("originallink")).otherwise(filled("link"))
    made = items.select(
        "seq",
        F.lit("NEWS_SEARCH").alias("source_id"),
        F.lit("NEWS").alias("source_type"),
        "searched_id",
        *[F.lit(None).cast("string").alias(c) for c in ("artist_id", "artist", "company", "label", "matched_artist_alias")],
        clean_markup(filled("title")).alias("title"),
        clean_markup(filled("description")).alias("body"),
        link.alias("url"),
        filled("originallink").alias("original_url"),
        filled("link").alias("naver_url"),
        host(link).alias("publisher"),
        "search_query",
        published("pubDate").alias("published_at"),
        F.to_timestamp(F.lit(fetched)).alias("fetched_at"),
    )
    return publisher_score(made, publishers, other)
