"""Schemas of stored tables. At rest every field is text; lists are joined by bars."""

from __future__ import annotations

from pyspark.sql import types as T

# Columns of the stores in their order.
HISTORY = (
    "event_key", "company", "label", "artist_id", "artist", "activity_type", "event_name", "event_start_date", "event_end_date", "event_dates",
    "date_confidence", "date_evidence", "date_source", "date_conflict", "cities", "venues", "first_seen", "last_seen", "status", "primary_url",
    "source_type", "official_verified", "score", "supporting_article_count", "related_urls", "approval_status", "article_title", "reviewed_at", "review_source",
)
QUEUE = (
    "candidate_id", "event_key", "company", "label", "artist_id", "artist", "activity_type", "event_name", "event_start_date", "event_end_date",
    "event_dates", "date_confidence", "date_evidence", "date_source", "date_conflict", "cities", "venues", "article_title", "published_at", "score",
    "review_reason", "primary_url", "naver_url", "related_urls", "supporting_article_count", "clipped_text", "first_seen", "last_seen", "review_status",
)
REVIEW_LOG = ("reviewed_at", "action", "candidate_id", "event_key", "artist", "activity_type", "event_name", "note")


def text_schema(columns: tuple[str, ...]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def names(ddl: str) -> list[str]:
    return [c.split()[0] for c in ddl.split(", ")]


ENTITY = "artist_id string, company string, label string, name string, aliases array<string>, official_url string, source_ids array<string>, enabled boolean"
SOURCE = (
    "source_id string, scope string, company string, label string, name string, url string, adapter string, official_domain string, status string, artist_ids array<string>, options map<string,string>"
)
SEARCH_PAGE = "items array<struct<title:string,originallink:string,link:string,description:string,pubDate:string>>"
ARTICLE = (
    "seq long, source_id string, source_type string, searched_id string, artist_id string, artist string, company string, label string, title string, body string, url string, "
    "original_url string, naver_url string, publisher string, publisher_score int, search_query string, published_at timestamp, fetched_at timestamp"
)
NOTICE_CACHE = (
    "artist string, company_group string, source_type string, url string, notice_id string, title string, body string, fetched_at string, "
    "http_status int, fetch_error string, search_title string, search_body string, extraction_method string"
)
