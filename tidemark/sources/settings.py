"""Settings kept as JSON: searches, scores and vocabulary of a run, and the window of the published calendar."""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

from .. import vocabulary as V
from ..plans.daily import Settings


def _document(spark: SparkSession, path: str) -> dict:
    """One small JSON object; only Spark's reader touches the path."""
    return json.loads(spark.read.text(path, wholetext=True).first()[0].lstrip("﻿"))


@dataclass(frozen=True)
class Search:
    """What a run asks for, and how it rates what comes back."""

    hours: int = 24
    page_size: int = 100
    pages: int = 3
    backfill_pages: int = 2
    sort: str = "date"
    enrich_display: int = 30
    backfill_enrich_limit: int = 80
    suffixes: tuple[str, ...] = ()
    overrides: dict[str, str] = field(default_factory=dict)
    blocked: tuple[str, ...] = ()
    publishers: dict[str, int] = field(default_factory=dict)
    other_publisher: int = V.OTHER_PUBLISHER
    daily: Settings = field(default_factory=Settings)


def search(spark: SparkSession, path: str) -> Search:
    """The search settings of a file; what it lacks keeps its default."""
    given = _document(spark, path)
    base, run = Search(), Settings()
    daily = Settings(
        hours=int(given.get("hours", run.hours)),
        least_score=int(given.get("min_score", run.least_score)),
        publish=bool(given.get("auto_publish_enabled", run.publish)),
        publish_score=int(given.get("auto_publish_min_score", run.publish_score)),
        examples=int(given.get("excluded_examples_per_reason", run.examples)),
        enrich_limit=int(given.get("date_enrichment_max_items", run.enrich_limit)),
        undated_score=int(given.get("backfill_undated_min_score", run.undated_score)),
        undated_per_group=int(given.get("backfill_max_undated_per_artist_activity", run.undated_per_group)),
        blocked=tuple(given.get("blocked_title_aliases", run.blocked)),
    )
    return Search(
        hours=daily.hours,
        page_size=int(given.get("display", base.page_size)),
        pages=int(given.get("max_pages", base.pages)),
        backfill_pages=int(given.get("backfill_max_pages", base.backfill_pages)),
        sort=str(given.get("sort", base.sort)),
        enrich_display=int(given.get("date_enrichment_display", base.enrich_display)),
        backfill_enrich_limit=int(given.get("backfill_date_enrichment_max_items", base.backfill_enrich_limit)),
        suffixes=tuple(given.get("backfill_query_suffixes", base.suffixes)),
        overrides=dict(given.get("search_name_overrides", base.overrides)),
        blocked=daily.blocked,
        publishers={k: int(v) for k, v in given.get("publisher_scores", base.publishers).items()},
        other_publisher=int(given.get("default_publisher_score", base.other_publisher)),
        daily=daily,
    )


@dataclass(frozen=True)
class Site:
    """The published calendar: its repository and how far it looks."""

    repository: str = ""
    months: int = 3
    days_back: int = 14


def site(spark: SparkSession, path: str) -> Site:
    given = _document(spark, path)
    return Site(str(given.get("repository", "")), int(given.get("calendar_months_forward", 3)), int(given.get("calendar_days_back", 14)))
