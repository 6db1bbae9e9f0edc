"""A run over a long window that only feeds the review queue."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import feeds, scan, schedule, state
from . import daily

DAYS_BACK, LIMIT = 180, 80


def settings(days_back: int = DAYS_BACK, base: daily.Settings | None = None) -> daily.Settings:
    return replace(base or daily.Settings(), hours=24 * days_back, backfill=True, enrich_limit=LIMIT)


def candidates(found: DataFrame, today: str, s: daily.Settings | None = None, *, months: int = 3, days_back: int = 14) -> DataFrame:
    """Events inside the calendar's window, and the best undated ones of each entity and activity, with the reason for their review."""
    s = s or settings()
    first, last = feeds.window_of(F.to_date(F.lit(today)), months, days_back)
    dated = found.filter((F.coalesce("event_end_date", "event_start_date") >= first) & (F.col("event_start_date") <= last))
    undated = found.filter(F.col("event_start_date").isNull() & (F.col("score") >= s.undated_score))
    order = [F.col("date_conflict").desc(), F.col("score").desc(), F.col("published_at").desc_nulls_last(), F.col("seq")]
    return schedule.backfill_reason(dated.unionByName(scan.top_per_group(undated, ["artist_id", "activity_type"], order, s.undated_per_group)))


def publish(chosen: DataFrame, queue: DataFrame, log: DataFrame, now: str) -> DataFrame:
    return state.upsert_queue(queue, chosen, log, now)
