"""Applies a review document and builds both feeds anew."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators import decisions, feeds


def apply_document(spark: SparkSession, text: str, history: DataFrame, queue: DataFrame, now: str, *, schema_id: str | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """New history, new queue and log rows; nothing is written here, so a bad document changes nothing."""
    return decisions.apply(decisions.read_document(spark, text, schema_id), history, queue, now)


def documents(history: DataFrame, queue: DataFrame, now: str, **settings) -> tuple[DataFrame, DataFrame]:
    """The calendar feed and the review feed."""
    return feeds.calendar_document(history, queue, now, **settings), feeds.review_document(queue, now, repository=settings.get("repository", ""))
