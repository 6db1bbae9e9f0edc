"""Compares articles with known events: a new event, more dates, more cities, or nothing new."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.similarity import alike as is_alike
from ..functions.similarity import ratio_bound
from ..functions.text import blank_to_null, filled, letters
from ..vocabulary import EXPLICIT_ADDITION, TOUR_FAMILY

ALIKE = 0.48
CITY_BONUS, DATE_BONUS, REVIEW_BONUS = 12, 15, 6


def related(articles: DataFrame, history: DataFrame, *, alike: float = ALIKE) -> DataFrame:
    """Per article seq: previous_event_keys, old_dates and old_cities of the known events it may continue.

    An equi-join by entity; the activity must be the same or both of the tour family, and the
    names alike.
    """
    new = articles.select("seq", "artist_id", F.col("activity_type").alias("new_type"), letters(F.coalesce(blank_to_null("event_name"), F.col("title"))).alias("new_name"))
    old = history.select("artist_id", F.col("activity_type").alias("old_type"), letters(filled("event_name")).alias("old_name"), "event_key", "event_dates", F.col("cities").alias("old_cities"))
    family = F.col("old_type").isin(*TOUR_FAMILY) & F.col("new_type").isin(*TOUR_FAMILY)
    met = new.join(old, "artist_id").filter((F.col("old_type") == F.col("new_type")) | family)
    met = met.filter(ratio_bound(F.col("old_name"), F.col("new_name")) >= alike).filter(is_alike("old_name", "new_name", F.lit(float(alike))))

    def listed(name: str) -> Column:
        return F.array_distinct(F.filter(F.flatten(F.collect_list(F.split(filled(name), r"\|"))), lambda v: v != ""))

    return met.groupBy("seq").agg(
        F.array_sort(F.collect_set(blank_to_null("event_key"))).alias("previous_event_keys"), listed("event_dates").alias("old_dates"), listed("old_cities").alias("old_cities"), F.lit(True).alias("known")
    )


def assess(articles: DataFrame, history: DataFrame, **settings) -> DataFrame:
    """Articles with previous_event_keys and schedule_status; activity_type and score follow the status.

    Tried in this order: an explicit addition, an event without known relatives, a new city, a new
    date in a known city, a new date, nothing new.
    """
    joined = articles.join(related(articles, history, **settings), "seq", "left")
    none = F.array().cast("array<string>")
    dates = F.transform("event_dates", lambda d: d.cast("string"))
    new_city = F.size(F.array_except("cities", F.coalesce("old_cities", none))) > 0
    new_date = F.size(F.array_except(dates, F.coalesce("old_dates", none))) > 0
    same_city = F.arrays_overlap("cities", F.coalesce("old_cities", none))
    status = (
        F.when(filled("title").rlike(f"(?iuU){EXPLICIT_ADDITION}"), "EXPLICIT_ADDITIONAL_SHOW")
        .when(F.col("known").isNull(), "NEW_EVENT")
        .when(new_city, "NEW_CITY")
        .when(new_date & same_city, "SAME_CITY_NEW_DATE")
        .when(new_date, "NEW_DATE_REVIEW")
        .otherwise("EXISTING_SCHEDULE")
    )
    put = joined.withColumns({"schedule_status": status, "previous_event_keys": F.coalesce("previous_event_keys", none)})
    at = F.col("schedule_status")
    more = F.when(at == "NEW_CITY", CITY_BONUS).when(at == "SAME_CITY_NEW_DATE", DATE_BONUS).when(at == "NEW_DATE_REVIEW", REVIEW_BONUS).otherwise(0)
    kind = F.when(at.isin("EXPLICIT_ADDITIONAL_SHOW", "SAME_CITY_NEW_DATE"), "ADDITIONAL_SHOW").when(at == "NEW_CITY", "TOUR_EXPANSION").otherwise(F.col("activity_type"))
    return put.withColumns({"activity_type": kind, "score": F.col("score") + more}).drop("old_dates", "old_cities", "known")


def corroborate(news: DataFrame, official: DataFrame, *, alike: float = ALIKE, bonus: int = 25) -> DataFrame:
    """News with official_verified, and ``bonus`` on the score where an official event shares a date or has a like name."""
    left = news.select("seq", "artist_id", "activity_type", "event_dates", F.lower(F.coalesce(blank_to_null("event_name"), F.col("title"))).alias("l"))
    right = official.select("artist_id", "activity_type", F.col("event_dates").alias("their_dates"), F.lower(F.coalesce(blank_to_null("event_name"), F.col("title"))).alias("r"))
    met = left.join(right, ["artist_id", "activity_type"])
    shared = F.arrays_overlap("event_dates", "their_dates")
    by_name = met.filter(~F.coalesce(shared, F.lit(False))).filter(ratio_bound(F.col("l"), F.col("r")) >= alike).filter(is_alike("l", "r", F.lit(float(alike))))
    seqs = met.filter(shared).select("seq").unionByName(by_name.select("seq")).distinct().withColumn("_met", F.lit(True))
    joined = news.drop("official_verified").join(seqs, "seq", "left")
    return joined.withColumns({"official_verified": F.col("_met").isNotNull(), "score": F.col("score") + F.when(F.col("_met"), bonus).otherwise(0)}).drop("_met")


def validation(articles: DataFrame, *, backfill: bool = False, publish: bool = False, least: int = 65) -> DataFrame:
    """Adds validation_status and review_reason."""
    dated = F.size("event_dates") > 0
    sure = (F.col("date_confidence") == "HIGH") & (F.col("date_source") == "TITLE") & ~F.col("date_conflict")
    auto = F.lit(publish and not backfill) & dated & sure & (F.col("score") >= least)
    reason = F.when(F.col("date_conflict"), "DATE_CONFLICT").when(~dated, "DATE_NOT_FOUND").when(F.col("date_confidence") != "HIGH", "DATE_LOW_CONFIDENCE").otherwise("MANUAL_APPROVAL_REQUIRED")
    if backfill:
        reason = F.lit("BACKFILL_CANDIDATE")
    return articles.withColumns({"validation_status": F.when(auto, "AUTO_SELECTED").otherwise("REVIEW_REQUIRED"), "review_reason": F.when(auto, "").otherwise(reason)})


def backfill_reason(articles: DataFrame) -> DataFrame:
    """Reviews of a backfill, by what is known of the date."""
    reason = (
        F.when(F.col("date_conflict"), "BACKFILL_DATE_CONFLICT")
        .when(F.col("event_start_date").isNull(), "BACKFILL_DATE_NOT_FOUND")
        .when(F.col("date_confidence") == "HIGH", "BACKFILL_DATE_HIGH_REVIEW")
        .otherwise("BACKFILL_DATE_LOW_REVIEW")
    )
    return articles.withColumns({"validation_status": F.lit("REVIEW_REQUIRED"), "review_reason": reason})
