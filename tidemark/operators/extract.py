"""Event fields of classified articles: name, dates, cities and venues. No shuffle; one pass over the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import dates, names
from ..functions.text import filled, strip_tags


def event_fields(articles: DataFrame, *, zone: str | None = None) -> DataFrame:
    """Adds event_name, event_dates, event_start_date, event_end_date, event_is_range, date_confidence, date_evidence, date_source, date_conflict, cities and venues.

    The day of publication (of fetching, where that is unknown) is the reference; ``zone`` moves
    time stamps that are in UTC into the reader's zone first.
    """
    seen = F.coalesce("published_at", "fetched_at")
    day = F.to_date(F.from_utc_timestamp(seen, zone) if zone else seen)
    read = articles.withColumns({"_title": strip_tags(filled("title")), "_body": strip_tags(filled("body")), "_day": day})
    # one expression over both texts keeps the plan small
    texts = F.array(*[F.struct(F.col(c).alias("text"), F.lit(name).alias("source")) for c, name in (("_title", "TITLE"), ("_body", "BODY"))])
    found = read.withColumn("_found", F.transform(texts, lambda t: dates.candidates(t["text"], F.col("_day"), F.col("activity_type"), t["source"])))
    chosen = found.withColumn("_pick", dates.choose(F.col("_found")[0], F.col("_found")[1])).withColumn("_text", F.trim(F.concat_ws(" ", "_title", "_body")))
    it = F.col("_pick.it")
    made = chosen.withColumns(
        {
            "event_name": names.event_name(F.col("title"), F.col("activity_type"), filled("artist"), filled("matched_artist_alias")),
            "event_dates": F.when(it.isNull(), F.array().cast("array<date>")).otherwise(dates.days(it["start"], it["end"])),
            "event_start_date": it["start"],
            "event_end_date": it["end"],
            "event_is_range": F.coalesce(it["start"] != it["end"], F.lit(False)),
            "date_confidence": dates.confidence(F.col("_pick")),
            "date_evidence": filled(it["evidence"]),
            "date_source": filled(it["source"]),
            "date_conflict": F.col("_pick.conflict"),
            "cities": names.cities(F.col("_text")),
            "venues": names.venues(F.col("_text")),
        }
    )
    return made.drop("_title", "_body", "_day", "_found", "_pick", "_text")
