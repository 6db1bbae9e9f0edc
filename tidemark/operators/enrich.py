"""A second look for events without a date: the dates of articles found by a new search vote."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.similarity import enrich_anchor, ratio, ratio_bound
from ..functions.text import filled

ALIKE, LEAST = 0.82, 4
NAME_SIZE = 80


def wanted(events: DataFrame, limit: int) -> DataFrame:
    """Events without dates and conflict, the first ``limit`` of them (the searches cost requests)."""
    named = (filled("event_name") != "") & (F.lower(filled("event_name")) != F.lower(filled("artist")))
    return events.filter((F.size("event_dates") == 0) & ~F.col("date_conflict") & named).orderBy("cluster_rank", "seq").limit(limit)


def searches(events: DataFrame, names: DataFrame) -> DataFrame:
    """seq, query: search name, name of the event and what is asked for."""
    word = F.when(F.col("activity_type") == "COMEBACK", "발매일").otherwise("일정")
    return events.join(names, "artist_id").select("seq", F.concat_ws(" ", "search_name", F.substring("event_name", 1, NAME_SIZE), word).alias("query"))


def supporting(events: DataFrame, hits: DataFrame) -> DataFrame:
    """event_seq and the columns of the dated hits of the same entity whose name says the same event."""
    left = events.select(F.col("seq").alias("event_seq"), "artist_id", enrich_anchor(F.col("event_name")).alias("_l"))
    sure = hits.filter((F.size("event_dates") > 0) & ~F.col("date_conflict") & F.col("date_confidence").isin("HIGH", "MEDIUM"))
    met = left.join(sure.withColumn("_r", enrich_anchor(F.col("event_name"))), "artist_id").filter((F.length("_l") >= LEAST) & (F.length("_r") >= LEAST))
    equal = met.filter(F.col("_l") == F.col("_r"))
    like = met.filter((F.col("_l") != F.col("_r")) & (ratio_bound(F.col("_l"), F.col("_r")) >= ALIKE)).filter(ratio("_l", "_r") >= ALIKE)
    return equal.unionByName(like).drop("_l", "_r")


def vote(ballots: DataFrame, *, key: str = "event_seq") -> DataFrame:
    """Per key: the span most articles name (start, end, votes), and tied where two spans lead."""
    counted = ballots.groupBy(key, "start", "end").agg(F.count(F.lit(1)).alias("votes"), F.max("score").alias("score"), F.min("seq").alias("first"))
    order = Window.partitionBy(key).orderBy(F.desc("votes"), F.desc("score"), "first", "start", "end")
    ranked = counted.withColumns({"_r": F.row_number().over(order), "_next": F.lead("votes").over(order)})
    return ranked.filter("_r = 1").select(key, "start", "end", "votes", F.coalesce(F.col("votes") == F.col("_next"), F.lit(False)).alias("tied"))


def enrich(events: DataFrame, hits: DataFrame, limit: int = 20) -> DataFrame:
    """Events; those without a date get the winners' dates, or a conflict where two spans lead."""
    asked = wanted(events, limit)
    found = supporting(asked, hits).withColumns({"start": F.col("event_start_date"), "end": F.coalesce("event_end_date", "event_start_date")})
    won = vote(found)
    best = F.struct((F.col("date_confidence") == "HIGH").alias("a"), (F.col("date_source") == "TITLE").alias("b"), F.col("score").alias("c"), (-F.col("seq")).alias("d"))
    fields = F.struct("event_dates", "date_confidence", "date_evidence", "date_source")
    rows = found.join(won.filter("NOT tied").select("event_seq", "start", "end"), ["event_seq", "start", "end"])
    gathered = rows.groupBy("event_seq", "start", "end").agg(
        F.max_by(fields, best).alias("best"),
        F.array_distinct(F.flatten(F.collect_list("cities"))).alias("more_cities"),
        F.array_distinct(F.flatten(F.collect_list("venues"))).alias("more_venues"),
        F.array_distinct(F.transform(F.array_sort(F.collect_list(F.struct("seq", "url"))), lambda s: s["url"])).alias("more_urls"),
        F.count(F.lit(1)).alias("more"),
    )
    news = won.select("event_seq", "tied").join(gathered, "event_seq", "left").withColumnRenamed("event_seq", "seq")
    joined = events.join(news, "seq", "left")
    new, tied = F.col("best").isNotNull(), F.coalesce("tied", F.lit(False))

    def either(name: str, value, otherwise=None):
        return F.when(new, value).otherwise(F.when(tied, otherwise).otherwise(F.col(name)) if otherwise is not None else F.col(name))

    made = {
        "event_dates": either("event_dates", F.col("best.event_dates")),
        "event_start_date": either("event_start_date", F.col("start")),
        "event_end_date": either("event_end_date", F.col("end")),
        "event_is_range": either("event_is_range", F.col("start") != F.col("end")),
        "date_confidence": either("date_confidence", F.col("best.date_confidence"), F.lit("CONFLICT")),
        "date_evidence": either("date_evidence", F.col("best.date_evidence")),
        "date_source": either("date_source", F.concat(F.lit("ENRICHED_"), F.col("best.date_source"))),
        "date_conflict": either("date_conflict", F.lit(False), F.lit(True)),
        "review_reason": either("review_reason", F.lit("DATE_ENRICHED_REVIEW"), F.lit("DATE_ENRICHMENT_CONFLICT")),
        "cities": either("cities", F.array_sort(F.array_union("cities", F.coalesce("more_cities", F.array().cast("array<string>"))))),
        "venues": either("venues", F.array_sort(F.array_union("venues", F.coalesce("more_venues", F.array().cast("array<string>"))))),
        "related_urls": either("related_urls", F.array_remove(F.array_union("related_urls", "more_urls"), F.col("url"))),
        "supporting_article_count": either("supporting_article_count", (F.col("supporting_article_count") + F.col("more")).cast("int")),
    }
    return joined.select(*[made[c].alias(c) if c in made else F.col(c) for c in events.columns])
