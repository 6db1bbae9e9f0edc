"""The plan of official sources: their articles, by the entities that each source speaks for."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import vocabulary as V
from ..functions.text import filled
from ..lineage import cut
from ..operators import classify, extract, resolve, scan, schedule
from .daily import LOW_SCORE, of_company

# Why an article is left out.
NO_DATE = "게시일 미확인"
OUTSIDE = "{hours}시간 범위 밖"
#: Bits of a row's seq that tell the entities of one article apart.
ROW_BITS = 12


@dataclass(frozen=True)
class Run:
    """Selected articles (one per key), left-out ones with their reason, and rows per source."""

    selected: DataFrame
    excluded: DataFrame
    sources: DataFrame


def of_sources(sources: DataFrame, entities: DataFrame) -> DataFrame:
    """source_id, source_name, scope, artist_id of the live sources and the entities among ``entities`` for which they speak."""
    live = sources.filter("status = 'LIVE'").select("source_id", F.col("name").alias("source_name"), "scope", F.explode(F.array_distinct("artist_ids")).alias("artist_id"))
    return live.join(entities.select("artist_id"), "artist_id", "left_semi").select("source_id", "source_name", "scope", "artist_id")


def attributed(articles: DataFrame, spoken: DataFrame, aliases: DataFrame) -> DataFrame:
    """One row per article and entity of its source that title or body names; a source of one entity's scope names all of its entities where the text names none.

    articles: seq, source_id, title, body and more. Rows get a seq of their own, in the order of articles and entities.
    """
    texts = articles.select("seq", "source_id", F.concat_ws(" ", filled("title"), filled("body")).alias("title"))
    named = resolve.matches(texts.select("seq", "title"), aliases).select("seq", "artist_id").distinct()
    mine = texts.select("seq", "source_id").join(spoken, "source_id")
    found = mine.join(named, ["seq", "artist_id"], "left_semi")
    fallback = mine.filter("scope = 'artist'").join(found.select("seq").distinct(), "seq", "left_anti")
    both = found.unionByName(fallback).select(F.col("seq").alias("article_seq"), "source_name", "artist_id")
    who = aliases.select("artist_id", "artist", "company", "label", F.col("rank.c").alias("place")).distinct()
    rows = articles.drop("artist_id", "artist", "company", "label", "source_name", "matched_artist_alias").join(both, F.col("seq") == F.col("article_seq")).join(who, "artist_id")
    # an article's entities are few: its rows are numbered among themselves, and the seq is a number of 63 bits of both
    nth = F.row_number().over(Window.partitionBy("article_seq").orderBy("place"))
    article = F.col("article_seq").cast("long")
    room = article.between(0, (1 << 63 - ROW_BITS) - 1) & (nth <= 1 << ROW_BITS)
    return rows.withColumn("seq", F.when(room, F.shiftleft(article, ROW_BITS) + nth - 1).otherwise(F.raise_error(F.lit("no room for a seq")).cast("long"))).drop("place")


def collect(
    articles: DataFrame, sources: DataFrame, entities: DataFrame, history: DataFrame, now: str, *, hours: int = 24, company: str | None = None, least_score: int = 40, rules: tuple[V.Rule, ...] = V.RULES, blocked: tuple[str, ...] = ()
) -> Run:
    """Entities by source, classification over title and body, event fields, schedule, window with reasons, and the best article per key."""
    known = of_company(entities, company)
    spoken = cut(of_sources(sources, known))
    named = attributed(articles.join(spoken.select("source_id").distinct(), "source_id", "left_semi"), spoken, resolve.alias_table(known, list(blocked)))
    rated = classify.classify(named.withColumn("matched_artist_alias", F.lit("")), rules, title_only=False)
    scored = rated.withColumns({"score": F.col("score") + V.OFFICIAL_BONUS, "source_type": F.lit("OFFICIAL"), "official_verified": F.lit(True)})
    compared = schedule.assess(extract.event_fields(scored), history)
    age = scan.age(F.col("published_at"), F.to_timestamp(F.lit(now)), hours)
    why = (
        F.when(age == "missing", NO_DATE).when(age != "recent", OUTSIDE.format(hours=hours)).when((F.col("activity_type") == classify.OTHER) | (F.col("score") < least_score), LOW_SCORE).otherwise("")
    )
    judged = cut(compared.withColumn("reason", why))
    ready = judged.filter("reason = ''").drop("reason")
    runs = spoken.groupBy("source_id", "source_name").agg(F.count(F.lit(1)).alias("entities")).join(judged.groupBy("source_id").agg(F.count(F.lit(1)).alias("rows")), "source_id", "left").na.fill(0, ["rows"])
    return Run(cut(scan.keep_best(ready)), judged.filter("reason <> ''"), runs)
