"""One run of collection: from scanned articles to events, and what was left out and why."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import vocabulary as V
from ..lineage import cut
from ..operators import classify, cluster, enrich, extract, resolve, scan, schedule, state

LOW_SCORE = "활동 분류/점수 기준 미달"
NO_ENTITY = "제목에 대상 아티스트 없음"


@dataclass(frozen=True)
class Settings:
    """Knobs of a run; the defaults are those of a daily one."""

    hours: int = 24
    company: str | None = None
    least_score: int = 40
    publish: bool = False
    publish_score: int = 65
    examples: int = 20
    enrich_limit: int = 20
    undated_score: int = 70
    undated_per_group: int = 2
    title_only: bool = True
    bonus: int = V.NEWS_BONUS
    zone: str | None = None
    backfill: bool = False
    blocked: tuple[str, ...] = ()
    rules: tuple[V.Rule, ...] = V.RULES
    rejections: tuple[V.Rejection, ...] = V.REJECTIONS
    announces: str = V.ANNOUNCES
    schedule: dict = field(default_factory=dict)


@dataclass(frozen=True)
class Run:
    """Selected articles (one per key), excluded ones with their reason, and figures per searched entity."""

    selected: DataFrame
    excluded: DataFrame
    figures: DataFrame


def of_company(entities: DataFrame, company: str | None) -> DataFrame:
    return entities if company is None or company.lower() == "all" else entities.filter(F.upper("company") == company.upper())


def collect(articles: DataFrame, entities: DataFrame, history: DataFrame, now: str, settings: Settings | None = None) -> Run:
    """Window, entity, classification, rejection, event fields, schedule, validation and the best article per key."""
    s = settings or Settings()
    aged = articles.withColumn("age", scan.age(F.col("published_at"), F.to_timestamp(F.lit(now)), s.hours))
    recent = scan.unseen(aged.filter("age = 'recent'")).drop("age")
    aliases = resolve.alias_table(of_company(entities, s.company), list(s.blocked))
    named = resolve.resolve(recent, aliases)
    rated = classify.classify(named, s.rules, title_only=s.title_only)
    scored = rated.withColumn("score", F.col("score") + F.col("publisher_score") + s.bonus)
    why = F.when(F.col("artist_id").isNull(), NO_ENTITY).otherwise(classify.rejection(F.col("title"), F.col("activity_type"), s.rejections, s.announces))
    # three results read the judged rows, and clustering reads the selected ones twice: both are written once
    judged = cut(scored.withColumn("reason", F.when(why != "", why).when(F.col("score") < s.least_score, LOW_SCORE).otherwise("")))
    accepted = extract.event_fields(judged.filter("reason = ''").drop("reason"), zone=s.zone)
    compared = schedule.assess(accepted, history, **s.schedule)
    checked = schedule.validation(compared, backfill=s.backfill, publish=s.publish, least=s.publish_score)
    ready = checked.withColumns({"related_urls": F.array().cast("array<string>"), "supporting_article_count": F.lit(1)})
    excluded = judged.filter("reason <> ''").select("seq", "searched_id", "title", "url", "published_at", "reason")
    chosen = judged.groupBy("searched_id").agg(F.count_if(F.col("reason") == "").alias("selected"))
    figures = scan.figures(aged).join(chosen, "searched_id", "left").na.fill(0, ["selected"])
    return Run(cut(scan.keep_best(ready)), excluded, figures)


def events(selected: DataFrame, hits: DataFrame | None = None, settings: Settings | None = None) -> DataFrame:
    """Clusters of selected articles, enriched from further hits where given, with their keys."""
    s = settings or Settings()
    clustered = cluster.cluster_events(selected)
    found = clustered if hits is None else enrich.enrich(clustered, hits, s.enrich_limit)
    return cut(state.keyed(found))


def stores(found: DataFrame, history: DataFrame, queue: DataFrame, log: DataFrame, now: str) -> tuple[DataFrame, DataFrame]:
    """New history (events selected without review) and new queue (all others)."""
    auto = F.col("validation_status") == "AUTO_SELECTED"
    return state.upsert_history(history, found.filter(auto), now), state.upsert_queue(queue, found.filter(~auto), log, now)
