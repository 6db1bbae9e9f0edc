"""Entry points: ``tidemark daily|backfill|review [options]``, or ``spark-submit jobs.py`` with the same.

Stores are CSV as ``sources.files`` reads them. A job works its results out first, writes each store
beside the old one and then puts it in its place, so a job that fails leaves the stores as they were.
"""

from __future__ import annotations

import argparse
import json
from dataclasses import replace
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import schemas
from .lineage import cut, scratch
from .operators import export, feeds, state
from .plans import backfill, daily, review
from .sources import files, search_api, settings, sinks


def _parser() -> argparse.ArgumentParser:
    root = argparse.ArgumentParser(prog="tidemark", description="Event tracking over article feeds")
    jobs = root.add_subparsers(dest="job", required=True)
    for name, about in (("daily", "one run of collection"), ("backfill", "a long window that feeds the review queue"), ("review", "apply a document of review decisions")):
        p = jobs.add_parser(name, help=about)
        p.add_argument("--history", required=True)
        p.add_argument("--review-queue", required=True)
        p.add_argument("--review-log", required=True)
        p.add_argument("--calendar-json", help="where the calendar feed goes")
        p.add_argument("--review-json", help="where the review feed goes")
        p.add_argument("--site", help="settings of the published calendar")
        p.add_argument("--now", help="the run's time as ISO text; now if left out")
        if name == "review":
            p.add_argument("--document", required=True, help="the file with the decisions")
            p.add_argument("--schema-id", help="the schema that the document must name")
            continue
        p.add_argument("--artists", required=True)
        p.add_argument("--activity-entities")
        p.add_argument("--news-config", required=True)
        p.add_argument("--articles", help="articles kept as Parquet; else the search API is asked")
        p.add_argument("--endpoint", help="address of the search API")
        p.add_argument("--company")
        p.add_argument("--min-score", type=int)
        p.add_argument("--out", help="folder of the sheets")
        if name == "daily":
            p.add_argument("--hours", type=int, default=24)
            p.add_argument("--daily-history", help="rows of all runs, as Parquet")
            p.add_argument("--no-persist", action="store_true")
        else:
            p.add_argument("--days-back", type=int, default=backfill.DAYS_BACK)
            p.add_argument("--publish-review-queue", action="store_true")
    return root


def _searched(spark: SparkSession, args: argparse.Namespace, entities: DataFrame, known: settings.Search, hours: int, now: str) -> DataFrame:
    """Articles of this run: kept ones, or what the search API says on every entity."""
    if args.articles:
        kept = files.articles(spark, args.articles)
        return kept.withColumn("matched_artist_alias", F.lit(None).cast("string")) if "matched_artist_alias" not in kept.columns else kept
    if not args.endpoint:
        raise ValueError("name --articles or --endpoint")
    from .operators import resolve

    wide = args.job == "backfill"
    asked = resolve.queries_of(daily.of_company(entities, args.company), list(known.blocked), known.overrides, known.suffixes if wide else ())
    # the dictionary's searches, not its articles, are planned on the driver
    queries = [{"searched_id": r["artist_id"], "query": r["query"]} for r in asked.toLocalIterator()]
    spark.dataSource.register(search_api.SearchApi)
    since = datetime.fromisoformat(now).timestamp() - hours * 3600
    options = {"endpoint": args.endpoint, "queries": json.dumps(queries), "display": str(known.page_size), "pages": str(known.backfill_pages if wide else known.pages), "sort": known.sort, "since": str(since)}
    found = cut(spark.read.format("news_search").options(**options).load())
    numbered = found.withColumn("seq", F.monotonically_increasing_id())
    return search_api.as_articles(numbered, now, publishers=known.publishers or search_api.PUBLISHERS, other=known.other_publisher)


def _stores(spark: SparkSession, args: argparse.Namespace) -> tuple[DataFrame, DataFrame, DataFrame]:
    return files.history(spark, args.history), files.queue(spark, args.review_queue), files.review_log(spark, args.review_log)


def _publish(args: argparse.Namespace, history: DataFrame, queue: DataFrame, now: str) -> dict:
    """Both stores and both feeds."""
    spark = history.sparkSession
    history, queue = cut(history), cut(queue)
    sinks.replace_store(history, args.history, schemas.HISTORY, state.history_order())
    sinks.replace_store(queue, args.review_queue, schemas.QUEUE, state.queue_order())
    site = settings.site(spark, args.site) if args.site else settings.Site()
    calendar, pending = review.documents(history, queue, now, months=site.months, days_back=site.days_back, repository=site.repository)
    for document, path in ((calendar, args.calendar_json), (pending, args.review_json)):
        if path:
            sinks.write_document(document, path)
    return {"confirmed": history.count(), "pending": queue.count()}


def _sheets(args: argparse.Namespace, run: daily.Run, found: DataFrame, history: DataFrame, values: dict, now: str) -> None:
    if args.out:
        spark = found.sparkSession
        missing = {c: F.lit("") for c in ("artist_id", "artist", "company", "label", "activity_type") if c not in run.excluded.columns}
        sinks.write_workbook(export.workbook(found, run.excluded.withColumns(missing) if missing else run.excluded, run.figures, sinks.parameters(spark, values), feeds.calendar_events(history, now[:10])), args.out)


def run_daily(spark: SparkSession, args: argparse.Namespace, now: str) -> dict:
    known = settings.search(spark, args.news_config)
    s = replace(known.daily, hours=args.hours, company=args.company, least_score=args.min_score if args.min_score is not None else known.daily.least_score)
    entities = cut(files.entities(spark, args.artists, args.activity_entities))
    history, queue, log = _stores(spark, args)
    articles = _searched(spark, args, entities, known, s.hours, now)
    run = daily.collect(articles, entities, history, now[:19].replace("T", " "), s)
    found = daily.events(run.selected, None, s)
    new_history, new_queue = daily.stores(found, history, queue, log, now)
    _sheets(args, run, found, new_history, vars(args), now)
    if args.daily_history and not args.no_persist:
        sinks.append_daily(export.selected_rows(found), args.daily_history)
    done = {"selected": run.selected.count(), "events": found.count()}
    return done if args.no_persist else done | _publish(args, new_history, new_queue, now)


def run_backfill(spark: SparkSession, args: argparse.Namespace, now: str) -> dict:
    known = settings.search(spark, args.news_config)
    base = replace(known.daily, company=args.company, least_score=args.min_score if args.min_score is not None else known.daily.least_score)
    s = replace(backfill.settings(max(1, args.days_back), base), enrich_limit=known.backfill_enrich_limit)
    entities = cut(files.entities(spark, args.artists, args.activity_entities))
    history, queue, log = _stores(spark, args)
    site = settings.site(spark, args.site) if args.site else settings.Site()
    run = daily.collect(_searched(spark, args, entities, known, s.hours, now), entities, history, now[:19].replace("T", " "), s)
    found = daily.events(run.selected, None, s)
    chosen = cut(backfill.candidates(found, now[:10], s, months=site.months, days_back=site.days_back))
    _sheets(args, run, chosen, history, vars(args), now)
    done = {"selected": run.selected.count(), "candidates": chosen.count()}
    return done | _publish(args, history, backfill.publish(chosen, queue, log, now), now) if args.publish_review_queue else done


def run_review(spark: SparkSession, args: argparse.Namespace, now: str) -> dict:
    text = spark.read.text(args.document, wholetext=True).first()[0]
    history, queue, _ = _stores(spark, args)
    new_history, new_queue, log = review.apply_document(spark, text, history, queue, now, schema_id=args.schema_id)
    log = cut(log)
    done = _publish(args, new_history, new_queue, now)
    sinks.append_log(log, args.review_log)
    return {"applied": log.count()} | done


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> dict:
    args = _parser().parse_args(argv)
    now = args.now or datetime.now(timezone.utc).isoformat(timespec="seconds")
    spark = spark or SparkSession.builder.appName(f"tidemark {args.job}").getOrCreate()
    with scratch(spark):
        done = {"daily": run_daily, "backfill": run_backfill, "review": run_review}[args.job](spark, args, now)
    print(json.dumps(done))
    return done


if __name__ == "__main__":
    main()
