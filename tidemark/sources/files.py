"""Dictionaries, stores and caches in files. Only Spark's readers touch the paths."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import filled, formula_restore
from ..schemas import ARTICLE, ENTITY, HISTORY, NOTICE_CACHE, QUEUE, REVIEW_LOG, SEARCH_PAGE, SOURCE, names, text_schema

#: A store whose header lacks this column was written by an older version and counts as empty.
GATE = "date_confidence"


def _json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path, multiLine=True)


def entities(spark: SparkSession, groups: str, members: str | None = None) -> DataFrame:
    """The dictionary of entities with seq and priority; members (solo acts and units) have priority, those not enabled are left out."""
    rows = _json(spark, groups, ENTITY).withColumn("priority", F.lit(False))
    if members:
        rows = rows.unionByName(_json(spark, members, ENTITY).withColumn("priority", F.lit(True)))
    kept = rows.filter(F.coalesce("enabled", F.lit(True))).withColumn("aliases", F.coalesce("aliases", F.array().cast("array<string>")))
    return kept.drop("enabled").withColumn("seq", F.monotonically_increasing_id())


def official_sources(spark: SparkSession, path: str, *, live_only: bool = True) -> DataFrame:
    """Official sources; each URL must lie in its official domain, or the read fails."""
    rows = _json(spark, path, SOURCE)
    host = F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@]*@)?([^/:?#]*)", 1))
    domain = F.lower("official_domain")
    inside = (host == domain) | host.endswith(F.concat(F.lit("."), domain))
    checked = rows.withColumn("url", F.when(filled("official_domain") == "", F.col("url")).when(inside, F.col("url")).otherwise(F.raise_error(F.concat(F.lit("not an official address: "), "url"))))
    return checked.filter("status = 'LIVE'") if live_only else checked


def store(spark: SparkSession, path: str, columns: tuple[str, ...], *, gate: str | None = GATE, key: str | None = None) -> DataFrame:
    """A CSV store as text columns, quotes against formulas taken away; empty where the file is missing, empty or of an older version."""
    empty = spark.createDataFrame([], text_schema(columns))
    try:
        raw = spark.read.csv(path, header=True, multiLine=True, escape='"', encoding="UTF-8")
    except Exception as error:
        if "PATH_NOT_FOUND" in str(error):
            return empty
        raise
    named = raw.toDF(*[c.lstrip("﻿") for c in raw.columns])
    if gate and gate not in named.columns:
        return empty
    rows = named.select(*[(formula_restore(filled(c)) if c in named.columns else F.lit("")).alias(c) for c in columns])
    return rows.filter(filled(key) != "") if key else rows


def history(spark: SparkSession, path: str) -> DataFrame:
    return store(spark, path, HISTORY, key="event_key")


def queue(spark: SparkSession, path: str) -> DataFrame:
    return store(spark, path, QUEUE)


def review_log(spark: SparkSession, path: str) -> DataFrame:
    return store(spark, path, REVIEW_LOG, gate=None)


def articles(spark: SparkSession, path: str) -> DataFrame:
    """Articles kept as Parquet."""
    return spark.read.schema(ARTICLE).parquet(path)


def search_pages(spark: SparkSession, path: str) -> DataFrame:
    """Saved answers of a search API, one JSON document per file or line: the rows of their items, with file and place."""
    rows = spark.read.schema(SEARCH_PAGE).json(path, multiLine=True)
    return rows.select(F.input_file_name().alias("page"), F.posexplode("items").alias("place", "item")).select("page", "place", "item.*")


def notice_cache(spark: SparkSession, path: str) -> DataFrame:
    """A cache of fetched notices in JSON lines: per URL the last line that was written; broken lines are skipped.

    Files count in the order in which they were written, then by name; lines in the order of their file.
    """
    meta = F.col("_metadata")
    at = F.struct(meta["file_modification_time"].alias("t"), meta["file_name"].alias("n"), meta["file_block_start"].alias("b"), F.monotonically_increasing_id().alias("i"))
    rows = spark.read.schema(NOTICE_CACHE).json(path, mode="DROPMALFORMED").withColumn("_at", at)
    return rows.groupBy("url").agg(F.max_by(F.struct(*[c for c in names(NOTICE_CACHE) if c != "url"]), "_at").alias("r")).select("url", "r.*").select(*names(NOTICE_CACHE))


def notice_urls(spark: SparkSession, community: str, first: int, last: int, *, template: str) -> DataFrame:
    """url, notice_id of a sweep over ids, whichever end comes first. template: an address with {community} and {id}."""
    head, tail = template.replace("{community}", community).split("{id}")
    ids = spark.range(min(first, last), max(first, last) + 1)
    return ids.select(F.concat(F.lit(head), F.col("id").cast("string"), F.lit(tail)).alias("url"), F.col("id").cast("string").alias("notice_id"))


def merged_candidates(*found: DataFrame) -> DataFrame:
    """One row per URL of several discoveries (url, source, title, body): sources joined, the first title and body that say something."""
    rows = None
    for i, f in enumerate(found):
        part = f.select("url", "source", "title", "body", F.lit(i).alias("at"))
        rows = part if rows is None else rows.unionByName(part)

    def first(c: str):
        return F.min_by(c, F.when(filled(c) != "", F.col("at")))

    sources = F.array_join(F.array_distinct(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("at", "source"))), lambda s: F.split(s["source"], r"\+")))), "+")
    return rows.groupBy("url").agg(sources.alias("source"), first("title").alias("title"), first("body").alias("body"))


def uncached(candidates: DataFrame, cache: DataFrame) -> DataFrame:
    """Candidates that have to be fetched still."""
    return candidates.join(cache.select("url"), "url", "left_anti")
