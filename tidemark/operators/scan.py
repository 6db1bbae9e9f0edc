"""What of a scan is kept: time window, seen URLs, best article per key, and the run's figures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.keys import dedupe_key
from ..functions.text import canonical_url

#: Minutes that an article may lie in the future.
AHEAD = 10


def age(published: Column, now: Column, hours: int) -> Column:
    """missing, outside, future or recent."""
    return F.when(published.isNull(), "missing").when(published < now - F.expr(f"INTERVAL {hours} HOURS"), "outside").when(published > now + F.expr(f"INTERVAL {AHEAD} MINUTES"), "future").otherwise("recent")


def first_per(rows: DataFrame, keys: list[Column | str], order: list[Column | str]) -> DataFrame:
    """One row per key: the first in order."""
    return rows.withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter("_r = 1").drop("_r")


def unseen(articles: DataFrame) -> DataFrame:
    """Of each searched entity's articles with one canonical URL, the first."""
    return first_per(articles.withColumn("_url", canonical_url("url")), ["searched_id", "_url"], ["seq"]).drop("_url")


def keep_best(articles: DataFrame) -> DataFrame:
    """One article per dedupe key: the highest score, then the latest, then the first."""
    keyed = articles.withColumn("dedupe_key", dedupe_key(F.col("artist_id"), F.col("original_url"), F.col("url"), F.col("title")))
    return first_per(keyed, ["dedupe_key"], [F.col("score").desc(), F.col("published_at").desc_nulls_last(), "seq"])


def figures(scanned: DataFrame, by: str = "searched_id") -> DataFrame:
    """Per searched entity: received, recent, outside and missing rows; future ones are counted too, but not as received."""
    counted = {name: F.count_if(F.col("age") == name) for name in ("recent", "outside", "missing", "future")}
    received = F.count_if(F.col("age").isin("recent", "outside", "missing"))
    return scanned.groupBy(by).agg(received.alias("received"), *[c.alias(n) for n, c in counted.items()])


def top_per_group(rows: DataFrame, groups: list[str], order: list[Column], n: int) -> DataFrame:
    """The first n rows of each group. Spark drops rows that cannot rank before it shuffles (WindowGroupLimit)."""
    return rows.withColumn("_r", F.row_number().over(Window.partitionBy(*groups).orderBy(*order))).filter(F.col("_r") <= n).drop("_r")
