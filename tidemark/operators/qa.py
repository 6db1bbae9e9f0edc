"""Precision and recall of found events against a manual list, by what events say."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import truth_key
from ..functions.text import blank_to_null

# A manual list may have Korean headers.
HEADERS = {"artist": ("아티스트", "artist", "artist_id"), "activity": ("활동 유형", "activity_type"), "name": ("행사명", "event_name"), "dates": ("이벤트 날짜", "event_dates"), "cities": ("도시", "cities"), "key": ("event_key",)}


def keys(rows: DataFrame) -> DataFrame:
    """Distinct, non-empty semantic keys, as key."""

    def of(part: str) -> Column:
        given = [blank_to_null(F.col(f"`{c}`")) for c in HEADERS[part] if c in rows.columns]
        return F.coalesce(*given, F.lit(""))

    made = truth_key(*[of(p) for p in ("artist", "activity", "name", "dates", "cities", "key")])
    return rows.select(made.alias("key")).filter("key <> ''").distinct()


def compared(predicted: DataFrame, actual: DataFrame) -> DataFrame:
    """key, outcome (hit, false positive or false negative) of every key of either side."""
    p, a = predicted.withColumn("_p", F.lit(True)), actual.withColumn("_a", F.lit(True))
    outcome = F.when(F.col("_p") & F.col("_a"), "hit").when(F.col("_p"), "false positive").otherwise("false negative")
    return p.join(a, "key", "full_outer").select("key", outcome.alias("outcome"))


def scores(outcomes: DataFrame) -> DataFrame:
    """One row: predicted, actual, hits, false_positives, false_negatives, precision and recall (0 without a denominator)."""
    hit, fp, fn = (F.count_if(F.col("outcome") == o) for o in ("hit", "false positive", "false negative"))
    counted = outcomes.agg(hit.alias("hits"), fp.alias("false_positives"), fn.alias("false_negatives"))

    def share(whole: Column) -> Column:
        return F.when(whole == 0, F.lit(0.0)).otherwise(F.col("hits") / whole)

    predicted, actual = F.col("hits") + F.col("false_positives"), F.col("hits") + F.col("false_negatives")
    return counted.select(predicted.alias("predicted"), actual.alias("actual"), "hits", "false_positives", "false_negatives", share(predicted).alias("precision"), share(actual).alias("recall"))
