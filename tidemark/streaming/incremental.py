"""Collection as a stream: late and repeated articles are bounded by a watermark, stores are upserted per micro-batch.

State per key is kept by Spark only as long as the watermark needs it. Store snapshots are written
beside the old ones, and the newest complete one counts; a batch that is run again after a
failure writes the same snapshot under the same name.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from ..functions.keys import dedupe_key
from ..operators import state
from ..schemas import HISTORY, QUEUE, text_schema

LATE = "24 hours"


def deduplicated(articles: DataFrame, late: str = LATE) -> DataFrame:
    """The first article per key within the watermark. A stream has no later look for a better one; ``scan.keep_best`` chooses inside a batch."""
    keyed = articles.withColumn("dedupe_key", dedupe_key(F.col("artist_id"), F.col("original_url"), F.col("url"), F.col("title")))
    return keyed.withWatermark("published_at", late).dropDuplicatesWithinWatermark(["dedupe_key"])


def activity_counts(articles: DataFrame, width: str = "1 day", slide: str | None = None, late: str = LATE) -> DataFrame:
    """Articles per activity and window of publication."""
    window = F.window("published_at", width, slide) if slide else F.window("published_at", width)
    return articles.withWatermark("published_at", late).groupBy(window.alias("span"), "activity_type").agg(F.count(F.lit(1)).alias("n"), F.max("score").alias("best"))


def _read(spark: SparkSession, base: str, batch: int, columns: tuple[str, ...]) -> DataFrame:
    """The newest snapshot before this batch."""
    found = []
    for row in _batches(spark, base):
        if row < batch:
            found.append(row)
    return spark.read.parquet(f"{base}/batch={max(found)}") if found else spark.createDataFrame([], text_schema(columns))


def _batches(spark: SparkSession, base: str) -> list[int]:
    path = spark._jvm.org.apache.hadoop.fs.Path(base)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    done = [s.getPath() for s in fs.listStatus(path)]
    return [int(p.getName().split("=")[1]) for p in done if p.getName().startswith("batch=") and fs.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]


def latest(spark: SparkSession, base: str, columns: tuple[str, ...]) -> DataFrame:
    return _read(spark, base, 1 << 62, columns)


def upsert_stores(events: DataFrame, base: str, log: DataFrame, now: Callable[[int], str], prepare: Callable[[DataFrame], DataFrame] = state.keyed) -> DataStreamWriter:
    """A stream writer that folds each batch of events into new snapshots of history and queue under base.

    ``prepare`` turns a batch of articles into keyed events. now: a batch's time as text.
    """

    def fold(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        found = prepare(batch)
        auto = F.col("validation_status") == "AUTO_SELECTED"
        history, queue = _read(spark, f"{base}/history", number, HISTORY), _read(spark, f"{base}/queue", number, QUEUE)
        state.upsert_history(history, found.filter(auto), now(number)).write.mode("overwrite").parquet(f"{base}/history/batch={number}")
        state.upsert_queue(queue, found.filter(~auto), log, now(number)).write.mode("overwrite").parquet(f"{base}/queue/batch={number}")

    return events.writeStream.foreachBatch(fold).option("checkpointLocation", f"{base}/checkpoint")
