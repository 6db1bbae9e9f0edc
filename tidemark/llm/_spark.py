"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.frames import groups
from ..lineage import cut, exists, remove, scratch, shared_dir

__all__ = ["cut", "exists", "fresh", "groups", "lower_ascii", "remove", "scratch", "shared_dir", "table", "text_of", "without"]

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the input tables; only Spark's reader touches the path."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(col: str | Column) -> Column:
    """The text, null taken as empty."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def lower_ascii(col: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(col, UPPER, LOWER)


def fresh(df: DataFrame, name: str) -> str:
    """A name that no column of df has, for joins that keep df's own columns."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


def without(docs: DataFrame, made: DataFrame, id_col: str, digest: Column, broadcast_rows: int) -> DataFrame:
    """The input's rows and columns that stay, each once.

    made: doc_id, digest and stays, a row per input row; rows of equal doc_id (null included) and
    digest are one document, of which one row stays. The ids of what goes are written once; they are
    broadcast only while their counted number is small, and joined by shuffle beyond that.
    """
    lost_id, lost_digest = fresh(docs, "lost_id"), fresh(docs, "lost_digest")
    named = [F.col("doc_id").alias(lost_id), F.col("digest").alias(lost_digest)]
    match = F.col(id_col).eqNullSafe(F.col(lost_id)) & (digest == F.col(lost_digest))
    kept = cut(made.select("doc_id", "digest", "stays").groupBy("doc_id", "digest", "stays").agg(F.count(F.lit(1)).alias("rows")).filter("NOT stays OR rows > 1"))

    def chosen(condition: str) -> DataFrame:
        rows = kept.filter(condition)
        return F.broadcast(rows.select(*named)) if rows.count() <= broadcast_rows else rows.select(*named)

    left = docs.join(chosen("NOT stays"), match, "left_anti")
    if kept.filter("stays").isEmpty():
        return left
    again = chosen("stays")
    key, own = fresh(docs, "_key"), fresh(docs, "_own")
    several = left.join(again, match, "left_semi").select(digest.alias(key), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(own))
    # the map side folds a hot document to one row per task
    one = several.groupBy(F.col(f"{own}.`{id_col}`"), key).agg(F.first(own).alias(own)).select(f"{own}.*")
    return left.join(again, match, "left_anti").unionByName(one)
