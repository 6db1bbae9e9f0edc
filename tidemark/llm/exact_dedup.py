"""Exact deduplication by skew-safe combining, in DataFrame operations only.

Three stages agree on one winner per distinct text, and each of them groups by the full content
beside its digest:

1. local: the map side of a hash aggregate folds equal texts of one task into one row;
2. salted: the rows of a digest are spread over ``salts`` reducers and folded there;
3. global: at most ``salts`` winners per text are combined into one.

A group that holds a third of all rows therefore reaches a reducer as one row per map task and
salt, never as its members. Members get their decision by the digest and a salt, so that a large
group's members spread over ``salts`` join tasks (and further by Spark's skew join); stage 3 has compared all
texts of a digest by then and raises an error if two texts ever shared one, so no decision can
rest on a collision.

Defined cases: a null text counts as empty; empty texts form one group; the largest doc_id of a
group stays (nulls lose against any number; a group of only nulls keeps a null); rows that repeat
both doc_id and text are one document: they share its decision, and ``drop_duplicates`` leaves one
of them; an empty table gives an empty result; further columns, whatever their names, are ignored
by ``decisions`` and passed through by ``drop_duplicates``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._spark import lower_ascii, text_of, without

#: Rows of a dropped-id table up to which the last filter is a broadcast join (8 bytes of id and 64 of digest each).
BROADCAST_ROWS = 200_000


def _normal(text: str):
    return lower_ascii(text_of(text))


def classes(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", salts: int = 8) -> DataFrame:
    """One row per distinct normalised text: digest, keep_id, group_size."""
    rows = docs.select(F.col(id_col).alias("id"), _normal(text_col).alias("content")).select(
        "id", "content", F.sha2("content", 256).alias("digest"), F.pmod(F.xxhash64("id"), F.lit(salts)).alias("salt")
    )
    salted = rows.groupBy("digest", "salt", "content").agg(F.max("id").alias("id"), F.count(F.lit(1)).alias("n"))
    winners = salted.repartition("digest").groupBy("digest", "content").agg(F.max("id").alias("id"), F.sum("n").alias("n"))
    one = winners.groupBy("digest").agg(F.max("id").alias("keep_id"), F.sum("n").alias("group_size"), F.count(F.lit(1)).alias("texts"))
    checked = F.when(F.col("texts") > 1, F.raise_error(F.concat(F.lit("two texts share the digest "), F.col("digest"))).cast("long")).otherwise(F.col("group_size"))
    return one.select("digest", "keep_id", checked.alias("group_size"))


def decisions(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", salts: int = 8) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256."""
    groups = classes(docs, id_col=id_col, text_col=text_col, salts=salts).filter("group_size > 1")
    spread = groups.withColumn("salt", F.explode(F.array(*[F.lit(i).cast("long") for i in range(salts)])))
    members = docs.select(F.col(id_col).alias("doc_id"), F.sha2(_normal(text_col), 256).alias("digest"), F.pmod(F.xxhash64(id_col), F.lit(salts)).cast("long").alias("salt"))
    joined = members.join(spread, ["digest", "salt"], "left")
    keep = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return joined.select(
        "doc_id",
        keep.alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def drop_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", salts: int = 8, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """The input's rows and columns without the documents that lose against an equal text; of rows that repeat doc_id and text, one stays."""
    made = decisions(docs, id_col=id_col, text_col=text_col, salts=salts).filter("group_size > 1").select("doc_id", F.col("text_sha256").alias("digest"), F.col("kept").alias("stays"))
    return without(docs, made, id_col, F.sha2(_normal(text_col), 256), broadcast_rows)
