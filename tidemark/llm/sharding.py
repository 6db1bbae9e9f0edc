"""Sharding by a Hilbert curve over metadata, with shards of equal row counts.

Several metadata dimensions are quantised to a few bits each; the Hilbert index of a row's cell
orders the rows so that rows near on the curve are near in every dimension, and the order is cut
into runs. Files written from the shards then cover small ranges of all dimensions at once, so
readers can skip files by any of them.

The position of a row is exact and needs no global sort: cells are at most ``2 ** (bits * dims)``
counted numbers whose running sum is small, a cell's rows are spread over buckets by a hash of
their id, buckets are counted too, and only rows inside one bucket are sorted. A cell that holds
a third of all rows is thus numbered by as many tasks as there are buckets. Texts are measured
where they are read and never shuffled.

Law ``rows``: with N rows and S shards, shard = position * S div N, so counts are at most one apart.

Defined cases: null text has no bytes; null metadata is a value of its own; equal ids are ordered
by text checksum, then as they come; an empty table gives an empty result; further columns are
ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._spark import cut, fresh

SHARDS = 40
BITS = 4
BUCKETS = 256
#: Slots of a shard that one task writes.
ROWS_PER_TASK = 200_000


def hilbert_index(axes: np.ndarray, bits: int) -> np.ndarray:
    """Index on the Hilbert curve of points (a row each, a column per dimension) with coordinates of ``bits`` bits.

    Coordinates are turned into the curve's transposed form by undoing, from the top bit down, the
    exchanges and inversions of the sub-cubes, then Gray-coded and interleaved.
    """
    x = axes.astype(np.int64).T.copy()
    n = len(x)
    for q in (1 << b for b in range(bits - 1, 0, -1)):
        low = q - 1
        for i in range(n):
            set_ = (x[i] & q) > 0
            swap = np.where(set_, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(set_, x[0] ^ low, x[0] ^ swap)
            x[i] ^= swap
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    for q in (1 << b for b in range(bits - 1, 0, -1)):
        flip ^= np.where(x[n - 1] & q, q - 1, 0)
    x ^= flip
    out = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            out = out << 1 | x[i] >> b & 1
    return out


def quantise_name(name: str, bits: int = BITS) -> Column:
    """A category as one of 2 ** bits - 1 hashed values; null is the first value."""
    return F.when(F.col(name).isNull(), F.lit(0)).otherwise(F.pmod(F.xxhash64(name), F.lit((1 << bits) - 1)) + 1).cast("int")


def quantise_size(size: Column, bits: int = BITS, low: int = 4) -> Column:
    """A size by its power of two, from 2 ** low on."""
    return F.least(F.greatest(F.floor(F.log2(size)).cast("int") - low, F.lit(0)), F.lit((1 << bits) - 1))


def shards(docs: DataFrame, *, count: int = SHARDS, bits: int = BITS, buckets: int = BUCKETS, id_col: str = "doc_id", text_col: str = "text", names: tuple[str, ...] = ("lang", "source")) -> DataFrame:
    """Per document: doc_id, size, text_crc32, law, shard, slot, grown_shard (null under this law), cell.

    Of ``names`` those that docs has are dimensions, beside the size.
    """
    names = tuple(n for n in names if n in docs.columns)

    @F.pandas_udf("int")
    def curve(*axes: pd.Series) -> pd.Series:
        return pd.Series(hilbert_index(np.stack([a.to_numpy() for a in axes], 1), bits), dtype="int32")

    size = (F.coalesce(F.octet_length(text_col), F.lit(0)) + 16).cast("long")
    measured = docs.select(
        F.col(id_col).alias("doc_id"), size.alias("size"), F.crc32(F.coalesce(F.col(text_col), F.lit("")).cast("binary")).alias("text_crc32"), *[quantise_name(n, bits).alias(f"axis_{i}") for i, n in enumerate(names)]
    )
    axes = [*[f"axis_{i}" for i in range(len(names))], quantise_size(F.col("size"), bits)]
    # written once, as the counts and the ranks both read it
    placed = cut(measured.select("doc_id", "size", "text_crc32", curve(*axes).alias("cell"), F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(buckets)).alias("bucket")))

    counts = placed.groupBy("cell", "bucket").agg(F.count(F.lit(1)).alias("n"))
    cells = counts.groupBy("cell").agg(F.sum("n").alias("n"))
    # at most 2 ** (bits * dimensions) rows: one task may order them
    along = Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    based = cells.select("cell", F.coalesce(F.sum("n").over(along), F.lit(0)).alias("cell_base"), F.sum("n").over(Window.partitionBy()).alias("total"))
    inside = Window.partitionBy("cell").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    bucketed = counts.select("cell", "bucket", F.coalesce(F.sum("n").over(inside), F.lit(0)).alias("bucket_base"))
    bases = bucketed.join(F.broadcast(based), "cell").select("cell", "bucket", (F.col("cell_base") + F.col("bucket_base")).alias("base"), "total")

    ranked = placed.withColumn("r", F.row_number().over(Window.partitionBy("cell", "bucket").orderBy("doc_id", "text_crc32")))
    at = ranked.join(bases, ["cell", "bucket"]).withColumn("position", F.col("base") + F.col("r") - 1)
    exact = at.withColumn("shard", F.expr(f"position * {count} div total").cast("int"))
    return exact.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        (F.col("position") - F.expr(f"(shard * total + {count - 1}) div {count}")).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "cell",
    )


def write(docs: DataFrame, placed: DataFrame, path: str, *, id_col: str = "doc_id", rows_per_task: int = ROWS_PER_TASK) -> None:
    """Writes the documents as one folder per shard, in curve order inside, so that file statistics prune by every dimension.

    A shard's slots are dealt to tasks in runs of ``rows_per_task``, so a shard may be of any size; a
    file holds runs of the curve.
    """
    key, shard, slot = (fresh(docs, name) for name in ("placed_id", "shard", "slot"))
    where = placed.select(F.col("doc_id").alias(key), F.col("shard").alias(shard), F.col("slot").alias(slot))
    joined = docs.join(where, F.col(id_col).eqNullSafe(F.col(key))).drop(key)
    dealt = joined.repartition(F.col(shard), F.floor(F.col(slot) / rows_per_task))
    dealt.sortWithinPartitions(shard, slot).drop(slot).write.partitionBy(shard).parquet(path)
