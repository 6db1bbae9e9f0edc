"""SimHash near-deduplication with BK-trees.

Each document gets a 64-bit fingerprint of its word shingles. Distinct fingerprints that differ
in at most ``radius`` bits are linked. Linking is sharded by pigeonhole: of ``radius + 2`` blocks
of bits, two such fingerprints agree on at least two, so each fingerprint goes into one shard per
pair of blocks and every link lies whole in some shard. In a shard, a BK-tree (children keyed by
their integer Hamming distance to the parent) is searched along the edges within the radius.

A shard of more than ``tree`` fingerprints is sharded again in the same way by the bits that it
leaves free. At radius 2 a shard fixes 32 bits and a shard inside a shard 16 more, so none of the
latter can hold over 65,536 distinct fingerprints, and no fingerprint is sent to more than 36
trees, however crowded its neighbourhood is. Shards are built where they are searched: sending
the trees to all executors would lead all fingerprints through the driver. A task reports a
spanning forest of its links, never all pairs; the forests are merged by connected components
(alternating large and small stars) in rounds that each end in a written table.

Defined cases: null text counts as empty; texts without a word have fingerprint 0 and are linked
like any other; a text of fewer words than a shingle is one shingle; equal texts share a
fingerprint and so a component; a null doc_id takes part in links, but names no component unless
all its members are null; rows that repeat doc_id and text are one document, of which
``drop_near_duplicates`` leaves one row; an empty table gives an empty result; further columns are
ignored by ``components`` and passed through by ``drop_near_duplicates``.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._spark import cut, text_of, without

SHINGLE = 3
RADIUS = 2
SEED = 42
TREE = 2_000
SALTS = 8
#: Ids of dropped documents up to which the last filter is a broadcast join (8 bytes each).
BROADCAST_ROWS = 1_000_000

_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)
_PLACES = np.arange(8) * 256


def fingerprint(text: str, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Bit i is set if it is set in over half of the XXH64 of the shingles; unsigned."""
    words = text.encode("utf-8").lower().split()  # on bytes: A-Z only, and white space of ASCII only
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(words) < shingle:
        hashes = [digest(b" ".join(words), seed)]
    else:
        hashes = [digest(b" ".join(s), seed) for s in zip(*[words[i:] for i in range(shingle)])]
    raw = np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8)
    counts = np.bincount((raw + _PLACES).ravel(), minlength=2048).reshape(8, 256) @ _BITS
    return int(np.packbits(counts * 2 > len(hashes), axis=None, bitorder="little").view("<u8")[0])


def digest_of(text_col: str) -> Column:
    """Tells texts of one doc_id apart."""
    return F.xxhash64(text_of(text_col))


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """doc_id, digest, fp: the fingerprint as a signed long."""
    rows = docs.select(F.col(id_col).alias("doc_id"), digest_of(text_col).alias("digest"), text_of(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t.as_py(), shingle) for t in batch.column(2)], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found)], names=["doc_id", "digest", "fp"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, digest long, fp long")


class Tree:
    """A BK-tree of integers."""

    def __init__(self) -> None:
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []

    def add(self, value: int) -> None:
        self.values.append(value)
        self.children.append({})
        if (new := len(self.values) - 1) == 0:
            return
        at = 0
        while (below := self.children[at].setdefault((self.values[at] ^ value).bit_count(), new)) != new:
            at = below

    def near(self, value: int, radius: int) -> Iterator[int]:
        """Values at most radius bits away."""
        return (self.values[at] for at in self.places(value, radius))

    def places(self, value: int, radius: int) -> Iterator[int]:
        """Which values, in the order they were added, are at most radius bits away; only edges whose distance can lead to one are followed."""
        open_ = [0] if self.values else []
        while open_:
            at = open_.pop()
            far = (self.values[at] ^ value).bit_count()
            if far <= radius:
                yield at
            below = self.children[at]
            if len(below) <= 2 * radius + 1:
                open_ += [n for d, n in below.items() if far - radius <= d <= far + radius]
            else:
                open_ += [below[d] for d in range(far - radius, far + radius + 1) if d in below]


def forest(values: list[int], radius: int) -> list[tuple[int, int]]:
    """A spanning forest of the links between values."""
    up: dict[int, int] = {}

    def top(x: int) -> int:
        while (above := up.setdefault(x, x)) != x:
            up[x] = x = up.setdefault(above, above)
        return x

    grown, links = Tree(), []
    for value in values:
        for other in grown.near(value, radius):
            if (a := top(value)) != (b := top(other)):
                up[a] = b
                links.append((value, other))
        grown.add(value)
    return links


def _held(positions: list[int]) -> Column:
    """The bits of fp at rising positions, put together."""
    runs: list[list[int]] = []
    for p in positions:
        if runs and runs[-1][-1] == p - 1:
            runs[-1].append(p)
        else:
            runs.append([p])
    parts, at = [], 0
    for run in runs:
        parts.append(F.shiftleft(F.shiftrightunsigned("fp", run[0]).bitwiseAND(F.lit((1 << len(run)) - 1)), at))
        at += len(run)
    return reduce(Column.bitwiseOR, parts)


def _blocks(positions: list[int], count: int) -> list[list[int]]:
    edges = [len(positions) * i // count for i in range(count + 1)]
    return [positions[a:b] for a, b in zip(edges, edges[1:])]


def _shards(positions: list[int], count: int) -> Column:
    """One shard per pair of blocks of these bits: which pair, and what the two hold."""
    pairs = combinations(_blocks(positions, count), 2)
    return F.array(*[F.struct(F.lit(n).alias("pair"), _held(a).alias("x"), _held(b).alias("y")) for n, (a, b) in enumerate(pairs)])


def links(distinct: DataFrame, *, radius: int = RADIUS, tree: int = TREE) -> DataFrame:
    """a, b: links between distinct fingerprints (column fp) that connect all within the radius."""
    count, bits = radius + 2, list(range(64))
    rows = distinct.select("fp", F.explode(_shards(bits, count)).alias("shard"))
    sizes = cut(rows.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"))
    whole = rows.join(sizes.filter(F.col("n") <= tree), "shard").select("fp", "shard", F.struct(F.lit(-1).alias("pair"), F.lit(0).cast("long").alias("x"), F.lit(0).cast("long").alias("y")).alias("part"))
    inner = F.lit(None)
    for n, pair in enumerate(combinations(_blocks(bits, count), 2)):
        free = [b for b in bits if b not in pair[0] and b not in pair[1]]
        inner = F.when(F.col("shard.pair") == n, _shards(free, count)).otherwise(inner)
    large = rows.join(sizes.filter(F.col("n") > tree), "shard").select("fp", "shard", F.explode(inner).alias("part"))
    dealt = whole.unionByName(large).select("fp", "shard.*", F.col("part.pair").alias("inner"), F.col("part.x").alias("i"), F.col("part.y").alias("j"))
    keys = ["pair", "x", "y", "inner", "i", "j"]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        mask = (1 << 64) - 1

        held: list[pd.DataFrame] = []

        def flush(frame: pd.DataFrame, last: bool) -> tuple[pd.DataFrame, pd.DataFrame]:
            """Solves the groups that are whole; the last one may go on in the next frame."""
            key = frame[keys].to_numpy()
            starts = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]).any(1)]) if len(frame) else np.array([], dtype=int)
            ends = np.r_[starts[1:], len(frame)].astype(int)
            whole = len(starts) if last else len(starts) - 1
            fp = frame["fp"].to_numpy()
            found = [link for a, b in zip(starts[:whole], ends[:whole]) if b - a > 1 for link in forest([v & mask for v in fp[a:b].tolist()], radius)]
            pairs = np.array(found, dtype=np.uint64).reshape(-1, 2).view(np.int64)
            rest = frame.iloc[starts[whole] :] if not last and len(starts) else frame.iloc[:0]
            return pd.DataFrame({"a": pairs[:, 0], "b": pairs[:, 1]}), rest

        for frame in frames:
            if not len(frame):
                continue
            held.append(frame)
            merged = pd.concat(held, ignore_index=True)
            out, rest = flush(merged, False)
            held = [rest]
            yield out
        if held:
            yield flush(held[0].reset_index(drop=True), True)[0]

    sorted_ = dealt.repartition(*keys).sortWithinPartitions(*keys, "fp")
    return sorted_.mapInPandas(run, "a long, b long").distinct()


def connected(edges: DataFrame) -> DataFrame:
    """node, root for every node of the edges a, b: the smallest node reachable, by alternating large and small stars."""

    def mark(table: DataFrame):
        return table.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()

    now = cut(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct())
    seen = mark(now)
    while seen["n"]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = cut(small.unionByName(lowest.select("u", F.col("m").alias("v"))).distinct())
        before, seen = seen, mark(now)
        if before == seen:
            break
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)


def components(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, radius: int = RADIUS, tree: int = TREE) -> DataFrame:
    """One row per input row: doc_id, fingerprint (hexadecimal), component_id (the smallest doc_id reachable).

    Beside them digest (of the text), keep_digest (of the text that stands for the component) and
    shared (whether the component holds several rows).
    """
    prints = cut(fingerprints(docs, id_col=id_col, text_col=text_col, shingle=shingle))
    distinct = _distinct(prints)
    return _labelled(prints, distinct, links(distinct.select("fp"), radius=radius, tree=tree))


def _distinct(prints: DataFrame) -> DataFrame:
    """fp, first (the smallest doc_id, nulls last, and of its texts the smallest digest), n."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("null"), "doc_id", "digest")).alias("first")
    # in two steps: the partial counts of one very common fingerprint, one per map task, spread over the salts first
    counted = prints.groupBy("fp", F.pmod(F.xxhash64("doc_id", "digest"), F.lit(SALTS)).alias("salt")).agg(first, F.count(F.lit(1)).alias("n"))
    return cut(counted.groupBy("fp").agg(F.min("first").alias("first"), F.sum("n").alias("n")))


def labelled(prints: DataFrame, edges: DataFrame, *more: str) -> DataFrame:
    """As ``components``, of given prints doc_id, digest, fp and links a, b between them; more: further columns of the prints to keep."""
    return _labelled(prints, _distinct(prints), edges, *more)


def _labelled(prints: DataFrame, distinct: DataFrame, edges: DataFrame, *more: str) -> DataFrame:
    members = cut(connected(edges))
    named = members.join(distinct, members["node"] == distinct["fp"])
    labels = named.groupBy("root").agg(F.min("first").alias("label"))
    labelled = members.join(labels, "root").select(F.col("node").alias("fp"), "label")
    shared = distinct.join(labelled, "fp", "left").filter("n > 1 OR label IS NOT NULL").select("fp", F.coalesce("label", "first").alias("label"))
    # salted, so that the documents of one very common fingerprint spread over several join tasks
    spread = shared.withColumn("salt", F.explode(F.array(*[F.lit(i).cast("long") for i in range(SALTS)])))
    dealt = prints.withColumn("salt", F.pmod(F.xxhash64("doc_id", "digest"), F.lit(SALTS)).cast("long"))
    alone = F.col("label").isNull()
    return dealt.join(spread, ["fp", "salt"], "left").select(
        "doc_id",
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.when(alone, F.col("doc_id")).otherwise(F.col("label.doc_id")).alias("component_id"),
        "digest",
        F.when(alone, F.col("digest")).otherwise(F.col("label.digest")).alias("keep_digest"),
        (~alone).alias("shared"),
        *more,
    )


def drop_near_duplicates(docs: DataFrame, *, broadcast_rows: int = BROADCAST_ROWS, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """The input's rows and columns; of each component only the document with the smallest doc_id stays."""
    return keep_first(docs, components(docs, id_col=id_col, text_col=text_col, **settings), id_col=id_col, text_col=text_col, broadcast_rows=broadcast_rows)


def keep_first(docs: DataFrame, made: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """The input's rows and columns that name their component (``components`` of the same docs), each document once.

    Nulls lose against any doc_id; of texts that share the smallest one, that of the smallest digest stays.
    """
    stays = F.col("digest").eqNullSafe(F.col("keep_digest")) & F.col("doc_id").eqNullSafe(F.col("component_id"))
    return without(docs, made.filter("shared").select("doc_id", "digest", stays.alias("stays")), id_col, digest_of(text_col), broadcast_rows)
