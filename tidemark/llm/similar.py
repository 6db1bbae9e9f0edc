"""Near-deduplication of texts by exact Jaccard similarity of their word shingles.

A text is the set of the XXH64 of its shingles; two texts are linked if the sets' Jaccard
similarity reaches ``least``. No linked pair is missed: of a set of n shingles, put in one order
that holds for all texts, two similar sets share one of the first n - ceil(least n) + 1 (prefix
filter). The order puts shingles that a sample of the texts finds common last; it decides only how
much work there is, not what is found. Texts meet in the buckets of the shingles in their
prefixes; pairs whose sizes, places or counts by ranges of hashes rule the similarity out are left
out, and the rest is compared whole.

Groups of many near copies are not compared pair by pair: first each text is compared with one
other of each bucket, then only texts of one bucket that are not connected yet.

Defined cases: null text counts as empty; texts without a word are equal; a text of fewer words
than a shingle is one shingle; a null doc_id takes part in links and loses against any other; rows
that repeat doc_id and text are one document, of which one row stays; an empty table gives an
empty result; further columns are passed through.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import simhash
from ._spark import cut, text_of

SHINGLE = 5
#: Least similarity, as a fraction of whole numbers.
LEAST = (4, 5)
#: Texts whose shingles are counted for the order, and shingles that the order knows as common (8 bytes each).
SAMPLE, COMMON = 5_000, 100_000
#: Shared shingles, and texts to be compared, up to which they are found by a broadcast join (8 and 16 bytes each).
BROADCAST_ROWS = 1_000_000
#: Ranges of hashes whose counts bound what two sets can share, and the count from which a range says nothing.
BINS, FULL = 64, 65_535
#: In the finer ranges: hashes of a set that fall into one, and the count from which a range says nothing.
SHARE, FINE_FULL = 2, 255
#: Texts compared with one other text in one task, and pairs of a text that meet its counts under one join key.
LEAVES = 64


def shingles(text: str, shingle: int = SHINGLE) -> np.ndarray:
    """The sorted, distinct hashes of a text's shingles, as signed longs."""
    words = text.encode("utf-8").lower().split()  # as in simhash.fingerprint
    parts = [b" ".join(s) for s in zip(*[words[i:] for i in range(shingle)])] or [b" ".join(words)]
    return np.unique(np.fromiter(map(xxhash.xxh64_intdigest, parts), dtype=np.uint64, count=len(parts)).view(np.int64))


def profile(hashes: np.ndarray) -> bytes:
    """How many of a set's hashes fall into each of BINS ranges."""
    return np.minimum(np.bincount(hashes.view(np.uint64) >> np.uint64(58), minlength=BINS), FULL).astype(np.uint16).tobytes()


def fine(hashes: np.ndarray) -> bytes:
    """As profile, in so many ranges that a set of any size has SHARE hashes or fewer in each.

    Their number is a power of two, so that the ranges of a larger set unite to those of a smaller one.
    """
    bits = max(6, (len(hashes) // SHARE).bit_length())
    return np.minimum(np.bincount(hashes.view(np.uint64) >> np.uint64(64 - bits), minlength=1 << bits), FINE_FULL).astype(np.uint8).tobytes()


def may_be_similar(x: bytes, y: bytes, least: tuple[int, int] = LEAST) -> bool:
    """False only if the fine counts x and y rule it out that their sets are similar."""
    (p, q), left, right = least, np.frombuffer(x, dtype=np.uint8), np.frombuffer(y, dtype=np.uint8)
    if max(left.max(), right.max()) == FINE_FULL:
        return True
    ranges = min(len(left), len(right))
    left, right = (v.reshape(ranges, -1).sum(1, dtype=np.int64) for v in (left, right))
    return bool((p + q) * np.minimum(left, right).sum() >= p * (left.sum() + right.sum()))


def node(hashes: np.ndarray) -> int:
    """One signed long for a set of shingles."""
    return int(np.uint64(xxhash.xxh64_intdigest(hashes.tobytes())).view(np.int64))


def common(docs: DataFrame, *, text_col: str = "text", shingle: int = SHINGLE, sample: int = SAMPLE, limit: int = COMMON) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent shingles of a sample of the texts, sorted, and how many of its texts hold each."""
    rows = docs.select(text_of(text_col).alias("text"))
    every = max(1, rows.count() // sample)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text in batch.column(0):
                yield pa.RecordBatch.from_arrays([pa.array(shingles(text.as_py(), shingle))], names=["h"])

    taken = rows.filter(F.pmod(F.xxhash64("text"), F.lit(every)) == 0).mapInArrow(run, "h long")
    found = taken.groupBy("h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").orderBy(F.desc("n"), "h").limit(limit).toArrow()
    h, n = found.column("h").to_numpy(), found.column("n").to_numpy()
    order = np.argsort(h)
    return h[order], n[order]


def prefixes(docs: DataFrame, known: tuple[np.ndarray, np.ndarray], *, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, least: tuple[int, int] = LEAST) -> DataFrame:
    """doc_id, digest (of the text), fp (the text's node), size, prefix (the first shingles of the order), profile, fine."""
    rows = docs.select(F.col(id_col).alias("doc_id"), simhash.digest_of(text_col).alias("digest"), text_of(text_col).alias("text"))
    (p, q), (h, n) = least, known

    def prefix(found: np.ndarray) -> np.ndarray:
        seen = np.zeros(len(found), dtype=np.int64)
        if len(h):
            at = np.minimum(np.searchsorted(h, found), len(h) - 1)
            seen = np.where(h[at] == found, n[at], 0)
        return found[np.lexsort((found, seen))][: len(found) - -(-p * len(found) // q) + 1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(t.as_py(), shingle) for t in batch.column(2)]
            columns = [pa.array([node(s) for s in sets], pa.int64()), pa.array([len(s) for s in sets], pa.int64()), pa.array([prefix(s) for s in sets], pa.list_(pa.int64())), pa.array([profile(s) for s in sets], pa.binary()), pa.array([fine(s) for s in sets], pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], names=["doc_id", "digest", "fp", "size", "prefix", "profile", "fine"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, digest long, fp long, size long, prefix array<long>, profile binary, fine binary")


def buckets(made: DataFrame, *, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """token, fp, size, place for the shingles that stand in the prefixes of several different texts."""
    held = made.select("fp", F.explode("prefix").alias("token")).groupBy("token").agg(F.min("fp").alias("a"), F.max("fp").alias("b"))
    shared = cut(held.filter("a < b").select("token"))
    small = shared.count() <= broadcast_rows
    rows = made.select("fp", "size", F.posexplode("prefix").alias("place", "token"))
    return rows.join(F.broadcast(shared) if small else shared, "token").select("token", "fp", "size", "place").distinct()


def _possible(least: tuple[int, int]) -> Column:
    """False for pairs x, y of one bucket that are not similar, or whose first common shingle is another one."""
    p, q = least
    rest = F.least(F.col("x.size") - F.col("x.place"), F.col("y.size") - F.col("y.place"))
    sizes = q * F.least("x.size", "y.size") >= p * F.greatest("x.size", "y.size")
    return (F.col("x.fp") != F.col("y.fp")) & sizes & ((p + q) * rest >= p * (F.col("x.size") + F.col("y.size")))


def _where(possible: Callable[[Column, Column], Column], pairs: DataFrame, made: DataFrame, column: str) -> DataFrame:
    """The pairs a, b for which possible holds of this column of both.

    A node of very many pairs has a copy for every LEAVES of them, so its pairs spread over as many join keys.
    """
    counted = pairs.select(F.explode(F.array("a", "b")).alias("fp")).groupBy("fp").agg(F.count(F.lit(1)).alias("n"))
    nodes = cut(counted.select("fp", F.ceil(F.col("n") / LEAVES).cast("int").alias("parts")))
    nodes = F.broadcast(nodes) if nodes.count() <= BROADCAST_ROWS else nodes
    known = made.select("fp", column).join(nodes, "fp").dropDuplicates(["fp"])
    copies = known.select("fp", column, F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    dealt = pairs.join(nodes.select(F.col("fp").alias("a"), F.col("parts").alias("of_a")), "a").join(nodes.select(F.col("fp").alias("b"), F.col("parts").alias("of_b")), "b")
    dealt = dealt.select("a", "b", F.pmod(F.xxhash64("b"), F.col("of_a")).cast("int").alias("part_a"), F.pmod(F.xxhash64("a"), F.col("of_b")).cast("int").alias("part_b"))
    left = copies.select(F.col("fp").alias("a"), F.col("part").alias("part_a"), F.col(column).alias("x"))
    right = copies.select(F.col("fp").alias("b"), F.col("part").alias("part_b"), F.col(column).alias("y"))
    both = dealt.join(left, ["a", "part_a"]).join(right, ["b", "part_b"])
    return both.filter(possible(F.col("x"), F.col("y"))).select("a", "b")


def close(pairs: DataFrame, made: DataFrame, *, least: tuple[int, int] = LEAST) -> DataFrame:
    """The pairs a, b that their counts do not rule out: two sets share in each range at most the lesser count.

    The few ranges of the profiles leave out most pairs of short texts; those left are held to the finer
    ranges, which take a sixteenth of the room of the sets themselves.
    """
    p, q = least

    @F.pandas_udf("boolean")
    def coarse(x: pd.Series, y: pd.Series) -> pd.Series:
        left, right = (np.frombuffer(b"".join(v), dtype=np.uint16).reshape(-1, BINS).astype(np.int64) for v in (x, y))
        shared = np.minimum(left, right)
        return pd.Series(((p + q) * shared.sum(1) >= p * (left.sum(1) + right.sum(1))) | (shared == FULL).any(1))

    @F.pandas_udf("boolean")
    def finer(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([may_be_similar(a, b, least) for a, b in zip(x, y)], dtype=bool)

    return _where(finer, cut(_where(coarse, pairs, made, "profile")), made, "fine")


def compare(pairs: DataFrame, docs: DataFrame, made: DataFrame, *, least: tuple[int, int] = LEAST, **settings) -> DataFrame:
    """The pairs a, b of nodes whose whole sets are similar: those that their counts do not rule out, confirmed."""
    return confirm(cut(close(pairs, made, least=least)), docs, made, least=least, **settings)


def sets(wanted: DataFrame, docs: DataFrame, made: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """fp, held (the sorted hashes) of the nodes fp of a written table, read from one text of each."""
    first = made.join(wanted, "fp", "left_semi").groupBy("fp").agg(F.min(F.struct("doc_id", "digest")).alias("of"))
    named = cut(first.select(F.col("of.doc_id").alias("wanted_id"), F.col("of.digest").alias("wanted_digest")).distinct())
    named = F.broadcast(named) if named.count() <= BROADCAST_ROWS else named
    texts = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"), simhash.digest_of(text_col).alias("digest"))
    texts = texts.join(named, F.col("doc_id").eqNullSafe(F.col("wanted_id")) & (F.col("digest") == F.col("wanted_digest")), "left_semi").select("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingles(t.as_py(), shingle) for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array([node(s) for s in found], pa.int64()), pa.array([s.tobytes() for s in found], pa.binary())], names=["fp", "held"])

    return texts.mapInArrow(run, "fp long, held binary")


def confirm(pairs: DataFrame, docs: DataFrame, made: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, least: tuple[int, int] = LEAST) -> DataFrame:
    """The pairs a, b of a written table whose whole sets are similar; made: doc_id, digest, fp of every document.

    A set travels once to each set that it is compared with; a set with very many others is met in several tasks.
    """
    p, q = least
    parts = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / LEAVES).cast("int").alias("parts"))
    leaves = pairs.join(parts, "a").select(F.col("b").alias("fp"), F.col("a").alias("to"), F.pmod(F.xxhash64("b"), F.col("parts")).cast("int").alias("part"), F.lit(1).alias("leaf"))
    hubs = parts.select(F.col("a").alias("fp"), F.col("a").alias("to"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(0).alias("leaf"))
    wanted = cut(hubs.unionByName(leaves))
    sent = sets(wanted, docs, made, id_col=id_col, text_col=text_col, shingle=shingle).join(wanted, "fp").select("to", "part", "leaf", "fp", "held")
    dealt = sent.repartition("to", "part").sortWithinPartitions("to", "part", "leaf")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub, left = None, np.zeros(0, dtype=np.int64)
        for batch in batches:
            good = []
            for to, leaf, fp, held in zip(*(batch.column(n).to_pylist() for n in ("to", "leaf", "fp")), batch.column("held")):
                own = np.frombuffer(held.as_py(), dtype=np.int64)
                if not leaf:
                    hub, left = to, own
                elif hub == to and (p + q) * len(np.intersect1d(left, own, assume_unique=True)) >= p * (len(left) + len(own)):
                    good.append((to, fp))
            yield pa.RecordBatch.from_arrays([pa.array([g[i] for g in good], pa.int64()) for i in (0, 1)], names=["a", "b"])

    return dealt.mapInArrow(check, "a long, b long").distinct()


def links(docs: DataFrame, made: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, least: tuple[int, int] = LEAST) -> DataFrame:
    """a, b: links between nodes that connect all similar ones."""
    settings = {"id_col": id_col, "text_col": text_col, "shingle": shingle, "least": least}
    met = cut(buckets(made))
    pair = [F.least("x.fp", "y.fp").alias("a"), F.greatest("x.fp", "y.fp").alias("b")]
    chosen = met.groupBy("token").agg(F.min_by(F.struct("fp", "size", "place"), F.xxhash64("fp", "token")).alias("y"))
    first = met.alias("x").join(chosen, "token").filter(_possible(least)).select(*pair).distinct()
    found = cut(compare(cut(first), docs, made, **settings))
    roots = cut(simhash.connected(found))
    rooted = cut(met.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp")))
    # a bucket whose texts are all connected makes no pair
    open_ = cut(rooted.groupBy("token").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low < high").select("token"))
    left = cut(rooted.join(open_, "token", "left_semi"))
    rest = left.alias("x").join(left.alias("y"), (F.col("x.token") == F.col("y.token")) & (F.col("x.root") != F.col("y.root")) & (F.col("x.fp") < F.col("y.fp")) & _possible(least))
    again = cut(rest.select(*pair).distinct())
    return found.unionByName(compare(again, docs, made, **settings))


def components(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, least: tuple[int, int] = LEAST) -> DataFrame:
    """One row per input row: doc_id, fingerprint (its node, hexadecimal), component_id (the smallest doc_id reachable)."""
    known = common(docs, text_col=text_col, shingle=shingle)
    made = cut(prefixes(docs, known, id_col=id_col, text_col=text_col, shingle=shingle, least=least))
    return simhash.labelled(made.select("doc_id", "digest", "fp"), links(docs, made, id_col=id_col, text_col=text_col, shingle=shingle, least=least))


def drop_near_duplicates(docs: DataFrame, *, broadcast_rows: int = simhash.BROADCAST_ROWS, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """The input's rows and columns; of each component only the document with the smallest doc_id stays."""
    return simhash.keep_first(docs, components(docs, id_col=id_col, text_col=text_col, **settings), id_col=id_col, text_col=text_col, broadcast_rows=broadcast_rows)
