"""Near-deduplication by exact Jaccard similarity, with candidates from HyperMinHash sketches.

A document's set of word shingles is dealt into buckets by the first bits of their hashes. A
register keeps of its bucket's least hash the number of leading zeros (six bits) and some mantissa
bits that follow the first one, however large the set. Each document has two such sketches:

* ``COARSE`` registers of 16 bits, in bands of ``ROWS``, are the buckets in which documents meet. Of two
  sets at the least similarity of 0.85 no band agrees with a probability of 6e-11 (32 bands of 4); small
  sets, whose registers hold them nearly whole, depend on chance even less.
* ``FINE`` registers of 8 bits estimate the similarity of a pair: the agreeing ones, less those that
  agree by chance (two different least hashes, one compressed value), over those in use. The agreeing
  ones are a draw without replacement from the union, so their spread is known; a pair goes only if
  its estimate lies ``SIGMAS`` standard deviations below the limit.

What remains is compared by whole sets, so no link is reported that is not one.

Large groups are not compared pair by pair from the start. Equal sets are one node. In each bucket
every node first meets its part's least node, and these each other's least; components are formed;
then only nodes of one bucket that are not connected yet meet, pair by pair. In a bucket of more than
``CROWD`` nodes that happens inside the tasks, block against block: a pair is looked at in the first of
its common bands alone, estimated, and compared by whole sets there (sets of up to ``HELD`` shingles
travel with their nodes); what leaves the task is a forest of the links found. Pairs with a larger set
leave it when they are likely and are compared after that. A crowd of very many texts that are much
alike, but never at the limit, costs the square of its sketches' blocks.

Defined cases: null text counts as empty; a document without words has an empty set and is linked
with nothing; with fewer words than a shingle the whole sequence is one shingle; equal sets are linked;
a null doc_id takes part in links but names no component unless all its members are null; rows that
repeat doc_id and text share their component, one row is returned for each; an empty table gives an
empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import similar, simhash
from ._spark import cut, groups, text_of

SHINGLE = 5
#: Least similarity, as a fraction of whole numbers.
LEAST = (85, 100)
COARSE, ROWS, FINE = 128, 4, 512
#: Mantissa bits of a register for bands and for estimates.
LONG, SHORT = 10, 2
#: Standard deviations by which an estimate may lie below the limit.
SIGMAS = 7
#: Parts of a bucket that find their least node apart.
SALTS = 8
#: Nodes of a bucket up to which they meet in a join, and nodes of a larger one that make a block.
CROWD, BLOCK = 64, 512
#: Shingles of a set that travels with its node to the blocks of crowds (8 bytes each).
HELD = 256


def shingles(text: str, shingle: int = SHINGLE) -> np.ndarray:
    """The distinct hashes of a text's shingles, sorted; none without a word."""
    return similar.shingles(text, shingle) if text.strip("\t\n\v\f\r ") else np.zeros(0, dtype=np.int64)


def registers(hashes: np.ndarray, count: int, mantissa: int) -> np.ndarray:
    """Leading zeros plus one in the upper six bits, the mantissa below; zero where the bucket is empty."""
    out = np.zeros(count, dtype=np.uint16 if mantissa > SHORT else np.uint8)
    lead = count.bit_length() - 1
    h = np.sort(hashes.view(np.uint64))
    bucket, first = np.unique(h >> np.uint64(64 - lead), return_index=True)
    rest = (h[first] << np.uint64(lead)) >> np.uint64(11)  # 53 bits, exact as a double
    zeros = np.uint64(53) - np.frexp(rest.astype(np.float64))[1].astype(np.uint64)
    after = (rest << zeros) & np.uint64((1 << 52) - 1)
    out[bucket.astype(np.int64)] = ((zeros + np.uint64(1)) << np.uint64(mantissa) | after >> np.uint64(52 - mantissa)).astype(out.dtype)
    return out


def bands(coarse: np.ndarray) -> np.ndarray:
    """One long per band of each row of coarse registers, zero where all of a band is empty; different bands are told apart."""
    values = np.ascontiguousarray(coarse).view(np.uint64)
    places = (np.arange(values.shape[-1], dtype=np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    return np.where(values != 0, (values ^ places) * np.uint64(0xD6E8FEB86659FD93), np.uint64(0)).view(np.int64)


def chance(n: np.ndarray, m: np.ndarray, count: int = FINE, mantissa: int = SHORT) -> np.ndarray:
    """How likely two different least hashes of a register have one compressed value, for sets of n and m.

    A least hash of a bucket of k hashes lies above t with exp(-k t); a value is a cell between two such t.
    """
    cells = np.arange(1 << mantissa) / (1 << mantissa)
    edges = np.r_[(2.0 ** -np.arange(1, 40)[:, None] * (1 + cells)).ravel(), 1.0]
    edges.sort()
    x, y = (np.diff(np.exp(-(v / count)[:, None] * edges), axis=1) for v in (n, m))
    return (x * y).sum(1) / np.maximum((1 - np.exp(-n / count)) * (1 - np.exp(-m / count)), 1e-12)


def likely(x: np.ndarray, y: np.ndarray, n: np.ndarray, m: np.ndarray, least: tuple[int, int] = LEAST) -> np.ndarray:
    """Which pairs of sketches (rows of fine registers x and y, of sets of n and m) may be similar."""
    p, q = least
    used = ((x | y) != 0).sum(1)
    agree = ((x == y) & (x != 0)).sum(1)
    both = ((x != 0) & (y != 0)).sum(1)
    by_chance = chance(n, m)
    # of the registers that both use, those that do not agree for good agree by chance now and then
    good = (agree - both * by_chance) / (1 - by_chance)
    used = np.maximum(used, 1)
    union = np.maximum((n + m) * q / (p + q), used)  # of a pair at the limit
    drawn = p * (q - p) / (q * q) / used * (union - used) / np.maximum(union - 1, 1)
    lucky = (q - p) / q * by_chance / (1 - by_chance) / used
    return (good / used >= p / q - SIGMAS * np.sqrt(drawn + lucky) - 2 / used) & (q * np.minimum(n, m) >= p * np.maximum(n, m))


def _fields(held: list) -> tuple[np.ndarray, np.ndarray]:
    """Size and fine registers of packed sketches."""
    raw = np.frombuffer(b"".join(held), dtype=np.uint8).reshape(len(held), 8 + FINE)
    return raw[:, :8].copy().view(np.int64)[:, 0].astype(float), raw[:, 8:]


def sketches(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """doc_id, digest (of the text), fp (the set's node), size, sketch (size and fine registers), bands (zero where empty)."""
    rows = docs.select(F.col(id_col).alias("doc_id"), simhash.digest_of(text_col).alias("digest"), text_of(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp, size, held, met = [], [], [], []
            for t in batch.column(2):
                own = shingles(t.as_py(), shingle)
                fp.append(similar.node(own))
                size.append(len(own))
                held.append(np.int64(len(own)).tobytes() + registers(own, FINE, SHORT).tobytes())
                met.append(bands(registers(own, COARSE, LONG)))
            columns = [pa.array(fp, pa.int64()), pa.array(size, pa.int64()), pa.array(held, pa.binary()), pa.array(met, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], names=["doc_id", "digest", "fp", "size", "sketch", "bands"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, digest long, fp long, size long, sketch binary, bands array<long>")


def _part() -> Column:
    return F.pmod(F.xxhash64("fp"), F.lit(SALTS)).cast("int")


def _by_token(rows: DataFrame, tokens: DataFrame) -> DataFrame:
    """A join by token in which the nodes of one token spread over SALTS tasks; tokens: one row each."""
    return rows.withColumn("salt", _part()).join(tokens.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))), ["token", "salt"])


def met_in(rows: DataFrame) -> DataFrame:
    """token, fp, size of the rows (token, fp, size; each once) whose token several nodes have.

    As a node has a token once, counts tell that, and they take less room on their way than nodes.
    """
    shared = rows.groupBy("token").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("token")
    return _by_token(rows, shared).select("token", "fp", "size")


def _sized(x: Column, y: Column, least: tuple[int, int]) -> Column:
    """Whether sets of x and y shingles can be similar."""
    p, q = least
    return q * F.least(x, y) >= p * F.greatest(x, y)


def stars(met: DataFrame, *, least: tuple[int, int] = LEAST) -> DataFrame:
    """a, b: every node of a token with its part's least node, and the parts' least nodes with the token's; a < b, of sizes that may be similar."""
    dealt = met.withColumn("salt", _part())
    parts = dealt.groupBy("token", "salt").agg(F.min(F.struct("fp", "size")).alias("top"))
    tops = parts.groupBy("token").agg(F.min("top").alias("one"))
    inner = dealt.join(parts, ["token", "salt"]).select("top", F.struct("fp", "size").alias("own"))
    outer = parts.join(tops, "token").select(F.col("one").alias("top"), F.col("top").alias("own"))
    both = inner.unionByName(outer).filter((F.col("top.fp") < F.col("own.fp")) & _sized(F.col("top.size"), F.col("own.size"), least))
    return both.select(F.col("top.fp").alias("a"), F.col("own.fp").alias("b")).distinct()


def estimated(pairs: DataFrame, nodes: DataFrame, *, least: tuple[int, int] = LEAST) -> DataFrame:
    """The likely ones of the pairs a, b. nodes: fp, sketch."""

    @F.pandas_udf("boolean")
    def possible(x: pd.Series, y: pd.Series) -> pd.Series:
        if not len(x):
            return pd.Series([], dtype=bool)
        (n, left), (m, right) = _fields(list(x)), _fields(list(y))
        return pd.Series(likely(left, right, n, m, least))

    return similar._where(possible, pairs, nodes, "sketch")


class _Forest:
    """Which of a few nodes are connected."""

    def __init__(self, roots: list) -> None:
        first: dict = {}
        self.up = [first.setdefault(r, i) for i, r in enumerate(roots)]

    def top(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = i = self.up[self.up[i]]
        return i

    def join(self, i: int, j: int) -> None:
        self.up[self.top(i)] = self.top(j)


def block_pairs(rows: DataFrame, *, least: tuple[int, int] = LEAST, block: int = BLOCK) -> DataFrame:
    """a, b, sure: a forest of the links, and likely pairs that are still to be compared, of unconnected nodes of each token, found block against block.

    rows: token, n (its nodes), fp, root, sketch, bands, held (the whole set, null for large ones).
    """
    p, q = least
    count = F.ceil(F.col("n") / block).cast("int")
    own = F.pmod(F.xxhash64("fp", "token"), count).cast("int").alias("own")
    carried = ["fp", "root", "sketch", "bands", "held"]
    dealt = rows.select("token", *carried, own, count.alias("count"))
    dealt = dealt.select("token", *carried, "own", F.explode(F.sequence(F.lit(0), F.col("count") - 1)).alias("other"))
    dealt = dealt.select("token", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), (F.col("own") > F.col("other")).alias("second"), *carried)
    keys = ["token", "i", "j"]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for (token, i, j), frame in groups(frames, keys):
            n, fine = _fields(frame["sketch"].tolist())
            met = np.stack(frame["bands"].tolist())
            fp, second = frame["fp"].tolist(), frame["second"].to_numpy()
            sets = [np.frombuffer(h, dtype=np.int64) if isinstance(h, bytes) else None for h in frame["held"]]
            forest, found = _Forest(frame["root"].tolist()), []
            for x in range(len(frame)) if i == j else np.flatnonzero(~second):
                ys = np.arange(x + 1, len(frame)) if i == j else np.flatnonzero(second)
                shared = (met[ys] == met[x]) & (met[x] != 0)
                # a pair is looked at in the first band that its nodes share, and nowhere else
                ys = ys[met[x][shared.argmax(1)] == token]
                ys = ys[likely(fine[[x]].repeat(len(ys), 0), fine[ys], np.full(len(ys), n[x]), n[ys], least)] if len(ys) else ys
                for y in ys.tolist():
                    if forest.top(x) == forest.top(y):
                        continue
                    sure = sets[x] is not None and sets[y] is not None
                    if sure:
                        if (p + q) * len(np.intersect1d(sets[x], sets[y], assume_unique=True)) < p * (len(sets[x]) + len(sets[y])):
                            continue
                        forest.join(x, y)
                    found.append((min(fp[x], fp[y]), max(fp[x], fp[y]), sure))
            yield pd.DataFrame(found, columns=["a", "b", "sure"]).astype({"a": "int64", "b": "int64", "sure": bool})

    return dealt.repartition(*keys).sortWithinPartitions(*keys).mapInPandas(run, "a long, b long, sure boolean").distinct()


def rest(met: DataFrame, roots: DataFrame, docs: DataFrame, made: DataFrame, *, least: tuple[int, int], crowd: int, block: int, held: int, **settings) -> tuple[DataFrame, DataFrame]:
    """Likely pairs a, b of nodes of one token that are not connected yet, and links a, b found on the way. roots: node, root."""
    rooted = cut(met.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp")))
    open_ = cut(rooted.groupBy("token").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count(F.lit(1)).alias("n")).filter("low < high").select("token", "n"))
    small = cut(_by_token(rooted, open_.filter(F.col("n") <= crowd)).select("token", "fp", "size", "root"))
    x, y = small.alias("x"), small.alias("y")
    pairs = x.join(y, (F.col("x.token") == F.col("y.token")) & (F.col("x.root") != F.col("y.root")) & (F.col("x.fp") < F.col("y.fp")) & _sized(F.col("x.size"), F.col("y.size"), least))
    few = estimated(cut(pairs.select(F.col("x.fp").alias("a"), F.col("y.fp").alias("b")).distinct()), made, least=least)
    many = cut(_by_token(rooted, open_.filter(F.col("n") > crowd)).select("token", "n", "fp", "size", "root"))
    if many.isEmpty():
        return few, few.filter("false")
    nodes = cut(many.select("fp").distinct())
    carried = made.join(nodes, "fp", "left_semi").select("fp", "sketch", "bands").dropDuplicates(["fp"])
    whole = similar.sets(cut(many.filter(F.col("size") <= held).select("fp").distinct()), docs, made, **settings)
    known = cut(carried.join(whole.dropDuplicates(["fp"]), "fp", "left"))
    found = cut(block_pairs(many.drop("size").join(known, "fp"), least=least, block=block))
    return few.unionByName(found.filter("NOT sure").select("a", "b")).distinct(), found.filter("sure").select("a", "b")


def links(docs: DataFrame, made: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, least: tuple[int, int] = LEAST, crowd: int = CROWD, block: int = BLOCK, held: int = HELD) -> DataFrame:
    """a, b: links between nodes that connect all similar ones."""
    settings = {"id_col": id_col, "text_col": text_col, "shingle": shingle}
    # written before the bands are dealt out: a row per band would take the room of its node each time
    nodes = cut(made.groupBy("fp").agg(F.first("size").alias("size"), F.first("bands").alias("bands")))
    met = cut(met_in(nodes.select(F.explode(F.filter("bands", lambda b: b != 0)).alias("token"), "fp", "size")))
    found = cut(similar.confirm(cut(estimated(cut(stars(met, least=least)), made, least=least)), docs, made, least=least, **settings))
    roots = cut(simhash.connected(found))
    again, sure = rest(met, roots, docs, made, least=least, crowd=crowd, block=block, held=held, **settings)
    return found.unionByName(sure).unionByName(similar.confirm(cut(again), docs, made, least=least, **settings))


def components(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, **settings) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id (the smallest doc_id reachable), kept (whether it is its component's)."""
    made = cut(sketches(docs, id_col=id_col, text_col=text_col, shingle=shingle))
    held = made.filter("size > 0")
    joined = simhash.labelled(held.select("doc_id", "digest", "fp", "size"), links(docs, held, id_col=id_col, text_col=text_col, shingle=shingle, **settings), "size")
    alone = made.filter("size = 0").select("doc_id", "size", F.col("doc_id").alias("component_id"))
    both = joined.select("doc_id", "size", "component_id").unionByName(alone)
    return both.select("doc_id", F.col("size").alias("n_shingles"), "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def drop_near_duplicates(docs: DataFrame, *, least: tuple[int, int] = LEAST, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, broadcast_rows: int = simhash.BROADCAST_ROWS, **settings) -> DataFrame:
    """The input's rows and columns; of each group of linked texts only the document with the smallest doc_id stays. Here texts without a word are equal.

    Nulls lose against any doc_id; of texts that share the smallest one that of the smallest digest
    stays, and of rows that repeat doc_id and text one.
    """
    made = cut(sketches(docs, id_col=id_col, text_col=text_col, shingle=shingle))
    edges = links(docs, made.filter("size > 0"), id_col=id_col, text_col=text_col, shingle=shingle, least=least, **settings)
    return simhash.keep_first(docs, simhash.labelled(made.select("doc_id", "digest", "fp"), edges), id_col=id_col, text_col=text_col, broadcast_rows=broadcast_rows)
