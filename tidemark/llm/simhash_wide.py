"""Near-deduplication by exact Jaccard similarity, with candidates from SimHash fingerprints and BK-trees.

The fingerprint of ``simhash`` at a radius of two bits knows nearly identical texts only: at a
Jaccard similarity of 0.8 two texts differ in 15 % of their bits. Here every text has ``VOTES``
bits, each decided by a vote of the hashes of its shingles, and links are looked for as there:
distinct texts go into shards, in each shard a BK-tree of fingerprints (``BITS`` of the bits) is
searched along the edges within the radius, and forests are merged by alternating stars.

* Shards. Equal bits cannot name them, as too many bits differ; but a clear vote seldom differs. The
  votes are turned ``TABLES * KEYS`` times (signs flipped, then a Hadamard transform) and the clearest
  place of a turn with its side is a key; ``KEYS`` of them name a shard of a table. Of two texts at
  0.8 one table agrees with a probability of 0.14 (see the tests), so no table does with 5e-7.
* Radius. Of two texts at 0.8 the fingerprints differ in 19 bits on average (spread 4; sets of five
  shingles 24, spread 4.4), those of unlike texts in 64 (spread 5.7); ``RADIUS`` lies between.

No task reports the pairs that it meets, as a group of texts that are much alike has the square of
its size of them:

* First, in the first ``EARLY`` tables, each tree gives a forest of what it finds. These pairs are
  compared by whole sets, save those that counts by ranges of hashes rule out (exactly).
* Then, in all tables, trees are searched for pairs that are not connected by now. What leaves the
  task is the texts that have such a pair. They meet again in the same shards with their counts, and
  those that the counts do not rule out with whole sets of any size. A pair is looked at in the first
  of its common shards alone; the result is a forest of the links found.

So no link is reported that is not one, and what leaves a task grows with the texts and tables.
In a shard of more than ``CROWD`` texts every text first meets its part's least one, and these each
other's least; after that its texts meet block against block, in blocks of so many shingles that a
task can hold two, a tree of one searched for the texts of the other. A crowd of very many texts that
are much alike, but never at the limit, costs the square of its blocks, as each text is sent to all of them.

Defined cases: null text counts as empty; texts without a word are equal; a text of fewer words than a
shingle is one shingle; a null doc_id takes part in links and loses against any other; rows that repeat
doc_id and text are one document, of which one row stays; an empty table gives an empty result;
further columns are passed through.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import hyperminhash, similar, simhash
from ._spark import cut, groups, text_of

SHINGLE = 5
#: Least similarity, as a fraction of whole numbers.
LEAST = (4, 5)
#: Bits that are voted on, and those of them that are the fingerprint.
VOTES, BITS = 256, 128
RADIUS = 46
#: Tables of shards, and turns whose clearest places name a shard.
TABLES, KEYS = 96, 2
#: Tables whose forests are compared first.
EARLY = 16
#: Texts of a shard up to which it is one tree, and texts of a larger one that make a block.
CROWD, BLOCK = 64, 512
#: Shingles up to which a set weighs as one text in its block, a larger one as several (8 bytes each).
HELD = 1_024
#: Shingles that vote, and texts whose votes are turned, at once.
PART, TURNED = 4_096, 32

_MIXED = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], dtype=np.uint64)
_SIGNS = np.random.Generator(np.random.PCG64(simhash.SEED)).choice(np.array([-1, 1], dtype=np.float32), (TABLES * KEYS, VOTES))


def _hadamard(size: int) -> np.ndarray:
    out = np.ones((1, 1), dtype=np.float32)
    while len(out) < size:
        out = np.block([[out, out], [out, -out]])
    return out


_TURN = _hadamard(VOTES)


def votes(hashes: np.ndarray) -> np.ndarray:
    """Per bit, how many more of the hashes have it set than not."""
    total = np.zeros(VOTES, dtype=np.int64)
    for at in range(0, len(hashes), PART):
        x = hashes[at : at + PART].view(np.uint64)[:, None] * _MIXED
        x ^= x >> np.uint64(29)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(32)
        total += np.unpackbits(x.view(np.uint8).reshape(len(x), -1), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return 2 * total - len(hashes)


def prints(voted: np.ndarray) -> np.ndarray:
    """The fingerprint of each row of votes, as longs: a bit is 1 if set in over half of the hashes."""
    return np.packbits(voted[:, :BITS] > 0, axis=1, bitorder="little").view("<i8")


def shards(voted: np.ndarray) -> np.ndarray:
    """The shard of each row of votes in each table; shards of different tables are different numbers."""
    out = np.zeros((len(voted), TABLES), dtype=np.int32)
    for at in range(0, len(voted), TURNED):
        rows = voted[at : at + TURNED].astype(np.float32)
        turned = ((rows[:, None, :] * _SIGNS).reshape(-1, VOTES) @ _TURN).reshape(len(rows), TABLES, KEYS, VOTES)
        place = np.abs(turned).argmax(3)
        side = np.take_along_axis(turned, place[..., None], 3)[..., 0] > 0
        key = place * 2 + side
        number = np.arange(TABLES)[None, :]
        for k in range(KEYS):
            number = number * (2 * VOTES) + key[:, :, k]
        out[at : at + TURNED] = number
    return out


def sketches(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """doc_id, digest (of the text), fp (the set's node), size, low and high (the fingerprint), shards (one per table), profile, fine (as ``similar``)."""
    rows = docs.select(F.col(id_col).alias("doc_id"), simhash.digest_of(text_col).alias("digest"), text_of(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp, size, profile, fine, voted = [], [], [], [], np.zeros((batch.num_rows, VOTES), dtype=np.int64)
            for i, t in enumerate(batch.column(2)):
                own = similar.shingles(t.as_py(), shingle)
                fp.append(similar.node(own))
                size.append(len(own))
                profile.append(similar.profile(own))
                fine.append(similar.fine(own))
                voted[i] = votes(own)
            held, where = prints(voted), shards(voted)
            lists = pa.ListArray.from_arrays(np.arange(len(where) + 1, dtype=np.int32) * TABLES, where.ravel())
            columns = [pa.array(fp, pa.int64()), pa.array(size, pa.int64()), pa.array(held[:, 0]), pa.array(held[:, 1]), lists, pa.array(profile, pa.binary()), pa.array(fine, pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], names=["doc_id", "digest", "fp", "size", "low", "high", "shards", "profile", "fine"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, digest long, fp long, size long, low long, high long, shards array<int>, profile binary, fine binary")


def _whole(low: np.ndarray, high: np.ndarray) -> list[int]:
    """Fingerprints as integers of BITS bits."""
    return [a | b << 64 for a, b in zip(low.view(np.uint64).tolist(), high.view(np.uint64).tolist())]


def _searched(rows: DataFrame, search: Callable[[int, dict[str, np.ndarray]], list[tuple]], schema: str) -> DataFrame:
    """What search gives for each shard of several texts; rows: token (the shard) and more, a shard is one task's."""
    names = [field.split()[0] for field in schema.split(", ")]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def solve(frame: pd.DataFrame, last: bool) -> tuple[list[tuple], pd.DataFrame]:
            """Searches the shards that are whole; the last one may go on in the next frame."""
            token = frame["token"].to_numpy()
            starts = np.flatnonzero(np.r_[True, token[1:] != token[:-1]])
            ends = np.r_[starts[1:], len(frame)]
            done = len(starts) if last else len(starts) - 1
            several = np.flatnonzero(ends[:done] - starts[:done] > 1)
            columns = {c: frame[c].to_numpy() for c in frame.columns}
            found = []
            for a, b in zip(starts[several].tolist(), ends[several].tolist()):
                found += search(int(token[a]), {c: v[a:b] for c, v in columns.items()})
            return found, frame.iloc[starts[done] :] if not last else frame.iloc[:0]

        def out(found: list[tuple]) -> pd.DataFrame:
            return pd.DataFrame(np.array(found, dtype=np.int64).reshape(-1, len(names)), columns=names)

        left = None
        for frame in frames:
            if not len(frame):
                continue
            found, left = solve(frame if left is None else pd.concat([left, frame], ignore_index=True), False)
            yield out(found)
        if left is not None and len(left):
            yield out(solve(left, True)[0])

    return rows.repartition("token").sortWithinPartitions("token", "fp").mapInPandas(run, schema)


def tree_links(rows: DataFrame, *, radius: int = RADIUS) -> DataFrame:
    """a, b: a forest of the pairs of each shard within the radius; a < b. rows: token, fp, low, high."""

    def search(_: int, shard: dict[str, np.ndarray]) -> list[tuple]:
        fp, tree, forest, found = shard["fp"].tolist(), simhash.Tree(), hyperminhash._Forest(list(range(len(shard["fp"])))), []
        for x, value in enumerate(_whole(shard["low"], shard["high"])):
            for y in tree.places(value, radius):
                if forest.top(x) != forest.top(y):
                    forest.join(x, y)
                    found.append((min(fp[x], fp[y]), max(fp[x], fp[y])))
            tree.add(value)
        return found

    return _searched(rows, search, "a long, b long").distinct()


def open_texts(rows: DataFrame, *, radius: int = RADIUS) -> DataFrame:
    """fp, token, n: the texts of each shard that have another one within the radius which they are not connected with; n: what all these weigh.

    rows: token, fp, low, high, root, weight.
    """

    def search(token: int, shard: dict[str, np.ndarray]) -> list[tuple]:
        root = shard["root"]
        if (root == root[0]).all():
            return []
        tree, open_ = simhash.Tree(), set()
        for x, value in enumerate(_whole(shard["low"], shard["high"])):
            for y in tree.places(value, radius):
                if root[x] != root[y]:
                    open_ |= {x, y}
            tree.add(value)
        n = sum(int(shard["weight"][x]) for x in open_)
        return [(int(shard["fp"][x]), token, n) for x in sorted(open_)]

    return _searched(rows, search, "fp long, token long, n long")


def _in_blocks(rows: DataFrame, carried: str, solve: Callable[[pd.DataFrame, Iterator[tuple[int, np.ndarray]]], pd.DataFrame], schema: str, *, radius: int, block: int) -> DataFrame:
    """What solve makes of the rows that meet in one task and of their pairs within the radius, each pair in the first shard that its texts share.

    rows: fp, root, low, high, shards, carried, met (token and n of each shard where the text is to meet
    others, n what these weigh). Shards that weigh more than block are met block against block.
    """
    kept = ["fp", "root", "low", "high", "shards", carried]
    dealt = rows.select(*kept, F.explode("met").alias("met")).select(*kept, "met.token", "met.n", F.ceil(F.col("met.n") / block).cast("int").alias("count"))
    own = F.pmod(F.xxhash64("fp", "token"), F.col("count")).cast("int").alias("own")
    dealt = dealt.select("token", "n", *kept, own, F.explode(F.sequence(F.lit(0), F.col("count") - 1)).alias("other"))
    dealt = dealt.select("token", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), (F.col("own") > F.col("other")).alias("second"), "n", *kept)
    keys = ["token", "i", "j"]

    def pairs(frame: pd.DataFrame, token: int, alone: bool) -> Iterator[tuple[int, np.ndarray]]:
        """A row and the rows that it is to be compared with."""
        met, second = np.stack(frame["shards"].tolist()), frame["second"].tolist()
        values, tree, members = _whole(frame["low"].to_numpy(), frame["high"].to_numpy()), simhash.Tree(), []
        # the first block is the tree's; of one block alone every text is searched for among those before it
        for x in sorted(range(len(values)), key=second.__getitem__):
            if alone or second[x]:
                near = np.array([members[at] for at in tree.places(values[x], radius)], dtype=np.int64)
                if len(near):
                    yield x, near[met[x][(met[near] == met[x]).argmax(1)] == token]
            if alone or not second[x]:
                tree.add(values[x])
                members.append(x)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for (token, i, j), frame in groups(frames, keys):
            if len(frame) > 1 and len(found := solve(frame, pairs(frame, token, i == j))):
                yield found

    return dealt.repartition(*keys).sortWithinPartitions(*keys).mapInPandas(run, schema).distinct()


def possible_texts(rows: DataFrame, *, least: tuple[int, int] = LEAST, radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """fp, token, n: the texts that have an unconnected one which their fine counts do not rule out. rows: as ``_in_blocks`` with fine."""

    p, q = least

    def solve(frame: pd.DataFrame, pairs: Iterator[tuple[int, np.ndarray]]) -> pd.DataFrame:
        root, fine, found = frame["root"].to_numpy(), frame["fine"].tolist(), np.zeros(len(frame), dtype=bool)
        raw = [np.frombuffer(f, dtype=np.uint8) for f in fine]
        full = np.array([v.max() == similar.FINE_FULL for v in raw])
        coarse = np.stack([v.reshape(similar.BINS, -1).sum(1, dtype=np.int64) for v in raw])
        size = coarse.sum(1)
        for x, ys in pairs:
            ys = ys[(root[ys] != root[x]) & ~(found[ys] & found[x])]
            shared = np.minimum(coarse[ys], coarse[x]).sum(1)
            for y in ys[((p + q) * shared >= p * (size[ys] + size[x])) | full[ys] | full[x]].tolist():
                if not (found[x] and found[y]) and similar.may_be_similar(fine[x], fine[y], least):
                    found[[x, y]] = True
        return frame.loc[found, ["fp", "token", "n"]].astype("int64")

    return _in_blocks(rows, "fine", solve, "fp long, token long, n long", radius=radius, block=block)


def whole_links(rows: DataFrame, *, least: tuple[int, int] = LEAST, radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """a, b: a forest of the links of each block, by whole sets; a < b. rows: as ``_in_blocks`` with held (the set)."""
    p, q = least

    def solve(frame: pd.DataFrame, pairs: Iterator[tuple[int, np.ndarray]]) -> pd.DataFrame:
        fp, sets, forest, found = frame["fp"].tolist(), [np.frombuffer(h, dtype=np.int64) for h in frame["held"]], hyperminhash._Forest(frame["root"].tolist()), []
        for x, y in ((x, y) for x, ys in pairs for y in ys.tolist()):
            n, m = len(sets[x]), len(sets[y])
            if forest.top(x) == forest.top(y) or q * min(n, m) < p * max(n, m):
                continue
            if (p + q) * len(np.intersect1d(sets[x], sets[y], assume_unique=True)) >= p * (n + m):
                forest.join(x, y)
                found.append((min(fp[x], fp[y]), max(fp[x], fp[y])))
        return pd.DataFrame(np.array(found, dtype=np.int64).reshape(-1, 2), columns=["a", "b"])

    return _in_blocks(rows, "held", solve, "a long, b long", radius=radius, block=block)


def links(docs: DataFrame, made: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, least: tuple[int, int] = LEAST, radius: int = RADIUS, crowd: int = CROWD, block: int = BLOCK, held: int = HELD, early: int = EARLY) -> DataFrame:
    """a, b: links between nodes that connect all similar ones. made: as ``sketches``, a written table."""
    settings = {"id_col": id_col, "text_col": text_col, "shingle": shingle}
    weight = F.greatest(F.lit(1), F.ceil(F.col("size") / max(held, 1))).cast("int").alias("weight")
    nodes = cut(made.dropDuplicates(["fp"]).select("fp", "size", "low", "high", "shards", weight))
    crowded = cut(nodes.select(F.explode("shards").alias("token"), "weight").groupBy("token").agg(F.count(F.lit(1)).alias("texts"), F.sum("weight").alias("n")).filter(F.col("texts") > crowd).select("token", "n"))
    # salted, so that the texts of one crowded shard spread over several join tasks
    salts = crowded.select("token", F.explode(F.sequence(F.lit(0), F.lit(hyperminhash.SALTS - 1))).alias("salt"))
    several = not crowded.isEmpty()

    def few(rows: DataFrame) -> DataFrame:
        return rows.withColumn("salt", hyperminhash._part()).join(salts, ["token", "salt"], "left_anti").drop("salt") if several else rows

    first, many = tree_links(few(nodes.select(F.explode(F.slice("shards", 1, early)).alias("token"), "fp", "low", "high")), radius=radius), None
    if several:
        many = cut(hyperminhash._by_token(nodes.select(F.explode("shards").alias("token"), "fp", "size"), crowded).select("token", "n", "fp", "size"))
        first = first.unionByName(hyperminhash.stars(many.filter(F.col("token") < early * (2 * VOTES) ** KEYS).drop("n"), least=least)).distinct()
    found = cut(similar.compare(cut(first), docs, made, least=least, **settings))
    roots = cut(simhash.connected(found)).withColumnRenamed("node", "fp")
    rooted = cut(nodes.drop("size").join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp")))
    met = open_texts(few(rooted.select(F.explode("shards").alias("token"), "fp", "low", "high", "root", "weight")), radius=radius)
    if several:
        crowds = cut(many.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp")))
        apart = cut(crowds.groupBy("token").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low < high").select("token"))
        met = met.unionByName(hyperminhash._by_token(crowds, apart).select("fp", F.col("token").cast("long"), "n"))

    def gathered(met: DataFrame) -> DataFrame:
        """A row per text, with all shards where it is to meet others (one per table at most)."""
        return cut(met.groupBy("fp").agg(F.collect_list(F.struct("token", "n")).alias("met")))

    met = gathered(met)
    fine = made.select("fp", "fine").join(met, "fp", "left_semi").dropDuplicates(["fp"])
    met = gathered(possible_texts(rooted.join(met, "fp").join(fine, "fp"), least=least, radius=radius, block=block))
    whole = similar.sets(met.select("fp"), docs, made, **settings).dropDuplicates(["fp"])
    return found.unionByName(whole_links(rooted.join(met, "fp").join(whole, "fp"), least=least, radius=radius, block=block))


def components(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, **settings) -> DataFrame:
    """One row per input row: doc_id, fingerprint (its node, hexadecimal), component_id (the smallest doc_id reachable)."""
    made = cut(sketches(docs, id_col=id_col, text_col=text_col, shingle=shingle))
    return simhash.labelled(made.select("doc_id", "digest", "fp"), links(docs, made, id_col=id_col, text_col=text_col, shingle=shingle, **settings))


def drop_near_duplicates(docs: DataFrame, *, broadcast_rows: int = simhash.BROADCAST_ROWS, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """The input's rows and columns; of each component only the document with the smallest doc_id stays."""
    return simhash.keep_first(docs, components(docs, id_col=id_col, text_col=text_col, **settings), id_col=id_col, text_col=text_col, broadcast_rows=broadcast_rows)
