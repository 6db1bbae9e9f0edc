"""Collocations: frequent phrases of two to five words, scored, found by hashed candidate generation.

The texts are read once per phrase length. While the phrases of k words are counted exactly, those
of k + 1 words are counted by buckets of their hashes (PCY, DHP), and what is sent on are bitmaps of
fixed size: one of the buckets that reach the support, one of the hashes of the frequent phrases of
k words. In the next pass a phrase is counted exactly only if its bucket reached the support and
both of its parts of k words are frequent (Apriori); and it enters the buckets of the next length
only if it passed the same test. Both bitmaps can only let too much through, so the exact counts and
their support decide.

What is broadcast is two bitmaps of ``2 ** bits`` bits, however large the texts are. Exact counts are
folded per slice of words in the task, then by the map side of the aggregate; a very frequent phrase
reaches its reducer as one row per task. Within a slice, phrases of equal hash are compared word by
word, and across slices they are grouped by the words themselves.

Defined cases: a null text is empty; a null lang is ``und`` (and meets rows of that name); texts of
any length are read whole; repeated rows count each; ties are decided by phrase; an empty table, or
one without frequent phrases, gives no row; further columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._spark import cut, text_of

SUPPORT, LONGEST, TOP = 100, 5, 2_000
#: The number of buckets, as a power of two: 2 MB per bitmap.
BITS = 24
#: Words of a task that are worked on together.
SLICE = 400_000
SALTS = 16
#: Frequent phrases up to which their counts are broadcast: rows and bytes of text.
BROADCAST_ROWS, BROADCAST_BYTES = 500_000, 32 << 20
#: Rows of one bucket table that travel together.
PART = 1 << 16

_BREAK = b"\xff"  # no byte of UTF-8
_TABLE = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\n\v\f\r", b"abcdefghijklmnopqrstuvwxyz" + _BREAK * 10)
_ODD, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def words(text: str) -> list[bytes]:
    """Lower-case words; a mark stands where a piece ends."""
    return text.encode("utf-8").translate(_TABLE).replace(_BREAK, b" \xff ").split()


class _Numbers(dict):
    """Numbers of words in the order in which they come."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


class Slice:
    """Words of several texts of one or more languages as numbers, with the hashes of their phrases."""

    def __init__(self) -> None:
        self.number = _Numbers({_BREAK: 0})
        self.at: list[int] = []
        self.langs: list[str] = []
        self.ends: list[int] = []

    def add(self, lang: str, text: str) -> None:
        self.at += map(self.number.__getitem__, words(text))
        self.at.append(0)
        self.langs.append(lang)
        self.ends.append(len(self.at))

    def close(self) -> None:
        self.ids = np.array(self.at, dtype=np.int32)
        self.words = list(self.number)
        names = sorted(set(self.langs))
        self.names = names
        place = {n: i for i, n in enumerate(names)}
        self.lang = np.repeat(np.array([place[x] for x in self.langs], dtype=np.int32), np.diff([0, *self.ends]))
        digest = np.fromiter(map(xxhash.xxh64_intdigest, self.words), dtype=np.uint64, count=len(self.words))
        seeds = np.array([xxhash.xxh64_intdigest(n.encode(), 7) for n in names], dtype=np.uint64)
        self.word_hash, self.seed = digest[self.ids], seeds[self.lang]
        self.whole = self.ids != 0

    def phrases(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """For every place: the hash of the k words from there on, and whether they stand in one piece."""
        n = len(self.ids) - k + 1
        if n <= 0:
            return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=bool)
        out, whole = self.seed[:n].copy(), self.whole[:n].copy()
        for i in range(k):
            out = (out ^ self.word_hash[i : n + i]) * _ODD
            out ^= out >> np.uint64(29)
            if i:
                whole &= self.whole[i : n + i]
        return out * _MIX, whole

    def count(self, k: int, hashes: np.ndarray, places: np.ndarray) -> tuple[list[str], list[str], np.ndarray]:
        """lang, phrase, count of the phrases at these places; phrases of one hash are told apart by their words."""
        if not len(places):
            return [], [], np.zeros(0, dtype=np.int64)
        _, first, back, n = np.unique(hashes, return_index=True, return_inverse=True, return_counts=True)
        held = places[first]
        same = self.lang[places] == self.lang[held[back]]
        for i in range(k):
            same &= self.ids[places + i] == self.ids[held[back] + i]
        if not same.all():
            rows = np.column_stack([self.lang[places], *[self.ids[places + i] for i in range(k)]])
            _, first, n = np.unique(rows, axis=0, return_index=True, return_counts=True)
            held = places[first]
        text = [w.decode("utf-8") for w in self.words[1:]]
        columns = [self.ids[held + i].tolist() for i in range(k)]
        phrases = [text[c - 1] for c in columns[0]] if k == 1 else [" ".join([text[w - 1] for w in row]) for row in zip(*columns)]
        return [self.names[i] for i in self.lang[held].tolist()], phrases, n


def slices(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[Slice]:
    """The texts of the batches (lang, text) in slices of at least so many words, or one text."""
    now = Slice()
    for batch in batches:
        for lang, text in zip(batch.column(0), batch.column(1)):
            now.add(lang.as_py(), text.as_py())
            if len(now.at) >= size:
                now.close()
                yield now
                now = Slice()
    if now.at:
        now.close()
        yield now


def _hit(bitmap: np.ndarray, places: np.ndarray) -> np.ndarray:
    return (bitmap[(places >> np.uint64(3)).astype(np.int64)] >> (places & np.uint64(7)).astype(np.uint8)) & 1 != 0


def _slot(hashes: np.ndarray, bits: int) -> np.ndarray:
    return hashes >> np.uint64(64 - bits)


def _slot_of_key(hashes: np.ndarray, bits: int) -> np.ndarray:
    """Other bits than those of ``_slot``, so that the two bitmaps err apart."""
    return (hashes * _ODD) >> np.uint64(64 - bits)


def _bitmap(packed: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(packed), dtype=np.uint8)


class Buckets:
    """Counts of buckets in a task: a sorted list of those that occur while they are few, a table of all beyond that."""

    def __init__(self, bits: int, most: int) -> None:
        self.bits, self.most = bits, most
        self.table: np.ndarray | None = None
        self.waiting: list[np.ndarray] = []
        self.room = (1 << bits) // 16

    def add(self, slots: np.ndarray) -> None:
        self.waiting.append(slots.astype(np.int64))
        if self.table is not None or sum(map(len, self.waiting)) > self.room:
            if self.table is None:
                self.table = np.zeros(1 << self.bits, dtype=np.uint32)
            for own in self.waiting:
                np.add.at(self.table, own, np.uint32(1))
            self.waiting = []

    def parts(self) -> Iterator[tuple[int, bytes]]:
        """Each part of PART buckets that is not empty: counts up to the limit, as bytes of all of its buckets or as places and counts."""
        size = min(PART, 1 << self.bits)
        if self.table is None:
            slots, n = np.unique(np.concatenate(self.waiting), return_counts=True) if self.waiting else (np.zeros(0, dtype=np.int64),) * 2
        else:
            slots = np.flatnonzero(self.table)
            n = self.table[slots]
        n = np.minimum(n, self.most).astype(np.uint8)
        part = slots // size
        starts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]]) if len(part) else np.zeros(0, dtype=int)
        for a, b in zip(starts, [*starts[1:], len(part)]):
            places = (slots[a:b] % size).astype(np.uint32)
            if (b - a) * 5 >= size:
                own = np.zeros(size, dtype=np.uint8)
                own[places] = n[a:b]
                yield int(part[a]), b"t" + zlib.compress(own.tobytes(), 1)
            else:
                yield int(part[a]), b"l" + places.tobytes() + n[a:b].tobytes()


def _put(table: np.ndarray, data: bytes) -> None:
    """Adds the counts of a part to a table of them, up to what a short number holds."""
    if data[:1] == b"t":
        table += np.frombuffer(zlib.decompress(data[1:]), dtype=np.uint8)
    else:
        n = (len(data) - 1) // 5
        table[np.frombuffer(data, dtype=np.uint32, count=n, offset=1)] += np.frombuffer(data, dtype=np.uint8, count=n, offset=1 + 4 * n)


def _merged(parts: DataFrame, bits: int, support: int) -> bytes:
    """The bitmap of the buckets that reach the support, out of parts (part, data) of tasks; what reaches the driver is that bitmap alone."""
    size = min(PART, 1 << bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                table = held.setdefault(part, np.zeros(size, dtype=np.uint16))
                _put(table, data.as_py())
                np.minimum(table, support, out=table)  # no larger sum can leave the support again
        for part, table in held.items():
            bitmap = np.packbits(table >= support, bitorder="little")
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([zlib.compress(bitmap.tobytes(), 1)], pa.binary())], names=["part", "data"])

    out = np.zeros((1 << bits) // 8, dtype=np.uint8)
    for row in parts.repartition("part").mapInArrow(run, "part int, data binary").collect():
        out[row["part"] * size // 8 : (row["part"] + 1) * size // 8] = _bitmap(row["data"])
    return zlib.compress(out.tobytes(), 1)


def counted(rows: DataFrame, k: int, allowed, *, support: int, longest: int, bits: int, size: int) -> DataFrame:
    """One row per phrase and slice (lang, phrase, n) and, with part set, the counts of the buckets of k + 1 words.

    rows: lang, text. allowed: None for single words, else the broadcast bitmaps of the buckets of k
    words and of the frequent phrases of k - 1 words.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets = Buckets(bits, support) if k < longest else None
        known = [_bitmap(b) for b in allowed.value] if allowed is not None else None
        for now in slices(batches, size):
            hashes, good = now.phrases(k)
            if known is not None and len(hashes):
                below, _ = now.phrases(k - 1)
                frequent = _hit(known[1], _slot_of_key(below, bits))
                good &= frequent[: len(good)] & frequent[1 : len(good) + 1]
                good[good] = _hit(known[0], _slot(hashes[good], bits))
            places = np.flatnonzero(good)
            langs, phrases, n = now.count(k, hashes[places], places)
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(phrases, pa.string()), pa.array(n, pa.int64()), pa.nulls(len(n), pa.int32()), pa.nulls(len(n), pa.binary())], names=["lang", "phrase", "n", "part", "data"])
            if buckets is not None:
                longer, whole = now.phrases(k + 1)
                if known is not None:
                    whole &= good[: len(whole)] & good[1 : len(whole) + 1]
                buckets.add(_slot(longer[whole], bits))
        if buckets is not None:
            parts, data = zip(*found) if (found := list(buckets.parts())) else ((), ())
            none = [pa.nulls(len(parts), t) for t in (pa.string(), pa.string(), pa.int64())]
            yield pa.RecordBatch.from_arrays([*none, pa.array(parts, pa.int32()), pa.array(data, pa.binary())], names=["lang", "phrase", "n", "part", "data"])

    return rows.mapInArrow(run, "lang string, phrase string, n long, part int, data binary")


def _frequent_bitmap(frequent: DataFrame, bits: int) -> bytes:
    """The bitmap of the hashes of frequent phrases (lang, phrase)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets = Buckets(bits, 1)
        for batch in batches:
            now, k = Slice(), 1
            for lang, phrase in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                now.add(lang, phrase)
                k = phrase.count(" ") + 1  # the same for all
            if now.at:
                now.close()
                buckets.add(_slot_of_key(now.phrases(k)[0][[0, *now.ends[:-1]]], bits))
        parts, data = zip(*found) if (found := list(buckets.parts())) else ((), ())
        yield pa.RecordBatch.from_arrays([pa.array(parts, pa.int32()), pa.array(data, pa.binary())], names=["part", "data"])

    return _merged(frequent.select("lang", "phrase").mapInArrow(run, "part int, data binary"), bits, 1)


def frequent_phrases(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", support: int = SUPPORT, longest: int = LONGEST, bits: int = BITS, size: int = SLICE) -> tuple[DataFrame, DataFrame]:
    """lang, phrase, words, n of all phrases of up to longest words with support; and lang, n of all words."""
    if not 0 < support < 256:
        raise ValueError("the counts that tasks report for a bucket are bytes: support must be 1 to 255")
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), text_of(text_col).alias("text"))
    found, allowed, totals = None, None, None
    for k in range(1, longest + 1):
        made = cut(counted(rows, k, allowed, support=support, longest=longest, bits=bits, size=size))
        phrases = made.filter("part IS NULL").groupBy("lang", "phrase").agg(F.sum("n").alias("n"))
        if k == 1:
            totals = cut(made.filter("part IS NULL").groupBy("lang").agg(F.sum("n").alias("n")))
        own = cut(phrases.filter(F.col("n") >= support).select("lang", "phrase", F.lit(k).alias("words"), "n"))
        found = own if found is None else found.unionByName(own)
        if k == longest or own.isEmpty():
            break
        enough = _merged(made.filter("part IS NOT NULL").select("part", "data"), bits, support)
        allowed = spark.sparkContext.broadcast([enough, _frequent_bitmap(own, bits)])
    return found, totals


def _cuts(words: Column, count: Column) -> Column:
    """A candidate's words cut after its first k words, for every k."""
    return F.transform(F.sequence(F.lit(1), count - 1), lambda k: F.struct(k.alias("k"), F.array_join(F.slice(words, F.lit(1), k), " ").alias("first"), F.array_join(F.slice(words, k + 1, count - k), " ").alias("rest")))


def scored(frequent: DataFrame, totals: DataFrame, *, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """lang, phrase, a, l, r, n, score of the candidates that no longer one covers."""
    size = frequent.agg(F.count(F.lit(1)).alias("rows"), F.sum(F.octet_length("phrase") + F.octet_length("lang")).alias("bytes")).first()
    small = size["rows"] <= broadcast_rows and (size["bytes"] or 0) <= BROADCAST_BYTES

    def counts(name: str) -> DataFrame:
        """The counts of phrases under other names; beyond a broadcast with salts, as one part may begin very many candidates."""
        own = frequent.select("lang", F.col("phrase").alias(name), F.col("n").alias("of_" + name))
        return F.broadcast(own) if small else own.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))

    keys = ["lang"] if small else ["lang", "salt"]
    several = frequent.filter("words > 1").withColumn("own", F.split("phrase", " "))
    # a phrase inside any longer one is inside one of one word more, which is as frequent at least
    inner = F.explode(F.array(F.array_join(F.slice("own", F.lit(1), F.col("words") - 1), " "), F.array_join(F.slice("own", F.lit(2), F.col("words") - 1), " "))).alias("phrase")
    covered = several.filter("words > 2").select("lang", inner, "n").groupBy("lang", "phrase").agg(F.max("n").alias("covered"))
    left = several.join(covered, ["lang", "phrase"], "left").filter(F.coalesce(100 * F.col("covered") < 100 * F.col("n"), F.lit(True)))
    salt = F.pmod(F.xxhash64("phrase"), F.lit(SALTS)).cast("int")
    parts = left.select("lang", "phrase", F.col("n").alias("a"), salt.alias("salt"), F.explode(_cuts(F.col("own"), F.col("words"))).alias("cut")).select("lang", "phrase", "a", "salt", "cut.*")
    both = parts.join(counts("first"), [*keys, "first"]).join(counts("rest"), [*keys, "rest"])
    # languages may be many, and one may hold most rows: their totals are few or meet by salts too
    sums = totals.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))) if not small else F.broadcast(totals)
    whole = both.join(sums, keys)
    long = lambda c: F.col(c).cast("decimal(19,0)")
    product = F.lit(1000).cast("decimal(4,0)") * (long("a") * long("n")).cast("decimal(34,0)")
    whole = whole.withColumns({"over": product.cast("decimal(38,0)"), "under": (long("of_first") * long("of_rest")).cast("decimal(38,0)")}).withColumn("score", F.expr("over div under"))
    best = F.min(F.struct("score", "k", F.col("of_first").alias("l"), F.col("of_rest").alias("r"))).alias("best")
    return whole.groupBy("lang", "phrase", "a", "n").agg(best).select("lang", "phrase", "a", "best.l", "best.r", "n", "best.score")


def ranked(candidates: DataFrame, top: int = TOP) -> DataFrame:
    """The first candidates of each lang with their rank; first inside salts, so that one task sorts at most SALTS * top rows of a lang."""
    order = [F.desc("score"), F.desc("a"), "phrase"]
    dealt = candidates.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    some = dealt.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).filter(F.col("rank") <= top).drop("rank", "salt")
    out = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= top)
    return out.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def collocations(docs: DataFrame, *, top: int = TOP, broadcast_rows: int = BROADCAST_ROWS, **settings) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each lang's first phrases by score."""
    frequent, totals = frequent_phrases(docs, **settings)
    return ranked(scored(cut(frequent), totals, broadcast_rows=broadcast_rows), top)
