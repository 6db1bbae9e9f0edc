"""How document filters interact, over all their orders, with duplicates found by partition refinement.

Four filters look at one text (few words, few distinct words, many capitals, reserved signs), the
fifth at all of them: a text identical to that of a smaller doc_id. Its classes are refined step by
step: texts are split by their length in code points, then by the hash of one block after the
other (each ``GROWTH`` times as long as the one before, so that a text of any length has few), and
after every split classes of a single text are dropped. What survives all blocks is compared by its
full texts, and every id but a class's smallest is marked. Hashes therefore only rule out; two texts
are never called identical by a hash.

A large class of copies reaches a reducer as one row per map task and salt; the members get their
class's smallest id by a salted join. After the marks each row is a mask of five bits; the rows are
counted per part and mask, and the 120 orders are worked out from those counts, so the work after the
count does not depend on the rows.

Defined cases: a null text is empty and a null lang is the part ''; a null doc_id is smaller than no
other and no other is smaller than it, so it is never marked; rows that repeat doc_id and text are
counted each and mark each other never; a doc_id labelled several times is good (toxic) if any of its
labels says so; an empty table gives no part and so no row; further columns are ignored.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._spark import cut, text_of

LETTERS = "ABCDE"
ORDERS = tuple("".join(p) for p in permutations(LETTERS))
#: Code points of the first block, and how many times longer each following one is.
BLOCK, GROWTH = 256, 16
SALTS = 8
#: Classes and labels up to which they are broadcast (16 bytes each).
BROADCAST_ROWS = 1_000_000
_WS = "[ \t-\r]+"


def failures(text: Column) -> Column:
    """Bits 0 to 3: few words, few distinct words, many capitals, reserved signs."""
    words = F.array_remove(F.split(text, _WS), "")
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    tests = [F.size(words) < 200, 100 * F.size(F.array_distinct(words)) < 50 * F.size(words), 100 * capitals.cast("long") > 3 * F.length(text).cast("long"), text.rlike("[#$%&*|]")]
    bits = [t.cast("int") * (1 << i) for i, t in enumerate(tests)]
    return bits[0] + bits[1] + bits[2] + bits[3]


def blocks(text: Column, block: int = BLOCK, growth: int = GROWTH) -> Column:
    """The hashes of a text's successive blocks; there are as many as the text is long enough for, one at least."""
    length = F.length(text)
    count = F.greatest(F.ceil(F.log(float(growth), 1 + length * F.lit(growth - 1) / block)).cast("int"), F.lit(1))
    start = lambda i: F.floor(block * (F.pow(F.lit(float(growth)), i) - 1) / (growth - 1)).cast("int")
    # the last block goes to the end of the text whatever rounding made of the count
    return F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.xxhash64(F.substr(text, start(i) + 1, F.when(i == count - 1, length).otherwise(start(i + 1) - start(i)))))


def _path(length: Column, hashes: Column, steps: int) -> Column:
    """The class of a text after so many blocks: one long for its length and the hashes so far."""
    return F.xxhash64(length, *[F.coalesce(F.get(hashes, F.lit(i)), F.lit(0).cast("long")) for i in range(steps)])


def _few(df: DataFrame, limit: int) -> DataFrame:
    return F.broadcast(df) if df.count() <= limit else df


def _within(rows: DataFrame, key: Column, classes: DataFrame, limit: int) -> DataFrame:
    """The rows whose class is in classes (column path): broadcast while few, else with salts, as one class may hold a third of the rows."""
    if classes.count() <= limit:
        return rows.join(F.broadcast(classes), key == F.col("path"), "left_semi")
    spread = classes.withColumn("salt", F.explode(F.array(*[F.lit(i).cast("long") for i in range(SALTS)])))
    return rows.join(spread, (key == F.col("path")) & (F.pmod(F.xxhash64("id", "hashes"), F.lit(SALTS)) == F.col("salt")), "left_semi")


def refined(marks: DataFrame, *, broadcast_rows: int = BROADCAST_ROWS) -> tuple[DataFrame, int]:
    """Classes (path) that no block splits into single texts, and after how many blocks. marks: id, length, hashes."""
    classes = cut(marks.groupBy(_path(F.col("length"), F.col("hashes"), 0).alias("path")).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("path"))
    left, steps = marks, 0
    while True:
        left = _within(marks, _path(F.col("length"), F.col("hashes"), steps), classes, broadcast_rows)
        longest = left.agg(F.max(F.size("hashes")).alias("most")).first()["most"]
        if longest is None or longest <= steps:
            return classes, steps
        steps += 1
        classes = cut(left.groupBy(_path(F.col("length"), F.col("hashes"), steps).alias("path")).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("path"))


def copies(docs: DataFrame, marks: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK, growth: int = GROWTH, broadcast_rows: int = BROADCAST_ROWS) -> tuple[DataFrame, DataFrame, int]:
    """path, least (the smallest id) of every class of identical texts; the same per text of the classes that still hold several; and the number of blocks."""
    classes, steps = refined(marks, broadcast_rows=broadcast_rows)
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text")).select("id", "text", F.length("text").alias("length"), blocks(F.col("text"), block, growth).alias("hashes"))
    met = _within(rows, _path(F.col("length"), F.col("hashes"), steps), classes, broadcast_rows).select("id", "text", _path(F.col("length"), F.col("hashes"), steps).alias("path"))
    salted = met.groupBy("path", F.pmod(F.xxhash64("id"), F.lit(SALTS)).alias("salt"), "text").agg(F.min("id").alias("id"))
    texts = cut(salted.repartition("path").groupBy("path", "text").agg(F.min("id").alias("least")))
    counted = texts.groupBy("path").agg(F.min("least").alias("least"), F.count(F.lit(1)).alias("texts"))
    several = counted.filter("texts > 1").select("path")
    return cut(counted.filter("texts = 1").select("path", "least")), texts.join(several, "path").select("path", "text", "least"), steps


def marked(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang", block: int = BLOCK, growth: int = GROWTH, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """id, part, mask (bit i: fails filter i), n: how many rows of the input are alike in these."""
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), text_of(text_col).alias("text"))
    marks = cut(rows.select("id", "part", failures(F.col("text")).alias("mask"), F.length("text").alias("length"), blocks(F.col("text"), block, growth).alias("hashes")))
    settings = {"id_col": id_col, "text_col": text_col, "block": block, "growth": growth, "broadcast_rows": broadcast_rows}
    one, several, steps = copies(docs, marks, **settings)
    path = _path(F.col("length"), F.col("hashes"), steps)
    salt = F.pmod(F.xxhash64("id", "hashes"), F.lit(SALTS))
    keyed = marks.withColumns({"path": path, "salt": salt})
    if one.count() <= broadcast_rows:
        held = keyed.join(F.broadcast(one), "path", "left")
    else:
        held = keyed.join(one.withColumn("salt", F.explode(F.array(*[F.lit(i).cast("long") for i in range(SALTS)]))), ["path", "salt"], "left")
    copy = F.coalesce(F.col("id") > F.col("least"), F.lit(False))
    plain = held.select("id", "part", (F.col("mask") + 16 * copy.cast("int")).alias("mask"), "path")
    if not several.isEmpty():
        # different texts of one length whose hashes all agree: those classes are told apart by their texts
        mixed = cut(several)
        again = rows.select("id", "part", failures(F.col("text")).alias("mask"), "text", _path(F.length("text"), blocks(F.col("text"), block, growth), steps).alias("path"))
        by_text = again.join(mixed, ["path", "text"]).select("id", "part", (F.col("mask") + 16 * copy.cast("int")).alias("mask"), "path")
        plain = plain.join(mixed.select("path").distinct(), "path", "left_anti").unionByName(by_text)
    return plain.groupBy("id", "part", "mask").agg(F.count(F.lit(1)).alias("n"))


def mask_counts(made: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """part, mask, n, good, toxic: counts of rows. made: as of ``marked``."""
    said = lambda c: F.max(F.coalesce(F.col(c) == 1, F.lit(False)).cast("int")).alias(c)
    known = cut(labels.filter(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(said("quality"), said("toxic")))
    joined = made.join(_few(known, broadcast_rows), "id", "left")
    return joined.groupBy("part", "mask").agg(F.sum("n").alias("n"), *[F.sum(F.when(F.col(c) == 1, F.col("n")).otherwise(0)).alias(to) for c, to in (("quality", "good"), ("toxic", "toxic"))])


def orders(counts: DataFrame) -> DataFrame:
    """One row per part, filter_order and step, zeros included. counts: as of ``mask_counts``, at most 32 rows a part."""
    empty = F.array_repeat(F.lit(0).cast("long"), 32)
    pick = lambda c: F.map_from_entries(F.collect_list(F.struct("mask", c)))
    tables = counts.groupBy("part").agg(*[pick(c).alias(c) for c in ("n", "good", "toxic")])

    def dense(c: str) -> Column:
        return F.transform(empty, lambda zero, i: F.coalesce(F.try_element_at(F.col(c), i), zero)).alias(c)

    tables = tables.select("part", *[dense(c) for c in ("n", "good", "toxic")])
    masks = F.sequence(F.lit(0), F.lit(31))

    def total(column: str, keep) -> Column:
        """The counts of a column over the masks for which keep holds."""
        return F.aggregate(masks, F.lit(0).cast("long"), lambda s, m: s + F.when(keep(m), F.get(F.col(column), m)).otherwise(F.lit(0).cast("long")))

    def held(m: Column, bits: Column) -> Column:
        return m.bitwiseAND(bits) != 0

    places = [(o, k + 1, 1 << LETTERS.index(o[k]), sum(1 << LETTERS.index(x) for x in o[:k])) for o in ORDERS for k in range(5)]
    # a filter's removed at one place depends on the letters before it alone: 80 cases, not 600
    cases = sorted({(bit, before) for _, _, bit, before in places})
    case = F.explode(F.array(*[F.struct(F.lit(b).alias("bit"), F.lit(f).alias("before")) for b, f in cases])).alias("case")
    worked = tables.select("part", "n", "good", "toxic", case).select("part", "n", "good", "toxic", "case.bit", "case.before")
    own = lambda m: held(m, F.col("bit")) & ~held(m, F.col("before"))
    figures = worked.select(
        "part",
        "bit",
        "before",
        total("n", lambda m: ~held(m, F.col("bit").bitwiseOR(F.col("before")))).alias("kept"),
        total("n", own).alias("removed"),
        total("n", lambda m: held(m, F.col("bit")) & held(m, F.col("before"))).alias("redundant"),
        total("n", lambda m: m == F.col("bit")).alias("unique_fails"),
        total("good", own).alias("good_lost"),
        total("toxic", own).alias("toxic_lost"),
    )
    named = F.explode(F.array(*[F.struct(F.lit(o).alias("filter_order"), F.lit(s).alias("step"), F.lit(b).alias("bit"), F.lit(f).alias("before")) for o, s, b, f in places])).alias("place")
    # the fixed table of 600 places meets the figures by the part and the case
    listed = tables.select("part", named).select("part", "place.*")
    full = listed.join(figures, ["part", "bit", "before"])
    shapley = full.groupBy("part", "bit").agg(F.sum("removed").alias("shapley"))
    return full.join(shapley, ["part", "bit"]).select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def audit(docs: DataFrame, labels: DataFrame, **settings) -> DataFrame:
    """The whole report: part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley."""
    counts = cut(mask_counts(marked(docs, **settings), labels, id_col=settings.get("id_col", "doc_id"), broadcast_rows=settings.get("broadcast_rows", BROADCAST_ROWS)))
    return cut(orders(counts))
