"""Spans of days that overlap, as an equi-join.

A span stands in a level by its length: level k has slots of 4 ** k days, so that a span meets at most
two slots of its own level and of every wider one. Two spans meet in the wider of their levels, in the
slot in which the later one starts, and nowhere else: one side stands in its own level only, the other in
all from its own on. A day and a span of years cost the same few rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Levels: the last has slots of 4 ** 11 days, longer than any calendar.
LEVELS = 12
_EPOCH = 719_528  # days before 1970, so that slots count from zero


def _width(level: Column) -> Column:
    return F.element_at(F.array(*[F.lit(4**k).cast("long") for k in range(LEVELS)]), level + 1)


def _placed(rows: DataFrame, name: str, keys: list[str], start: str, end: str) -> DataFrame:
    first, last = F.datediff(F.col(start), F.lit("1970-01-01").cast("date")) + _EPOCH, F.datediff(F.coalesce(end, start), F.lit("1970-01-01").cast("date")) + _EPOCH
    put = rows.select(*keys, F.struct(*rows.columns).alias(name), first.cast("long").alias("_first"), last.cast("long").alias("_last")).filter("_first <= _last")
    length = F.col("_last") - F.col("_first") + 1
    return put.withColumn("_own", F.filter(F.sequence(F.lit(0), F.lit(LEVELS - 1)), lambda k: _width(k) >= length)[0])


def _slots(placed: DataFrame, levels: Column, side: str) -> DataFrame:
    dealt = placed.withColumn("_level", F.explode(levels))
    slot = lambda day: F.floor(F.col(f"{day}_{side}") / _width(F.col("_level")))
    return dealt.withColumn("_slot", F.explode(F.array_distinct(F.array(slot("_first"), slot("_last")))))


def overlapping(left: DataFrame, right: DataFrame, keys: list[str], *, start: str = "start", end: str = "end") -> DataFrame:
    """keys, l and r (the rows, as structs) of all rows of equal keys whose spans share a day. A missing end is the start; rows without a start, or that end before it, meet nothing."""
    marks = ("_first", "_last", "_own")
    x = _placed(left, "l", keys, start, end).withColumnsRenamed({m: f"{m}_l" for m in marks})
    y = _placed(right, "r", keys, start, end).withColumnsRenamed({m: f"{m}_r" for m in marks})
    own = lambda placed, side: _slots(placed, F.array(f"_own_{side}"), side)
    on = [*keys, "_level", "_slot"]
    # where both have one level they meet in the first of the joins; merged, as Spark takes the dealt rows for as small as the table that they come from and would send them to all
    wider_left = own(x, "l").hint("merge").join(_slots(y, F.sequence(F.col("_own_r"), F.lit(LEVELS - 1)), "r"), on)
    wider_right = _slots(x, F.filter(F.sequence(F.col("_own_l"), F.lit(LEVELS - 1)), lambda k: k > F.col("_own_l")), "l").hint("merge").join(own(y, "r"), on)
    here = F.col("_slot") == F.floor(F.greatest("_first_l", "_first_r") / _width(F.col("_level")))
    met = wider_left.unionByName(wider_right)
    return met.filter(here & (F.col("_first_l") <= F.col("_last_r")) & (F.col("_first_r") <= F.col("_last_l"))).select(*keys, "l", "r")
