"""How alike two names are.

The ratio of matching blocks has no built-in. It cannot exceed twice the shorter length over both
lengths, so callers filter by ``ratio_bound`` first, which costs nothing.
"""

from __future__ import annotations

from collections.abc import Callable
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import vocabulary as V
from .text import filled, letters, without


@F.pandas_udf(T.DoubleType())
def ratio(left: pd.Series, right: pd.Series) -> pd.Series:
    """Twice the matching characters over all; not symmetric. 0 where a side is empty or null."""
    seen: dict[tuple[str, str], float] = {}
    for pair in zip(left, right):
        if pair not in seen:
            seen[pair] = SequenceMatcher(None, *pair).ratio() if pair[0] and pair[1] else 0.0
    return pd.Series([seen[p] for p in zip(left, right)], dtype="float64")


@F.pandas_udf(T.BooleanType())
def alike(left: pd.Series, right: pd.Series, least: pd.Series) -> pd.Series:
    """Whether the ratio reaches a limit. The letters that two names share bound it and are counted first; what belongs to the right name is prepared once for all that it meets."""
    seen: dict[tuple, bool] = {}
    matchers: dict[str, SequenceMatcher] = {}
    for pair in zip(left, right, least):
        if pair not in seen:
            a, b, limit = pair
            if a and b and b not in matchers:
                matchers[b] = SequenceMatcher(None, "", b)
            if a and b:
                matchers[b].set_seq1(a)
                seen[pair] = matchers[b].quick_ratio() >= limit and matchers[b].ratio() >= limit
            else:
                seen[pair] = limit <= 0
    return pd.Series([seen[p] for p in zip(left, right, least)], dtype=bool)


def ratio_bound(left: Column, right: Column) -> Column:
    """An upper bound of the ratio from the lengths alone; 0 where both are empty."""
    total = F.length(left) + F.length(right)
    return F.when(total == 0, F.lit(0.0)).otherwise(F.lit(2.0) * F.least(F.length(left), F.length(right)) / total)


def jaccard(left: Column, right: Column) -> Column:
    """Shared over all distinct entries of two arrays; 0 where both are empty."""
    either = F.size(F.array_union(left, right))
    return F.when(either == 0, F.lit(0.0)).otherwise(F.size(F.array_intersect(left, right)) / either)


def sharing(names: DataFrame, blocks: list[str], least: float) -> DataFrame:
    """blocks, name, other, alike: ordered pairs of names of one block (a name with itself too) whose jaccard of tokens is least (above 0) or more.

    Such names share a token, so they meet by tokens: in the first that they share, and their sizes bound what they can reach.
    """
    words = names.select(*blocks, "name", "tokens", F.size("tokens").alias("size_of"), F.explode("tokens").alias("word"))
    other = words.select(*blocks, "word", F.col("name").alias("other"), F.col("tokens").alias("theirs"), F.col("size_of").alias("size_other"))
    near = words.join(other, [*blocks, "word"]).filter(F.least("size_of", "size_other") >= F.lit(least) * F.greatest("size_of", "size_other"))
    once = near.filter(F.array_intersect("tokens", "theirs")[0] == F.col("word"))
    return once.withColumn("alike", jaccard(F.col("tokens"), F.col("theirs"))).filter(F.col("alike") >= least).select(*blocks, "name", "other", "alike")


def like_pairs(rows: DataFrame, blocks: list[str], alike: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """l, r and what alike adds: rows (key, name and blocks) of one block whose names are alike, l the lesser key.

    alike is asked about the distinct names of a block and gives ordered pairs (blocks, name, other, its columns; a name
    with itself too). Rows meet only where their names are alike, so the work grows with the pairs that come out.
    """
    names = rows.filter(F.col("name").isNotNull()).select(*blocks, "name").distinct()
    pairs = alike(names)
    added = [c for c in pairs.columns if c not in (*blocks, "name", "other")]
    left = rows.select(*blocks, "name", F.col("key").alias("l")).join(pairs, [*blocks, "name"]).drop("name")
    # merged: a side that looks small would be sent to all, and a name's rows are streamed here
    met = left.hint("merge").join(rows.select(*blocks, F.col("name").alias("other"), F.col("key").alias("r")), [*blocks, "other"])
    return met.filter("l < r").select("l", "r", *added)


def tokens(title: Column, name: Column, artist: Column, alias: Column, stop: tuple[str, ...] = V.STOP_WORDS) -> Column:
    """Distinct words of two characters or more, without the entity's names and words that say nothing."""
    text = F.lower(F.concat_ws(" ", title, name))
    for part in (artist, alias):
        text = F.when(filled(part) == "", text).otherwise(F.replace(text, F.lower(part), F.lit(" ")))
    words = F.regexp_extract_all(text, F.lit("[0-9a-z가-힣♥]+"), F.lit(0))
    return F.array_distinct(F.filter(words, lambda w: (F.length(w) >= 2) & ~w.isin(*stop)))


def anchor(name: Column, artist: Column, alias: Column) -> Column:
    """What of a name tells one event from another; empty if nothing does."""
    value = F.lower(filled(name))
    for part in (artist, alias):
        value = without(value, F.lower(part))
    value = letters(F.regexp_replace(value, f"(?U){V.NAME_NOISE}", " "), "0-9a-z가-힣♥")
    return F.when((F.length(value) < 4) | value.rlike(V.GENERIC_NAME), "").otherwise(value)


def enrich_anchor(name: Column) -> Column:
    return letters(F.regexp_replace(F.lower(filled(name)), f"(?U){V.ENRICH_NOISE}", " "), "0-9a-z가-힣♥")
