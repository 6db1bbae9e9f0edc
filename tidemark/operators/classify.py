"""Activity, score and rejection of titles by weighted keywords and ordered reasons."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import clip, filled, let
from ..vocabulary import ANNOUNCES, REJECTIONS, RULES, Rejection, Rule

PER_HIT, MOST = 3, 12
OTHER = "OTHER"


def classified(text: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """struct<activity, score, keywords>: the best rule (the earlier one on ties) and the sorted keywords of all rules that hit."""

    def rate(low: Column) -> Column:
        hits = [F.array_compact(F.array(*[F.when(F.contains(low, F.lit(k.lower())), k) for k in r.keywords])) for r in rules]
        scored = F.array(
            *[
                F.struct((F.lit(r.base) + F.least(F.lit(MOST), PER_HIT * (F.size(h) - 1))).alias("score"), F.lit(-i).alias("order"), F.lit(r.activity).alias("activity"), h.alias("hits"))
                for i, (r, h) in enumerate(zip(rules, hits))
            ]
        )
        return F.filter(scored, lambda s: F.size(s["hits"]) > 0)

    def best_of(met: Column) -> Column:
        best = F.array_max(F.transform(met, lambda s: F.struct(s["score"].alias("score"), s["order"].alias("order"), s["activity"].alias("activity"))))
        keywords = F.array_sort(F.array_distinct(F.flatten(F.transform(met, lambda s: s["hits"]))))
        return F.struct(F.coalesce(best["activity"], F.lit(OTHER)).alias("activity"), F.coalesce(best["score"], F.lit(0)).alias("score"), keywords.alias("keywords"))

    return let(F.lower(filled(text)), lambda low: let(rate(low), best_of))


def classify(articles: DataFrame, rules: tuple[Rule, ...] = RULES, *, title_only: bool = True) -> DataFrame:
    """Adds activity_type, score, matched_keywords and clipped_text."""
    text = F.col("title") if title_only else F.concat_ws("\n", "title", filled("body"))
    made = articles.withColumn("_c", classified(text, rules))
    evidence = F.when(filled("body") != "", F.col("body")).otherwise(F.col("title"))
    columns = {"activity_type": F.col("_c.activity"), "score": F.col("_c.score"), "matched_keywords": F.col("_c.keywords"), "clipped_text": clip(evidence, F.col("_c.keywords"))}
    return made.withColumns(columns).drop("_c")


def rejection(title: Column, activity: Column, rejections: tuple[Rejection, ...] = REJECTIONS, announces: str = ANNOUNCES) -> Column:
    """The first reason that holds, or an empty string."""
    text = filled(title)
    new = text.rlike(f"(?iuU){announces}")

    def holds(r: Rejection) -> Column:
        tests = [activity.isin(*r.activities)] if r.activities else []
        tests += [text.rlike(f"(?iuU){r.pattern}")] if r.pattern else []
        tests += [~new] if r.lifted else []
        return reduce(lambda a, b: a & b, tests)

    return F.coalesce(*[F.when(holds(r), r.reason) for r in rejections], F.lit(""))


def excluded_report(excluded: DataFrame, examples: int = 20) -> tuple[DataFrame, DataFrame]:
    """Counts per reason, and the first ``examples`` rows of each reason by seq."""
    counts = excluded.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))
    first = Window.partitionBy("reason").orderBy("seq")
    return counts, excluded.withColumn("_r", F.row_number().over(first)).filter(F.col("_r") <= examples).drop("_r")
