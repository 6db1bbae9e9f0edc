"""Event dates out of text, as native columns.

Each pattern claims the matches that overlap no earlier claim and name a real span of days; a
claim becomes a candidate whose score tells how well the words around it speak for it. The whole
search is one fold over arrays, so it stays in the JVM and needs no shuffle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..vocabulary import CUES, DATE_PATTERNS, FUTURE, NEXT_YEAR, PAST_PREFIX, DatePattern
from .text import find_all, let

LONGEST = 45
AROUND, AROUND_YEAR, BEFORE = 34, 30, 10
BODY_PENALTY, GAP, HIGH, MEDIUM = 32, 15, 85, 55
CANDIDATE = "struct<start:date,end:date,score:int,evidence:string,source:string,from:int,to:int>"


def real_date(year: Column, month: Column, day: Column) -> Column:
    """The date, or null where there is none."""

    def of(p: Column) -> Column:
        length = F.dayofmonth(F.last_day(F.make_date(p["y"], p["m"], F.lit(1))))
        real = p["y"].between(0, 9999) & p["m"].between(1, 12) & p["d"].between(1, 31)
        return F.when(real, F.when(p["d"] <= length, F.make_date(p["y"], p["m"], p["d"])))

    return let(F.struct(year.cast("int").alias("y"), month.cast("int").alias("m"), day.cast("int").alias("d")), of)


def days(start: Column, end: Column, longest: int = LONGEST) -> Column:
    """All days from start to end; empty if reversed or longer apart than ``longest`` days."""
    return F.when(F.datediff(end, start).between(0, longest), F.sequence(F.least(start, end), F.greatest(start, end))).otherwise(F.array().cast("array<date>"))


def review_days(start: Column, end: Column, longest: int = LONGEST) -> Column:
    """Days joined by bars as reviews store them; longer spans as their two ends; reversed ones are an error."""
    last = F.coalesce(end, start)
    joined = F.array_join(F.transform(days(start, last, longest), lambda d: d.cast("string")), "|")
    ends = F.concat_ws("|", start.cast("string"), last.cast("string"))
    return F.when(last < start, F.raise_error(F.lit("an event ends before it starts"))).when(F.datediff(last, start) > longest, ends).otherwise(joined)


def _span(kind: str, parts: Column, reference: Column, context: Column, future: str) -> tuple[Column, Column]:
    """First and last day of a match, from its groups and the day of publication."""
    n = [parts[i].cast("int") for i in range(4)]
    year, month = F.year(reference), F.month(reference)
    later = F.add_months(F.trunc(reference, "month"), 1)

    def year_of(m: Column) -> Column:
        ahead = context.rlike(NEXT_YEAR) | ((month >= 10) & (m <= 3) & context.rlike(f"(?iu){future}"))
        return year + F.when(ahead, 1).otherwise(0)

    if kind == "month day month day":
        first = year_of(n[0])
        return real_date(first, n[0], n[1]), real_date(first + F.when(n[2] < n[0], 1).otherwise(0), n[2], n[3])
    if kind == "month day day":
        return real_date(year_of(n[0]), n[0], n[1]), real_date(year_of(n[0]), n[0], n[2])
    if kind == "day next day":
        return real_date(year, month, n[0]), real_date(F.year(later), F.month(later), n[1])
    if kind == "day day":
        return real_date(year, month, n[0]), real_date(year, month, n[1])
    one = {
        "year month day": lambda: real_date(n[0], n[1], n[2]),
        "month day": lambda: real_date(year_of(n[0]), n[0], n[1]),
        "next day": lambda: real_date(F.year(later), F.month(later), n[0]),
        "day": lambda: real_date(year, month, n[0]),
    }[kind]()
    return one, one


def candidates(
    text: Column,
    reference: Column,
    activity: Column,
    source: Column,
    *,
    patterns: tuple[DatePattern, ...] = DATE_PATTERNS,
    cues: dict[str, tuple[str, ...]] = CUES,
    future: str = FUTURE,
    penalty: int = BODY_PENALTY,
) -> Column:
    """array<CANDIDATE> of a clean text. reference: the day of publication; source: TITLE or BODY."""
    none = F.array().cast("array<string>")
    words = F.coalesce(F.element_at(F.create_map(*[x for k, v in cues.items() for x in (F.lit(k), F.array(*[F.lit(w.lower()) for w in v]))]), activity), none)

    def around(hit: Column, reach: int) -> Column:
        first = F.greatest(hit["from"] - reach, F.lit(0))
        return F.substring(text, first + 1, hit["to"] + reach - first)

    def claim(found: Column, spec: DatePattern) -> Column:
        groups = len(spec.kind.replace("next ", "").split())

        def step(acc: Column, hit: Column) -> Column:
            near = around(hit, AROUND)
            cued, coming = F.exists(words, lambda w: F.contains(F.lower(near), w)), near.rlike(f"(?iu){future}")
            start, end = _span(spec.kind, hit["parts"], reference, around(hit, AROUND_YEAR), future)
            free = ~F.exists(acc, lambda c: (hit["from"] < c["to"]) & (hit["to"] > c["from"]))
            good = free & F.coalesce(F.datediff(end, start).between(0, LONGEST), F.lit(False))
            if spec.title_only:
                lead = F.substring(text, F.greatest(hit["from"] - BEFORE, F.lit(0)) + 1, F.least(hit["from"], F.lit(BEFORE)))
                good = good & cued & coming & ~lead.rlike(f"(?iu){PAST_PREFIX}")
            score = F.lit(spec.base) - F.when(source == "BODY", penalty).otherwise(0) + F.when(cued, 18).otherwise(0) + F.when(coming, 6).otherwise(0)
            said = F.trim(F.regexp_replace(hit["said"], r"(?U)\s+", " "))
            made = F.struct(start.alias("start"), end.alias("end"), score.alias("score"), said.alias("evidence"), source.alias("source"), hit["from"].alias("from"), hit["to"].alias("to"))
            return F.when(good, F.concat(acc, F.array(made.cast(CANDIDATE)))).otherwise(acc)

        read = F.when(source == "TITLE", text).otherwise("") if spec.title_only else text
        return F.aggregate(find_all(read, f"(?U){spec.pattern}", groups), found, step)

    nothing = F.array().cast(f"array<{CANDIDATE}>")
    return F.when(text.rlike(r"(?U)\d"), reduce(claim, patterns, nothing)).otherwise(nothing)


def _best(found: Column) -> Column:
    """The first candidate of the highest score."""
    return F.array_max(F.transform(found, lambda c, i: F.struct(c["score"].alias("score"), (-i).alias("order"), c.alias("it"))))["it"]


def choose(title: Column, body: Column, gap: int = GAP) -> Column:
    """struct<it: CANDIDATE, conflict: boolean> of the title's candidates, or the body's where there are none.

    A title's single day gives way to a body's range that starts on the same day and scores no
    less. Of several spans the best must lead by ``gap``; otherwise they conflict.
    """

    def pool(best: Column) -> Column:
        head, rest = best["head"], best["rest"]
        extends = (head["start"] == head["end"]) & (rest["start"] == head["start"]) & (rest["end"] > head["end"]) & (rest["score"] >= head["score"])
        return F.when((F.size(title) == 0) | F.coalesce(extends, F.lit(False)), body).otherwise(title)

    def led(both: Column) -> Column:
        top = both["top"]
        second = F.array_max(F.filter(both["ranked"], lambda r: (r["start"] != top["start"]) | (r["end"] != top["end"])))
        clear = second.isNull() | (top["score"] - second["score"] >= gap)
        return F.struct(F.when(clear, top["it"]).alias("it"), (top.isNotNull() & ~clear).alias("conflict"))

    ranked = F.transform(
        let(F.struct(_best(title).alias("head"), _best(body).alias("rest")), pool),
        lambda c, i: F.struct(c["score"].alias("score"), c["start"].alias("start"), c["end"].alias("end"), (-i).alias("order"), c.alias("it")),
    )
    return let(ranked, lambda r: let(F.struct(r.alias("ranked"), F.array_max(r).alias("top")), led))


def confidence(chosen: Column) -> Column:
    score = chosen["it"]["score"]
    return F.when(chosen["conflict"], "CONFLICT").when(score.isNull(), "NONE").when(score >= HIGH, "HIGH").when(score >= MEDIUM, "MEDIUM").otherwise("LOW")
