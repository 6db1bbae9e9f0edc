"""The plan of pop-up notices: searches, addresses, what is cached and what has to be fetched, and ordered rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import filled
from ..lineage import cut
from ..operators import popup
from ..operators.scan import first_per
from ..sources.files import uncached

# The terms of a search, and the reason of a row outside the range.
TERMS = ("POP-UP", "POP UP", "popup", "팝업", "ポップアップ")
OUTSIDE = "outside extracted popup-period range"
PREVIEW = 2_500


def search_queries(spark: SparkSession, communities: DataFrame, first_year: int, last_year: int, *, site: str, terms: tuple[str, ...] = TERMS) -> DataFrame:
    """community, place, query: per term a search by title, by text and with the group's name, and the last two again for each year; each once.

    communities: community, group_name. site: what the search is limited to, with {community}.
    """
    head, tail = site.split("{community}")
    at = F.concat(F.lit(f"site:{head}"), F.col("community"), F.lit(tail + " "))
    quoted = F.concat(F.lit('"'), F.col("term"), F.lit('"'))
    group = F.concat(F.lit('"'), F.col("group_name"), F.lit('" '))
    years = F.transform(F.sequence(F.lit(first_year), F.lit(last_year)), lambda y: F.concat(F.lit(" "), y.cast("string"))) if first_year <= last_year else F.array().cast("array<string>")
    per_year = F.flatten(F.transform(years, lambda y: F.array(F.concat(at, quoted, y), F.concat(at, group, quoted, y))))
    asked = communities.select("*", F.posexplode(F.array(*[F.lit(t) for t in terms])).alias("n", "term"))
    plain = F.array(F.concat(at, F.lit("intitle:"), quoted), F.concat(at, quoted), F.concat(at, group, quoted))
    rows = asked.select("community", "n", F.posexplode(F.concat(plain, per_year)).alias("m", "query"))
    return first_per(rows, ["community", "query"], ["n", "m"]).withColumn("place", F.col("n") * (3 + 2 * max(0, last_year - first_year + 1)) + F.col("m")).select("community", "place", "query")


def notice_id(url: Column) -> Column:
    """The number in a notice's address, else empty."""
    return F.regexp_extract(filled(url), r"/notice/(\d+)", 1)


def canonical(url: Column, community: Column, *, host: str) -> Column:
    """The plain address of a community's notice on this host; empty for any other address."""
    parts = [F.regexp_extract(filled(url), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)([^?#]*)", g) for g in (1, 2)]
    # what follows the community's folder, empty where there is none
    behind = F.split_part(parts[1], F.concat(F.lit("/"), community, F.lit("/notice/")), F.lit(2))
    number = F.regexp_extract(behind, r"^(\d+)", 1)
    return F.when((parts[0] == host) & (number != ""), F.concat(F.lit(f"https://{host}/"), community, F.lit("/notice/"), number)).otherwise("")


@dataclass(frozen=True)
class Run:
    """Pop-up rows in order, raw notices with a preview of the body, what was left out and why, and the cache as it is now."""

    rows: DataFrame
    raw: DataFrame
    excluded: DataFrame
    cache: DataFrame


def collect(candidates: DataFrame, cache: DataFrame, fetch: Callable[[DataFrame], DataFrame], first: str, last: str, *, secondary: bool = False) -> Run:
    """Candidates that the cache lacks are fetched; titles, periods and reasons follow for all of them.

    candidates: url and more. fetch: turns candidates into rows of the cache's columns.
    """
    new = fetch(uncached(candidates, cache))
    known = cut(cache.unionByName(new.select(*cache.columns)))
    mine = known.join(candidates.select("url").distinct(), "url", "left_semi")
    titled = mine.withColumn("title", popup.clean_title(F.col("title")))
    why = popup.wanted(F.col("http_status"), F.col("title"), secondary=secondary)
    judged = cut(titled.withColumn("reason", why))
    made = cut(popup.popup_rows(judged.filter("reason = ''").drop("reason")))
    inside = popup.overlaps(F.col("start_date"), F.col("end_date"), F.lit(first).cast("date"), F.lit(last).cast("date"))
    rows = first_per(made.filter(inside), ["url"], ["notice_id"]).orderBy(*order())
    kept = ["artist", "company_group", "source_type", "url", "notice_id", "title", "http_status", "fetch_error"]
    excluded = judged.filter("reason <> ''").select(*kept, "reason").unionByName(made.filter(~inside).select(*kept, F.lit(OUTSIDE).alias("reason")))
    return Run(rows, preview(mine), excluded, known)


def preview(notices: DataFrame, size: int = PREVIEW) -> DataFrame:
    """Notices with the beginning of their body instead of the body."""
    return notices.withColumn("body_preview", F.substring(filled("body"), 1, size)).drop("body")


def order() -> list[Column]:
    """Company, artist, first day and title; rows without a day stand last in their group."""
    return [F.col("company_group").asc_nulls_last(), F.col("artist").asc_nulls_last(), F.col("start_date").asc_nulls_last(), F.col("title").asc_nulls_last(), F.col("url")]
