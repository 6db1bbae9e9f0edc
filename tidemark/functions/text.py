"""Text, URL and spreadsheet functions as native columns."""

from __future__ import annotations

import html
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..vocabulary import TRACKING


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is worked out once, however often body names it."""
    return F.transform(F.array(value), body)[0]


def filled(c: Column | str) -> Column:
    """Null as the empty string."""
    return F.coalesce(_col(c), F.lit(""))


def blank_to_null(c: Column | str) -> Column:
    return F.nullif(_col(c), F.lit(""))


def collapse(c: Column | str) -> Column:
    """Runs of white space as one space, none at the ends."""
    return F.trim(F.regexp_replace(_col(c), r"(?U)\s+", " "))


def strip_tags(c: Column | str) -> Column:
    return collapse(F.regexp_replace(_col(c), "<[^>]+>", " "))


@F.pandas_udf(T.StringType())
def unescape(c: pd.Series) -> pd.Series:
    """HTML entities decoded (there is no built-in for it)."""
    return c.map(html.unescape, na_action="ignore")


def clean_markup(c: Column | str) -> Column:
    """Tags dropped, entities decoded, white space collapsed."""
    return collapse(unescape(F.regexp_replace(_col(c), "<[^>]+>", "")))


def letters(c: Column | str, keep: str = "0-9a-z가-힣") -> Column:
    """Lower case, only the given characters kept."""
    return F.regexp_replace(F.lower(_col(c)), f"[^{keep}]+", "")


def without(c: Column, part: Column) -> Column:
    """Every occurrence of a literal, whatever its case, as a space; an empty or null part changes nothing."""
    quoted = F.regexp_replace(part, r"([\\^$.|?*+()\[\]{}])", r"\\$1")
    return F.when(filled(part) == "", c).otherwise(F.regexp_replace(c, F.concat(F.lit("(?iu)"), quoted), F.lit(" ")))


def find_all(text: Column, pattern: str, groups: int = 1) -> Column:
    """All matches as array<struct<from, to, said, parts>>; offsets in characters, parts the groups from 1 on.

    Java splits at the same matches that it extracts, so offsets are running sums of the lengths
    of gaps and matches.
    """
    kind = "array<struct<from:int,to:int,said:string,parts:array<string>>>"
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    parts = [F.regexp_extract_all(text, F.lit(pattern), F.lit(g)) for g in range(1, groups + 1)]
    rows = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), whole.alias("said"), *[p.alias(f"g{i}") for i, p in enumerate(parts)])
    zero = F.struct(F.lit(0).alias("at"), F.array().cast(kind).alias("found"))

    def step(acc: Column, row: Column) -> Column:
        start = acc["at"] + F.length(row["gap"])
        end = start + F.length(row["said"])
        hit = F.struct(start.alias("from"), end.alias("to"), row["said"].alias("said"), F.array(*[row[f"g{i}"] for i in range(groups)]).alias("parts"))
        return F.struct(F.coalesce(end, acc["at"]).alias("at"), F.when(row["said"].isNull(), acc["found"]).otherwise(F.concat(acc["found"], F.array(hit))).alias("found"))

    return F.when(text.rlike(pattern), F.aggregate(rows, zero, step, lambda acc: acc["found"])).otherwise(F.array().cast(kind))


def clip(text: Column | str, keywords: Column, size: int = 320, lead: int = 90) -> Column:
    """A window of the text that begins ``lead`` characters before the first keyword, with marks where it is cut."""
    clean = collapse(filled(text))
    places = F.filter(F.transform(keywords, lambda k: F.position(F.lower(k), F.lower(clean))), lambda p: p > 0)
    start = F.greatest(F.coalesce(F.array_min(places), F.lit(1)) - 1 - lead, F.lit(0))
    end = F.least(F.length(clean), start + size)
    cut = F.trim(F.substring(clean, start + 1, end - start))
    return F.when(clean == "", "").otherwise(F.concat(F.when(start > 0, "… ").otherwise(""), cut, F.when(end < F.length(clean), " …").otherwise("")))


_FORMULA = r"^[ \t\r\n]*[=+@-]"


def formula_safe(c: Column | str) -> Column:
    """A quote before texts that a spreadsheet would run; a text that has one already stays."""
    return F.when(_col(c).rlike(_FORMULA), F.concat(F.lit("'"), _col(c))).otherwise(_col(c))


def formula_restore(c: Column | str) -> Column:
    """Takes away one quote that ``formula_safe`` has put."""
    return F.when(_col(c).rlike(r"^'[ \t\r\n]*[=+@-]"), F.substring(_col(c), 2, 2_000_000_000)).otherwise(_col(c))


def http_url(c: Column | str) -> Column:
    """The URL if it is one of http or https, else empty."""
    url = F.trim(filled(c))
    return F.when(url.rlike(r"(?i)^https?://[^/?#]"), url).otherwise("")


_URL = r"^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)([^?#]*)(?:\?([^#]*))?(?:#[\s\S]*)?$"
_AUTHORITY = r"^(?:(.*)@)?\[?([^\]@:]*|[^\]]*(?=\]))\]?(?::([0-9]*))?$"


def host(c: Column | str) -> Column:
    """The lower-case host without www."""
    authority = F.regexp_extract(filled(c), _URL, 2)
    return F.regexp_replace(F.lower(F.regexp_extract(authority, _AUTHORITY, 2)), r"^www\.", "")


def canonical_url(c: Column | str, tracking: tuple[str, ...] = TRACKING) -> Column:
    """The URL without tracking parameters, fragment, default port and trailing slashes; parameters sorted.

    What is no absolute URL, or has an impossible port, keeps everything before its first #.
    """
    url = F.trim(filled(c))
    scheme, authority = F.lower(F.regexp_extract(url, _URL, 1)), F.regexp_extract(url, _URL, 2)
    user, name, port = (F.regexp_extract(authority, _AUTHORITY, i) for i in (1, 2, 3))
    usual = (port == "") | ((scheme == "http") & (port == "80")) | ((scheme == "https") & (port == "443")) | (port.try_cast("int") == 0)
    place = F.concat(F.when(user == "", "").otherwise(F.concat(user, F.lit("@"))), F.lower(name), F.when(usual, "").otherwise(F.concat(F.lit(":"), port.try_cast("int").cast("string"))))

    def plain(x: Column) -> Column:
        return F.coalesce(F.try_url_decode(x), F.regexp_replace(x, r"\+", " "))

    def coded(x: Column) -> Column:
        return F.replace(F.replace(F.url_encode(x), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))

    given = F.filter(F.split(F.regexp_extract(url, _URL, 4), "&"), lambda p: p != "")
    pairs = F.transform(
        given,
        lambda p, i: F.struct(
            F.lower(plain(F.substring_index(p, "=", 1))).alias("folded"),
            F.when(F.contains(p, F.lit("=")), plain(F.regexp_replace(p, "^[^=]*=", ""))).otherwise("").alias("value"),
            i.alias("at"),
            plain(F.substring_index(p, "=", 1)).alias("key"),
        ),
    )
    kept = F.filter(pairs, lambda p: ~p["folded"].startswith("utm_") & ~p["folded"].isin(*tracking))
    query = F.array_join(F.transform(F.array_sort(kept), lambda p: F.concat(coded(p["key"]), F.lit("="), coded(p["value"]))), "&")
    path = F.regexp_replace(F.regexp_extract(url, _URL, 3), "/+$", "")
    made = F.concat(scheme, F.lit("://"), place, F.when(path == "", "/").otherwise(path), F.when(query == "", "").otherwise(F.concat(F.lit("?"), query)))
    bad = (scheme == "") | (authority == "") | ~authority.rlike(_AUTHORITY) | ((port != "") & F.coalesce(port.try_cast("int") > 65535, F.lit(True)))
    return F.when(bad, F.substring_index(url, "#", 1)).otherwise(made)
