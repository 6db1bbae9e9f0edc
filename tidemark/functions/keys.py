"""Identity keys: the first 24 hexadecimal digits of a SHA-256 over joined fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import blank_to_null, canonical_url, collapse, filled, letters

_SIGNS = r"(?U)\W+"


def digest(*fields: Column) -> Column:
    """Fields joined by a bar, nulls as empty strings."""
    return F.substring(F.sha2(F.concat_ws("|", *[filled(f) for f in fields]), 256), 1, 24)


def _address(original_url: Column, url: Column) -> Column:
    return canonical_url(F.coalesce(blank_to_null(original_url), url))


def dedupe_key(artist_id: Column, original_url: Column, url: Column, title: Column) -> Column:
    """One article about one entity."""
    return digest(artist_id, F.coalesce(blank_to_null(_address(original_url, url)), F.lower(collapse(title))))


def candidate_id(artist_id: Column, original_url: Column, url: Column, title: Column) -> Column:
    """A review candidate; stays the same when its date or type is corrected."""
    return digest(artist_id, F.coalesce(blank_to_null(_address(original_url, url)), F.lower(F.regexp_replace(title, _SIGNS, ""))))


def event_key(artist_id: Column, activity: Column, name: Column, title: Column, start: Column, end: Column, dates: Column, cities: Column) -> Column:
    """An event found in articles. start and end: ISO texts or null; dates and cities: arrays of texts."""
    said = F.lower(F.regexp_replace(F.coalesce(blank_to_null(name), title), _SIGNS, ""))
    when = F.when(filled(start) != "", F.concat_ws(":", start, filled(end))).otherwise(F.array_join(F.array_sort(dates), ","))
    return digest(artist_id, activity, said, when, F.array_join(F.array_sort(cities), ","))


def review_key(artist_id: Column, activity: Column, name: Column, start: Column, cities: Column) -> Column:
    """An event confirmed in review. start and cities as stored."""
    return digest(artist_id, activity, letters(filled(name)), start, cities)


def truth_key(artist: Column, activity: Column, name: Column, dates: Column, cities: Column, key: Column) -> Column:
    """What an event says, so that a manual list needs no hashed key; the key itself where nothing is said."""
    said = F.when((filled(dates) != "") | (filled(cities) != ""), F.concat_ws("|", filled(dates), filled(cities))).otherwise(filled(name))
    joined = F.concat_ws("|", letters(filled(artist)), letters(filled(activity)), letters(said))
    return F.when(F.replace(joined, F.lit("|"), F.lit("")) == "", filled(key)).otherwise(joined)
