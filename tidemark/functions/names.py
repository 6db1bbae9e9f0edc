"""Event names, cities and venues out of text, as native columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import vocabulary as V
from .text import blank_to_null, collapse, let, without

NAME_SIZE = 120
_EDGE = " -–—,·"


def _found(text: Column, pattern: str, flags: str = "(?iuU)") -> Column:
    """The first group of the first match, collapsed; null if nothing matches."""
    return blank_to_null(collapse(F.regexp_extract(text, flags + pattern, 1)))


def _name(c: Column) -> Column:
    return F.when(~c.rlike(f"(?iuU){V.NOT_A_NAME}"), c)


def event_name(title: Column, activity: Column, artist: Column, alias: Column) -> Column:
    """What the title calls the event, by the first of these that finds something.

    A quoted name after its type, or before a type of live event; a release name in capitals; the
    name of a tour; a general label where the quoted words are a song; the title without entity,
    dates and set phrases; a general label.
    """
    clean = collapse(title)
    release = activity == "COMEBACK"
    labels = F.create_map(*[F.lit(x) for pair in V.LABELS.items() for x in pair])
    label = F.coalesce(F.element_at(labels, activity), F.lit(V.OTHER_LABEL))
    fans = clean.rlike(f"(?iuU){V.FAN_CONCERT}")
    tour = F.btrim(_found(clean, V.TOUR_NAME), F.lit(_EDGE))
    song = activity.isin(*V.STAGE_ACTIVITIES) & clean.rlike(f"(?iuU){V.SONG}")
    bare = F.substring_index(F.substring_index(clean, "…", 1), "...", 1)
    bare = reduce(without, (alias, artist), bare)
    bare = reduce(lambda c, p: F.regexp_replace(c, f"(?U){p.pattern}", " "), V.DATE_PATTERNS, bare)
    bare = F.btrim(collapse(F.regexp_replace(bare, f"(?iuU){V.BOILERPLATE}", " ")), F.lit(" -–—|,·"))
    name = F.coalesce(
        F.when(release, _name(_found(clean, V.RELEASE_NAME))).otherwise(_name(_found(clean, V.LIVE_NAME))),
        F.when(~release, _name(_found(clean, V.NAME_BEFORE_LIVE))),
        F.when(release, _found(clean, V.BARE_RELEASE_NAME, "(?U)")),
        F.when(F.length(tour) >= 3, tour),
        F.when(song, F.concat_ws(" ", artist, F.when(fans, V.FAN_CONCERT_LABEL).otherwise(label))),
        F.when(F.length(bare) >= 3, _name(bare)),
        F.concat_ws(" ", artist, F.when((activity == "CONCERT") & fans, V.FAN_CONCERT_LABEL).otherwise(label)),
    )
    return F.substring(name, 1, NAME_SIZE)


def cities(text: Column, names: dict[str, tuple[str, ...]] = V.CITIES) -> Column:
    """Sorted cities that the text names."""
    padded = F.concat(F.lit(" "), F.lower(text), F.lit(" "))

    def said(inside: Column) -> Column:
        return F.array(*[F.when(reduce(lambda a, b: a | b, [F.contains(inside, F.lit(n.lower())) for n in known]), city) for city, known in names.items()])

    # padded is worked out once, not once for every name that is looked for in it
    return F.array_sort(F.array_compact(let(padded, said)))


def venues(text: Column, pattern: str = V.VENUE) -> Column:
    """Sorted venues that the text names."""

    def tidy(found: Column) -> Column:
        value = F.btrim(collapse(found), F.lit(_EDGE))
        last = F.trim(F.element_at(F.split(value, f"(?U){V.VENUE_CUT}", -1), -1))
        kept = F.when(F.length(last) < 2, value).otherwise(last)
        after = F.when(F.contains(kept, F.lit("까지")), F.trim(F.regexp_replace(kept, "(?s)^.*?까지", ""))).otherwise(kept)
        return F.regexp_replace(F.regexp_replace(after, r"(?U)^.*?\d{1,2}\s*일(?:부터|까지)?\s*", ""), f"(?iuU){V.VENUE_CITY}", "")

    named = F.transform(F.regexp_extract_all(text, F.lit(f"(?iuU){pattern}"), F.lit(1)), tidy)
    return F.array_sort(F.array_distinct(F.filter(named, lambda v: F.length(v).between(2, 60))))
