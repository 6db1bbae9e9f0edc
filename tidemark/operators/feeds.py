"""Calendar and review feeds: rows first, and the JSON documents made of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import filled, http_url
from ..vocabulary import CALENDAR_COLOURS, CALENDAR_LABELS, OTHER_COLOUR

HIDDEN = ("REJECTED", "DELETED", "PENDING")

# Properties of a calendar entry, by the history columns they come from.
PROPERTIES = {
    "company": "company",
    "label": "label",
    "artistId": "artist_id",
    "eventStartDate": "event_start_date",
    "eventEndDate": "event_end_date",
    "dateConfidence": "date_confidence",
    "dateEvidence": "date_evidence",
    "dateSource": "date_source",
    "cities": "cities",
    "venues": "venues",
    "status": "status",
    "sourceType": "source_type",
    "approvalStatus": "approval_status",
    "relatedUrls": "related_urls",
    "articleTitle": "article_title",
}


def _lookup(values: dict[str, str], key: Column, other: Column) -> Column:
    return F.coalesce(F.element_at(F.create_map(*[F.lit(x) for pair in values.items() for x in pair]), key), other)


def window_of(today: Column, months: int = 3, days_back: int = 14) -> tuple[Column, Column]:
    """First and last day of the calendar: some days back, and whole months ahead (cut to the month's end)."""
    return F.date_sub(today, max(0, days_back)), F.add_months(today, months)


def calendar_events(history: DataFrame, today: str, *, months: int = 3, days_back: int = 14) -> DataFrame:
    """One row per entry: id, groupId, title, start, end (the day after, null for single days of a list), allDay, color, url, extendedProps.

    A row with a readable first day makes one entry, if it overlaps the window; otherwise each day
    of its list inside the window makes one.
    """
    first, last = window_of(F.to_date(F.lit(today)), months, days_back)
    name, artist, activity = F.trim(filled("event_name")), F.trim(filled("artist")), filled("activity_type")
    label = _lookup(CALENDAR_LABELS, activity, activity)
    title = F.concat(artist, F.lit(" · "), F.when((name != "") & (F.lower(name) != F.lower(artist)), name).otherwise(label))
    start = F.try_to_date(F.trim(filled("event_start_date")), "yyyy-MM-dd")
    end_text = F.trim(filled("event_end_date"))
    end = F.when(end_text == "", start).otherwise(F.try_to_date(end_text, "yyyy-MM-dd"))
    spanned = F.coalesce((end >= first) & (start <= last), F.lit(False))
    listed = F.transform(F.split(filled("event_dates"), r"\|"), lambda d: F.struct(F.trim(d).alias("said"), F.try_to_date(F.trim(d), "yyyy-MM-dd").alias("day")))
    inside = F.filter(listed, lambda d: F.coalesce((d["day"] >= first) & (d["day"] <= last), F.lit(False)))
    key = filled("event_key")
    entry = "array<struct<id:string,start:string,end:string>>"
    whole = F.array(F.struct(key.alias("id"), start.cast("string").alias("start"), F.date_add(end, 1).cast("string").alias("end"))).cast(entry)
    single = F.transform(inside, lambda d: F.struct(F.concat(key, F.lit(":"), d["said"]).alias("id"), d["said"].alias("start"), F.lit(None).cast("string").alias("end"))).cast(entry)
    shown = history.filter(~F.upper(filled("approval_status")).isin(*HIDDEN))
    props = F.struct(activity.alias("activityType"), label.alias("activityLabel"), artist.alias("artist"), name.alias("eventName"), *[(filled(c) if c in history.columns else F.lit("")).alias(p) for p, c in PROPERTIES.items()])
    colour = _lookup(CALENDAR_COLOURS, activity, F.lit(OTHER_COLOUR))
    made = shown.select(
        key.alias("groupId"),
        title.alias("title"),
        colour.alias("color"),
        (http_url("primary_url") if "primary_url" in history.columns else F.lit("")).alias("url"),
        props.alias("extendedProps"),
        F.explode(F.when(spanned, whole).otherwise(single)).alias("e"),
    )
    return made.select("e.id", "groupId", "title", "e.start", "e.end", F.lit(True).alias("allDay"), "color", "url", "extendedProps")


def calendar_document(history: DataFrame, queue: DataFrame, now: str, *, months: int = 3, days_back: int = 14, repository: str = "", zone: str = "Asia/Seoul") -> DataFrame:
    """One row, json: the feed of a bounded window, entries by start and title. Archives are read from ``calendar_events`` instead."""
    today = now[:10]
    events = calendar_events(history, today, months=months, days_back=days_back)
    entries = events.agg(F.array_sort(F.collect_list(F.struct("start", "title", F.struct(*events.columns).alias("it")))).alias("e"))
    first, last = window_of(F.to_date(F.lit(today)), months, days_back)
    head = {"generatedAt": F.lit(now), "timezone": F.lit(zone), "rangeStart": first.cast("string"), "rangeEndInclusive": last.cast("string"), "rangeEndExclusive": F.date_add(last, 1).cast("string"), "eventCount": F.size("e")}
    pending = queue.agg(F.count(F.lit(1)).alias("pending"))
    doc = F.struct(*[c.alias(n) for n, c in head.items()], F.col("pending").alias("pendingCount"), F.lit(repository).alias("repository"), F.transform("e", lambda x: x["it"]).alias("events"))
    # one row each
    return entries.join(F.broadcast(pending), F.lit(True)).select(F.to_json(doc).alias("json"))


def review_items(queue: DataFrame) -> DataFrame:
    """One row per queued candidate, in camel case; links are http or https."""

    def camel(name: str) -> str:
        head, *rest = name.split("_")
        return head + "".join(r.capitalize() for r in rest)

    return queue.select(*[(http_url(c) if c.endswith("_url") else filled(c)).alias(camel(c)) for c in queue.columns])


def review_document(queue: DataFrame, now: str, *, repository: str = "") -> DataFrame:
    """One row, json: the queue by start, company, artist and name."""
    items = review_items(queue)
    order = F.struct(F.coalesce(F.nullif("eventStartDate", F.lit("")), F.lit("9999-99-99")).alias("a"), F.col("company").alias("b"), F.col("artist").alias("c"), F.col("eventName").alias("d"), F.struct(*items.columns).alias("it"))
    listed = items.agg(F.array_sort(F.collect_list(order)).alias("e"))
    doc = F.struct(F.lit(now).alias("generatedAt"), F.size("e").alias("itemCount"), F.lit(repository).alias("repository"), F.transform("e", lambda x: x["it"]).alias("items"))
    return listed.select(F.to_json(doc).alias("json"))
