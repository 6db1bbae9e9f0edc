"""The stores that outlive a run: event history and review queue, upserted as new snapshots."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.frames import groups
from ..functions.keys import candidate_id, event_key
from ..functions.similarity import alike, ratio_bound
from ..functions.text import blank_to_null, filled
from ..lineage import cut
from ..schemas import HISTORY, QUEUE

#: Least likeness of names with the same first day, and without.
SAME_DAY, ANY_DAY = 0.25, 0.72
#: Events of a run up to which they are broadcast to the history.
BROADCAST_ROWS = 200_000


def _bars(c: str) -> Column:
    return F.array_join(F.transform(F.coalesce(F.col(c), F.array()), lambda v: v.cast("string")), "|")


def _iso(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(""))


def keyed(events: DataFrame) -> DataFrame:
    """Events with event_key and candidate_id, derived from their fields as they are now."""
    dates = F.transform("event_dates", lambda d: d.cast("string"))
    key = event_key(F.col("artist_id"), F.col("activity_type"), F.col("event_name"), F.col("title"), F.col("event_start_date").cast("string"), F.col("event_end_date").cast("string"), dates, F.col("cities"))
    return events.withColumns({"event_key": key, "candidate_id": candidate_id(F.col("artist_id"), F.col("original_url"), F.col("url"), F.col("title"))})


def match_in_order(rows: dict[str, tuple], new: Iterable[tuple]) -> Iterator[tuple]:
    """seq and history key of each new event of one (entity, activity): its own, else that of the first like event, in order.

    rows: key -> first day, name, fixed, in the order of the history; the events' own rows are added or
    take the place of others as they come. new: seq, event_key, start, first_day, name, exact.
    """
    matcher = SequenceMatcher(None)
    for seq, key, start, first_day, name, exact in new:
        to = key
        if to not in rows and not exact:
            matcher.set_seq2(name)
            for k, (day, known, _) in rows.items():
                least = SAME_DAY if start and day == start else ANY_DAY
                if 2 * min(len(known), len(name)) < least * (len(known) + len(name)):
                    continue
                matcher.set_seq1(known)
                if matcher.quick_ratio() >= least and matcher.ratio() >= least:
                    to = k
                    break
        if to not in rows or not rows[to][2]:
            rows[to] = (first_day, name, False)
        yield seq, to


_FOLDED = ["event_key", "start", "first_day", "name", "fixed", "exact", "seq"]


def _fold(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """As match_in_order, for every (entity, activity) of a sorted partition; rows of the history come first."""
    out: list[tuple] = []
    for _, group in groups(frames, ["artist_id", "activity_type"]):
        rows: dict[str, tuple] = {}
        new = []
        for key, start, first_day, name, fixed, exact, seq in zip(*(group[c].tolist() for c in _FOLDED)):
            if seq is None or seq != seq:
                rows[key] = (start, name, fixed)
            else:
                new.append((int(seq), key, start, first_day, name, exact))
        out += match_in_order(rows, new)
        if len(out) > 10_000:
            yield pd.DataFrame(out, columns=["seq", "history_key"])
            out = []
    yield pd.DataFrame(out, columns=["seq", "history_key"]).astype({"seq": "int64"})


def _first_day(start: Column, days: Column) -> Column:
    """A row's first day: its start, else the first of its listed days, else empty."""
    return F.coalesce(blank_to_null(start), blank_to_null(F.substring_index(days, "|", 1)), F.lit(""))


def history_keys(history: DataFrame, events: DataFrame, *, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """seq, history_key. Events of one entity and activity are matched in order, so that one may find a row which an earlier one made.

    Only what the run can touch leaves the history: rows whose key an event has, and rows that are
    like an event without such a key. Likeness is tested pair by pair after an equi-join by entity and
    activity and the bound by lengths; the ordered part sees the surviving rows only, and no group
    all of whose events have their keys in the history.
    """
    keys = ["artist_id", "activity_type"]
    place = F.concat_ws("|", F.coalesce(blank_to_null("event_start_date"), blank_to_null("event_dates"), F.lit("9999-99-99")), filled("company"), filled("artist"), "event_key")
    fixed = (filled("approval_status") == "MANUAL_CONFIRMED") | (filled("official_verified") == "Y")
    first_day = _first_day(F.col("event_start_date"), F.col("event_dates"))
    known = history.filter(filled("event_key") != "").select(*keys, "event_key", first_day.alias("start"), F.lower(filled("event_name")).alias("name"), fixed.alias("fixed"), place.alias("place"))
    raw = cut(events.select(*keys, *match_fields(), F.col("seq").alias("place")))
    small = raw.count() <= broadcast_rows
    few = F.broadcast if small else (lambda df: df)
    present = known.join(few(raw.select("event_key").distinct()), "event_key", "left_semi").select("event_key", F.lit(True).alias("exact"))
    new = cut(raw.join(present, "event_key", "left").withColumn("exact", F.coalesce("exact", F.lit(False))))
    loose = new.filter("NOT exact")
    wanted = cut(loose.select(*keys).distinct())

    other = few(loose.select(*keys, F.col("start").alias("its_start"), F.col("name").alias("its_name")).distinct())
    least = F.when((F.col("its_start") != "") & (F.col("its_start") == F.col("start")), SAME_DAY).otherwise(ANY_DAY)
    met = known.select(*keys, "event_key", "start", "name").join(other, keys).withColumn("least", least)
    near = met.filter(ratio_bound(F.col("name"), F.col("its_name")) >= F.col("least") - 1e-9).filter(alike("name", "its_name", "least")).select("event_key")
    touched = near.unionByName(new.filter("exact").join(wanted, keys, "left_semi").select("event_key")).distinct()
    kept = known.join(touched, "event_key", "left_semi")
    old = kept.select(*keys, F.lit(0).alias("side"), "place", "event_key", "start", F.lit("").alias("first_day"), "name", "fixed", F.lit(False).alias("exact"), F.lit(None).cast("long").alias("seq"))
    own = new.join(few(wanted), keys, "left_semi").select(*keys, F.lit(1).alias("side"), F.lit("").alias("place"), "event_key", "start", "first_day", "name", F.lit(False).alias("fixed"), "exact", F.col("place").alias("seq"))
    dealt = old.unionByName(own).repartition(*keys).sortWithinPartitions(*keys, "side", "place", "seq")
    folded = dealt.select(*keys, *_FOLDED).mapInPandas(_fold, "seq long, history_key string")
    return folded.unionByName(new.join(few(wanted), keys, "left_anti").select(F.col("place").alias("seq"), F.col("event_key").alias("history_key")))


def stored_fields() -> list[Column]:
    """What a row of the history takes over from an event."""
    return [
        filled("company").alias("company"), filled("label").alias("label"), F.col("artist_id"), filled("artist").alias("artist"), F.col("activity_type"),
        F.coalesce(blank_to_null("event_name"), F.col("title")).alias("event_name"), _iso("event_start_date").alias("event_start_date"), _iso("event_end_date").alias("event_end_date"),
        _bars("event_dates").alias("event_dates"), F.col("date_confidence"), filled("date_evidence").alias("date_evidence"), filled("date_source").alias("date_source"),
        F.when(F.col("date_conflict"), "Y").otherwise("N").alias("date_conflict"), _bars("cities").alias("cities"), _bars("venues").alias("venues"),
        filled("schedule_status").alias("status"), filled("source_type").alias("source_type"), F.col("score").cast("string").alias("score"), F.col("title").alias("article_title"),
    ]


def addresses() -> Column:
    return F.concat(F.array("url"), F.coalesce("related_urls", F.array().cast("array<string>")))


def officially(events: DataFrame) -> Column:
    return F.coalesce(F.col("official_verified"), F.lit(False)) if "official_verified" in events.columns else F.lit(False)


def match_fields() -> list[Column]:
    """What decides which row of the history an event belongs to."""
    name = F.lower(F.coalesce(blank_to_null("event_name"), F.col("title")))
    return [F.col("event_key"), _iso("event_start_date").alias("start"), _first_day(_iso("event_start_date"), _bars("event_dates")).alias("first_day"), name.alias("name")]


def upsert_history(history: DataFrame, events: DataFrame, now: str) -> DataFrame:
    """A new snapshot of the history. events: clustered and keyed; now: the run's time as text.

    A row confirmed by hand, or by an official source while the event is not, only notes that it
    was seen and its best score. Any other row takes the fields of the run's last event, keeps its
    first sighting and primary URL, and gathers URLs.
    """
    matched = events.join(history_keys(history, events), "seq")
    runs = matched.groupBy("history_key").agg(
        F.max_by(F.struct(*stored_fields()), "seq").alias("new"),
        F.max("score").alias("best"),
        F.bool_or(officially(events)).alias("official"),
        F.array_distinct(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("seq", addresses().alias("urls")))), lambda s: s["urls"]))).alias("urls"),
    )
    old = history.filter(filled("event_key") != "").select(F.struct(*HISTORY).alias("old"), F.col("event_key").alias("history_key"))
    both = old.join(runs, "history_key", "full_outer")
    new, was = F.col("new"), F.col("old")
    touched = new.isNotNull() & ((filled("old.approval_status") == "MANUAL_CONFIRMED") | ((filled("old.official_verified") == "Y") & ~F.col("official")))
    kept = F.filter(F.array_distinct(F.concat(F.array(filled("old.primary_url")), F.split(filled("old.related_urls"), r"\|"), F.coalesce("urls", F.array().cast("array<string>")))), lambda u: u != "")
    primary = F.coalesce(blank_to_null("old.primary_url"), F.col("urls")[0])
    made = {
        "event_key": F.col("history_key"),
        "first_seen": F.coalesce(blank_to_null("old.first_seen"), F.lit(now)),
        "last_seen": F.lit(now),
        "primary_url": primary,
        "official_verified": F.lit("N/A"),
        "supporting_article_count": F.greatest(F.size(kept), F.lit(1)).cast("string"),
        "related_urls": F.array_join(F.array_remove(kept, primary), "|"),
        "approval_status": F.coalesce(blank_to_null("old.approval_status"), F.lit("AUTO_CONFIRMED")),
        "reviewed_at": filled("old.reviewed_at"),
        "review_source": filled("old.review_source"),
    }
    best = F.greatest(F.coalesce(was["score"].try_cast("int"), F.lit(0)), F.col("best")).cast("string")

    def field(name: str) -> Column:
        fresh = made[name] if name in made else new[name]
        seen = F.lit(now) if name == "last_seen" else best if name == "score" else was[name]
        return F.when(new.isNull(), was[name]).when(touched, seen).otherwise(fresh).alias(name)

    return both.select(*[field(n) for n in HISTORY])


def review_rows(events: DataFrame, now: str | Column) -> DataFrame:
    """Events as rows of the queue, with seq. now: the run's time as text, or a column that has it."""
    seen = F.lit(now) if isinstance(now, str) else now
    made = {
        "event_name": F.coalesce(blank_to_null("event_name"), F.col("title")),
        "event_start_date": _iso("event_start_date"),
        "event_end_date": _iso("event_end_date"),
        "event_dates": _bars("event_dates"),
        "date_conflict": F.when(F.col("date_conflict"), "Y").otherwise("N"),
        "cities": _bars("cities"),
        "venues": _bars("venues"),
        "article_title": F.col("title"),
        "published_at": F.coalesce(F.date_format("published_at", "yyyy-MM-dd'T'HH:mm:ssXXX"), F.lit("")),
        "score": F.col("score").cast("string"),
        "review_reason": F.coalesce(blank_to_null("review_reason"), F.lit("MANUAL_REVIEW")),
        "primary_url": F.col("url"),
        "related_urls": _bars("related_urls"),
        "supporting_article_count": F.col("supporting_article_count").cast("string"),
        "first_seen": seen,
        "last_seen": seen,
        "review_status": F.lit("PENDING"),
    }
    return events.select("seq", *[(made[c] if c in made else filled(c)).alias(c) for c in QUEUE])


def without_rejected(rows: DataFrame, log: DataFrame) -> DataFrame:
    """Rows whose event or candidate was not rejected before."""
    rejected = log.filter("action = 'REJECT'")
    return rows.join(rejected.select("event_key").distinct(), "event_key", "left_anti").join(rejected.select("candidate_id").distinct(), "candidate_id", "left_anti")


def upsert_queue(queue: DataFrame, events: DataFrame, log: DataFrame, now: str) -> DataFrame:
    """A new snapshot of the review queue. events: clustered and keyed.

    A candidate is known by its id, else by its event key (also of an earlier event of this run);
    a known one keeps its id and first sighting, everything else is new. Rows that no event
    touches stay.
    """
    new = without_rejected(review_rows(events, now), log)
    known = queue.filter(filled("candidate_id") != "")
    by_id = known.select("candidate_id", F.col("candidate_id").alias("id_1"))
    by_event = known.groupBy("event_key").agg(F.max("candidate_id").alias("id_2")).filter(filled("event_key") != "")
    met = new.join(by_id, "candidate_id", "left").join(by_event, "event_key", "left").withColumn("known_id", F.coalesce("id_1", "id_2")).drop("id_1", "id_2")
    first = F.first(F.coalesce("known_id", "candidate_id")).over(Window.partitionBy("event_key").orderBy("seq"))
    named = met.withColumn("candidate_id", F.coalesce("known_id", first)).drop("known_id")
    last = named.groupBy("candidate_id").agg(F.max_by(F.struct(*QUEUE), "seq").alias("new"))
    both = known.select(F.struct(*QUEUE).alias("old"), "candidate_id").join(last, "candidate_id", "full_outer")

    def field(name: str) -> Column:
        fresh = F.coalesce(blank_to_null("old.first_seen"), F.col("new.first_seen")) if name == "first_seen" else F.col(f"new.{name}")
        return F.when(F.col("new").isNull(), F.col(f"old.{name}")).otherwise(fresh).alias(name)

    return both.select(*[field(n) for n in QUEUE])


def history_order() -> list[Column]:
    return [F.coalesce(blank_to_null("event_start_date"), blank_to_null("event_dates"), F.lit("9999-99-99")), F.col("company"), F.col("artist")]


def queue_order() -> list[Column]:
    return [F.coalesce(blank_to_null("event_start_date"), F.lit("9999-99-99")), F.col("company"), F.col("artist"), F.col("event_name")]
