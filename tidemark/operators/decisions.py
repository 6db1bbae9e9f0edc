"""Applies a document of review decisions to history and queue, all of it or nothing."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import review_days
from ..functions.keys import review_key
from ..functions.text import blank_to_null, filled
from ..lineage import cut
from ..schemas import HISTORY, QUEUE, REVIEW_LOG
from ..vocabulary import CUES

# Actions, the fields that a decision may set, and limits.
ACTIONS = ("APPROVE", "REJECT", "UPDATE", "DELETE", "CREATE")
FIELDS = {
    "company": "company",
    "label": "label",
    "artistId": "artist_id",
    "artist": "artist",
    "activityType": "activity_type",
    "eventName": "event_name",
    "eventStartDate": "event_start_date",
    "eventEndDate": "event_end_date",
    "cities": "cities",
    "venues": "venues",
    "primaryUrl": "primary_url",
}
MOST, NOTE_SIZE = 30, 500


def read_document(spark: SparkSession, text: str, schema_id: str | None = None) -> DataFrame:
    """place, decision (map) of a document: its last fenced JSON block, or all of it. ``schema_id`` must match where given."""
    one = spark.range(1).select(F.lit(text).alias("text"))
    fenced = F.regexp_extract_all("text", F.lit(r"(?is)```json\s*(\{.*?\})\s*```"), F.lit(1))
    raw = F.coalesce(F.try_element_at(fenced, F.lit(-1)), F.trim("text"))
    read = one.select(F.from_json(raw, "schema string, decisions array<map<string,string>>").alias("d"))
    wrong = F.col("d.decisions").isNull() | ~F.size("d.decisions").between(1, MOST) | F.exists("d.decisions", lambda x: x.isNull())
    if schema_id is not None:
        wrong = wrong | (filled("d.schema") != schema_id)
    checked = F.when(wrong, F.raise_error(F.lit("the document does not hold 1 to 30 decisions of a known schema")).cast("array<map<string,string>>")).otherwise(F.col("d.decisions"))
    return read.select(F.posexplode(checked).alias("place", "decision"))


def _said(key: str) -> Column:
    return F.trim(filled(F.try_element_at("decision", F.lit(key))))


def _sources(decisions: DataFrame, history: DataFrame, queue: DataFrame) -> DataFrame:
    """Decisions with the queued or confirmed row that they are about (source), if there is one."""
    d = decisions.select("place", "decision", F.upper(_said("action")).alias("action"), _said("candidateId").alias("candidate"), _said("eventKey").alias("target"))
    queued = queue.select(F.col("candidate_id").alias("candidate"), _whole(queue).alias("queued"))
    known = history.select(F.col("event_key").alias("target"), _whole(history).alias("known"))
    # at most MOST decisions: the small side of both joins, kept whole
    a = F.broadcast(d).filter(F.col("action").isin("APPROVE", "REJECT")).join(queued, "candidate").select("place", F.col("queued").alias("source"))
    b = F.broadcast(d).filter(F.col("action").isin("UPDATE", "DELETE")).join(known, "target").select("place", F.col("known").alias("source"))
    return d.join(a.unionByName(b), "place", "left")


def _whole(rows: DataFrame) -> Column:
    return F.struct(*[(filled(c) if c in rows.columns else F.lit("")).alias(c) for c in HISTORY])


def confirmed(sourced: DataFrame, now: str) -> DataFrame:
    """Per decision: action, candidate, target, source, and row, the confirmed event that it makes (with error, why it cannot)."""

    def field(name: str) -> Column:
        base = filled(f"source.{name}")
        keys = [k for k, v in FIELDS.items() if v == name]
        return F.when(F.map_contains_key("decision", keys[0]), _said(keys[0])).otherwise(base) if keys else base

    def iso(c: Column) -> Column:
        return F.when(c == "", None).otherwise(F.try_to_date(c, "yyyy-MM-dd"))

    put = sourced.select("*", *[field(n).alias(f"f_{n}") for n in FIELDS.values()])
    start, end_given = F.col("f_event_start_date"), F.col("f_event_end_date")
    end = F.when(end_given == "", start).otherwise(end_given)
    makes = F.col("action").isin("APPROVE", "UPDATE", "CREATE")
    first, last = iso(start), iso(end)
    error = F.coalesce(
        F.when(~F.col("action").isin(*ACTIONS), "unknown action"),
        F.when(F.col("action").isin("APPROVE", "REJECT") & F.col("source").isNull(), "no such candidate"),
        F.when(F.col("action").isin("UPDATE", "DELETE") & F.col("source").isNull(), "no such event"),
        F.when(makes & ~F.col("f_activity_type").isin(*CUES), "unknown activity"),
        F.when(makes & ((F.col("f_artist") == "") | (F.col("f_event_name") == "")), "artist and event name are needed"),
        F.when(makes & (first.isNull() | last.isNull()), "dates must be real days, with a first one"),
        F.when(makes & (last < first), "an event ends before it starts"),
        F.when(makes & (F.col("f_primary_url") != "") & ~F.col("f_primary_url").rlike("^https?://[^/?#]"), "the URL must be http or https"),
    )
    made = {
        **{n: F.col(f"f_{n}") for n in FIELDS.values()},
        "event_key": review_key(F.col("f_artist_id"), F.col("f_activity_type"), F.col("f_event_name"), first.cast("string"), F.col("f_cities")),
        "event_start_date": first.cast("string"),
        "event_end_date": last.cast("string"),
        "event_dates": F.when(last >= first, review_days(first, last)),
        "date_confidence": F.lit("MANUAL"),
        "date_source": F.lit("OWNER_REVIEW"),
        "date_conflict": F.lit("N"),
        "first_seen": F.coalesce(blank_to_null("source.first_seen"), F.lit(now)),
        "last_seen": F.lit(now),
        "status": F.lit("MANUAL_CONFIRMED"),
        "source_type": F.coalesce(blank_to_null("source.source_type"), F.when(F.col("action") == "CREATE", "MANUAL_CREATE").otherwise("MANUAL_REVIEW")),
        "official_verified": F.coalesce(blank_to_null("source.official_verified"), F.lit("N/A")),
        "score": F.coalesce(blank_to_null("source.score"), F.lit("100")),
        "supporting_article_count": F.coalesce(blank_to_null("source.supporting_article_count"), F.lit("1")),
        "approval_status": F.lit("MANUAL_CONFIRMED"),
        "reviewed_at": F.lit(now),
        "review_source": F.lit("GITHUB_OWNER_REVIEW"),
    }
    row = F.struct(*[filled(made[c] if c in made else F.col(f"source.{c}")).alias(c) for c in HISTORY])
    return put.select("place", "decision", "action", "candidate", "target", "source", error.alias("error"), F.when(makes & error.isNull(), row).alias("row"))


def _log_row(now: str) -> list[Column]:
    log = {
        "reviewed_at": F.lit(now),
        "action": F.col("action"),
        "candidate_id": F.col("candidate"),
        "event_key": F.coalesce(blank_to_null("target"), filled("source.event_key")),
        "artist": F.coalesce(blank_to_null(_said("artist")), filled("source.artist")),
        "activity_type": F.coalesce(blank_to_null(_said("activityType")), filled("source.activity_type")),
        "event_name": F.coalesce(blank_to_null(_said("eventName")), filled("source.event_name")),
        "note": F.substring(filled(F.try_element_at("decision", F.lit("note"))), 1, NOTE_SIZE),
    }
    return [log[c].alias(c) for c in REVIEW_LOG]


def _independent(checked: list[Row]) -> int:
    """How many decisions, from the first on, are about nothing that one before them has decided or made."""
    gone: set[tuple[str, str]] = set()
    for n, r in enumerate(checked):
        about = ("candidate", r["candidate"]) if r["action"] in ("APPROVE", "REJECT") else ("event", r["target"])
        if r["action"] != "CREATE" and about in gone:
            return n
        if r["error"] is not None:
            raise ValueError(f"decision {r['place'] + 1}: {r['error']}")
        gone |= {about, ("event", r["made"])} if r["made"] else {about}
    return len(checked)


def apply(decisions: DataFrame, history: DataFrame, queue: DataFrame, now: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """New history, new queue and the log of the decisions; raises ValueError before anything is made if one of them cannot be applied.

    Decisions count in the order of the document: an event that one of them makes, changes or removes
    is so for those that follow, and of two that make the same event the later one counts. Those that
    do not build on each other are applied together, so a document costs a read of the stores for each
    step of dependence, mostly one.
    """
    history, queue = history.select(*HISTORY), queue.select(*queue.columns)
    left, logs = cut(decisions), []
    while True:
        made = cut(confirmed(_sources(left, history, queue), now))
        checked = made.select("place", "action", "candidate", "target", "error", F.col("row.event_key").alias("made")).orderBy("place").collect()  # at most MOST rows
        done = _independent(checked)
        last = checked[done - 1]["place"] if done else -1
        step = made.filter(F.col("place") <= last)
        rows = step.filter(F.col("row").isNotNull()).groupBy("row.event_key").agg(F.max_by("row", "place").alias("row")).select("row.*")
        gone = [step.filter(F.col("action").isin("UPDATE", "DELETE")).select(F.col("target").alias("event_key")), rows.select("event_key")]
        history = history.join(F.broadcast(reduce(DataFrame.unionByName, gone)), "event_key", "left_anti").select(*HISTORY).unionByName(rows.select(*HISTORY))
        decided = step.filter(F.col("action").isin("APPROVE", "REJECT")).select(F.col("candidate").alias("candidate_id"))
        queue = queue.join(F.broadcast(decided), "candidate_id", "left_anti").select(*queue.columns)
        logs.append(step.select("place", *_log_row(now)))
        if done == len(checked):
            break
        left = left.filter(F.col("place") > last)
    return history, queue, reduce(DataFrame.unionByName, logs).orderBy("place").select(*REVIEW_LOG)
