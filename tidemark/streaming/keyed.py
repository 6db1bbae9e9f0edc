"""The stores as keyed state: a batch of events reads and writes the rows of its own entities only.

Each store is a map in the state of its key (history: entity and activity; queue: entity), kept by
Spark's state store and checkpointed with the stream, so it survives lost executors and restarts. What
leaves the operator are the rows that a batch has changed; ``upsert`` appends them to a log of
changes, and ``latest`` is the last row of each key in it. A stream may start from stores that exist
(``initial``), and rows that no event has touched for a given time may expire.

Events of one key are taken in the order of seq within a batch; batches must come in order.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..operators import state
from ..schemas import HISTORY, QUEUE, text_schema

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_FIELDS = [c for c in HISTORY if c not in ("event_key", "first_seen", "last_seen", "primary_url", "official_verified", "supporting_article_count", "related_urls", "approval_status", "reviewed_at", "review_source")]


def _text(value: object) -> str:
    """A stored field; nulls are empty."""
    return value if isinstance(value, str) else ""


def merged(old: dict | None, key: str, events: list[dict], now: str) -> dict:
    """A row of the history after events of one run, in order; old is None for a new one. As ``state.upsert_history`` has it."""
    was = old or {}
    best = max(e["score_number"] for e in events)
    if old and (was["approval_status"] == "MANUAL_CONFIRMED" or (was["official_verified"] == "Y" and not any(e["official"] for e in events))):
        number = int(was["score"]) if was["score"].lstrip("+-").isdigit() else 0
        return was | {"last_seen": now, "score": str(max(number, best))}
    urls = [u for e in events for u in e["urls"]]
    kept = list(dict.fromkeys(u for u in [was.get("primary_url", ""), *was.get("related_urls", "").split("|"), *urls] if u))
    primary = was.get("primary_url") or urls[0]
    made = {c: _text(events[-1][c]) for c in _FIELDS}
    made |= {
        "event_key": key,
        "first_seen": was.get("first_seen") or now,
        "last_seen": now,
        "primary_url": primary,
        "official_verified": "N/A",
        "supporting_article_count": str(max(len(kept), 1)),
        "related_urls": "|".join(u for u in kept if u != primary),
        "approval_status": was.get("approval_status") or "AUTO_CONFIRMED",
        "reviewed_at": was.get("reviewed_at", ""),
        "review_source": was.get("review_source", ""),
    }
    return made


def folded(rows: dict[str, dict], events: list[dict]) -> dict[str, dict]:
    """The rows that events of one (entity, activity) change or make; rows: event_key -> row of the history."""
    place = lambda r: "|".join([r["event_start_date"] or r["event_dates"] or "9999-99-99", r["company"], r["artist"], r["event_key"]])
    fixed = lambda r: r["approval_status"] == "MANUAL_CONFIRMED" or r["official_verified"] == "Y"
    known = {r["event_key"]: (r["event_start_date"] or r["event_dates"].split("|")[0], r["event_name"].lower(), fixed(r)) for r in sorted(rows.values(), key=place)}
    events = sorted(events, key=lambda e: e["seq"])
    to = dict(state.match_in_order(known, [(e["seq"], e["event_key"], e["start"], e["first_day"], e["name"], e["event_key"] in rows) for e in events]))
    own: dict[str, list[dict]] = {}
    for e in events:
        own.setdefault(to[e["seq"]], []).append(e)
    return {key: merged(rows.get(key), key, es, es[-1]["now"]) for key, es in own.items()}


def queued(rows: dict[str, dict], events: list[dict]) -> dict[str, dict]:
    """The rows that events of one entity change or make; rows: candidate_id -> row of the queue. As ``state.upsert_queue`` has it."""
    by_event: dict[str, str] = {}
    for i, r in rows.items():
        if r["event_key"]:
            by_event[r["event_key"]] = max(i, by_event.get(r["event_key"], ""))
    first: dict[str, str] = {}
    out: dict[str, dict] = {}
    for e in sorted(events, key=lambda e: e["seq"]):
        known = e["candidate_id"] if e["candidate_id"] in rows else by_event.get(e["event_key"])
        began = first.setdefault(e["event_key"], known or e["candidate_id"])
        i = known or began
        seen = rows[i]["first_seen"] if i in rows else ""
        out[i] = {c: _text(e[c]) for c in QUEUE} | {"candidate_id": i, "first_seen": seen or _text(e["first_seen"])}
    return out


class _Store(StatefulProcessor):
    """A map of stored rows per key, and a fold of a batch's events into it."""

    columns: tuple[str, ...]
    own: str

    def __init__(self, ttl_ms: int | None = None) -> None:
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        # a row as one text: each read and write of a state goes field by field between Python and the JVM
        self.rows = handle.getMapState("rows", "own string", "fields string", self.ttl_ms)

    def put(self, own: str, values: tuple[str, ...]) -> None:
        self.rows.updateValue((own,), (json.dumps(values),))

    def fold(self, rows: dict[str, dict], events: list[dict]) -> dict[str, dict]:
        raise NotImplementedError

    def handleInitialState(self, key: tuple, initialState: Row, timerValues: object) -> None:
        self.put(_text(initialState[self.own]), tuple(_text(initialState[c]) for c in self.columns))

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues: object) -> Iterator[Row]:
        events = [row.asDict() for row in rows]
        known = {k[0]: dict(zip(self.columns, json.loads(v[0]))) for k, v in self.rows.iterator()}
        changed = self.fold(known, events)
        for k, row in changed.items():
            values = tuple(row[c] for c in self.columns)
            self.put(k, values)
            yield Row(**dict(zip(self.columns, values)))

    def close(self) -> None:
        pass


class History(_Store):
    columns, own = HISTORY, "event_key"

    def fold(self, rows: dict[str, dict], events: list[dict]) -> dict[str, dict]:
        return folded(rows, events)


class Queue(_Store):
    columns, own = QUEUE, "candidate_id"

    def fold(self, rows: dict[str, dict], events: list[dict]) -> dict[str, dict]:
        return queued(rows, events)


def _changes(rows: DataFrame, keys: list[str], store: _Store, initial: DataFrame | None) -> DataFrame:
    rows.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)
    first = initial.select(*[F.coalesce(c, F.lit("")).alias(c) for c in store.columns]).groupBy(*keys) if initial is not None else None
    mode = "ProcessingTime" if store.ttl_ms else "None"
    # rows, not frames: most keys have few rows in a batch, and a frame for each of them costs more than its rows
    return rows.groupBy(*keys).transformWithState(store, text_schema(store.columns), "Update", mode, first)


def history_changes(events: DataFrame, *, initial: DataFrame | None = None, ttl_ms: int | None = None) -> DataFrame:
    """Rows of the history as each batch of keyed events changes or makes them. events: as ``state.keyed``, with seq and now (text)."""
    rows = events.select("seq", "now", *state.match_fields(), *state.stored_fields(), F.col("score").cast("int").alias("score_number"), state.officially(events).alias("official"), state.addresses().alias("urls"))
    return _changes(rows, ["artist_id", "activity_type"], History(ttl_ms), initial)


def queue_changes(events: DataFrame, log: DataFrame, *, initial: DataFrame | None = None, ttl_ms: int | None = None) -> DataFrame:
    """Rows of the review queue as each batch of keyed events changes or makes them; those that the log rejects are left out."""
    rows = state.without_rejected(state.review_rows(events, F.col("now")), log)
    return _changes(rows, ["artist_id"], Queue(ttl_ms), initial)


def upsert(changes: DataFrame, base: str) -> DataStreamWriter:
    """A stream writer that appends each batch's changed rows to a log under base; a batch that is run again replaces its own part."""

    def put(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{base}/batch={number}")

    return changes.writeStream.outputMode("update").foreachBatch(put).option("checkpointLocation", f"{base}/_checkpoint")


def latest(spark: SparkSession, base: str, columns: tuple[str, ...], key: str) -> DataFrame:
    """The last row of each key in a log of changes; no row is read twice."""
    batches = spark.read.schema(text_schema(columns).add("batch", "long")).option("basePath", base).parquet(base)
    last = batches.groupBy(key).agg(F.max_by(F.struct(*columns), "batch").alias("it"))
    return last.select("it.*")
