"""Streams over small files, run until they are drained."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Row
from pyspark.sql import functions as F

from tidemark import catalogue, schemas
from tidemark.operators import state
from tidemark.streaming import incremental, keyed

ARTICLE = "artist_id string, original_url string, url string, title string, published_at timestamp, activity_type string, score int"


def _feed(spark, tmp_path, *batches):
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, ARTICLE).coalesce(1).write.mode("append").json(f"file://{tmp_path}/in/{i}")
    return spark.readStream.schema(ARTICLE).option("maxFilesPerTrigger", 1).json(f"file://{tmp_path}/in/*")


def _drain(writer):
    q = writer.trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert q.exception() is None


def test_deduplicated_and_counted(spark, tmp_path):
    at = dt.datetime(2026, 7, 1)
    a = ("g", "", "http://n/1?utm_source=x", "t", at, "CONCERT", 5)
    b = ("g", "", "http://n/1", "t", at + dt.timedelta(hours=1), "CONCERT", 9)
    c = ("g", "", "http://n/2", "t", at + dt.timedelta(hours=2), "POPUP", 7)
    stream = _feed(spark, tmp_path, [a], [b, c])
    _drain(incremental.deduplicated(stream).writeStream.format("memory").queryName("kept").option("checkpointLocation", f"file://{tmp_path}/c1"))
    assert sorted(r["activity_type"] for r in spark.table("kept").collect()) == ["CONCERT", "POPUP"]
    _drain(incremental.activity_counts(stream).writeStream.outputMode("complete").format("memory").queryName("counted").option("checkpointLocation", f"file://{tmp_path}/c2"))
    assert {r["activity_type"]: (r["n"], r["best"]) for r in spark.table("counted").collect()} == {"CONCERT": (2, 9), "POPUP": (1, 7)}


def test_stores_are_upserted_per_batch(spark, tmp_path):
    at = dt.datetime(2026, 7, 1)
    stream = _feed(spark, tmp_path, [("g", "", "http://n/1", "first", at, "CONCERT", 5)], [("g", "", "http://n/1", "first", at, "CONCERT", 8), ("h", "", "http://n/2", "second", at, "POPUP", 7)])
    none, base = F.array().cast("array<string>"), f"file://{tmp_path}/stores"

    def prepare(batch):
        seq = batch.withColumn("seq", F.monotonically_increasing_id())
        fixed = {"artist": "", "company": "", "label": "", "event_name": "", "date_confidence": "NONE", "date_evidence": "", "date_source": "", "schedule_status": "NEW_EVENT", "source_type": "NEWS", "naver_url": "", "clipped_text": "", "review_reason": ""}
        made = seq.withColumns({k: F.lit(v) for k, v in fixed.items()} | {"event_dates": F.array().cast("array<date>"), "event_start_date": F.lit(None).cast("date"), "event_end_date": F.lit(None).cast("date")})
        rest = {"date_conflict": F.lit(False), "cities": none, "venues": none, "related_urls": none, "supporting_article_count": F.lit(1), "validation_status": F.when(F.col("activity_type") == "POPUP", "AUTO_SELECTED").otherwise("REVIEW_REQUIRED")}
        return state.keyed(made.withColumns(rest))

    log = spark.createDataFrame([], schemas.text_schema(schemas.REVIEW_LOG))
    _drain(incremental.upsert_stores(stream, base, log, lambda n: f"T{n}", prepare))
    queue = incremental.latest(spark, f"{base}/queue", schemas.QUEUE).collect()
    assert [(r["event_name"], r["score"]) for r in queue] in ([("first", "5")], [("first", "8")]) and queue[0]["first_seen"] <= queue[0]["last_seen"]
    assert [r["event_name"] for r in incremental.latest(spark, f"{base}/history", schemas.HISTORY).collect()] == ["second"]


def _slices(spark, names):
    """Events of few entities in three runs, with names that differ by some letters, rows confirmed by hand and events without a day."""
    base = catalogue.stream_events(spark, "/root/testdata/sf0.001").withColumns({"artist_id": F.pmod(F.col("seq"), F.lit(4)).cast("string"), "activity_type": F.lit("CONCERT")})
    varied = F.concat(F.element_at(F.array(*[F.lit(n) for n in names]), (F.pmod(F.xxhash64("seq"), F.lit(len(names))) + 1).cast("int")), F.lit(" "), F.substring(F.md5(F.col("seq").cast("string")), 1, 4))
    day = F.when(F.col("seq") % 5 > 0, F.col("event_start_date"))
    made = base.filter("seq < 240").withColumns({"event_name": varied, "title": varied, "event_start_date": day, "event_end_date": day, "official_verified": F.col("seq") % 3 == 0, "now": F.concat(F.lit("T"), (F.floor(F.col("seq") / 80) + 1).cast("string"))})
    return state.keyed(made)


def test_history_as_keyed_state_is_the_batch_upsert(spark, tmp_path):
    events = _slices(spark, ["summer tour seoul", "winter fan party", "pop up store"]).cache()
    first = events.filter("now = 'T1'")
    seeded = state.upsert_history(spark.createDataFrame([], schemas.text_schema(schemas.HISTORY)), first, "T1").withColumns(
        {"approval_status": F.when(F.substring("event_key", 1, 1) < "4", "MANUAL_CONFIRMED").otherwise(F.col("approval_status")), "official_verified": F.when(F.substring("event_key", 1, 1) > "b", "Y").otherwise(F.col("official_verified"))}
    )
    seeded = spark.createDataFrame(seeded.collect(), seeded.schema)
    expected = seeded
    (tmp_path / "in").mkdir()
    source = spark.readStream.schema(events.schema).option("recursiveFileLookup", "true").parquet(f"file://{tmp_path}/in")
    changes = keyed.history_changes(source, initial=seeded)
    for now in ("T2", "T3"):
        own = events.filter(F.col("now") == now)
        expected = state.upsert_history(expected, own, now)
        expected = spark.createDataFrame(expected.collect(), expected.schema)
        own.write.parquet(f"file://{tmp_path}/in/{now}")
        _drain(keyed.upsert(changes, f"file://{tmp_path}/out"))
    made = {r["event_key"]: r for r in keyed.latest(spark, f"file://{tmp_path}/out", schemas.HISTORY, "event_key").collect()}
    known = {r["event_key"]: r for r in expected.collect()}
    touched = {k: r for k, r in known.items() if r["last_seen"] != "T1"}
    assert 10 < len(touched) < len(known) and made == touched
    # a batch of one entity writes rows of that entity only
    own = events.filter("now = 'T3' AND artist_id = '2'").withColumn("now", F.lit("T4"))
    own.write.parquet(f"file://{tmp_path}/in/T4")
    _drain(keyed.upsert(changes, f"file://{tmp_path}/out"))
    assert {r["artist_id"] for r in keyed.latest(spark, f"file://{tmp_path}/out", schemas.HISTORY, "event_key").filter("last_seen = 'T4'").collect()} == {"2"}


def test_queue_as_keyed_state_is_the_batch_upsert(spark, tmp_path):
    events = _slices(spark, ["a", "b"]).withColumns({"event_name": F.lit("one"), "title": F.lit("one"), "url": F.concat(F.lit("http://n/"), F.pmod(F.xxhash64("seq"), F.lit(60)).cast("string"))})
    events = state.keyed(events).cache()
    rejected = events.filter("seq % 11 = 0").select("candidate_id").distinct()
    log = rejected.select(*[(F.lit("REJECT") if c == "action" else F.col(c) if c == "candidate_id" else F.lit("")).alias(c) for c in schemas.REVIEW_LOG])
    expected = spark.createDataFrame([], schemas.text_schema(schemas.QUEUE))
    (tmp_path / "in").mkdir()
    changes = keyed.queue_changes(spark.readStream.schema(events.schema).option("recursiveFileLookup", "true").parquet(f"file://{tmp_path}/in"), log)
    for now in ("T1", "T2", "T3"):
        own = events.filter(F.col("now") == now)
        expected = state.upsert_queue(expected, own, log, now)
        expected = spark.createDataFrame(expected.collect(), expected.schema)
        own.write.parquet(f"file://{tmp_path}/in/{now}")
        _drain(keyed.upsert(changes, f"file://{tmp_path}/out"))
    made = {r["candidate_id"]: r for r in keyed.latest(spark, f"file://{tmp_path}/out", schemas.QUEUE, "candidate_id").collect()}
    assert len(made) > 10 and made == {r["candidate_id"]: r for r in expected.collect()}


def test_state_takes_rows_and_keeps_each_as_one_text():
    """FINDINGS_r04 F6 and F8: no frame per key, and one field per stored row goes between Python and the state."""

    class Kept(dict):
        def updateValue(self, key, value):  # noqa: N802
            self[key] = value

        def iterator(self):
            return iter(self.items())

    def event(seq, now):
        fields = {c: "" for c in keyed._FIELDS} | {"event_name": "Ünïted | \"tour\"", "score": str(seq)}
        return Row(**fields, seq=seq, now=now, event_key="k", start="2026-08-01", first_day="2026-08-01", name="a", score_number=seq, official=None, urls=[f"http://n/{seq}"])

    store = keyed.History()
    store.rows = Kept()
    made = [row for n in (1, 2) for row in store.handleInputRows(("g", "CONCERT"), iter([event(n, f"T{n}")]), None)]
    assert [(r["first_seen"], r["last_seen"], r["score"], r["related_urls"]) for r in made] == [("T1", "T1", "1", ""), ("T1", "T2", "2", "http://n/2")]
    assert made[1]["event_name"] == "Ünïted | \"tour\"" and [len(v) for v in store.rows.values()] == [1]
    again = keyed.History()
    again.rows = Kept()
    again.handleInitialState(("g", "CONCERT"), made[1], None)
    assert again.rows == store.rows
