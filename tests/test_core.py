"""Operators on articles, events and reviews against expected values."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions import dates, keys, names, similarity, text
from tidemark.operators import classify, cluster, decisions, enrich, extract, feeds, popup, qa, resolve, scan, schedule, state
from tidemark.plans import backfill, daily, review
from tidemark.sources import embedded, files, html, search_api, sinks

NOW = "2026-07-31 08:00:00"


def one(spark, column, **values):
    """The value of a column over one row of literals."""
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()]) if values else spark.range(1)
    return row.select(column.alias("v")).first()["v"]


def day(s):
    return dt.date.fromisoformat(s)


@pytest.mark.parametrize(
    ("url", "expected"),
    [
        ("HTTPS://Example.COM:443/a/b/?utm_source=x&b=2&a=1&fbclid=z#f", "https://example.com/a/b?a=1&b=2"),
        ("http://u:p@h.org:8080", "http://u:p@h.org:8080/"),
        ("http://h.org/x?q=a+b%20c&q=%EA%B0%80&empty", "http://h.org/x?empty=&q=a+b+c&q=%EA%B0%80"),
        ("http://h.org/x?id=1~*", "http://h.org/x?id=1~%2A"),
        ("relative/path#x", "relative/path"),
        ("http://h.org:99999/x#y", "http://h.org:99999/x"),
        ("", ""),
        (None, ""),
    ],
)
def test_canonical_url(spark, url, expected):
    assert one(spark, text.canonical_url(F.lit(url).cast("string"))) == expected


def test_text_functions(spark):
    assert one(spark, text.collapse(F.lit("  a　 b\n\tc "))) == "a b c"
    assert one(spark, text.clean_markup(F.lit("<b>A &amp; B</b>&nbsp; &lt;c&gt;"))) == "A & B <c>"
    assert one(spark, text.host(F.lit("https://WWW.News.example.com:80/x"))) == "news.example.com"
    assert one(spark, text.http_url(F.lit("ftp://x.y"))) == "" and one(spark, text.http_url(F.lit(" http://x.y/ "))) == "http://x.y/"
    for given in ("=1+1", " @x", "-3", "+4", "plain", "'=1", "'x", ""):
        safe = one(spark, text.formula_safe(F.lit(given)))
        assert safe == ("'" + given if given.strip()[:1] in tuple("=+-@") and given.strip() else given)
    assert one(spark, text.formula_restore(F.lit("'=1+1"))) == "=1+1" and one(spark, text.formula_restore(F.lit("'x"))) == "'x"
    long = "a" * 200 + " key " + "b" * 400
    clipped = one(spark, text.clip(F.lit(long), F.array(F.lit("KEY"))))
    assert clipped.startswith("… ") and clipped.endswith(" …") and "key" in clipped and len(clipped) <= 324
    found = one(spark, text.find_all(F.lit("x1y22z"), r"([a-z])(\d+)", 2))
    assert [(f["from"], f["to"], f["said"], list(f["parts"])) for f in found] == [(0, 2, "x1", ["x", "1"]), (2, 5, "y22", ["y", "22"])]


DATED = [
    ("단독 콘서트 개최 8월 10일", "", "2026-07-28", "CONCERT", "2026-08-10", "2026-08-10", "HIGH", "TITLE"),
    ("8월 10일 서울, 8월 20일 부산 콘서트 개최", "", "2026-07-28", "CONCERT", None, None, "CONFLICT", ""),
    ("31일 팬콘서트 개최", "오는 31일부터 내달 2일까지 올림픽홀에서 콘서트 개최", "2026-07-29", "CONCERT", "2026-07-31", "2026-08-02", "MEDIUM", "BODY"),
    ("9월 12일~13일 단독 콘서트 개최", "8월 1일~3일 예매", "2026-07-30", "CONCERT", "2026-09-12", "2026-09-13", "HIGH", "TITLE"),
    ("5월 22일 앨범 발매", "", "2026-07-30", "COMEBACK", "2026-05-22", "2026-05-22", "HIGH", "TITLE"),
    ("24일 컴백 확정", "", "2026-07-18", "COMEBACK", "2026-07-24", "2026-07-24", "MEDIUM", "TITLE"),
    ("3일간 콘서트 개최", "", "2026-07-31", "CONCERT", None, None, "NONE", ""),
    ("2년 만에 8월 컴백", "", "2026-07-31", "COMEBACK", None, None, "NONE", ""),
    ("1월 5일 컴백 예정", "", "2026-11-02", "COMEBACK", "2027-01-05", "2027-01-05", "HIGH", "TITLE"),
    ("2026.12.31 팬미팅 개최", "", "2026-07-31", "FANMEETING", "2026-12-31", "2026-12-31", "HIGH", "TITLE"),
    ("12월 30일~1월 2일 팝업스토어 오픈", "", "2026-07-31", "POPUP", "2026-12-30", "2027-01-02", "HIGH", "TITLE"),

]


def test_event_dates(spark):
    rows = [(i, t, b, a, dt.datetime.fromisoformat(p), "가수", "가수") for i, (t, b, p, a, *_) in enumerate(DATED)]
    articles = spark.createDataFrame(rows, "seq long, title string, body string, activity_type string, published_at timestamp, artist string, matched_artist_alias string")
    got = {r["seq"]: (r["event_start_date"] and str(r["event_start_date"]), r["event_end_date"] and str(r["event_end_date"]), r["date_confidence"], r["date_source"]) for r in extract.event_fields(articles.withColumn("fetched_at", F.col("published_at"))).collect()}
    assert got == {i: expected for i, (_, _, _, _, *e) in enumerate(DATED) for expected in [tuple(e)]}


@pytest.mark.parametrize(
    ("title", "activity", "expected"),
    [
        ("가수, 정규 2집 'BLUE' 발매 확정", "COMEBACK", "BLUE"),
        ("가수, 정규 2집 BLUE SKY 발매", "COMEBACK", "BLUE"),
        ("가수 월드투어 'ORBIT' 개최", "TOUR_ANNOUNCEMENT", "ORBIT"),
        ("가수 'ORBIT' 콘서트 개최", "CONCERT", "ORBIT"),
        ("가수 2026 MOON WORLD TOUR 개최", "TOUR_ANNOUNCEMENT", "가수 2026 MOON WORLD TOUR"),
        ("가수 팬콘서트서 신곡 '별' 무대", "CONCERT", "가수 팬콘서트"),
        ("가수 컴백 발표", "COMEBACK", "가수 컴백"),
    ],
)
def test_event_names(spark, title, activity, expected):
    assert one(spark, names.event_name(F.lit(title), F.lit(activity), F.lit("가수"), F.lit("가수"))) == expected


def test_cities_and_venues(spark):
    assert one(spark, names.cities(F.lit("Seoul 과 도쿄, in LA tonight"))) == ["도쿄", "로스앤젤레스", "서울"]
    assert one(spark, names.venues(F.lit("8월 1일부터 3일까지 서울 KSPO DOME에서 개최"))) == ["KSPO DOME"]


def test_notices_work_out_their_text_once(spark):
    """FINDINGS_r04 F5: not once for every place, article or word that is looked for in it."""
    text = F.reverse(F.reverse(F.col("body")))
    told = spark.createDataFrame([("Osaka, then Tokyo: cap and cushion. Period: May 3 ~ 5, 2026, reservation",)], "body string").select(popup.location(F.lit(""), text).alias("l"), popup.item_count(text).alias("n"), popup.ranked_periods(F.lit(""), text).alias("p"))
    plan = told._jdf.queryExecution().analyzed().toString()
    assert plan.count("reverse(reverse(") <= 3 and plan.count("lower(") <= 10
    row = told.first()
    assert (row["l"]["country"], row["l"]["place"], row["n"]) == ("일본", "오사카", 2)
    assert [(p["score"], str(p["start"]), str(p["end"])) for p in row["p"]][0] == (-5, "2026-05-03", "2026-05-05")


def test_real_dates(spark):
    """The calendar's days and nothing else, by arithmetic, as parsing them has it."""
    parts = [("y", "0 1 1900 2000 2023 2024 9999 10000"), ("m", "0 1 02 4 12 13"), ("d", "0 1 28 29 30 31 32")]
    grid = spark.range(1).select()
    for name, values in parts:
        grid = grid.crossJoin(spark.createDataFrame([(v,) for v in [None, *values.split()]], f"{name} string"))
    parsed = F.try_to_date(F.format_string("%04d-%02d-%02d", *[F.col(n).cast("int") for n, _ in parts]), "yyyy-MM-dd")
    made = grid.select(parsed.alias("old"), dates.real_date(*[F.col(n) for n, _ in parts]).alias("new"))
    assert made.filter("old IS NOT NULL").count() > 60 and made.filter("NOT (old <=> new)").count() == 0


def test_cities_work_out_their_text_once(spark):
    """FINDINGS_r04 F4: not once for every name that is looked for in it."""
    said = spark.createDataFrame([("SEOUL and",), (None,)], "said string").select(names.cities(F.reverse(F.reverse(F.concat("said", F.lit(" Tokyo"))))).alias("c"))
    assert said._jdf.queryExecution().analyzed().toString().count("reverse(reverse(") == 1
    assert [r["c"] for r in said.collect()] == [["도쿄", "서울"], []]


def test_classification(spark):
    assert one(spark, classify.classified(F.lit("월드투어 추가 공연"))["activity"]) == "ADDITIONAL_SHOW"
    r = one(spark, classify.classified(F.lit("WORLD TOUR concert 콘서트 개최")))
    assert (r["activity"], r["score"], list(r["keywords"])) == ("CONCERT", 56, ["concert", "world tour", "콘서트 개최"])
    assert one(spark, classify.classified(F.lit(None).cast("string"))["activity"]) == "OTHER"
    cases = {
        ("콘서트 취소", "CONCERT"): "취소·중단·건강 이슈",
        ("월드투어 성료", "TOUR_ANNOUNCEMENT"): "종료·성료·과거 실적 기사",
        ("콘서트 개최 발표", "CONCERT"): "",
        ("콘서트 이야기", "CONCERT"): "개최·운영 신규 문구 없음",
        ("아무 말", "OTHER"): "제목에 대상 활동 키워드 없음",
        ("컴백 효과에 주가 상승", "COMEBACK"): "실적·주가·흥행 효과 등 일정 비핵심 기사",
        ("컴백 티저", "COMEBACK"): "티저·인터뷰·차트 등 후속 콘텐츠",
    }
    for (title, activity), reason in cases.items():
        assert one(spark, classify.rejection(F.lit(title), F.lit(activity))) == reason, title


ENTITIES = [
    ("g1", "C", "L", "Blue (블루)", ["BLU"], False, 0),
    ("g2", "C", "L", "Bluebird", [], False, 1),
    ("s1", "D", "L", "Blue Kim", ["블루 킴"], True, 2),
    ("x1", "D", "L", "V", [], True, 3),
]


def entities(spark):
    return spark.createDataFrame(ENTITIES, "artist_id string, company string, label string, name string, aliases array<string>, priority boolean, seq long")


@pytest.mark.parametrize("limit", [200_000, 0])
def test_resolution(spark, limit):
    titles = [(1, "BLUE 컴백"), (2, "Bluebird 콘서트"), (3, "Blue Kim of Blue 발표"), (4, "오늘블루컴백"), (5, "V 컴백"), (6, "snublue x"), (7, None), (8, ""), (9, "블루 킴 콘서트")]
    articles = spark.createDataFrame(titles, "seq long, title string").withColumn("artist_id", F.lit("q"))
    aliases = resolve.alias_table(entities(spark), ["v"])
    got = {r["seq"]: (r["artist_id"], r["matched_artist_alias"]) for r in resolve.resolve(articles, aliases, broadcast_rows=limit).collect()}
    assert got == {1: ("g1", "Blue"), 2: ("g2", "Bluebird"), 3: ("s1", "Blue Kim"), 4: ("g1", "블루"), 5: (None, None), 6: (None, None), 7: (None, None), 8: (None, None), 9: ("s1", "블루 킴")}
    named = {r["artist_id"]: r["search_name"] for r in resolve.search_name(entities(spark), ["v"], {"g2": "BB"}).collect()}
    assert named == {"g1": "Blue", "g2": "BB", "s1": "블루 킴", "x1": "V"}
    assert resolve.queries_of(entities(spark), [], suffixes=("a", "b")).count() == 8


EVENT = "seq long, artist_id string, artist string, matched_artist_alias string, activity_type string, title string, event_name string, event_dates array<date>, event_start_date date, event_end_date date, event_is_range boolean, date_confidence string, date_evidence string, date_source string, date_conflict boolean, cities array<string>, venues array<string>, score int, publisher_score int, published_at timestamp, url string, original_url string, related_urls array<string>, supporting_article_count int, company string, label string, review_reason string, validation_status string, schedule_status string, source_type string, naver_url string, clipped_text string"


def event(seq, title, name, start=None, end=None, cities=(), score=60, **more):
    e = end or start
    r = dict(
        seq=seq, artist_id="g1", artist="가수", matched_artist_alias="가수", activity_type="CONCERT", title=title, event_name=name,
        event_dates=[day(start) + dt.timedelta(n) for n in range((day(e) - day(start)).days + 1)] if start else [],
        event_start_date=day(start) if start else None, event_end_date=day(e) if start else None, event_is_range=bool(end), date_confidence="HIGH" if start else "NONE",
        date_evidence="", date_source="TITLE" if start else "", date_conflict=False, cities=list(cities), venues=[], score=score, publisher_score=3,
        published_at=dt.datetime(2026, 7, 30), url=f"http://n/{seq}", original_url=None, related_urls=[], supporting_article_count=1, company="C", label="L",
        review_reason="", validation_status="AUTO_SELECTED", schedule_status="NEW_EVENT", source_type="NEWS", naver_url="", clipped_text="",
    )
    return {**r, **more}


def events(spark, *rows):
    order = [c.split()[0] for c in EVENT.split(", ")]
    return spark.createDataFrame([tuple(r[c] for c in order) for r in rows], EVENT)


def test_schedule(spark):
    history = spark.createDataFrame([("k1", "g1", "TOUR_ANNOUNCEMENT", "Orbit World", "2026-08-01|2026-08-02", "서울")], "event_key string, artist_id string, activity_type string, event_name string, event_dates string, cities string")
    new = events(
        spark,
        event(1, "t", "Orbit World", "2026-08-01", cities=["서울"]),
        event(2, "t", "Orbit World", "2026-08-05", cities=["서울"]),
        event(3, "t", "Orbit World", "2026-08-05", cities=["부산"]),
        event(4, "t", "Orbit World", "2026-08-05"),
        event(5, "t", "다른 이름 전혀", "2026-08-05"),
        event(6, "추가 공연 확정", "Orbit World", "2026-08-01"),
    )
    got = {r["seq"]: (r["schedule_status"], r["activity_type"], r["score"], list(r["previous_event_keys"])) for r in schedule.assess(new, history).collect()}
    assert got == {
        1: ("EXISTING_SCHEDULE", "CONCERT", 60, ["k1"]),
        2: ("SAME_CITY_NEW_DATE", "ADDITIONAL_SHOW", 75, ["k1"]),
        3: ("NEW_CITY", "TOUR_EXPANSION", 72, ["k1"]),
        4: ("NEW_DATE_REVIEW", "CONCERT", 66, ["k1"]),
        5: ("NEW_EVENT", "CONCERT", 60, []),
        6: ("EXPLICIT_ADDITIONAL_SHOW", "ADDITIONAL_SHOW", 60, ["k1"]),
    }


def test_corroboration_and_validation(spark):
    news = events(spark, event(1, "t", "Orbit", "2026-08-01"), event(2, "t", "Nothing alike", "2026-09-01"))
    official = events(spark, event(9, "t", "Other", "2026-08-01"))
    got = {r["seq"]: (r["official_verified"], r["score"]) for r in schedule.corroborate(news, official).collect()}
    assert got == {1: (True, 85), 2: (False, 60)}
    status = {r["seq"]: (r["validation_status"], r["review_reason"]) for r in schedule.validation(events(spark, event(1, "t", "n", "2026-08-01", score=70), event(2, "t", "n"), event(3, "t", "n", "2026-08-01", score=60)), publish=True).collect()}
    assert status == {1: ("AUTO_SELECTED", ""), 2: ("REVIEW_REQUIRED", "DATE_NOT_FOUND"), 3: ("REVIEW_REQUIRED", "MANUAL_APPROVAL_REQUIRED")}


def test_clusters(spark):
    rows = events(
        spark,
        event(1, "가수 푸른밤 콘서트", "푸른밤하늘", "2026-08-01"),
        event(2, "가수 푸른밤 공연 개최", "푸른밤하늘", "2026-08-01", "2026-08-02", cities=["서울"], score=90),
        event(3, "가수 푸른밤", "푸른밤하늘", "2026-12-01"),
        event(4, "가수 전혀다른행사", "전혀다른행사", "2026-08-01"),
        event(5, "가수 콘서트", "콘서트"),
        event(6, "가수 콘서트", "콘서트"),
        event(7, "가수 푸른밤", "푸른밤하늘", activity_type="FANMEETING"),
    )
    assigned = {r["seq"]: r["cluster"] for r in cluster.assign(rows).collect()}
    assert assigned == {1: 2, 2: 2, 3: 3, 4: 4, 5: 5, 6: 6, 7: 7}
    best = next(r for r in cluster.cluster_events(rows).collect() if r["seq"] == 2)
    assert (best["supporting_article_count"], list(best["related_urls"]), list(best["cities"]), str(best["event_end_date"])) == (2, ["http://n/1"], ["서울"], "2026-08-02")


def test_days_of_equal_quality_are_those_of_the_representative(spark):
    """FINDINGS_r04 F7: the later article of the same score, not the one with the least number; an article whose days conflict lends none."""
    later, latest = dt.datetime(2026, 7, 31), dt.datetime(2026, 8, 1)
    rows = events(spark, event(1, "t", "a", "2026-08-01"), event(2, "t", "a", "2026-08-05", published_at=later), event(3, "t", "a", "2026-08-09", published_at=latest, date_conflict=True))
    given = rows.select("seq", F.lit(1).cast("long").alias("cluster"), F.lit("").alias("cluster_rank"))
    got = {n: cluster.roll_up(rows.filter(f"seq <= {n}"), given).first() for n in (2, 3)}
    assert {n: (r["seq"], str(r["event_start_date"])) for n, r in got.items()} == {2: (2, "2026-08-05"), 3: (3, "2026-08-05")}


def test_enrichment(spark):
    asked = events(spark, event(1, "t", "푸른밤하늘"), event(2, "t", "붉은노을빛")).withColumn("cluster_rank", F.lpad(F.col("seq").cast("string"), 3, "0"))
    hits = events(
        spark,
        event(11, "t", "푸른밤하늘", "2026-08-01", cities=["서울"]),
        event(12, "t", "푸른밤하늘", "2026-08-01"),
        event(13, "t", "푸른밤하늘", "2026-09-01"),
        event(14, "t", "붉은노을빛", "2026-08-01"),
        event(15, "t", "붉은노을빛", "2026-09-01"),
    )
    got = {r["seq"]: r for r in enrich.enrich(asked, hits).collect()}
    assert (str(got[1]["event_start_date"]), got[1]["date_source"], list(got[1]["cities"]), got[1]["supporting_article_count"], got[1]["review_reason"]) == ("2026-08-01", "ENRICHED_TITLE", ["서울"], 3, "DATE_ENRICHED_REVIEW")
    assert (got[2]["date_confidence"], got[2]["date_conflict"], got[2]["event_start_date"]) == ("CONFLICT", True, None)


def text_table(spark, columns, *rows):
    return spark.createDataFrame([tuple(r.get(c, "") for c in columns) for r in rows], schemas.text_schema(columns))


def test_history(spark):
    first = state.keyed(events(spark, event(1, "t", "푸른밤하늘", "2026-08-01"), event(2, "t", "푸른밤하늘2", "2026-08-01")))
    history = state.upsert_history(text_table(spark, schemas.HISTORY), first, "T1").cache()
    assert history.count() == 1  # the second is like the first and on the same day
    row = history.first()
    assert (row["event_name"], row["primary_url"], row["related_urls"], row["supporting_article_count"], row["approval_status"], row["first_seen"]) == ("푸른밤하늘2", "http://n/1", "http://n/2", "2", "AUTO_CONFIRMED", "T1")
    fixed = history.withColumn("approval_status", F.lit("MANUAL_CONFIRMED"))
    again = state.upsert_history(fixed, state.keyed(events(spark, event(5, "t", "푸른밤하늘3", "2026-08-01", score=99))), "T2").first()
    assert (again["event_name"], again["score"], again["last_seen"], again["first_seen"]) == ("푸른밤하늘2", "99", "T2", "T1")
    assert state.upsert_history(history, first.limit(0), "T3").count() == 1


def test_queue(spark):
    log = text_table(spark, schemas.REVIEW_LOG)
    new = state.keyed(events(spark, event(1, "t", "a", "2026-08-01"), event(2, "u", "b", "2026-08-02")))
    queue = state.upsert_queue(text_table(spark, schemas.QUEUE), new, log, "T1").cache()
    assert queue.count() == 2 and {r["review_status"] for r in queue.collect()} == {"PENDING"}
    moved = state.keyed(events(spark, event(1, "t", "a", "2026-08-01", url="http://n/other"), event(3, "v", "c")))
    after = {r["event_name"]: r for r in state.upsert_queue(queue, moved, log, "T2").collect()}
    before = {r["event_name"]: r for r in queue.collect()}
    assert set(after) == {"a", "b", "c"}
    assert (after["a"]["candidate_id"], after["a"]["first_seen"], after["a"]["primary_url"]) == (before["a"]["candidate_id"], "T1", "http://n/other")
    rejected = text_table(spark, schemas.REVIEW_LOG, {"action": "REJECT", "candidate_id": before["b"]["candidate_id"], "event_key": "zz"})
    assert state.upsert_queue(text_table(spark, schemas.QUEUE), new, rejected, "T1").count() == 1


def document(*items):
    return "text ```json {\"schema\": \"old\", \"decisions\": []} ``` more\n```json\n" + json.dumps({"schema": "calendar-review-v1", "decisions": list(items)}, ensure_ascii=False) + "\n```"


def test_decisions(spark):
    queue = text_table(spark, schemas.QUEUE, *[{"candidate_id": f"c{i}", "event_key": f"q{i}", "artist_id": "g1", "artist": "가수", "activity_type": "CONCERT", "event_name": f"n{i}", "event_start_date": "2026-08-01", "first_seen": "T0"} for i in (1, 2, 3)])
    history = text_table(spark, schemas.HISTORY, *[{"event_key": f"k{i}", "artist_id": "g1", "artist": "가수", "activity_type": "CONCERT", "event_name": f"h{i}", "event_start_date": "2026-09-01"} for i in (1, 2)])
    doc = document(
        {"action": "approve", "candidateId": "c1", "eventEndDate": "2026-08-03", "note": "x" * 600},
        {"action": "REJECT", "candidateId": "c2"},
        {"action": "UPDATE", "eventKey": "k1", "eventName": "renamed"},
        {"action": "DELETE", "eventKey": "k2"},
        {"action": "CREATE", "artist": "가수", "artistId": "g1", "activityType": "POPUP", "eventName": "shop", "eventStartDate": "2026-10-01", "eventEndDate": "2026-12-31", "primaryUrl": "https://a.b/c"},
    )
    new_history, new_queue, log = review.apply_document(spark, doc, history, queue, "T1", schema_id="calendar-review-v1")
    rows = {r["event_name"]: r for r in new_history.collect()}
    assert set(rows) == {"n1", "renamed", "shop"}
    assert (rows["n1"]["event_dates"], rows["n1"]["first_seen"], rows["n1"]["date_confidence"]) == ("2026-08-01|2026-08-02|2026-08-03", "T0", "MANUAL")
    assert rows["shop"]["event_dates"] == "2026-10-01|2026-12-31" and rows["renamed"]["event_key"] != "k1"
    assert rows["n1"]["event_key"] == one(spark, keys.review_key(F.lit("g1"), F.lit("CONCERT"), F.lit("n1"), F.lit("2026-08-01"), F.lit("")))
    assert [r["candidate_id"] for r in new_queue.collect()] == ["c3"]
    logged = log.collect()
    assert [r["action"] for r in logged] == ["APPROVE", "REJECT", "UPDATE", "DELETE", "CREATE"] and len(logged[0]["note"]) == 500
    for bad in (
        {"action": "APPROVE", "candidateId": "none"},
        {"action": "WAVE", "candidateId": "c1"},
        {"action": "APPROVE", "candidateId": "c1", "eventStartDate": "2026-02-30"},
        {"action": "APPROVE", "candidateId": "c1", "eventEndDate": "2026-01-01"},
        {"action": "UPDATE", "eventKey": "k1", "primaryUrl": "javascript:x"},
        {"action": "CREATE", "artist": "a", "eventName": "b", "activityType": "PARTY", "eventStartDate": "2026-01-01"},
    ):
        with pytest.raises(ValueError):
            review.apply_document(spark, document(bad), history, queue, "T1")
    with pytest.raises(ValueError):
        review.apply_document(spark, document({"action": "REJECT", "candidateId": "c1"}, {"action": "REJECT", "candidateId": "c1"}), history, queue, "T1")
    with pytest.raises(Exception, match="decisions"):
        decisions.read_document(spark, document(*[{"action": "REJECT"}] * 31)).count()


def test_feeds(spark):
    rows = [
        {"event_key": "a", "artist": "가수", "activity_type": "CONCERT", "event_name": "밤", "event_start_date": "2026-07-10", "event_end_date": "2026-07-14", "primary_url": "https://x.y/z"},
        {"event_key": "b", "artist": "가수", "activity_type": "NEW", "event_name": "가수", "event_dates": "2026-07-13|2026-07-14|2026-10-28|2026-10-29|bad"},
        {"event_key": "c", "artist": "가수", "event_name": "x", "event_start_date": "2026-08-01", "approval_status": "pending"},
        {"event_key": "d", "artist": "가수", "event_name": "x", "event_start_date": "2026-11-01"},
    ]
    history = text_table(spark, schemas.HISTORY, *rows)
    got = {r["id"]: r for r in feeds.calendar_events(history, "2026-07-28").collect()}
    assert set(got) == {"a", "b:2026-07-14", "b:2026-10-28"}
    assert (got["a"]["end"], got["a"]["title"], got["a"]["color"], got["a"]["url"]) == ("2026-07-15", "가수 · 밤", "#0f766e", "https://x.y/z")
    assert (got["b:2026-07-14"]["title"], got["b:2026-07-14"]["color"], got["b:2026-07-14"]["end"]) == ("가수 · NEW", "#64748b", None)
    queue = text_table(spark, schemas.QUEUE, {"candidate_id": "1", "event_name": "z", "primary_url": "javascript:1"}, {"candidate_id": "2", "event_name": "y", "event_start_date": "2026-08-01"})
    calendar, pending = review.documents(history, queue, "2026-07-28T08:00:00+09:00")
    doc = json.loads(calendar.first()["json"])
    assert (doc["rangeStart"], doc["rangeEndInclusive"], doc["rangeEndExclusive"], doc["eventCount"], doc["pendingCount"]) == ("2026-07-14", "2026-10-28", "2026-10-29", 3, 2)
    assert [e["start"] for e in doc["events"]] == sorted(e["start"] for e in doc["events"])
    items = json.loads(pending.first()["json"])["items"]
    assert [i["candidateId"] for i in items] == ["2", "1"] and items[1]["primaryUrl"] == ""


def test_precision_and_recall(spark):
    auto = spark.createDataFrame([("가수", "CONCERT", "밤", "2026-08-01", "서울", "k"), ("다른", "POPUP", "x", "", "", "k2")], "artist string, activity_type string, event_name string, event_dates string, cities string, event_key string")
    manual = spark.createDataFrame([("가 수", "concert", "2026-08-01", "서울"), ("셋", "POPUP", "", "")], ["아티스트", "활동 유형", "이벤트 날짜", "도시"])
    r = qa.scores(qa.compared(qa.keys(auto), qa.keys(manual))).first()
    assert tuple(r) == (2, 2, 1, 1, 1, 0.5, 0.5)
    assert tuple(qa.scores(qa.compared(qa.keys(auto.limit(0)), qa.keys(manual.limit(0)))).first()) == (0, 0, 0, 0, 0, 0.0, 0.0)


def test_popups(spark):
    rows = [
        (1, 200, "[NOTICE] BLUE POP-UP STORE N", "운영 기간: 2026.08.01 (토) ~ 08.15 장소: 더현대서울 지하 [안내] 티셔츠, 키링"),
        (2, 200, "Blue pop up in Tokyo", "Period: March 7 - March 17, 2026. Venue: Shibuya 109 [x] hoodie"),
        (3, 200, "팝업 일정 변경", ""),
        (4, 404, "팝업", ""),
        (5, 200, "팝업 안내", "내용 없음"),
    ]
    df = spark.createDataFrame(rows, "seq long, http_status int, title string, body string")
    assert {r["seq"]: r["w"] for r in df.select("seq", popup.wanted(F.col("http_status"), F.col("title")).alias("w")).collect()} == {1: "", 2: "", 3: "amends another notice", 4: "not fetched", 5: ""}
    got = {r["seq"]: r for r in popup.popup_rows(df).collect()}
    assert (str(got[1]["start_date"]), str(got[1]["end_date"]), got[1]["duration_days"], got[1]["country"], got[1]["item_count"], got[1]["title"], got[1]["verify"]) == ("2026-08-01", "2026-08-15", 15, "한국", 3, "BLUE POP-UP STORE", "")
    assert (str(got[2]["start_date"]), str(got[2]["end_date"]), got[2]["country"], got[2]["place"]) == ("2026-03-07", "2026-03-17", "일본", "Shibuya 109")
    assert got[5]["verify"].count(";") == 2 and got[5]["start_date"] is None


def test_html(spark):
    page = """<html><head><title>T</title><script>var a='<a href="/news/0">no</a>';</script></head><body><nav><a href="/news/nav">outside nav</a></nav>
    <ul><li><a href="/news/1?utm_source=x">First story</a><a href="/news/9">second link</a></li><li><a href="/about">About us</a></li><li><a href="/news/1#top">First story again</a></li>
    <li><a href="/news/2">abc</a></li><li><a href="https://o.org/post/3">Third &amp; last</a></li></ul><h1>Head  line</h1><time datetime="2026-07-01T00:00">x</time></body></html>"""
    pages = spark.createDataFrame([(1, "https://s.org/list", page), (2, None, None), (3, "https://s.org/", "<a href='http://[bad'>broken link news</a>")], "page_id long, url string, html string")
    rows = html.parsed(pages).orderBy("page_id").collect()
    assert (rows[0]["title"], rows[0]["published"], rows[1]["title"]) == ("Head line", "2026-07-01T00:00", "") and "var a" not in rows[0]["text"]
    assert [(r["url"], r["title"]) for r in html.listed(pages).orderBy("place").collect()] == [("https://s.org/news/1?utm_source=x", "First story"), ("https://o.org/post/3", "Third & last")]


def test_embedded(spark):
    nested = r"""{"a":{"title":"BLUE A POP-UP Weverse","n":[{"noticeBody":"Tokyo <b>shop</b> &amp; more\nline"},{"note":"Operating Period: 1"},{"x":"nothing"},{"title":"Weverse"}]}}"""
    page = f"<html><head><title>Weverse</title><script type='application/json'>{nested}</script><script>var q = 'popup opens on 3';</script></head><body>Weverse</body></html>"
    long = "<script>{\"body\":\"" + "ab\\\"c" * 100_000 + "\"}</script>"
    rows = [(1, "u", page), (2, "u", "<h1>Plain</h1>text"), (3, None, None), (4, "u", long), (5, "u", "<title>Weverse</title>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r for r in embedded.notices(pages).collect()}
    assert (got[1]["title"], got[1]["body"], got[1]["method"]) == ("BLUE A POP-UP", "BLUE A POP-UP Weverse Tokyo shop & more line Operating Period: 1 var q = 'popup opens on 3';", "html+script_json")
    assert (got[2]["title"], got[2]["body"], got[2]["method"]) == ("Plain", "Plain text", "html")
    assert got[3]["method"] == got[5]["method"] == "shell_only" and got[4]["body"] == 'ab"c' * 100_000
    found = embedded.notices(pages.filter("page_id IN (2, 5)")).selectExpr("*", "'[NOTICE] Found' AS search_title", "'a snippet' AS search_body")
    filled = {r["page_id"]: (r["title"], r["body"], r["method"]) for r in embedded.with_search(found).collect()}
    assert filled == {2: ("Plain", "Plain text a snippet", "html+search_append"), 5: ("Found", "Found a snippet", "shell_only+search_title+search_body")}
    assert embedded.notices(pages.limit(0)).count() == 0


def test_search_items(spark):
    items = spark.createDataFrame([(1, "g1", "q", "<b>Blue</b> &quot;x&quot;", "https://www.yna.co.kr/1", "https://p/1", "d", "Fri, 31 Jul 2026 08:00:00 +0900"), (2, "g1", "q", "t", "", "https://p/2", None, "no date")], "seq long, searched_id string, search_query string, title string, originallink string, link string, description string, pubDate string")
    r = {x["seq"]: x for x in search_api.as_articles(items, NOW).collect()}
    assert (r[1]["title"], r[1]["publisher"], r[1]["publisher_score"], r[1]["published_at"]) == ('Blue "x"', "yna.co.kr", 10, dt.datetime(2026, 7, 30, 23))
    assert (r[2]["url"], r[2]["publisher_score"], r[2]["published_at"]) == ("https://p/2", 3, None)
    with pytest.raises(Exception, match="endpoint"):
        spark.dataSource.register(search_api.SearchApi)
        spark.read.format("news_search").option("queries", "[]").load().count()


def test_stores_round_trip(spark, tmp_path):
    history = text_table(spark, schemas.HISTORY, {"event_key": "k", "event_name": '=cmd "q", x\ny', "artist": "가수"}, {"event_key": "", "event_name": "no key"})
    path = f"file://{tmp_path}/h"
    sinks.write_store(history, path, schemas.HISTORY, state.history_order())
    assert [(r["event_name"], r["artist"]) for r in files.history(spark, path).collect()] == [('=cmd "q", x\ny', "가수")]
    assert files.history(spark, f"file://{tmp_path}/none").count() == 0
    spark.createDataFrame([("k", "n")], "event_key string, event_name string").write.csv(f"file://{tmp_path}/old", header=True)
    assert files.history(spark, f"file://{tmp_path}/old").count() == 0
    sinks.append_log(text_table(spark, schemas.REVIEW_LOG, {"action": "REJECT"}), f"file://{tmp_path}/log")
    assert files.review_log(spark, f"file://{tmp_path}/log").first()["action"] == "REJECT"
    (tmp_path / "cache").mkdir()
    (tmp_path / "cache" / "a.json").write_text('{"url":"u","title":"1"}\nbroken{\n{"url":"u","title":"2"}\n')
    assert [(r["url"], r["title"]) for r in files.notice_cache(spark, f"file://{tmp_path}/cache").collect()] == [("u", "2")]
    a = spark.createDataFrame([("u", "search", "", "b")], "url string, source string, title string, body string")
    b = spark.createDataFrame([("u", "sweep", "t", ""), ("v", "sweep", "", "")], a.schema)
    assert {r["url"]: (r["source"], r["title"], r["body"]) for r in files.merged_candidates(a, b).collect()} == {"u": ("search+sweep", "t", "b"), "v": ("sweep", None, None)}
    sinks.write_workbook({"one": history, "run": sinks.parameters(spark, {"a": 1, "b": {"c": 2}})}, f"file://{tmp_path}/book")
    assert spark.read.csv(f"file://{tmp_path}/book/run", header=True).count() == 2


def test_whole_run(spark):
    rows = [
        (1, "g1", "블루 월드투어 'ORBIT' 8월 10일 서울 개최", "2026-07-31 06:00:00", "http://n/1"),
        (2, "g1", "블루 월드투어 'ORBIT' 8월 10일 개최 확정", "2026-07-31 07:00:00", "http://n/2"),
        (3, "g1", "블루 콘서트 개최 취소", "2026-07-31 07:00:00", "http://n/3"),
        (4, "g1", "다른 가수 콘서트 개최", "2026-07-31 07:00:00", "http://n/4"),
        (5, "g1", "블루 컴백 확정", "2026-07-30 02:00:00", "http://n/5"),
        (6, "g1", "블루 컴백 확정", None, "http://n/6"),
        (7, "g1", "블루 월드투어 다시 개최", "2026-07-31 07:30:00", "http://n/1?utm_source=z"),
        (8, "g1", "블루 컴백 확정", "2026-07-31 09:00:00", "http://n/8"),
    ]
    items = spark.createDataFrame(rows, "seq long, searched_id string, title string, published_at string, url string").selectExpr(
        "seq", "searched_id", "'S' source_id", "'NEWS' source_type", "cast(null as string) artist_id", "cast(null as string) artist", "cast(null as string) company", "cast(null as string) label", "cast(null as string) matched_artist_alias",
        "title", "'' body", "url", "'' original_url", "'' naver_url", "'' publisher", "3 publisher_score", "'q' search_query", "to_timestamp(published_at) published_at", f"to_timestamp('{NOW}') fetched_at",
    )
    history, queue, log = (text_table(spark, c) for c in (schemas.HISTORY, schemas.QUEUE, schemas.REVIEW_LOG))
    run = daily.collect(items, entities(spark), history, NOW, daily.Settings(publish=True, blocked=("v",)))
    assert {r["seq"]: r["reason"] for r in run.excluded.collect()} == {3: "취소·중단·건강 이슈", 4: daily.NO_ENTITY}
    f = run.figures.first()
    assert (f["received"], f["recent"], f["outside"], f["missing"], f["future"], f["selected"]) == (7, 5, 1, 1, 1, 2)
    found = daily.events(run.selected)
    assert [(r["event_name"], str(r["event_start_date"]), r["supporting_article_count"], list(r["cities"])) for r in found.collect()] == [("ORBIT", "2026-08-10", 2, ["서울"])]
    new_history, new_queue = daily.stores(found, history, queue, log, NOW)
    assert (new_history.count(), new_queue.count()) == (1, 0)
    again = daily.collect(items, entities(spark), new_history, NOW, backfill.settings(base=daily.Settings(blocked=("v",))))
    chosen = backfill.candidates(daily.events(again.selected), "2026-07-31").collect()
    assert [r["review_reason"] for r in chosen] == ["BACKFILL_DATE_HIGH_REVIEW"]  # the undated one scores too little
