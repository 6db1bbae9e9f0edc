"""Decisions in order, spans, selectors, free-form dates, walks of JSON and the entry points."""

from __future__ import annotations

import datetime as dt
import hashlib
import json
import random

import plain
import pytest
from pyspark.sql import functions as F

from tidemark import jobs, schemas
from tidemark.functions.freedates import free_date
from tidemark.operators import resolve, spans
from tidemark.plans import review
from tidemark.sources import embedded, files, selectors


def text_table(spark, columns, *rows):
    return spark.createDataFrame([tuple(r.get(c, "") for c in columns) for r in rows], schemas.text_schema(columns))


def _key(row):
    name = "".join(c for c in row["event_name"].lower() if c.isalnum())
    return hashlib.sha256("|".join([row["artist_id"], row["activity_type"], name, row["event_start_date"], ""]).encode()).hexdigest()[:24]


def test_decisions_count_in_the_order_of_the_document(spark):
    event = lambda k, n: {"event_key": k, "artist_id": "g", "artist": "a", "activity_type": "CONCERT", "event_name": n, "event_start_date": "2026-09-01"}
    history = [event("k1", "one"), event("k2", "two"), event("k3", "three"), event(_key(event("", "four")), "four")]
    queue = [event(f"q{i}", f"wait{i}") | {"candidate_id": f"c{i}"} for i in (1, 2, 3)]
    renamed, made, approved = (_key(event("", n)) for n in ("renamed", "made", "wait1"))
    new = {"action": "CREATE", "artist": "a", "artistId": "g", "activityType": "CONCERT", "eventName": "made", "eventStartDate": "2026-09-01"}
    items = [
        {"action": "UPDATE", "eventKey": "k1", "eventName": "renamed"},
        {"action": "UPDATE", "eventKey": renamed, "eventName": "again"},
        {"action": "APPROVE", "candidateId": "c1"},
        new,
        {"action": "UPDATE", "eventKey": made, "eventName": "two made"},
        {"action": "DELETE", "eventKey": approved},
        {"action": "REJECT", "candidateId": "c3"},
        {"action": "UPDATE", "eventKey": "k2", "eventName": "four"},  # takes the place of another event
        {"action": "UPDATE", "eventKey": _key(event("", "four")), "eventName": "five"},
        new,
    ]
    expected = plain.fold_decisions(items, history, queue, _key)
    tables = text_table(spark, schemas.HISTORY, *history), text_table(spark, schemas.QUEUE, *queue)
    got, left, log = review.apply_document(spark, json.dumps({"decisions": items}), *tables, "T1")
    rows = got.collect()
    assert len(rows) == len(expected[0]) and ({r["event_key"]: r["event_name"] for r in rows}, sorted(r["candidate_id"] for r in left.collect())) == expected
    assert [r["action"] for r in log.collect()] == [d["action"] for d in items]
    assert [r["event_name"] for r in log.collect()][5] == "wait1"
    for bad in ([items[0], items[0]], [{"action": "DELETE", "eventKey": "k1"}, {"action": "UPDATE", "eventKey": "k1"}], [{"action": "REJECT", "candidateId": "c1"}, {"action": "APPROVE", "candidateId": "c1"}], [items[1]]):
        with pytest.raises(ValueError):
            review.apply_document(spark, json.dumps({"decisions": bad}), *tables, "T1")


def test_spans_of_any_length(spark):
    rng = random.Random(2)
    day = lambda: dt.date(2000, 1, 1) + dt.timedelta(days=rng.randrange(3000))
    rows = [(i, rng.choice("ab"), (s := day()), s + dt.timedelta(days=rng.choice([0, 0, 1, 3, 4, 15, 16, 17, 300, 4000]))) for i in range(300)]
    rows += [(900, "a", dt.date(2004, 2, 29), None), (901, "a", None, None), (902, "a", dt.date(2004, 2, 2), dt.date(2004, 2, 1)), (903, "a", dt.date(1, 1, 1), dt.date(9999, 12, 31)), (904, None, dt.date(2004, 2, 2), None)]
    df = spark.createDataFrame(rows, "id int, k string, start date, end date")
    end = lambda r: r[3] or r[2]
    good = [r for r in rows if r[2] and r[1] and r[2] <= end(r)]
    expected = sorted((x[0], y[0]) for x in good for y in good if x[1] == y[1] and x[2] <= end(y) and y[2] <= end(x))
    assert sorted((r["l"]["id"], r["r"]["id"]) for r in spans.overlapping(df, df, ["k"]).collect()) == expected


def test_dealt_spans_are_never_broadcast(spark):
    """FINDINGS_r04 F3: a table of a few MB becomes many rows per span, which the size that Spark reads off the table does not show."""
    day = F.date_add(F.lit("2000-01-01").cast("date"), F.col("id").cast("int"))
    rows = spark.range(50).select("id", F.lit("k").alias("k"), day.alias("start"), F.date_add(day, (F.col("id") % 9).cast("int")).alias("end"))
    met = spans.overlapping(rows, rows, ["k"])
    assert met.count() > 50 and "Broadcast" not in met._jdf.queryExecution().executedPlan().toString()


NEWSROOM = """<html><body><div id="main"><ul class="news list"><li class="row"><span class="date">2026. 8. 1.</span> <a href="/news/1">First <b>piece</b></a></li>
<li class="row top"><a name="x">no link</a><a href="/news/2" title="t"></a> Second piece <script>no</script></li><li><a href="/about">About us here</a></li></ul>
<div class="post"><p><a href="/report/3">abc</a></p></div><article><a href="/news/1">Again</a></article></div><div class="row"><a href="/news/9">Outside of it</a></div></body></html>"""


def test_selectors(spark):
    pages = spark.createDataFrame([(1, "https://n.example/list", NEWSROOM), (2, None, None), (3, "https://n.example/x", "<li><a href='http://[bad'>What</a>")], "page_id long, url string, html string")
    read = lambda **s: [(r["page_id"], r["url"].rsplit("/", 1)[-1], r["title"], r["day"]) for r in selectors.items(pages, **s).orderBy("page_id", "place").collect()]
    day = dt.date(2026, 8, 1)
    # article before li, as the defaults stand; an address counts where it comes first
    assert read() == [(1, "1", "Again", None), (1, "2", "no link Second piece", None)]
    assert read(selectors=("#main li.row",)) == [(1, "1", "First piece", day), (1, "2", "no link Second piece", None)]
    assert read(selectors=("ul.news.list > li", "div[class=post]"), link="about|report", least=3) == [(1, "about", "About us here", None), (1, "3", "abc", None)]
    assert read(selectors=("div > li",)) == [] and read(selectors=('body > [class*="ro"], .none',)) == [(1, "9", "Outside of it", None)]
    for wrong in ("", "li >", "> li", "a:hover", "li,,p"):
        with pytest.raises(ValueError):
            selectors.items(pages, selectors=(wrong,))
    detail = spark.createDataFrame([("https://n.example/news/2", "<main>All <i>of it</i></main><time>2026-08-03</time>"), ("https://n.example/news/1", "<p>nothing</p>")], "url string, html string")
    made = {r["url"][-1]: (r["body"], r["day"]) for r in selectors.followed(selectors.items(pages, selectors=("li.row",)), detail).collect()}
    assert made == {"1": ("2026. 8. 1. First piece", day), "2": ("All of it", dt.date(2026, 8, 3))}


def test_days_of_pages_as_people_write_them(spark):
    pages = spark.createDataFrame([(1, "<article>x</article><time>March 5th, 2026</time>"), (2, "<main>y</main><p class=date>3일 전</p>"), (3, "<main>z</main><time>soon</time>")], "page_id long, html string")
    read = lambda **s: {r["page_id"]: r["day"] for r in selectors.details(pages, **s).collect()}
    assert read() == {1: None, 2: None, 3: None}
    assert read(now="2026-03-10 09:00:00") == {1: dt.date(2026, 3, 5), 2: dt.date(2026, 3, 7), 3: None}


def test_free_dates(spark):
    base = "2026-03-10 09:30:00"
    cases = {
        "March 5, 2026": "2026-03-05", "5th of March 2026": "2026-03-05", "Sept. 1 2025": "2025-09-01", "Tuesday, 10 March 2026 at 10:00 pm KST": "2026-03-10", "2026 Mar 7": "2026-03-07", "Mar 5": "2026-03-05", "12 Dec": "2026-12-12",
        "an hour ago": "2026-03-10", "10 hours ago": "2026-03-09", "in 2 days": "2026-03-12", "a month ago": "2026-02-10", "Day before yesterday": "2026-03-08", "20260301": "2026-03-01", "2026-03-05T10:20:30Z": "2026-03-05",
        "2026년 3월 5일 (목) 오후 7시 30분": "2026-03-05", "3월 5일": "2026-03-05", "26년 12월 1일": "2026-12-01", "3시간 전": "2026-03-10", "그저께": "2026-03-08", "2주 후": "2026-03-24", "2026.03.05.": "2026-03-05", "2개월 전": "2026-01-10",
        "令和8年3月5日": "2026-03-05", "令和元年5月1日": "2019-05-01", "２０２６年３月５日": "2026-03-05", "3月5日(木)": "2026-03-05", "昨日": "2026-03-09", "3日前": "2026-03-07", "明後日": "2026-03-12",
        "2026-02-30": None, "Smarch 5": None, "it was yesterday that": None, "": None, None: None, "5": None, "2026": None, "March": None, "99999999999999 days ago": None,
    }
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(cases)], "i int, t string")
    got = rows.select("t", free_date(F.col("t"), F.to_timestamp(F.lit(base))).cast("string").alias("d")).collect()
    assert {r["t"]: r["d"] for r in got} == cases
    one = lambda t, **s: spark.range(1).select(free_date(F.lit(t), F.to_timestamp(F.lit(base)), **s).cast("string")).first()[0]
    assert (one("5/3/2026"), one("5/3/2026", order="DMY"), one("25/3/2026"), one("3/25/26", order="DMY")) == ("2026-05-03", "2026-03-05", "2026-03-25", "2026-03-25")
    assert (one("12월 1일", prefer="past"), one("1月2日", prefer="future"), one("Mar 10", prefer="past")) == ("2025-12-01", "2027-01-02", "2026-03-10")
    with pytest.raises(ValueError):
        free_date(F.lit("x"), F.lit(None), prefer="ever")


def test_walk_of_json():
    assert embedded.walk('{"a": {"b": ["x", {"title": "t"}, 5, [{"c": "d"}]]}, "e": "f", "": "g"}') == [("title", "t"), ("c", "d"), ("e", "f")]
    assert embedded.walk("no json") is None and embedded.walk("[" * 100_000) is None and embedded.walk("5") == []
    deep = '{"k":' * 300 + '"v"' + "}" * 300
    assert embedded.walk(deep) == [("k", "v")]


def test_aliases_of_several_scripts(spark):
    names = ["Kim A", "Kim B", "Kim", "방탄소년단", "방탄", "탄", "The The", "R.E.D \\E x", "ÄÖ", "아이 유", "A-B"]
    entities = spark.createDataFrame([(str(i), "", "", n, [], False, i) for i, n in enumerate(names)], "artist_id string, company string, label string, name string, aliases array<string>, priority boolean, seq long")
    titles = ["kim a and kim b", "KIM A!", "Kimchi a", "new 방탄소년단 song", "방 탄", "탄산", "the the", "the  the", "r.e.d \\e X", "äö ÄÖ", "아이 유 live", "a-b", "a b", "xa-b", "", None]
    expected = set()
    for s, t in enumerate(titles):
        for i, n in enumerate(names):
            low, name = (t or "").lower(), n.lower()
            latin = any(c.isascii() and c.isalnum() for c in name)
            edge = lambda c: not (c.isascii() and c.isalnum())
            at = [p for p in range(len(low)) if low.startswith(name, p)]
            if (n in (t or "")) if not latin else any(edge(low[p - 1 : p]) and edge(low[p + len(name) : p + len(name) + 1]) for p in at):
                expected.add((s, str(i)))
    rows = spark.createDataFrame(list(enumerate(titles)), "seq long, title string")
    for limit in (10**6, 0):
        assert {(r["seq"], r["artist_id"]) for r in resolve.matches(rows, resolve.alias_table(entities, []), broadcast_rows=limit).collect()} == expected
    assert len(expected) > 10


def test_jobs(spark, tmp_path):
    at = lambda name: f"file://{tmp_path}/{name}"
    (tmp_path / "artists.json").write_text(json.dumps([{"artist_id": "g1", "company": "C", "label": "L", "name": "Aurora", "aliases": []}, {"artist_id": "g2", "company": "D", "label": "L", "name": "Borealis", "aliases": []}]), encoding="utf-8")
    (tmp_path / "news.json").write_text(json.dumps({"min_score": 40, "auto_publish_enabled": True}), encoding="utf-8")
    rows = [(1, "Aurora 콘서트 개최 8월 20일", "2026-07-31 07:00:00"), (2, "Aurora 팬미팅 개최 확정", "2026-07-31 06:00:00"), (3, "Borealis 콘서트 개최 9월 1일", "2026-07-31 05:00:00"), (4, "nothing", "2026-07-31 05:00:00")]
    made = spark.createDataFrame(rows, "seq long, title string, at string").select(
        "seq", F.lit("S").alias("source_id"), F.lit("NEWS").alias("source_type"), F.lit("g1").alias("searched_id"), *[F.lit(None).cast("string").alias(c) for c in ("artist_id", "artist", "company", "label")], "title", F.lit("").alias("body"),
        F.concat(F.lit("http://n/"), F.col("seq").cast("string")).alias("url"), F.lit("").alias("original_url"), F.lit("").alias("naver_url"), F.lit("n").alias("publisher"), F.lit("").alias("search_query"), F.lit(3).alias("publisher_score"),
        F.to_timestamp("at").alias("published_at"), F.to_timestamp("at").alias("fetched_at"),
    )
    made.write.parquet(at("articles"))
    stores = ["--history", at("history"), "--review-queue", at("queue"), "--review-log", at("log"), "--calendar-json", at("calendar"), "--review-json", at("pending"), "--now", "2026-07-31T08:00:00+00:00"]
    run = ["--artists", at("artists.json"), "--news-config", at("news.json"), "--articles", at("articles"), "--out", at("sheets")]
    done = jobs.main(["daily", *run, "--company", "C", "--daily-history", at("all"), *stores], spark)
    assert done["events"] == 2 and done["confirmed"] + done["pending"] == 2
    history, queue = files.history(spark, at("history")), files.queue(spark, at("queue"))
    assert (history.count(), queue.count()) == (done["confirmed"], done["pending"]) and spark.read.parquet(at("all")).count() == 2
    assert json.loads(spark.read.text(at("calendar")).first()[0])["pendingCount"] == done["pending"]
    again = jobs.main(["backfill", *run, "--publish-review-queue", "--days-back", "30", *stores], spark)
    assert again["candidates"] >= 1 and again["pending"] >= done["pending"]
    waiting = files.queue(spark, at("queue")).orderBy("candidate_id").first()["candidate_id"]
    (tmp_path / "doc.txt").write_text(json.dumps({"schema": "s1", "decisions": [{"action": "REJECT", "candidateId": waiting}]}), encoding="utf-8")
    last = jobs.main(["review", "--document", at("doc.txt"), "--schema-id", "s1", *stores], spark)
    assert last["applied"] == 1 and last["pending"] == again["pending"] - 1 and files.review_log(spark, at("log")).count() == 1
    with pytest.raises(ValueError):
        jobs.main(["daily", *[a for a in run if a not in ("--articles", at("articles"))], *stores], spark)
    with pytest.raises(SystemExit):
        jobs.main(["daily"], spark)
