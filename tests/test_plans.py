"""Settings, pages over HTTP, official sources, notices and the workbook, on small fixtures."""

from __future__ import annotations

import json
import threading
from http.server import BaseHTTPRequestHandler, HTTPServer

import pytest
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators import export
from tidemark.plans import notices, official
from tidemark.sources import fetch, html, settings, sinks


def test_settings(spark, tmp_path):
    (tmp_path / "s.json").write_text(json.dumps({"hours": 12, "min_score": 50, "publisher_scores": {"a.example": 9}, "blocked_title_aliases": ["x"], "search_name_overrides": {"k": "v"}, "max_pages": 7}), encoding="utf-8")
    found = settings.search(spark, f"file://{tmp_path}/s.json")
    assert (found.daily.hours, found.daily.least_score, found.pages, found.page_size, found.blocked, found.publishers, found.overrides) == (12, 50, 7, 100, ("x",), {"a.example": 9}, {"k": "v"})
    (tmp_path / "w.json").write_text('{"repository": "o/r", "calendar_days_back": 3}', encoding="utf-8")
    assert settings.site(spark, f"file://{tmp_path}/w.json") == settings.Site("o/r", 3, 3)


@pytest.fixture
def server():
    class Handler(BaseHTTPRequestHandler):
        def do_GET(self):
            known = {"/list": '<ul><li><a href="/notice/1">First notice</a> 2026.08.01</li><li><a href="/notice/2">Other notice</a></li></ul>', "/notice/1": "<article>All about it</article><time>2026-08-03</time>"}
            text = known.get(self.path)
            self.send_response(200 if text else 404)
            self.end_headers()
            self.wfile.write((text or "").encode())

        def log_message(self, *_):
            pass

    served = HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=served.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{served.server_port}"
    served.shutdown()


def test_fetch_never_throws(spark, server):
    urls = [(f"{server}/list", "a"), (f"{server}/none", "b"), ("http://127.0.0.1:1/", "c"), (None, "d"), ("nonsense", "e")]
    rows = {r["tag"]: r for r in fetch.fetched(spark.createDataFrame(urls, "url string, tag string"), timeout=5).collect()}
    assert rows["a"]["http_status"] == 200 and "First notice" in rows["a"]["html"] and rows["a"]["fetch_error"] == ""
    assert rows["b"]["http_status"] == 404 and rows["b"]["html"] == "" and "404" in rows["b"]["fetch_error"]
    assert all(rows[t]["http_status"] == 0 and rows[t]["fetch_error"] for t in "cde")


def test_listed_links_with_their_pages(spark, server):
    pages = fetch.fetched(spark.createDataFrame([(1, f"{server}/list")], "page_id long, url string"))
    made = fetch.with_details(html.listed(pages), parse=html.parsed)
    rows = {r["url"].rsplit("/", 1)[1]: r for r in made.collect()}
    assert rows["1"]["detail"].startswith("All about it") and rows["2"]["detail"] is None and rows["2"]["title"] == "Other notice"


def test_official_run(spark):
    entities = spark.createDataFrame([("a", "C", "l", "Aurora", [], False, 1), ("b", "C", "l", "Borealis", [], False, 2), ("c", "D", "l", "Corona", [], False, 3)], "artist_id string, company string, label string, name string, aliases array<string>, priority boolean, seq long")
    sources = spark.createDataFrame([("s1", "company", "One", "LIVE", ["a", "b", "x"]), ("s2", "artist", "Two", "LIVE", ["b"]), ("s3", "company", "Off", "OFF", ["a"]), ("s4", "company", "Four", "LIVE", ["c"])], "source_id string, scope string, name string, status string, artist_ids array<string>")
    rows = [
        (1, "s1", "Aurora concert 개최", "with Borealis", "2026-07-31 07:00:00"), (2, "s1", "콘서트 without a name", "", "2026-07-31 07:00:00"), (3, "s2", "콘서트 개최", "", "2026-07-31 06:00:00"), (4, "s2", "콘서트 개최 old", "", "2026-07-01 06:00:00"),
        (5, "s2", "콘서트 개최 no day", "", None), (6, "s2", "nothing of note", "", "2026-07-31 06:00:00"), (7, "s3", "Aurora 콘서트", "", "2026-07-31 06:00:00"), (8, "s4", "Corona 콘서트 개최", "", "2026-07-31 06:00:00"),
    ]
    at = F.to_timestamp("published_at")
    articles = spark.createDataFrame(rows, "seq long, source_id string, title string, body string, published_at string").withColumns({"published_at": at, "fetched_at": at, "url": F.concat(F.lit("http://o/"), F.col("seq").cast("string")), "original_url": F.lit(""), "naver_url": F.lit(""), "publisher": F.lit(""), "search_query": F.lit("")})
    history = spark.createDataFrame([], schemas.text_schema(schemas.HISTORY))
    run = official.collect(articles, sources, entities, history, "2026-07-31 08:00:00", company="C")
    assert sorted((r["url"][-1], r["artist"], r["official_verified"]) for r in run.selected.collect()) == [("1", "Aurora", True), ("1", "Borealis", True), ("3", "Borealis", True)]
    assert {r["url"][-1]: r["reason"] for r in run.excluded.collect()} == {"4": "24시간 범위 밖", "5": "게시일 미확인", "6": "활동 분류/점수 기준 미달"}
    assert {r["source_id"]: (r["entities"], r["rows"]) for r in run.sources.collect()} == {"s1": (2, 2), "s2": (1, 4)}
    sheet = export.selected_rows(run.selected)
    assert tuple(sheet.columns) == export.ARTICLE_COLUMNS and len(sheet.columns) == 42
    assert {r["공식 확인"] for r in sheet.collect()} == {"Y"} and {r["수집 채널"] for r in sheet.collect()} == {"OFFICIAL"}


def test_workbook(spark, tmp_path):
    articles = spark.createDataFrame([("=t", "REVIEW_REQUIRED", "NAVER_NEWS", ["x", "y"], 7, "whole body"), ("u", "AUTO_SELECTED", "OFFICIAL", [], 8, None)], "title string, validation_status string, source_type string, cities array<string>, score int, body string")
    runs, parameters = spark.createDataFrame([("s", 3)], "source_id string, rows int"), sinks.parameters(spark, {"hours": 24, "x": {"a": 1}})
    excluded = export.excluded_rows(articles.limit(1).withColumn("reason", F.lit("why")))
    book = export.workbook(articles, excluded, runs, parameters, spark.createDataFrame([], "id string"))
    assert list(book) == ["daily_selected", "calendar_events", "raw_articles", "excluded", "source_runs", "validation_queue", "run_params"]
    sinks.write_workbook(book, f"file://{tmp_path}/book")
    read = lambda n: spark.read.csv(f"file://{tmp_path}/book/{n}", header=True, escape='"').collect()
    assert {r["공식 확인"]: r["도시"] for r in read("daily_selected")} == {"N/A": "x|y", "N": None}
    assert [r["제목"] for r in read("validation_queue")] == ["'=t"] and {r[export.BODY_COLUMN] for r in read("raw_articles")} == {"whole body", None}
    assert [r[export.REASON_COLUMN] for r in read("excluded")] == ["why"] and {r["항목"] for r in read("run_params")} == {"hours", "x"}


def test_notice_run(spark):
    columns = schemas.names(schemas.NOTICE_CACHE)

    def row(n, title, body, status=200):
        made = {"artist": "A", "company_group": "C", "url": f"u{n}", "notice_id": str(n), "title": title, "body": body, "http_status": status, "source_type": "s"}
        return tuple(made.get(c, "") for c in columns)

    cache = spark.createDataFrame([row(1, "POP-UP one", "2026.08.01 ~ 2026.08.09"), row(9, "POP-UP unasked", "")], schemas.NOTICE_CACHE)
    fresh = [row(2, "POP-UP two", "2026.07.01 ~ 2026.07.09 " + "x" * 3000), row(3, "other", ""), row(4, "", "", 404), row(5, "POP-UP old", "2020.07.01 ~ 2020.07.09"), row(6, "POP-UP without a day", "")]
    asked = []

    def fetcher(missing):
        asked.extend(sorted(r["url"] for r in missing.collect()))
        return spark.createDataFrame(fresh, schemas.NOTICE_CACHE)

    run = notices.collect(spark.createDataFrame([(f"u{n}",) for n in range(1, 7)], "url string"), cache, fetcher, "2026-01-01", "2026-12-31")
    assert asked == ["u2", "u3", "u4", "u5", "u6"]
    assert [r["url"] for r in run.rows.collect()] == ["u2", "u1", "u6"]
    assert {r["url"]: r["reason"] for r in run.excluded.collect()} == {"u3": "no pop-up shop", "u4": "not fetched", "u5": notices.OUTSIDE}
    raw = {r["url"]: r for r in run.raw.collect()}
    assert set(raw) == {f"u{n}" for n in range(1, 7)} and len(raw["u2"]["body_preview"]) == 2500 and "body" not in run.raw.columns
    assert run.cache.count() == 7


def test_search_queries(spark):
    made = notices.search_queries(spark, spark.createDataFrame([("c", "G")], "community string, group_name string"), 2025, 2026, site="n.example/{community}/notice", terms=("a", "b")).orderBy("place")
    assert [r["query"] for r in made.collect()][:8] == [f"site:n.example/c/notice {q}" for q in ('intitle:"a"', '"a"', '"G" "a"', '"a" 2025', '"G" "a" 2025', '"a" 2026', '"G" "a" 2026', 'intitle:"b"')]
