"""All queries of the library by name, and their equivalents in DuckDB's SQL.

The tables hold no articles, so titles, entities and stores are made of typed columns, alike in
both languages, and vocabularies are given as parameters. Every query reads its whole tables.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import lineage, schemas, vocabulary
from .functions import dates, freedates, keys, names, similarity, text
from .operators import classify, cluster, decisions, enrich, export, extract, feeds, popup, qa, resolve, scan, schedule, spans, state
from .plans import daily, notices, official
from .sources import embedded, html, selectors
from .streaming import keyed
from .vocabulary import Rejection, Rule

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- vocabularies for the invented prose

RULES = (Rule("NOTICE", 60, ("this", "from")), Rule("REPORT", 54, ("that", "then")), Rule("STORY", 50, ("with", "have", "pour")))
REJECTIONS = (Rejection("no keyword", None, ("OTHER",)), Rejection("bulk", r"(free|offer|###)"), Rejection("nothing new", r"(\d\d\d)", lifted=True), Rejection("story without news", None, ("STORY",), True))
ANNOUNCES = r"(and|und)"
SELECTORS = ("li", "body > p", "div p, nav")
_SPACE = r"[\s\x{0B}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"


def _rules_sql(column: str, rules: tuple[Rule, ...] = RULES) -> str:
    """Subquery rated: the table's columns, score, activity_type and keywords."""
    hit = lambda k: f"contains(lower({column}), '{k}')"
    n = ", ".join(f"{' + '.join(f'CAST({hit(k)} AS INT)' for k in r.keywords)} AS n{i}" for i, r in enumerate(rules))
    s = ", ".join(f"CASE WHEN n{i} > 0 THEN {r.base} + least(12, 3 * (n{i} - 1)) ELSE 0 END AS s{i}" for i, r in enumerate(rules))
    best = f"greatest({', '.join(f's{i}' for i in range(len(rules)))})"
    kind = " ".join(f"WHEN s{i} = {best} THEN '{r.activity}'" for i, r in enumerate(rules))
    words = ", ".join(f"CASE WHEN {hit(k)} THEN '{k}' END" for k in sorted(k for r in rules for k in r.keywords))
    return f"""counted AS (SELECT doc_id, text, {n} FROM documents),
scored AS (SELECT *, {s} FROM counted),
rated AS (SELECT doc_id, text, CAST({best} AS INT) AS score, CASE WHEN {best} = 0 THEN 'OTHER' {kind} END AS activity_type, concat_ws('|', {words}) AS keywords FROM scored)"""


def _rated(spark: SparkSession, sf_dir: str) -> DataFrame:
    # a generator of one element: a filter above cannot be pushed below it, which would rate every text twice
    made = table(spark, sf_dir, "documents").select("doc_id", "text", F.explode(F.array(classify.classified(F.col("text"), RULES))).alias("c"))
    return made.select("doc_id", "text", F.col("c.score").alias("score"), F.col("c.activity").alias("activity_type"), F.array_join("c.keywords", "|").alias("keywords"))


@query(
    f"""WITH {_rules_sql("text")},
keyed AS (SELECT *, substr(sha256('doc|' || lower(trim(regexp_replace(text, '{_SPACE}', ' ', 'g')))), 1, 24) AS dedupe_key FROM rated WHERE activity_type <> 'OTHER')
SELECT doc_id, activity_type, score, dedupe_key FROM keyed QUALIFY row_number() OVER (PARTITION BY dedupe_key ORDER BY score DESC, doc_id) = 1"""
)
def announcements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best new article per key."""
    none = F.lit(None).cast("string")
    found = _rated(spark, sf_dir).filter("activity_type <> 'OTHER'")
    told = found.select("doc_id", "activity_type", "score", keys.dedupe_key(F.lit("doc"), none, none, F.col("text")).alias("dedupe_key"))
    return scan.first_per(told, ["dedupe_key"], [F.desc("score"), "doc_id"])


@query(f"WITH {_rules_sql('text')} SELECT doc_id, activity_type, score, keywords FROM rated")
def keyword_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rated(spark, sf_dir).select("doc_id", "activity_type", "score", "keywords")


_REASON = r"""CASE WHEN activity_type = 'OTHER' THEN 'no keyword' WHEN regexp_matches(text, '(?i)(free|offer|###)') THEN 'bulk'
WHEN regexp_matches(text, '[0-9][0-9][0-9]') AND NOT regexp_matches(text, '(?i)(and|und)') THEN 'nothing new'
WHEN activity_type = 'STORY' AND NOT regexp_matches(text, '(?i)(and|und)') THEN 'story without news' ELSE '' END"""


def _judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rated(spark, sf_dir).select("doc_id", classify.rejection(F.col("text"), F.col("activity_type"), REJECTIONS, ANNOUNCES).alias("reason"))


@query(f"WITH {_rules_sql('text')} SELECT doc_id, {_REASON} AS reason FROM rated")
def rejection_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _judged(spark, sf_dir)


@query(
    f"""WITH {_rules_sql("text")}, judged AS (SELECT doc_id, {_REASON} AS reason FROM rated), out AS (SELECT * FROM judged WHERE reason <> '')
SELECT doc_id, reason, n FROM (SELECT doc_id, reason, row_number() OVER (PARTITION BY reason ORDER BY doc_id) AS r FROM out WHERE true QUALIFY r <= 20)
JOIN (SELECT reason, count(*) AS n FROM out GROUP BY reason) USING (reason)"""
)
def excluded_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 20 left-out articles per reason, beside the count of all."""
    counts, first = classify.excluded_report(_judged(spark, sf_dir).filter("reason <> ''").withColumnRenamed("doc_id", "seq"))
    return first.join(counts, "reason").select(F.col("seq").alias("doc_id"), "reason", "n")


@query(
    f"""WITH c AS (SELECT doc_id, trim(regexp_replace(text, '{_SPACE}', ' ', 'g')) AS t FROM documents),
p AS (SELECT *, coalesce(least(nullif(strpos(lower(t), 'that'), 0), nullif(strpos(lower(t), 'pour'), 0)), 1) AS pos FROM c),
w AS (SELECT *, greatest(pos - 91, 0) AS a FROM p)
SELECT doc_id, CASE WHEN t = '' THEN '' ELSE CASE WHEN a > 0 THEN '… ' ELSE '' END || trim(substr(t, a + 1, 320)) || CASE WHEN a + 320 < length(t) THEN ' …' ELSE '' END END AS clipped FROM w"""
)
def evidence_clip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", text.clip("text", F.array(F.lit("that"), F.lit("pour"))).alias("clipped"))


_TITLE = "CASE CAST(o_orderkey % 4 AS INT) WHEN 0 THEN n_name || ' announces' WHEN 1 THEN 'the ' || lower(n_name) || ', live' WHEN 2 THEN n_name || 'x band' ELSE 'with ' || n_name || ' and NATION_3' END"


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their customer and nation; the nations are a fixed list of countries."""
    joined = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return joined.join(F.broadcast(table(spark, sf_dir, "nation")), F.col("c_nationkey") == F.col("n_nationkey"))


@query(
    f"""WITH t AS (SELECT o_orderkey AS seq, {_TITLE} AS title FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
m AS (SELECT seq, CAST(n_nationkey AS VARCHAR) AS artist_id, n_name AS alias FROM t JOIN nation ON regexp_matches(title, '(?i)(^|[^A-Za-z0-9])' || n_name || '([^A-Za-z0-9]|$)')
      QUALIFY row_number() OVER (PARTITION BY seq ORDER BY length(n_name) DESC, n_nationkey) = 1)
SELECT seq, title, artist_id, alias FROM t LEFT JOIN m USING (seq)"""
)
def entity_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which nation a title is about, with boundaries and the longest name first."""
    nations = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("string").alias("artist_id"), F.lit("").alias("company"), F.lit("").alias("label"), F.col("n_name").alias("name"), F.array().cast("array<string>").alias("aliases"), F.lit(False).alias("priority"), F.col("n_nationkey").cast("long").alias("seq")
    )
    titles = _orders(spark, sf_dir).select(F.col("o_orderkey").alias("seq"), F.expr(_TITLE).alias("title"))
    return resolve.resolve(titles, resolve.alias_table(nations, [])).select("seq", "title", "artist_id", F.col("matched_artist_alias").alias("alias"))


@query(
    """SELECT event_type, count(*) FILTER (ts <= TIMESTAMP '2024-01-20 00:10:00') AS received, count(*) FILTER (ts BETWEEN TIMESTAMP '2024-01-13 00:00:00' AND TIMESTAMP '2024-01-20 00:10:00') AS recent,
count(*) FILTER (ts < TIMESTAMP '2024-01-13 00:00:00') AS outside, CAST(0 AS BIGINT) AS missing, count(*) FILTER (ts > TIMESTAMP '2024-01-20 00:10:00') AS future FROM events GROUP BY event_type"""
)
def lookback_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    age = scan.age(F.col("ts"), F.lit("2024-01-20 00:00:00").cast(_stamp(spark, sf_dir)), 24 * 7)
    return scan.figures(table(spark, sf_dir, "events").select("event_type", age.alias("age")), "event_type")


def _stamp(spark: SparkSession, sf_dir: str) -> str:
    return table(spark, sf_dir, "events").schema["ts"].dataType.simpleString()


@query(
    """SELECT event_type, event_id, value FROM events QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY value DESC, event_id) <= 2"""
)
def topk_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan.top_per_group(table(spark, sf_dir, "events").select("event_type", "event_id", "value"), ["event_type"], [F.desc("value"), F.col("event_id")], 2)


@query("SELECT event_type, CAST(json_extract(props, '$.k') AS INT) % 10 AS k, count(*) AS n, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS cents FROM events GROUP BY ALL")
def json_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = table(spark, sf_dir, "events").withColumn("k", F.from_json("props", "k int")["k"] % 10)
    return read.groupBy("event_type", "k").agg(F.count(F.lit(1)).alias("n"), F.sum(F.round(F.col("value") * 100).cast("long")).alias("cents"))


_URL = r"""regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)([^?#]*)(?:\?([^#]*))?', {})"""
_CANON = (
    f"""lower({_URL.format(1)}) || '://' || lower({_URL.format(2)}) || CASE WHEN regexp_replace({_URL.format(3)}, '/+$', '') = '' THEN '/' ELSE regexp_replace({_URL.format(3)}, '/+$', '') END"""
    f""" || coalesce('?' || nullif(array_to_string(list_sort(list_filter(string_split({_URL.format(4)}, '&'), lambda p: p <> '' AND NOT regexp_matches(lower(p), '^(utm_|fbclid=|gclid=|referrer=)'))), '&'), ''), '')"""
)


@query(f"WITH c AS (SELECT page_id, {_CANON} AS canonical FROM pages) SELECT min(page_id) AS page_id, canonical FROM c GROUP BY canonical")
def url_canonical_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first page per canonical URL."""
    made = table(spark, sf_dir, "pages").select("page_id", text.canonical_url("url").alias("canonical"))
    return made.groupBy("canonical").agg(F.min("page_id").alias("page_id"))


@query(
    rf"""WITH h AS (SELECT regexp_replace(lower({_URL.format(2)}), '^www\.', '') AS publisher FROM pages)
SELECT publisher, CAST(CASE WHEN publisher = 'spam-farm.example.org' THEN 1 ELSE 3 END AS INT) AS publisher_score, count(*) AS n FROM h GROUP BY ALL"""
)
def domain_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    hosts = table(spark, sf_dir, "pages").select(text.host("url").alias("publisher")).groupBy("publisher").agg(F.count(F.lit(1)).alias("n"))
    return resolve.publisher_score(hosts, {"spam-farm.example.org": 1}, 3)


@query("""SELECT page_id, len(regexp_extract_all(html, '<a [^>]*href="[^"]+"')) AS n_links FROM pages""")
def html_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many links each page has, outside scripts."""
    return html.parsed(table(spark, sf_dir, "pages").select("page_id", "url", "html")).select("page_id", F.size("links").cast("long").alias("n_links"))


@query()
def html_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.parsed(table(spark, sf_dir, "pages").select("page_id", "url", "html")).select("page_id", "title", F.sha2("text", 256).alias("text_sha256"))


@query()
def html_listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first link of each list item, by address once per page."""
    return html.listed(table(spark, sf_dir, "pages").select("page_id", "url", "html"), link=".", least=2)


_SCRIPTS = (
    # no JSON as a whole: searched as text
    """'<script>var x = {"a": [{"title": "Page <b>' || page_id || '</b>"}, {"body": "no. ' || page_id || ' &amp; \\\\"\\\\u00e9\\\\""}], y: 1};</script>'""",
    # nested; a string of a list stands under no key, and numbers and nulls are no texts
    """'<script type="application/json">{"title": "T ' || page_id || '", "a": {"b": [{"x": {"contents": "deep ' || page_id || '"}}, "POP-UP", 5, null, [{"name": "N ' || page_id || '"}]]}}</script>'""",
    # a mark under a key that says nothing and is long, and the title of an empty shell
    """'<script id="__NEXT_DATA__">{"' || repeat('k', 300) || '": "POP-UP ' || page_id || '", "name": "weverse", "other": "not this"}</script>'""",
    # a marked title is a text too; escapes are decoded once
    """'<script type="application/ld+json">{"subject": "POP UP \\\\"\\\\u00e9\\\\" ' || page_id || '", "n": 5, "message": "a &lt; b"}</script>'""",
)


@query(
    """SELECT page_id, CASE CAST(page_id % 4 AS INT) WHEN 0 THEN 'Page ' || page_id WHEN 1 THEN 'T ' || page_id || '|N ' || page_id WHEN 2 THEN '' ELSE 'POP UP "é" ' || page_id END AS titles,
CASE CAST(page_id % 4 AS INT) WHEN 0 THEN 'no. ' || page_id || ' & "é"' WHEN 1 THEN 'deep ' || page_id WHEN 2 THEN 'POP-UP ' || page_id ELSE 'POP UP "é" ' || page_id || '|a < b' END AS texts FROM pages"""
)
def script_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles and texts out of scripts of four kinds that are put before the pages."""
    script = F.element_at(F.array(*[F.expr(s) for s in _SCRIPTS]), (F.col("page_id") % 4 + 1).cast("int"))
    made = embedded.script_texts(table(spark, sf_dir, "pages").select("page_id", F.concat(script, text.filled("html")).alias("html")))
    return made.select("page_id", F.array_join("titles", "|").alias("titles"), F.array_join("texts", "|").alias("texts"))


@query(
    """SELECT o_orderkey AS seq, CASE CAST(o_orderkey % 4 AS INT) WHEN 0 THEN '도쿄' WHEN 1 THEN '부산' WHEN 2 THEN '' ELSE '서울|오사카' END AS cities, 'Green ' || o_orderkey || ' Hall' AS venues FROM orders"""
)
def event_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cities and venues out of announcements made of orders."""
    said = F.expr("CASE CAST(o_orderkey % 4 AS INT) WHEN 0 THEN 'live in Tokyo' WHEN 1 THEN '부산 공연' WHEN 2 THEN 'somewhere' ELSE 'OSAKA and Seoul' END || ', Green ' || o_orderkey || ' Hall'")
    made = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("seq"), said.alias("said"))
    return made.select("seq", F.array_join(names.cities(F.col("said")), "|").alias("cities"), F.array_join(names.venues(F.col("said")), "|").alias("venues"))


_CITIES = tuple(sorted(vocabulary.CITIES))


@query(
    f"""WITH c AS (SELECT [{", ".join(repr(c) for c in _CITIES)}] AS names)
SELECT o_orderkey AS seq, names[CAST(o_orderkey % {len(_CITIES)} AS INT) + 1] || CASE WHEN o_orderkey % 3 = 0 AND o_orderkey % {len(_CITIES)} < {len(_CITIES) - 1} THEN '|' || names[{len(_CITIES)}] ELSE '' END AS cities FROM orders, c"""
)
def event_cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All cities of the default list by all of their names, alone and two at a time, sorted."""
    key, n = F.col("o_orderkey"), len(_CITIES)
    said = [F.element_at(F.array(*[F.lit(a.strip()) for a in vocabulary.CITIES[c] if a.strip() != "la"]), (key % len([a for a in vocabulary.CITIES[c] if a.strip() != "la"]) + 1).cast("int")) for c in _CITIES]
    one = F.element_at(F.array(*[F.concat(F.lit("Live in "), F.initcap(s), F.lit(" soon")) for s in said]), (key % n + 1).cast("int"))
    both = F.concat(one, F.when((key % 3 == 0) & (key % n < n - 1), F.concat(F.lit(", and "), said[-1])).otherwise(""))
    return table(spark, sf_dir, "orders").select(key.alias("seq"), F.array_join(names.cities(both), "|").alias("cities"))


@query(
    """WITH s AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS a, CAST(o_orderkey % 60 AS INT) - 5 AS n FROM orders)
SELECT o_orderkey, CAST(CASE WHEN n BETWEEN 0 AND 45 THEN n + 1 ELSE 0 END AS INT) AS days, CASE WHEN n BETWEEN 0 AND 45 THEN CAST(CAST(a + n AS DATE) AS VARCHAR) END AS last,
CASE WHEN n < 0 THEN '' WHEN n > 45 THEN CAST(a AS VARCHAR) || '|' || CAST(CAST(a + n AS DATE) AS VARCHAR) ELSE array_to_string([CAST(CAST(a + CAST(i AS INT) AS DATE) AS VARCHAR) FOR i IN range(n + 1)], '|') END AS stored FROM s"""
)
def date_range_expand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of days, empty if reversed or too long, and as reviews store them."""
    s = table(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("a"), ((F.col("o_orderkey") % 60).cast("int") - 5).alias("n"))
    spans = s.select("o_orderkey", "a", F.date_add("a", F.col("n")).alias("b"), "n")
    listed = spans.withColumn("d", dates.days(F.col("a"), F.col("b")))
    return listed.select("o_orderkey", F.size("d").alias("days"), F.array_max("d").cast("string").alias("last"), F.when(F.col("n") < 0, "").otherwise(dates.review_days(F.col("a"), F.col("b"))).alias("stored"))


def _stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as rows of a history: two of three with a span, one of three with a list of days."""
    day = F.to_date("o_orderdate")
    ranged = F.col("o_orderkey") % 3 > 0
    made = {
        "event_key": F.col("o_orderkey").cast("string"),
        "artist_id": F.col("o_custkey").cast("string"),
        "artist": F.concat(F.lit("C"), F.col("o_custkey").cast("string")),
        "activity_type": F.when(F.col("o_orderstatus") == "F", "CONCERT").otherwise("OTHERWISE"),
        "event_name": F.when(F.col("o_orderkey") % 5 == 0, "").otherwise(F.col("o_orderpriority")),
        "event_start_date": F.when(ranged, day.cast("string")).otherwise(""),
        "event_end_date": F.when(F.col("o_orderkey") % 3 == 1, F.date_add(day, 3).cast("string")).otherwise(""),
        "event_dates": F.when(ranged, "").otherwise(F.concat_ws("|", day.cast("string"), F.date_add(day, 9).cast("string"))),
        "approval_status": F.when(F.col("o_orderkey") % 11 == 0, "REJECTED").otherwise("AUTO_CONFIRMED"),
        "primary_url": F.lit("http://x.example/"),
    }
    return table(spark, sf_dir, "orders").select(*[made.get(c, F.lit("")).alias(c) for c in schemas.HISTORY])


@query(
    """WITH s AS (SELECT *, CAST(o_orderdate AS DATE) AS d, CAST(o_orderkey AS VARCHAR) AS k, 'C' || o_custkey || ' · ' || CASE WHEN o_orderkey % 5 <> 0 THEN o_orderpriority WHEN o_orderstatus = 'F' THEN '콘서트' ELSE 'OTHERWISE' END AS title,
 CASE WHEN o_orderstatus = 'F' THEN '#0f766e' ELSE '#64748b' END AS color FROM orders WHERE o_orderkey % 11 <> 0),
w AS (SELECT DATE '1998-06-15' - 14 AS a, DATE '1998-09-15' AS b),
e AS (SELECT k AS id, title, color, d AS s, d + CASE WHEN o_orderkey % 3 = 1 THEN 4 ELSE 1 END AS t FROM s, w WHERE o_orderkey % 3 > 0 AND d + CASE WHEN o_orderkey % 3 = 1 THEN 3 ELSE 0 END >= a AND d <= b
 UNION ALL SELECT k || ':' || CAST(CAST(d + o AS DATE) AS VARCHAR), title, color, d + o, NULL FROM s, w, (VALUES (0), (9)) AS x(o) WHERE o_orderkey % 3 = 0 AND d + o BETWEEN a AND b)
SELECT id, title, color, CAST(CAST(s AS DATE) AS VARCHAR) AS start, CAST(CAST(t AS DATE) AS VARCHAR) AS "end" FROM e"""
)
def calendar_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.calendar_events(_stored(spark, sf_dir), "1998-06-15").select("id", "title", "color", "start", "end")


def _dated_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles that name the day of an order (or a span of three days), published 20 days before."""
    at = F.to_date("o_orderdate")
    day = F.concat(F.month(at).cast("string"), F.lit("월 "), F.dayofmonth(at).cast("string"), F.lit("일"))
    span = F.concat(F.lit("~"), F.month(F.date_add(at, 2)).cast("string"), F.lit("월 "), F.dayofmonth(F.date_add(at, 2)).cast("string"), F.lit("일"))
    title = F.concat(F.col("c_name"), F.lit(" 콘서트 개최 "), day, F.when(F.col("o_orderkey") % 3 == 0, span).otherwise(""))
    return _orders(spark, sf_dir).select(
        F.col("o_orderkey").alias("seq"), F.col("o_custkey").cast("string").alias("artist_id"), F.col("c_name").alias("artist"), F.col("c_name").alias("matched_artist_alias"), title.alias("title"), F.lit("").alias("body"),
        F.lit("CONCERT").alias("activity_type"), F.date_sub(at, 20).cast("timestamp").alias("published_at"), F.date_sub(at, 20).cast("timestamp").alias("fetched_at"),
    )


@query(
    """SELECT o_orderkey AS seq, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS start, CAST(CAST(CAST(o_orderdate AS DATE) + CASE WHEN o_orderkey % 3 = 0 THEN 2 ELSE 0 END AS DATE) AS VARCHAR) AS "end",
'HIGH' AS confidence, 'TITLE' AS source FROM orders JOIN customer ON o_custkey = c_custkey"""
)
def date_parse_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days read back out of titles; the oracle knows them from the source columns."""
    found = extract.event_fields(_dated_titles(spark, sf_dir))
    return found.select("seq", F.col("event_start_date").cast("string").alias("start"), F.col("event_end_date").cast("string").alias("end"), F.col("date_confidence").alias("confidence"), F.col("date_source").alias("source"))


# Titles by kind, the activity that the default rules give them, and the reason for which the default chain leaves them out.
_TITLES = (
    ("새 소식", "OTHER", 0), ("콘서트 개최 취소", "CONCERT", 1), ("팬미팅 성료", "FANMEETING", 2), ("컴백 실적 발표", "COMEBACK", 3), ("컴백 투표 시작", "COMEBACK", 4), ("컴백 앞두고 미소", "COMEBACK", 5),
    ("새 앨범 티저", "COMEBACK", 6), ("월드투어 무대", "TOUR_ANNOUNCEMENT", 7), ("팬미팅 무대", "FANMEETING", 8), ("미니 앨범 무대", "COMEBACK", 9), ("콘서트 개최 확정", "CONCERT", None), ("팬미팅 성료 앙코르", "FANMEETING", None),
)


@query(
    f"""SELECT o_orderkey AS seq, {" ".join(["CASE CAST(o_orderkey % 12 AS INT)", *[f"WHEN {i} THEN '{a}'" for i, (_, a, _) in enumerate(_TITLES)]])} END AS activity_type,
{" ".join(["CASE CAST(o_orderkey % 12 AS INT)", *[f"WHEN {i} THEN '{vocabulary.REJECTIONS[r].reason if r is not None else ''}'" for i, (_, _, r) in enumerate(_TITLES)]])} END AS reason FROM orders"""
)
def rejection_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ten reasons of the default chain, and announcements that lift one."""
    title = F.concat(F.lit("가수 "), F.element_at(F.array(*[F.lit(t) for t, _, _ in _TITLES]), (F.col("o_orderkey") % 12 + 1).cast("int")), F.lit(" no "), F.col("o_orderkey").cast("string"))
    rated = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("seq"), title.alias("title")).withColumn("activity_type", classify.classified(F.col("title"), vocabulary.RULES)["activity"])
    return rated.select("seq", "activity_type", classify.rejection(F.col("title"), F.col("activity_type"), vocabulary.REJECTIONS, vocabulary.ANNOUNCES).alias("reason"))


# Title and body by kind, with the days that they name; d: the day of the order, p: the day of publication, 20 days before.
_DATE_FORMS = (
    ("month(d) || '월 ' || day(d) || '일~' || month(d + 2) || '월 ' || day(d + 2) || '일'", "''", "d", "d + 2"),
    ("'2' || substr(CAST(year(d) + 10 AS STRING), 2) || '.' || month(d) || '.' || day(d)", "''", "make_date(year(d) + 10, month(d), day(d))", "make_date(year(d) + 10, month(d), day(d))"),
    ("month(p) || '월 3~5일'", "''", "make_date(year(p), month(p), 3)", "make_date(year(p), month(p), 5)"),
    ("'오는 28일부터 내달 2일까지'", "''", "make_date(year(p), month(p), 28)", "make_date(year(n), month(n), 2)"),
    ("'내달 ' || 5 || '일'", "''", "make_date(year(n), month(n), 5)", "make_date(year(n), month(n), 5)"),
    ("'12~14일'", "''", "make_date(year(p), month(p), 12)", "make_date(year(p), month(p), 14)"),
    ("'오는 25일'", "''", "make_date(year(p), month(p), 25)", "make_date(year(p), month(p), 25)"),
    ("'26일'", "''", "make_date(year(p), month(p), 26)", "make_date(year(p), month(p), 26)"),
    ("''", "'콘서트는 ' || month(d) || '월 ' || day(d) || '일 개최된다'", "d", "d"),
    ("'지난 26일'", "''", "NULL", "NULL"),
    ("month(p) || '월 3일, ' || month(p) || '월 9일'", "''", "NULL", "NULL"),
    ("month(p) || '월 31일'", "''", "CASE WHEN day(last_day(p)) = 31 THEN make_date(year(p), month(p), 31) END", "CASE WHEN day(last_day(p)) = 31 THEN make_date(year(p), month(p), 31) END"),
)


def _forms_sql(part: int) -> str:
    return "CASE CAST(k % 12 AS INT) " + " ".join(f"WHEN {i} THEN {form[part]}" for i, form in enumerate(_DATE_FORMS)) + " END"


@query(
    f"""WITH o AS (SELECT o_orderkey AS k, CAST(o_orderdate AS DATE) AS d, CAST(o_orderdate AS DATE) - 20 AS p FROM orders), o2 AS (SELECT *, CAST(date_trunc('month', p) + INTERVAL 1 MONTH AS DATE) AS n FROM o)
SELECT k AS seq, CAST(CAST({_forms_sql(2)} AS DATE) AS VARCHAR) AS start, CAST(CAST({_forms_sql(3)} AS DATE) AS VARCHAR) AS "end", k % 12 = 10 AS conflict FROM o2"""
)
def date_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days in all nine forms of the default patterns, in titles and bodies, past ones, conflicting ones and ones that do not exist."""
    d = F.to_date("o_orderdate")
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), d.alias("d"), F.date_sub(d, 20).alias("p"))
    said = lambda part: F.expr(_forms_sql(part))
    made = rows.select(
        F.col("k").alias("seq"), F.lit("X").alias("artist"), F.lit("X").alias("matched_artist_alias"), F.lit("CONCERT").alias("activity_type"),
        F.concat(F.lit("X 콘서트 개최 "), said(0)).alias("title"), said(1).alias("body"), F.col("p").cast("timestamp").alias("published_at"), F.col("p").cast("timestamp").alias("fetched_at"),
    )
    found = extract.event_fields(made)
    return found.select("seq", F.col("event_start_date").cast("string").alias("start"), F.col("event_end_date").cast("string").alias("end"), F.col("date_conflict").alias("conflict"))


@query(
    """WITH v AS (SELECT l_orderkey, CAST(l_shipdate AS DATE) AS d, count(*) AS votes, max(CAST(l_quantity AS INT)) AS q, min(l_linenumber) AS f FROM lineitem GROUP BY ALL),
r AS (SELECT *, row_number() OVER w AS r, lead(votes) OVER w AS nxt FROM v WINDOW w AS (PARTITION BY l_orderkey ORDER BY votes DESC, q DESC, f, d))
SELECT l_orderkey AS event_seq, CAST(d AS VARCHAR) AS start, CAST(d AS VARCHAR) AS "end", votes, coalesce(votes = nxt, false) AS tied FROM r WHERE r = 1"""
)
def date_vote(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The day most lines of an order name, and whether another has as many."""
    day = F.to_date("l_shipdate").cast("string")
    return enrich.vote(table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("event_seq"), day.alias("start"), day.alias("end"), F.col("l_quantity").cast("int").alias("score"), F.col("l_linenumber").alias("seq")))


@query(
    """WITH s AS (SELECT o_orderkey AS k, o_custkey AS c, CAST(o_orderdate AS DATE) AS a, CAST(o_orderdate AS DATE) + CASE CAST(o_orderkey % 4 AS INT) WHEN 0 THEN 0 WHEN 1 THEN 5 WHEN 2 THEN 30 ELSE CAST(o_orderkey % 700 AS INT) END AS b FROM orders)
SELECT x.c AS custkey, count(*) AS overlaps FROM s x JOIN s y ON x.c = y.c AND x.k < y.k AND x.a <= y.b AND y.a <= x.b GROUP BY x.c"""
)
def interval_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overlapping spans of one customer, from single days to two years."""
    day = F.to_date("o_orderdate")
    length = F.expr("CASE o_orderkey % 4 WHEN 0 THEN 0 WHEN 1 THEN 5 WHEN 2 THEN 30 ELSE CAST(o_orderkey % 700 AS INT) END")
    s = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("custkey"), day.alias("start"), F.date_add(day, length).alias("end"))
    return spans.overlapping(s, s, ["custkey"]).filter("l.k < r.k").groupBy("custkey").agg(F.count(F.lit(1)).alias("overlaps"))


_EVENT_COLUMNS = {"old": "o_orderdate < TIMESTAMP '1998-01-01'", "new": "o_orderdate >= TIMESTAMP '1998-01-01'"}


def _events(spark: SparkSession, sf_dir: str, part: str | None = None) -> DataFrame:
    """Orders as found events of their customers; part: old or new."""
    day = F.to_date("o_orderdate")
    orders = table(spark, sf_dir, "orders")
    rows = orders if part is None else orders.filter(F.expr(_EVENT_COLUMNS[part]))
    none = F.array().cast("array<string>")
    made = {
        "seq": F.col("o_orderkey"), "artist_id": F.col("o_custkey").cast("string"), "artist": F.lit(""), "matched_artist_alias": F.lit(""), "activity_type": F.lit("CONCERT"),
        "title": F.col("o_orderpriority"), "event_name": F.col("o_orderpriority"), "event_dates": F.array(day), "event_start_date": day, "event_end_date": day, "event_is_range": F.lit(False),
        "date_confidence": F.lit("HIGH"), "date_evidence": F.lit(""), "date_source": F.lit("TITLE"), "date_conflict": F.lit(False), "cities": F.array("o_orderstatus"), "venues": none,
        "score": F.floor("o_totalprice").cast("int"), "publisher_score": F.lit(3), "published_at": F.col("o_orderdate").cast("timestamp"), "url": F.concat(F.lit("http://o.example/"), F.col("o_orderkey").cast("string")),
        "original_url": F.lit(""), "naver_url": F.lit(""), "related_urls": none, "supporting_article_count": F.lit(1), "company": F.lit("c"), "label": F.lit("l"), "review_reason": F.lit(""),
        "validation_status": F.lit("AUTO_SELECTED"), "schedule_status": F.lit("NEW_EVENT"), "source_type": F.lit("NEWS"), "clipped_text": F.lit(""),
    }
    return rows.select(*[c.alias(n) for n, c in made.items()])


@query(
    """WITH h AS (SELECT o_custkey AS c, o_orderpriority AS p, list(DISTINCT CAST(CAST(o_orderdate AS DATE) AS VARCHAR)) AS ds, list(DISTINCT o_orderstatus) AS cs, count(*) AS n FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01' GROUP BY ALL),
j AS (SELECT o_orderkey AS seq, CAST(floor(o_totalprice) AS INT) AS score, n, NOT list_contains(cs, o_orderstatus) AS new_city, NOT list_contains(ds, CAST(CAST(o_orderdate AS DATE) AS VARCHAR)) AS new_date
 FROM orders LEFT JOIN h ON c = o_custkey AND p = o_orderpriority WHERE o_orderdate >= TIMESTAMP '1998-01-01')
SELECT seq, CASE WHEN n IS NULL THEN 'NEW_EVENT' WHEN new_city THEN 'NEW_CITY' WHEN new_date THEN 'SAME_CITY_NEW_DATE' ELSE 'EXISTING_SCHEDULE' END AS schedule_status,
CASE WHEN n IS NULL THEN 'CONCERT' WHEN new_city THEN 'TOUR_EXPANSION' WHEN new_date THEN 'ADDITIONAL_SHOW' ELSE 'CONCERT' END AS activity_type,
CAST(score + CASE WHEN n IS NULL THEN 0 WHEN new_city THEN 12 WHEN new_date THEN 15 ELSE 0 END AS INT) AS score, CAST(coalesce(n, 0) AS INT) AS known FROM j"""
)
def schedule_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    old = _events(spark, sf_dir, "old").select(F.col("seq").cast("string").alias("event_key"), "artist_id", "activity_type", "event_name", F.col("event_start_date").cast("string").alias("event_dates"), F.array_join("cities", "|").alias("cities"))
    made = schedule.assess(_by_name(_events(spark, sf_dir, "new")), _by_name(old))
    return made.select("seq", "schedule_status", "activity_type", "score", F.size("previous_event_keys").alias("known"))


@query()
def schedule_change_fuzzy(spark: SparkSession, sf_dir: str) -> DataFrame:
    old = _events(spark, sf_dir, "old").select(F.col("seq").cast("string").alias("event_key"), "artist_id", "activity_type", "event_name", F.col("event_start_date").cast("string").alias("event_dates"), F.array_join("cities", "|").alias("cities"))
    return schedule.assess(_events(spark, sf_dir, "new"), old).select("seq", "schedule_status", "activity_type", "score", F.size("previous_event_keys").alias("known"))


def _like_parts(spark: SparkSession, sf_dir: str, alike: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """l, r and what alike says of their names: parts of one brand and size in the order of their keys."""
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("key"), F.col("p_brand").alias("brand"), F.col("p_size").alias("size"), F.col("p_name").alias("name"))
    return similarity.like_pairs(parts, ["brand", "size"], alike)


@query(
    f"""WITH t AS (SELECT a.p_partkey AS l, b.p_partkey AS r, string_split(a.p_name, ' ') AS x, string_split(b.p_name, ' ') AS y FROM part a JOIN part b ON a.p_brand = b.p_brand AND a.p_size = b.p_size AND a.p_partkey < b.p_partkey)
SELECT l, r, len(list_intersect(list_distinct(x), list_distinct(y))) / len(list_distinct(list_concat(x, y))) AS jaccard FROM t WHERE jaccard >= 0.3"""
)
def jaccard_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Like names inside one brand and size."""
    empty = F.lit("")

    def alike(names: DataFrame) -> DataFrame:
        worded = names.withColumn("tokens", similarity.tokens(F.col("name"), empty, empty, empty))
        return similarity.sharing(worded, ["brand", "size"], 0.3).withColumnRenamed("alike", "jaccard")

    return _like_parts(spark, sf_dir, alike)


@query()
def ratio_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Like names by matching blocks, bounded by length before Python sees them."""

    def alike(names: DataFrame) -> DataFrame:
        other = names.select("brand", "size", F.col("name").alias("other"))
        near = names.join(other, ["brand", "size"]).filter(similarity.ratio_bound(F.col("name"), F.col("other")) >= 0.72)
        # the ratio of two names is the same in every block
        rated = near.select("name", "other").distinct().withColumn("ratio", similarity.ratio("name", "other")).filter("ratio >= 0.72")
        return near.join(rated, ["name", "other"])

    return _like_parts(spark, sf_dir, alike)


def monthly_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events on the first day of their month, so that some of one customer fall together."""
    day = F.trunc("event_start_date", "month")
    return _events(spark, sf_dir).withColumns({"event_start_date": day, "event_end_date": day, "event_dates": F.array(day)})


@query()
def greedy_cluster(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of one customer by likeness of name and days, in order of quality."""
    return cluster.assign(monthly_events(spark, sf_dir)).select("seq", "cluster")


@query(
    """WITH g AS (SELECT o_custkey, o_orderpriority, min(o_orderkey) AS cluster, count(*) AS n, arg_max(o_orderkey, (CAST(floor(o_totalprice) AS INT), o_orderdate, -o_orderkey)) AS seq,
 array_to_string(list_sort(list(DISTINCT o_orderstatus)), '|') AS cities FROM orders GROUP BY ALL)
SELECT g.seq, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS start, cities, CAST(n AS INT) AS articles, CAST(n - 1 AS INT) AS related FROM g JOIN orders ON seq = o_orderkey"""
)
def cluster_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Given clusters of one customer and priority as one event each."""
    events = _events(spark, sf_dir)
    given = events.groupBy("artist_id", "event_name").agg(F.min("seq").alias("cluster"), F.collect_list("seq").alias("seqs")).select("cluster", F.explode("seqs").alias("seq"), F.lit("").alias("cluster_rank"))
    made = cluster.roll_up(events, given)
    return made.select("seq", F.col("event_start_date").cast("string").alias("start"), F.array_join("cities", "|").alias("cities"), F.col("supporting_article_count").alias("articles"), F.size("related_urls").alias("related"))


_KEYS_SQL = """keyed AS (SELECT *, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS d, substr(sha256(CAST(o_custkey AS VARCHAR) || '|http://o.example/' || o_orderkey), 1, 24) AS candidate_id,
 substr(sha256(CAST(o_custkey AS VARCHAR) || '|CONCERT|' || lower(regexp_replace(o_orderpriority, '[^A-Za-z0-9_]+', '', 'g')) || '|' || CAST(CAST(o_orderdate AS DATE) AS VARCHAR) || ':' || CAST(CAST(o_orderdate AS DATE) AS VARCHAR) || '|' || o_orderstatus), 1, 24) AS event_key FROM orders)"""


def _by_name(rows: DataFrame) -> DataFrame:
    """Rows whose entity is the customer and the event's name, so that all events of one entity bear the same name."""
    return rows.withColumn("artist_id", F.concat("artist_id", "event_name"))


def _named(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events whose names are all different, so that no two orders are one event."""
    return state.keyed(_events(spark, sf_dir).withColumn("event_name", F.concat_ws(" ", "event_name", F.col("seq").cast("string"))))


def _queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A queue as an earlier run has left it: the events published before 1996."""
    return state.review_rows(_named(spark, sf_dir).filter("published_at < TIMESTAMP '1996-01-01'"), "T1").select(*schemas.QUEUE)


def _log(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = {"action": F.when(F.col("seq") % 7 == 0, "REJECT").otherwise("APPROVE"), "candidate_id": F.col("candidate_id"), "event_key": F.lit("none")}
    return state.keyed(_events(spark, sf_dir)).select(*[made.get(c, F.lit("")).alias(c) for c in schemas.REVIEW_LOG])


@query(
    f"""WITH {_KEYS_SQL.replace("lower(regexp_replace(o_orderpriority,", "lower(regexp_replace(o_orderpriority || o_orderkey,")}, r AS (SELECT * FROM keyed)
SELECT candidate_id, event_key, CASE WHEN o_orderdate < TIMESTAMP '1996-01-01' THEN 'T1' ELSE 'T2' END AS first_seen, CASE WHEN o_orderdate >= TIMESTAMP '1995-01-01' AND o_orderkey % 7 <> 0 THEN 'T2' ELSE 'T1' END AS last_seen FROM r
WHERE o_orderdate < TIMESTAMP '1996-01-01' OR o_orderkey % 7 <> 0"""
)
def queue_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders up to 1995 are queued; those from 1995 on come (again), unless they were rejected."""
    new = _named(spark, sf_dir).filter("published_at >= TIMESTAMP '1995-01-01'")
    return state.upsert_queue(_queue(spark, sf_dir), new, _log(spark, sf_dir), "T2").select("candidate_id", "event_key", "first_seen", "last_seen")


_FIRST_RUN, _SECOND_RUN = "published_at < TIMESTAMP '1997-01-01'", "published_at >= TIMESTAMP '1996-07-01'"


@query(
    f"""WITH {_KEYS_SQL.replace("CAST(o_custkey AS VARCHAR) || '|CONCERT", "CAST(o_custkey AS VARCHAR) || o_orderpriority || '|CONCERT")},
o AS (SELECT o_custkey AS c, o_orderpriority AS p, min(o_orderkey) AS a, arg_min(event_key, o_orderkey) AS k, arg_max(CAST(floor(o_totalprice) AS INT), o_orderkey) AS score FROM keyed WHERE o_orderdate < TIMESTAMP '1997-01-01' GROUP BY ALL),
w AS (SELECT o_custkey AS c, o_orderpriority AS p, arg_min(event_key, o_orderkey) AS k, arg_max(CAST(floor(o_totalprice) AS INT), o_orderkey) AS score, max(CAST(floor(o_totalprice) AS INT)) AS best FROM keyed WHERE o_orderdate >= TIMESTAMP '1996-07-01' GROUP BY ALL)
SELECT coalesce(o.k, w.k) AS event_key, CASE WHEN o.k IS NULL THEN 'T2' ELSE 'T1' END AS first_seen, CASE WHEN w.k IS NULL THEN 'T1' ELSE 'T2' END AS last_seen,
CAST(CASE WHEN w.k IS NULL THEN o.score WHEN o.k IS NOT NULL AND o.a % 5 = 0 THEN greatest(o.score, w.best) ELSE w.score END AS VARCHAR) AS score
FROM o FULL JOIN w ON o.c = w.c AND o.p = w.p"""
)
def history_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs that overlap by half a year; orders of one customer and priority are one event by their like names, some confirmed by hand."""
    events = state.keyed(_by_name(_events(spark, sf_dir)))
    empty = spark.createDataFrame([], schemas.text_schema(schemas.HISTORY))
    first = events.filter(_FIRST_RUN)
    by_hand = first.groupBy("artist_id").agg((F.min("seq") % 5 == 0).alias("by_hand"))
    known = state.upsert_history(empty, first, "T1").join(by_hand, "artist_id")
    history = known.withColumn("approval_status", F.when(F.col("by_hand"), "MANUAL_CONFIRMED").otherwise(F.col("approval_status"))).drop("by_hand")
    return state.upsert_history(history, events.filter(_SECOND_RUN), "T2").select("event_key", "first_seen", "last_seen", "score")


def match_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """A history and a run whose names differ by a few letters; every other row of the history lists days and has no start."""
    named = F.concat_ws(" ", "event_name", F.substring(F.md5(F.col("seq").cast("string")), 1, 5))
    events = state.keyed(_events(spark, sf_dir).withColumn("event_name", named))
    old = state.upsert_history(spark.createDataFrame([], schemas.text_schema(schemas.HISTORY)), events.filter("published_at < TIMESTAMP '1998-01-01'"), "T1")
    listed = F.crc32(F.col("event_key").cast("binary")) % 2 == 0
    days = F.when(listed, F.concat_ws("|", "event_start_date", F.lit("2030-01-01"))).otherwise(F.col("event_dates"))
    history = old.withColumns({"event_dates": days, "event_start_date": F.when(listed, "").otherwise(F.col("event_start_date")), "approval_status": F.when(F.substring("event_key", 1, 1) == "0", "MANUAL_CONFIRMED").otherwise(F.col("approval_status"))})
    return history, events.filter("published_at >= TIMESTAMP '1997-10-01'")


@query()
def history_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which known event a found one is, by key, else by likeness of names and first days, in order."""
    history, events = match_inputs(spark, sf_dir)
    return state.history_keys(history, events)


def stream_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table's events as found events of their users in three slices of time (now: T1 to T3); names are all the same or have no letter in common."""
    day = F.to_date("ts")
    name = F.repeat(F.char(F.from_json("props", "k int")["k"] % 10 + 97), F.lit(12))
    none = F.array().cast("array<string>")
    made = {
        "seq": F.col("event_id"), "now": F.when(day < "2024-01-11", "T1").when(day < "2024-01-21", "T2").otherwise("T3"), "artist_id": F.col("user_id").cast("string"), "activity_type": F.col("event_type"), "event_name": name, "title": name,
        "event_dates": F.array(day), "event_start_date": day, "event_end_date": day, "date_confidence": F.lit("HIGH"), "date_conflict": F.lit(False), "cities": none, "venues": none, "related_urls": none, "score": F.floor("value").cast("int"),
        "published_at": F.col("ts").cast("timestamp"), "url": F.concat(F.lit("http://e.example/"), F.col("event_id").cast("string")), "supporting_article_count": F.lit(1),
    }
    rest = ("artist", "company", "label", "date_evidence", "date_source", "schedule_status", "source_type", "original_url", "naver_url", "clipped_text", "review_reason")
    return state.keyed(table(spark, sf_dir, "events").select(*[c.alias(n) for n, c in made.items()], *[F.lit("").alias(n) for n in rest]))


_STREAM_SQL = """e AS (SELECT *, CAST(CAST(ts AS DATE) AS VARCHAR) AS d, repeat(chr(CAST(97 + CAST(json_extract(props, '$.k') AS INT) % 10 AS INT)), 12) AS name, CAST(CASE WHEN ts < DATE '2024-01-11' THEN 1 WHEN ts < DATE '2024-01-21' THEN 2 ELSE 3 END AS INT) AS slice FROM events),
keyed AS (SELECT *, substr(sha256(user_id || '|' || event_type || '|' || name || '|' || d || ':' || d || '|'), 1, 24) AS event_key, substr(sha256(user_id || '|http://e.example/' || event_id), 1, 24) AS candidate_id FROM e)"""


def _replayed(spark: SparkSession, sf_dir: str, changes: Callable[[DataFrame], DataFrame], columns: tuple[str, ...], key: str) -> DataFrame:
    """The last row of each key after the slices came one after the other, each as a run of one stream that goes on from its checkpoint."""
    base = f"{lineage.own_dir(spark)}/stream-{uuid.uuid4().hex}"
    events = stream_events(spark, sf_dir)
    for now in ("T1", "T2", "T3"):
        events.filter(F.col("now") == now).write.parquet(f"{base}/in/{now}")
        source = spark.readStream.schema(events.schema).option("recursiveFileLookup", "true").parquet(f"{base}/in")
        keyed.upsert(changes(source), f"{base}/out").trigger(availableNow=True).start().awaitTermination()
    return keyed.latest(spark, f"{base}/out", columns, key)


@query(
    f"""WITH {_STREAM_SQL}
SELECT arg_min(event_key, event_id) AS event_key, any_value(name) AS event_name, 'T' || min(slice) AS first_seen, 'T' || max(slice) AS last_seen, CAST(arg_max(CAST(floor(value) AS INT), event_id) AS VARCHAR) AS score, CAST(count(*) AS VARCHAR) AS articles,
'http://e.example/' || min(event_id) AS primary_url FROM keyed GROUP BY user_id, event_type, name"""
)
def stream_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The history as keyed state of a stream."""
    made = _replayed(spark, sf_dir, keyed.history_changes, schemas.HISTORY, "event_key")
    return made.select("event_key", "event_name", "first_seen", "last_seen", "score", F.col("supporting_article_count").alias("articles"), "primary_url")


@query(
    f"""WITH {_STREAM_SQL}
SELECT arg_min(candidate_id, event_id) AS candidate_id, event_key, 'T' || min(slice) AS first_seen, 'T' || max(slice) AS last_seen, CAST(arg_max(CAST(floor(value) AS INT), event_id) AS VARCHAR) AS score
FROM keyed WHERE event_id % 7 <> 0 GROUP BY event_key"""
)
def stream_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The review queue as keyed state of a stream; one of seven candidates was rejected before."""
    found = stream_events(spark, sf_dir)
    log = found.filter("seq % 7 = 0").select(*[(F.lit("REJECT") if c == "action" else F.col(c) if c == "candidate_id" else F.lit("")).alias(c) for c in schemas.REVIEW_LOG])
    made = _replayed(spark, sf_dir, lambda events: keyed.queue_changes(events, log), schemas.QUEUE, "candidate_id")
    return made.select("candidate_id", "event_key", "first_seen", "last_seen", "score")


@query(
    f"""WITH {_KEYS_SQL} SELECT candidate_id, event_key, o_orderkey AS seq FROM keyed WHERE o_orderkey % 7 <> 0"""
)
def reject_antijoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = state.keyed(_events(spark, sf_dir)).select("candidate_id", "event_key", "seq")
    return state.without_rejected(rows, _log(spark, sf_dir))


# The event that a decision of the document makes, and which the next one changes.
_CREATED = hashlib.sha256(b"a|CONCERT|new|2026-01-30|").hexdigest()[:24]


def _document(approved: str, rejected: str) -> str:
    """A reply whose last fenced block has all five actions; one of them builds on another."""
    items = [
        {"action": "UPDATE", "eventKey": "1", "eventName": "renamed", "activityType": "POPUP", "eventEndDate": ""},
        {"action": "delete", "eventKey": "2"},
        {"action": "CREATE", "artistId": "a", "artist": "A", "activityType": "CONCERT", "eventName": "new", "eventStartDate": "2026-01-30", "eventEndDate": "2026-02-01"},
        {"action": "APPROVE", "candidateId": approved, "artist": "Approved"},
        {"action": "UPDATE", "eventKey": _CREATED, "eventName": "newer", "eventStartDate": "2026-01-31"},
        {"action": "REJECT", "candidateId": rejected, "note": "no"},
    ]
    return "As follows.\n```json\n{}\n```\nand\n```json\n" + json.dumps({"schema": "calendar-review-v1", "decisions": items}) + "\n```\n"


def _reviewed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """History, queue and log after a document about the first two orders of the history and the first two of the queue."""
    waiting = _named(spark, sf_dir).filter("published_at < TIMESTAMP '1996-01-01'").orderBy("seq").limit(2).select("candidate_id").collect()
    document = decisions.read_document(spark, _document(*[r["candidate_id"] for r in waiting]), "calendar-review-v1")
    return decisions.apply(document, _stored(spark, sf_dir), _queue(spark, sf_dir), "T2")


_WAITING_SQL = f"""{_KEYS_SQL.replace("lower(regexp_replace(o_orderpriority,", "lower(regexp_replace(o_orderpriority || o_orderkey,")}, w AS (SELECT *, row_number() OVER (ORDER BY o_orderkey) AS nth FROM keyed WHERE o_orderdate < TIMESTAMP '1996-01-01')"""


@query(
    f"""WITH {_WAITING_SQL}, b AS (SELECT CAST(o_orderkey AS VARCHAR) AS event_key, CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE o_orderpriority END AS event_name, CASE WHEN o_orderkey % 3 > 0 THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) ELSE '' END AS event_start_date,
 CASE WHEN o_orderkey % 3 > 0 THEN '' ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) || '|' || CAST(CAST(o_orderdate AS DATE) + 9 AS VARCHAR) END AS event_dates FROM orders WHERE o_orderkey NOT IN (1, 2))
SELECT * FROM b UNION ALL SELECT substr(sha256(CAST(o_custkey AS VARCHAR) || '|POPUP|renamed|' || CAST(CAST(o_orderdate AS DATE) AS VARCHAR) || '|'), 1, 24), 'renamed', CAST(CAST(o_orderdate AS DATE) AS VARCHAR), CAST(CAST(o_orderdate AS DATE) AS VARCHAR) FROM orders WHERE o_orderkey = 1
UNION ALL SELECT substr(sha256('a|CONCERT|newer|2026-01-31|'), 1, 24), 'newer', '2026-01-31', '2026-01-31|2026-02-01'
UNION ALL SELECT substr(sha256(o_custkey || '|CONCERT|' || lower(regexp_replace(o_orderpriority || o_orderkey, '[^A-Za-z0-9]+', '', 'g')) || '|' || d || '|' || o_orderstatus), 1, 24), o_orderpriority || ' ' || o_orderkey, d, d FROM w WHERE nth = 1"""
)
def decision_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The history after decisions of all five kinds, of which one builds on another."""
    return _reviewed(spark, sf_dir)[0].select("event_key", "event_name", "event_start_date", "event_dates")


@query(f"WITH {_WAITING_SQL} SELECT candidate_id, event_key FROM w WHERE nth > 2")
def decision_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The queue after the same decisions."""
    return _reviewed(spark, sf_dir)[1].select("candidate_id", "event_key")


@query(
    f"""WITH {_WAITING_SQL}, h AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE o_orderpriority END AS name FROM orders WHERE o_orderkey IN (1, 2))
SELECT 'UPDATE' AS action, '' AS candidate_id, '1' AS event_key, 'renamed' AS event_name, '' AS note UNION ALL SELECT 'DELETE', '', '2', name, '' FROM h WHERE k = 2 UNION ALL SELECT 'CREATE', '', '', 'new', ''
UNION ALL SELECT 'APPROVE', candidate_id, event_key, o_orderpriority || ' ' || o_orderkey, '' FROM w WHERE nth = 1 UNION ALL SELECT 'UPDATE', '', '{_CREATED}', 'newer', ''
UNION ALL SELECT 'REJECT', candidate_id, event_key, o_orderpriority || ' ' || o_orderkey, 'no' FROM w WHERE nth = 2"""
)
def decision_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log of the same decisions."""
    return _reviewed(spark, sf_dir)[2].select("action", "candidate_id", "event_key", "event_name", "note")


@query(
    f"""WITH {_rules_sql("text")}, p AS (SELECT DISTINCT doc_id FROM rated WHERE activity_type <> 'OTHER'), a AS (SELECT DISTINCT doc_id FROM labels WHERE quality = 1),
h AS (SELECT count(*) FILTER (p.doc_id IS NOT NULL) AS p, count(*) FILTER (a.doc_id IS NOT NULL) AS a, count(*) FILTER (p.doc_id IS NOT NULL AND a.doc_id IS NOT NULL) AS h FROM p FULL JOIN a ON p.doc_id = a.doc_id)
SELECT p AS predicted, a AS actual, h AS hits, p - h AS false_positives, a - h AS false_negatives, CAST(CASE WHEN p = 0 THEN 0 ELSE h / p END AS DOUBLE) AS precision, CAST(CASE WHEN a = 0 THEN 0 ELSE h / a END AS DOUBLE) AS recall FROM h"""
)
def precision_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _rated(spark, sf_dir).filter("activity_type <> 'OTHER'").select(F.col("doc_id").cast("string").alias("event_key"))
    truth = table(spark, sf_dir, "labels").filter("quality = 1").select(F.col("doc_id").cast("string").alias("event_key"))
    return qa.scores(qa.compared(qa.keys(found), qa.keys(truth)))


@query(
    """WITH v AS (SELECT doc_id, CASE CAST(doc_id % 4 AS INT) WHEN 0 THEN ' =' || text WHEN 1 THEN '@' || text WHEN 2 THEN '''-' || text ELSE text END AS t FROM documents),
s AS (SELECT doc_id, t, CASE WHEN regexp_matches(t, '^[ \t\r\n]*[=+@-]') THEN '''' || t ELSE t END AS safe FROM v)
SELECT doc_id, sha256(safe) AS safe_sha256, CAST(length(CASE WHEN regexp_matches(safe, '^''[ \t\r\n]*[=+@-]') THEN substr(safe, 2) ELSE safe END) AS INT) AS restored_chars FROM s"""
)
def formula_escape(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts that a spreadsheet would run are quoted, and unquoted when read."""
    mark = F.when(F.col("doc_id") % 4 == 0, " =").when(F.col("doc_id") % 4 == 1, "@").when(F.col("doc_id") % 4 == 2, "'-").otherwise("")
    safe = table(spark, sf_dir, "documents").select("doc_id", text.formula_safe(F.concat(mark, "text")).alias("safe"))
    return safe.select("doc_id", F.sha2("safe", 256).alias("safe_sha256"), F.length(text.formula_restore("safe")).alias("restored_chars"))


@query(
    """SELECT o_orderkey AS seq, CAST(CAST(o_orderdate + INTERVAL 10 YEAR AS DATE) AS VARCHAR) AS start_date, CAST(CAST(o_orderdate + INTERVAL 10 YEAR + INTERVAL 9 DAY AS DATE) AS VARCHAR) AS end_date, CAST(10 AS INT) AS duration_days,
'일본' AS country, CAST(CASE WHEN o_orderkey % 2 = 0 THEN 1 END AS INT) AS item_count, CASE WHEN o_orderkey % 2 = 0 THEN '' ELSE '품목 수 확인 필요' END AS verify FROM orders"""
)
def popup_notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operating periods, places and articles out of notices made of orders."""
    day = F.add_months(F.to_date("o_orderdate"), 120)
    body = F.concat(F.lit("operating period "), F.date_format(day, "yyyy.MM.dd"), F.lit(" ~ "), F.date_format(F.date_add(day, 9), "yyyy.MM.dd"), F.lit(" Tokyo"), F.when(F.col("o_orderkey") % 2 == 0, " cushion").otherwise(""))
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("seq"), F.lit("BLUE popup").alias("title"), body.alias("body"))
    # a file of one row group is one task's work, and reading a notice costs much more than moving it
    rows = rows.repartition(spark.sparkContext.defaultParallelism)
    return popup.popup_rows(rows).select("seq", F.col("start_date").cast("string").alias("start_date"), F.col("end_date").cast("string").alias("end_date"), "duration_days", "country", "item_count", "verify")


@query(
    """SELECT n_nationkey, n_nationkey IN (SELECT s_nationkey FROM supplier) AS both_sides, false AS suppliers_only FROM nation WHERE n_nationkey IN (SELECT c_nationkey FROM customer)
UNION ALL SELECT n_nationkey, false, true FROM nation WHERE n_nationkey IN (SELECT s_nationkey FROM supplier) AND n_nationkey NOT IN (SELECT c_nationkey FROM customer)"""
)
def set_ops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations of customers and suppliers: union, intersection and difference."""
    c = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("n_nationkey")).distinct()
    s = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("n_nationkey")).distinct()
    both = c.intersect(s).withColumn("both_sides", F.lit(True))
    kept = c.join(both, "n_nationkey", "left").select("n_nationkey", F.coalesce("both_sides", F.lit(False)).alias("both_sides"), F.lit(False).alias("suppliers_only"))
    return kept.unionByName(s.exceptAll(c).select("n_nationkey", F.lit(False).alias("both_sides"), F.lit(True).alias("suppliers_only")))


@query()
def daily_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A whole run over titles made of orders: window, entity, classification, dates, clusters and keys."""
    titles = _dated_titles(spark, sf_dir)
    none = F.lit(None).cast("string")
    articles = titles.select(
        "seq", F.lit("S").alias("source_id"), F.lit("NEWS").alias("source_type"), F.col("artist_id").alias("searched_id"), *[none.alias(c) for c in ("artist_id", "artist", "company", "label", "matched_artist_alias")],
        "title", "body", F.concat(F.lit("http://o.example/"), F.col("seq").cast("string")).alias("url"), F.lit("").alias("original_url"), F.lit("").alias("naver_url"), F.lit("").alias("publisher"), F.lit(3).alias("publisher_score"), F.lit("").alias("search_query"),
        "published_at", "fetched_at",
    )
    entities = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("artist_id"), F.lit("c").alias("company"), F.lit("l").alias("label"), F.col("c_name").alias("name"), F.array().cast("array<string>").alias("aliases"), F.lit(False).alias("priority"), F.col("c_custkey").alias("seq"))
    history = spark.createDataFrame([], schemas.text_schema(schemas.HISTORY))
    run = daily.collect(articles, entities, history, "1998-01-01 00:00:00", daily.Settings(hours=24 * 365))
    return daily.events(run.selected).select("seq", "artist_id", "event_key", F.col("event_start_date").cast("string").alias("start"), F.col("supporting_article_count").alias("articles"))


_PLAIN_TEXTS = {"수집 채널": "'NEWS'", "회사": "'c'", "레이블": "'l'", "활동 유형": "'CONCERT'", "일정 판정": "'NEW_EVENT'", "날짜 신뢰도": "'HIGH'", "날짜 출처": "'TITLE'", "날짜 충돌": "'N'", "공식 확인": "'N'", "검증 상태": "'AUTO_SELECTED'"}
_EXPORT_SQL = _PLAIN_TEXTS | {
    "candidate_id": "candidate_id", "event_key": "event_key", "artist_id": "CAST(o_custkey AS VARCHAR)", "점수": "CAST(floor(o_totalprice) AS INT)", "매체 점수": "CAST(3 AS INT)", "게시일": "strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ')",
    "제목": "o_orderpriority", "행사명": "o_orderpriority", "이벤트 날짜": "d", "시작일": "d", "종료일": "d", "도시": "o_orderstatus", "출처 URL": "'http://o.example/' || o_orderkey", "관련 기사 수": "CAST(1 AS INT)",
}


@query("WITH " + _KEYS_SQL + " SELECT " + ", ".join(f"""{_EXPORT_SQL.get(c, "''")} AS "{c}\"""" for c in export.ARTICLE_COLUMNS) + " FROM keyed")
def selected_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Selected articles in the columns of the daily sheet."""
    return export.selected_rows(state.keyed(_events(spark, sf_dir)))


@query(
    """WITH t AS (SELECT o_orderkey AS seq, CAST(o_orderkey % 5 AS INT) AS r, n_nationkey, n_regionkey FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)
SELECT seq, CAST(n_nationkey AS VARCHAR) AS artist_id FROM t WHERE n_regionkey = r
UNION ALL SELECT t.seq, CAST(n.n_nationkey AS VARCHAR) FROM t JOIN nation n ON n.n_regionkey = 0 WHERE r = 0 AND t.n_regionkey <> 0"""
)
def official_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles of official sources, one per region, with the nations that a source speaks for and the text names; the first source speaks for all of its own where it names none."""
    nations = table(spark, sf_dir, "nation")
    entities = nations.select(F.col("n_nationkey").cast("string").alias("artist_id"), F.lit("").alias("company"), F.lit("").alias("label"), F.col("n_name").alias("name"), F.array().cast("array<string>").alias("aliases"), F.lit(False).alias("priority"), F.col("n_nationkey").cast("long").alias("seq"))
    sources = nations.groupBy("n_regionkey").agg(F.collect_list(F.col("n_nationkey").cast("string")).alias("artist_ids")).select(
        F.concat(F.lit("r"), F.col("n_regionkey").cast("string")).alias("source_id"), F.lit("s").alias("name"), F.when(F.col("n_regionkey") == 0, "artist").otherwise("company").alias("scope"), F.lit("LIVE").alias("status"), "artist_ids"
    )
    articles = _orders(spark, sf_dir).select(F.col("o_orderkey").alias("seq"), F.concat(F.lit("r"), (F.col("o_orderkey") % 5).cast("string")).alias("source_id"), F.concat(F.lit("news from "), F.initcap("n_name"), F.lit(".")).alias("title"), F.lit("").alias("body"))
    made = official.attributed(articles, official.of_sources(sources, entities), resolve.alias_table(entities, []))
    return made.select(F.col("article_seq").alias("seq"), "artist_id")


@query(
    """WITH c AS (SELECT lower(n_name) AS community, n_name AS g FROM nation), t AS (SELECT unnest(['POP-UP', 'POP UP', 'popup', '팝업', 'ポップアップ']) AS term), y AS (SELECT unnest(range(1996, 1999)) AS y),
q AS (SELECT community, 'site:n.example/' || community || '/notice intitle:"' || term || '"' AS query FROM c, t UNION ALL SELECT community, 'site:n.example/' || community || '/notice "' || term || '"' FROM c, t
 UNION ALL SELECT community, 'site:n.example/' || community || '/notice "' || g || '" "' || term || '"' FROM c, t UNION ALL SELECT community, 'site:n.example/' || community || '/notice "' || term || '" ' || y FROM c, t, y
 UNION ALL SELECT community, 'site:n.example/' || community || '/notice "' || g || '" "' || term || '" ' || y FROM c, t, y)
SELECT DISTINCT community, query FROM q"""
)
def notice_searches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Searches for pop-up notices of each nation's community, by term and year."""
    communities = table(spark, sf_dir, "nation").select(F.lower("n_name").alias("community"), F.col("n_name").alias("group_name"))
    return notices.search_queries(spark, communities, 1996, 1998, site="n.example/{community}/notice").select("community", "query")


@query(
    """SELECT page_id, CAST(page_id AS VARCHAR) AS notice_id, CASE CAST(page_id % 4 AS INT) WHEN 0 THEN 'https://n.example/c/notice/' || page_id WHEN 1 THEN 'https://n.example/c/notice/' || page_id ELSE '' END AS canonical FROM pages"""
)
def notice_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers and plain addresses of notices; other hosts and communities have none."""
    end = F.concat(F.lit("/notice/"), F.col("page_id").cast("string"), F.lit("?lang=en#top"))
    begin = F.element_at(F.array(F.lit("https://n.example/c"), F.lit("http://n.example/x/c"), F.lit("https://shop.n.example/c"), F.lit("https://n.example/d")), (F.col("page_id") % 4 + 1).cast("int"))
    rows = table(spark, sf_dir, "pages").select("page_id", F.concat(begin, end).alias("url"))
    return rows.select("page_id", notices.notice_id(F.col("url")).alias("notice_id"), notices.canonical(F.col("url"), F.lit("c"), host="n.example").alias("canonical"))


@query("""SELECT doc_id, substr(coalesce(text, ''), 1, 2500) AS body_preview FROM documents""")
def body_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return notices.preview(table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("body")))


# How a day d is written, and what day that is, by kind; b is the day from which it is read.
_FREE_DATES = (
    ("date_format(d, 'MMMM d, yyyy')", "d"), ("date_format(d, 'd MMM yyyy')", "d"), ("date_format(d, \"EEEE, MMMM d yyyy 'at' 10:30\") || ' am'", "d"), ("date_format(d, 'MMM d') || 'th'", "make_date(year(b), month(d), day(d))"),
    ("date_format(d, 'M/d/yyyy')", "d"), ("datediff(b, d) || ' days ago'", "d"), ("date_format(d, 'yyyy-MM-dd') || ' 23:59'", "d"), ("'in 3 weeks'", "b + 21"), ("'Yesterday'", "b - 1"), ("'an hour ago'", "b"),
    ("date_format(d, \"yyyy'년 'M'월 'd'일'\")", "d"), ("date_format(d, \"M'월 'd'일 (토)'\")", "make_date(year(b), month(d), day(d))"), ("date_format(d, \"yy'년 'M'월 'd'일 오후 3시'\")", "d"), ("datediff(b, d) || '일 전'", "d"), ("'어제'", "b - 1"),
    ("date_format(d, 'yyyy. M. d.')", "d"), ("'3주 후'", "b + 21"), ("'26시간 전'", "b - 1"), ("'모레'", "b + 2"),
    ("date_format(d, \"yyyy'年'M'月'd'日'\")", "d"), ("date_format(d, \"M'月'd'日(土)'\")", "make_date(year(b), month(d), day(d))"), ("datediff(b, d) || '日前'", "d"), ("'明日'", "b + 1"), ("'1週間前'", "b - 7"),
    ("'平成' || (year(d) - 1988) || date_format(d, \"'年'M'月'd'日 10時'\")", "d"), ("'本日'", "b"), ("'2か月前'", "CAST(b - INTERVAL 2 MONTH AS DATE)"),
    ("'not a date, March'", "NULL"), ("'31 June 2026'", "NULL"), ("date_format(d, 'yyyy') || '-13-01'", "NULL"), ("''", "NULL"),
)


@query(
    f"""WITH o AS (SELECT o_orderkey AS seq, CAST(o_orderdate AS DATE) AS d, CAST(o_orderdate AS DATE) + CAST(2 + o_orderkey % 5 AS INT) AS b FROM orders)
SELECT seq, CAST(CAST(CASE CAST(seq % {len(_FREE_DATES)} AS INT) {" ".join(f"WHEN {i} THEN {day}" for i, (_, day) in enumerate(_FREE_DATES))} END AS DATE) AS VARCHAR) AS day FROM o"""
)
def free_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order dates written in ten ways or so in each of three languages, read back."""
    d = F.to_date("o_orderdate")
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("seq"), d.alias("d"), F.date_add(d, (F.col("o_orderkey") % 5 + 2).cast("int")).alias("b"))
    said = F.element_at(F.array(*[F.expr(text_) for text_, _ in _FREE_DATES]), (F.col("seq") % len(_FREE_DATES) + 1).cast("int"))
    noon = F.timestamp_seconds(F.unix_timestamp(F.col("b").cast("timestamp")) + 43_200)
    return rows.select("seq", said.alias("said"), noon.alias("base")).select("seq", freedates.free_date(F.col("said"), F.col("base")).cast("string").alias("day"))


@query()
def html_selected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first link of every node that a source's selectors choose, with the node's text and day."""
    made = selectors.items(table(spark, sf_dir, "pages").select("page_id", "url", "html"), selectors=SELECTORS, link=".", least=2)
    return made.select("page_id", "place", "url", "title", F.sha2("body", 256).alias("body_sha256"), F.col("day").cast("string").alias("day"))


@query("""SELECT o_orderkey AS seq, CASE WHEN o_orderkey % 4 = 3 THEN NULL ELSE CAST(CAST(o_orderdate + INTERVAL 10 YEAR AS DATE) AS VARCHAR) END AS day FROM orders""")
def page_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first full date that a page's text names."""
    at = F.add_months(F.to_date("o_orderdate"), 120)
    forms = [F.date_format(at, "'on 'yyyy.M.d', not 2001-01-01'"), F.date_format(at, "yyyy-MM-dd"), F.date_format(at, "'No. 17 'yyyy/M/d"), F.lit("17 May, 30.02.")]
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("seq"), F.element_at(F.array(*forms), (F.col("o_orderkey") % 4 + 1).cast("int")).alias("said"))
    return rows.select("seq", html.day_of(F.col("said")).cast("string").alias("day"))


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
