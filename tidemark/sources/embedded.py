"""Titles and texts that pages carry inside their scripts, and notices read from pages with these as fallback.

Scripts that say they are JSON are parsed and walked: every string that stands under a key of an
object, at whatever depth, in the order of the document. Other scripts, and those that do not parse,
are searched as text by regular expressions in the JVM, which find pairs of a JSON key and a string
at every depth. Strings are decoded once. Repetitions are possessive, so long strings cost neither
stack nor rescans.
"""

from __future__ import annotations

import html
import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import collapse, filled, find_all, let, strip_tags
from ..operators.popup import clean_title
from .html import parsed

# Keys whose strings are titles or texts, marks of a text under any key, and titles of an empty shell.
TITLE_KEYS = ("title", "subject", "name", "noticeTitle", "notice_title", "postTitle", "post_title")
TEXT_KEYS = ("body", "content", "contents", "description", "text", "message", "noticeBody", "notice_body", "postBody", "post_body")
MARKS = r"(?iuU)(pop\s*[-–—]?\s*up|팝업|ポップアップ|운영\s*기간|DATE\s*:|LOCATION\s*:|Operating\s+Period|Event\s+Period|開催期間|場所)"
SHELL_TITLES = ("global fandom platform", "weverse")
BEFORE, AFTER = 1200, 2400

_SCRIPT = r"(?is)<script\b([^>]*+)>(.*?)</script"
_PAIR = r'(?s)"([^"\\]++)"\s*+:\s*+"((?:[^"\\]|\\.)*+)"'
# How a script says that it is JSON.
_JSON = r"""(?i)\b(type\s*=\s*["']?application/(ld\+)?json["'\s]?|id\s*=\s*["']?__(NEXT|NUXT)_DATA__)"""


def is_shell_title(title: Column, shells: tuple[str, ...] = SHELL_TITLES) -> Column:
    """True for an empty title and for one that says only whose site it is."""
    bare = F.regexp_replace(F.lower(collapse(filled(title))), r"^[ |_-]+|[ |_-]+$", "")
    return (bare == "") | bare.startswith(shells[0]) | bare.isin(*shells[1:])


def _decoded(raw: Column) -> Column:
    """The value of a JSON string; as it stands where its escapes are wrong."""
    return F.coalesce(F.from_json(F.concat(F.lit('["'), raw, F.lit('"]')), "array<string>")[0], raw)


def _cleaned(values: Column) -> Column:
    """White space collapsed; blank and repeated values left out; the first of each stays."""
    return F.array_distinct(F.filter(F.transform(values, collapse), lambda v: v != ""))


def _unescaped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """HTML entities of all values decoded (a step of its own, as Spark runs no UDF over lambdas)."""
    for batch in batches:
        decoded = [pa.array([[html.unescape(v) for v in values] for values in c.to_pylist()], pa.list_(pa.string())) for c in batch.columns[1:]]
        yield pa.RecordBatch.from_arrays([batch.column(0), *decoded], names=batch.schema.names)


def walk(text: str) -> list[tuple[str, str]] | None:
    """Key and value of every string under a key of a JSON document, in its order; null if it is none."""
    try:
        open_ = [("", json.loads(text))]
    except (ValueError, RecursionError):
        return None
    out = []
    while open_:
        key, value = open_.pop()
        if isinstance(value, str):
            out.append((key, value))
        elif isinstance(value, dict):
            open_ += reversed(value.items())
        elif isinstance(value, list):
            # strings of a list stand under no key
            open_ += [(key, v) for v in reversed(value) if isinstance(v, (dict, list))]
    return [(k, v.encode("utf-8", "replace").decode("utf-8")) for k, v in out if k]


_WALKED = "page_id long, scripts array<struct<json:boolean,text:string>>, walked array<array<struct<key:string,value:string>>>"


def _walked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What is found in each script that is JSON; null for the others."""
    kind = pa.list_(pa.list_(pa.struct([("key", pa.string()), ("value", pa.string())])))
    for batch in batches:
        pages = batch.column(1).to_pylist()
        found = [[[{"key": k, "value": v} for k, v in got] if s["json"] and (got := walk(s["text"])) is not None else None for s in scripts] for scripts in pages]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, kind)], names=["page_id", "scripts", "walked"])


def script_texts(pages: DataFrame, *, shells: tuple[str, ...] = SHELL_TITLES) -> DataFrame:
    """page_id, titles, texts: what stands inside each page's scripts, each value once, in the page's order; null pages have none.

    Texts are the strings under the text keys and those with a mark under any key; then, from
    scripts without any such pair, the surroundings of each mark.
    """
    whole = filled("html")
    attributes, bodies = (F.regexp_extract_all(whole, F.lit(_SCRIPT), F.lit(g)) for g in (1, 2))
    scripts = F.transform(F.arrays_zip(attributes.alias("a"), bodies.alias("b")), lambda s: F.struct(s["a"].rlike(_JSON).alias("json"), s["b"].alias("text")))
    opened = pages.select(F.col("page_id").cast("long").alias("page_id"), scripts.alias("scripts")).mapInArrow(_walked, _WALKED)

    def pairs(script: Column) -> Column:
        keys, values = (F.regexp_extract_all(script, F.lit(_PAIR), F.lit(g)) for g in (1, 2))
        return F.transform(F.arrays_zip(keys.alias("key"), values.alias("raw")), lambda p: F.struct(p["key"].alias("key"), _decoded(p["raw"]).alias("value")))

    def texts(script: Column, found: Column) -> Column:
        told = F.filter(found, lambda p: p["key"].isin(*TEXT_KEYS) | p["value"].rlike(MARKS))
        near = F.transform(find_all(script, MARKS), lambda m: F.substring(script, F.greatest(m["from"] - BEFORE, F.lit(0)) + 1, m["to"] + AFTER - F.greatest(m["from"] - BEFORE, F.lit(0))))
        none = F.array().cast("array<string>")
        return F.when(F.size(told) > 0, F.transform(told, lambda p: p["value"])).when(script.rlike(MARKS), near).otherwise(none)

    def titles(found: Column) -> Column:
        return F.transform(F.filter(found, lambda p: p["key"].isin(*TITLE_KEYS)), lambda p: p["value"])

    def plain(part: str) -> Column:
        return F.transform(F.flatten(F.transform("read", lambda r: r[part])), strip_tags)

    both = F.arrays_zip("scripts", "walked")
    read = F.transform(both, lambda s: let(F.coalesce(s["walked"], pairs(s["scripts"]["text"])), lambda found: F.struct(titles(found).alias("titles"), texts(s["scripts"]["text"], found).alias("texts"))))
    raw = opened.select("page_id", read.alias("read")).select("page_id", plain("titles").alias("titles"), plain("texts").alias("texts"))
    made = raw.mapInArrow(_unescaped, "page_id long, titles array<string>, texts array<string>")
    return made.select("page_id", F.filter(_cleaned(F.col("titles")), lambda t: ~is_shell_title(t, shells)).alias("titles"), _cleaned(F.col("texts")).alias("texts"))


def notices(pages: DataFrame, *, shells: tuple[str, ...] = SHELL_TITLES) -> DataFrame:
    """page_id, url, title, body, method of every page.

    The title is the first of the declared, the heading and the script titles that is no shell
    title; the body is the visible text and the script texts. method: ``html``,
    ``html+script_json`` where scripts gave anything, ``shell_only`` where nothing but a shell came.
    pages: page_id, url, html; page_id is unique.
    """
    hidden = script_texts(pages, shells=shells).withColumnsRenamed({"titles": "_titles", "texts": "_texts"})
    read = parsed(pages).select("page_id", "url", "title", "text").join(hidden, "page_id")
    named = F.concat(F.array(F.col("title")), F.col("_titles"))
    good = F.filter(F.transform(named, clean_title), lambda t: ~is_shell_title(t, shells))
    title = F.coalesce(F.get(good, F.lit(0)), clean_title(F.col("title")))
    visible = F.when(is_shell_title(F.col("text"), shells), "").otherwise(F.col("text"))
    body = collapse(F.concat_ws(" ", visible, F.array_join("_texts", " ")))
    method = F.when(is_shell_title(title, shells) & (body == ""), "shell_only").when(F.size("_titles") + F.size("_texts") > 0, "html+script_json").otherwise("html")
    return read.select("page_id", "url", title.alias("title"), body.alias("body"), method.alias("method"))


def with_search(found: DataFrame, *, title_col: str = "search_title", body_col: str = "search_body", shells: tuple[str, ...] = SHELL_TITLES) -> DataFrame:
    """Fills a shell's title and body from the search result that led to the page, and appends a snippet the body lacks; method says so."""
    said, snippet = clean_title(F.col(title_col)), strip_tags(filled(body_col))
    title_gone = is_shell_title(F.col("title"), shells) & (said != "")
    body_gone = is_shell_title(F.col("body"), shells) & (F.concat(said, snippet) != "")
    appended = ~body_gone & (snippet != "") & ~F.contains(F.col("body"), snippet)
    body = F.when(body_gone, collapse(F.concat_ws(" ", said, snippet))).when(appended, collapse(F.concat_ws(" ", F.col("body"), snippet))).otherwise(F.col("body"))
    steps = F.concat(F.when(title_gone, "+search_title").otherwise(""), F.when(body_gone, "+search_body").when(appended, "+search_append").otherwise(""))
    return found.withColumns({"title": F.when(title_gone, said).otherwise(F.col("title")), "body": body, "method": F.concat(F.col("method"), steps)})
