"""Pages over HTTP, many partitions at a time; a failure is a value of the row, never of the task."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from urllib.error import HTTPError
from urllib.request import Request, urlopen

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TIMEOUT, DELAY = 20.0, 0.0
AGENT = "Mozilla/5.0 (compatible; tidemark)"

Answer = tuple[int, str, str]


def get(url: str, timeout: float = TIMEOUT) -> Answer:
    """Status, text and error of one request: the text is empty where the error is not; status 0 means that nothing answered."""
    try:
        with urlopen(Request(url, headers={"User-Agent": AGENT}), timeout=timeout) as answer:
            return answer.status, answer.read().decode(answer.headers.get_content_charset() or "utf-8", "replace"), ""
    except HTTPError as error:
        return error.code, "", f"HTTPError: {error.code} {error.reason}"
    except Exception as error:  # whatever it is, the row says so
        return 0, "", f"{type(error).__name__}: {error}"


def fetched(urls: DataFrame, *, url_col: str = "url", timeout: float = TIMEOUT, delay: float = DELAY, fetch: Callable[[str, float], Answer] = get) -> DataFrame:
    """The input's rows with http_status, html and fetch_error. Requests of one partition follow each other, ``delay`` seconds apart."""
    own = urls.drop("http_status", "html", "fetch_error")
    names, at = own.columns, own.columns.index(url_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):  # a page a batch: pages are large
                url = batch.column(at)[i].as_py()
                status, text, error = fetch(url, timeout) if url else (0, "", "no address")
                if delay:
                    time.sleep(delay)
                made = [pa.array([status], pa.int32()), pa.array([text]), pa.array([error])]
                yield pa.RecordBatch.from_arrays([*batch.slice(i, 1).columns, *made], names=[*names, "http_status", "html", "fetch_error"])

    return own.mapInArrow(run, ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in own.schema] + ["http_status int", "html string", "fetch_error string"]))


def with_details(listed: DataFrame, *, parse: Callable[[DataFrame], DataFrame], **settings) -> DataFrame:
    """Listed links (page_id, url, title) with the text and the date of their own pages; a page that fails leaves both null."""
    pages = fetched(listed.select(F.col("url").alias("detail_url")).distinct(), url_col="detail_url", **settings)
    read = parse(pages.select(F.xxhash64("detail_url").alias("page_id"), F.col("detail_url").alias("url"), "html"))
    details = read.filter(F.col("text") != "").select(F.col("url").alias("detail_url"), F.col("text").alias("detail"), F.col("published").alias("detail_published"))
    return listed.join(details, F.col("url") == F.col("detail_url"), "left").drop("detail_url")
