"""Byte-level BPE encoding and decoding by overlapping chunks.

Texts are cut into chunks that overlap; the chunks are dealt over the cluster and pre-tokenised in
parallel. Neighbours are stitched where their pre-token boundaries agree: the pattern looks ahead
but never back, so from a boundary that both have found on, both read the same pre-tokens. A cut is
taken only at a boundary before a plain space that follows a character which is not a space, so
that a piece reads alone as it reads in its text. Where two neighbours meet depends on the two
alone, so each pair is stitched by itself, and each piece is encoded in a task of its own; counts
and ids are then put together in the order of the pieces, and decoding concatenates the raw bytes
of the ids. That is done for every text. Texts of up to one ``CHUNK`` are cut into chunks of ``INNER``
characters, stitched and encoded piece by piece inside the task that reads them, without a shuffle;
the chunks of longer ones are dealt over the cluster.

Chunks between which there is no meeting point (inside one very long word) are encoded as one piece.

Defined cases: null text counts as empty and has no ids; equal texts get equal ids; equal long
texts are chunked once; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import base64
import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._spark import cut, text_of

CHUNK = 32_768
OVERLAP = 512
#: Characters and overlap of chunks inside a task.
INNER, INNER_OVERLAP = 1_024, 128
#: Boundaries this near to a chunk's end may move when more text follows (the longest look-ahead is two characters).
MARGIN = 3
#: Chunks that are encoded at once.
PART = 16


@functools.lru_cache(maxsize=2)
def encoding(path: str, pattern: str):
    """tiktoken's encoder for a file of ranks."""
    import tiktoken

    ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, open(path, "rb"))}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


@functools.lru_cache(maxsize=2)
def _pretokens(pattern: str):
    import regex

    return regex.compile(pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))


def boundaries(chunk: str, pattern: str) -> np.ndarray:
    """Positions in a chunk at which a pre-token starts."""
    return np.fromiter((m.start() for m in _pretokens(pattern).finditer(chunk)), dtype=np.int32)


def stops(text: str, starts: np.ndarray, chunk: int) -> list[int]:
    """The boundaries in a chunk's overlap with the next one at which it could be cut."""
    mine = starts[(starts > chunk) & (starts < len(text) - MARGIN)]
    return [p for p in mine.tolist() if text[p] == " " and not text[p - 1].isspace()]


def encode(text: str, encoder) -> list[int]:
    return encoder.encode_ordinary(text)


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A few chunks at a time, so that the ids of one part are all that is held."""
    for batch in batches:
        for i in range(0, batch.num_rows, PART):
            yield batch.slice(i, PART)


def pieces(text: str, pattern: str, *, chunk: int = INNER, overlap: int = INNER_OVERLAP) -> list[str]:
    """A text cut where the pre-tokens of neighbouring chunks agree; joined, the pieces are the text."""
    count = max(0, (len(text) - overlap - 1) // chunk) + 1
    parts = [text[n * chunk : (n + 1) * chunk + overlap] for n in range(count)]
    if count == 1:
        return parts
    found = [boundaries(p, pattern) for p in parts]
    cuts = [0]
    for n, (own, mine, following) in enumerate(zip(parts, found, found[1:])):
        head = set((following[following < overlap] + chunk).tolist())
        stop = next((p for p in stops(own, mine, chunk) if p in head), None)
        if stop is not None:
            cuts.append(n * chunk + stop)
    return [text[a:b] for a, b in zip(cuts, [*cuts[1:], len(text)])]


def _whole(rows: DataFrame, path: str, pattern: str, *, chunk: int = INNER, overlap: int = INNER_OVERLAP) -> DataFrame:
    """Digests of texts that are chunked, stitched and encoded where they are read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoding(path, pattern)
        numerals = [str(i) for i in range(encoder.n_vocab)]

        def digest(text: str) -> tuple[int, str, str]:
            ids = [encode(p, encoder) for p in pieces(text, pattern, chunk=chunk, overlap=overlap)]
            said = ",".join([numerals[i] for own in ids for i in own]).encode()
            raw = b"".join([encoder.decode_bytes(own) for own in ids])
            return sum(map(len, ids)), hashlib.sha256(said).hexdigest(), hashlib.sha256(raw).hexdigest()

        for batch in batches:
            made = [digest(t.as_py()) for t in batch.column(1)]
            columns = [pa.array([m[i] for m in made], t) for i, t in enumerate((pa.int64(), pa.string(), pa.string()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return rows.select("doc_id", "text").mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def encoded_pieces(texts: DataFrame, path: str, pattern: str, *, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """key, piece, n_tokens, ids (decimal, joined by commas), raw (decoded bytes) of distinct texts key, text, a row per piece."""
    numbers = F.sequence(F.lit(0), F.greatest(F.lit(0), F.floor((F.length("text") - overlap - 1) / chunk)).cast("int"))
    last = F.size(numbers) - 1
    cuts = F.transform(numbers, lambda n: F.struct(n.alias("n"), (n == last).alias("last"), F.substr(F.col("text"), n * chunk + 1, F.lit(chunk + overlap)).alias("chunk")))
    dealt = texts.select("key", F.explode(cuts).alias("c")).select("key", "c.*").repartition("key", "n")

    def pretokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _parts(batches):
            texts = batch.column(3).to_pylist()
            found = [boundaries(t, pattern) for t in texts]
            columns = [[stops(t, s, chunk) for t, s in zip(texts, found)], [(s[s < overlap] + chunk).tolist() for s in found]]
            yield pa.RecordBatch.from_arrays([*batch.columns, *[pa.array(c, pa.list_(pa.int32())) for c in columns]], names=["key", "n", "last", "chunk", "stops", "head"])

    parsed = cut(dealt.mapInArrow(pretokenise, "key string, n int, last boolean, chunk string, stops array<int>, head array<int>"))
    # where a chunk and the next one agree; no text takes part
    heads = parsed.filter("n > 0").select("key", (F.col("n") - 1).alias("n"), "head")
    met = cut(parsed.filter("NOT last").select("key", "n", "stops").join(heads, ["key", "n"]).select("key", "n", F.array_min(F.array_intersect("stops", "head")).alias("stop")))
    before = met.select("key", (F.col("n") + 1).alias("n"), (F.col("stop") - chunk).alias("start"))
    placed = parsed.select("key", "n", "last", "chunk").join(met, ["key", "n"], "left").join(before, ["key", "n"], "left")
    # chunks between which there is no meeting point are one piece; a row per chunk, without its text, is numbered
    runs = before.withColumn("piece", F.max(F.when(F.col("start").isNotNull(), F.col("n"))).over(Window.partitionBy("key").orderBy("n"))).select("key", "n", F.coalesce("piece", F.lit(0)).alias("piece"))
    upto = F.when(F.col("last"), F.length("chunk")).otherwise(F.coalesce("stop", F.lit(chunk)))
    own = F.substr(F.col("chunk"), F.coalesce("start", F.lit(0)) + 1, upto - F.coalesce("start", F.lit(0)))
    parts = placed.join(runs, ["key", "n"], "left").select("key", F.coalesce("piece", F.lit(0)).alias("piece"), "n", own.alias("part"))
    pieces = parts.groupBy("key", "piece").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", "part"))), lambda p: p["part"]), "").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoding(path, pattern)
        numerals = [str(i) for i in range(encoder.n_vocab)]
        for batch in _parts(batches):
            found = [encode(t.as_py(), encoder) for t in batch.column(2)]
            said, raw = [",".join([numerals[i] for i in ids]) for ids in found], [encoder.decode_bytes(ids) for ids in found]
            columns = [pa.array([len(ids) for ids in found], pa.int64()), pa.array(said), pa.array(raw, pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], names=["key", "piece", "n_tokens", "ids", "raw"])

    return pieces.mapInArrow(run, "key string, piece int, n_tokens long, ids string, raw binary")


def digests(docs: DataFrame, path: str, pattern: str, *, id_col: str = "doc_id", text_col: str = "text", chunk: int = CHUNK, overlap: int = OVERLAP, inner: tuple[int, int] = (INNER, INNER_OVERLAP)) -> DataFrame:
    """Per document: doc_id, n_tokens, ids_sha256 and, from the decoded ids, decoded_sha256."""
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    several = F.length("text") > chunk + overlap
    keyed = rows.filter(several).withColumn("key", F.sha2("text", 256))
    texts = keyed.groupBy("key").agg(F.first("text").alias("text"))
    encoded = encoded_pieces(texts, path, pattern, chunk=chunk, overlap=overlap)
    ordered = encoded.groupBy("key").agg(F.sum("n_tokens").alias("n_tokens"), F.array_sort(F.collect_list(F.struct("piece", "ids", "raw"))).alias("own"))
    joined = F.array_join(F.transform("own", lambda p: p["ids"]), ",")
    raw = F.array_join(F.transform("own", lambda p: p["raw"].cast("string")), "")
    whole = ordered.select("key", "n_tokens", F.sha2(joined, 256).alias("ids_sha256"), F.sha2(raw, 256).alias("decoded_sha256"))
    stitched = keyed.select("doc_id", "key").join(whole, "key").drop("key")
    return _whole(rows.filter(~several), path, pattern, chunk=inner[0], overlap=inner[1]).unionByName(stitched)
