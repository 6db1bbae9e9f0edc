"""Best-fit packing of tokenised documents into sequences of a fixed length.

Pattern packing: the histogram of piece lengths (at most ``capacity`` numbers, whatever the size
of the input) goes to the driver. There, few-document patterns of lengths that fill a sequence
are enumerated, their repeat counts are fitted to the histogram by non-negative least squares
and rounded, and what is left is packed best-fit in order of falling length, whole lengths at a
time. The result is a table of runs (length, from the k-th piece of that length, how many, first
sequence, offset) whose size depends on ``capacity`` only. Each piece then looks up its place by
its length and its number among the pieces of that length.

Pieces are numbered without a hot task: they are spread over (length, bucket), counted, and
numbered inside a bucket from the running sum of the counts.

Defined cases: null text counts as empty; an empty text is one piece that holds the end id; rows
that repeat are packed as often as they stand; ties are broken by doc_id and piece; doc_id keeps
its type; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import functools
import json
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._spark import cut, text_of

CAPACITY = 2048
BUCKETS = 256
#: Patterns whose waste is at most this share of a sequence are tried.
WASTE = 0.004
ROUNDS = 400

#: Lengths tried at each place of a pattern of two and of three documents before the one that closes it; they bound the plan's work, whatever the input.
TWO, THREE = (512, 48), (64, 24, 24)

_PIECES = (pa.int32(), pa.int64(), pa.int64(), pa.int64())


def _byte_of_symbol() -> dict[str, int]:
    """Byte-level vocabularies write each byte as one printable character; the others follow from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}


@functools.lru_cache(maxsize=2)
def tokenizer(path: str):
    """Text to ids, as the tokenizers library encodes with the file, without adding special tokens.

    The file's vocabulary is byte-level and its ids are its merge ranks, so tiktoken's merge loop
    gives the same ids faster; texts that hold one of the file's added tokens go through the
    tokenizers library itself.
    """
    import tiktoken
    from tokenizers import Tokenizer

    spec = json.loads(open(path, encoding="utf-8").read())
    added = [t["content"] for t in spec["added_tokens"]]
    byte = _byte_of_symbol()
    ranks = {bytes(byte[c] for c in symbol): i for symbol, i in spec["model"]["vocab"].items() if symbol not in added}
    import public_tokenizers

    fast = tiktoken.Encoding("pieces", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    slow = Tokenizer.from_file(path)

    def encode(text: str) -> np.ndarray:
        ids = slow.encode(text, add_special_tokens=False).ids if any(t in text for t in added) else fast.encode_ordinary(text)
        return np.array(ids, dtype="<u4")

    return encode


def pieces(docs: DataFrame, tokenizer_path: str, *, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end_id: int = 0) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32: each document's ids and the end id, cut from the back into pieces of ``capacity``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokenizer(tokenizer_path)
        for batch in batches:
            rows: list[tuple] = []
            owner: list[int] = []
            for i, text in enumerate(batch.column(1)):
                ids = np.append(encode(text.as_py()), np.uint32(end_id)).astype("<u4")
                first = len(ids) % capacity or capacity
                starts = [0, *range(first, len(ids), capacity)]
                for n, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids)])):
                    owner.append(i)
                    rows.append((n, a, b - a, zlib.crc32(ids[a:b].tobytes())))
            if rows:
                columns = [pa.array(c, t) for c, t in zip(zip(*rows), _PIECES)]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(owner)), *columns], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, piece int, start long, length long, ids_crc32 long")


def patterns(lengths: np.ndarray, capacity: int, two: tuple[int, int] = TWO, three: tuple[int, int, int] = THREE) -> np.ndarray:
    """Multisets of two to four of the lengths that nearly fill a sequence, one a row, zeros to the right."""
    slack = int(capacity * WASTE)

    def closing(fixed: np.ndarray) -> np.ndarray:
        """Adds to each row the largest length that still fits; keeps what wastes little."""
        room = capacity - fixed.sum(1)
        at = np.searchsorted(lengths, room, side="right") - 1
        last = np.where(at >= 0, lengths[np.maximum(at, 0)], 0)
        good = (at >= 0) & (room - last <= slack) & (room >= 0)
        made = np.zeros((good.sum(), 4), dtype=np.int64)
        made[:, : fixed.shape[1]] = fixed[good]
        made[:, fixed.shape[1]] = last[good]
        return made

    def spread(values: np.ndarray, n: int) -> np.ndarray:
        return values[np.unique(np.linspace(0, len(values) - 1, min(n, len(values))).astype(int))]

    fixed = [np.stack(np.meshgrid(*[spread(lengths, n) for n in tried], indexing="ij"), -1).reshape(-1, len(tried)) for tried in (two, three)]
    rows = np.concatenate([closing(x) for x in (lengths[:, None], *fixed)])
    return np.unique(-np.sort(-rows, axis=1), axis=0)


def repeats(rows: np.ndarray, histogram: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Non-negative least squares of the histogram by the patterns, by multiplicative steps, which keep every count positive."""
    used = np.zeros((len(rows), 4)) + (rows > 0)
    sums = lambda x: np.bincount(rows.ravel(), weights=(x[:, None] * used).ravel(), minlength=len(histogram))
    back = lambda y: (y[rows] * used).sum(1)
    x = np.full(len(rows), histogram.sum() / max(1.0, used.sum()))
    pull = back(histogram)
    for _ in range(rounds):
        x *= pull / (back(sums(x)) + 1e-9)
    return x


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> tuple[np.ndarray, int]:
    """Runs (length, k, count, sequence, offset), sorted by length and k, and the number of sequences."""
    left = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in histogram.items():
        left[length] = n
    taken = np.zeros_like(left)
    runs: list[tuple[int, int, int, int, int]] = []
    sequences = 0

    def place(length: int, n: int, sequence: int, offset: int) -> None:
        runs.append((length, int(taken[length]), n, sequence, offset))
        taken[length] += n
        left[length] -= n

    room: dict[int, list[tuple[int, int]]] = {}
    if n := int(left[capacity]):
        place(capacity, n, 0, 0)
        sequences = n
    lengths = np.flatnonzero(left)
    rows = patterns(lengths, capacity) if len(lengths) else np.zeros((0, 4), dtype=np.int64)
    if len(rows):
        fitted = repeats(rows, left.astype(float))
        for i in np.argsort(-fitted, kind="stable"):
            if (m := int(round(fitted[i]))) < 1:
                break
            own, counts = np.unique(rows[i][rows[i] > 0], return_counts=True)
            if (m := min(m, int((left[own] // counts).min()))) < 1:
                continue
            offset = 0
            for length in rows[i][rows[i] > 0].tolist():
                place(length, m, sequences, offset)
                offset += length
            if offset < capacity:
                room.setdefault(capacity - offset, []).append((sequences, m))
            sequences += m
    for length in np.flatnonzero(left)[::-1].tolist():
        while n := int(left[length]):
            fits = [r for r in room if r >= length]
            if not fits:
                each = min(n, capacity // length)
                m = n // each
                for j in range(each):
                    place(length, m, sequences, j * length)
                if rest := capacity - each * length:
                    room.setdefault(rest, []).append((sequences, m))
                sequences += m
                continue
            tight = min(fits)
            first, held = room[tight].pop()
            m = min(n, held)
            place(length, m, first, capacity - tight)
            if held > m:
                room[tight].append((first + m, held - m))
            if not room[tight]:
                del room[tight]
            if rest := tight - length:
                room.setdefault(rest, []).append((first, m))
    made = np.array(sorted(runs), dtype=np.int64).reshape(-1, 5)
    return made, sequences


def numbered(rows: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """Adds k, the number of a piece among those of its length, from 0 without gaps."""
    dealt = rows.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(buckets)))
    counts = dealt.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    bases = counts.select("length", "bucket", before.alias("base"))
    inside = F.row_number().over(Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "start"))
    return dealt.withColumn("inside", inside).join(bases, ["length", "bucket"]).select(*rows.columns, (F.col("base") + F.col("inside") - 1).alias("k"))


def pack(docs: DataFrame, tokenizer_path: str, *, capacity: int = CAPACITY, **columns) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    cuts = cut(pieces(docs, tokenizer_path, capacity=capacity, **columns))
    histogram = {r["length"]: r["count"] for r in cuts.groupBy("length").count().collect()}  # at most `capacity` rows
    runs, _ = plan(histogram, capacity)
    starts = (runs[:, 0] << 44) + runs[:, 1]

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, k: pd.Series) -> pd.DataFrame:
        at = np.searchsorted(starts, (length.to_numpy() << 44) + k.to_numpy(), side="right") - 1
        return pd.DataFrame({"sequence_id": runs[at, 3] + k.to_numpy() - runs[at, 1], "offset": runs[at, 4]})

    placed = numbered(cuts).withColumn("place", place("length", "k"))
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", "place.sequence_id", "place.offset")
