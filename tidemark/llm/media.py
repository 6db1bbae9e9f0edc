"""Media columns: bytes stored as FLAC, read back frame by frame.

``store`` turns text into a FLAC stream per row, ``load`` decodes the streams (Rice residuals,
fixed and quantised linear predictors), checks the frames' and streams' checksums and computes
features, and ``pcm_blocks`` writes decoded PCM as rows with their sample offsets, so that a range
of samples is a filter.

Defined cases: null text counts as empty, and an empty text is one block of 255s; equal texts give
equal streams; long texts are coded about a thousand blocks at a time; a damaged stream fails the
task with the reason; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import flac
from ._spark import text_of

#: Payload bytes that are coded at once.
SLICE = 1 << 20


def payload(text: str) -> bytes:
    """UTF-8, filled with 255 (no byte of UTF-8) to a positive multiple of the block."""
    raw = text.encode("utf-8")
    return raw + b"\xff" * (-len(raw) % flac.BLOCK if raw else flac.BLOCK)


def _slices(values: Iterable[bytes], limit: int) -> Iterator[list[bytes]]:
    """Runs of values of about ``limit`` bytes; only one run is held."""
    held, size = [], 0
    for value in values:
        held.append(value)
        size += len(value)
        if size >= limit:
            yield held
            held, size = [], 0
    if held:
        yield held


def store(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lpc_order: int = 4) -> DataFrame:
    """doc_id, media: the FLAC stream."""
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for own in _slices((payload(t.as_py()) for t in batch.column(1)), SLICE):
                made = pa.array(flac.write_streams(own, lpc_order), pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(own)), made], names=["doc_id", "media"])
                at += len(own)

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, media binary")


def features(payload: bytes) -> str:
    """Of the decoded samples: their mean, root mean square and changes of sign per sample, in thousandths."""
    x = np.frombuffer(payload, dtype=np.uint8).astype(np.int64) - 128
    turns = int(((x[1:] < 0) != (x[:-1] < 0)).sum())
    return f"mean={round(1000 * float(x.mean()))};rms={round(1000 * float(np.sqrt((x * x).mean())))};turns={round(1000 * turns / len(x))}"


def load(media: DataFrame, *, id_col: str = "doc_id", media_col: str = "media") -> DataFrame:
    """What the stored streams hold: doc_id, n_bytes, payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256, feature."""
    rows = media.select(F.col(id_col).alias("doc_id"), F.col(media_col).alias("media"))
    names = ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]
    types = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for own in _slices((m.as_py() for m in batch.column(1)), SLICE):
                made = [
                    (len(p.rstrip(b"\xff")), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-32:]), len(m), hashlib.sha256(m).hexdigest(), features(p))
                    for m, p in zip(own, flac.read_streams(own))
                ]
                columns = [pa.array(c, t) for c, t in zip(zip(*made), types)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(own)), *columns], names=names)
                at += len(own)

    said = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"
    return rows.mapInArrow(run, said)


def pcm_blocks(media: DataFrame, *, id_col: str = "doc_id", media_col: str = "media") -> DataFrame:
    """A row per decoded block: doc_id, sample_offset, pcm (unsigned 8-bit)."""
    rows = media.select(F.col(id_col).alias("doc_id"), F.col(media_col).alias("media"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for own in _slices((m.as_py() for m in batch.column(1)), SLICE):
                decoded = flac.read_streams(own)
                spread = np.repeat(np.arange(at, at + len(own)), [len(p) // flac.BLOCK for p in decoded])
                offsets = [o for p in decoded for o in range(0, len(p), flac.BLOCK)]
                pcm = [p[o : o + flac.BLOCK] for p in decoded for o in range(0, len(p), flac.BLOCK)]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(spread)), pa.array(offsets, pa.int64()), pa.array(pcm, pa.binary())], names=["doc_id", "sample_offset", "pcm"])
                at += len(own)

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, sample_offset long, pcm binary")
