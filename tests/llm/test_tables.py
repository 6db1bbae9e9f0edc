"""Operators against plain versions over all documents of the smallest tables."""

from __future__ import annotations

import random
import zlib

import brute
import numpy as np
import public_tokenizers
import pytest

from tidemark.llm import byte_bpe, pii, queries

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def rows(spark):
    return [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]


def _made(spark, name, *columns):
    return {r["doc_id"]: tuple(r[c] for c in columns) for r in queries.queries()[name](spark, DATA).collect()}


def test_simhash(spark, rows):
    assert _made(spark, "op2_simhash_dedup", "fingerprint", "component_id") == brute.components(rows)


def test_packed_ids_are_those_of_the_tokenizer(spark, rows):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    ids = {d: np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0], dtype="<u4") for d, t in rows}
    placed = queries.queries()["op3_pack"](spark, DATA).collect()
    whole: dict[int, int] = {}
    for r in placed:
        assert zlib.crc32(ids[r["doc_id"]][r["start"] : r["start"] + r["length"]].tobytes()) == r["ids_crc32"]
        whole[r["doc_id"]] = whole.get(r["doc_id"], 0) + r["length"]
    assert whole == {d: len(own) for d, own in ids.items()}


def test_personal_data(spark, rows):
    assert _made(spark, "op6_private_data", "n_email", "n_ip", "n_card", "n_phone", "base_sha256") == {d: brute.personal(t) for d, t in rows}


def test_byte_bpe(spark, rows):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    encoder = brute.rank_encoder(path, public_tokenizers.PATTERN)
    # most texts go through several chunks
    assert sum(len(t or "") > byte_bpe.INNER + byte_bpe.INNER_OVERLAP for _, t in rows) > len(rows) / 2
    assert _made(spark, "op9_byte_bpe", "n_tokens", "ids_sha256", "decoded_sha256") == {d: brute.encoded(t, encoder) for d, t in rows}


def test_pieces_encode_as_their_text():
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    encoder = byte_bpe.encoding(path, public_tokenizers.PATTERN)
    rng = random.Random(4)
    parts = ["word", " ", "  ", "\n", "\r\n", "\t", " 'll", "n't", "12345", "é", "한국", " ", " ", "...", " ?!", "\U0001f600", "a" * 40, " <|x|>", "\x1c", "\x85"]
    cut = 0
    for _ in range(60):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 400)))
        for chunk, overlap in ((16, 8), (64, 16), (200, 40)):
            pieces = byte_bpe.pieces(text, public_tokenizers.PATTERN, chunk=chunk, overlap=overlap)
            assert "".join(pieces) == text
            assert [i for p in pieces for i in encoder.encode_ordinary(p)] == encoder.encode_ordinary(text)
            cut += len(pieces) > 1
    assert cut > 60


def test_a_text_of_very_many_spans(spark):
    """What a text costs grows with its spans, not with their square."""
    text = " ".join(f"user{i}@host{i % 7}.example.org said word" for i in range(30_000))
    docs = spark.createDataFrame([(1, text), (2, None), (3, "x")], "doc_id long, text string")
    clean = {r["doc_id"]: r["text"] for r in pii.sanitise(docs).collect()}
    assert clean == {1: " ".join(["[EMAIL] said word"] * 30_000), 2: None, 3: "x"}
    report = {r["doc_id"]: r["n_email"] for r in pii.report(docs).collect()}
    assert report == {1: 30_000, 2: 0, 3: 0}
