"""Similar texts found by SimHash fingerprints, against all pairs in plain Python."""

from __future__ import annotations

import random

import corpus_pipeline
import numpy as np
import pytest
from test_similar import _expected, _rows

from tidemark.llm import hyperminhash, similar, simhash, simhash_wide


def _found(docs, **settings):
    return {r["doc_id"]: r["component_id"] for r in simhash_wide.components(docs, **settings).select("doc_id", "component_id").collect()}


def test_components(spark):
    rows = _rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert _found(docs) == _expected(rows)


@pytest.mark.parametrize(("block", "held"), [(3, simhash_wide.HELD), (7, 60), (512, 0)])
def test_crowds(spark, block, held):
    rng = random.Random(8)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(70):  # a crowd of unlike and like edits of one text
        own = list(base)
        for at in rng.sample(range(120), rng.choice([1, 1, 2, 5, 6])):
            own[at] = f"new{rng.randrange(10**6)}"
        rows.append((i, " ".join(own)))
    rows += [(d + 1000, t) for d, t in _rows()]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert _found(docs, crowd=1, block=block, held=held) == _expected(rows)


@pytest.mark.parametrize(("crowd", "held"), [(400, simhash_wide.HELD), (1, 0)])
def test_what_is_written_of_a_group_grows_with_its_texts(spark, monkeypatch, crowd, held):
    """Edits of one text that are all within the radius, hardly any at the limit; 19,900 pairs."""
    written, cut = [], simhash_wide.cut

    def watched(df):
        out = cut(df)
        if {"a", "b"} <= set(out.columns):
            written.append(out.count())
        return out

    monkeypatch.setattr(simhash_wide, "cut", watched)
    monkeypatch.setattr(similar, "cut", watched)
    rng = random.Random(4)
    rows = []
    for i in range(200):
        own = [f"w{i}" for i in range(120)]
        for at in rng.sample(range(120), 3):
            own[at] = f"new{rng.randrange(10**6)}"
        rows.append((i, " ".join(own)))
    rows += [(1000, rows[7][1] + " end"), (1001, rows[8][1] + " end")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert _found(docs, crowd=crowd, held=held) == _expected(rows)
    assert written and max(written) <= 16 * len(rows)


def test_sets_of_any_size_meet_in_blocks(spark, monkeypatch):
    """Large sets whose links are all left to the blocks, none to a list of pairs."""
    rng = random.Random(9)
    base = [f"w{i}" for i in range(3000)]
    rows = []
    for i in range(24):
        own = list(base)
        for at in rng.sample(range(3000), rng.choice([20, 75, 90])):
            own[at] = f"new{rng.randrange(10**6)}"
        rows.append((i, " ".join(own)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    made = simhash_wide.cut(simhash_wide.sketches(docs))
    nobody = made.filter("false").select(made["fp"].alias("a"), made["fp"].alias("b"))
    monkeypatch.setattr(similar, "compare", lambda *_, **__: nobody)  # no link is found early
    found = simhash.labelled(made.select("doc_id", "digest", "fp"), simhash_wide.links(docs, made, block=8, crowd=5))
    assert {r["doc_id"]: r["component_id"] for r in found.collect()} == _expected(rows)


def test_stage_goes_by_fingerprints_and_trees(spark, monkeypatch):
    def other(*_, **__):
        raise AssertionError("candidates of another method")

    monkeypatch.setattr(hyperminhash, "sketches", other)
    monkeypatch.setattr(similar, "prefixes", other)
    rows = _rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r["doc_id"] for r in corpus_pipeline.near_deduplication(spark, docs, "").collect()} == set(_expected(rows).values())
    # trees that lead nowhere find no pair of different texts
    docs_of = dict(rows)
    alone = _found(docs, radius=-1)
    assert all(d == c or similar.node(similar.shingles(docs_of[d] or "")) == similar.node(similar.shingles(docs_of[c] or "")) for d, c in alone.items())


def test_pairs_at_the_limit_meet_within_the_radius():
    rng = np.random.default_rng(3)
    for union in (5, 10, 50, 300):
        met, far = [], []
        for _ in range(150):
            h = rng.integers(-(2**63), 2**63 - 1, union, dtype=np.int64)
            common = union * 4 // 5
            half = (union - common) // 2
            voted = np.stack([simhash_wide.votes(h[: common + half]), simhash_wide.votes(np.r_[h[:common], h[common + half :]])])
            x, y = simhash_wide.shards(voted)
            met.append((x == y).sum())
            far.append(sum(int(v).bit_count() for v in np.bitwise_xor(*simhash_wide.prints(voted).view(np.uint64))))
        assert min(met) > 0 and np.mean(met) > 0.12 * simhash_wide.TABLES and max(far) <= simhash_wide.RADIUS
    unlike = np.stack([simhash_wide.votes(rng.integers(-(2**63), 2**63 - 1, 300, dtype=np.int64)) for _ in range(400)])
    values = simhash_wide._whole(*simhash_wide.prints(unlike).T.copy())
    assert sum((a ^ b).bit_count() <= simhash_wide.RADIUS for a in values for b in values if a < b) < 0.003 * 400 * 399 / 2
    shards = simhash_wide.shards(unlike)
    assert sum((shards[:i] == s).sum() for i, s in enumerate(shards)) < 200


def test_votes_and_prints_against_a_plain_count(monkeypatch):
    monkeypatch.setattr(simhash_wide, "PART", 7)
    h = np.random.default_rng(5).integers(-(2**63), 2**63 - 1, 40, dtype=np.int64)
    total = [0] * simhash_wide.VOTES
    mask = (1 << 64) - 1
    for v in h.tolist():
        for w, factor in enumerate(simhash_wide._MIXED.tolist()):
            x = (v & mask) * factor & mask
            x = (x ^ x >> 29) * 0xBF58476D1CE4E5B9 & mask
            x ^= x >> 32
            for i in range(64):
                total[64 * w + i] += 1 if x >> i & 1 else -1
    voted = simhash_wide.votes(h)
    assert voted.tolist() == total
    whole = simhash_wide._whole(*simhash_wide.prints(voted[None]).T.copy())[0]
    assert [whole >> i & 1 for i in range(simhash_wide.BITS)] == [int(v > 0) for v in total[: simhash_wide.BITS]]


def test_a_tree_gives_places_in_the_order_of_adding():
    rng = random.Random(2)
    values = [rng.getrandbits(12) for _ in range(200)]
    tree = simhash.Tree()
    for v in values:
        tree.add(v)
    for v in values[:20]:
        assert sorted(tree.places(v, 3)) == [i for i, w in enumerate(values) if (v ^ w).bit_count() <= 3]


def test_empty_and_repeated(spark):
    schema = "doc_id long, text string"
    assert simhash_wide.drop_near_duplicates(spark.createDataFrame([], schema)).count() == 0
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (2, "A b c  d e f"), (None, "a b c d e f"), (3, "z"), (3, "z"), (4, None), (5, ""), (None, "only null"), (None, "only  null")]
    kept = simhash_wide.drop_near_duplicates(spark.createDataFrame(rows, schema)).collect()
    assert sorted(((r["doc_id"], r["text"] and " ".join(r["text"].split())) for r in kept), key=str) == sorted([(1, "a b c d e f"), (3, "z"), (4, None), (None, "only null")], key=str)
