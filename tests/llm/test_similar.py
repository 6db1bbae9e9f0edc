"""Near-deduplication by similarity against all pairs in plain Python."""

from __future__ import annotations

import random

import corpus_pipeline

from tidemark.llm import similar


def _set(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or {tuple(words)}


def _expected(rows):
    sets, up = {d: _set(t) for d, t in rows}, {d: d for d, _ in rows}

    def top(d):
        while up[d] != d:
            d = up[d]
        return d

    for a in sets:
        for b in sets:
            if a < b and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]) and top(a) != top(b):
                up[max(top(a), top(b))] = min(top(a), top(b))
    return {d: top(d) for d in sets}


def _rows():
    rng = random.Random(11)
    words = [f"w{i}" for i in range(900)]
    prose = [[rng.choice(words) for _ in range(rng.randint(30, 200))] for _ in range(20)]
    texts = [" ".join(p) for p in prose]
    for p in prose[:12]:
        for changed in (1, 2, 3, 4, 6):
            own = list(p)
            for i in rng.sample(range(len(own)), changed):
                own[i] = "new%d" % rng.randrange(10**6)
            texts.append(" ".join(own))
    chain = list(prose[19])
    for step in range(12):
        chain = [*chain[3:], *(f"c{step}x{i}" for i in range(3))]
        texts.append(" ".join(chain))
    texts += [f"own{i} " + " ".join(prose[18]) + " " + " ".join(rng.choice(words) for _ in range(60)) for i in range(8)]
    texts += [None, "", " \n", "one", "ONE", "one two", "a b c d e", "a b c d e f", "a b c d e f g h i", "a b c d e f g h i j"]
    return list(enumerate(texts, 1))


def test_components(spark, monkeypatch):
    monkeypatch.setattr(similar, "LEAVES", 2)  # texts of several copies in the joins
    rows = _rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    expected = _expected(rows)
    assert len(set(expected.values())) < len(rows) - 30
    assert {r["doc_id"]: r["component_id"] for r in similar.components(docs).select("doc_id", "component_id").collect()} == expected
    none = (similar.np.zeros(0, dtype=similar.np.int64),) * 2
    monkeypatch.setattr(similar, "common", lambda *_, **__: none)  # the order decides nothing
    assert {r["doc_id"]: r["component_id"] for r in similar.components(docs).select("doc_id", "component_id").collect()} == expected


def test_stage_drops_planted_near_copies(spark):
    rows = _rows()
    docs = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, text string, fp string")
    kept = corpus_pipeline.near_deduplication(spark, docs, "")
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == set(_expected(rows).values())


def test_empty_and_repeated(spark):
    schema = "doc_id long, text string"
    assert similar.drop_near_duplicates(spark.createDataFrame([], schema)).count() == 0
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (2, "A b c  d e f"), (None, "a b c d e f"), (3, "z"), (3, "z"), (4, "q"), (4, "another text"), (None, "only null"), (None, "only  null")]
    kept = similar.drop_near_duplicates(spark.createDataFrame(rows, schema)).collect()
    assert sorted(((r["doc_id"], " ".join(r["text"].split())) for r in kept), key=str) == sorted([(1, "a b c d e f"), (3, "z"), (4, "q"), (4, "another text"), (None, "only null")], key=str)


def test_fine_counts_never_rule_out_a_similar_pair():
    rng = random.Random(5)
    for size in (1, 2, 9, 60, 127, 128, 700, 4000):
        base = [f"w{rng.randrange(10**6)}" for _ in range(size + 4)]
        for changed in (0, 1, size // 60, size // 30, size // 8):
            other = list(base)
            for i in rng.sample(range(len(other)), min(changed, len(other))):
                other[i] = f"new{i}"
            other += [f"end{i}" for i in range(rng.choice([0, size // 9]))]
            a, b = (similar.shingles(" ".join(t)) for t in (base, other))
            alike = 5 * len(set(a) & set(b)) >= 4 * len(set(a) | set(b))
            assert similar.may_be_similar(similar.fine(a), similar.fine(b)) or not alike
    far = [similar.shingles(" ".join(f"{name}{i}" for i in range(3000))) for name in "xy"]
    assert not similar.may_be_similar(*map(similar.fine, far))
    full = bytes([similar.FINE_FULL]) + bytes(63)
    assert similar.may_be_similar(full, bytes([1] * 64))
