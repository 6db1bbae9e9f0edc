"""Filter audit, HyperMinHash links and collocations against plain versions written from their contracts."""

from __future__ import annotations

import glob
import os
import random
import re
from collections import Counter, defaultdict
from itertools import permutations

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import collocations, filter_audit, hyperminhash, queries

DATA = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, id long, part string, mask int, path long, token long, fp long, size int, phrase string, n long, salt int, rank long"
LABELS = "doc_id long, quality int, toxic int, text string"
CLASH = (7, "clash", 3, 4, 5, 6, 7, "clash", 8, 9, 10)
WORD = r"[^\x20\x09-\x0D]+"


def _frame(spark, rows):
    return spark.createDataFrame([(d, t, lang, *CLASH) for d, t, lang in rows], SCHEMA).repartition(3)


@pytest.mark.parametrize("name", ["op11_filter_audit", "op12_hyperminhash_dedup", "op13_collocations"])
def test_against_sql(spark, name):
    con = duckdb.connect()
    for f in glob.glob(f"{DATA}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    expected = con.sql(queries.oracle_sql()[name])
    made = queries.queries()[name](spark, DATA)
    assert sorted(made.columns) == sorted(expected.columns)
    columns = sorted(made.columns)
    assert sorted(tuple(r[c] for c in columns) for r in made.collect()) == sorted(expected.project(", ".join(columns)).fetchall())


# --- filter interaction audit


def _audit_rows():
    rng = random.Random(4)
    words = [f"w{i}" for i in range(400)]
    prose = [" ".join(rng.choice(words) for _ in range(rng.choice([3, 150, 199, 200, 260]))) for _ in range(24)]
    # long texts of one length that differ in their last, middle or first code points only
    long_ = "x " * 3000
    same_length = [long_ + "end a", long_ + "end b", "y" + long_[1:] + "end a", long_[:2000] + "Z" + long_[2001:] + "end a", long_ + "end a"]
    odd = [None, "", " ", "ABC", "a|b", "50 % off", "é" * 300, "é" * 300, "\U0001f600" * 256, "\U0001f600" * 257, "ok " * 220, "One Two " * 120]
    texts = prose + same_length + odd + prose[:5] + prose[:2]
    rows = [(i * 2 + 1, t, (None, "en", "de")[i % 3]) for i, t in enumerate(texts)]
    rows += [(None, prose[0], "en"), (None, None, None), (1, prose[0], None), (1, prose[0], None), (3, "another text of a doc_id", "en")]
    labels = [(d, d % 3 == 0, d % 4 == 1, "clash") for d, _, _ in rows if d is not None and d % 5] + [(1, 1, 0, "clash"), (1, 0, None, "clash"), (None, 1, 1, "clash"), (99_999, 1, 1, "clash")]
    return rows, [(d, None if q is None else int(q), None if t is None else int(t), c) for d, q, t, c in labels]


def _audit(rows, labels):
    good, toxic = {d for d, q, _, _ in labels if q == 1 and d is not None}, {d for d, _, t, _ in labels if t == 1 and d is not None}
    least = {}
    for d, t, _ in rows:
        if d is not None:
            least[t or ""] = min(d, least.get(t or "", d))
    fails = []
    for d, text, lang in rows:
        t = text or ""
        w = re.findall(WORD, t)
        own = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 3 * len(t), "D": bool(re.search(r"[#$%&*|]", t)), "E": d is not None and d > least[t]}
        fails.append((lang or "", d, {k for k, v in own.items() if v}))
    out, shapley = {}, Counter()
    for part in {p for p, _, _ in fails}:
        mine = [(d, f) for p, d, f in fails if p == part]
        for order in map("".join, permutations("ABCDE")):
            left = mine
            for step, letter in enumerate(order, 1):
                gone = [(d, f) for d, f in left if letter in f]
                left = [(d, f) for d, f in left if letter not in f]
                out[part, order, step] = [len(left), len(gone), sum(letter in f for _, f in mine) - len(gone), sum(f == {letter} for _, f in mine), sum(d in good for d, _ in gone), sum(d in toxic for d, _ in gone)]
                shapley[part, letter] += len(gone)
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def _audited(df):
    rows = df.collect()
    assert len({tuple(r)[:3] for r in rows}) == len(rows)
    return {(r["part"], r["filter_order"], r["step"]): tuple(r)[3:] for r in rows}


def test_audit(spark, monkeypatch):
    rows, labels = _audit_rows()
    docs, known = _frame(spark, rows), spark.createDataFrame(labels, LABELS)
    expected = _audit(rows, labels)
    assert _audited(filter_audit.audit(docs, known)) == expected
    # no broadcast, many short blocks
    assert _audited(filter_audit.audit(docs, known, block=3, growth=2, broadcast_rows=0)) == expected
    # hashes that tell nothing apart: the full texts decide
    monkeypatch.setattr(filter_audit, "_path", lambda length, hashes, steps: length.cast("long") * 0)
    assert _audited(filter_audit.audit(docs, known)) == expected


def test_audit_of_nothing(spark):
    docs, labels = spark.createDataFrame([], SCHEMA), spark.createDataFrame([], LABELS)
    assert filter_audit.audit(docs, labels).collect() == []
    one = _audited(filter_audit.audit(_frame(spark, [(1, None, None)]), labels))
    assert len(one) == 600 and one["", "ABCDE", 1] == (0, 1, 0, 1, 0, 0, 120)


def test_refinement_drops_single_texts_step_by_step(spark):
    texts = ["a" * 300, "a" * 300, "b" + "a" * 299, "a" * 299 + "b", "short", "other", "a"]
    docs = _frame(spark, [(i, t, "en") for i, t in enumerate(texts)])
    text = F.col("text")
    marks = docs.select(F.col("doc_id").alias("id"), F.length(text).alias("length"), filter_audit.blocks(text).alias("hashes"))
    assert sorted(len(r["hashes"]) for r in marks.collect()) == [1, 1, 1, 2, 2, 2, 2]
    classes, steps = filter_audit.refined(marks)
    assert classes.count() == 1 and steps == 2


# --- HyperMinHash


def _set(text):
    w = re.findall(WORD, (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())


def _linked(rows):
    sets = [_set(t) for _, t, _ in rows]
    up = list(range(len(rows)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and 100 * len(a & b) >= 85 * len(a | b):
                up[top(i)] = top(j)
    least = defaultdict(list)
    for i, (d, _, _) in enumerate(rows):
        least[top(i)].append(d)
    named = {i: min((d for d in ds if d is not None), default=None) for i, ds in least.items()}
    return sorted(((d, len(s), named[top(i)], d == named[top(i)]) for i, ((d, _, _), s) in enumerate(zip(rows, sets))), key=repr)


def _near_rows():
    rng = random.Random(12)
    words = [f"w{i}" for i in range(900)]
    prose = [[rng.choice(words) for _ in range(rng.choice([12, 40, 150, 400]))] for _ in range(18)]
    texts = [" ".join(p) for p in prose]
    for p in prose[:12]:
        for changed in (1, 1, 2, 3, 5):
            own = list(p)
            for i in rng.sample(range(len(own)), changed):
                own[i] = "new%d" % rng.randrange(10**6)
            texts.append(" ".join(own))
    # a family of unlike copies of one text, of which only some are near each other, and texts that share one passage
    hub = [rng.choice(words) for _ in range(300)]
    for i in range(40):
        own = list(hub)
        for at in rng.sample(range(300), rng.choice([1, 2, 2, 3, 9, 12])):
            own[at] = f"f{i}x{at}"
        texts.append(" ".join(own))
    texts += [" ".join(prose[5]) + " " + " ".join(rng.choice(words) for _ in range(60)) for _ in range(20)]
    chain = list(prose[17])
    for step in range(10):
        chain = [*chain[2:], f"c{step}a", f"c{step}b"]
        texts.append(" ".join(chain))
    texts += [None, "", " \n", "one", "ONE", "one two", "a b c d e", "a b c d e f", "A b c d  e f", "a b c d e f g h i j k l", "a b c d e f g h i j k", "É x", "é x", "\x1cq", "q"]
    return [(i, t, "en") for i, t in enumerate(texts, 1)] + [(None, texts[0], "en"), (None, None, None), (5, texts[4], "en"), (5, "another text", "en"), (None, "only null", "en"), (None, "only  null", "en")]


def _out(df):
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"] if r["doc_id"] is not None else False) for r in df.select("doc_id", "n_shingles", "component_id", "kept").collect()), key=repr)


def test_links(spark):
    rows = _near_rows()
    expected = sorted(((d, n, c, k and d is not None) for d, n, c, k in _linked(rows)), key=repr)
    groups = Counter(c for _, _, c, _ in expected)
    assert max(groups.values()) > 15 and len(groups) > 60
    docs = _frame(spark, rows)
    assert _out(hyperminhash.components(docs)) == expected
    # every bucket is a crowd, in blocks of a few nodes
    assert _out(hyperminhash.components(docs, crowd=1, block=3)) == expected
    # sets too large to travel, and then some of them
    for held in (0, 150):
        assert _out(hyperminhash.components(docs, crowd=1, block=7, held=held)) == expected


def test_links_of_nothing(spark):
    assert hyperminhash.components(spark.createDataFrame([], SCHEMA)).collect() == []
    assert _out(hyperminhash.components(_frame(spark, [(1, None, None), (2, "", None)]))) == [(1, 0, 1, True), (2, 0, 2, True)]


def test_estimates_keep_similar_pairs():
    rng = np.random.default_rng(3)
    for size in (1, 3, 7, 40, 200, 1500, 20_000):
        for _ in range(20):
            n_shared = int(np.ceil(size * 0.85))
            union = np.unique(rng.integers(-(2**63), 2**63 - 1, size, dtype=np.int64))
            cutoff = (len(union) - n_shared) // 2
            a, b = union[rng.permutation(len(union))], None
            a, b = a[cutoff:], np.concatenate([a[:cutoff], a[2 * cutoff :]])
            if not len(a) or not len(b):
                continue
            inter = len(np.intersect1d(a, b))
            x, y = (hyperminhash.registers(v, hyperminhash.FINE, hyperminhash.SHORT) for v in (a, b))
            kept = hyperminhash.likely(x[None], y[None], np.array([float(len(a))]), np.array([float(len(b))]))[0]
            assert kept or 100 * inter < 85 * len(np.union1d(a, b))
            assert set(hyperminhash.bands(hyperminhash.registers(a, hyperminhash.COARSE, hyperminhash.LONG))) & set(hyperminhash.bands(hyperminhash.registers(b, hyperminhash.COARSE, hyperminhash.LONG))) - {0} or 100 * inter < 85 * len(np.union1d(a, b))
    far = [hyperminhash.registers(rng.integers(-(2**63), 2**63 - 1, 3000, dtype=np.int64), hyperminhash.FINE, hyperminhash.SHORT) for _ in range(2)]
    size = np.array([3000.0])
    assert not hyperminhash.likely(far[0][None], far[1][None], size, size)[0]
    # two unlike sets agree by chance about as often as it is worked out
    many = [np.stack([hyperminhash.registers(rng.integers(-(2**63), 2**63 - 1, 5000, dtype=np.int64), hyperminhash.FINE, hyperminhash.SHORT) for _ in range(60)]) for _ in range(2)]
    agreed = (many[0][:, None] == many[1][None]).mean()
    expected = hyperminhash.chance(np.array([5000.0]), np.array([5000.0]))[0]
    assert 0.7 < agreed / expected < 1.3


# --- collocations


def _phrases(rows, support, top):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    counts, total = defaultdict(Counter), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(lower)):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(w)
            for k in range(1, 6):
                for i in range(len(w) - k + 1):
                    counts[lang][tuple(w[i : i + k])] += 1
    out = []
    for lang, f in counts.items():
        candidates = {p for p, a in f.items() if len(p) > 1 and a >= support}
        covered = {q[i : i + k] for q in candidates for k in range(2, len(q)) for i in range(len(q) - k + 1) if f[q] >= f[q[i : i + k]]}
        kept = []
        for p in candidates - covered:
            a, n = f[p], total[lang]
            score, k = min((1000 * a * n // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), a, f[p[:k]], f[p[k:]], n, score))
        out += [(lang, i, r[2].decode(), *r[3:]) for i, r in enumerate(sorted(kept)[:top], 1)]
    return sorted(out)


def _phrase_rows():
    rng = random.Random(8)
    words = ["a", "b", "c", "ç", "DE", "de", "f\x0b", "g,h", "ii", "\U0001f600", "x\ty", "z.", "Q!r"]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.choice([0, 1, 2, 5, 40, 120]))), (None, "und", "en", "de")[i % 4]) for i in range(60)]
    rows += [(100, None, "en"), (101, "", "en"), (102, "\n.,", "en"), (103, "new york city hall " * 30, "en"), (103, "new york city hall " * 30, "en"), (104, "long" * 5000 + " tail", "en"), (None, "b c b c b c", None)]
    return rows


def test_collocations(spark):
    rows = _phrase_rows()
    docs = _frame(spark, rows)
    for support, top, settings in ((5, 2000, {}), (5, 3, {"bits": 6, "size": 50, "broadcast_rows": 0}), (60, 2000, {"bits": 12, "size": 7})):
        made = [tuple(r) for r in collocations.collocations(docs, support=support, top=top, **settings).select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()]
        assert made and sorted(made) == _phrases(rows, support, top)


def test_phrases_of_one_hash_are_told_apart():
    now = collocations.Slice()
    now.add("en", "a b a c a b")
    now.close()
    hashes, whole = now.phrases(2)
    places = np.flatnonzero(whole)
    got = sorted(zip(*now.count(2, np.zeros(len(places), dtype=np.uint64), places)))
    assert [(lang, p, int(n)) for lang, p, n in got] == [("en", "a b", 2), ("en", "a c", 1), ("en", "b a", 1), ("en", "c a", 1)]


def test_no_collocations(spark):
    assert collocations.collocations(spark.createDataFrame([], SCHEMA)).collect() == []
    assert collocations.collocations(_frame(spark, [(1, "a b c", "en")])).collect() == []
    with pytest.raises(ValueError):
        collocations.frequent_phrases(_frame(spark, [(1, "a", "en")]), support=300)


def test_score_is_exact_beyond_64_bits(spark):
    a, left, right, n = 3 * 10**12, 7 * 10**12, 5 * 10**12, 9 * 10**13
    frequent = spark.createDataFrame([("en", "x", 1, left), ("en", "y", 1, right), ("en", "x y", 2, a)], "lang string, phrase string, words int, n long")
    got = collocations.scored(frequent, spark.createDataFrame([("en", n)], "lang string, n long")).collect()
    assert [(r["a"], r["l"], r["r"], r["score"]) for r in got] == [(a, left, right, 1000 * a * n // (left * right))]
