"""The corpus pipeline against a version in plain Python, over the smallest tables and over awkward rows."""

from __future__ import annotations

import random

import brute
import corpus_pipeline
import public_tokenizers
import pytest

from tidemark import lineage

DATA = "/root/testdata/sf0.001"
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def _expected(docs: list[tuple], labels: dict) -> list[tuple]:
    """docs: (doc_id, text), ids distinct or rows equal. The pieces of what the stages leave."""
    train = [(t or "", labels[d]) for d, t in docs if labels.get(d) in (0, 1)]
    scores = brute.quality_scores(train, [t or "" for _, t in docs])
    docs = [row for row, s in zip(docs, scores) if s >= 0.7]
    docs = list(dict.fromkeys(docs))
    exact = brute.kept(docs)
    docs = [(d, t) for d, t in docs if exact[d][2]]
    near = brute.near_classes(docs)
    docs = [(d, t) for d, t in docs if near[d] == d]
    clean, _ = brute.sanitised([t for _, t in docs])
    return sorted(brute.pieces([(d, t) for (d, _), t in zip(docs, clean)], VOCABULARY))


def test_pipeline(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{DATA}/labels.parquet").collect()}
    rows = corpus_pipeline.run(spark, DATA).collect()
    assert sorted(tuple(r)[:5] for r in rows) == _expected(docs, labels)
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "exact_dedup", "simhash", "personal_data", "packing"]


def _awkward():
    rng = random.Random(4)
    good = ["the", "river", "and", "Stone", "bridge", "holds", "water", "early", "morning", "light", *(f"name{i}" for i in range(300))]
    rows, labels = [], []
    for i in range(160):
        own = [rng.choice(good) for _ in range(rng.randint(40, 90))]
        if i % 2:
            own = [rng.choice(["$$", "##1", "x9", "BUY", "!!"]) for _ in own]
        rows.append((i, " ".join(own)))
        labels.append((i, 1 - i % 2))
    for i in range(10):
        rows.append((600 + i, " ".join(rng.choice(good) for _ in range(rng.randint(100, 12_000)))))
        labels.append((600 + i, 1))
    for i in range(8):  # a name that stands by one address only
        rows.append((300 + i, f"{rows[2 * i][1]} Quillon bob@host.example.org {rows[2 * i + 20][1]}"))
    rows += [(400, rows[0][1].upper()), (401, rows[2][1] + " more"), (402, rows[4][1].replace("river", "stream", 1)), (403, rows[6][1])]
    rows += [(500, " ".join(rng.choice(good) for _ in range(30_000))), (501, None), (502, ""), (503, "river"), rows[8], rows[8]]
    return rows, labels


def test_pipeline_over_awkward_rows(spark, tmp_path):
    rows, labels = _awkward()
    data = f"file://{tmp_path}"
    clash = [(d, t, None, "web", 1, "x", d, "x", 0.5, None) for d, t in rows]
    schema = "doc_id long, text string, lang string, source string, n_chars long, fp string, lost_id long, digest string, score double, _known int"
    spark.createDataFrame(clash, schema).repartition(5).write.parquet(f"{data}/documents.parquet")
    spark.createDataFrame([*labels, (9999, None), (9998, 3)], "doc_id long, quality int").write.parquet(f"{data}/labels.parquet")
    made = sorted(tuple(r)[:5] for r in corpus_pipeline.run(spark, data).collect())
    assert made == _expected(rows, dict(labels))
    ids = {r[0] for r in made}
    assert ids >= {2, 8, 300, 400, 500, 600} and not ids & {0, 1, 3, 6, 401} and max(r[1] for r in made) > 5


@pytest.mark.parametrize("n", range(5))
def test_stages_on_empty_tables(spark, tmp_path, n):
    spark.createDataFrame([], "doc_id long, quality int").write.parquet(f"file://{tmp_path}/labels.parquet")
    made = corpus_pipeline.STAGES[n][1](spark, spark.createDataFrame([], "doc_id long, text string, fp string"), f"file://{tmp_path}")
    assert made.count() == 0 and (n == 4 or made.columns == ["doc_id", "text", "fp"])


def test_run_leaves_only_its_result(spark):
    before = {p.getPath().toString() for p in _listed(spark)}
    corpus_pipeline.run(spark, DATA)
    new = [p for p in _listed(spark) if p.getPath().toString() not in before]
    assert len(new) == 1
    fs = new[0].getPath().getFileSystem(spark._jsc.hadoopConfiguration())
    assert [p.getPath().getName() for p in fs.listStatus(new[0].getPath())] == ["packing"]


def _listed(spark):
    path = spark._jvm.org.apache.hadoop.fs.Path(lineage.shared_dir(spark))
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return list(fs.listStatus(path)) if fs.exists(path) else []
