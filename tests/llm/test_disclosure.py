"""Terms that disclose an entity: wherever they stand, and for single values."""

from __future__ import annotations

from tidemark.llm import pii

FILL = "then people walk along quiet water until evening comes over hill " * 3


def _clean(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    return {r["doc_id"]: r["text"] for r in pii.sanitise(docs).collect()}, {r["doc_id"]: r["spans"] for r in pii.report(docs).collect()}


def _others(n=400):
    return [(1000 + i, f"{FILL} number{i}") for i in range(n)]


def test_far_occurrence_and_document_without_entity(spark):
    rows = [(i, f"zorblax {FILL} user{chr(97 + i)}@mail.example.com {FILL} for Zorblax") for i in range(20)]
    rows += [(50, f"the zorblax alone {FILL}")]
    clean, spans = _clean(spark, rows + _others())
    assert all("zorblax" not in clean[d].lower() for d, _ in rows)
    assert spans[50] == "term:4:11" and "quiet" in clean[50]
    assert clean[1000] == _others()[0][1]


def test_one_value_beside_one_name(spark):
    named = [(i, f"{'abcdefghij'[i] * 4} text {FILL} Quillon bob@host.example.org") for i in range(10)]
    kind = [(100 + i, f"{FILL} user{i}@mail.example.com") for i in range(30)]
    clean, spans = _clean(spark, named + kind + _others())
    assert all("Quillon" not in clean[d] and "[EMAIL]" in clean[d] and "term:" in spans[d] for d, _ in named)
    assert all("quiet" in clean[d] for d, _ in named + kind)


def test_value_of_a_common_kind(spark):
    """A name that comes with one value, which itself is in few documents of a kind that is in nearly all."""
    rows = [(i, f"{FILL} user{i}@mail.example.com t{i}") for i in range(300)]
    rows += [(500 + i, f"{FILL} Quillon {FILL} bob@host.example.org {chr(97 + i) * 3}") for i in range(8)]
    rows += [(600, f"{FILL} quillon is seen"), (601, FILL)]
    clean, _ = _clean(spark, rows)
    assert all("uillon" not in clean[d] for d, _ in rows[300:309]) and clean[601] == FILL
