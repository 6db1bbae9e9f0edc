"""Intermediate tables: where they are, and that they go."""

from __future__ import annotations

from tidemark import lineage


def test_scratch_owns_its_tables(spark):
    with lineage.scratch(spark) as path:
        made = lineage.cut(spark.range(5))
        with lineage.scratch(spark) as inner:
            lineage.cut(spark.range(2))
            assert inner.startswith(path) and lineage.exists(spark, inner)
        assert not lineage.exists(spark, inner) and made.count() == 5
    assert not lineage.exists(spark, path)


def test_clear(spark):
    kept = lineage.cut(spark.range(3))
    assert kept.count() == 3 and lineage.shared_dir(spark) in kept.inputFiles()[0].replace("file:///", "file:///")
    with lineage.scratch(spark) as path:
        lineage.cut(spark.range(1))
        lineage.clear(spark)
        assert not lineage.exists(spark, path)
    assert kept.count() == 3


def test_no_machine_local_folder_on_a_cluster():
    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return {}

    class Session:
        sparkContext = Context()
        conf = {}

    try:
        lineage.shared_dir(Session())
    except RuntimeError:
        return
    raise AssertionError("a temporary folder was taken")
