"""Writers of stores, sheets and feeds. Snapshots are written beside the old one and then named, never over what is read."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import filled, formula_safe
from ..lineage import exists, rename


def safe(df: DataFrame) -> DataFrame:
    """All text columns without formulas that a spreadsheet would run."""
    return df.select(*[(formula_safe(F.col(c)) if t == "string" else F.col(c)).alias(c) for c, t in df.dtypes])


def write_store(df: DataFrame, path: str, columns: tuple[str, ...], order: list[Column]) -> None:
    """A CSV store with all columns as text, ordered; the order costs a range partitioning, the files follow it."""
    text = df.select(*[filled(F.col(c).cast("string")).alias(c) for c in columns])
    safe(text.orderBy(*order)).write.mode("overwrite").csv(path, header=True, escape='"', quoteAll=False, emptyValue="")


def replace_store(df: DataFrame, path: str, columns: tuple[str, ...], order: list[Column]) -> None:
    """As write_store, beside what is at path and then in its place. df must not read from path any more (``lineage.cut``)."""
    beside = f"{path.rstrip('/')}-{uuid.uuid4().hex}"
    write_store(df, beside, columns, order)
    rename(df.sparkSession, beside, path)


def write_snapshot(df: DataFrame, base: str) -> str:
    """A new Parquet snapshot under base; returns its path. Readers go on with the old one."""
    path = f"{base.rstrip('/')}/snapshot-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return path


def append_log(df: DataFrame, path: str) -> None:
    safe(df).write.mode("append").csv(path, header=True, escape='"')


def append_daily(df: DataFrame, path: str) -> None:
    """Appends a run's rows; rows of another header are replaced."""
    spark = df.sparkSession
    same = not exists(spark, path) or spark.read.parquet(path).columns == df.columns
    df.write.mode("append" if same else "overwrite").parquet(path)


def append_cache(notices: DataFrame, path: str) -> None:
    notices.write.mode("append").json(path)


def parameters(spark, values: dict) -> DataFrame:
    """name, value rows of a run's parameters; nested values as JSON."""
    import json

    rows = [(k, v if isinstance(v, str) else json.dumps(v, ensure_ascii=False, default=str)) for k, v in values.items()]
    return spark.createDataFrame(rows, "name string, value string")


def write_workbook(sheets: dict[str, DataFrame], base: str) -> None:
    """A folder per sheet, as CSV with a header and safe cells."""
    for name, df in sheets.items():
        flat = df.select(*[(F.to_json(c) if t.startswith(("struct", "map")) else F.array_join(F.transform(c, lambda v: v.cast("string")), "|") if t.startswith("array") else F.col(c)).alias(c) for c, t in df.dtypes])
        safe(flat).write.mode("overwrite").csv(f"{base.rstrip('/')}/{name}", header=True, escape='"')


def write_document(document: DataFrame, path: str) -> None:
    """A feed of one JSON document."""
    document.select("json").write.mode("overwrite").text(path)
