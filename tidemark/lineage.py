"""Where intermediate tables go, so that lost executors cost no recomputation, and when they go away."""

from __future__ import annotations

import contextlib
import contextvars
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

_folder: contextvars.ContextVar[str | None] = contextvars.ContextVar("folder", default=None)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir.

    Where it is unset, a local session gets a temporary folder; on a cluster that is an error, as
    executors would each write their own disk.
    """
    path = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = "file://" + tempfile.mkdtemp(prefix="tidemark-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def _at(spark: SparkSession, path: str):
    """The Hadoop path and its file system."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    place, fs = _at(spark, path)
    return fs.exists(place)


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder that this library wrote; nothing happens if it is gone."""
    place, fs = _at(spark, path)
    fs.delete(place, True)


def rename(spark: SparkSession, old: str, new: str) -> None:
    """Puts a folder in another's place."""
    remove(spark, new)
    place, fs = _at(spark, old)
    if not fs.rename(place, _at(spark, new)[0]):
        raise OSError(f"could not put {old} in the place of {new}")


def own_dir(spark: SparkSession) -> str:
    """The folder of the innermost ``scratch`` block, else that of this application."""
    return _folder.get() or f"{shared_dir(spark)}/tidemark-{spark.sparkContext.applicationId}"


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """A folder that owns every table cut inside the block; it is removed at the end, so write the result before."""
    path = f"{own_dir(spark)}/{uuid.uuid4().hex}"
    token = _folder.set(path)
    try:
        yield path
    finally:
        _folder.reset(token)
        remove(spark, path)


def clear(spark: SparkSession) -> None:
    """Removes all tables that this application cut; results that still read them can no longer be evaluated."""
    remove(spark, own_dir(spark))


def cut(df: DataFrame) -> DataFrame:
    """Write df once into the shared folder and read it back: the lineage ends there.

    Unlike checkpoint(), which evaluates its plan a second time to save it, the plan runs once. The
    table stays until its ``scratch`` block ends, or until ``clear``.
    """
    spark = df.sparkSession
    path = f"{own_dir(spark)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
