"""Tables that cut a plan's lineage, in the folder that the cluster shares."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

#: The folder that tables go to inside :func:`cleared`.
_INSIDE: ContextVar[str | None] = ContextVar("tidemark_scratch", default=None)


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors see: ``spark.checkpoint.dir``.

    Where it is unset, a local master gets a temporary folder; a cluster gets an error, as a
    machine-local folder would lose the data of other machines.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = "file://" + tempfile.mkdtemp(prefix="tidemark-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    return f"{_INSIDE.get() or shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: its lineage ends there, so a lost executor
    costs a read and not the work before it. Columns keep their types and nullability relaxes."""
    return written(df, shared_path(df.sparkSession, name))


def written(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def written_over(df: DataFrame, path: str) -> DataFrame:
    """:func:`written`, in place of what an earlier attempt may have left there."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared store."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


@contextmanager
def cleared(spark: SparkSession) -> Iterator[None]:
    """Tables cut inside are removed at the end if nothing failed. What outlives them must be written elsewhere, at a
    path taken before."""
    folder = shared_path(spark, "run")
    token = _INSIDE.set(folder)
    try:
        yield
    finally:
        _INSIDE.reset(token)
    remove(spark, folder)
