"""Tables in the folder that driver and executors share, as the session names it."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``, else the context's own checkpoint folder; where neither is set a folder of this machine.

    The last is for tests alone: with a master that is not local it is an error, as executors would not see that folder.
    A path without a scheme is of the session's default file system, as it is for Spark itself.
    """
    context = spark.sparkContext
    at = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if not at:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="spark-benthic-"))
        at = context.getCheckpointDir()
    if ":" not in at:
        path = context._jvm.org.apache.hadoop.fs.Path(at)
        at = path.getFileSystem(context._jsc.hadoopConfiguration()).makeQualified(path).toString()
    return at.rstrip("/")


_scope: ContextVar[str] = ContextVar("scope", default="")


def new_dir(spark: SparkSession, name: str, folder: str = "jobs") -> str:
    """A path in the shared folder that nothing else uses."""
    return f"{shared_dir(spark)}/{_scope.get()}{folder}/{name}-{uuid.uuid4().hex}"


@contextmanager
def cleared(spark: SparkSession) -> Iterator[None]:
    """What is stored within this block is removed at its end, whether it succeeds or not.

    Results are read from those tables, so they must be written elsewhere (or collected) before the block ends. Blocks may
    be nested; other threads, and tables stored outside, are not touched.
    """
    own = f"{_scope.get()}scope-{uuid.uuid4().hex}/"
    before = _scope.set(own)
    try:
        yield
    finally:
        _scope.reset(before)
        context = spark.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/{own}")
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def stored(df: DataFrame, name: str, folder: str = "jobs") -> DataFrame:
    """``df`` written to the shared folder and read back, which cuts the lineage. It stays there, but within ``cleared``."""
    path = new_dir(df.sparkSession, name, folder)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
