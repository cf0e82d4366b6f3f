"""Lineage cuts that survive the loss of an executor."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Sequence
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the cluster's ``spark.checkpoint.dir``; make one only for local runs."""
    context = spark.sparkContext
    if context.getCheckpointDir():
        return
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.mkdtemp(prefix="checkpoint-")
    context.setCheckpointDir(shared)


def small_methods(spark: SparkSession) -> None:
    """Have Spark split generated code that HotSpot would not compile, unless the session sets its own limit.

    Wide projections in one generated method of over 8,000 bytes run in the JVM's interpreter.
    """
    if int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) == 65_535:
        spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def in_parallel(spark: SparkSession, tasks: Sequence[Callable], *, width: int = 8) -> list:
    """Run independent fits side by side, so small iterative jobs overlap."""
    with ThreadPool(min(width, max(len(tasks), 1))) as pool:
        return pool.map(lambda task: task(), [inheritable_thread_target(spark)(t) for t in tasks])


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared checkpoint folder."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"
