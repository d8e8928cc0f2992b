"""Intermediate tables in the folder that driver and executors share, and broadcasts of a checked size."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows that may be broadcast after they were counted; beyond it the join shuffles.
BROADCAST_ROWS = 200_000
FREE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_base(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``. Where none is set a temporary folder serves on one machine; on a cluster that is an error."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if where is None and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return where or tempfile.mkdtemp(prefix="speclake-")


def shared_folder(spark: SparkSession) -> str:
    """A new folder that all executors see."""
    return f"{shared_base(spark).rstrip('/')}/speclake-{uuid.uuid4().hex}"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Frames that are made within drop their shuffle files as soon as they have run, not when the driver happens to collect its garbage."""
    before = spark.conf.get(FREE, None)
    spark.conf.set(FREE, "true")
    try:
        yield
    finally:
        spark.conf.unset(FREE) if before is None else spark.conf.set(FREE, before)


def cut(df: DataFrame) -> DataFrame:
    """Materialises ``df`` in the shared checkpoint folder, cuts its lineage and frees the shuffle files that it took."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_base(df.sparkSession))
    with shuffles_freed(df.sparkSession):
        return df.select("*").checkpoint()


def sized(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if it was counted to hold at most ``limit`` rows, else as it is.

    ``df`` should be materialised already: it is counted here.
    """
    with shuffles_freed(df.sparkSession):
        rows = df.limit(limit + 1).count()
    return F.broadcast(df) if rows <= limit else df
