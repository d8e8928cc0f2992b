"""Resumable work on files that land over time; each function runs what is there and ends, and goes on from its checkpoint next time."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType


def landed(spark: SparkSession, files: str, a_batch: int | None = None) -> DataFrame:
    """A stream over Parquet files, the older ones first; ``files`` is a folder or a pattern, of which a batch takes ``a_batch`` files, or all that are there."""
    stream = spark.readStream.schema(spark.read.parquet(files).schema)
    return (stream if a_batch is None else stream.option("maxFilesPerTrigger", a_batch)).parquet(files)


#: What ``progress`` tells of each batch.
PROGRESS = "run string, batch long, rows long, held long, late long"


def progress(spark: SparkSession, out: str) -> DataFrame:
    """(run, batch, rows, held, late) of the batches of ``first_within`` over ``out``: rows that came in, keys in state afterwards, rows dropped as too late."""
    return spark.read.schema(PROGRESS).parquet(f"{out}/progress")


def first_seen(rows: DataFrame, keys: list[str], out: str) -> DataFrame:
    """Rows whose keys weren't seen before, in this run or an earlier one over the same ``out``; a null is a key like any other.

    What was seen is the table itself, which each batch is compared with by an anti join; no state is held in
    memory between batches. A batch that runs again compares with the batches before it and overwrites its own folder.
    """
    spark, kind = rows.sparkSession, rows.schema

    def written() -> DataFrame:
        return spark.read.schema(StructType([*kind.fields, StructField("batch", LongType())])).parquet(f"{out}/data")

    def put(batch: DataFrame, number: int) -> None:
        new = batch.dropDuplicates(keys)
        if number:
            old = written().filter(F.col("batch") < number).select(*[F.col(k).alias(f"_old_{k}") for k in keys])
            new = new.join(old, [F.col(k).eqNullSafe(F.col(f"_old_{k}")) for k in keys], "left_anti")
        new.select(*kind.names).write.mode("overwrite").parquet(f"{out}/data/batch={number}")

    rows.writeStream.foreachBatch(put).option("checkpointLocation", f"{out}/state").trigger(availableNow=True).start().awaitTermination()
    return written().drop("batch")


def first_within(rows: DataFrame, keys: list[str], time: str, horizon: str, out: str) -> DataFrame:
    """Like ``first_seen``, but keys seen longer than ``horizon`` before the newest event are forgotten, so state stays bounded.

    A key that comes again after that counts as new; rows that are older than that are dropped as late. ``progress`` tells of both, batch by batch.
    """
    spark = rows.sparkSession
    once = rows.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, horizon).dropDuplicatesWithinWatermark(keys)
    ran = once.writeStream.format("parquet").option("path", f"{out}/data").option("checkpointLocation", f"{out}/state").trigger(availableNow=True).start()
    ran.awaitTermination()
    said = [(str(ran.runId), p["batchId"], p["numInputRows"], sum(s["numRowsTotal"] for s in p["stateOperators"]), sum(s["numRowsDroppedByWatermark"] for s in p["stateOperators"])) for p in map(json.loads, (p.json for p in ran.recentProgress))]
    if said:
        spark.createDataFrame(said, PROGRESS).coalesce(1).write.mode("append").parquet(f"{out}/progress")
    return spark.read.schema(once.schema).parquet(f"{out}/data")


def running_counts(rows: DataFrame, keys: list[str], out: str) -> DataFrame:
    """Counts by key of all that landed; each batch is a whole table of its own, and the last one is read, so that a failed batch leaves the one before."""

    def put(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/data/batch={number}")

    counted = rows.groupBy(*keys).agg(F.count("*").alias("n"))
    counted.writeStream.outputMode("complete").foreachBatch(put).option("checkpointLocation", f"{out}/state").trigger(availableNow=True).start().awaitTermination()
    written = rows.sparkSession.read.schema(counted.schema.add("batch", "long")).parquet(f"{out}/data")
    last = written.agg(F.max("batch")).first()[0]
    return written.filter(F.col("batch").eqNullSafe(F.lit(last))).drop("batch")


def decided(rows: DataFrame, decide: Callable[[DataFrame], DataFrame], out: str) -> DataFrame:
    """``decide`` on each batch of files; a batch that runs again overwrites its own folder, so no row counts twice."""

    def put(batch: DataFrame, number: int) -> None:
        decide(batch).write.mode("overwrite").parquet(f"{out}/data/batch={number}")

    rows.writeStream.foreachBatch(put).option("checkpointLocation", f"{out}/state").trigger(availableNow=True).start().awaitTermination()
    return rows.sparkSession.read.parquet(f"{out}/data").drop("batch")
