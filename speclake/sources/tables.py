"""Manifest files: readers by extension, envelope unwrapping, image listings, and sinks that publish only whole results."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from speclake.sources.shared import cut, sized

#: File suffixes of images, and the names under which responses hold their rows.
IMAGE_SUFFIXES = ("jpg", "jpeg", "png", "tif", "tiff", "webp")
ENVELOPES = ("results", "items", "data", "digitalSpecimens", "digitalSpecimen")


def read_table(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """A table of strings by extension: csv, tsv or txt (.gz too), jsonl, ndjson, json or parquet.

    Whether text has tabs, without quotes, or commas, is told from its header, whatever its name says. Absent values are empty strings. Files in .gz can't be split: one task reads each, so they are dealt out afterwards.
    """
    name = path.lower().removesuffix(".gz")
    kind = name.rpartition(".")[2]
    if kind in ("csv", "tsv", "txt"):
        head = (spark.read.text(path).first() or [""])[0]
        tabs = "\t" in head or kind != "csv" and "," not in head
        options = {"header": True, "sep": "\t" if tabs else ",", "quote": "" if tabs else '"', "escape": "\\" if tabs else '"'}
        rows = spark.read.options(**options).csv(path)
    elif kind in ("jsonl", "ndjson", "json"):
        rows = spark.read.options(multiLine=multiline, primitivesAsString=True).json(path)
    elif kind == "parquet":
        rows = spark.read.parquet(path)
    else:
        raise ValueError(f"no reader for {path}")
    rows = rows.select(*[F.coalesce(F.col(f"`{f.name}`").cast("string"), F.lit("")).alias(f.name) if f.dataType.typeName() not in ("array", "struct", "map") else F.col(f"`{f.name}`") for f in rows.schema])
    return rows.repartition(spark.sparkContext.defaultParallelism) if path.endswith(".gz") else rows


def unwrap(document: Column, names: tuple[str, ...] = ENVELOPES) -> Column:
    """The rows of a response as an array of JSON texts: those of the first envelope that is there, a list's own, else the object itself."""
    held = F.coalesce(*[F.get_json_object(document, f"$.{n}") for n in names], document)
    return F.when(F.ltrim(held).startswith("["), F.from_json(held, "array<string>")).otherwise(F.array(held))


def read_scope(spark: SparkSession, path: str) -> DataFrame:
    """(family) of a JSON list of names, or of an object's ``families``; names that differ in case only are an error."""
    text = spark.read.text(path, wholetext=True).select(F.coalesce(F.get_json_object("value", "$.families"), F.col("value")).alias("value"))
    names = text.select(F.explode(F.from_json("value", "array<string>")).alias("family")).select(F.trim("family").alias("family")).filter("family != ''")
    if not names.groupBy(F.lower("family").alias("low")).count().filter("count > 1").isEmpty():
        raise ValueError("a family is named twice")
    return names


def list_images(spark: SparkSession, folder: str) -> DataFrame:
    """(local_path, bytes) of all image files below a folder; their content isn't read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.*").load(folder)
    return files.filter(F.lower(F.regexp_extract("path", r"\.([^./]+)$", 1)).isin(*IMAGE_SUFFIXES)).select(F.col("path").alias("local_path"), F.col("length").alias("bytes"))


def write_manifest(df: DataFrame, path: str, columns: list[str] | None = None) -> DataFrame:
    """Writes ``df`` as zstd Parquet of strings in fixed column order and reads it again.

    Each write goes to a version of its own below ``path``; only when it is whole and not empty is it named in
    the small table ``path``/current, by an append. So a failed or an empty write leaves the older rows as they are.
    """
    spark = df.sparkSession
    names = columns or df.columns
    rows = df.select(*[(F.coalesce(F.col(c).cast("string"), F.lit("")) if c in df.columns else F.lit("")).alias(c) for c in names])
    version = f"{time.time_ns():020d}-{uuid.uuid4().hex}"
    where = f"{path.rstrip('/')}/versions/{version}"
    rows.write.option("compression", "zstd").parquet(where)
    if spark.read.parquet(where).isEmpty():
        raise ValueError("nothing to write")
    spark.createDataFrame([(version,)], "version string").write.mode("append").parquet(f"{path.rstrip('/')}/current")
    return read_manifest(spark, path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """The rows of the last whole write of ``write_manifest``."""
    version = spark.read.parquet(f"{path.rstrip('/')}/current").agg(F.max("version")).first()[0]
    return spark.read.parquet(f"{path.rstrip('/')}/versions/{version}")


#: Fixed value: rows of a partitioned write that go to one file.
FILE_ROWS = 100_000


def write_partitioned(df: DataFrame, path: str, column: str) -> DataFrame:
    """One folder per value of ``column`` (a shard, or accepted and quarantined rows); older folders go.

    Rows are dealt by value and a hash over the others, into as many files as the value's rows fill: a small shard is one file,
    a hot value is spread over tasks. ``df`` is materialised and its values are counted first.
    """
    rows = cut(df)
    files = sized(cut(rows.groupBy(F.col(column).alias("_value")).agg(F.ceil(F.count("*") / FILE_ROWS).alias("_files")).filter("_files > 1")))
    piece = F.pmod(F.xxhash64(*[c for c in df.columns if c != column]), F.coalesce(F.col("_files"), F.lit(1)))
    dealt = rows.join(files, F.col(column).eqNullSafe(F.col("_value")), "left").withColumn("_piece", piece).drop("_value", "_files")
    dealt.repartition(F.col(column), F.col("_piece")).drop("_piece").write.mode("overwrite").partitionBy(column).parquet(path)
    return df.sparkSession.read.parquet(path)
