"""Line dedup by site-relative frequency."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from speclake.llm.common import cut


def _digest(line: Column) -> Column:
    return F.unhex(F.md5(line))


def boilerplate_lines(docs: DataFrame, site: str, ratio: float, min_pages: int) -> DataFrame:
    """(host, bad): for each host the MD5 of its lines on more than ``ratio`` of its pages and on ``min_pages`` at least.

    The number of such lines of a host is below its mean number of lines a page divided by ``ratio``.
    Only digests are shuffled, summed up before they are.
    """
    pages = docs.select(F.col(site).alias("host"), F.split("text", "\n").alias("lines"))
    totals = pages.groupBy("host").agg(F.count("*").alias("pages"))
    line = F.explode(F.array_distinct(F.transform(F.filter("lines", lambda x: F.trim(x) != ""), _digest)))
    counts = pages.select("host", line.alias("line")).groupBy("host", "line").agg(F.count("*").alias("n")).filter(F.col("n") >= min_pages)
    totals = totals.withColumnRenamed("host", "site")
    common = counts.join(totals, counts["host"].eqNullSafe(totals["site"])).filter(F.col("n") > F.col("pages") * ratio)
    return common.groupBy("host").agg(F.collect_list("line").alias("bad"))


def drop_boilerplate(docs: DataFrame, site: str = "source", ratio: float = 0.02, min_pages: int = 5, small: int = 100_000, salts: int = 64) -> DataFrame:
    """Removes from each text the lines that are boilerplate on its site.

    ``docs`` needs text and the ``site`` column; all its columns are returned, with text replaced and
    n_lines, n_dropped (long) added, which replace columns of these names. A line is boilerplate if
    the pages of the host that hold it are more than ``ratio`` of its pages, and ``min_pages`` at
    least. Blank lines always stay. Null text stays null with 0 lines; a null site is a site of its
    own; repeated rows count as pages of their own; an empty table gives an empty result.

    The lines to drop are counted: at most ``small`` hosts with at most ``small`` lines are broadcast,
    more are joined by host and salt, so a hot host is spread.
    """
    docs = docs.drop("n_lines", "n_dropped")
    bad = cut(boilerplate_lines(docs, site, ratio, min_pages))
    hosts, lines = bad.agg(F.count("*"), F.coalesce(F.sum(F.size("bad")), F.lit(0))).first()
    names = docs.columns
    whole = F.struct(*[docs[x] for x in names]).alias("row")
    if hosts <= small and lines <= small:
        left, right = docs.select(whole), F.broadcast(bad)
        on = F.col(f"row.{site}").eqNullSafe(F.col("host"))
    else:
        left = docs.select(whole, F.pmod(F.xxhash64("text"), F.lit(salts)).alias("salt"))
        right = bad.select("*", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("other"))
        on = F.col(f"row.{site}").eqNullSafe(F.col("host")) & (F.col("salt") == F.col("other"))
    joined = left.join(right, on, "left").select("row", F.coalesce("bad", F.array().cast("array<binary>")).alias("bad"), F.split("row.text", "\n").alias("lines"))
    kept = F.filter("lines", lambda x: (F.trim(x) == "") | ~F.array_contains("bad", _digest(x)))
    joined = joined.select("row", "lines", F.when(F.size("bad") > 0, kept).otherwise(F.col("lines")).alias("kept"))
    return joined.select(
        *[(F.array_join("kept", "\n") if x == "text" else F.col(f"row.`{x}`")).alias(x) for x in names],
        F.coalesce(F.size("lines"), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size("lines") - F.size("kept"), F.lit(0)).cast("long").alias("n_dropped"),
    )
