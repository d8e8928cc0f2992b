"""Connected components of links between rows' groups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from speclake.sources.shared import cut


def components(links: DataFrame) -> DataFrame:
    """(node, root): each node of ``links`` (a, b) and the smallest node of its component, itself included.

    Each round points a node's larger neighbours to its smallest one, then a node to the smallest of what it points to, until nothing
    changes; each is written to the shared folder, and only a count and a checksum come to the driver. A hub's links are spread by
    their other ends, so no task holds a component. Nulls link nothing; links of a node to itself name it.
    """
    named = links.filter("a IS NOT NULL AND b IS NOT NULL").select("a", "b")
    nodes = named.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    down = cut(named.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    while (state := down.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()) != before:
        before = state
        around = down.unionAll(down.select(F.col("b"), F.col("a")))
        least = around.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        hung = around.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        lowest = hung.groupBy("a").agg(F.min("b").alias("m"))
        rest = hung.join(lowest, "a").filter("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        down = cut(rest.unionAll(lowest.select("a", F.col("m").alias("b"))).distinct())
    return nodes.join(down.select(F.col("a").alias("node"), F.col("b").alias("root")), "node", "left").select("node", F.coalesce("root", "node").alias("root"))
