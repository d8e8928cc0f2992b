"""Groups of texts whose word shingles are similar, for radii at which a vantage-point tree has nothing to prune."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from speclake.llm import sketches
from speclake.llm.common import cut, sized

#: Buckets of so many texts are compared pair by pair, larger ones with some of their texts at a time; from round to round both numbers grow.
SMALL, LARGEST = 8, 64
WORDS = sketches.PARITIES // 64


def sketched(docs: DataFrame, words: int) -> DataFrame:
    """(key, fp, found): fingerprint and bands of minima of each row of ``docs`` (key, text)."""
    multipliers, offsets = sketches.permutations()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps, found = [], []
            for text in batch.column(1).to_pylist():
                h = sketches.hashes(text, words)
                fps.append(sketches.simhash(h))
                found.append(sketches.buckets(h, multipliers, offsets))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps, pa.int64()), pa.array(found, pa.list_(pa.int64()))], ["key", "fp", "found"])

    return docs.select("key", F.col("text").cast("binary")).mapInArrow(run, "key long, fp long, found array<bigint>")


def shingle_sets(docs: DataFrame, words: int) -> DataFrame:
    """(key, set, odd): distinct shingle hashes and their parities, once a text, of ``docs`` (key, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [sketches.np.unique(sketches.hashes(x, words)) for x in batch.column(1).to_pylist()]
            odd = [sketches.parities(h) for h in sets]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([h.view("int64") for h in sets], pa.list_(pa.int64())), pa.array(odd, pa.list_(pa.int64()))], ["key", "set", "odd"])

    return docs.select("key", F.col("text").cast("binary")).mapInArrow(run, "key long, set array<bigint>, odd array<bigint>").dropDuplicates(["key"])


def met(rows: DataFrame) -> DataFrame:
    """(key): texts of ``rows`` (key, found) that share a bucket with another text."""
    each = rows.select("key", F.explode("found").alias("bucket"))
    shared = each.groupBy("bucket").agg(F.min("key").alias("a"), F.max("key").alias("b")).filter("a != b").select("bucket")
    return each.join(shared, "bucket", "left_semi").select("key").distinct()


def prefixes(sets: DataFrame, similarity: float) -> DataFrame:
    """(token, key, n, pos, odd): the rarest shingles of each text, of which two similar texts have one in common.

    Shingles are ordered by the number of texts that hold them; those that one text alone holds come
    first and count in ``pos``, but are left out.
    """
    tokens = sets.select("key", F.size("set").alias("n"), F.explode("set").alias("token"))
    shared = tokens.groupBy("token").agg(F.count("*").alias("held")).filter("held > 1")
    ranked = tokens.join(shared, "token").groupBy("key", "n").agg(F.sort_array(F.collect_list(F.struct("held", "token"))).alias("x"))
    alone = F.col("n") - F.size("x")
    take = F.col("n") - F.ceil(F.lit(similarity) * F.col("n") - F.lit(1e-9)) + 1 - alone
    ranked = ranked.withColumn("alone", alone).withColumn("take", take.cast("int")).filter("take > 0")
    rarest = ranked.select("key", "n", "alone", F.posexplode(F.slice("x", F.lit(1), F.col("take"))).alias("at", "x"))
    return rarest.select(F.col("x.token").alias("token"), "key", "n", (F.col("at") + F.col("alone")).alias("pos")).join(sets.select("key", "odd"), "key")


def likely(similarity: float) -> Column:
    """Can the rows ``a`` and ``b`` of ``prefixes`` be similar? By size, by what is left after the shared shingle, and by parities; no similar pair is denied at its first shared shingle."""
    n, m = F.col("a.n"), F.col("b.n")
    size = F.least(n, m) >= F.lit(similarity) * F.greatest(n, m) - F.lit(1e-9)
    share = F.least(n - F.col("a.pos"), m - F.col("b.pos")) >= F.lit(similarity / (1 + similarity)) * (n + m) - F.lit(1e-9)
    apart = F.bit_count(F.col("a.odd")[0].bitwiseXOR(F.col("b.odd")[0]))
    for k in range(1, WORDS):
        apart = apart + F.bit_count(F.col("a.odd")[k].bitwiseXOR(F.col("b.odd")[k]))
    return size & share & (apart <= F.lit((1 - similarity) / (1 + similarity)) * (n + m) + F.lit(1e-9))


def verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Of ``pairs`` (a, b, ...) those with a Jaccard index of at least ``similarity``; each pair carries its two sets, so no key is hot."""
    few = sized(pairs)
    one = few.join(sets.select(F.col("key").alias("a"), F.col("set").alias("s")), "a")
    two = few.select("a", "b").join(sets.select(F.col("key").alias("b"), F.col("set").alias("t")), "b")
    both = one.join(two, ["a", "b"]).withColumn("both", F.size(F.array_intersect("s", "t")))
    return both.filter(F.col("both") >= F.lit(similarity) * (F.size("s") + F.size("t") - F.col("both")) - F.lit(1e-9)).select(*pairs.columns)


def similar_links(docs: DataFrame, rows: DataFrame, known: DataFrame, starred: Callable[[DataFrame], DataFrame], words: int = 5, similarity: float = 0.8) -> list[DataFrame]:
    """Links (a, b), b < a, that with those of ``known`` join all similar texts into groups.

    ``docs``: key, text; ``rows``: their sketches (key, fp, found). Two texts are similar if they share
    ``similarity`` of their distinct word shingles. Only texts that share a bucket of minima with another
    one go further (a pair at 0.8 does with a probability of 0.9993); from there on no pair is lost:
    candidates share one of their rarest shingles, pass bounds by size, position and parity, and are
    compared exactly. Of the texts that share a shingle those of one group need no comparison. So, in rounds,
    all are compared with the text to which the shingle is the most common (its likely centre), then,
    where several groups are left, with 16, 256, ... further ones, or pair by pair where few are left.
    ``starred`` merges groups after each round, at least those that meet in a common one.
    Texts that pass the bounds, but are similar to none of a large bucket cost comparisons by their square.
    Texts without words have no links; an empty table gives none.
    """

    def merged(links: DataFrame) -> DataFrame:
        return cut(starred(links).groupBy(F.col("a").alias("comp")).agg(F.min("b").alias("root")))

    keys = sized(cut(met(rows)))
    sets = cut(shingle_sets(docs.join(keys, "key", "left_semi"), words))
    members = prefixes(sets, similarity).join(merged(known).withColumnRenamed("comp", "key"), "key", "left")
    members = members.select("token", "key", "n", "pos", "odd", F.coalesce("root", "key").alias("comp"))
    found, small, leaders = [], SMALL, 1
    while True:
        members = cut(members)
        several = members.groupBy("token").agg(F.count("*").alias("size"), F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo != hi").select("token", "size")
        members = cut(members.join(several, "token"))
        if not members.take(1):
            return found
        part = F.pmod(F.xxhash64("key"), F.lit(leaders))
        centres = members.filter(F.col("size") > small).groupBy("token", part.alias("part")).agg(F.min(F.struct("pos", "key", "n", "odd", "comp")).alias("x")).select("token", "x.*")
        asked = cut(centres.unionByName(members.filter(F.col("size") <= small).select(centres.columns)))
        pairs = members.alias("a").join(asked.alias("b"), (F.col("a.token") == F.col("b.token")) & (F.col("a.comp") != F.col("b.comp")) & likely(similarity))
        first = F.col("a.key") < F.col("b.key")
        a, b = F.struct(F.col("a.key").alias("k"), F.col("a.comp").alias("c")), F.struct(F.col("b.key").alias("k"), F.col("b.comp").alias("c"))
        ordered = pairs.select(F.when(first, a).otherwise(b).alias("x"), F.when(first, b).otherwise(a).alias("y")).distinct()
        pairs = cut(ordered.select(F.col("x.k").alias("a"), F.col("y.k").alias("b"), F.col("x.c").alias("p"), F.col("y.c").alias("q")))
        rest = members.join(asked.select("token", "key"), ["token", "key"], "left_anti").select("token", "key", "n", "pos", "odd", "comp")
        members, small, leaders = rest, LARGEST, 16 * leaders
        if not pairs.take(1):
            continue
        links = cut(verified(pairs, sets, similarity).select(F.greatest("p", "q").alias("a"), F.least("p", "q").alias("b")).distinct())
        found.append(links)
        members = rest.join(merged(links), "comp", "left").select("token", "key", "n", "pos", "odd", F.coalesce("root", "comp").alias("comp"))
