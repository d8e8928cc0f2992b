"""SimHash near-dedup: fingerprints, vantage-point trees and connected components."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from speclake.llm import nearcopies, sketches
from speclake.llm.common import cut, shuffles_freed


def fingerprint(text: bytes | None, shingle: int) -> int:
    """Signed 64-bit SimHash of a text in UTF-8."""
    return sketches.simhash(sketches.hashes(text, shingle))


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, fp long) of each row: a bit is 1 if it is set in over half the XXH64 (seed 42) of the word shingles, repeats counted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(x, shingle) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps, pa.int64())], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text")).mapInArrow(run, "doc_id long, fp long")


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Numbers of differing bits; of a signed number bitwise_count would take the absolute value."""
    return np.bitwise_count((a ^ b).view(np.uint64)).astype(np.int16)


def vantage(points: np.ndarray) -> tuple[np.int64, int, np.ndarray]:
    """Of a few candidates the point with the widest spread of distances, the median distance and all distances."""
    best = max((points[i] for i in np.linspace(0, len(points) - 1, min(8, len(points))).astype(int)), key=lambda p: float(distances(points, p).var()))
    d = distances(points, best)
    return best, int(np.median(d)), d


def grow(points: np.ndarray, depth: int, reach: int) -> tuple | None:
    """The top of a vantage-point tree: (vantage, radius, inside, outside), None for a shard."""
    if depth == 0 or len(points) < 4:
        return None
    p, radius, d = vantage(points)
    inside, outside = sides(d, radius, reach)
    if inside.all() or outside.all():
        return None
    return p, radius, grow(points[inside], depth - 1, reach), grow(points[outside], depth - 1, reach)


def sides(d: np.ndarray, radius: int, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """Of distances to a vantage point, which are to go inside, which outside.

    Two points on different sides are within ``reach`` only if the inner one is within ``reach`` of the
    border, so it goes to both sides and the pair meets outside; outer points need no copy.
    """
    return d <= radius, d > radius - reach


def route(tree: tuple | None, points: np.ndarray, at: np.ndarray, reach: int, path: str = "r") -> Iterator[tuple[str, np.ndarray]]:
    """(shard, indices): the shards of each point; all pairs within ``reach`` meet in one."""
    if tree is None or not len(at):
        if len(at):
            yield path, at
        return
    p, radius, inside, outside = tree
    for child, there, name in zip((inside, outside), sides(distances(points[at], p), radius, reach), "io"):
        yield from route(child, points, at[there], reach, path + name)


class Links:
    """Sets of linked points, joined by whole arrays of links at a time."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            ra, rb = self.root[a], self.root[b]
            apart = ra != rb
            if not apart.any():
                return
            a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
            np.minimum.at(self.root, np.maximum(ra, rb), np.minimum(ra, rb))
            while True:
                jumped = self.root[self.root]
                if (jumped == self.root).all():
                    break
                self.root = jumped


def search(points: np.ndarray, at: np.ndarray, reach: int, links: Links, leaf: int = 256) -> None:
    """Joins all points within ``reach`` of each other, by a vantage-point tree that prunes by triangle bounds."""
    if len(at) > leaf:
        p, radius, d = vantage(points[at])
        inside, outside = sides(d, radius, reach)
        if not (inside.all() or outside.all()):
            search(points, at[inside], reach, links, leaf)
            search(points, at[outside], reach, links, leaf)
            return
    for k in range(0, len(at), 1024):
        for m in range(0, k + 1, 1024):
            one, two = at[k : k + 1024], at[m : m + 1024]
            near = np.nonzero(distances(points[one][:, None], points[two][None, :]) <= reach)
            links.add(one[near[0]], two[near[1]])


def linked(fps: DataFrame, reach: int, shard_rows: int, sample_share: int) -> DataFrame:
    """Links (a, b), b < a, that join all distinct fingerprints ``fps`` (fp) within ``reach`` bits; linear in number.

    The top of a vantage-point tree is grown over a sample by hash, one of ``sample_share`` fingerprints
    and at least 4096, which comes to the driver (8 bytes each), so it splits the fingerprints into shards of
    about ``shard_rows`` however many there are. A shard hands on, for each point, the smallest fingerprint of
    its set, never the pairs.
    """
    n = fps.count()
    by_hash = F.xxhash64("fp")
    sampled = fps.filter(F.pmod(by_hash, F.lit(sample_share)) == 0) if n > 4096 * sample_share else fps.orderBy(by_hash, "fp").limit(4096)
    sample = np.sort(np.array([r[0] for r in sampled.collect()], np.int64))
    tree = grow(sample, max(0, math.ceil(math.log2(max(1, n / shard_rows)))), reach)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(0).to_numpy(zero_copy_only=False)
            for shard, at in route(tree, x, np.arange(len(x)), reach):
                yield pa.RecordBatch.from_arrays([pa.array([shard] * len(at)), pa.array(x[at])], ["shard", "fp"])

    def join(shard: pd.DataFrame) -> pd.DataFrame:
        x = np.sort(shard["fp"].to_numpy())
        links = Links(len(x))
        search(x, np.arange(len(x)), reach, links)
        moved = links.root != np.arange(len(x))
        return pd.DataFrame({"a": x[moved], "b": x[links.root[moved]]})

    return fps.mapInArrow(deal, "shard string, fp long").groupBy("shard").applyInPandas(join, "a long, b long").distinct()


def starred(links: DataFrame) -> DataFrame:
    """One large-star and one small-star step over ``links`` (a, b), b < a: the same components, each node closer to its smallest one."""
    both = links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a != b").distinct()
    least = large.groupBy("a").agg(F.min("b").alias("m"))
    small = large.join(least, "a").filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return small.unionAll(least.select("a", F.col("m").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """(fp, root): each point of ``links`` (a, b) and the smallest point that it reaches, other than itself.

    Repeats ``starred`` until the links stay the same; every round is written to the checkpoint folder,
    and nothing but a count and a checksum comes to the driver. The join of a star's links with its
    centre's least one is an inner join, whose hot keys adaptive execution splits.
    """
    links, seen = cut(links.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()), None
    while True:
        with shuffles_freed(links.sparkSession):
            state = links.agg(F.count("*"), F.coalesce(F.bit_xor(F.xxhash64("a", "b")), F.lit(0))).first()
        if state == seen or not state[0]:
            break
        seen, links = state, cut(starred(links))
    return links.select(F.col("a").alias("fp"), F.col("b").alias("root"))


def near_duplicates(docs: DataFrame, shingle: int = 3, reach: int = 2, shard_rows: int = 1 << 15, sample_share: int = 1 << 12) -> DataFrame:
    """Groups documents whose SimHash fingerprints are linked by steps of at most ``reach`` bits.

    ``docs``: doc_id, text. Returns doc_id, fp (long), component_id (the smallest doc_id reachable, the
    own included). Copies share a fingerprint, which is searched once. A text without words, empty or
    null, has fingerprint zero and is linked like any other; a text of fewer words than a shingle is
    one shingle. Repeated rows stay; null ids never are a component's id unless it has no other; an
    empty table gives an empty result.
    """
    rows = cut(fingerprints(docs, shingle))
    distinct = cut(rows.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = components(linked(distinct.select("fp"), reach, shard_rows, sample_share))
    rooted = distinct.join(roots, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(smallest, "root").select("fp", "component_id")
    return rows.join(named, "fp").select("doc_id", "fp", "component_id")


def near_groups(docs: DataFrame, shingle: int = 5, similarity: float = 0.8, reach: int = 2, shard_rows: int = 1 << 15, sample_share: int = 1 << 12) -> DataFrame:
    """(key, root): the xxhash64 of each text and that of its group.

    Texts are linked if their SimHash fingerprints over ``shingle`` words differ in ``reach`` bits at
    most, found by vantage-point trees, or if they share ``similarity`` of their shingles. At that
    similarity fingerprints differ in about ten bits, where triangle bounds prune nothing, so these links
    come from minima and rare shingles and are verified. Texts without words, null ones too, are one group.
    """
    keyed = docs.select(F.xxhash64("text").alias("key"), "text")
    rows = cut(nearcopies.sketched(keyed, shingle))
    keys = cut(rows.select("key", "fp").distinct())
    distinct = cut(keys.groupBy("fp").agg(F.min("key").alias("least")))
    same = keys.join(distinct, "fp").select(F.col("key").alias("a"), F.col("least").alias("b")).filter("a != b")
    close = linked(distinct.select("fp"), reach, shard_rows, sample_share)
    one, two = (distinct.select(F.col("fp").alias(x), F.col("least").alias(f"key_{x}")) for x in "ab")
    close = close.join(one, "a").join(two, "b").select(F.greatest("key_a", "key_b").alias("a"), F.least("key_a", "key_b").alias("b"))
    links = cut(same.unionAll(close))
    for more in nearcopies.similar_links(keyed, rows, links, starred, shingle, similarity):
        links = links.unionAll(more)
    roots = components(links).withColumnRenamed("fp", "key")
    return keys.select("key").join(roots, "key", "left").select("key", F.coalesce("root", "key").alias("root"))


def keep_one(docs: DataFrame, **options: float) -> DataFrame:
    """One row of each near-duplicate group of ``near_groups``: that of the smallest doc_id, nulls last, then of the smallest text by hash; columns as given, whatever their names.

    Only the rows' keys are grouped. Of rows with the same doc_id and text the one whose columns have the smallest hash stays; an empty table gives an empty result.
    """
    groups = cut(near_groups(docs, **options))
    id_, key = F.col("doc_id"), F.xxhash64("text")
    rank = F.struct(F.col("id").isNull().alias("none"), "id", "key")
    rows = docs.select(id_.alias("id"), key.alias("key")).groupBy("key").agg(F.min(rank).alias("rank"))
    first = cut(rows.join(groups, "key").groupBy("root").agg(F.min("rank").alias("rank")).select("rank.id", "rank.key"))
    whole = docs.select(F.struct("*").alias("row"), id_.alias("id"), key.alias("key"))
    kept = whole.join(first.select(F.col("id").alias("first_id"), F.col("key").alias("first_key")), (F.col("key") == F.col("first_key")) & F.col("id").eqNullSafe(F.col("first_id")), "left_semi")
    nth = Window.partitionBy("id", "key").orderBy(F.xxhash64(F.to_json("row")))
    return kept.withColumn("nth", F.row_number().over(nth)).filter("nth = 1").select("row.*")
