"""Embedding operators: fusion, centroids, gates and exact search."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F

from speclake.functions import scalars as S
from speclake.functions.vectors import dot, unit
from speclake.sources.shared import cut, sized


def mean_vectors(df: DataFrame, keys: list[str], vector: str = "embedding") -> DataFrame:
    """Element-wise mean by group: positions are averaged map-side first, so a hot group is never in one task as a whole."""
    parts = df.select(*keys, F.posexplode(vector).alias("at", "x")).groupBy(*keys, "at").agg(F.avg(F.col("x").cast("double")).alias("x"))
    whole = parts.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("at", "x"))).alias("_v"))
    return whole.select(*keys, F.transform("_v", lambda s: s["x"]).alias("mean"))


#: Ranks that must not differ within a specimen.
CHECKED_RANKS = ("family", "genus", "species")


def fuse_views(df: DataFrame, specimen: str = "specimen_group_id", identity: str = "record_id", vector: str = "embedding") -> DataFrame:
    """One unit vector a specimen: specimen, embedding, view_count, available_views and embedding_view_ids (sorted, comma-joined), split_group, split, ranks, eligible_supervised, exclusion_reason.

    A blank specimen id is a specimen of its own, named by its record id. Of ``view_type``, ``split_group``, ``split``
    and the ranks those count that ``df`` has. Ranks that differ become '' and make the specimen ineligible;
    ``split_conflict`` tells that its split groups or splits differ (``assert_one_split`` refuses such).
    """
    have = set(df.columns)
    own = lambda c, other="": S.clean(F.col(c)) if c in have else F.lit(other)
    key = F.coalesce(F.nullif(own(specimen), F.lit("")), F.concat(F.lit("record:"), own(identity)))
    rows = df.select(key.alias("_s"), own(identity).alias("_id"), F.coalesce(F.nullif(own("view_type", "habitus"), F.lit("")), F.lit("habitus")).alias("_view"), *[own(c).alias(c) for c in ("split_group", "split", *CHECKED_RANKS)], F.col(vector).alias("_v"))
    said = lambda c: F.array_sort(F.collect_set(F.nullif(F.col(c), F.lit(""))))
    about = rows.groupBy("_s").agg(
        F.count("*").alias("view_count"),
        F.array_join(F.array_sort(F.collect_set("_view")), ",").alias("available_views"),
        F.array_join(F.array_sort(F.collect_list("_id")), ",").alias("embedding_view_ids"),
        *[said(c).alias(c) for c in ("split_group", "split", *CHECKED_RANKS)],
    )
    one = lambda c: F.when(F.size(c) == 1, F.get(c, 0)).otherwise("")
    # The last rank that differs gives the reason.
    reason = F.coalesce(*[F.when(F.size(r) > 1, F.lit(f"conflicting_{r}_within_specimen")) for r in reversed(CHECKED_RANKS)], F.lit(""))
    told = about.select(
        "_s", "view_count", "available_views", "embedding_view_ids", ((F.size("split_group") > 1) | (F.size("split") > 1)).alias("split_conflict"), reason.alias("exclusion_reason"), (reason == "").alias("eligible_supervised"),
        F.when(F.size("split_group") == 0, F.col("_s")).otherwise(one("split_group")).alias("split_group"), one("split").alias("split"), *[one(r).alias(r) for r in CHECKED_RANKS],
    )
    means = mean_vectors(rows, ["_s"], "_v").select("_s", unit(F.col("mean")).alias("embedding"))
    return told.join(means, "_s").withColumnRenamed("_s", specimen)


def assert_one_split(fused: DataFrame) -> DataFrame:
    if not fused.filter("split_conflict").isEmpty():
        raise ValueError("split groups or splits differ within a specimen")
    return fused


def key_problems(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """(side, problem, n): blank and repeated keys of either side, and keys that one side alone has."""
    counts = lambda df, side: df.groupBy(key).agg(F.count("*").alias(side))
    both = counts(a, "left").join(counts(b, "right"), key, "full")
    blank = F.coalesce(F.trim(F.col(key).cast("string")), F.lit("")) == ""
    problem = lambda side, other: F.when(F.col(side).isNull(), None).when(blank, "blank").when(F.col(side) > 1, "repeated").when(F.col(other).isNull(), "alone")
    sides = both.select(F.explode(F.array(*[F.struct(F.lit(s).alias("side"), problem(s, o).alias("problem")) for s, o in (("left", "right"), ("right", "left"))])).alias("x"))
    return sides.select("x.*").filter("problem IS NOT NULL").groupBy("side", "problem").agg(F.count("*").alias("n"))


def fuse_encoders(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Equal-weight fusion of two encoders' vectors ``va`` and ``vb`` over the common keys, length 1. Blank or repeated keys are an error; keys of one side alone are left out (``key_problems`` counts them)."""
    if not key_problems(a, b, key).filter("problem <> 'alone'").isEmpty():
        raise ValueError(f"{key} must be complete and unique on both sides")
    both = a.join(b, key).select(key, unit(F.col("va")).alias("a"), unit(F.col("vb")).alias("b"))
    return both.select(key, unit(F.transform(F.concat("a", "b"), lambda x: x / F.sqrt(F.lit(2.0)))).alias("embedding"))


def with_metadata(vectors: DataFrame, metadata: DataFrame, key: str) -> DataFrame:
    """A store's vectors (key, embedding) with their metadata rows; an error unless each has exactly one of the other."""
    problems = key_problems(vectors, metadata, key).orderBy("side", "problem").collect()
    if problems:
        raise ValueError("vectors and metadata don't match: " + ", ".join(f"{r['n']} {r['problem']} on the {r['side']}" for r in problems))
    return metadata.join(vectors, key)


def fuse_cohorts(a: DataFrame, b: DataFrame, key: str, vector: str = "embedding") -> tuple[DataFrame, str]:
    """Two encoders' tables (key, metadata, embedding) of one cohort fused over their common keys: (a's metadata with the fused embedding, digest of the cohort).

    Rows of a key must agree in all of ``ALIGNED`` that ``a`` has, else it is an error. The digest is that of
    the keys with those columns, in any order of rows, so that reports over the same cohort can be told.
    """
    from speclake.operators.records import fingerprint

    common = cut(a.join(b.select(key), key, "left_semi"))
    differing = alignment_problems(common.drop(vector), b.drop(vector), key).orderBy(key).limit(3).collect()
    if differing:
        raise ValueError("the encoders' cohorts differ: " + ", ".join(f"{r[key]} {r['problem']}" for r in differing))
    fused = fuse_encoders(common.select(key, F.col(vector).alias("va")), b.join(common.select(key), key, "left_semi").select(key, F.col(vector).alias("vb")), key)
    digest = fingerprint(common, [key, *[c for c in ALIGNED if c in common.columns and c != key]]).first()["digest"]
    return common.drop(vector).join(fused, key), digest


#: The metadata that a retrieval table keeps.
KEPT = (
    "record_id", "source", "source_record_id", "image_url", "local_path", "image_license", "attribution", "family", "genus", "species",
    "accepted_scientific_name", "label_quality", "view_type", "country", "split", "split_group", "specimen_group_id", "source_url",
)


def retrieval_table(df: DataFrame, vector: str = "embedding") -> DataFrame:
    """Unit vectors with the kept metadata, absent columns as ''."""
    have = set(df.columns)
    return df.select(*[(S.clean(F.col(c)) if c in have else F.lit("")).alias(c) for c in KEPT], unit(F.col(vector)).alias("embedding"))


#: The columns in which the rows of two encoders' cohorts must agree.
ALIGNED = (
    "record_id", "specimen_group_id", "split_group", "split", "source", "source_split", "family", "genus", "species", "label_quality",
    "eligible_supervised", "view_type", "image_sha256", "observation_id", "duplicate_group_id", "accepted_scientific_name",
)


def alignment_problems(cohort: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """(key, problem): cohort rows that ``other`` lacks ('missing') and those that differ in a column of ``ALIGNED`` that the cohort has ('differs:column', the first)."""
    names = [c for c in ALIGNED if c in cohort.columns and c != key]
    right = other.select(F.col(key).alias("_key"), F.struct(*[(F.col(c) if c in other.columns else F.lit(None).cast("string")).alias(c) for c in names]).alias("_r") if names else F.struct(F.lit(1).alias("x")).alias("_r"))
    both = cohort.join(right, F.col(key) == F.col("_key"), "left")
    differs = [F.when(~F.col(c).cast("string").eqNullSafe(F.col(f"_r.{c}").cast("string")), f"differs:{c}") for c in names]
    problem = F.when(F.col("_key").isNull(), "missing").otherwise(F.coalesce(*differs, F.lit(None).cast("string")))
    return both.select(key, problem.alias("problem")).filter("problem IS NOT NULL")


def shard_state(df: DataFrame, shard: str, vector: str = "embedding") -> DataFrame:
    """(shard, n, least_dim, most_dim, not_finite) of each shard."""
    size = F.size(vector).cast("long")
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    return df.groupBy(shard).agg(F.count("*").alias("n"), F.min(size).alias("least_dim"), F.max(size).alias("most_dim"), F.count_if(bad).alias("not_finite"))


def merge_shards(shards: list[DataFrame], vector: str = "embedding") -> DataFrame:
    """The union of shards of vectors, all finite and of one dimension, else an error."""
    whole = reduce(DataFrame.unionByName, shards)
    state = shard_state(whole.withColumn("_all", F.lit(1)), "_all", vector).first()
    if state and (state["least_dim"] != state["most_dim"] or state["not_finite"]):
        raise ValueError(f"vectors of dimension {state['least_dim']} to {state['most_dim']}, {state['not_finite']} not finite")
    return whole


def centroids(df: DataFrame, label: str, vector: str = "embedding") -> DataFrame:
    units = df.select(label, unit(F.col(vector)).alias("u"))
    return mean_vectors(units, [label], "u").select(label, unit(F.col("mean")).alias("centroid"))


def gates(df: DataFrame, label: str, quantile: float, margin: float, vector: str = "embedding") -> DataFrame:
    """(label, centroid, threshold): the quantile of a class's similarities to its centroid less a margin, within -1 and 1."""
    mid = sized(cut(centroids(df, label, vector)))
    sims = cut(df.join(mid, label).select(label, dot(unit(F.col(vector)), F.col("centroid")).alias("sim")))
    limit = quantiles(sims, label, "sim", quantile).select(label, F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.col("quantile") - margin)).alias("threshold"))
    return mid.join(limit, label)


def quantiles(df: DataFrame, key: str, value: str, q: float, bins: int = 4096) -> DataFrame:
    """(key, quantile): exact, between the two nearest values in proportion; ``value`` is within -1 and 1, nulls don't count.

    Counts by bin tell in which bins the two ranks lie; only the rows of these are ordered, and those only once per
    value, so no task sorts a whole class. ``df`` is read twice and should be materialised.
    """
    rows = df.select(key, F.col(value).alias("v")).filter("v IS NOT NULL").withColumn("bin", F.floor((F.col("v") + 1) * (bins / 2)).cast("int"))
    counts = rows.groupBy(key, "bin").agg(F.count("*").alias("n"))
    to = Window.partitionBy(key).orderBy("bin")
    at = counts.withColumn("last", F.sum("n").over(to)).withColumn("total", F.sum("n").over(Window.partitionBy(key)))  # at most ``bins`` rows a key
    rank = (F.col("total") - 1) * F.lit(q)
    wanted = at.withColumns({"first": F.col("last") - F.col("n"), "rank": rank}).filter((F.col("first") <= F.ceil("rank")) & (F.col("last") > F.floor("rank"))).select(F.col(key).alias("_key"), F.col("bin").alias("_bin"), "first", "rank")
    near = rows.join(wanted, F.col(key).eqNullSafe(F.col("_key")) & (F.col("bin") == F.col("_bin")), "inner").groupBy(key, "bin", "v", "first", "rank").agg(F.count("*").alias("n"))
    through = F.sum("n").over(Window.partitionBy(key, "bin").orderBy("v")) + F.col("first")
    placed = near.withColumn("through", through)
    value_at = lambda place: F.max(F.when((F.col("through") > place) & (F.col("through") - F.col("n") <= place), F.col("v")))
    both = placed.groupBy(key).agg(value_at(F.floor("rank")).alias("lo"), value_at(F.ceil("rank")).alias("hi"), F.max("rank").alias("rank"))
    return both.select(key, (F.col("lo") + (F.col("hi") - F.col("lo")) * (F.col("rank") - F.floor("rank"))).alias("quantile"))


def guesses(df: DataFrame, mids: DataFrame, label: str, k: int, identity: str = "vec_id", vector: str = "embedding", bound: int = 4096) -> DataFrame:
    """(identity, guess, similarity, nth): the ``k`` classes of ``mids`` (label, centroid) most similar to each row.

    Centroids are broadcast in parts of ``bound``, so what a task holds stays bounded however many classes
    there are; each part multiplies blocks of rows in Arrow batches and hands on its best ``k`` a row.
    """
    mids = cut(mids.select(F.col(label).cast("string").alias("label"), "centroid"))
    parts = max(1, -(-mids.count() // bound))
    found = [_guesses(df, mids.filter(F.pmod(F.xxhash64("label"), F.lit(parts)) == p).collect(), k, identity, vector) for p in range(parts)]
    nth = F.row_number().over(Window.partitionBy(identity).orderBy(F.desc("similarity"), "guess"))
    return reduce(DataFrame.unionAll, found).withColumn("nth", nth).filter(F.col("nth") <= k)


def _guesses(df: DataFrame, mids: list[Row], k: int, identity: str, vector: str) -> DataFrame:
    mids = sorted(mids)
    names = np.array([r["label"] for r in mids], object)
    shared = df.sparkSession.sparkContext.broadcast((names, np.array([r["centroid"] for r in mids], float)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, c = shared.value
        for batch in batches:
            for s in range(0, batch.num_rows if len(names) else 0, 2048):
                part = batch.slice(s, 2048)
                v = np.array(part.column(1).to_pylist(), float)
                sims = np.round((v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)) @ c.T, 9)
                best = np.argsort(-sims, axis=1, kind="stable")[:, :k]
                ids = np.repeat(part.column(0).to_numpy(zero_copy_only=False), best.shape[1])
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(names[best].ravel(), pa.string()), pa.array(np.take_along_axis(sims, best, 1).ravel())], [identity, "guess", "similarity"])

    return df.select(F.col(identity).cast("long"), vector).mapInArrow(run, f"{identity} long, guess string, similarity double")


def nearest(queries: DataFrame, index: DataFrame, k: int, identity: str = "vec_id", vector: str = "embedding", bound: int = 10_000, block: int = 4096, cell: int = 65_536) -> DataFrame:
    """The ``k`` rows of ``index`` with the largest inner product of unit vectors for each query: query_id, id, similarity, nth.

    Each query id is asked once, of rows that share it that with the smallest vector; null ids and null vectors neither ask nor answer.
    Ties go to the smaller id. Up to ``bound`` queries are broadcast: each task multiplies blocks and keeps its own best ``k``. More
    meet the index in cells of ``cell`` queries by ``cell`` rows, all in one job. Either way only a task's best ``k`` a query are shuffled.
    """
    there = lambda df: df.select(F.col(identity).cast("long").alias(identity), vector).filter(F.col(identity).isNotNull() & F.col(vector).isNotNull())
    asked = cut(there(queries).groupBy(identity).agg(F.min(vector).alias(vector)))
    n = asked.count()
    found = _nearest(asked.collect(), there(index), k, identity, vector, block) if n <= bound else _in_cells(asked, n, there(index), k, identity, vector, cell)
    nth = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("similarity"), "id"))
    return found.withColumn("nth", nth).filter(F.col("nth") <= k)


HITS = "query_id long, id long, similarity double"


def _units(vectors: pa.ChunkedArray) -> np.ndarray:
    v = np.array(vectors.to_pylist(), float)
    return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)


def _in_cells(asked: DataFrame, n: int, index: DataFrame, k: int, identity: str, vector: str, cell: int) -> DataFrame:
    """The best ``k`` of each query in each cell of query blocks by index blocks, dealt by hash."""
    index = cut(index)
    across, down = max(1, -(-n // cell)), max(1, -(-index.count() // cell))
    dealt = lambda df, own, m, other, of: df.select(identity, vector, F.pmod(F.xxhash64(identity, vector), F.lit(m)).cast("int").alias(own), F.explode(F.sequence(F.lit(0), F.lit(of - 1))).alias(other))

    def best(queries: pa.Table, rows: pa.Table) -> pa.Table:
        found = [[], [], []]
        if queries.num_rows and rows.num_rows:
            rows = rows.sort_by(identity)
            names, v, ids = rows[identity].to_numpy(), _units(rows[vector]).T, queries[identity].to_numpy()
            for at in range(0, len(ids), 128):
                sims = np.round(_units(queries[vector].slice(at, 128)) @ v, 9)
                least = -np.partition(-sims, min(k, len(names)) - 1, axis=1)[:, min(k, len(names)) - 1]
                for i, row in enumerate(sims):
                    near = np.nonzero(row >= least[i])[0]
                    near = near[np.argsort(-row[near], kind="stable")][:k]
                    for column, values in zip(found, (np.full(len(near), ids[at + i]), names[near], row[near]), strict=True):
                        column.append(values)
        joined = [np.concatenate(x) if x else np.array([]) for x in found]
        return pa.table([pa.array(x, t) for x, t in zip(joined, (pa.int64(), pa.int64(), pa.float64()), strict=True)], names=["query_id", "id", "similarity"])

    left, right = dealt(asked, "q", across, "x", down), dealt(index, "x", down, "q", across)
    return left.groupBy("q", "x").cogroup(right.groupBy("q", "x")).applyInArrow(best, HITS)


def _nearest(rows: list[Row], index: DataFrame, k: int, identity: str, vector: str, block: int) -> DataFrame:
    """``nearest`` for so few queries (id, vector) that they fit in a broadcast."""
    ids = np.array([r[0] for r in rows], np.int64)
    q = np.array([r[1] for r in rows], float) if rows else np.zeros((0, 1))
    shared = index.sparkSession.sparkContext.broadcast((ids, q / np.maximum(np.linalg.norm(q, axis=1, keepdims=True), 1e-12)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, q = shared.value
        for batch in batches:
            for s in range(0, batch.num_rows if len(ids) else 0, block):
                part = batch.slice(s, block)
                names = part.column(0).to_numpy(zero_copy_only=False)
                v = np.array(part.column(1).to_pylist(), float)
                sims = np.round(q @ (v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)).T, 9)
                best = np.lexsort((np.broadcast_to(names, sims.shape), -sims), axis=1)[:, :k]
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(ids, best.shape[1])), pa.array(names[best].ravel()), pa.array(np.take_along_axis(sims, best, 1).ravel())], ["query_id", "id", "similarity"])

    return index.mapInArrow(run, HITS)
