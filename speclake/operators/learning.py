"""Embedding by a given encoder, classifier heads by rank, and predictions that descend while a known class is met."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from speclake.functions import scalars as S
from speclake.functions.vectors import unit
from speclake.operators import records
from speclake.operators.sampling import lowest
from speclake.operators.vectors import gates
from speclake.sources.shared import cut, sized

RANKS = ("family", "genus", "species")
#: Between the names of a parent's ranks.
SEP = "\x1f"
#: The least and the largest weight of a row.
WEIGHTS = (0.1, 10.0)
HEAD = "rank string, parent string, taxon string, coefficients array<double>, intercept double"


def embed_shards(df: DataFrame, shard: str, encoder: Callable[[list[bytes]], np.ndarray], content: str, settings: dict[str, str], out: str, identity: str = "record_id", batch: int = 32, least: float = 0.8, force: bool = False) -> DataFrame:
    """``embed`` shard by shard, going on where an earlier run over ``out`` ended: (shard, identity, embedding, error) of the shards of ``df``.

    The table ``out``/runs says of each shard that was embedded with which digest of its rows and with which settings, into which
    version, and whether ``least`` of its rows got vectors. Shards that it holds as complete with the same digest are skipped, others are embedded,
    all in one job, into a version of their own, and only then named in the table, so a run that fails leaves the shards before it. Other settings
    than those that the table has are an error, unless ``force`` embeds every shard anew. Shards below ``least`` are tried again next time. Null shards are ''.
    """
    spark = df.sparkSession
    said = json.dumps(dict(sorted(settings.items())))
    rows = df.withColumn(shard, F.coalesce(F.col(shard).cast("string"), F.lit("")))
    digested = cut(rows.groupBy(shard).agg(F.count("*").alias("rows"), records.digest_of([identity, content])))
    runs = shard_runs(spark, out)
    if not force and not runs.filter(F.col("settings") != said).isEmpty():
        raise ValueError(f"{out} was embedded with other settings")
    done = runs.filter(F.col("complete") & (F.col("settings") == said)).select(F.col("shard").alias("_shard"), F.col("digest").alias("_digest"))
    todo = sized(cut(digested.join(done.limit(0) if force else done, (F.col(shard) == F.col("_shard")) & (F.col("digest") == F.col("_digest")), "left_anti")))
    if not todo.isEmpty():
        version = f"{time.time_ns():020d}-{uuid.uuid4().hex}"
        part = rows.join(todo.select(shard), shard, "left_semi").select(F.col(shard).alias("shard"), F.col(identity).cast("string").alias(identity), content)
        made = embed(part.withColumn("_id", F.to_json(F.struct(F.col("shard").alias("s"), F.col(identity).alias("i")))), encoder, content, "_id", batch)
        back = F.from_json("_id", "s string, i string")
        made.select(back["s"].alias("shard"), back["i"].alias(identity), "embedding", "error").write.parquet(f"{out}/data/{version}")
        counts = spark.read.parquet(f"{out}/data/{version}").groupBy("shard").agg(F.count("embedding").alias("embedded"))
        told = todo.withColumnRenamed(shard, "shard").join(counts, "shard", "left").na.fill(0, ["embedded"])
        told = told.select("shard", "digest", F.lit(said).alias("settings"), F.lit(version).alias("version"), "rows", "embedded", (F.col("embedded") >= least * F.col("rows")).alias("complete"))
        told.write.mode("append").parquet(f"{out}/runs")
        runs = shard_runs(spark, out)
    last = runs.join(digested.select(F.col(shard).alias("shard")), "shard", "left_semi").select("shard", "version").orderBy("version", "shard").collect()  # a row a shard
    versions = sorted({r["version"] for r in last})
    if not versions:
        return spark.createDataFrame([], f"shard string, {identity} string, embedding array<double>, error string")
    whole = reduce(DataFrame.unionByName, [spark.read.parquet(f"{out}/data/{v}").withColumn("version", F.lit(v)) for v in versions])
    return whole.join(sized(spark.createDataFrame(last, "shard string, version string")), ["shard", "version"], "left_semi").drop("version")


RUNS = "shard string, digest string, settings string, version string, rows long, embedded long, complete boolean"


def shard_runs(spark: SparkSession, out: str) -> DataFrame:
    """The last run of each shard of ``embed_shards`` over ``out``; none where nothing ran yet."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{out}/runs")
    if not where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where):
        return spark.createDataFrame([], RUNS)
    runs = spark.read.schema(RUNS).parquet(f"{out}/runs")
    return runs.groupBy("shard").agg(F.max_by(F.struct("digest", "settings", "version", "rows", "embedded", "complete"), "version").alias("r")).select("shard", "r.*")


def embed(df: DataFrame, encoder: Callable[[list[bytes]], np.ndarray], content: str, identity: str = "record_id", batch: int = 32) -> DataFrame:
    """(identity, embedding, error): ``encoder`` (a list of contents to a matrix) on batches of rows; a row that fails has a null vector and its error's name.

    A failed batch is tried again row by row, so one bad row costs its own result only. Null content fails as 'Missing'.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for k in range(0, rows.num_rows, batch):
                names, contents = rows.column(0)[k : k + batch], rows.column(1)[k : k + batch].to_pylist()  # only these rows are held as Python's values
                vectors, errors = [None] * len(contents), ["Missing" if c is None else "" for c in contents]
                at = [i for i, e in enumerate(errors) if not e]
                for group in [at, *[[i] for i in at]] if at else []:
                    if all(vectors[i] is not None for i in group):
                        continue
                    try:
                        made = np.asarray(encoder([contents[i] for i in group]), float)
                        for i, v in zip(group, made, strict=True):
                            vectors[i], errors[i] = (v.tolist(), "") if np.isfinite(v).all() else (None, "NotFinite")
                    except Exception as e:  # noqa: BLE001  the encoder's own errors become rows
                        for i in group:
                            errors[i] = type(e).__name__
                yield pa.RecordBatch.from_arrays([names, pa.array(vectors, pa.list_(pa.float64())), pa.array(errors, pa.string())], [identity, "embedding", "error"])

    return df.select(F.col(identity).cast("string").alias(identity), F.col(content).cast("binary").alias(content)).mapInArrow(run, f"{identity} string, embedding array<double>, error string")


def shard_success(expected: DataFrame, observed: DataFrame, shard: str, identity: str = "record_id", least: float = 0.98) -> DataFrame:
    """(shard, expected, observed, rate, complete): of each shard's rows (shard, identity) those that have a vector in ``observed`` (identity, embedding)."""
    good = observed.filter(F.col("embedding").isNotNull()).select(F.col(identity).alias("_id")).distinct().withColumn("_ok", F.lit(True))
    counts = expected.join(good, F.col(identity).cast("string") == F.col("_id").cast("string"), "left").groupBy(shard).agg(F.count("*").alias("expected"), F.count("_ok").alias("observed"))
    rate = F.col("observed") / F.col("expected")
    return counts.withColumns({"rate": F.round(rate, 6), "complete": rate >= least})


def balanced(taxon: np.ndarray, source: np.ndarray) -> np.ndarray:
    """Weights of one over the root of the sizes of a row's class and source, over their mean, within ``WEIGHTS``; both are given as numbers from 0."""
    raw = 1 / np.sqrt(np.bincount(taxon)[taxon] * np.bincount(source)[source].astype(float))
    return np.clip(raw / raw.mean(), *WEIGHTS)


def softmax_loss(w: np.ndarray, x1: np.ndarray, y: np.ndarray, share: np.ndarray, ridge: float) -> tuple[float, np.ndarray]:
    """Weighted mean of the log-losses plus ``ridge`` / 2 times the squared coefficients, and its gradient; the last column of ``x1`` is 1 and its coefficients are free."""
    z = x1 @ w.T
    z -= z.max(axis=1, keepdims=True)
    p = np.exp(z)
    total = p.sum(axis=1, keepdims=True)
    rows = np.arange(len(y))
    loss = float(share @ (np.log(total[:, 0]) - z[rows, y])) + ridge / 2 * float((w[:, :-1] ** 2).sum())
    p /= total
    p[rows, y] -= 1
    g = (p * share[:, None]).T @ x1
    g[:, :-1] += ridge * w[:, :-1]
    return loss, g


def fit_softmax(x: np.ndarray, y: np.ndarray, weights: np.ndarray, classes: int, c: float = 2.0, tolerance: float = 1e-7, rounds: int = 3000) -> tuple[np.ndarray, np.ndarray]:
    """Multinomial logistic regression: the coefficients and intercepts that minimise ``c`` times the weighted losses plus half the squared coefficients.

    L-BFGS until no entry of the gradient, over the sum of weights, is above ``tolerance``. Two classes are one
    logistic curve, whose coefficients are the difference of both rows, so each row's count double.
    """
    x1 = np.hstack([x, np.ones((len(x), 1))])
    ridge = (2 if classes == 2 else 1) / (c * weights.sum())
    ask = lambda at: softmax_loss(at, x1, y, weights / weights.sum(), ridge)
    w = np.zeros((classes, x1.shape[1]))
    f, g = ask(w)
    past: list[tuple[np.ndarray, np.ndarray, float]] = []
    for _ in range(rounds):
        if np.abs(g).max() <= tolerance:
            break
        turn, steps = g.copy(), []
        for s, d, rho in reversed(past):
            steps.append(rho * (s * turn).sum())
            turn -= steps[-1] * d
        turn *= 1 / (past[-1][2] * (past[-1][1] ** 2).sum()) if past else 1 / max(1.0, float(np.abs(g).max()))
        for (s, d, rho), step in zip(past, reversed(steps), strict=True):
            turn += s * (step - rho * (d * turn).sum())
        slope, size = -float((g * turn).sum()), 1.0
        while True:
            at = w - size * turn
            value, slopes = ask(at)
            if value <= f + 1e-4 * size * slope + 1e-15 * abs(f) or size < 1e-10:
                break
            size /= 2
        s, d = at - w, slopes - g
        if (bend := float((s * d).sum())) > 0:
            past = [*past[-9:], (s, d, 1 / bend)]
        w, f, g = at, value, slopes
    return w[:, :-1], w[:, -1] - w[:, -1].mean()


def balance_weights(df: DataFrame, label: str, source: str) -> DataFrame:
    """``df`` with ``weight``: ``balanced`` over the sizes of its classes and sources."""
    n = lambda c: df.groupBy(F.col(c).alias(f"_{c}")).agg(F.count("*").cast("double").alias(f"_n_{c}"))
    raw = F.sqrt(1 / (F.col(f"_n_{label}") * F.col(f"_n_{source}")))
    both = df.join(n(label), F.col(label) == F.col(f"_{label}")).join(n(source), F.col(source).eqNullSafe(F.col(f"_{source}"))).withColumn("_raw", raw)
    mean = both.agg(F.avg("_raw")).first()[0] or 1.0
    return both.withColumn("weight", F.greatest(F.lit(WEIGHTS[0]), F.least(F.lit(WEIGHTS[1]), F.col("_raw") / mean))).drop("_raw", f"_{label}", f"_{source}", f"_n_{label}", f"_n_{source}")


def _fit_group(group: pd.DataFrame) -> pd.DataFrame:
    """The head of one parent whose rows fit into a task."""
    group = group.sort_values(["taxon", "id"])
    taxa, y = np.unique(group["taxon"].to_numpy().astype(str), return_inverse=True)
    _, source = np.unique(group["source"].astype(str), return_inverse=True)
    w, b = fit_softmax(np.array(group["v"].tolist(), float), y, balanced(y, source), len(taxa))
    return pd.DataFrame({"rank": group["rank"].iloc[0], "parent": group["parent"].iloc[0], "taxon": taxa, "coefficients": list(w), "intercept": b})


def _fit_whole(rows: DataFrame, rank: str, parent: str, c: float = 2.0, block: int = 8_000_000) -> DataFrame:
    """The head of one parent fitted over all executors; its coefficients, classes times dimensions, are held by the driver and by each task, ``block`` probabilities at a time."""
    spark = rows.sparkSession
    taxa = [r[0] for r in rows.select("taxon").distinct().orderBy("taxon").collect()]
    named = sized(spark.createDataFrame(list(enumerate(taxa)), "label int, taxon string"))
    data = balance_weights(rows.select("taxon", "source", "v"), "taxon", "source").join(named, "taxon")
    data = cut(data.select(F.col("label").cast("double"), "weight", array_to_vector("v").alias("features")))
    total, dim = data.agg(F.sum("weight"), F.max(F.size(vector_to_array("features")))).first()
    held = min(1.0, max(1e-3, block / len(taxa) * (dim + 1) * 8 / 1e6))
    solver = LogisticRegression(family="multinomial", weightCol="weight", regParam=(2 if len(taxa) == 2 else 1) / (c * total), standardization=False, tol=1e-11, maxIter=3000, maxBlockSizeInMB=held)
    model = solver.fit(data)
    made = zip(taxa, model.coefficientMatrix.toArray().tolist(), model.interceptVector.toArray().tolist(), strict=True)
    return spark.createDataFrame([(rank, parent, *x) for x in made], HEAD)


def _at_ranks(df: DataFrame, identity: str, vector: str) -> DataFrame:
    """(rank, parent, taxon, id, source, v): each row of ``df`` at each rank down to which it is named; at species with a label of quality A or B only."""
    names = {r: S.clean(F.col(r)) for r in RANKS}
    known = {"family": names["family"] != ""}
    known["genus"] = known["family"] & (names["genus"] != "")
    known["species"] = known["genus"] & (names["species"] != "") & F.coalesce(F.upper("label_quality").isin("A", "B"), F.lit(False))
    above = {"family": F.lit(""), "genus": names["family"], "species": F.concat(names["family"], F.lit(SEP), names["genus"])}
    each = [F.when(known[r], F.struct(F.lit(r).alias("rank"), above[r].alias("parent"), names[r].alias("taxon"))) for r in RANKS]
    rows = df.select(F.col(identity).cast("string").alias("id"), F.col("source").cast("string").alias("source"), *[c for c in ("split", "source_split") if c in df.columns], unit(F.col(vector)).alias("v"), F.explode(F.filter(F.array(*each), lambda x: x.isNotNull())).alias("at"))
    return rows.select("at.*", *[c for c in rows.columns if c != "at"])


def _below(parent: str = "parent", taxon: str = "taxon") -> Column:
    """What a class is as a parent."""
    return F.when(F.col(parent) == "", F.col(taxon)).otherwise(F.concat(parent, F.lit(SEP), taxon))


def _classes(rows: DataFrame, least: dict[str, int]) -> DataFrame:
    """(rank, parent, taxon): the classes with ``least`` rows of their rank, in heads of two classes at least below a class of the head above."""
    enough = F.coalesce(*[F.when(F.col("rank") == r, F.lit(n)) for r, n in least.items()])
    common = cut(rows.groupBy("rank", "parent", "taxon").agg(F.count("*").alias("n")).filter(F.col("n") >= enough).drop("n"))
    found, upper = None, None
    for rank in least:
        own = common.filter(F.col("rank") == rank)
        if upper is not None:
            own = own.join(upper, "parent", "left_semi")
        own = own.join(own.groupBy("parent").agg(F.count("*").alias("n")).filter("n > 1"), "parent", "left_semi").select("rank", "parent", "taxon")
        found = own if found is None else found.unionAll(own)
        upper = own.select(_below().alias("parent"))
    return cut(found)


def fit_heads(rows: DataFrame, least: dict[str, int], per_class: int, seed: int, quantile: float, margin: float, cells: int = 4_000_000) -> DataFrame:
    """``train_heads`` over rows at their ranks (``_at_ranks``): heads of at most ``cells`` rows times classes in groups, each larger one over all executors."""
    keys = ["rank", "parent"]
    classes = sized(_classes(rows, least))
    common = cut(rows.join(classes, [*keys, "taxon"], "left_semi"))
    sample = cut(lowest(common, [*keys, "taxon"], per_class, seed, "id"))
    sizes = cut(sample.groupBy(*keys).agg((F.count("*") * F.count_distinct("taxon")).alias("cells")))
    small = sample.join(sized(sizes.filter(F.col("cells") <= cells)), keys, "left_semi")
    made = small.groupBy(*keys).applyInPandas(_fit_group, HEAD)
    for r in sizes.filter(F.col("cells") > cells).orderBy(*keys).collect():  # each is a whole job of its own
        made = made.unionByName(_fit_whole(sample.filter((F.col("rank") == r["rank"]) & (F.col("parent") == r["parent"])), r["rank"], r["parent"]))
    key = lambda: F.concat_ws("\x1e", *keys, "taxon").alias("key")
    limits = gates(common.select(key(), "v"), "key", quantile, margin, "v")
    return made.withColumn("key", key()).join(limits, "key").drop("key")


def train_heads(df: DataFrame, least: dict[str, int] | None = None, per_class: int = 500, seed: int = 42, quantile: float = 0.05, margin: float = 0.02, identity: str = "record_id", vector: str = "embedding", cells: int = 4_000_000) -> DataFrame:
    """(rank, parent, taxon, coefficients, intercept, centroid, threshold): heads for family, genus within a family, species within a genus.

    ``df``: identity, source, family, genus, species, label_quality, embedding; split and source_split may be there. A head has the classes with
    ``least`` rows of its rank (species rows of quality A or B only), needs two of them, and stands below a class of the
    head above. Heads are fitted to the optimum of ``fit_softmax`` on at most ``per_class`` rows of each class by seeded
    score, weighted by class and source: those of at most ``cells`` rows times classes each in a task, larger ones each over all executors.
    A class's threshold is the quantile of all its rows' similarities to its centroid less a margin.
    """
    return fit_heads(_at_ranks(df, identity, vector), least or dict.fromkeys(RANKS, 2), per_class, seed, quantile, margin, cells)


def centroid_heads(df: DataFrame, least: dict[str, int] | None = None, quantile: float = 0.05, margin: float = 0.02, identity: str = "record_id", vector: str = "embedding") -> DataFrame:
    """Heads of the shape of ``train_heads`` that need no fit: a class's coefficients are its centroid, so its logit is the similarity to it."""
    rows = _at_ranks(df, identity, vector)
    keys = ["rank", "parent", "taxon"]
    classes = sized(_classes(rows, least or dict.fromkeys(RANKS, 2)))
    key = lambda: F.concat_ws("\x1e", *keys).alias("key")
    limits = gates(cut(rows.join(classes, keys, "left_semi").select(key(), "v")), "key", quantile, margin, "v")
    return classes.withColumn("key", key()).join(limits, "key").select(*keys, F.col("centroid").alias("coefficients"), F.lit(0.0).alias("intercept"), "centroid", "threshold")


def train_flat(df: DataFrame, label: str, train: int = 80, least: int = 2, per_class: int = 500, seed: int = 42, quantile: float = 0.05, margin: float = 0.02, identity: str = "record_id", vector: str = "embedding", cells: int = 4_000_000) -> tuple[DataFrame, DataFrame]:
    """One head over all classes of ``label``, fitted as by ``train_heads`` on the training groups: (heads, rows held out). Without a split, groups are dealt by hash."""
    split = F.col("split") if "split" in df.columns else S.split_of(F.col("split_group").cast("string"), train, 0)
    rows = df.withColumn("_split", split)
    taxon = S.clean(F.col(label).cast("string"))
    flat = rows.filter("_split = 'train'").filter(taxon != "").select(F.lit(label).alias("rank"), F.lit("").alias("parent"), taxon.alias("taxon"), F.col(identity).cast("string").alias("id"), F.col("source").cast("string").alias("source"), unit(F.col(vector)).alias("v"))
    return fit_heads(flat, {label: least}, per_class, seed, quantile, margin, cells), rows.filter("_split <> 'train'").drop("_split")


class Heads:
    """The heads of ``train_heads`` as arrays, by rank and parent."""

    def __init__(self, rows: list):
        self.of: dict[tuple[str, str], tuple] = {}
        by: dict[tuple[str, str], list] = {}
        for r in sorted(rows, key=lambda r: (r["rank"], r["parent"], r["taxon"])):
            by.setdefault((r["rank"], r["parent"]), []).append(r)
        for key, rs in by.items():
            self.of[key] = ([r["taxon"] for r in rs], *(np.array([r[c] for r in rs], float) for c in ("coefficients", "intercept", "centroid", "threshold")))

    def ask(self, rank: str, parent: str, x: np.ndarray, k: int) -> tuple[list[dict], bool] | None:
        """The best ``k`` classes with probability, and whether the best one is too far from its centroid."""
        if (rank, parent) not in self.of:
            return None
        taxa, w, b, mids, limits = self.of[rank, parent]
        z = w @ x + b
        p = np.exp(z - z.max())
        p /= p.sum()
        best = sorted(range(len(taxa)), key=lambda i: (-p[i], taxa[i]))[:k]
        return [{"rank": rank, "taxon": taxa[i], "probability": round(float(p[i]), 6), "nth": n} for n, i in enumerate(best, 1)], bool(mids[best[0]] @ x < limits[best[0]])


CANDIDATES = "array<struct<rank:string,taxon:string,probability:double,nth:int>>"


def predict_hierarchical(vectors: DataFrame, heads: DataFrame, k: int = 5, bound: int = 20_000, identity: str = "record_id", vector: str = "embedding") -> DataFrame:
    """(identity, candidates (rank, taxon, probability, nth), rejected_rank): family, then genus within the best one, then species, going on while the best class isn't rejected by its threshold.

    Heads have a row a class; they are counted and broadcast up to ``bound`` classes, more are met by routing rows to their heads (``_routed``), with the same result.
    """
    heads = cut(heads)
    if heads.count() > bound:
        return _routed(vectors, heads, k, identity, vector)
    shared = vectors.sparkSession.sparkContext.broadcast(Heads(heads.collect()))
    arrow = pa.list_(pa.struct([("rank", pa.string()), ("taxon", pa.string()), ("probability", pa.float64()), ("nth", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            found, rejected = [], []
            for v in batch.column(1).to_pylist():
                x, parent, said, stop = np.asarray(v, float), "", [], None
                x = x / max(float(np.linalg.norm(x)), 1e-12)
                for rank in RANKS:
                    if (asked := model.ask(rank, parent, x, k)) is None:
                        break
                    said += asked[0]
                    if asked[1]:
                        stop = rank
                        break
                    parent = f"{parent}{SEP}{asked[0][0]['taxon']}" if parent else asked[0][0]["taxon"]
                found.append(said)
                rejected.append(stop)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, arrow), pa.array(rejected, pa.string())], [identity, "candidates", "rejected_rank"])

    return vectors.select(F.col(identity).cast("string").alias(identity), vector).mapInArrow(run, f"{identity} string, candidates {CANDIDATES}, rejected_rank string")


PARTIAL = "row long, parent string, top double, mass double, best array<struct<z:double,taxon:string,far:boolean>>"


def _score_block(k: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """What scores the rows at one parent by one block of its classes: largest logit, mass over it, and the best ``k``."""

    def score(rows: pa.Table, head: pa.Table) -> pa.Table:
        if not (rows.num_rows and head.num_rows):
            return pa.table({"row": pa.array([], pa.int64()), "parent": pa.array([], pa.string()), "top": pa.array([], pa.float64()), "mass": pa.array([], pa.float64()), "best": pa.array([], BEST)})
        head = head.sort_by("taxon")
        w, b, mids, limits = (np.array(head[c].to_pylist(), float) for c in ("coefficients", "intercept", "centroid", "threshold"))
        taxa, parts = head["taxon"].to_pylist(), []
        for at in range(0, rows.num_rows, 2048):
            part = rows.slice(at, 2048)
            x = np.array(part["v"].to_pylist(), float)
            z = x @ w.T + b
            top = z.max(axis=1)
            order = np.argsort(-z, axis=1, kind="stable")[:, :k]
            far = np.einsum("nkd,nd->nk", mids[order], x) < limits[order]
            best = [[{"z": float(z[i, j]), "taxon": taxa[j], "far": bool(f)} for j, f in zip(js, fs, strict=True)] for i, (js, fs) in enumerate(zip(order, far, strict=True))]
            parts.append(pa.table({"row": part["row"], "parent": part["parent"], "top": pa.array(top), "mass": pa.array(np.exp(z - top[:, None]).sum(axis=1)), "best": pa.array(best, BEST)}))
        return pa.concat_tables(parts)

    return score


BEST = pa.list_(pa.struct([("z", pa.float64()), ("taxon", pa.string()), ("far", pa.bool_())]))


def ask_heads(rows: DataFrame, heads: DataFrame, k: int, block: int = 2048, spread: int = 50_000) -> DataFrame:
    """(row, parent, candidates (taxon, probability, nth), far): each of ``rows`` (row, parent, v) by the head (taxon, coefficients, intercept, centroid, threshold) of its parent, if there is one.

    Rows meet blocks of ``block`` classes of their head; those of a parent with more than ``spread`` rows are dealt to
    several copies of it. A block hands on its best ``k`` and its mass, so no task holds a whole head or all rows of a parent.
    """
    heads = heads.withColumn("block", F.floor((F.row_number().over(Window.partitionBy("parent").orderBy("taxon")) - 1) / block).cast("int"))
    blocks = heads.groupBy("parent").agg((F.max("block") + 1).alias("blocks"))
    plan = sized(cut(rows.groupBy("parent").agg(F.ceil(F.count("*") / spread).cast("int").alias("salts")).join(blocks, "parent")))
    asked = rows.join(plan, "parent").select("row", "parent", "v", F.pmod(F.xxhash64("row"), F.col("salts")).cast("int").alias("salt"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    offered = heads.join(plan, "parent").select("parent", "taxon", "coefficients", "intercept", "centroid", "threshold", "block", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
    key = ["parent", "block", "salt"]
    found = asked.groupBy(*key).cogroup(offered.groupBy(*key)).applyInArrow(_score_block(k), PARTIAL)
    both = found.groupBy("row", "parent").agg(F.max("top").alias("top"), F.collect_list(F.struct("top", "mass")).alias("parts"), F.flatten(F.collect_list("best")).alias("best"))
    mass = F.aggregate("parts", F.lit(0.0), lambda a, p: a + p["mass"] * F.exp(p["top"] - F.col("top")))
    first = F.slice(F.array_sort(F.transform("best", lambda x: F.struct((-x["z"]).alias("low"), x["taxon"].alias("taxon"), x["far"].alias("far")))), 1, k)
    both = both.select("row", "parent", first.alias("best"), "top", mass.alias("mass"))
    said = F.transform("best", lambda x, i: F.struct(x["taxon"].alias("taxon"), F.round(F.exp(-x["low"] - F.col("top")) / F.col("mass"), 6).alias("probability"), (i + 1).cast("int").alias("nth")))
    return both.select("row", "parent", said.alias("candidates"), F.get("best", 0)["far"].alias("far"))


def at_true_heads(df: DataFrame, heads: DataFrame, k: int = 5, identity: str = "record_id", vector: str = "embedding") -> DataFrame:
    """(row, rank, parent, taxon, id, source, split, source_split as far as given, candidates): each row of ``df`` at each rank where its class is known to ``heads``, asked at its true parent."""
    known = sized(cut(heads.select("rank", "parent", "taxon").distinct()))
    rows = cut(_at_ranks(df, identity, vector).join(known, ["rank", "parent", "taxon"], "left_semi").withColumn("row", F.monotonically_increasing_id()))
    key = F.concat_ws("\x1e", "rank", "parent")
    found = ask_heads(rows.select("row", key.alias("parent"), "v"), heads.withColumn("parent", key), k)
    return rows.drop("v").join(found.select("row", "candidates"), "row")


def _routed(vectors: DataFrame, heads: DataFrame, k: int, identity: str, vector: str) -> DataFrame:
    """``predict_hierarchical`` with heads of any number of classes: rank by rank, rows go to the heads of their parents."""
    rows = cut(vectors.select(F.monotonically_increasing_id().alias("row"), F.col(identity).cast("string").alias(identity), unit(F.col(vector)).alias("v")))
    at, said = rows.select("row", F.lit("").alias("parent")), []
    for rank in RANKS:
        found = cut(ask_heads(at.join(rows.select("row", "v"), "row"), heads.filter(F.col("rank") == rank), k))
        own = F.lit(rank).alias("rank")
        named = F.transform("candidates", lambda c: F.struct(own, c["taxon"].alias("taxon"), c["probability"].alias("probability"), c["nth"].alias("nth")))  # noqa: B023
        said.append(found.select("row", F.lit(len(said)).alias("step"), named.alias("candidates"), F.when(F.col("far"), rank).alias("rejected")))
        at = found.filter(~F.col("far")).select("row", "parent", F.get("candidates", 0)["taxon"].alias("taxon")).select("row", _below().alias("parent"))
    whole = reduce(DataFrame.unionAll, said).groupBy("row").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("step", "candidates"))), lambda x: x["candidates"])).alias("candidates"), F.max("rejected").alias("rejected_rank"))
    return rows.select("row", identity).join(whole, "row", "left").select(identity, F.coalesce("candidates", F.array().cast(CANDIDATES)).alias("candidates"), "rejected_rank")


def accepted(predictions: DataFrame) -> DataFrame:
    """``predictions`` with accepted_rank and accepted_taxon: the deepest rank whose best class is probable enough and not rejected."""
    best = lambda rank: F.get(F.filter("candidates", lambda c: (c["rank"] == rank) & (c["nth"] == 1)), 0)
    said = records.accepted_rank({r: best(r)["probability"] for r in RANKS}, F.col("rejected_rank"))
    rows = predictions.withColumn("accepted_rank", said)
    return rows.withColumn("accepted_taxon", F.coalesce(*[F.when(F.col("accepted_rank") == r, best(r)["taxon"]) for r in RANKS]))
