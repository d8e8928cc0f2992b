"""Vector operators bound to embeddings, and streams bound to events."""

from __future__ import annotations

from pyspark.sql import functions as F

from speclake.functions.vectors import dot, rounded, unit
from speclake.operators import evaluation, vectors
from speclake.plans.register import read, registry
from speclake.sources.shared import cut, sized

QUERIES, SQL, query = registry()

UNITS = "u AS (SELECT vec_id, label, list_transform(e, lambda x: x / greatest(sqrt(list_dot_product(e, e)), 1e-12)) AS u FROM (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings))"
MEANS = "m AS (SELECT label, i, avg(u[i]) AS x FROM (SELECT label, u, unnest(range(1, 65)) AS i FROM u) GROUP BY label, i), c AS (SELECT label, list(x / (SELECT greatest(sqrt(sum(x * x)), 1e-12) FROM m b WHERE b.label = m.label) ORDER BY i) AS c FROM m GROUP BY label)"


@query("""SELECT shard, count(*) AS n, min(len(e)) AS least_dim, max(len(e)) AS most_dim, count(*) FILTER (len(list_filter(e, lambda x: NOT isfinite(x))) > 0) AS not_finite FROM (SELECT vec_id % 4 AS shard, embedding::DOUBLE[] AS e FROM embeddings) GROUP BY shard""")
def s7_k5_v7_vector_store(spark, d):
    """Shards put together, checked, and what the check saw of each."""
    t = read(spark, d, "embeddings")
    merged = vectors.merge_shards([t.filter(f"vec_id % 4 = {k}").withColumn("shard", F.lit(k).cast("long")).select("vec_id", "shard", "embedding") for k in range(4)])
    return vectors.shard_state(vectors.with_metadata(merged, t.select("vec_id", "label"), "vec_id"), "shard")


@query(f"WITH {UNITS} SELECT CAST(vec_id AS VARCHAR) AS record_id, 'fam' || label AS family, '' AS attribution, 18 AS kept, list_transform(u, lambda x: round(x, 6)) AS embedding FROM u")
def v1_k6_retrieval_table(spark, d):
    t = read(spark, d, "embeddings").select(F.col("vec_id").alias("record_id"), F.concat(F.lit(" fam"), "label").alias("family"), "embedding")
    table = vectors.retrieval_table(t)
    return table.select("record_id", "family", "attribution", F.lit(len(table.columns) - 1).alias("kept"), F.transform("embedding", lambda x: rounded(x, 6)).alias("embedding"))


@query("""WITH v AS (SELECT vec_id, CASE WHEN vec_id % 6 < 2 THEN 'record:' || vec_id ELSE 'sp' || (vec_id // 2) END AS s, ['wing', 'head', ''][1 + vec_id % 3] AS view, CAST(label % 3 AS VARCHAR) AS family, CASE WHEN vec_id % 8 < 4 THEN CAST(label AS VARCHAR) ELSE '' END AS species, embedding::DOUBLE[] AS e FROM embeddings),
  m AS (SELECT s, i, avg(e[i]) AS x FROM (SELECT s, e, unnest(range(1, 65)) AS i FROM v) GROUP BY s, i), n AS (SELECT s, greatest(sqrt(sum(x * x)), 1e-12) AS n FROM m GROUP BY s),
  u AS (SELECT m.s, list(round(x / n, 6) ORDER BY i) AS embedding FROM m JOIN n ON m.s = n.s GROUP BY m.s),
  a AS (SELECT s, count(*) AS view_count, string_agg(DISTINCT coalesce(nullif(view, ''), 'habitus'), ',' ORDER BY coalesce(nullif(view, ''), 'habitus')) AS available_views, string_agg(CAST(vec_id AS VARCHAR), ',' ORDER BY CAST(vec_id AS VARCHAR)) AS embedding_view_ids,
    count(DISTINCT family) AS nf, min(family) AS family, count(DISTINCT nullif(species, '')) AS ns, coalesce(max(species), '') AS species FROM v GROUP BY s)
  SELECT a.s AS specimen, view_count, available_views, embedding_view_ids, a.s AS split_group, CASE WHEN nf > 1 THEN '' ELSE family END AS family, CASE WHEN ns > 1 THEN '' ELSE species END AS species,
    CASE WHEN ns > 1 THEN 'conflicting_species_within_specimen' WHEN nf > 1 THEN 'conflicting_family_within_specimen' ELSE '' END AS exclusion_reason, nf <= 1 AND ns <= 1 AS eligible_supervised, embedding FROM a JOIN u ON a.s = u.s""")
def c22_a7_fuse_views(spark, d):
    """A third of the rows has no specimen id; families and species differ in some specimens."""
    k = F.col("vec_id")
    t = read(spark, d, "embeddings").select(
        F.when(k % 6 < 2, " ").otherwise(F.concat(F.lit("sp"), F.floor(k / 2))).alias("specimen"), k.alias("record_id"), F.get(F.array(F.lit("wing"), F.lit("head"), F.lit("")), (k % 3).cast("int")).alias("view_type"),
        (F.col("label") % 3).alias("family"), F.when(k % 8 < 4, F.col("label").cast("string")).otherwise("").alias("species"), "embedding")
    fused = vectors.assert_one_split(vectors.fuse_views(t, "specimen"))
    return fused.select("specimen", "view_count", "available_views", "embedding_view_ids", "split_group", "family", "species", "exclusion_reason", "eligible_supervised", F.transform("embedding", lambda x: rounded(x, 6)).alias("embedding"))


@query("""WITH h AS (SELECT vec_id, embedding[1:32]::DOUBLE[] AS a, embedding[33:64]::DOUBLE[] AS b FROM embeddings)
  SELECT vec_id, list_transform(list_concat(list_transform(a, lambda x: x / sqrt(list_dot_product(a, a))), list_transform(b, lambda x: x / sqrt(list_dot_product(b, b)))), lambda x: round(x / sqrt(2), 6)) AS embedding FROM h WHERE vec_id % 5 <> 0""")
def c23_j11_v4_fuse_encoders(spark, d):
    """Two encoders over one cohort, whose metadata must agree; the other encoder lacks a fifth of the rows."""
    t = read(spark, d, "embeddings")
    about = t.select("vec_id", F.concat(F.lit("fam"), "label").alias("family"), (F.col("vec_id") % 3).alias("source"), "embedding")
    a, b = about.withColumn("embedding", F.slice("embedding", 1, 32)), about.filter("vec_id % 5 <> 0").withColumn("embedding", F.slice("embedding", 33, 32))
    fused, _ = vectors.fuse_cohorts(a, b, "vec_id")
    return fused.select("vec_id", "embedding").withColumn("embedding", F.transform("embedding", lambda x: rounded(x, 6)))


@query(f"""WITH {UNITS}, {MEANS}, s AS (SELECT label, list_dot_product(u, c) AS sim FROM u JOIN c USING (label))
  SELECT label, round(greatest(-1, least(1, quantile_cont(sim, 0.05) - 0.02)), 6) AS threshold FROM s GROUP BY label""")
def c26_a8_a9_gates(spark, d):
    return vectors.gates(read(spark, d, "embeddings"), "label", 0.05, 0.02).select("label", rounded(F.col("threshold"), 6).alias("threshold"))


@query(f"""WITH {UNITS}, {MEANS}, s AS (SELECT label, list_dot_product(u, c) AS sim FROM u JOIN c USING (label)),
  g AS (SELECT label, greatest(-1, least(1, quantile_cont(sim, 0.05) - 0.02)) AS t FROM s GROUP BY label)
  SELECT u.vec_id, round(list_dot_product(u.u, c.c), 6) AS similarity, round(list_dot_product(u.u, c.c), 6) < round(g.t, 6) AS rejected FROM u JOIN c USING (label) JOIN g USING (label)""")
def v6_rejection(spark, d):
    t = read(spark, d, "embeddings")
    sims = t.join(sized(cut(vectors.gates(t, "label", 0.05, 0.02))), "label").select("vec_id", rounded(dot(unit(F.col("embedding")), F.col("centroid")), 6).alias("similarity"), rounded(F.col("threshold"), 6).alias("t"))
    return sims.select("vec_id", "similarity", (F.col("similarity") < F.col("t")).alias("rejected"))


@query(f"""WITH {UNITS}, p AS (SELECT q.vec_id AS query_id, x.vec_id AS id, round(list_dot_product(q.u, x.u), 9) AS s FROM u q, u x WHERE q.vec_id % 100 = 0)
  SELECT query_id, id, nth FROM (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY s DESC, id) AS INTEGER) AS nth FROM p) WHERE nth <= 8""")
def c30_v5_search(spark, d):
    """Every hundredth row asks all rows for its eight nearest."""
    t = read(spark, d, "embeddings")
    return vectors.nearest(t.filter("vec_id % 100 = 0"), t, 8).select("query_id", "id", "nth")


@query(f"""WITH {UNITS}, {MEANS}, s AS (SELECT vec_id, u.label, c.label AS guess, round(list_dot_product(u, c), 9) AS sim FROM u, c),
  r AS (SELECT vec_id, label, guess, row_number() OVER (PARTITION BY vec_id ORDER BY sim DESC, CAST(guess AS VARCHAR)) AS k FROM s),
  h AS (SELECT CAST(label AS VARCHAR) AS label, 'src' || (vec_id % 3) AS source, CASE WHEN vec_id % 5 = 0 THEN 'test' ELSE 'val' END AS split, k FROM r WHERE label = guess)
  SELECT CASE WHEN g = 7 THEN 'all' WHEN g = 3 THEN 'label' WHEN g = 5 THEN 'source' ELSE 'split' END AS dimension, coalesce(label, source, split, '') AS value, n, top1, top5 FROM (
    SELECT grouping(label, source, split) AS g, label, source, split, count(*) AS n, count(*) FILTER (k = 1) AS top1, count(*) FILTER (k <= 5) AS top5 FROM h GROUP BY GROUPING SETS ((), (label), (source), (split)))""")
def a11_w5_accuracy(spark, d):
    """Top-1 and top-5 hits by nearest centroid: overall, by class, source and split."""
    t = read(spark, d, "embeddings")
    ranked = vectors.guesses(t, vectors.centroids(t, "label"), "label", 5)
    k = F.col("vec_id")
    truth = t.select("vec_id", F.col("label").cast("string").alias("label"), F.concat(F.lit("src"), k % 3).alias("source"), F.when(k % 5 == 0, "test").otherwise("val").alias("split"))
    return evaluation.accuracy(truth, ranked, "vec_id", "label", ["label", "source", "split"])
