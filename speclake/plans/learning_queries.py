"""Audits, gates, cohorts, guards, heads and recommendations over the given tables."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from speclake.functions import scalars as S
from speclake.operators import evaluation, learning, manifest, quality, records, references, sampling, vectors
from speclake.plans.corpus_queries import BOUND, bound, planned
from speclake.plans.register import read, registry
from speclake.plans.vector_queries import MEANS, UNITS
from speclake.sources import shared, tables

QUERIES, SQL, query = registry()


def one(name: str, c: str) -> str:
    return f"SELECT '{name}' AS dimension, coalesce(nullif(CAST({c} AS VARCHAR), ''), 'UNKNOWN') AS value, count(*) AS n FROM m GROUP BY ALL"


@query(f"""WITH {BOUND}, m AS (SELECT *, CASE WHEN doc_id % 3 = 0 THEN 'PRESERVED_SPECIMEN' ELSE '' END AS basis, CASE WHEN doc_id % 4 = 0 THEN 'CC-BY-NC' ELSE 'CC-BY' END AS lic FROM bound)
  SELECT 'total' AS dimension, 'rows' AS value, count(*) AS n FROM m UNION ALL SELECT 'total', 'eligible_supervised', count(*) FILTER (doc_id % 4 <> 0) FROM m UNION ALL SELECT 'total', 'preserved_specimens', count(*) FILTER (doc_id % 3 = 0) FROM m
  UNION ALL SELECT 'total', 'with_dna_or_bin', count(*) FILTER (doc_id % 5 = 0 OR doc_id % 7 = 0) FROM m UNION ALL SELECT 'total', 'unique_families', count(DISTINCT family) FROM m UNION ALL SELECT 'total', 'unique_genera', count(DISTINCT genus) FROM m UNION ALL SELECT 'total', 'unique_species', 0
  UNION ALL {one('source', 'source')} UNION ALL {one('license', 'lic')} UNION ALL {one('quality', 'label_quality')} UNION ALL {one('basis', 'basis')}""")
def c17_a1_audit(spark, d):
    k = F.col("doc_id")
    t = bound(spark, d).withColumns({
        "basis_of_record": F.when(k % 3 == 0, "preserved_specimen").otherwise(""), "image_license": F.when(k % 4 == 0, "CC BY-NC 4.0").otherwise("CC BY 4.0"), "dna_barcode": F.when(k % 5 == 0, "ACGT").otherwise(""), "dna_bin": F.when(k % 7 == 0, "BOLD:A").otherwise("")})
    return evaluation.audit(manifest.finalize(t))


@query("""WITH r AS (SELECT r_name AS region, count(*) AS nations FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY r_name)
  SELECT 0 AS at, '# Nations' AS line UNION ALL SELECT 1, '' UNION ALL SELECT 2, '| region | nations |' UNION ALL SELECT 3, '| --- | ---: |' UNION ALL SELECT CAST(3 + row_number() OVER (ORDER BY region) AS INTEGER), '| ' || region || ' | ' || nations || ' |' FROM r""")
def k4_report(spark, d):
    t = read(spark, d, "nation").join(F.broadcast(read(spark, d, "region")), F.col("n_regionkey") == F.col("r_regionkey"))  # region: five rows
    return evaluation.write_report(t.groupBy(F.col("r_name").alias("region")).agg(F.count("*").alias("nations")), shared.shared_folder(spark), "Nations")


@query("""SELECT lower(p_name) AS name, max(p_brand) AS accepted, max(CAST(p_size AS VARCHAR)) FILTER (p_brand = b) AS taxon_id FROM (SELECT *, max(p_brand) OVER (PARTITION BY lower(p_name)) AS b FROM part) GROUP BY lower(p_name)""")
def s8_synonym_table(spark, d):
    """The name stands in one of three columns."""
    k = F.col("p_partkey") % 3
    t = read(spark, d, "part").select(*[F.when(k == i, F.upper("p_name")).otherwise("").alias(c) for i, c in enumerate(("original_name", "raw_name", "synonym"))], F.col("p_brand").alias("accepted_scientific_name"), F.col("p_size").cast("string").alias("accepted_taxon_id"))
    out = f"{shared.shared_folder(spark)}/synonyms.csv"
    t.write.options(header=True, escape='"').csv(out)
    return manifest.synonyms(tables.read_table(spark, out)).select("name", F.col("accepted.name").alias("accepted"), F.col("accepted.taxon_id").alias("taxon_id"))


@query("SELECT CAST(doc_id AS VARCHAR) AS record_id, CASE WHEN toxic = 1 THEN 'exclude' WHEN quality = 1 THEN 'accept' ELSE '' END AS decision FROM labels")
def s9_overrides(spark, d):
    out = f"{shared.shared_folder(spark)}/overrides.csv"
    read(spark, d, "labels").select(F.col("doc_id").alias("record_id"), F.when(F.col("toxic") == 1, " Exclude").when(F.col("quality") == 1, "accept").alias("decision")).write.options(header=True).csv(out)
    return quality.read_overrides(spark, out)


@query("SELECT r_name AS title, CAST(count(*) AS BIGINT) AS families, min(n_name) AS first FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY r_name")
def s10_catalog(spark, d):
    t = read(spark, d, "nation").join(F.broadcast(read(spark, d, "region")), F.col("n_regionkey") == F.col("r_regionkey"))
    entries = t.groupBy("r_name").agg(F.array_sort(F.collect_list("n_name")).alias("families")).select(F.struct(F.col("r_name").alias("title"), "families", F.array(F.lit("Gen")).alias("genera")).alias("e"))
    out = f"{shared.shared_folder(spark)}/catalog"
    entries.agg(F.to_json(F.struct(F.collect_list("e").alias("references"))).alias("value")).coalesce(1).write.text(out)
    return references.read_catalog(spark, out).select("title", F.size("families").cast("long").alias("families"), F.get("families", 0).alias("first"))


@query("SELECT c_custkey FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_regionkey = 2")
def s11_scope(spark, d):
    nation = read(spark, d, "nation")
    out = f"{shared.shared_folder(spark)}/scope"
    nation.filter("n_regionkey = 2").agg(F.to_json(F.collect_list(F.upper("n_name"))).alias("value")).coalesce(1).write.text(out)
    scope = F.broadcast(tables.read_scope(spark, out).select(F.lower("family").alias("family")))  # names that a person listed
    named = read(spark, d, "customer").join(F.broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey"))
    return named.join(scope, F.lower("n_name") == F.col("family"), "left_semi").select("c_custkey")


def judged(spark, d):
    k, n = F.col("doc_id"), F.col("n_chars")
    t = read(spark, d, "documents").join(read(spark, d, "labels"), "doc_id", "left").withColumn("record_id", k.cast("string"))
    plan = t.select("record_id", "source", F.concat(F.lit("raw/"), k).alias("local_path"), F.lit("own").alias("image_sha256"))
    metrics = t.filter(k % 17 != 0).select("record_id", F.lit(1000).alias("width"), n.alias("height"), (n % 50).cast("double").alias("contrast"), F.lit(5.0).alias("entropy"))
    box = F.struct(F.lit(0.0).alias("x1"), F.lit(0.0).alias("y1"), F.when(k % 3 == 0, 900.0).otherwise(200.0).alias("x2"), n.cast("double").alias("y2"))
    detections = t.filter(k % 4 != 0).select("record_id", box.alias("box"), F.concat(F.lit("crop/"), k).alias("cropped_path"), F.lit("cropped").alias("cropped_sha256"))
    overrides = t.filter("toxic IS NOT NULL").select("record_id", F.when(F.col("toxic") == 1, "exclude").when(F.col("quality") == 1, "accept").otherwise("").alias("decision"))
    limits = {"image_side": 200, "contrast": 5.0, "entropy": 2.5, "specimen_side": 10, "specimen_area": 0.01, "crop_below": 0.35}
    return plan, metrics, detections, overrides, ["src0"], limits


JUDGED = """j AS (SELECT CAST(d.doc_id AS VARCHAR) AS record_id, d.doc_id AS k, source, CASE WHEN toxic = 1 THEN 'exclude manual_exclude' WHEN quality = 1 AND toxic IS NOT NULL THEN 'accept manual_accept' WHEN d.doc_id % 17 = 0 THEN 'exclude unreadable_image' WHEN n_chars < 200 THEN 'exclude image_too_small'
  WHEN n_chars % 50 < 5 THEN 'exclude blank_or_near_uniform' WHEN source <> 'src0' THEN 'accept trusted_source_technical_pass' WHEN d.doc_id % 4 = 0 THEN 'review no_fly_detected' WHEN d.doc_id % 3 = 0 THEN 'accept detected_fly_large_enough' ELSE 'accept_crop detected_fly_cropped' END AS x
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id), q AS (SELECT *, split_part(x, ' ', 1) AS decision, split_part(x, ' ', 2) AS reason FROM j)"""


@query(f"""WITH {JUDGED} SELECT record_id, decision IN ('accept', 'accept_crop') AS eligible_supervised, CASE WHEN decision IN ('accept', 'accept_crop') THEN '' ELSE 'quality:' || reason END AS exclusion_reason,
  CASE WHEN decision = 'accept_crop' THEN 'crop/' ELSE 'raw/' END || record_id AS local_path, CASE WHEN decision = 'accept_crop' THEN 'cropped' ELSE 'own' END AS image_sha256 FROM q""")
def c18_quality_gate(spark, d):
    """Accepted and quarantined rows together are the plan."""
    gate = quality.quality_gate(*judged(spark, d), required=[])
    return gate.accepted.unionByName(gate.quarantined).select("record_id", "eligible_supervised", "exclusion_reason", "local_path", "image_sha256")


@query(f"""WITH {JUDGED} SELECT source, count(*) AS input, count(*) FILTER (decision LIKE 'accept%') AS accepted, count(*) FILTER (decision = 'accept_crop') AS cropped, count(*) FILTER (decision = 'review') AS review, count(*) FILTER (decision = 'exclude') AS excluded,
  round(count(*) FILTER (decision LIKE 'accept%') / count(*), 6) AS accepted_fraction FROM q GROUP BY source""")
def c18_a6_gate_report(spark, d):
    return quality.report(quality.decide(*judged(spark, d)))


@query(f"WITH {BOUND}, s AS (SELECT *, ('0x' || substr(sha256(duplicate_key), 1, 8))::UBIGINT % 100 AS b FROM bound) SELECT record_id, CASE WHEN b < 90 THEN 'val' ELSE 'test' END AS split FROM s WHERE b >= 80")
def c20_freeze_cohort(spark, d):
    t = bound(spark, d).withColumn("split", S.split_of(F.col("duplicate_key"))).withColumnRenamed("duplicate_key", "split_group")
    cohort = evaluation.freeze(t).select("record_id", "split")
    return evaluation.keep_frozen(cohort, cohort.orderBy(F.desc("record_id")))


def lengths(contents: list[bytes]) -> np.ndarray:
    """A stand-in for a model: bytes and blanks of a text; it can't read texts of under 40 bytes."""
    if any(len(c) < 40 for c in contents):
        raise ValueError("too short")
    return np.array([[len(c), c.count(b" ")] for c in contents], float)


@query("""SELECT CAST(doc_id AS VARCHAR) AS record_id, CASE WHEN strlen(text) < 40 THEN NULL ELSE [CAST(strlen(text) AS DOUBLE), CAST(length(text) - length(replace(text, ' ', '')) AS DOUBLE)] END AS embedding, CASE WHEN strlen(text) < 40 THEN 'ValueError' ELSE '' END AS error FROM documents""")
def c21_embed(spark, d):
    return learning.embed(read(spark, d, "documents").select(F.col("doc_id").alias("record_id"), "text"), lengths, "text")


@query("""SELECT doc_id % 8 AS shard, count(*) AS expected, count(*) FILTER (strlen(text) >= 40) AS observed, round(count(*) FILTER (strlen(text) >= 40) / count(*), 6) AS rate, count(*) FILTER (strlen(text) >= 40) / count(*) >= 0.97 AS complete FROM documents GROUP BY ALL""")
def c21_a19_shard_success(spark, d):
    t = read(spark, d, "documents").select(F.col("doc_id").alias("record_id"), "text", (F.col("doc_id") % 8).alias("shard"))
    return learning.shard_success(t.select("record_id", "shard"), learning.embed(t, lengths, "text"), "shard", least=0.97)


def labelled(spark, d):
    """embeddings with a taxonomy over their labels."""
    k = F.col("label")
    return read(spark, d, "embeddings").select(
        F.col("vec_id").cast("string").alias("record_id"), F.concat(F.lit("src"), F.col("vec_id") % 3).alias("source"), F.concat(F.lit("fam"), k % 2).alias("family"), F.concat(F.lit("gen"), k % 4).alias("genus"), F.concat(F.lit("sp"), k).alias("species"),
        F.when(F.col("vec_id") % 5 == 0, "D").otherwise("A").alias("label_quality"), F.col("vec_id").cast("string").alias("split_group"), "embedding")


@query()
def c24_train_heads(spark, d):
    """Probabilities can't be had in SQL; tests compare accuracy and shapes."""
    return learning.train_heads(labelled(spark, d)).select("rank", "parent", "taxon", F.size("coefficients").alias("dim"), F.round("threshold", 6).alias("threshold"))


@query()
def c25_train_flat(spark, d):
    heads, held = learning.train_flat(labelled(spark, d), "species")
    ranked = learning.predict_hierarchical(held, heads.withColumn("rank", F.lit("family"))).select("record_id", F.explode("candidates").alias("c")).select("record_id", F.col("c.taxon").alias("guess"), "c.nth")
    return evaluation.accuracy(held, ranked, "record_id", "species", ["source"])


@query()
def c27_predict_hierarchical(spark, d):
    t = labelled(spark, d)
    predicted = learning.accepted(learning.predict_hierarchical(t, learning.train_heads(t)))
    return predicted.select("record_id", "rejected_rank", "accepted_rank", "accepted_taxon", F.size("candidates").alias("candidates"))


#: Rows at the ranks where they are named, classes' centroids over training rows, and each row's similarities at its true parent.
RANKED = """u AS (SELECT vec_id, label, list_transform(e, lambda x: x / greatest(sqrt(list_dot_product(e, e)), 1e-12)) AS u FROM (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings)),
  t AS (SELECT *, 'fam' || label % 2 AS fam, 'gen' || label % 4 AS gen, CASE WHEN vec_id % 10 < 7 THEN 'train' WHEN vec_id % 10 < 9 THEN 'val' ELSE 'test' END AS split, 'src' || vec_id % 3 AS source FROM u),
  r AS (SELECT vec_id, 'family' AS rank, '' AS parent, fam AS taxon, split, source, u FROM t UNION ALL SELECT vec_id, 'genus', fam, gen, split, source, u FROM t
    UNION ALL SELECT vec_id, 'species', fam || chr(31) || gen, 'sp' || label, split, source, u FROM t WHERE vec_id % 5 <> 0),
  m AS (SELECT rank, parent, taxon, i, avg(u[i]) AS x FROM (SELECT rank, parent, taxon, u, unnest(range(1, 65)) AS i FROM r WHERE split = 'train') GROUP BY ALL),
  c AS (SELECT rank, parent, taxon, list(x ORDER BY i) AS v, sqrt(sum(x * x)) AS n FROM m GROUP BY ALL), cs AS (SELECT rank, parent, taxon, list_transform(v, lambda x: x / greatest(n, 1e-12)) AS c FROM c)"""


def split_by_id(t):
    k = F.col("record_id").cast("long") % 10
    return t.withColumn("split", F.when(k < 7, "train").when(k < 9, "val").otherwise("test"))


@query(f"""WITH {RANKED}, s AS (SELECT r.vec_id, r.rank, r.parent, r.taxon, r.split, r.source, cs.taxon AS guess, list_dot_product(r.u, cs.c) AS sim FROM r JOIN cs ON r.rank = cs.rank AND r.parent = cs.parent WHERE r.split <> 'train'),
  h AS (SELECT rank, parent, split, source, k FROM (SELECT *, row_number() OVER (PARTITION BY vec_id, rank ORDER BY sim DESC, guess) AS k FROM s) WHERE guess = taxon),
  x AS (SELECT rank, parent, unnest([{{'d': 'all', 'v': ''}}, {{'d': 'split', 'v': split}}, {{'d': 'source', 'v': source}}]) AS x, k FROM h)
  SELECT rank, parent, x.d AS dimension, x.v AS value, count(*) AS n, count(*) FILTER (k = 1) AS top1, count(*) FILTER (k <= 5) AS top5, round(count(*) FILTER (k = 1) / count(*), 6) AS rate1, round(count(*) FILTER (k <= 5) / count(*), 6) AS rate5 FROM x GROUP BY ALL""")
def c29_evaluate(spark, d):
    """Centroids of the training rows as heads, each asked at the true parent of the other rows: metrics of each head."""
    t = split_by_id(labelled(spark, d))
    return evaluation.evaluate(t, learning.centroid_heads(t.filter("split = 'train'"))).metrics


@query(f"""WITH {RANKED}, s AS (SELECT r.vec_id, r.rank, r.parent, r.taxon, cs.taxon AS guess, list_dot_product(r.u, cs.c) AS sim FROM r JOIN cs ON r.rank = cs.rank AND r.parent = cs.parent WHERE r.split <> 'train'),
  b AS (SELECT rank, parent, taxon AS truth, guess AS predicted, count(*) AS n FROM (SELECT *, row_number() OVER (PARTITION BY vec_id, rank ORDER BY sim DESC, guess) AS k FROM s) WHERE k = 1 AND guess <> taxon GROUP BY ALL)
  SELECT *, CAST(row_number() OVER (PARTITION BY rank, parent ORDER BY n DESC, truth, predicted) AS INTEGER) AS nth FROM b""")
def c29_confusions(spark, d):
    """The errors of the same heads, most frequent first."""
    t = split_by_id(labelled(spark, d))
    return evaluation.evaluate(t, learning.centroid_heads(t.filter("split = 'train'"))).confusions


@query(f"""WITH {RANKED}, q AS (SELECT cs.*, greatest(-1, least(1, quantile_cont(list_dot_product(r.u, cs.c), 0.05) - 0.02)) AS limits FROM r JOIN cs ON r.rank = cs.rank AND r.parent = cs.parent AND r.taxon = cs.taxon WHERE r.split = 'train' GROUP BY ALL),
  f AS (SELECT t.vec_id, q.rank, q.parent, q.taxon, list_dot_product(t.u, q.c) AS sim, limits FROM t JOIN q ON q.rank = 'family'),
  fr AS (SELECT *, exp(sim) / sum(exp(sim)) OVER (PARTITION BY vec_id) AS p, row_number() OVER (PARTITION BY vec_id ORDER BY sim DESC, taxon) AS nth FROM f),
  g AS (SELECT t.vec_id, q.rank, q.parent, q.taxon, list_dot_product(t.u, q.c) AS sim, q.limits FROM fr JOIN t ON t.vec_id = fr.vec_id JOIN q ON q.rank = 'genus' AND q.parent = fr.taxon WHERE fr.nth = 1 AND fr.sim >= fr.limits),
  gr AS (SELECT *, exp(sim) / sum(exp(sim)) OVER (PARTITION BY vec_id) AS p, row_number() OVER (PARTITION BY vec_id ORDER BY sim DESC, taxon) AS nth FROM g),
  s AS (SELECT t.vec_id, q.rank, q.parent, q.taxon, list_dot_product(t.u, q.c) AS sim, q.limits FROM gr JOIN t ON t.vec_id = gr.vec_id JOIN q ON q.rank = 'species' AND q.parent = gr.parent || chr(31) || gr.taxon WHERE gr.nth = 1 AND gr.sim >= gr.limits),
  sr AS (SELECT *, exp(sim) / sum(exp(sim)) OVER (PARTITION BY vec_id) AS p, row_number() OVER (PARTITION BY vec_id ORDER BY sim DESC, taxon) AS nth FROM s),
  w AS (SELECT * FROM fr UNION ALL SELECT * FROM gr UNION ALL SELECT * FROM sr)
  SELECT CAST(vec_id AS VARCHAR) AS record_id, rank, taxon, round(p, 6) AS probability, CAST(nth AS INTEGER) AS nth, coalesce(max(CASE WHEN nth = 1 AND sim < limits THEN rank END) OVER (PARTITION BY vec_id), '') AS rejected_rank FROM w""")
def c27_descend(spark, d):
    """All rows descend through centroids as heads, routed to the heads of their parents; probabilities of each class met."""
    t = split_by_id(labelled(spark, d))
    found = learning.predict_hierarchical(t, learning.centroid_heads(t.filter("split = 'train'")), bound=0)
    return found.select("record_id", F.explode("candidates").alias("c"), F.coalesce("rejected_rank", F.lit("")).alias("rejected_rank")).select("record_id", "c.rank", "c.taxon", "c.probability", "c.nth", "rejected_rank")


@query("SELECT CAST(doc_id % 4 AS VARCHAR) AS shard, count(*) AS n, count(*) FILTER (strlen(text) >= 40) AS embedded, CAST(CASE WHEN doc_id % 4 = 1 THEN 2 ELSE 1 END AS BIGINT) AS runs FROM documents GROUP BY ALL")
def c21_resume(spark, d):
    """Four shards embedded; then one of them lost its rows of odd tens and is embedded anew when they are back, the others are skipped."""
    out = shared.shared_folder(spark)
    t = read(spark, d, "documents").select(F.col("doc_id").alias("record_id"), "text", (F.col("doc_id") % 4).alias("shard"))
    ask = lambda rows: learning.embed_shards(rows, "shard", lengths, "text", {"encoder": "lengths"}, out, least=0.5)
    ask(t.filter("shard <> 1 OR record_id % 20 < 10"))
    made = ask(t)
    runs = spark.read.schema(learning.RUNS).parquet(f"{out}/runs").groupBy("shard").agg(F.count("*").alias("runs"))
    return made.groupBy("shard").agg(F.count("*").alias("n"), F.count("embedding").alias("embedded")).join(runs, "shard")


def _reported(model: str, dims: int) -> str:
    """SQL: accuracy by the nearest centroid over the first ``dims`` dimensions."""
    units, means = UNITS.replace("embedding::DOUBLE[]", f"embedding[1:{dims}]::DOUBLE[]"), MEANS.replace("range(1, 65)", f"range(1, {dims + 1})")
    return f"""SELECT '{model}' AS model, CASE g WHEN 3 THEN 'all' WHEN 1 THEN 'label' ELSE 'source' END AS dimension, coalesce(label, source, '') AS value, n, top1, top5, round(top1 / n, 6) AS rate1, round(top5 / n, 6) AS rate5 FROM (
      WITH {units}, {means}, s AS (SELECT vec_id, u.label, c.label AS guess, round(list_dot_product(u, c), 9) AS sim FROM u, c),
      r AS (SELECT vec_id, label, guess, row_number() OVER (PARTITION BY vec_id ORDER BY sim DESC, CAST(guess AS VARCHAR)) AS k FROM s),
      h AS (SELECT CAST(label AS VARCHAR) AS label, 'src' || (vec_id % 3) AS source, k FROM r WHERE label = guess)
      SELECT grouping(label, source) AS g, label, source, count(*) AS n, count(*) FILTER (k = 1) AS top1, count(*) FILTER (k <= 5) AS top5 FROM h GROUP BY GROUPING SETS ((), (label), (source)))"""


@query(" UNION ALL ".join(_reported(model, dims) for model, dims in (("whole", 64), ("part", 8))))
def c29_compare(spark, d):
    """Two models over one cohort: nearest centroids over all 64 dimensions and over the first eight."""
    t = read(spark, d, "embeddings")
    truth = t.select("vec_id", F.col("label").cast("string").alias("label"), F.concat(F.lit("src"), F.col("vec_id") % 3).alias("source"))
    digest = records.fingerprint(truth, ["vec_id", "label", "source"]).first()["digest"]

    def reported(dims: int):
        part = t.withColumn("embedding", F.slice("embedding", 1, dims))
        ranked = vectors.guesses(part, vectors.centroids(part, "label"), "label", 5)
        return digest, evaluation.accuracy(truth, ranked, "vec_id", "label", ["label", "source"])

    return evaluation.compare({"whole": reported(64), "part": reported(8)})


@query("""WITH c AS (SELECT CASE WHEN p_partkey % 3 = 0 THEN '10.1/' || p_size ELSE '' END AS doi, 'https://k.org/' || p_partkey AS url, p_name AS title, CASE WHEN p_size % 10 = 0 THEN [] ELSE [lower(p_brand)] END AS families, [lower(split_part(p_name, ' ', 1))] AS genera FROM part),
  a AS (SELECT n_nationkey AS record_id, 'brand#1' || (1 + n_nationkey % 5) AS family, lower(n_name) AS g FROM nation),
  h AS (SELECT record_id, doi, url, title, CASE WHEN list_has_any(genera, ['part', g]) THEN CAST(110 AS DOUBLE) ELSE 100 END AS score FROM a, c WHERE len(families) = 0 OR list_contains(families, family) OR list_has_any(genera, ['part', g])
    UNION ALL SELECT n_nationkey, '', 'https://found.org/' || n_nationkey, 'Found', CAST(105 AS DOUBLE) FROM nation),
  b AS (SELECT record_id, lower(coalesce(nullif(doi, ''), url)) AS i, max(struct_pack(s := score, t := title, d := doi, u := url)) AS m FROM h GROUP BY ALL)
  SELECT record_id, CAST(nth AS INTEGER) AS nth, s AS score, t AS title FROM (SELECT record_id, m.s AS s, m.t AS t, row_number() OVER (PARTITION BY record_id ORDER BY m.s DESC, m.t, m.d, m.u) AS nth FROM b) WHERE nth <= 12""")
def c31_t3_recommend(spark, d):
    k = F.col("p_partkey")
    catalog = read(spark, d, "part").select(
        F.when(k % 3 == 0, F.concat(F.lit("10.1/"), "p_size")).otherwise("").alias("doi"), F.concat(F.lit("https://k.org/"), k).alias("url"), F.col("p_name").alias("title"),
        F.when(F.col("p_size") % 10 == 0, F.array().cast("array<string>")).otherwise(F.array("p_brand")).alias("families"), F.slice(F.split("p_name", " "), 1, 1).alias("genera"))
    nation = read(spark, d, "nation").withColumnRenamed("n_nationkey", "record_id")
    asked = nation.select("record_id", F.concat(F.lit("BRAND#1"), 1 + F.col("record_id") % 5).alias("family"), F.array(F.lit("Part"), F.lit(" "), F.lit("PART"), "n_name").alias("genera"))
    found = nation.select("record_id", F.lit("").alias("doi"), F.concat(F.lit("https://found.org/"), "record_id").alias("url"), F.lit("Found").alias("title"), F.lit(105.0).alias("score"))
    return references.recommend(asked, catalog, found).select("record_id", "nth", "score", "title")


@query("""SELECT 'blank_id' AS problem, CAST(c_custkey AS VARCHAR) AS subject FROM customer WHERE c_custkey % 10 = 0 UNION ALL SELECT 'archive_location', 'p' || c_custkey FROM customer WHERE c_custkey % 10 <> 0 AND c_custkey % 7 = 0
  UNION ALL SELECT 'family_out_of_scope', lower(n_name) FROM nation WHERE n_regionkey = 4 AND n_nationkey IN (SELECT c_nationkey FROM customer)
  UNION ALL SELECT 'shortfall', lower(n_name) FROM nation LEFT JOIN (SELECT c_nationkey, count(*) AS n FROM customer GROUP BY 1) ON c_nationkey = n_nationkey WHERE n_regionkey <> 4 AND coalesce(n, 0) < (SELECT count(*) // 25 FROM customer)""")
def q7_saved_topup(spark, d):
    nation, customer = read(spark, d, "nation"), read(spark, d, "customer")
    k = F.col("c_custkey")
    t = customer.join(F.broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.when(k % 10 == 0, " ").otherwise(F.concat(F.lit("p"), k)).alias("processid"), F.col("n_name").alias("family"), F.when((k % 7 == 0) & (k % 10 != 0), "elsewhere").otherwise("train").alias("archive_group"), k.cast("string").alias("archive_member"))
    families = [r[0] for r in nation.filter("n_regionkey <> 4").select("n_name").collect()]  # 25 nations
    return evaluation.topup_problems(t, families, customer.count() // 25)


@query("""WITH a AS (SELECT source, count(*) AS n FROM documents GROUP BY source), w AS (SELECT 'src0' AS subject, 5 AS requested UNION ALL SELECT 'src1', 0 UNION ALL SELECT 'nowhere', 7 UNION ALL SELECT 'src2', 100000000)
  SELECT CASE WHEN requested <= 0 THEN 'not_positive' ELSE 'shortfall' END AS problem, subject, CAST(requested AS BIGINT) AS requested, CAST(coalesce(n, 0) AS BIGINT) AS available FROM w LEFT JOIN a ON source = subject WHERE requested <= 0 OR coalesce(n, 0) < requested
  UNION ALL SELECT 'total', '', 100000012, 12""")
def q8_quota_totals(spark, d):
    available = read(spark, d, "documents").groupBy("source").agg(F.count("*").alias("available"))
    return evaluation.quota_problems(available, {"src0": 5, "src1": 0, "nowhere": 7, "src2": 100_000_000}, 12)


@query("SELECT 'dimension' AS setting, '64' AS least, CASE WHEN count(*) > 0 THEN '65' END AS most FROM embeddings UNION ALL SELECT 'model', '', 'm1'")
def q9_shard_settings(spark, d):
    k = F.col("vec_id") % 4
    t = read(spark, d, "embeddings").select(k.alias("shard"), (F.size("embedding") + F.when(k == 3, 1).otherwise(0)).alias("dimension"), F.when(k != 2, "m1").alias("model"), F.lit(True).alias("normalized"))
    return evaluation.setting_conflicts(t, "shard", ["dimension", "model", "normalized"])


@query("""WITH o AS (SELECT count(*) AS n, count(DISTINCT o_custkey) AS ids FROM orders) SELECT 'manifest_rows' AS problem, n + 1 AS expected, n AS found FROM o UNION ALL SELECT 'repeated_ids', n, ids FROM o WHERE n <> ids
  UNION ALL SELECT 'sharded_rows', n, n - 3 FROM o UNION ALL SELECT 'shard_too_large', 100, max(m) - 3 FROM (SELECT count(*) AS m FROM orders GROUP BY o_orderkey % 5)""".replace("max(m) - 3", "max(m - CASE WHEN s = 0 THEN 3 ELSE 0 END)").replace("SELECT count(*) AS m FROM orders", "SELECT o_orderkey % 5 AS s, count(*) AS m FROM orders"))
def q10_gate_state(spark, d):
    """The report counts a row too many, the shards lack three rows, ids repeat."""
    t = read(spark, d, "orders")
    report = t.agg((F.count("*") + 1).alias("accepted_rows"))
    shards = t.groupBy((F.col("o_orderkey") % 5).alias("shard_id")).agg(F.count("*").alias("n")).select("shard_id", (F.col("n") - F.when(F.col("shard_id") == 0, 3).otherwise(0)).alias("rows"))
    return evaluation.gate_problems(report, t, shards, 100, "o_custkey")


Q12 = {"rows": "count(*)", "users": "count(DISTINCT user_id)", "first_user": "min(user_id)", "first_event": "min(event_id)", "last_k": "max(json_extract_string(props, '$.k'))", "year": "max(year(ts))"}


@query(f"""WITH r AS (SELECT event_type, {', '.join(f"CAST({v} AS VARCHAR) AS {k}" for k, v in Q12.items())} FROM events GROUP BY event_type), s AS (UNPIVOT r ON {', '.join(Q12)} INTO NAME setting VALUE value)
  SELECT setting, min(value) AS least, max(value) AS most FROM s GROUP BY setting HAVING min(value) <> max(value)""")
def q12_resumed_settings(spark, d):
    """A run an event type, its settings counted from its events: those differ that the types don't share."""
    runs = read(spark, d, "events").groupBy("event_type").agg(
        F.count("*").alias("rows"), F.countDistinct("user_id").alias("users"), F.min("user_id").alias("first_user"), F.min("event_id").alias("first_event"), F.max(F.get_json_object("props", "$.k")).alias("last_k"), F.max(F.year("ts")).alias("year"))
    return evaluation.setting_conflicts(runs, "event_type", list(Q12))


@query("SELECT 'left' AS side, 'alone' AS problem, count(*) AS n FROM embeddings WHERE vec_id % 5 = 0 UNION ALL SELECT 'right', 'repeated', count(*) FROM embeddings WHERE vec_id % 5 <> 0 AND vec_id % 7 = 0")
def j11_key_problems(spark, d):
    t = read(spark, d, "embeddings").select("vec_id")
    right = t.filter("vec_id % 5 <> 0")
    return vectors.key_problems(t, right.unionAll(right.filter("vec_id % 7 = 0")), "vec_id")


C12 = f"""WITH RECURSIVE e AS (SELECT processid, split AS source, split, chunk, CASE WHEN k % 3 = 0 THEN 'species:S s' || k % 20 ELSE 'genus:g' || lang END AS bucket FROM (
    SELECT CAST(doc_id AS VARCHAR) AS processid, doc_id AS k, lang, ['train', 'val', 'pretrain'][1 + doc_id % 3] AS split, CAST(doc_id % 4 AS VARCHAR) AS chunk FROM documents)),
  k AS (SELECT count(*) // 3 AS total FROM documents), wanted AS (SELECT * FROM (VALUES ('train', 3), ('val', 1), ('pretrain', 2)) AS v(source, requested)),
  {planned("e", "wanted", "(SELECT total FROM k)", "(SELECT greatest(1, total // 10) FROM k)", 42, "processid")}
  SELECT processid, split, bucket, CASE WHEN split = 'val' THEN 'eval' ELSE split END AS archive_group, split || '/' || chunk || '/' || processid || '.jpg' AS archive_member FROM picked"""


@query(C12)
def c12_select_balanced(spark, d):
    """Splits by target, taxa by square roots; the splits are asked in the order of their names, as the SQL deals remainders."""
    k = F.col("doc_id")
    t = read(spark, d, "documents").select(k.cast("string").alias("processid"), F.concat(F.lit("f"), "source").alias("family"), F.concat(F.lit("g"), "lang").alias("genus"), F.when(k % 3 == 0, F.concat(F.lit("S s"), k % 20)).otherwise("").alias("species"), F.get(F.array(F.lit("train"), F.lit("val"), F.lit("pretrain")), (k % 3).cast("int")).alias("split"), (k % 4).cast("string").alias("chunk"))
    total = t.count() // 3
    return sampling.select_balanced(t, {"pretrain": 2, "train": 3, "val": 1}, total, max(1, total // 10), 42).select("processid", "split", "bucket", "archive_group", "archive_member")
