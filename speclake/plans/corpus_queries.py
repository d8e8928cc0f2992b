"""Composite corpus operators bound to documents and labels."""

from __future__ import annotations

from pyspark.sql import functions as F

from speclake.functions import scalars as S
from speclake.operators import manifest, records, sampling
from speclake.plans.register import read, registry

QUERIES, SQL, query = registry()


def bound(spark, d):
    """documents and labels in the shape of a manifest: families are languages, label quality comes from the labels."""
    t = read(spark, d, "documents").join(read(spark, d, "labels"), "doc_id", "left")
    quality = F.when((F.col("quality") == 1) & (F.col("toxic") == 0), "A").when(F.col("quality") == 1, "B").when(F.col("toxic") == 0, "C").when(F.col("toxic") == 1, "E").otherwise("D")
    return t.select(
        F.concat(F.lit("doc:"), "doc_id").alias("record_id"), "doc_id", "source", F.col("lang").alias("family"), F.concat("lang", F.col("n_chars") % 7).alias("genus"),
        quality.alias("label_quality"), F.sha2("text", 256).alias("duplicate_key"), F.lit("CC BY 4.0").alias("image_license"), F.col("toxic").isNotNull().alias("labelled"),
    )


BOUND = """bound AS (SELECT 'doc:' || CAST(d.doc_id AS VARCHAR) AS record_id, d.doc_id, source, lang AS family, lang || CAST(n_chars % 7 AS VARCHAR) AS genus,
  CASE WHEN quality = 1 AND toxic = 0 THEN 'A' WHEN quality = 1 THEN 'B' WHEN toxic = 0 THEN 'C' WHEN toxic = 1 THEN 'E' ELSE 'D' END AS label_quality,
  sha256(text) AS duplicate_key, toxic IS NOT NULL AS labelled FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""
BEST = "row_number() OVER (PARTITION BY duplicate_key ORDER BY label_quality, record_id)"


def deduplicated(spark, d):
    t = bound(spark, d)
    return manifest.deduplicate(t.withColumn("priority", S.priority(S.normalize_license(F.col("image_license")), F.col("label_quality"), F.col("source"), F.col("record_id"))))


@query(f"""WITH {BOUND}, kept AS (SELECT *, count(*) OVER (PARTITION BY duplicate_key) AS n, {BEST} AS r FROM bound),
  split AS (SELECT *, ('0x' || substr(sha256(duplicate_key), 1, 8))::UBIGINT % 100 AS b FROM kept WHERE r = 1)
  SELECT source, CASE WHEN b < 80 THEN 'train' WHEN b < 90 THEN 'val' ELSE 'test' END AS split, count(*) AS rows, CAST(sum(CAST(labelled AS INTEGER)) AS BIGINT) AS with_label,
  CAST(sum(CAST(n > 1 AS INTEGER)) AS BIGINT) AS duplicate_groups FROM split GROUP BY ALL""")
def c11_dedup_audit(spark, d):
    t = deduplicated(spark, d).withColumn("split", S.split_of(F.col("duplicate_key")))
    return t.groupBy("source", "split").agg(F.count("*").alias("rows"), F.count_if("labelled").alias("with_label"), F.count_if(F.col("group_size") > 1).alias("duplicate_groups"))


@query(f"WITH {BOUND} SELECT record_id, n AS group_size, CASE WHEN n > 1 THEN 'dup:' || substr(sha256(duplicate_key), 1, 24) ELSE '' END AS duplicate_group_id FROM (SELECT *, count(*) OVER (PARTITION BY duplicate_key) AS n, {BEST} AS r FROM bound) WHERE r = 1")
def w1_deduplicate(spark, d):
    return deduplicated(spark, d).select("record_id", "group_size", "duplicate_group_id")


@query(f"WITH {BOUND} SELECT record_id, count(*) OVER (PARTITION BY duplicate_key) AS group_size FROM bound")
def w1b_keep_all(spark, d):
    return manifest.deduplicate(bound(spark, d), keep_all=True).select("record_id", "group_size")


@query(f"""WITH {BOUND} SELECT record_id, 'img:' || '' AS none, family, genus, 'genus' AS identification_level, 'CC-BY' AS image_license, source || ':' || record_id AS specimen_group_id, TRUE AS eligible_supervised, '' AS exclusion_reason FROM bound""".replace("'img:' || '' AS none, ", ""))
def p8_finalize(spark, d):
    t = bound(spark, d).withColumn("source_record_id", F.col("record_id"))
    return manifest.finalize(t).select("record_id", "family", "genus", "identification_level", "image_license", "specimen_group_id", "eligible_supervised", "exclusion_reason")


@query(f"""WITH {BOUND}, m AS (SELECT *, ('0x' || substr(sha256(source || ':' || record_id), 1, 8))::UBIGINT % 100 AS b FROM bound)
  SELECT record_id, CASE WHEN b < 80 THEN 'train' WHEN b < 90 THEN 'val' ELSE 'test' END AS split FROM m""")
def c10_build_master(spark, d):
    t = bound(spark, d).withColumn("source_record_id", F.col("record_id"))
    return manifest.build_master(t.filter("doc_id % 2 = 0"), t.filter("doc_id % 2 = 1").drop("labelled")).select("record_id", "split")


@query(f"""WITH RECURSIVE {BOUND}, m AS (SELECT record_id, source, 'd:dup:' || duplicate_key AS d, 's:sp' || (doc_id // 3) AS s, CASE WHEN source = 'src3' AND doc_id % 2 = 0 THEN 0 WHEN source = 'src3' THEN 2 END AS fixed, count(*) OVER (PARTITION BY duplicate_key) AS n FROM bound),
  r AS (SELECT *, CASE WHEN n > 1 THEN d ELSE s END AS node FROM m), e AS (SELECT DISTINCT node AS a, s AS b FROM r UNION SELECT DISTINCT s, node FROM r),
  reach AS (SELECT DISTINCT a, a AS b FROM e UNION SELECT reach.a, e.b FROM reach JOIN e ON reach.b = e.a), root AS (SELECT a AS node, min(b) AS root FROM reach GROUP BY a),
  held AS (SELECT root, min(fixed) AS fixed FROM r JOIN root USING (node) GROUP BY root), z AS (SELECT record_id, substr(root.root, 3) AS split_group, held.fixed FROM r JOIN root USING (node) JOIN held ON held.root = root.root),
  b AS (SELECT *, ('0x' || substr(sha256(split_group), 1, 8))::UBIGINT % 100 AS b FROM z)
  SELECT record_id, split_group, CASE WHEN fixed = 0 OR fixed IS NULL AND b >= 90 THEN 'test' WHEN fixed IS NULL AND b >= 80 THEN 'val' ELSE 'train' END AS split FROM b""")
def c10_component_master(spark, d):
    """Specimens of three documents, linked by copies of texts; one source has official hold-outs, which hold for all that is linked to them."""
    t = bound(spark, d)
    twins = t.groupBy(F.col("duplicate_key").alias("_key")).agg(F.count("*").alias("_n"))
    t = t.join(twins, F.col("duplicate_key") == F.col("_key")).select(
        "record_id", "source", F.col("record_id").alias("source_record_id"), "family", "genus", "image_license", F.concat(F.lit("sp"), F.floor(F.col("doc_id") / 3)).alias("specimen_group_id"),
        F.when(F.col("_n") > 1, F.concat(F.lit("dup:"), "duplicate_key")).otherwise("").alias("duplicate_group_id"), F.when(F.col("doc_id") % 2 == 0, "test").otherwise("train").alias("source_split"))
    return manifest.build_master(t, official_source="src3", group_mode="component").select("record_id", "split_group", "split")


@query(f"""WITH {BOUND} SELECT 'all' AS dimension, '' AS value, count(*) AS n FROM bound UNION ALL SELECT 'source', source, count(*) FROM bound GROUP BY source
  UNION ALL SELECT 'label_quality', label_quality, count(*) FROM bound GROUP BY label_quality UNION ALL SELECT 'family', family, count(*) FROM bound GROUP BY family""")
def a1_audit(spark, d):
    """One pass by grouping sets."""
    bound(spark, d).createOrReplaceTempView("_audited")
    return spark.sql("""SELECT CASE grouping_id(source, label_quality, family) WHEN 7 THEN 'all' WHEN 3 THEN 'source' WHEN 5 THEN 'label_quality' ELSE 'family' END AS dimension,
      coalesce(source, label_quality, family, '') AS value, count(*) AS n FROM _audited GROUP BY GROUPING SETS ((), (source), (label_quality), (family))""")


@query(f"""WITH {BOUND}, s AS (SELECT *, ('0x' || substr(sha256(duplicate_key), 1, 8))::UBIGINT % 100 AS b FROM bound)
  SELECT CASE WHEN b < 90 THEN 'val' ELSE 'test' END AS split, source, count(*) AS n, count(DISTINCT duplicate_key) AS groups FROM s WHERE b >= 80 GROUP BY ALL""")
def a5_frozen_cohort(spark, d):
    t = bound(spark, d).withColumn("split", S.split_of(F.col("duplicate_key"))).filter("split IN ('val', 'test')")
    return t.groupBy("split", "source").agg(F.count("*").alias("n"), F.count_distinct("duplicate_key").alias("groups"))


@query(f"""WITH {BOUND} SELECT record_id FROM bound WHERE label_quality <> 'E' AND doc_id % 9 <> 0 AND doc_id % 10 <> 5 AND family IN (SELECT family FROM bound GROUP BY family ORDER BY count(*) DESC, family LIMIT 2)""")
def f7_plan_eligible(spark, d):
    """Not eligible, without a bucket, without a place, out of scope: each rejects some rows."""
    k = F.col("doc_id")
    t = bound(spark, d).withColumns({"eligible_supervised": F.col("label_quality") != "E", "bucket": F.when(k % 9 == 0, "").otherwise(F.col("genus")), "image_url": F.when(k % 2 == 0, "https://x.org/1").otherwise(""), "local_path": F.when((k % 2 == 1) & (k % 10 != 5), "a.jpg").otherwise(" ")})
    scope = t.groupBy("family").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "family").limit(2).select(F.upper("family").alias("family"))
    return records.plan_eligible(t, scope=scope).select("record_id")


def rounds(name: str, strata: str, part: str, taxon: str, weight: str) -> str:
    """SQL for ``sampling.granted``: tables ``name``_r (all rounds) and ``name`` ({part}, {taxon}, given) over ``strata`` ({part}, {taxon}, lim, total, weight columns)."""
    over, before = f"OVER (PARTITION BY {part})", f"OVER (PARTITION BY {part} ORDER BY {taxon} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    return f"""{name}_r AS (SELECT 0 AS round, *, 0 AS given, least(total, sum(lim) {over}) AS rest FROM {strata}
  UNION ALL SELECT round + 1, * EXCLUDE (round, given, rest, w, want, more), given + more, rest - sum(more) {over} FROM (
    SELECT *, greatest(0, least(want, rest - coalesce(sum(want) {before}, 0))) AS more FROM (
      SELECT *, CASE WHEN given < lim THEN least(greatest(1, floor(rest * w / sum(w) {over})), lim - given) ELSE 0 END AS want FROM (
        SELECT *, CASE WHEN given < lim THEN CAST({weight} AS DOUBLE) ELSE 0 END AS w FROM {name}_r WHERE rest > 0)))),
  {name} AS (SELECT {part}, {taxon}, CAST(max(given) AS BIGINT) AS given FROM {name}_r GROUP BY ALL)"""


def planned(rows: str, wanted: str, total: str, cap: str, seed: int, identity: str) -> str:
    """SQL tables of ``sampling.plan`` over ``rows`` (source, bucket, {identity}) and ``wanted`` (source, requested): the last one is picked."""
    return f"""st AS (SELECT source, bucket, count(*) AS n FROM {rows} GROUP BY ALL), ss AS (SELECT 0 AS one, source, CAST(sum(n) AS BIGINT) AS lim, {total} AS total, any_value(requested) AS requested FROM st JOIN {wanted} w USING (source) GROUP BY source),
  {rounds("sh", "ss", "one", "source", "requested")}, bs AS (SELECT st.source, bucket, least(n, {cap}) AS lim, given AS total FROM st JOIN sh USING (source)),
  {rounds("bu", "bs", "source", "bucket", "sqrt(lim - given)")},
  ranked AS (SELECT *, row_number() OVER (PARTITION BY source, bucket ORDER BY substr(sha256('{seed}' || chr(31) || {identity}), 1, 16), {identity}) AS nth FROM {rows}),
  picked AS (SELECT ranked.* FROM ranked JOIN bu ON ranked.source = bu.source AND ranked.bucket = bu.bucket WHERE nth <= given)"""


C15 = f"""WITH RECURSIVE {BOUND}, e AS (SELECT *, 'genus:' || genus AS bucket FROM bound WHERE label_quality <> 'E'), k AS (SELECT count(*) // 2 AS total FROM e),
  wanted AS (SELECT source, 1 + (row_number() OVER (ORDER BY source) - 1) % 3 AS requested FROM (SELECT DISTINCT source FROM e)),
  {planned("e", "wanted", "(SELECT total FROM k)", "(SELECT greatest(1, total // 20) FROM k)", 42, "record_id")}"""


@query(f"{C15} SELECT record_id, source, bucket FROM picked")
def c15_plan_corpus(spark, d):
    """Weighted sources, square-root taxa, lowest scores."""
    t = bound(spark, d).filter("label_quality <> 'E'").withColumn("bucket", S.sampling_bucket(F.col("label_quality"), F.lit(""), F.col("genus"), F.col("family")))
    sources = [r[0] for r in t.select("source").distinct().orderBy("source").collect()]
    total = t.count() // 2
    return sampling.plan(t, {s: 1 + i % 3 for i, s in enumerate(sources)}, total, max(1, total // 20), 42).select("record_id", "source", "bucket")


@query(f"""{C15} SELECT source, bucket, given AS budget FROM bu""")
def c14_budgets(spark, d):
    """Each source's share dealt to its taxa by square roots."""
    t = bound(spark, d).filter("label_quality <> 'E'").withColumn("bucket", F.concat(F.lit("genus:"), "genus"))
    names = [r[0] for r in t.select("source").distinct().orderBy("source").collect()]
    total = t.count() // 2
    strata = t.groupBy("source", "bucket").agg(F.count("*").alias("available"))
    return sampling.budgets(strata, {s: 1 + i % 3 for i, s in enumerate(names)}, total, max(1, total // 20), "bucket").select("source", "bucket", "budget")


#: Greedy packing a group at a time; of a size, the shards in order take as many of its groups, by hash, as they got.
SHARDED = f"""WITH RECURSIVE {BOUND}, g AS (SELECT duplicate_key, count(*) AS n FROM bound GROUP BY duplicate_key), s AS (SELECT CAST(greatest(1, least(count(*), CAST(ceil(sum(n) / 100.0) AS BIGINT))) AS BIGINT) AS shards FROM g),
  o AS (SELECT duplicate_key, n, row_number() OVER (ORDER BY n DESC, sha256(duplicate_key)) - 1 AS place FROM g),
  steps AS (SELECT CAST(-1 AS BIGINT) AS place, CAST(0 AS BIGINT) AS n, CAST(0 AS BIGINT) AS shard, [CAST(0 AS BIGINT) FOR x IN range(shards)] AS loads FROM s UNION ALL
    SELECT o.place, o.n, list_position(loads, list_min(loads)), [CASE WHEN i = list_position(loads, list_min(loads)) THEN x + o.n ELSE x END FOR x, i IN loads] FROM steps JOIN o ON o.place = steps.place + 1),
  z AS (SELECT o.duplicate_key, o.n, o.place, k.shard - 1 AS shard_id FROM o JOIN (SELECT n, shard, row_number() OVER (PARTITION BY n ORDER BY shard) AS k FROM steps WHERE place >= 0) k
    ON k.n = o.n AND k.k = o.place - (SELECT min(p.place) FROM o p WHERE p.n = o.n) + 1)"""


@query(f"{SHARDED} SELECT record_id, CAST(shard_id AS INTEGER) AS shard_id FROM bound JOIN z ON bound.duplicate_key = z.duplicate_key")
def c19_assign_shards(spark, d):
    return sampling.assign_shards(bound(spark, d), "duplicate_key", 100).select("record_id", "shard_id")


@query(f"{SHARDED} SELECT duplicate_key, n AS size, CAST(place AS BIGINT) AS place FROM z")
def w9_group_order(spark, d):
    return sampling.group_order(bound(spark, d), "duplicate_key").select("duplicate_key", "size", F.col("at").cast("long").alias("place"))


@query(f"""{SHARDED} SELECT count(*) AS shards, CAST(sum(n) AS BIGINT) AS rows, CAST(min(n) AS BIGINT) AS least, CAST(max(n) AS BIGINT) AS most, 0 AS split_groups FROM (SELECT shard_id, sum(n) AS n FROM z GROUP BY shard_id)""")
def a18_shard_balance(spark, d):
    t = sampling.assign_shards(bound(spark, d), "duplicate_key", 100)
    split = t.groupBy("duplicate_key").agg(F.count_distinct("shard_id").alias("n")).agg(F.count_if(F.col("n") > 1).cast("int").alias("split_groups"))
    sizes = t.groupBy("shard_id").agg(F.count("*").alias("n")).agg(F.count("*").alias("shards"), F.sum("n").alias("rows"), F.min("n").alias("least"), F.max("n").alias("most"))
    return sizes.join(F.broadcast(split))  # one row each


@query(f"WITH {BOUND} SELECT record_id, count(*) AS n FROM bound GROUP BY record_id HAVING count(*) > 1 UNION ALL SELECT family, count(*) FROM bound WHERE family NOT IN ('en', 'fr') GROUP BY family")
def q1_q2_violations(spark, d):
    """Duplicate record ids, and families out of scope."""
    t = bound(spark, d)
    twice = t.groupBy("record_id").agg(F.count("*").alias("n")).filter("n > 1")
    return twice.unionByName(t.filter(~F.col("family").isin("en", "fr")).groupBy(F.col("family").alias("record_id")).agg(F.count("*").alias("n")))


@query(f"WITH {BOUND} SELECT source, round(sum(n * acc) / sum(n), 6) AS accuracy FROM (SELECT source, family, count(*) AS n, avg(CAST(label_quality IN ('A', 'B') AS INTEGER)) AS acc FROM bound GROUP BY source, family) GROUP BY source")
def a13_weighted_mean(spark, d):
    part = bound(spark, d).groupBy("source", "family").agg(F.count("*").alias("n"), F.avg(F.col("label_quality").isin("A", "B").cast("double")).alias("acc"))
    return part.groupBy("source").agg(F.round(F.sum(F.col("n") * F.col("acc")) / F.sum("n"), 6).alias("accuracy"))
