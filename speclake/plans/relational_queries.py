"""Joins, windows, sets and aggregates over the given tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from speclake.functions import documents
from speclake.functions.vectors import rounded
from speclake.operators import manifest, records, references, sampling
from speclake.plans.register import read, registry

QUERIES, SQL, query = registry()


@query("SELECT l_orderkey, l_linenumber, o_custkey, o_orderdate FROM lineitem JOIN orders ON l_orderkey = o_orderkey")
def j1_photos_observations(spark, d):
    last = manifest.last_per_key(read(spark, d, "orders"), ["o_orderkey"], [F.desc("o_orderdate"), F.desc("o_custkey")])
    return read(spark, d, "lineitem").join(last, F.col("l_orderkey") == F.col("o_orderkey")).select("l_orderkey", "l_linenumber", "o_custkey", "o_orderdate")


@query("SELECT o_orderkey, coalesce(c_name, CAST(o_custkey AS VARCHAR)) AS observer FROM orders LEFT JOIN customer ON o_custkey = c_custkey")
def j2_observers(spark, d):
    return read(spark, d, "orders").join(read(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"), "left").select("o_orderkey", F.coalesce("c_name", F.col("o_custkey").cast("string")).alias("observer"))


@query("SELECT c_custkey, n_name AS genus, r_name AS family FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey")
def j3_lineage(spark, d):
    """Ancestry ids exploded, names joined, ranks pivoted; the last name of a rank wins."""
    nation, region = read(spark, d, "nation"), read(spark, d, "region")
    taxa = region.select(F.concat(F.lit("r"), "r_regionkey").alias("taxon"), F.lit("family").alias("rank"), F.col("r_name").alias("name")).unionByName(
        nation.select(F.concat(F.lit("n"), "n_nationkey").alias("taxon"), F.lit("genus").alias("rank"), F.col("n_name").alias("name"))
    )
    paths = nation.select("n_nationkey", F.posexplode(F.array(F.concat(F.lit("r"), "n_regionkey"), F.concat(F.lit("n"), "n_nationkey"))).alias("at", "taxon"))
    ranks = paths.join(taxa, "taxon").groupBy("n_nationkey").agg(*[F.max_by(F.when(F.col("rank") == r, F.col("name")), F.when(F.col("rank") == r, F.col("at"))).alias(r) for r in ("genus", "family")])
    return read(spark, d, "customer").join(ranks, F.col("c_nationkey") == F.col("n_nationkey"), "left").select("c_custkey", "genus", "family")


@query("SELECT c_custkey FROM customer WHERE c_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 1)")
def j4_clade_semi(spark, d):
    clade = read(spark, d, "nation").filter("n_regionkey = 1").select(F.col("n_nationkey").alias("c_nationkey"))
    return read(spark, d, "customer").join(clade, "c_nationkey", "left_semi").select("c_custkey")


@query("SELECT l_orderkey, l_linenumber, p_name FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_size > 20")
def j5_occurrence_media(spark, d):
    return read(spark, d, "lineitem").join(read(spark, d, "part").filter("p_size > 20"), F.col("l_partkey") == F.col("p_partkey")).select("l_orderkey", "l_linenumber", "p_name")


@query("""WITH r AS (SELECT CAST(p_partkey AS VARCHAR) AS record_id, CASE WHEN p_size % 3 = 0 THEN '' ELSE split_part(p_name, ' ', 1) || ' ' || p_size END AS species, CASE WHEN p_size % 2 = 0 THEN '' ELSE p_type END AS original, p_brand AS family, p_size % 7 = 0 AS corrupt FROM part),
  n AS (SELECT *, lower(coalesce(nullif(original, ''), species)) AS k1, array_to_string(string_split(CASE WHEN species = '' THEN original ELSE species END, ' ')[1:2], ' ') AS s FROM r),
  h AS (SELECT *, CASE WHEN k1 LIKE 'a%' OR lower(s) LIKE '% 7' THEN 1 ELSE 0 END AS hit FROM n WHERE k1 IS NOT NULL)
  SELECT record_id, CASE WHEN hit = 1 THEN 'Cus dus' ELSE s END AS species, CASE WHEN hit = 1 THEN 'Cus' ELSE split_part(s, ' ', 1) END AS genus, CASE WHEN hit = 1 THEN 'Cusidae' ELSE family END AS family, CASE WHEN hit = 1 THEN 't1' ELSE 'own' END AS taxon_id,
    CASE WHEN hit = 1 OR s <> '' THEN 'species' ELSE 'family' END AS identification_level, NOT corrupt AS eligible_supervised FROM h""")
def c9_j6_harmonize(spark, d):
    """Names that begin with A by original name, those that end in 7 by species; level and eligibility of the rows were others."""
    part, k = read(spark, d, "part"), F.col("p_size")
    species = F.when(k % 3 == 0, "").otherwise(F.concat(F.get(F.split("p_name", " "), 0), F.lit(" "), k))
    rows = part.select(
        F.col("p_partkey").cast("string").alias("record_id"), species.alias("species"), F.when(k % 2 == 0, "").otherwise(F.col("p_type")).alias("original_scientific_name"), F.col("p_brand").alias("family"), F.lit("own").alias("taxon_id"),
        F.lit("family").alias("identification_level"), F.lit("true").alias("eligible_supervised"), F.when(k % 7 == 0, "corrupt_image").otherwise("").alias("exclusion_reason"), F.lit("CC BY 4.0").alias("image_license"), F.lit("wrong").alias("genus"))
    rows = rows.withColumn("genus", F.lit(""))
    named = rows.select(F.col("original_scientific_name").alias("x")).filter("lower(x) LIKE 'a%'").unionAll(rows.filter("original_scientific_name = '' AND lower(species) LIKE 'a%'").select("species")).unionAll(rows.select("species").filter("species LIKE '% 7'"))
    reviewed = named.distinct().select(F.upper("x").alias("synonym"), F.lit("Cus dus (Author)").alias("accepted_name"), F.lit("Cusidae").alias("accepted_family"), F.lit("t1").alias("accepted_taxon_id"))
    return manifest.harmonize(rows, reviewed).select("record_id", "species", "genus", "family", "taxon_id", "identification_level", "eligible_supervised")


@query("SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')")
def j8_anti_selection(spark, d):
    return read(spark, d, "orders").join(read(spark, d, "lineitem").filter("l_returnflag = 'R'"), F.col("o_orderkey") == F.col("l_orderkey"), "left_anti").select("o_orderkey")


@query("""SELECT doc_id, coalesce(CASE WHEN toxic = 1 THEN 'exclude' WHEN quality = 1 THEN 'accept' END, decision) AS decision
  FROM (SELECT d.doc_id, CASE WHEN n_chars > 500 THEN 'accept' ELSE 'review' END AS decision, quality, toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)""")
def j10_overrides(spark, d):
    t = read(spark, d, "documents").join(read(spark, d, "labels"), "doc_id", "left")
    own = F.when(F.col("n_chars") > 500, "accept").otherwise("review")
    return t.select("doc_id", F.coalesce(F.when(F.col("toxic") == 1, "exclude").when(F.col("quality") == 1, "accept"), own).alias("decision"))


@query("""WITH c AS (SELECT p_partkey, CASE WHEN p_size % 10 = 0 THEN [] ELSE [lower(p_brand)] END AS families, [lower(split_part(p_name, ' ', 1)), lower(split_part(p_name, ' ', 2))] AS genera FROM part),
  a AS (SELECT n_nationkey, 'brand#1' || (1 + n_nationkey % 5) AS family, ['part', lower(n_name)] AS genera FROM nation)
  SELECT n_nationkey, p_partkey, list_has_any(a.genera, c.genera) AS by_genus FROM a, c WHERE len(families) = 0 OR list_contains(families, family) OR list_has_any(a.genera, c.genera)""")
def j13_catalog_match(spark, d):
    """Entries without families meet every question; the others by family or by any genus."""
    part = read(spark, d, "part")
    catalog = part.select("p_partkey", F.when(F.col("p_size") % 10 == 0, F.array().cast("array<string>")).otherwise(F.array("p_brand")).alias("families"), F.slice(F.split("p_name", " "), 1, 2).alias("genera"))
    asked = read(spark, d, "nation").select("n_nationkey", F.concat(F.lit("BRAND#1"), 1 + F.col("n_nationkey") % 5).alias("family"), F.array(F.lit("Part"), "n_name").alias("genera"))
    return references.matches(asked, catalog, "n_nationkey", "p_partkey").select("n_nationkey", "p_partkey", "by_genus")


@query("SELECT coalesce(a.doc_id, b.doc_id) AS doc_id, a.doc_id IS NULL AS missing FROM (SELECT doc_id FROM documents WHERE doc_id % 7 <> 0) a FULL JOIN labels b ON a.doc_id = b.doc_id WHERE a.doc_id IS NULL OR b.doc_id IS NULL")
def j15_alignment(spark, d):
    a = read(spark, d, "documents").filter("doc_id % 7 <> 0").select("doc_id", F.lit(1).alias("a"))
    b = read(spark, d, "labels").select("doc_id", F.lit(1).alias("b"))
    return a.join(b, "doc_id", "full").filter("a IS NULL OR b IS NULL").select("doc_id", F.col("a").isNull().alias("missing"))


@query("SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'new' ELSE 'old' END AS version FROM orders")
def j16_merge(spark, d):
    t = read(spark, d, "orders")
    new = t.filter("o_orderstatus = 'F'").select("o_orderkey", F.lit("new").alias("version"))
    return manifest.merge(t.select("o_orderkey", F.lit("old").alias("version")), new, "o_orderkey")


@query("""SELECT source, lang, count(*) AS n FROM documents GROUP BY ROLLUP (source, lang)""")
def a2_availability(spark, d):
    return read(spark, d, "documents").rollup("source", "lang").agg(F.count("*").alias("n"))


@query("SELECT p_partkey, p_brand FROM part WHERE p_brand IN (SELECT p_brand FROM part GROUP BY p_brand HAVING count(*) >= 8)")
def a3_common_taxa(spark, d):
    t = read(spark, d, "part")
    common = t.groupBy("p_brand").agg(F.count("*").alias("n")).filter("n >= 8")
    return t.join(common, "p_brand", "left_semi").select("p_partkey", "p_brand")


@query("SELECT text_id, count(DISTINCT source) AS splits FROM (SELECT sha256(text) AS text_id, source FROM documents) GROUP BY text_id HAVING count(DISTINCT source) > 1")
def a4_leakage(spark, d):
    t = read(spark, d, "documents").select(F.sha2("text", 256).alias("text_id"), "source")
    return t.groupBy("text_id").agg(F.count_distinct("source").alias("splits")).filter("splits > 1")


@query("""SELECT source, count(*) AS n, sum(CASE WHEN n_chars >= 500 THEN 1 ELSE 0 END)::BIGINT AS accepted, sum(CASE WHEN n_chars < 500 THEN 1 ELSE 0 END)::BIGINT AS review,
  round(avg(CASE WHEN n_chars >= 500 THEN 1.0 ELSE 0.0 END), 6) AS fraction FROM documents GROUP BY source""")
def a6_quality_report(spark, d):
    good = F.col("n_chars") >= 500
    return read(spark, d, "documents").groupBy("source").agg(F.count("*").alias("n"), F.count_if(good).alias("accepted"), F.count_if(~good).alias("review"), F.round(F.avg(good.cast("double")), 6).alias("fraction"))


@query("""WITH w AS (SELECT doc_id, 1 / sqrt(count(*) OVER (PARTITION BY lang) * CAST(count(*) OVER (PARTITION BY source) AS DOUBLE)) AS w FROM documents)
  SELECT doc_id, round(greatest(0.1, least(10, w / (SELECT avg(w) FROM w))), 6) AS weight FROM w""")
def a10_weights(spark, d):
    t = read(spark, d, "documents")
    by = lambda c: t.groupBy(c).agg(F.count("*").alias(f"n_{c}"))  # noqa: E731  small tables, so no window over hot classes
    w = t.join(by("lang"), "lang").join(by("source"), "source").select("doc_id", (1 / F.sqrt(F.col("n_lang") * F.col("n_source").cast("double"))).alias("w"))
    return w.join(F.broadcast(w.agg(F.avg("w").alias("mean")))).select("doc_id", F.round(F.greatest(F.lit(0.1), F.least(F.lit(10.0), F.col("w") / F.col("mean"))), 6).alias("weight"))


@query("""WITH c AS (SELECT doc_id, unnest(string_split(text, '')) AS ch FROM documents), n AS (SELECT doc_id, ch, count(*) AS n FROM c GROUP BY doc_id, ch),
  t AS (SELECT doc_id, ord(ch) AS v, n, n / sum(n) OVER (PARTITION BY doc_id) AS p FROM n) SELECT doc_id, round(-sum(p * log2(p)), 6) AS entropy, round(sqrt(greatest(0, sum(p * v * v) - sum(p * v) ** 2)), 4) AS deviation FROM t GROUP BY doc_id""")
def a15_entropy(spark, d):
    """Entropy and deviation of each text's characters, counted in the row; ``doc_id`` is the key. One piece alone, as an empty text is, has -0.0 bits."""
    spread = read(spark, d, "documents").filter("text IS NOT NULL").select("doc_id", documents.character_spread("text").alias("s"))
    return spread.select("doc_id", rounded(F.coalesce("s.entropy", F.lit(-0.0)), 6).alias("entropy"), F.round(F.coalesce("s.deviation", F.lit(0.0)), 4).alias("deviation"))


@query("SELECT count(*) AS groups, CAST(sum(n - 1) AS BIGINT) AS removed FROM (SELECT count(*) AS n FROM documents GROUP BY text) WHERE n > 1")
def a17_duplicate_groups(spark, d):
    n = read(spark, d, "documents").groupBy(F.sha2("text", 256)).agg(F.count("*").alias("n")).filter("n > 1")
    return n.agg(F.count("*").alias("groups"), F.sum(F.col("n") - 1).alias("removed"))


@query("""SELECT o_orderkey, o_orderpriority FROM (SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY substr(sha256('7' || chr(31) || CAST(o_orderkey AS VARCHAR)), 1, 16), o_orderkey) AS r,
  count(*) OVER (PARTITION BY o_orderpriority) // 10 AS k FROM orders) WHERE r <= k""")
def w2_lowest_per_stratum(spark, d):
    t = read(spark, d, "orders")
    budgets = t.groupBy("o_orderpriority").agg(F.floor(F.count("*") / 10).alias("k"))
    return sampling.lowest(t.join(budgets, "o_orderpriority"), ["o_orderpriority"], "k", 7, "o_orderkey").select("o_orderkey", "o_orderpriority")


@query("""WITH s AS (SELECT *, substr(sha256('3' || chr(31) || CAST(p_partkey AS VARCHAR)), 1, 16) AS sc FROM part),
  a AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY p_brand, p_size % 3 ORDER BY sc, p_partkey) AS r FROM s WHERE p_brand IN (SELECT p_brand FROM part GROUP BY 1 HAVING count(*) >= 5)) WHERE r <= 3)
  SELECT p_partkey FROM (SELECT p_partkey, row_number() OVER (PARTITION BY p_brand ORDER BY sc, p_partkey) AS q FROM a) WHERE q <= 5""")
def c16_pilot(spark, d):
    t = read(spark, d, "part").withColumn("source", F.col("p_size") % 3)
    return sampling.pilot(t, "p_brand", 5, 3, 5, 3, "p_partkey").select("p_partkey")


@query("""SELECT o_orderkey FROM (SELECT o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY CASE WHEN o_orderstatus = 'F' THEN 0 ELSE 1 END, substr(sha256('5' || chr(31) || CAST(o_orderkey AS VARCHAR)), 1, 16), o_orderkey) AS r FROM orders) WHERE r <= 2""")
def w4_present_first(spark, d):
    from speclake.functions import scalars as S

    order = Window.partitionBy("o_custkey").orderBy(F.when(F.col("o_orderstatus") == "F", 0).otherwise(1), S.score(F.col("o_orderkey").cast("string"), 5), "o_orderkey")
    return read(spark, d, "orders").withColumn("r", F.row_number().over(order)).filter("r <= 2").select("o_orderkey")


@query("SELECT o_custkey, max(o_orderkey) AS o_orderkey FROM orders GROUP BY o_custkey")
def w6_last_per_key(spark, d):
    return read(spark, d, "orders").groupBy("o_custkey").agg(F.max("o_orderkey").alias("o_orderkey"))


@query("SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment, c_acctbal AS balance FROM customer UNION ALL SELECT s_suppkey, s_name, NULL, s_acctbal FROM supplier")
def u1_union_manifests(spark, d):
    c = read(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("balance"))
    s = read(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"))
    return c.unionByName(s, allowMissingColumns=True)


@query("SELECT n_name FROM nation WHERE n_nationkey NOT IN (SELECT s_nationkey FROM supplier WHERE s_acctbal > 9000)")
def u3_missing(spark, d):
    n, s = read(spark, d, "nation"), read(spark, d, "supplier").filter("s_acctbal > 9000")
    return n.join(s, F.col("n_nationkey") == F.col("s_nationkey"), "left_anti").select("n_name")


@query("""WITH w AS (SELECT doc_id, list_filter(string_split(text, ' '), lambda x: trim(x) <> '') AS w FROM documents), e AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS i FROM w),
  f AS (SELECT doc_id, lower(x), min(i) AS i, arg_min(x, i) AS x FROM e GROUP BY doc_id, lower(x)) SELECT doc_id, string_agg(x, ' ' ORDER BY i) AS words FROM f GROUP BY doc_id""")
def u5_unique_values(spark, d):
    """The words of each text in order, each once without regard to case."""
    return records.first_seen_values(read(spark, d, "documents").select("doc_id", F.split("text", " ").alias("w")), "doc_id", "w").select("doc_id", F.array_join("w", " ").alias("words"))


@query("SELECT doc_id, CAST(4 * contains(lower(text), 'the') + 2.5 * contains(lower(text), 'tion') + 3 * contains(lower(text), lower(lang)) AS DOUBLE) AS score FROM documents".replace("contains(lower(text), 'the')", "CAST(contains(lower(text), 'the') AS INTEGER)").replace("contains(lower(text), 'tion')", "CAST(contains(lower(text), 'tion') AS INTEGER)").replace("contains(lower(text), lower(lang))", "CAST(contains(lower(text), lower(lang)) AS INTEGER)"))
def x5_keyword_score(spark, d):
    low = F.lower("text")
    has = lambda x, w: F.when(F.contains(low, x), w).otherwise(0.0)
    return read(spark, d, "documents").select("doc_id", (has(F.lit("the"), 4.0) + has(F.lit("tion"), 2.5) + has(F.lower("lang"), 3.0)).alias("score"))
