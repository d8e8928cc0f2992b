"""Record operators, top lists, sets and violations over the given tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from speclake.functions import scalars as S
from speclake.functions.vectors import dot, unit
from speclake.operators import manifest, records, sampling, vectors
from speclake.plans.corpus_queries import BOUND, bound
from speclake.plans.register import read, registry
from speclake.plans.vector_queries import MEANS, UNITS
from speclake.sources import tables

QUERIES, SQL, query = registry()

#: Licences that the languages stand for in the query of cache states; other languages have none.
LICENSED = {"en": "CC0", "de": "CC-BY", "es": "CC-BY-NC", "fr": "CC-BY-SA"}


@query("""SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: length(x) >= 20)[1] AS line FROM documents""")
def s5_w7_first_media(spark, d):
    """The first acceptable element in array order, without exploding."""
    return read(spark, d, "documents").select("doc_id", F.get(F.filter(F.split("text", "\n"), lambda x: F.length(x) >= 20), 0).alias("line"))


@query("""SELECT event_id, CAST(i AS INTEGER) AS at, CASE i WHEN 0 THEN event_type ELSE props END AS item FROM events, (SELECT unnest([0, 1]) AS i)""")
def s5_envelope(spark, d):
    document = F.to_json(F.struct(F.array(F.to_json(F.struct("event_type")), "props").alias("results")))
    t = read(spark, d, "events").select("event_id", F.posexplode(tables.unwrap(document)).alias("at", "item"))
    return t.select("event_id", "at", F.coalesce(F.get_json_object("item", "$.event_type"), "item").alias("item"))


@query("SELECT event_id, json_extract_string(props, '$.k') AS value FROM events")
def x1_recursive_pick(spark, d):
    """Eight levels deep; a blank value comes before it, another one after it."""
    nested = F.concat(F.lit('{"a": [{"ods:K": " "}, {"b": {"l4": {"l5": [{"l6": {"l7": {"dwc/x#k": '), F.get_json_object("props", "$.k"), F.lit('}}}]}}}], "c": {"k": "later"}}'))
    return records.with_picked(read(spark, d, "events").select("event_id", nested.alias("doc")), "doc", ["k"], "value").select("event_id", "value")


@query("SELECT o_orderkey FROM orders WHERE o_orderpriority IN ('3-MEDIUM', '1-URGENT')")
def f5_research_grade(spark, d):
    marked = F.replace("o_orderpriority", F.lit("-"), F.lit("_"))
    return read(spark, d, "orders").filter(records.grade_in(marked, ["3 medium", "1_Urgent"])).select("o_orderkey")


@query(f"WITH {BOUND} SELECT record_id FROM bound WHERE doc_id % 3 <> 0")
def f8_supervised_only(spark, d):
    t = bound(spark, d).withColumn("image_license", F.when(F.col("doc_id") % 3 == 0, "CC BY-NC").otherwise("CC0"))
    return manifest.build_master(t, supervised_only=True).select("record_id")


@query(f"""WITH p AS (SELECT doc_id, CASE coalesce(lang, '') {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in LICENSED.items())} ELSE 'UNKNOWN' END AS lic, url FROM documents LEFT JOIN pages ON doc_id = page_id),
  r AS (SELECT p.doc_id, lic, url, l.doc_id IS NOT NULL AS there, CASE WHEN label % 4 = 0 THEN 'HTTP ' || label ELSE '' END AS error, v.vec_id IS NOT NULL AS fetched
    FROM p LEFT JOIN labels l ON p.doc_id = l.doc_id AND quality = 1 LEFT JOIN embeddings v ON vec_id = p.doc_id AND vec_id % 3 < 2),
  s AS (SELECT doc_id, there, CASE WHEN lic NOT IN ('CC0', 'CC-BY', 'CC-BY-SA', 'PROJECT-OWNED') THEN 'license:' || lic WHEN there THEN '' WHEN coalesce(url, '') = '' THEN 'missing_image_location'
    WHEN NOT fetched THEN 'not_fetched' WHEN error <> '' THEN 'download_error:' || error ELSE '' END AS reason FROM r)
  SELECT doc_id, reason = '' AS eligible_supervised, reason AS exclusion_reason, CASE WHEN there THEN 'cache/' || doc_id ELSE '' END AS local_path FROM s""")
def c32_f10_cache_status(spark, d):
    """The plan is of documents, addresses of pages; files that are there come from labels, what was fetched from embeddings."""
    said = F.create_map(*[F.lit(x) for pair in LICENSED.items() for x in pair])
    pages = read(spark, d, "pages").select(F.col("page_id").alias("doc_id"), F.col("url").alias("image_url"))
    plan = read(spark, d, "documents").select("doc_id", F.coalesce(F.try_element_at(said, F.coalesce("lang", F.lit(""))), F.lit("UNKNOWN")).alias("image_license")).join(pages, "doc_id", "left")
    listing = read(spark, d, "labels").filter("quality = 1").select("doc_id", F.concat(F.lit("cache/"), "doc_id").alias("local_path"))
    results = read(spark, d, "embeddings").filter("vec_id % 3 < 2").select(F.col("vec_id").alias("doc_id"), F.when(F.col("label") % 4 == 0, F.concat(F.lit("HTTP "), "label")).otherwise("").alias("error"))
    return records.cache_status(plan, listing, results, "doc_id").select("doc_id", "eligible_supervised", "exclusion_reason", "local_path")


@query(r"""WITH p AS (SELECT page_id, 'top/' || (page_id % 5) || '/a/b/' || regexp_replace(regexp_replace(regexp_replace(url, '[?#].*$', ''), '^https?://', ''), '/+$', '') AS path FROM pages),
  s AS (SELECT page_id, regexp_extract(path, CASE page_id % 3 WHEN 0 THEN '([^/]+)$' WHEN 1 THEN '([^/]+/[^/]+)$' ELSE '(b/.*)$' END, 1) AS member, regexp_extract(path, '([^/]+)/*$', 1) AS base FROM p WHERE path NOT LIKE '%//%'),
  l AS (SELECT DISTINCT path, regexp_extract(path, '([^/]+)/*$', 1) AS base FROM p)
  SELECT s.page_id, min(l.path) AS path FROM s JOIN l ON s.base = l.base AND ends_with(l.path, '/' || s.member) GROUP BY s.page_id""")
def c33_j9_archive_members(spark, d):
    """Members of one, two and more than four segments, written with backslashes and './'."""
    t = read(spark, d, "pages").select("page_id", F.concat(F.lit("top/"), F.col("page_id") % 5, F.lit("/a/b/"), F.regexp_replace(F.regexp_replace(F.regexp_replace("url", "[?#].*$", ""), "^https?://", ""), "/+$", "")).alias("path"))
    ends = [F.regexp_extract("path", p, 1) for p in ("([^/]+)$", "([^/]+/[^/]+)$", "(b/.*)$")]
    member = F.when(F.col("page_id") % 3 == 0, ends[0]).when(F.col("page_id") % 3 == 1, F.replace(ends[1], F.lit("/"), F.lit("\\"))).otherwise(F.concat(F.lit("./"), ends[2]))
    selection = t.filter("path NOT LIKE '%//%'").select("page_id", member.alias("member"))
    return records.match_archive(selection, t.select("path"), "member", "path").filter("path IS NOT NULL").select("page_id", "path")


@query(f"""WITH {BOUND}, b AS (SELECT source, count(*) // 3 AS budget FROM bound GROUP BY source),
  r AS (SELECT record_id, source, row_number() OVER (PARTITION BY source ORDER BY substr(sha256('9' || chr(31) || record_id), 1, 16), record_id) AS n FROM bound)
  SELECT record_id FROM r JOIN b ON r.source = b.source WHERE n <= budget""")
def j7_budgets(spark, d):
    t = bound(spark, d)
    budgets = t.groupBy("source").agg(F.floor(F.count("*") / 3).alias("budget"))
    return sampling.lowest(t.select("record_id", "source").join(budgets, "source"), ["source"], "budget", 9, "record_id").select("record_id")


@query("""SELECT record_id, problem FROM (SELECT vec_id AS record_id, CASE WHEN vec_id % 10 = 0 THEN 'missing' WHEN vec_id % 6 = 1 THEN 'differs:family' WHEN vec_id % 6 = 2 THEN 'differs:species' END AS problem FROM embeddings) WHERE problem IS NOT NULL""")
def j12_cohort_alignment(spark, d):
    """A null in one cohort and a text in the other differ; nulls in both don't."""
    k = F.col("vec_id")
    t = read(spark, d, "embeddings").select(k.alias("record_id"), F.col("label").cast("string").alias("family"), F.when(k % 5 != 0, F.lit("s")).alias("species"), F.lit("train").alias("split"))
    other = t.filter("record_id % 10 <> 0").withColumns({"family": F.when(F.col("record_id") % 6 == 1, F.concat("family", F.lit("x"))).otherwise(F.col("family")), "species": F.when(F.col("record_id") % 6 == 2, F.when(F.col("species").isNull(), "s")).otherwise(F.col("species"))})
    return vectors.alignment_problems(t, other, "record_id")


@query("SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN '.jpg' WHEN 1 THEN '.jpeg' WHEN 2 THEN '.png' END AS suffix FROM documents")
def j14_listing_suffix(spark, d):
    """The file with the first suffix by priority; of a document four may be there."""
    t, order = read(spark, d, "documents").select("doc_id"), [".jpg", ".jpeg", ".png"]
    files = t.select("doc_id", F.explode(F.slice(F.array(*map(F.lit, order)), F.lit(1) + (F.col("doc_id") % 4).cast("int"), F.lit(3))).alias("suffix"))
    first = files.groupBy("doc_id").agg(F.min_by("suffix", F.array_position(F.array(*map(F.lit, order)), F.col("suffix"))).alias("suffix"))
    return t.join(first, "doc_id", "left").select("doc_id", "suffix")


@query(f"""WITH {UNITS}, {MEANS}, s AS (SELECT vec_id, u.label, c.label AS guess, round(list_dot_product(u, c), 9) AS sim FROM u, c),
  r AS (SELECT label, guess, row_number() OVER (PARTITION BY vec_id ORDER BY sim DESC, guess) AS k FROM s)
  SELECT label, guess, count(*) AS n FROM r WHERE k = 1 AND label <> guess GROUP BY label, guess ORDER BY n DESC, label, guess LIMIT 50""")
def a12_confusions(spark, d):
    t = read(spark, d, "embeddings")
    best = vectors.guesses(t, vectors.centroids(t, "label"), "label", 1).select("vec_id", F.col("guess").cast(t.schema["label"].dataType).alias("guess"))
    wrong = t.select("vec_id", "label").join(best, "vec_id").filter("label <> guess")
    return wrong.groupBy("label", "guess").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "label", "guess").limit(50)


PARTS = [f"('0x' || substr(h, {1 + 8 * k}, 8))::UBIGINT" for k in range(8)]
DIGEST = " || ".join([f"printf('%08x', bit_xor({p})::BIGINT)" for p in PARTS] + [f"printf('%08x', (sum({p}) % 4294967296)::BIGINT)" for p in PARTS])


@query(f"SELECT count(*) AS n, {DIGEST} AS digest FROM (SELECT sha256(CAST(vec_id AS VARCHAR) || chr(31) || CAST(label AS VARCHAR)) AS h FROM embeddings)")
def a14_fingerprint(spark, d):
    return records.fingerprint(read(spark, d, "embeddings"), ["vec_id", "label"])


TOPUP = """r AS (SELECT c_custkey, c_nationkey, c_acctbal > 5000 AS in_base, row_number() OVER (PARTITION BY c_nationkey ORDER BY CASE WHEN c_acctbal > 5000 THEN 0 ELSE 1 END,
  substr(sha256('4' || chr(31) || CAST(c_custkey AS VARCHAR)), 1, 16), c_custkey) AS n FROM customer), t AS (SELECT * FROM r WHERE n <= 8)"""


def topped(spark, d):
    t = read(spark, d, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    return records.topup(t, t.filter("c_acctbal > 5000"), "c_nationkey", "c_custkey", 8, 4)


@query(f"WITH {TOPUP} SELECT c_custkey, in_base FROM t")
def c13_topup(spark, d):
    return topped(spark, d).select("c_custkey", "in_base")


@query(f"""WITH {TOPUP}, f AS (SELECT n_nationkey AS c_nationkey FROM nation), c AS (SELECT c_nationkey, count(*) FILTER (in_base) AS b, count(*) FILTER (NOT in_base) AS w FROM t GROUP BY c_nationkey)
  SELECT f.c_nationkey, 8 AS target, coalesce(b, 0) AS from_base, coalesce(w, 0) AS new, coalesce(b + w, 0) AS total, 8 - coalesce(b + w, 0) AS shortfall FROM f LEFT JOIN c ON f.c_nationkey = c.c_nationkey""")
def a16_topup_report(spark, d):
    requested = read(spark, d, "nation").select(F.col("n_nationkey").alias("c_nationkey"))
    return records.topup_report(topped(spark, d), requested, "c_nationkey", 8)


@query("""WITH f AS (SELECT n_nationkey, 77 // count(*) OVER () + CASE WHEN row_number() OVER (ORDER BY n_nationkey) - 1 < 77 % count(*) OVER () THEN 1 ELSE 0 END AS quota FROM nation),
  r AS (SELECT c_custkey, c_nationkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY substr(sha256('8' || chr(31) || CAST(c_custkey AS VARCHAR)), 1, 16), c_custkey) AS n FROM customer)
  SELECT c_custkey FROM r JOIN f ON c_nationkey = n_nationkey WHERE n <= quota""")
def c8_family_balanced(spark, d):
    quotas = records.even_quotas(read(spark, d, "nation").select(F.col("n_nationkey").alias("c_nationkey")), "c_nationkey", 77)
    return sampling.lowest(read(spark, d, "customer").select("c_custkey", "c_nationkey").join(quotas, "c_nationkey"), ["c_nationkey"], "quota", 8, "c_custkey").select("c_custkey")


@query("""SELECT shard, count(*) AS expected, count(*) FILTER (n_chars >= 100) AS observed, round(count(*) FILTER (n_chars >= 100) / count(*), 6) AS rate FROM (SELECT doc_id % 16 AS shard, n_chars FROM documents)
  GROUP BY shard HAVING count(*) FILTER (n_chars >= 100) < 0.98 * count(*)""")
def a19_shard_completeness(spark, d):
    t = read(spark, d, "documents").select((F.col("doc_id") % 16).alias("shard"), F.col("n_chars") >= 100)
    n = t.toDF("shard", "ok").groupBy("shard").agg(F.count("*").alias("expected"), F.count_if("ok").alias("observed"))
    return n.filter("observed < 0.98 * expected").withColumn("rate", F.round(F.col("observed") / F.col("expected"), 6))


@query("""WITH n AS (SELECT source, count(*) AS n FROM documents GROUP BY source), b AS (SELECT sum(n) // 2 AS budget FROM n)
  SELECT source, n, CAST(greatest(0, least(n, budget - coalesce(sum(n) OVER (ORDER BY source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))) AS BIGINT) AS granted FROM n, b""")
def w8_running_grants(spark, d):
    t = read(spark, d, "documents")
    return records.running_grants(t.groupBy("source").agg(F.count("*").alias("n")), "source", "n", t.count() // 2)


@query("""SELECT p_partkey, CAST(k AS INTEGER) AS tile, CAST(round_even((k % 2) * w / 2, 0) AS BIGINT) AS x1, CAST(round_even((k // 2) * h / 2, 0) AS BIGINT) AS y1,
  CAST(round_even((k % 2 + 1) * w / 2, 0) AS BIGINT) AS x2, CAST(round_even((k // 2 + 1) * h / 2, 0) AS BIGINT) AS y2 FROM (SELECT p_partkey, p_size * 10 + 101 AS w, p_size * 7 + 80 AS h, unnest([0, 1, 2, 3]) AS k FROM part)""")
def v8_tiles(spark, d):
    t = read(spark, d, "part").select("p_partkey", F.explode(records.tiles(F.col("p_size") * 10 + 101, F.col("p_size") * 7 + 80, 2)).alias("b"))
    return t.select("p_partkey", F.col("b.tile").alias("tile"), "b.x1", "b.y1", "b.x2", "b.y2")


@query("""SELECT doc_id, CASE WHEN n_chars % 100 < 40 OR doc_id % 11 = 1 THEN NULL WHEN n_chars % 90 < 45 OR doc_id % 11 = 2 THEN 'family' WHEN n_chars % 80 < 52 OR doc_id % 11 = 3 THEN 'genus' ELSE 'species' END AS rank FROM documents""")
def c28_accepted_rank(spark, d):
    n = F.col("n_chars")
    said = {"family": (n % 100) / 100, "genus": (n % 90) / 90, "species": (n % 80) / 80}
    return read(spark, d, "documents").select("doc_id", records.accepted_rank(said, F.get(F.array(F.lit("family"), F.lit("genus"), F.lit("species")), (F.col("doc_id") % 11).cast("int") - 1)).alias("rank"))


@query("SELECT doc_id, source, lang FROM documents ORDER BY source, lang, doc_id")
def t1_output_order(spark, d):
    return read(spark, d, "documents").select("doc_id", "source", "lang").orderBy("source", "lang", "doc_id")


@query("SELECT p_brand, count(*) AS n FROM part GROUP BY p_brand ORDER BY n DESC, p_brand LIMIT 5")
def t2_top_classes(spark, d):
    return read(spark, d, "part").groupBy("p_brand").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "p_brand").limit(5)


@query(r"""WITH s AS (SELECT regexp_replace(url, '[?#].*$', '') AS title, length(html) AS score FROM pages) SELECT title, max(score) AS score FROM s GROUP BY title ORDER BY score DESC, title LIMIT 12""")
def t3_ranked_hits(spark, d):
    hits = read(spark, d, "pages").select(F.regexp_replace("url", "[?#].*$", "").alias("title"), F.length("html").cast("long").alias("score"))
    return hits.groupBy("title").agg(F.max("score").alias("score")).orderBy(F.desc("score"), "title").limit(12)


@query("SELECT o_orderkey FROM orders ORDER BY substr(sha256('6' || chr(31) || CAST(o_orderkey AS VARCHAR)), 1, 16), o_orderkey LIMIT 100")
def t4_first_n(spark, d):
    return read(spark, d, "orders").select("o_orderkey").orderBy(S.score(F.col("o_orderkey").cast("string"), 6), "o_orderkey").limit(100)


@query("SELECT regexp_replace(url, '[?#].*$', '') AS url, min(page_id) AS page_id FROM pages GROUP BY 1")
def u2_distinct_url(spark, d):
    return read(spark, d, "pages").groupBy(F.regexp_replace("url", "[?#].*$", "").alias("url")).agg(F.min("page_id").alias("page_id"))


@query("SELECT o_orderkey AS id FROM orders INTERSECT SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R'")
def u4_common_ids(spark, d):
    return read(spark, d, "orders").select(F.col("o_orderkey").alias("id")).intersect(read(spark, d, "lineitem").filter("l_returnflag = 'R'").select("l_orderkey"))


@query("SELECT o_orderkey, o_orderstatus AS split FROM orders WHERE o_orderstatus NOT IN ('F', 'O')")
def q4_unknown_split(spark, d):
    return read(spark, d, "orders").filter(~F.col("o_orderstatus").isin("F", "O")).select("o_orderkey", F.col("o_orderstatus").alias("split"))


@query("SELECT l_orderkey, string_agg(DISTINCT l_returnflag, ',' ORDER BY l_returnflag) AS splits FROM lineitem GROUP BY l_orderkey HAVING count(DISTINCT l_returnflag) > 1")
def q3_q5_group_conflicts(spark, d):
    """Groups whose rows disagree; flags are few, so the sets stay small."""
    sets = read(spark, d, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_set("l_returnflag")).alias("s"))
    return sets.filter(F.size("s") > 1).select("l_orderkey", F.array_join("s", ",").alias("splits"))


@query("""SELECT doc_id, CASE WHEN doc_id NOT IN (SELECT doc_id FROM documents WHERE n_chars >= 200) THEN 'unknown' ELSE 'illegal' END AS problem FROM labels
  WHERE doc_id NOT IN (SELECT doc_id FROM documents WHERE n_chars >= 200) OR toxic = 1""")
def q6_bad_overrides(spark, d):
    known = read(spark, d, "documents").filter("n_chars >= 200").select("doc_id").distinct().withColumn("known", F.lit(True))
    t = read(spark, d, "labels").join(known, "doc_id", "left")
    return t.select("doc_id", F.when(F.col("known").isNull(), "unknown").when(F.col("toxic") == 1, "illegal").alias("problem")).filter("problem IS NOT NULL")


@query("SELECT source, requested, available FROM (SELECT source, count(*) AS available, 200 * CAST(length(source) AS BIGINT) AS requested FROM documents GROUP BY source) WHERE available < requested")
def q8_quota_shortfall(spark, d):
    n = read(spark, d, "documents").groupBy("source").agg(F.count("*").alias("available"))
    return n.select("source", (200 * F.length("source").cast("long")).alias("requested"), "available").filter("available < requested")


@query("SELECT 'o_custkey' AS key, count(*) - count(DISTINCT o_custkey) AS repeated FROM orders UNION ALL SELECT 'o_orderkey', count(*) - count(DISTINCT o_orderkey) FROM orders")
def q11_common_key(spark, d):
    """How many rows each candidate key repeats; a key needs none."""
    t = read(spark, d, "orders")
    one = lambda c: t.agg(F.lit(c).alias("key"), (F.count("*") - F.count_distinct(c)).alias("repeated"))
    return one("o_custkey").unionAll(one("o_orderkey"))


@query("""SELECT l_orderkey, l_linenumber FROM (SELECT l_orderkey, l_linenumber, row_number() OVER (PARTITION BY l_partkey ORDER BY sc, l_orderkey, l_linenumber) AS q FROM (
  SELECT *, row_number() OVER (PARTITION BY l_partkey, l_returnflag ORDER BY sc, l_orderkey, l_linenumber) AS r FROM (SELECT *, substr(sha256('2' || chr(31) || CAST(l_orderkey AS VARCHAR)), 1, 16) AS sc FROM lineitem)) WHERE r <= 2) WHERE q <= 3""")
def w3_two_caps(spark, d):
    nth = lambda *keys: F.row_number().over(Window.partitionBy(*keys).orderBy("sc", "l_orderkey", "l_linenumber"))
    t = read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", S.score(F.col("l_orderkey").cast("string"), 2).alias("sc"))
    return t.withColumn("r", nth("l_partkey", "l_returnflag")).filter("r <= 2").withColumn("q", nth("l_partkey")).filter("q <= 3").select("l_orderkey", "l_linenumber")
