"""Ingestors and nested documents over exports shaped from the given tables."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from speclake.functions import documents as D
from speclake.operators import ingest
from speclake.plans.register import read, registry
from speclake.sources import shared, tables

QUERIES, SQL, query = registry()


def one_of(k: Column, *values: object) -> Column:
    return F.get(F.array(*[v if isinstance(v, Column) else F.lit(v) for v in values]), F.pmod(k, F.lit(len(values))).cast("int"))


@query("""SELECT CAST(o_orderkey AS VARCHAR) AS source_record_id, 'https://inaturalist-open-data.s3.amazonaws.com/photos/' || o_orderkey || l_linenumber || '/medium.jpg' AS image_url, CASE WHEN l_linestatus = 'O' THEN 'CC0' ELSE 'CC-BY' END AS image_license,
  n_name AS family, CASE WHEN c_custkey % 2 = 0 THEN 'Gen sp' || c_custkey ELSE '' END AS species, CASE WHEN c_custkey % 2 = 0 THEN 'C' ELSE 'D' END AS label_quality, CASE WHEN c_custkey % 3 = 0 THEN CAST(c_custkey AS VARCHAR) ELSE c_name END AS observer
  FROM orders JOIN lineitem ON o_orderkey = l_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  WHERE o_orderstatus <> 'F' AND n_regionkey <> 0 AND l_returnflag <> 'R'""")
def c1_s3_photo_bundle(spark, d):
    """Observations from orders, photos from lines, a taxonomy of nations and customers, observers from customers; the tables are landed as tab-separated text named .csv.gz, as the bundle has it, and read again."""
    orders, lines, customer, nation = (read(spark, d, t) for t in ("orders", "lineitem", "customer", "nation"))
    name = lambda rank, key: F.concat(F.lit(rank), F.col(key).cast("string"))
    taxa = spark.createDataFrame([(ingest.ORDER_TAXON, "", "order", "Diptera")], "taxon_id string, ancestry string, rank string, name string")
    above = F.concat(F.lit(f"1/{ingest.ORDER_TAXON}/"), name("n", "n_nationkey"))
    taxa = taxa.unionAll(nation.select(name("n", "n_nationkey"), F.when(F.col("n_regionkey") == 0, "1/2").otherwise(f"1/{ingest.ORDER_TAXON}"), F.lit("family"), "n_name"))
    of = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    taxa = taxa.unionAll(of.select(name("c", "c_custkey"), F.when(F.col("n_regionkey") == 0, "1/2").otherwise(above), F.when(F.col("c_custkey") % 2 == 0, "species").otherwise("tribe"), F.concat(F.lit("Gen sp"), "c_custkey", F.lit(" var"))))
    observations = orders.select(F.col("o_orderkey").alias("observation_uuid"), name("c", "o_custkey").alias("taxon_id"), F.when(F.col("o_orderstatus") == "F", "needs_id").otherwise("research").alias("quality_grade"), F.col("o_custkey").alias("observer_id"))
    photos = lines.select(F.col("l_orderkey").alias("observation_uuid"), F.concat("l_orderkey", "l_linenumber").alias("photo_id"), F.when(F.col("l_returnflag") == "R", "CC-BY-NC").when(F.col("l_linestatus") == "O", "CC0").otherwise("CC-BY").alias("license"), F.lit("jpg").alias("extension"))
    photos = photos.join(orders.select("o_orderkey", F.col("o_custkey").alias("observer_id")), F.col("observation_uuid") == F.col("o_orderkey")).drop("o_orderkey")
    observers = customer.filter("c_custkey % 3 <> 0").select(F.col("c_custkey").alias("observer_id"), F.col("c_name").alias("login"))
    out = shared.shared_folder(spark)
    landed = {}
    for kind, t in {"observations": observations, "photos": photos, "taxa": taxa, "observers": observers}.items():
        t.select(*[F.col(c).cast("string").alias(c) for c in t.columns]).write.options(header=True, sep="\t", quote="", compression="gzip").csv(f"{out}/{kind}.csv.gz")
        landed[kind] = tables.read_table(spark, f"{out}/{kind}.csv.gz")
    rows = ingest.ingest_photo_bundle(landed["observations"], landed["photos"], landed["taxa"], landed["observers"])
    return rows.select("source_record_id", "image_url", "image_license", "family", "species", "label_quality", "observer")


@query("""SELECT 'obs' || page_id AS source_record_id, CASE WHEN page_id % 2 = 0 THEN 'Aus bus' ELSE '' END AS species, CASE WHEN page_id % 2 = 0 THEN 'Aus' ELSE '' END AS genus, CASE WHEN page_id % 2 = 0 THEN 'C' ELSE 'D' END AS label_quality, url AS image_url, CASE WHEN page_id % 3 = 0 THEN 'CC0' ELSE 'CC-BY' END AS image_license
  FROM pages WHERE page_id % 5 <> 0 AND page_id % 3 <> 2 AND url LIKE 'http%'""")
def c2_flat_occurrences(spark, d):
    k = F.col("page_id")
    t = read(spark, d, "pages").select(
        F.concat(F.lit("obs"), k).alias("ID"), F.when(k % 5 == 0, "Coleoptera").otherwise("diptera").alias("taxon_order"), F.when(k % 2 == 0, "Aus bus (Author, 1900)").otherwise("Ausidae").alias("scientific_name"), F.when(k % 2 == 0, "Species").otherwise("family").alias("taxon_rank"),
        F.col("url").alias("photo_url"), one_of(k, "CC0", "https://creativecommons.org/licenses/by/4.0/", "CC BY-NC").alias("photo_license"))
    return ingest.ingest_flat_occurrences(t).select("source_record_id", "species", "genus", "label_quality", "image_url", "image_license")


@query("""SELECT source_record_id, species, label_quality, CASE WHEN species <> '' THEN 'species' ELSE 'family' END AS identification_level, image IS NOT NULL AS eligible_supervised, CASE WHEN image IS NULL THEN 'missing_image_location' ELSE '' END AS exclusion_reason, 'BIOSCAN-5M:' || source_record_id AS specimen_group_id FROM (
  SELECT 'p' || d.doc_id AS source_record_id, CASE WHEN d.doc_id % 4 = 1 THEN 'Aus bus' ELSE '' END AS species, CASE WHEN d.doc_id % 4 = 1 THEN CASE WHEN quality = 1 THEN 'A' ELSE 'B' END ELSE 'D' END AS label_quality, CASE WHEN d.doc_id % 6 <> 0 THEN 'x' END AS image
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE d.doc_id % 5 <> 0)""")
def c3_ingest_barcode(spark, d):
    k = F.col("doc_id")
    t = read(spark, d, "documents").join(read(spark, d, "labels"), "doc_id", "left").select(
        F.concat(F.lit("p"), k).alias("processid"), F.when(k % 5 == 0, "Other").otherwise("DIPTERA").alias("order"), F.lit("Ausidae").alias("family"), one_of(k, "", "Aus bus", "Aus sp. 3", "BOLD:AAA1234").alias("species"),
        F.when(F.col("quality") == 1, "ACGT").alias("nuc"), F.when(k % 6 != 0, "x.jpg").alias("image_file"))
    return ingest.ingest_barcode(t).select("source_record_id", "species", "label_quality", "identification_level", "eligible_supervised", "exclusion_reason", "specimen_group_id")


@query("""SELECT CAST(o_orderkey AS VARCHAR) AS source_record_id, 'https://media.example.org/' || l_orderkey || '/' || l_linenumber AS image_url, CASE WHEN l_linestatus = 'O' THEN 'CC0' ELSE 'CC-BY-SA' END AS image_license, CASE WHEN o_orderkey % 2 = 0 THEN 'B' ELSE 'D' END AS label_quality, 'GBIF:' || o_orderkey AS specimen_group_id, 'c' || o_custkey AS identified_by
  FROM orders JOIN lineitem ON o_orderkey = l_orderkey WHERE o_orderstatus <> 'P' AND o_orderpriority NOT LIKE '5%' AND l_returnflag <> 'R' AND l_linenumber <> 3""")
def c4_j5_dwca(spark, d):
    k = F.col("o_orderkey")
    occurrence = read(spark, d, "orders").select(
        k.alias("gbifID"), F.when(F.col("o_orderstatus") == "P", "Other").otherwise("Diptera").alias("order"), F.when(F.col("o_orderpriority").startswith("5"), "HUMAN_OBSERVATION").otherwise("preserved_specimen").alias("basisOfRecord"),
        F.lit("Ausidae").alias("family"), F.when(k % 2 == 0, "Aus bus").otherwise("").alias("species"), F.concat(F.lit("c"), "o_custkey").alias("identifiedBy"))
    media = read(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("coreid"), F.when(F.col("l_linenumber") == 3, "Sound").when(F.col("l_linenumber") == 2, "").otherwise("StillImage").alias("type"), F.concat(F.lit("https://media.example.org/"), "l_orderkey", F.lit("/"), "l_linenumber").alias("identifier"),
        F.when(F.col("l_returnflag") == "R", "all rights reserved").when(F.col("l_linestatus") == "O", "http://creativecommons.org/publicdomain/zero/1.0/").otherwise("CC BY-SA 4.0").alias("license"))
    return ingest.ingest_dwca(occurrence, media).select("source_record_id", "image_url", "image_license", "label_quality", "specimen_group_id", "identified_by")


@query("""SELECT CAST(o_orderkey AS VARCHAR) AS source_record_id, 'https://media.example.org/' || o_orderkey AS image_url FROM orders WHERE o_orderkey % 3 = 0 AND o_custkey % 2 = 0""")
def j5_inline_media(spark, d):
    """Without a table of media the occurrences' own images count."""
    k = F.col("o_orderkey")
    t = read(spark, d, "orders").select(k.alias("gbifid"), F.lit("Ausidae").alias("family"), F.when(k % 3 == 0, F.concat(F.lit("https://media.example.org/"), k)).alias("media"), F.when(F.col("o_custkey") % 2 == 0, "CC BY 4.0").otherwise("CC BY-ND 4.0").alias("license"))
    return ingest.ingest_dwca(t, any_order=True).select("source_record_id", "image_url")


def specimens(spark, d):
    """A full response each: a specimen with one or two media objects, a sound, a link to a DOI, and annotations that also look like media."""
    k = F.col("doc_id").cast("string")
    media = lambda n, kind, license_: F.struct(F.struct(F.concat(F.lit("https://media.example.org/"), k, F.lit(f"/{n}")).alias("ac:accessURI"), F.lit(kind).alias("dc:type"), F.struct(license_.alias("dcterms:rights")).alias("inner")).alias("digitalMediaObject"))
    open_ = F.when(F.col("doc_id") % 3 == 0, "CC BY-NC 4.0").otherwise("CC BY 4.0")
    objects = F.when(F.col("doc_id") % 2 == 0, F.array(media(1, "StillImage", open_), media(2, "Sound", F.lit("CC0")), media(3, "image/jpeg", F.lit("CC0")))).otherwise(F.array(media(1, "", open_)))
    specimen = F.struct(
        F.when(F.col("doc_id") % 5 == 0, "Other").otherwise("Diptera").alias("dwc:order"), F.struct(F.array(F.struct(F.col("lang").alias("dwc:family"), F.when(F.col("doc_id") % 4 == 0, "Aus bus").alias("http://rs.tdwg.org/dwc/terms/species"))).alias("list")).alias("ods:hasIdentifications"),
        F.when(F.col("doc_id") % 7 == 0, "HumanObservation").otherwise("PreservedSpecimen").alias("dwc:basisOfRecord"))
    attributes = F.struct(specimen.alias("digitalSpecimen"), objects.alias("digitalMedia"), F.array(F.struct(F.lit("https://wrong.example.org/1").alias("ac:accessURI"))).alias("annotations"))
    return read(spark, d, "documents").select("doc_id", F.to_json(F.struct(F.struct(F.concat(F.lit("ds/"), k).alias("id"), attributes.alias("attributes")).alias("data"))).alias("document"))


IMAGES = """SELECT doc_id, unnest(CASE WHEN doc_id % 2 = 0 THEN [1, 3] ELSE [1] END) AS n, lang FROM documents"""


@query(f"""SELECT 'ds/' || doc_id AS source_record_id, 'https://media.example.org/' || doc_id || '/' || n AS image_url, CASE WHEN n = 3 THEN 'CC0' ELSE 'CC-BY' END AS image_license, lang AS family, CASE WHEN doc_id % 4 = 0 THEN 'Aus bus' ELSE '' END AS species, CASE WHEN doc_id % 4 = 0 THEN 'B' ELSE 'D' END AS label_quality, 'DiSSCo:ds/' || doc_id AS specimen_group_id
  FROM ({IMAGES}) WHERE doc_id % 5 <> 0 AND doc_id % 7 <> 0 AND (n = 3 OR doc_id % 3 <> 0)""")
def c5_x3_x4_digital_specimens(spark, d):
    rows = ingest.ingest_digital_specimens(specimens(spark, d))
    return rows.select("source_record_id", "image_url", "image_license", "family", "species", "label_quality", "specimen_group_id")


@query("""SELECT doc_id, CAST(CASE WHEN doc_id % 2 = 0 THEN 3 ELSE 1 END AS BIGINT) AS objects, CASE WHEN doc_id % 2 = 0 THEN 'StillImage,Sound,image/jpeg' ELSE '' END AS kinds FROM documents""")
def x2_media_objects(spark, d):
    """Media objects of nested documents: none is looked for inside another one."""
    t = specimens(spark, d).select("doc_id", D.opened(ingest.full_response(F.col("document"))).alias("tree"))
    kinds = F.transform(D.media(F.col("tree")), lambda at: D.pick(D.below(F.col("tree"), at), "type"))
    return t.select("doc_id", F.size(D.media(F.col("tree"))).cast("long").alias("objects"), F.array_join(kinds, ",").alias("kinds"))


API = "SELECT doc_id, lang, source FROM documents WHERE lang = 'en' AND doc_id % 5 <> 0"


def responses(spark, d):
    """A page of search results each sixteen documents: of the media the first is closed, the second a sound."""
    k = F.col("doc_id").cast("string")
    medium = lambda kind, path, license_: F.struct(F.lit(kind).alias("type"), F.concat(F.lit("https://media.example.org"), path).alias("identifier"), F.lit(license_).alias("license"), F.lit("Holder").alias("rightsHolder"), F.lit(None).cast("string").alias("creator"))
    photo = F.concat(F.lit("/photos/"), k, F.lit("/original.jpg"))
    media = F.array(medium("StillImage", F.concat(F.lit("/closed/"), k), "CC BY-NC 4.0"), medium("Sound", F.concat(F.lit("/sound/"), k), "CC0"), medium("StillImage", photo, "CC BY 4.0"))
    item = F.struct(
        F.col("doc_id").alias("key"), F.when(F.col("doc_id") % 5 == 0, "Other").otherwise("Diptera").alias("order"), F.upper("lang").alias("family"), F.when(F.col("doc_id") % 3 == 0, "Aus bus").alias("species"), F.when(F.col("doc_id") % 2 == 0, "PRESERVED_SPECIMEN").otherwise("HUMAN_OBSERVATION").alias("basisOfRecord"),
        F.lit("set-1").alias("datasetKey"), F.col("source").alias("datasetName"), F.when(F.col("doc_id") % 7 != 0, F.concat(F.lit("https://www.inaturalist.org/observations/"), k)).alias("occurrenceID"), F.lit("Someone").alias("recordedBy"), F.when(F.col("doc_id") % 11 == 0, F.slice(media, 1, 2)).otherwise(media).alias("media"))
    t = read(spark, d, "documents").select(F.floor(F.col("doc_id") / 16).alias("page"), item.alias("item"))
    return t.groupBy("page").agg(F.to_json(F.struct(F.collect_list("item").alias("results"))).alias("response")).drop("page")


@query(f"""SELECT CAST(doc_id AS VARCHAR) AS source_record_id, 'https://media.example.org/photos/' || doc_id || '/original.jpg' AS image_url, 'Someone' AS attribution, source || ' [GBIF dataset set-1]' AS source_dataset, CASE WHEN doc_id % 3 = 0 THEN 'B' ELSE 'D' END AS label_quality FROM ({API}) WHERE doc_id % 2 = 0 AND doc_id % 11 <> 0""")
def c6_api_pages(spark, d):
    return ingest.ingest_api_pages(responses(spark, d), "En").select("source_record_id", "image_url", "attribution", "source_dataset", "label_quality")


@query(f"""SELECT CAST(doc_id AS VARCHAR) AS observation_id, CAST(doc_id AS VARCHAR) AS photo_id, 'https://media.example.org/photos/' || doc_id || '/medium.jpg' AS image_url, 'iNaturalist:' || doc_id AS specimen_group_id, CASE WHEN doc_id % 3 = 0 THEN 'C' ELSE 'D' END AS label_quality, FALSE AS is_preserved_specimen FROM ({API}) WHERE doc_id % 7 <> 0 AND doc_id % 11 <> 0""")
def c6_p15_api_observations(spark, d):
    return ingest.ingest_api_pages(responses(spark, d), "en", dataset="set-1").select("observation_id", "photo_id", "image_url", "specimen_group_id", "label_quality", "is_preserved_specimen")


@query("""SELECT 'LOCAL-' || printf('%05d', row_number() OVER (ORDER BY path)) AS parent_specimen_id, path AS local_path, CASE doc_id % 3 WHEN 0 THEN 'wing' WHEN 1 THEN 'habitus' ELSE 'terminalia' END AS view_type, 'PROJECT-OWNED' AS image_license, TRUE AS eligible_supervised FROM (
  SELECT doc_id, 'voucher/' || doc_id || ['_wing.jpg', '.jpg', '-genitalia.png'][1 + doc_id % 3] AS path FROM documents)""")
def c7_local_views(spark, d):
    listing = read(spark, d, "documents").select(F.concat(F.lit("voucher/"), "doc_id", one_of(F.col("doc_id"), "_wing.jpg", ".jpg", "-genitalia.png")).alias("local_path"))
    return ingest.ingest_local_views(listing, "Ausidae").select("parent_specimen_id", "local_path", "view_type", "image_license", "eligible_supervised")


@query("""SELECT CAST(p_partkey AS VARCHAR) AS key, CASE WHEN p_size % 3 = 0 THEN 'x' || p_brand ELSE '' END AS species, CASE WHEN p_size % 2 = 0 AND p_size % 3 = 0 THEN 'A' WHEN p_size % 3 = 0 THEN 'B' ELSE 'D' END AS barcode, CASE WHEN p_size % 3 = 0 THEN 'B' ELSE 'D' END AS specimen,
  CASE WHEN p_size % 3 = 0 AND p_size % 5 = 0 THEN 'C' ELSE 'D' END AS observation FROM part""")
def p13_quality_by_source(spark, d):
    from speclake.functions import scalars as S

    k = F.col("p_size")
    species = F.when(k % 3 == 0, F.concat(F.lit("x"), "p_brand")).otherwise("")
    return read(spark, d, "part").select(F.col("p_partkey").cast("string").alias("key"), species.alias("species"), S.barcode_quality(F.when(k % 2 == 0, "AC").otherwise(""), species).alias("barcode"), S.determined_quality(species).alias("specimen"), S.determined_quality(species, k % 5 == 0, specimen=False).alias("observation"))
