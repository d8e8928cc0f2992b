"""Recommended references for a prediction: catalogue entries by family and genera, and landed search results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from speclake.functions import scalars as S
from speclake.sources.shared import cut, sized

#: Score of a curated entry, what a match by genus adds, numbers of genera asked for and of results.
CURATED, BY_GENUS, GENERA, RESULTS = 100.0, 10.0, 4, 12


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    """One row an entry (title, families, genera, doi, url) of a JSON file that holds a list, or an object with ``references``."""
    text = spark.read.text(path, wholetext=True).select(F.coalesce(F.get_json_object("value", "$.references"), F.col("value")).alias("value"))
    entry = F.from_json("value", "array<struct<title:string,families:array<string>,genera:array<string>,doi:string,url:string>>")
    return text.select(F.explode(entry).alias("e")).select("e.*")


def _folded(values: Column | str) -> Column:
    return F.array_distinct(F.filter(F.transform(F.coalesce(F.col(values) if isinstance(values, str) else values, F.array().cast("array<string>")), lambda x: F.lower(F.trim(x))), lambda x: x != ""))


def matches(asked: DataFrame, catalog: DataFrame, identity: str, entry: str, anywhere: DataFrame | None = None) -> DataFrame:
    """(identity, entry, by_genus): entries for questions ``asked`` (identity, family, genera), of a catalogue (entry, families, genera).

    An entry matches by family or by any genus, found by equi-joins. One without families is for all questions: all of
    these, or the few (entry) that the caller has chosen as ``anywhere``, are a row of their own for each question.
    """
    a = asked.select(identity, F.lower(F.trim(F.coalesce("family", F.lit("")))).alias("family"), _folded("genera").alias("genera"))
    c = catalog.select(entry, _folded("families").alias("families"), _folded("genera").alias("genera"))
    genus = a.select(identity, F.explode("genera").alias("x")).join(c.select(entry, F.explode("genera").alias("x")), "x").select(identity, entry, F.lit(True).alias("by_genus"))
    family = a.select(identity, F.col("family").alias("x")).join(c.select(entry, F.explode("families").alias("x")), "x").select(identity, entry, F.lit(False).alias("by_genus"))
    # The result has a row for each question and each of these; many are met bucket by bucket.
    buckets = 64 if anywhere is None else 1
    free = (c.filter(F.size("families") == 0) if anywhere is None else anywhere).select(entry, F.pmod(F.xxhash64(entry), F.lit(buckets)).cast("int").alias("_bucket"))
    everyone = a.select(identity, F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))).alias("_bucket")).join(sized(free), "_bucket").select(identity, entry, F.lit(False).alias("by_genus"))
    return genus.unionByName(family).unionByName(everyone).groupBy(identity, entry).agg(F.max("by_genus").alias("by_genus"))


def ranked_hits(hits: DataFrame, identity: str, limit: int = RESULTS) -> DataFrame:
    """``hits`` (identity, doi, url, title, score) once per DOI, else URL, else title, case aside, the highest score kept; of each question the first ``limit`` by score and title, as nth."""
    name = F.lower(F.coalesce(*[F.nullif(S.clean(F.col(c)), F.lit("")) for c in ("doi", "url", "title")]))
    best = hits.withColumn("_name", name).filter(F.col("_name").isNotNull()).groupBy(identity, "_name").agg(F.max_by(F.struct("doi", "url", "title", "score"), F.struct("score", "title")).alias("h")).select(identity, "h.*")
    nth = F.row_number().over(Window.partitionBy(identity).orderBy(F.desc("score"), F.trim("title"), "doi", "url"))
    return best.withColumn("nth", nth).filter(F.col("nth") <= limit)


def recommend(predictions: DataFrame, catalog: DataFrame, found: DataFrame | None = None, identity: str = "record_id", genera: int = GENERA, limit: int = RESULTS) -> DataFrame:
    """(identity, doi, url, title, score, nth): curated entries for each prediction (identity, family, genera in order), those for all predictions the first ``limit`` of them, and search results ``found`` (identity, doi, url, title, score) that have landed."""
    once = F.transform(F.filter(F.transform("genera", lambda x, i: F.struct(x.alias("x"), i.alias("i"))), lambda s: F.trim(s["x"]) != ""), lambda s: s["x"])
    asked = predictions.select(identity, "family", F.slice(S.top_unique(once), 1, genera).alias("genera"))
    entries = catalog.withColumn("_entry", F.struct("doi", "url", "title"))
    # Of entries for all questions, which score alike, the first ``limit`` can be among the results, and one more for each
    # search result of that score, which may stand for one of them under a later title.
    free = entries.filter(F.size(_folded("families")) == 0).select("doi", "url", F.col("title"), F.lit(0).alias("all"), F.lit(CURATED).alias("score"))
    hits = None if found is None else found.select(identity, "doi", "url", "title", F.col("score").cast("double").alias("score"))
    again = None if hits is None else cut(hits.filter(F.col("score") == CURATED).groupBy(identity).agg(F.count("*").alias("n")))
    most = 0 if again is None else again.agg(F.coalesce(F.max("n"), F.lit(0))).first()[0]
    listed = cut(ranked_hits(free, "all", limit + most).select(F.struct("doi", "url", "title").alias("_entry"), "nth"))
    first = listed.filter(F.col("nth") <= limit).select("_entry")
    curated = matches(asked, entries, identity, "_entry", first).select(identity, "_entry.*", F.when(F.col("by_genus"), CURATED + BY_GENUS).otherwise(CURATED).alias("score"))
    if hits is None:
        return ranked_hits(curated, identity, limit)
    further = asked.join(again, identity).select(identity, F.explode(F.sequence(F.lit(limit + 1), (F.lit(limit) + F.col("n")).cast("int"))).alias("nth")).join(listed, "nth")
    more = further.select(identity, "_entry.*", F.lit(CURATED).alias("score"))
    return ranked_hits(curated.unionByName(more).unionByName(hits), identity, limit)
