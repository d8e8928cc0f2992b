"""Corpus pipeline over ``documents``: each stage calls one training-data operator on all rows that the stage before kept.

Every stage but the last returns the columns of documents (doc_id, text, lang, source, n_chars).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from speclake.llm import decontaminate, langid, langmodel, lines, mixing, simhash
from speclake.llm.common import cut, sized, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts without a letter and those whose best language has not over half of the probability.

    Learned from the documents with a language, without those held out. Of rows that share an id all
    go if one is rejected for each of its texts; null ids are judged like others.
    """
    docs = docs.select(COLUMNS)
    keyed = docs.select(F.xxhash64("doc_id", "text").alias("doc_id"), "text")
    pieces = langid.vocabulary()
    languages, p = langid.train(docs.filter(~langmodel.held_out(parts=3, part=1)), pieces)
    found = langid.identify(keyed, languages, p, pieces)
    rejected = cut(found.filter("lang_pred = 'und' OR score <= 0.5").select(F.col("doc_id").alias("rejected")).distinct())
    return docs.join(sized(rejected), F.xxhash64("doc_id", "text") == F.col("rejected"), "left_anti")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes boilerplate lines of each source; n_chars follows the text."""
    return lines.drop_boilerplate(docs.select(COLUMNS)).withColumn("n_chars", F.length("text").cast("long")).select(COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each near-duplicate group."""
    return simhash.keep_one(docs.select(COLUMNS))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a window of a benchmark item."""
    return decontaminate.remove_contaminated(docs.select(COLUMNS), table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Draws the mix: doc_id, size, source_size, target, taken."""
    return mixing.mix_sources(docs.select(COLUMNS))


STAGES = [("language_id", language_id), ("line_dedup", line_dedup), ("near_dedup", near_dedup), ("decontamination", decontamination), ("mix", mix)]

#: Fingerprints by XXH64, expectation maximisation and subset sums are not to be had in SQL; tests/llm compares with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs if name == STAGES[0][0] else cut(docs), sf_dir)
    return docs
