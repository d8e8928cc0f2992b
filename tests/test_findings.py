"""Results and sizes that reviews found wrong, on tables made for it."""

import math

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from speclake.functions import scalars as S
from speclake.functions.vectors import rounded
from speclake.operators import manifest
from speclake.sources import tables


def test_rounding_keeps_the_sign_of_zero(spark):
    xs = [-1e-7, -4.9e-7, -0.0, 0.0, 1e-7, -1.5e-6, 2.5, float("nan"), None]
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "i int, x double").select("i", rounded(F.col("x"), 6).alias("x")).orderBy("i").collect()
    want = [r[0] for r in duckdb.sql("SELECT round(x::DOUBLE, 6) FROM (VALUES " + ", ".join("('nan')" if x is not None and math.isnan(x) else "(NULL)" if x is None else f"('{x!r}')" for x in xs) + ") t(x)").fetchall()]
    assert [repr(r["x"]) for r in rows] == [repr(x) for x in want]


@pytest.mark.parametrize("name", ["c22_a7_fuse_views", "c23_j11_v4_fuse_encoders", "v1_k6_retrieval_table"])
def test_small_negative_elements_round_as_in_sql(spark, tmp_path, name):
    """Elements that round to zero from below, as some of a million do."""
    vectors = [(i, [1.0 + i, *[-1e-7 if (i + j) % 3 else 1e-7 for j in range(31)], 2.0, *[-2e-7] * 31], i % 2) for i in range(24)]
    spark.createDataFrame(vectors, "vec_id long, embedding array<float>, label int").coalesce(1).write.parquet(f"{tmp_path}/embeddings.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{tmp_path}/embeddings.parquet/*.parquet')")
    made = entry.queries()[name](spark, str(tmp_path))
    want = con.execute(f"SELECT {', '.join(made.columns)} FROM ({entry.oracle_sql()[name]})").fetchall()
    assert any("-0.0" in repr(r) for r in want)
    assert sorted(map(repr, want)) == sorted(repr(tuple(r)) for r in made.collect())


def test_finalize_computes_each_part_once(spark):
    """A licence is read once, and columns that a table lacks are constants, not carried from step to step."""
    t = spark.createDataFrame([("CC BY 4.0", "a"), (" http://creativecommons.org/publicdomain/zero/1.0/", "b"), ("https://example.org/terms", "c"), (None, "d")], "image_license string, source_record_id string")
    plan = t.select(S.normalize_license(F.col("image_license")).alias("x"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract") == 2 and plan.count("split(") == 1
    made = manifest.finalize(t)
    assert "tribe" not in made._jdf.queryExecution().optimizedPlan().toString().partition("Generate")[2]
    assert {r["source_record_id"]: r["image_license"] for r in made.collect()} == {"a": "CC-BY", "b": "CC0", "c": "HTTPS://EXAMPLE.ORG/TERMS", "d": "UNKNOWN"}
    assert manifest.finalize(t.select(F.lit(1).alias("x"))).select("source", "image_license").distinct().collect() == [("unknown", "UNKNOWN")]


def test_partitioned_write_makes_as_many_files_as_rows_fill(spark, tmp_path, monkeypatch):
    """Small shards are a file each; a hot value, null too, is spread over several; no row is lost."""
    monkeypatch.setattr(tables, "FILE_ROWS", 100)
    t = spark.range(2000).select("id", F.when(F.col("id") < 1000, "hot").when(F.col("id") >= 1600, F.concat(F.lit("s"), F.col("id") % 10)).alias("k"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)  # else tables as small as this one are one task
    try:
        back = tables.write_partitioned(t, f"{tmp_path}/out", "k")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert dict(map(tuple, back.select("id", "k").collect())) == dict(map(tuple, t.collect())) and back.count() == 2000
    files = {k.name: len(list(k.glob("*.parquet"))) for k in (tmp_path / "out").iterdir() if k.is_dir()}
    assert all(n == 1 for k, n in files.items() if k.startswith("k=s")) and files["k=hot"] > 1 and files["k=__HIVE_DEFAULT_PARTITION__"] > 1


def made_and_wanted(spark, folder, name, documents):
    """Rows of a query and of its SQL over ``documents`` (doc_id, text, source, n_chars), as texts, so that -0.0, NaN and null are told apart."""
    spark.createDataFrame(documents, "doc_id long, text string, source string, n_chars long").coalesce(1).write.parquet(f"{folder}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{folder}/documents.parquet/*.parquet')")
    made = entry.queries()[name](spark, str(folder))
    want = con.execute(f"SELECT {', '.join(made.columns)} FROM ({entry.oracle_sql()[name]})").fetchall()
    return sorted(repr(tuple(r)) for r in made.collect()), sorted(map(repr, want))


def test_entropy_of_texts_without_or_with_one_character(spark, tmp_path):
    """An empty text is a row of its own, null is none, and a distribution of one character has -0.0 bits, as in SQL."""
    texts = ["", None, "a", "aaaa", " ", "\n\n", "👍", "ab", "aab\u0301", "x👍", "Von.", ""]
    made, want = made_and_wanted(spark, tmp_path, "a15_entropy", [(i, x, "src0", None if x is None else len(x)) for i, x in enumerate(texts)])
    assert made == want and len(made) == 11 and sum("-0.0" in r for r in made) == 7


def test_decision_on_images_without_or_of_unknown_height(spark, tmp_path):
    """An image of no area has a box whose share is NaN, one of unknown height is judged by its width, as in SQL."""
    heights = (0, None, 1, 299, 1027, 6027)
    made, want = made_and_wanted(spark, tmp_path, "f9_quality_decision", [(k, "", s, n) for n in heights for s in ("src0", "src5", None) for k in (*range(15), None)])
    assert made == want and sum("nan" in r for r in made) == 36
