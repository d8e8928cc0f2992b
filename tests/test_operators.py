import math
from collections import Counter

from pyspark.sql import functions as F

from speclake.functions import scalars as S
from speclake.operators import manifest, sampling, vectors


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_licences(spark):
    said = {"https://creativecommons.org/licenses/by/4.0/": "CC-BY", "CC BY 3.0": "CC-BY", "cc-by-nc": "CC-BY-NC", "project-owned": "PROJECT-OWNED", None: "UNKNOWN", "CC BY-NC-ND 2.5": "CC BY-NC-ND 2.5"}
    for text, code in said.items():
        assert one(spark, S.normalize_license(F.lit(text))) == code, text


def test_views_and_ids(spark):
    for name, view in (("a/voucher-1_wing.jpg", "wing"), ("voucher-1_terminalia.png", "terminalia"), ("voucher-1.jpg", "habitus")):
        assert one(spark, S.view_type(F.lit(name))) == view
    assert one(spark, S.plain_identifier(F.lit("https://doi.org/10.1/ab"))) == "10.1/ab"
    assert one(spark, S.clean(F.lit(" NaN "))) == ""
    assert one(spark, S.real_species(F.lit("Aus cf. bus"))) == ""


def test_finalize_is_idempotent(spark):
    row = [("m", "1", "p", "CC BY 4.0", "Ord", "Fam", "Aus bus (Author, 1900)")]
    raw = spark.createDataFrame(row, "source string, source_record_id string, source_image_id string, image_license string, `order` string, family string, species string")
    once = manifest.finalize(raw)
    got = once.first()
    assert (got["species"], got["genus"], got["specimen_group_id"], got["eligible_supervised"]) == ("Aus bus", "Aus", "m:1", True)
    assert manifest.finalize(once).collect() == once.collect()
    assert manifest.finalize(raw.limit(0)).count() == 0


def test_budgets():
    given = sampling.granted([3, 30, 30], lambda free, _: math.sqrt(free), 50)
    assert sum(given) == 50 and given[0] == 3 and max(given) <= 30
    assert sampling.granted([5, 100], lambda _, i: (1, 1)[i], 60) == [5, 55]


def test_plan_and_shards(spark):
    rows = [(f"r{i}", f"s{i % 4}", f"genus:g{i % 3}") for i in range(60)]
    df = spark.createDataFrame(rows, "record_id string, source string, bucket string")
    requested = {f"s{i}": 1 for i in range(4)}
    got = sampling.plan(df, requested, 20, 10, 1).collect()
    assert len(got) == 20 and set(Counter(r["source"] for r in got).values()) == {5}
    assert {r["record_id"] for r in sampling.plan(df.repartition(7), requested, 20, 10, 1).collect()} == {r["record_id"] for r in got}
    assert sampling.plan(df, requested, 0, 10, 1).count() == 60
    shards = sampling.assign_shards(df.limit(21).withColumn("g", F.col("record_id")), "g", 10).groupBy("shard_id").count().collect()
    assert len(shards) == 3 and max(r["count"] for r in shards) - min(r["count"] for r in shards) <= 1


def test_fusion_and_search(spark):
    a = spark.createDataFrame([("b", [10.0, 0.0]), ("a", [1.0, 0.0])], "k string, va array<double>")
    b = spark.createDataFrame([("b", [0.0, 0.0, 5.0])], "k string, vb array<double>")
    (row,) = vectors.fuse_encoders(a, b, "k").collect()
    assert [round(x, 6) for x in row["embedding"]] == [0.707107, 0, 0, 0, 0.707107]
    index = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(20)], "vec_id long, embedding array<double>")
    got = vectors.nearest(index.filter("vec_id = 19"), index, 3).orderBy("nth").collect()
    assert [r["id"] for r in got] == [19, 18, 17]


def test_search_takes_any_number_of_queries(spark):
    index = spark.createDataFrame([(i, [float(i % 7), float(i % 5), 1.0]) for i in range(23)], "vec_id long, embedding array<double>")
    rows = lambda bound: sorted(vectors.nearest(index, index, 3, bound=bound).collect())
    assert len(rows(23)) == 69 and rows(23) == rows(5) == rows(22)
