"""Readers and sinks on small files."""

import gzip
import json

import pytest
from pyspark.sql import functions as F

from speclake.operators import records
from speclake.sources import tables
from speclake.streaming import landing


def test_read_table_by_extension(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,name\n1,"x, ""y"""\n2,\n')
    (tmp_path / "occurrence.txt").write_text('id\tname\n1\t"x\n2\t\n')
    with gzip.open(tmp_path / "b.tsv.gz", "wt") as f:
        f.write("id\tname\n3\tz\n")
    (tmp_path / "c.jsonl").write_text('{"id": 4, "name": null}\n{"id": 5, "name": "q"}\n')
    rows = lambda name: sorted(tuple(r[c] for c in ("id", "name")) for r in tables.read_table(spark, str(tmp_path / name)).collect())
    assert rows("a.csv") == [("1", 'x, "y"'), ("2", "")]
    assert rows("occurrence.txt") == [("1", '"x'), ("2", "")]
    assert rows("b.tsv.gz") == [("3", "z")]
    assert rows("c.jsonl") == [("4", ""), ("5", "q")]
    with pytest.raises(ValueError):
        tables.read_table(spark, str(tmp_path / "d.bin"))


def test_unwrap_envelopes(spark):
    said = ['{"results": [{"a": 1}, {"a": 2}]}', '[{"a": 3}]', '{"a": 4}', '{"digitalSpecimen": {"a": 5}}', None]
    got = spark.createDataFrame([(s,) for s in said], "doc string").select(F.explode(tables.unwrap(F.col("doc"))).alias("x")).filter("x IS NOT NULL").collect()
    assert sorted(json.loads(r.x)["a"] for r in got) == [1, 2, 3, 4, 5]


def test_images_and_sinks(spark, tmp_path):
    (tmp_path / "in/deep").mkdir(parents=True)
    for name in ("a.JPG", "deep/b.png", "deep/c.txt"):
        (tmp_path / "in" / name).write_bytes(b"12")
    assert {r.local_path.rpartition("/")[2] for r in tables.list_images(spark, str(tmp_path / "in")).collect()} == {"a.JPG", "b.png"}
    frame = spark.createDataFrame([(1, True), (2, None)], "id int, ok boolean")
    out = tables.write_manifest(frame, str(tmp_path / "m"), ["id", "ok", "more"])
    assert sorted(map(tuple, out.collect())) == [("1", "true", ""), ("2", "", "")]
    with pytest.raises(ValueError):
        tables.write_manifest(frame.filter("id > 5"), str(tmp_path / "m"))
    assert tables.read_manifest(spark, str(tmp_path / "m")).count() == 2
    # A failed write leaves the older rows.
    with pytest.raises(Exception, match="stop"):
        tables.write_manifest(frame.withColumn("more", F.raise_error(F.lit("stop")).cast("string")), str(tmp_path / "m"))
    assert tables.read_manifest(spark, str(tmp_path / "m")).count() == 2
    tables.write_manifest(frame.filter("id = 2"), str(tmp_path / "m"), ["id"])
    assert [tuple(r) for r in tables.read_manifest(spark, str(tmp_path / "m")).collect()] == [("2",)]


def test_pick_keeps_document_order(spark):
    said = ['{"b": {"x:K": {"k": "deep"}}, "k": "top"}', '{"k": [1, 2], "c": [{"k": "in list"}]}', "no json", None, '{"k": " "}']
    got = records.with_picked(spark.createDataFrame(list(enumerate(said)), "id int, doc string"), "doc", ["k"], "value")
    assert [r.value for r in got.orderBy("id").collect()] == ["deep", "in list", "", "", ""]


def test_stream_goes_on_from_its_checkpoint(spark, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    spark.createDataFrame([(1, "a"), (2, "b"), (1, "a")], "id int, x string").write.parquet(folder)
    assert landing.first_seen(landing.landed(spark, folder), ["id"], out).count() == 2
    spark.createDataFrame([(2, "b"), (3, "c")], "id int, x string").write.mode("append").parquet(folder)
    assert sorted(r.id for r in landing.first_seen(landing.landed(spark, folder), ["id"], out).collect()) == [1, 2, 3]
