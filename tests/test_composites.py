"""Ingestors, gates, cohorts, heads and guards on small fixtures."""

import json
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from speclake.functions import documents as D
from speclake.functions import scalars as S
from speclake.functions.vectors import unit
from speclake.operators import evaluation, ingest, learning, manifest, quality, records, references, sampling, vectors


def rows(spark, names, *data):
    return spark.createDataFrame(list(data), ", ".join(n if " " in n else f"`{n}` string" for n in names))


def test_photo_bundle(spark):
    taxa = rows(spark, ["taxon_id", "ancestry", "rank", "name"], ("47822", "1", "order", "Diptera"), ("100", "1/47822", "family", "Ausidae"), ("101", "1/47822/100", "genus", "Aus"), ("102", "1/47822/100/101", "species", "Aus bus"), ("9", "1", "order", "Other"), ("10", "1/9", "species", "Cus dus"))
    observations = rows(spark, ["observation_uuid", "observer_id", "taxon_id", "quality_grade", "observed_on"], ("u1", "5", "102", "research", "2020"), ("u2", "5", "10", "research", "2020"), ("u3", "5", "102", "needs_id", "2020"))
    photos = rows(spark, ["photo_uuid", "photo_id", "observation_uuid", "observer_id", "extension", "license"], ("p", "77", "u1", "5", "jpg", "CC-BY"), ("q", "78", "u2", "5", "jpg", "CC-BY"), ("r", "79", "u1", "5", "jpg", "CC-BY-NC"))
    observers = rows(spark, ["observer_id", "login", "name"], ("5", "someone", "Some One"))
    (got,) = ingest.ingest_photo_bundle(observations, photos, taxa, observers).collect()
    assert (got["family"], got["genus"], got["species"], got["label_quality"]) == ("Ausidae", "Aus", "Aus bus", "C")
    assert got["image_url"].endswith("/photos/77/medium.jpg") and got["observer"] == got["attribution"] == "someone"
    assert ingest.ingest_photo_bundle(observations, photos, taxa, grades=(), licenses=None).count() == 2
    with pytest.raises(ValueError):
        ingest.ingest_photo_bundle(observations, photos, taxa.filter("taxon_id = '9'"))
    assert ingest.ingest_photo_bundle(observations.limit(0), photos, taxa).count() == 0


def test_flat_barcode_and_archive(spark):
    flat = rows(spark, ["id", "order", "family", "genus", "species", "eventDate"], ("1", "Diptera", "Ausidae", "Aus", "Aus bus", "2020"))
    photos = rows(spark, ["coreid", "id", "type", "identifier", "license"], ("1", "m1", "StillImage", "https://x.org/1.jpg", "CC BY 4.0"), ("1", "m2", "Sound", "https://x.org/1.mp3", "CC0"), ("2", "m3", "StillImage", "https://x.org/2.jpg", "CC0"))
    (got,) = ingest.ingest_flat_occurrences(flat, photos).collect()
    assert (got["image_license"], got["source_image_id"], got["label_quality"]) == ("CC-BY", "m1", "C")
    barcode = rows(spark, ["processid", "order", "family", "genus", "species", "dna_barcode", "dna_bin", "image_url"], ("p1", "Diptera", "Ausidae", "Aus", "Aus bus", "ACGT", "BOLD:AAA", "https://x.org/1.jpg"))
    got = ingest.ingest_barcode(barcode).first()
    assert (got["label_quality"], got["image_license"], got["is_preserved_specimen"]) == ("A", "CC-BY", True)
    assert ingest.ingest_barcode(barcode.drop("image_url"), "/images").first()["local_path"] == "/images/p1.jpg"
    occurrence = rows(spark, ["gbifID", "order", "basisOfRecord", "family", "genus", "species"], ("7", "Diptera", "PRESERVED_SPECIMEN", "Ausidae", "Aus", "Aus bus"), ("7", "Diptera", "PRESERVED_SPECIMEN", "Ausidae", "Aus", "Aus bus"))
    media = rows(spark, ["coreid", "type", "identifier", "license"], ("7", "StillImage", "https://x.org/7.jpg", "http://creativecommons.org/licenses/by-sa/4.0/"))
    (got,) = ingest.ingest_dwca(occurrence, media).collect()
    assert (got["image_license"], got["specimen_group_id"], got["label_quality"]) == ("CC-BY-SA", "GBIF:7", "B")


def test_digital_specimens(spark):
    nested = {"digitalSpecimenId": "d1", "order": "Diptera", "family": "Ausidae", "genus": "Aus", "species": "Aus bus", "ods:hasMedia": [{"digitalMediaId": "m", "mediaType": "image", "accessURI": "https://x.org/1.jpg", "license": "CC0"}]}
    full = {"data": {"id": "d2", "attributes": {"digitalSpecimen": {"dwc:order": "Diptera", "ods:x": {"dwc:family": "Ausidae"}, "dwc:basisOfRecord": "PreservedSpecimen"}, "digitalMedia": [
        {"digitalMediaObject": {"@id": "https://doi.org/10.1/m", "dcterms:identifier": "https://doi.org/10.1/m", "dcterms:type": "StillImage", "ac:accessURI": "https://x.org/2.jpg", "dcterms:rights": "CC BY 4.0"}, "annotations": [{"ac:accessURI": "https://wrong.org/3.jpg"}]}]}}}
    said = [json.dumps(nested), json.dumps(full), "no json", None, json.dumps({"order": "Other", "id": "x"})]
    got = {r["source_record_id"]: r for r in ingest.ingest_digital_specimens(spark.createDataFrame([(s,) for s in said], "document string")).collect()}
    assert {k: (r["image_url"], r["image_license"], r["family"]) for k, r in got.items()} == {"d1": ("https://x.org/1.jpg", "CC0", "Ausidae"), "d2": ("https://x.org/2.jpg", "CC-BY", "Ausidae")}
    deep = value = {}
    for k in range(40):
        value[f"l{k}"] = value = {}
    value["a/x#K"] = "found"
    got = spark.createDataFrame([(json.dumps(deep),)], "doc string").select(D.pick(D.opened("doc"), "k").alias("x")).first()
    assert got["x"] == "found"


def test_archive_members_of_any_depth(spark):
    listing = rows(spark, ["path"], ("x/a/b/c/d/e.jpg",), ("y/a/b/c/d/e.jpg",), ("z/e.jpg",), ("z/be.jpg",))
    wanted = rows(spark, ["member"], ("a/b/c/d/e.jpg",), (".\\z\\e.jpg",), ("/e.jpg",), ("c/e.jpg",), ("",), (None,))
    got = {r["member"]: r["path"] for r in records.match_archive(wanted, listing, "member", "path").collect()}
    assert got == {"a/b/c/d/e.jpg": "x/a/b/c/d/e.jpg", ".\\z\\e.jpg": "z/e.jpg", "/e.jpg": "x/a/b/c/d/e.jpg", "c/e.jpg": None, "": None, None: None}


def test_harmonize(spark):
    t = rows(spark, ["record_id", "original_scientific_name", "species", "genus", "family", "image_license", "exclusion_reason"], ("1", "Old name", "Aus bus", "Aus", "Ausidae", "CC0", ""), ("2", "", "", "", "Ausidae", "CC0", "corrupt_image"), ("3", "Eus fus (Someone)", "", "", "", "CC0", ""))
    reviewed = rows(spark, ["raw_name", "accepted_name", "accepted_taxon_id"], ("OLD NAME", "Cus dus", "9"), ("", "Nothing", "1"))
    got = {r["record_id"]: r for r in manifest.harmonize(t, reviewed).collect()}
    assert [got["1"][c] for c in ("species", "genus", "accepted_scientific_name", "taxon_id", "family")] == ["Cus dus", "Cus", "Cus dus", "9", "Ausidae"]
    assert (got["2"]["eligible_supervised"], got["2"]["identification_level"], got["3"]["species"], got["3"]["identification_level"]) == (False, "family", "Eus fus", "species")


def test_views_and_encoders(spark):
    t = rows(spark, ["specimen_group_id", "record_id", "view_type", "family", "v array<double>"], ("s", "a", "wing", "F", [1.0, 0.0]), ("s", "b", "dorsal", "G", [0.0, 1.0]), ("", "c", "", "F", [2.0, 0.0]), (" ", "d", "head", "F", [0.0, 3.0]))
    got = {r["specimen_group_id"]: r for r in vectors.fuse_views(t, vector="v").collect()}
    assert set(got) == {"s", "record:c", "record:d"} and (got["s"]["available_views"], got["s"]["view_count"], got["s"]["embedding_view_ids"]) == ("dorsal,wing", 2, "a,b")
    assert (got["s"]["family"], got["s"]["exclusion_reason"], got["record:c"]["available_views"]) == ("", "conflicting_family_within_specimen", "habitus")
    with pytest.raises(ValueError):
        vectors.assert_one_split(vectors.fuse_views(t.withColumn("split", F.when(F.col("record_id") == "a", "train").otherwise("val")), vector="v"))
    a = rows(spark, ["k", "va array<double>"], ("a", [1.0]), ("b", [2.0]))
    assert [tuple(r) for r in vectors.key_problems(a, a.filter("k = 'b'"), "k").collect()] == [("left", "alone", 1)]
    with pytest.raises(ValueError):
        vectors.fuse_encoders(a, a.unionAll(a).withColumnRenamed("va", "vb"), "k")
    with pytest.raises(ValueError):
        vectors.merge_shards([a, a.withColumn("va", F.array(F.lit(1.0), F.lit(2.0)))], "va")
    lengths = spark.range(3).select(unit(F.array_repeat(F.col("id").cast("double"), 512)).alias("u")).collect()
    assert [round(sum(x * x for x in r["u"]), 6) for r in lengths] == [0.0, 1.0, 1.0]


def test_quality(spark):
    limits = {"image_side": 50, "contrast": 5.0, "entropy": 1.0, "specimen_side": 30, "specimen_area": 0.001, "crop_below": 0.35}
    plan = rows(spark, ["record_id", "source", "local_path", "image_sha256"], *[(str(k), "trusted" if k == 4 else "strict", f"p{k}", "") for k in range(6)])
    metrics = rows(spark, ["record_id", "width int", "height int", "contrast double", "entropy double"], *[(str(k), 1000, 1000, 1.0 if k == 5 else 50.0, 5.0) for k in range(6)])
    box = "struct<x1:double,y1:double,x2:double,y2:double>"
    boxes = {"1": (0.0, 0.0, 30.0, 25.0), "2": (0.0, 0.0, 400.0, 400.0), "3": (-50.0, 0.0, 900.0, 2000.0), "4": None}
    detections = rows(spark, ["record_id", f"box {box}", "cropped_path", "cropped_sha256"], *[(k, b, f"crop{k}", "h") for k, b in boxes.items()])
    none = rows(spark, ["record_id", "decision"], ("9", "accept")).limit(0)
    said = {r["record_id"]: (r["decision"], r["reason"]) for r in quality.decide(plan, metrics, detections, none, ["strict"], limits).collect()}
    assert said == {"0": S.NOTHING_FOUND, "1": S.SPECIMEN_SMALL, "2": S.CROPPED, "3": S.LARGE_ENOUGH, "4": S.TRUSTED, "5": S.BLANK}
    gate = quality.quality_gate(plan, metrics, detections, rows(spark, ["record_id", "decision"], ("0", "accept"), ("4", "")), ["strict"], limits)
    assert {r["record_id"]: r["local_path"] for r in gate.accepted.collect()} == {"0": "p0", "2": "crop2", "3": "p3", "4": "p4"}
    assert {r["record_id"]: r["exclusion_reason"] for r in gate.quarantined.collect()} == {"1": "quality:specimen_too_small", "5": "quality:blank_or_near_uniform"}
    assert {r["source"]: (r["input"], r["accepted"], r["cropped"]) for r in gate.by_source.collect()} == {"strict": (5, 3, 1), "trusted": (1, 1, 0)}
    for bad, required in ((rows(spark, ["record_id", "decision"], ("99", "accept")), None), (none, ["absent"])):
        with pytest.raises(ValueError):
            quality.quality_gate(plan, metrics, detections, bad, ["strict"], limits, required)


def test_balanced_selection(spark):
    data = [(f"p{k}", "Diptera", f"F{k % 3}", f"G{k % 5}", f"Aus s{k}" if k % 2 else "Aus sp. 1", ("pretrain", "train", "val", "test")[k % 4], "c") for k in range(80)]
    t = rows(spark, ["processid", "order", "family", "genus", "species", "split", "chunk"], *data, ("other", "Other", "F0", "G", "x y", "train", ""))
    eligible = records.selection_eligible(t, "Diptera", "processid", ["pretrain", "train", "val", "test"], ["family"])
    got = sampling.select_balanced(eligible, {"pretrain": 6, "train": 6, "val": 3, "test": 3}, 18, 2, 42)
    assert Counter(r["split"] for r in got.collect()) == {"pretrain": 6, "train": 6, "val": 3, "test": 3}
    assert got.columns == [*t.columns, "bucket", "archive_group", "archive_member"] and max(Counter((r["split"], r["bucket"]) for r in got.collect()).values()) <= 2
    assert sorted(r[0] for r in got.collect()) == sorted(r[0] for r in sampling.select_balanced(eligible.repartition(5), {"pretrain": 6, "train": 6, "val": 3, "test": 3}, 18, 2, 42).collect())
    scoped = records.selection_eligible(t, "diptera", "processid", ["train"], ["family"], rows(spark, ["family"], ("f1",)))
    assert {r["family"] for r in scoped.collect()} == {"F1"}


def test_cohorts_and_reports(spark, tmp_path):
    names = ["record_id", "split_group", "split", "source", "family"]
    t = rows(spark, names, ("1", "a", "train", "s", "F"), ("2", "b", "val", "s", "F"), ("3", "", "test", "s", "G"))
    cohort = evaluation.freeze(t)
    assert Counter(r["split"] for r in cohort.collect()) == {"val": 1, "test": 1}
    assert evaluation.keep_frozen(cohort, cohort.orderBy(F.desc("record_id"))).count() == 2
    for bad in (t.unionAll(rows(spark, names, ("4", "a", "val", "s", "F"))), t.withColumn("split", F.lit("elsewhere")), t.filter("split = 'train'"), t.drop("family")):
        with pytest.raises(ValueError):
            evaluation.freeze(bad)
    with pytest.raises(ValueError):
        evaluation.keep_frozen(cohort, cohort.filter("split = 'val'"))
    audited = evaluation.audit(manifest.finalize(t.withColumn("image_license", F.lit("CC0"))))
    assert evaluation.missing_sources(audited, ["s", "other"]) == ["other"]
    lines = [r["line"] for r in evaluation.write_report(audited.filter("dimension = 'source'"), str(tmp_path / "r"), "Audit").orderBy("at").collect()]
    assert lines[0] == "# Audit" and lines[-1] == "| source | s | 3 |" and [r[0] for r in spark.read.text(str(tmp_path / "r/markdown")).collect()] == lines
    with pytest.raises(ValueError):
        evaluation.compare({"a": ("x", audited), "b": ("y", audited)})
    old, new = rows(spark, ["processid", "family"], ("1", "F"), ("2", "F")), rows(spark, ["processid", "family"], ("2", "G"), ("3", "G"))
    assert {r["processid"]: r["family"] for r in manifest.merge(old, new, "processid", keep_ids=True).collect()} == {"1": "F", "2": "G", "3": "G"}
    with pytest.raises(ValueError):
        manifest.merge(old.unionAll(rows(spark, ["processid", "family"], ("", "F"))), new, "processid", keep_ids=True)
    assert not evaluation.leaks(t, "split_group").collect()


def test_heads(spark):
    rng = np.random.default_rng(3)
    data = []
    for k in range(96):
        c = k % 8
        v = np.zeros(8)
        v[c], v[c // 4] = 1.0, v[c // 4] + 0.6
        data.append((str(k), f"s{k % 2}", f"F{c // 4}", f"G{c // 2}", f"S{c}", "A" if k % 3 else "D", str(k), (v + rng.normal(0, 0.05, 8)).tolist()))
    t = rows(spark, ["record_id", "source", "family", "genus", "species", "label_quality", "split_group", "embedding array<double>"], *data)
    heads = learning.train_heads(t)
    assert Counter(r["rank"] for r in heads.collect()) == {"family": 2, "genus": 4, "species": 8}
    got = {r["record_id"]: r for r in learning.accepted(learning.predict_hierarchical(t, heads)).collect()}
    best = lambda r, rank: next((c["taxon"] for c in r["candidates"] if c["rank"] == rank and c["nth"] == 1), None)
    assert all(best(got[x[0]], "family") == x[2] and best(got[x[0]], "genus") in (x[3], None) for x in data)
    assert sum(best(got[x[0]], "species") == x[4] for x in data) > 80
    away = rows(spark, ["record_id", "embedding array<double>"], ("far", [-1.0] * 8))
    (far,) = learning.accepted(learning.predict_hierarchical(away, heads)).collect()
    assert far["rejected_rank"] == "family" and far["accepted_rank"] is None
    flat, held = learning.train_flat(t, "genus", train=60)
    ranked = learning.predict_hierarchical(held, flat.withColumn("rank", F.lit("family"))).select("record_id", F.explode("candidates").alias("c")).select("record_id", F.col("c.taxon").alias("guess"), "c.nth")
    (overall,) = evaluation.accuracy(held, ranked, "record_id", "genus", []).collect()
    assert overall["n"] == held.count() and overall["top1"] == overall["n"]
    weighed = {r["record_id"]: r["weight"] for r in learning.balance_weights(rows(spark, ["record_id", "label", "source"], ("1", "A", "i"), ("2", "A", "i"), ("3", "A", "i"), ("4", "B", "b")), "label", "source").collect()}
    assert weighed["4"] > weighed["1"]
    assert learning.train_heads(t.limit(0)).count() == 0


def test_embedding_keeps_failures(spark):
    def encoder(contents):
        if b"bad" in contents:
            raise KeyError("bad")
        return [[len(c), 1.0] for c in contents]

    t = spark.createDataFrame([("1", b"abc"), ("2", b"bad"), ("3", None), ("4", b"")], "record_id string, image binary")
    got = learning.embed(t, encoder, "image")
    assert {r["record_id"]: (r["embedding"], r["error"]) for r in got.collect()} == {"1": ([3.0, 1.0], ""), "2": (None, "KeyError"), "3": (None, "Missing"), "4": ([0.0, 1.0], "")}
    (state,) = learning.shard_success(t.select("record_id", F.lit(0).alias("shard")), got, "shard").collect()
    assert (state["expected"], state["observed"], state["complete"]) == (4, 2, False)


def test_recommendations(spark):
    catalog = rows(spark, ["title", "families array<string>", "genera array<string>", "doi", "url"], ("By family", ["Ausidae"], [], "", "https://a.org"), ("By genus", ["Other"], ["AUS"], "10.1/x", ""), ("For all", [], [], "", "https://c.org"), ("Not", ["Other"], ["Cus"], "", ""))
    asked = rows(spark, ["record_id", "family", "genera array<string>"], ("1", "ausidae", ["Aus", "aus", "", "B", "C", "D", "Cus"]), ("2", None, None))
    found = rows(spark, ["record_id", "doi", "url", "title", "score double"], ("1", "10.1/X", "", "Found again", 50.0), ("1", "", "", "", 500.0))
    got = {k: [(r["title"], r["score"]) for r in sorted(references.recommend(asked, catalog, found).collect(), key=lambda r: r["nth"]) if r["record_id"] == k] for k in "12"}
    assert got == {"1": [("By genus", 110.0), ("By family", 100.0), ("For all", 100.0)], "2": [("For all", 100.0)]}


def test_open_set_stops_acceptance(spark):
    p = {"family": F.lit(0.9), "genus": F.lit(0.9), "species": F.lit(0.9)}
    said = [records.accepted_rank(p, F.lit(r).cast("string")).alias(str(i)) for i, r in enumerate((None, "family", "genus", "species"))]
    assert list(spark.range(1).select(*said).first()) == ["species", None, "family", "genus"]
    assert [r[0] for r in spark.createDataFrame([("src_0.5",), ("",), ("A b/C",)], "x string").select(S.slug(F.col("x"))).collect()] == ["src_0.5", "unknown", "a-b-c"]


def test_hot_keys_in_dedup_and_order(spark):
    t = spark.range(200).select(F.when(F.col("id") < 150, "hot").otherwise(F.col("id").cast("string")).alias("duplicate_key"), F.col("id").alias("record_id"), F.struct(-F.col("id")).alias("priority"))
    got = {r["duplicate_key"]: (r["record_id"], r["group_size"]) for r in manifest.deduplicate(t).collect()}
    assert got["hot"] == (149, 150) and len(got) == 51
    places = sorted((r["at"], r["size"]) for r in sampling.group_order(t, "duplicate_key").collect())
    assert [p for p, _ in places] == list(range(51)) and places[0][1] == 150
