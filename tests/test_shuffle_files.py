"""Materialised tables leave no shuffle files behind, whether or not the driver collects its garbage."""

import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from speclake.llm import langmodel, simhash
from speclake.sources import shared


def shuffled(spark) -> set[Path]:
    return set(Path(spark.sparkContext.getConf().get("spark.local.dir")).glob("blockmgr-*/*/shuffle_*.data"))


@pytest.mark.parametrize("materialise", [shared.cut, langmodel.stored])
def test_shuffle_files_go_with_the_query_that_made_them(spark, materialise):
    before = shuffled(spark)
    counted = spark.range(1000).groupBy((F.col("id") % 10).alias("k")).count()
    kept = materialise(counted)
    until = time.time() + 10
    while (left := shuffled(spark) - before) and time.time() < until:
        time.sleep(0.1)
    assert not left
    assert spark.conf.get(shared.FREE, "false") == "false"
    assert kept.count() == 10 and counted.filter("count = 100").count() == 10


def test_scores_keep_only_the_table_that_texts_ask(spark):
    made = lambda: {p.parent for p in Path(spark.sparkContext.getCheckpointDir().removeprefix("file:")).rglob("_SUCCESS")}
    docs = spark.createDataFrame([(i, f"one two rare{i // 2} three") for i in range(20)], "doc_id long, text string")
    langmodel.stored(docs)
    before = made()
    scores = langmodel.score_texts(docs)
    assert len(made() - before) == 1
    assert scores.count() == 20 and len({r.score for r in scores.collect()}) > 1


def test_components_start_from_distinct_links(spark):
    links = spark.createDataFrame([(2, 1), (1, 2), (2, 1), (3, 2), (3, 3), (9, 7)], "a long, b long")
    assert sorted(map(tuple, simhash.components(links).collect())) == [(2, 1), (3, 1), (9, 7)]
