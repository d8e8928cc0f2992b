"""The image quality gate: decisions by rules, manual overrides, accepted and quarantined rows, reports."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from speclake.functions import scalars as S
from speclake.sources import tables
from speclake.sources.shared import cut, sized

#: What a manual override may say, and which decisions keep a row.
OVERRIDES = ("accept", "exclude", "")
KEPT = ("accept", "accept_crop")


class Gate(NamedTuple):
    accepted: DataFrame
    quarantined: DataFrame
    decisions: DataFrame
    by_source: DataFrame
    by_reason: DataFrame


def read_overrides(spark: SparkSession, path: str) -> DataFrame:
    """(record_id, decision) of a reviewed table; anything but accept, exclude or nothing is an error, and of an id the last by text counts."""
    t = tables.read_table(spark, path)
    rows = t.select(S.clean(F.col("record_id")).alias("record_id"), F.lower(S.clean(F.col("decision"))).alias("decision")).filter("record_id != ''")
    if not rows.filter(~F.col("decision").isin(*OVERRIDES)).isEmpty():
        raise ValueError("an override may say accept, exclude or nothing")
    return rows.groupBy("record_id").agg(F.max("decision").alias("decision"))


def decide(plan: DataFrame, metrics: DataFrame, detections: DataFrame, overrides: DataFrame, strict: list[str], limits: dict[str, float], identity: str = "record_id") -> DataFrame:
    """(identity, source, decision, reason, manual_override, cropped_path, cropped_sha256) of each row of ``plan``.

    ``metrics`` (identity, width, height, contrast, entropy), ``detections`` (identity, box, cropped_path, cropped_sha256) of the
    sources that are judged strictly. A row without metrics couldn't be read. Overrides of unknown rows are an error.
    """
    overrides = cut(overrides.filter("decision != ''").select(F.col(identity), F.col("decision").alias("manual_override")))
    if not overrides.join(plan.select(identity), identity, "left_anti").isEmpty():
        raise ValueError("an override names an unknown row")
    rows = plan.select(identity, "source").join(metrics, identity, "left").join(detections, identity, "left").join(sized(overrides), identity, "left")
    said = S.quality_decision(~F.col("source").isin(*strict), F.col("width"), F.col("height"), F.col("contrast"), F.col("entropy"), F.col("box"), limits)
    unread = F.struct(F.lit("exclude").alias("decision"), F.lit("unreadable_image").alias("reason"))
    by_hand = F.struct(F.col("manual_override").alias("decision"), F.concat(F.lit("manual_"), "manual_override").alias("reason"))
    own = F.when(F.col("manual_override").isNotNull(), by_hand).when(F.col("width").isNull(), unread).otherwise(said)
    rows = rows.withColumn("_said", own)
    crop = lambda c: F.when(F.col("_said.decision") == "accept_crop", F.coalesce(c, F.lit(""))).otherwise("").alias(c)
    return rows.select(identity, "source", "_said.decision", "_said.reason", F.coalesce("manual_override", F.lit("")).alias("manual_override"), crop("cropped_path"), crop("cropped_sha256"))


def report(decisions: DataFrame, dimension: str = "source") -> DataFrame:
    """Of each source: input, accepted, cropped, review, excluded, accepted_fraction."""
    n = lambda *d: F.count_if(F.col("decision").isin(*d))
    counts = decisions.groupBy(dimension).agg(F.count("*").alias("input"), n(*KEPT).alias("accepted"), n("accept_crop").alias("cropped"), n("review").alias("review"), n("exclude").alias("excluded"))
    return counts.withColumn("accepted_fraction", F.round(F.col("accepted") / F.col("input"), 6))


def quality_gate(plan: DataFrame, metrics: DataFrame, detections: DataFrame, overrides: DataFrame, strict: list[str], limits: dict[str, float], required: list[str] | None = None, identity: str = "record_id") -> Gate:
    """The rows of ``plan`` that pass, with cropped files in place of their own, and those that don't, with the reason; nothing is deleted.

    ``required`` sources (all, if not given) must have an accepted row, and those that are named must be in ``plan``; else an error.
    """
    decisions = cut(decide(plan, metrics, detections, overrides, strict, limits, identity))
    told = decisions.select(identity, F.col("decision").alias("_decision"), F.col("reason").alias("_reason"), F.col("cropped_path").alias("_path"), F.col("cropped_sha256").alias("_sha"))
    both = plan.join(told, identity)
    kept = F.col("_decision").isin(*KEPT)
    cropped = lambda c, new: F.when(F.col("_path") != "", F.col(new)).otherwise(F.col(c))
    marked = both.withColumns({
        "local_path": cropped("local_path", "_path"), "image_sha256": cropped("image_sha256", "_sha"), "eligible_supervised": kept,
        "exclusion_reason": F.when(kept, "").otherwise(F.concat(F.lit("quality:"), "_reason")),
    })
    names = dict.fromkeys([*plan.columns, "local_path", "image_sha256", "eligible_supervised", "exclusion_reason"])
    by_source = cut(report(decisions))
    rows = {r["source"]: r["accepted"] for r in by_source.collect()}  # a row a source
    wanted = list(rows) if required is None else required
    if lacking := [s for s in wanted if not rows.get(s)]:
        raise ValueError(f"no accepted row of {', '.join(map(str, lacking))}")
    return Gate(marked.filter(kept).select(*names), marked.filter(~kept).select(*names), decisions, by_source, decisions.groupBy("reason").agg(F.count("*").alias("n")))
