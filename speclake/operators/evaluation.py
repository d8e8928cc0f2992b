"""Audits, frozen cohorts, accuracy and guards over corpora and predictions."""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from speclake.functions import scalars as S
from speclake.operators import learning, records
from speclake.sources.shared import cut

#: The dimensions of an audit and the manifest's columns behind them.
DIMENSIONS = {"source": "source", "license": "image_license", "quality": "label_quality", "basis": "basis_of_record"}
#: Columns that may hold a row's group, the first that is there counts.
GROUPS = ("split_group", "duplicate_group_id", "specimen_group_id", "record_id")
ARCHIVE_GROUPS = ("train", "eval", "pretrain")


def counts_by(df: DataFrame, dimensions: dict[str, Column]) -> DataFrame:
    """(dimension, value, n) of several dimensions in one pass; a row is expanded to one for each of them before counts are summed up."""
    each = F.array(*[F.struct(F.lit(d).alias("dimension"), F.coalesce(F.nullif(c.cast("string"), F.lit("")), F.lit("UNKNOWN")).alias("value")) for d, c in dimensions.items()])
    return df.select(F.explode(each).alias("x")).groupBy("x.dimension", "x.value").agg(F.count("*").alias("n"))


def audit(master: DataFrame) -> DataFrame:
    """(dimension, value, n): rows, eligible, preserved, with DNA, numbers of families, genera and species, and counts by source, licence, quality and basis."""
    have = lambda *names: reduce(lambda a, b: a | b, [S.clean(F.col(c)) != "" for c in names])
    totals = {
        "rows": F.count("*"), "eligible_supervised": F.count_if(S.as_bool(F.col("eligible_supervised"))), "preserved_specimens": F.count_if(S.as_bool(F.col("is_preserved_specimen"))), "with_dna_or_bin": F.count_if(have("dna_barcode", "dna_bin")),
    } | {f"unique_{name}": F.count_distinct(F.nullif(S.clean(F.col(rank)), F.lit(""))) for name, rank in (("families", "family"), ("genera", "genus"), ("species", "species"))}
    one = master.agg(*[t.alias(k) for k, t in totals.items()])
    wide = one.select(F.explode(F.array(*[F.struct(F.lit("total").alias("dimension"), F.lit(k).alias("value"), F.col(k).alias("n")) for k in totals])).alias("x")).select("x.*")
    return wide.unionByName(counts_by(master, {d: F.col(c) for d, c in DIMENSIONS.items()}))


def missing_sources(audited: DataFrame, required: list[str]) -> list[str]:
    there = {r[0] for r in audited.filter((F.col("dimension") == "source") & F.col("value").isin(*required)).select("value").collect()}
    return [s for s in required if s not in there]


def write_report(report: DataFrame, path: str, title: str) -> DataFrame:
    """Writes a report (a row a line, so small) as JSON lines in ``path``/json and as a Markdown table in ``path``/markdown, each one file; returns the table's lines in order."""
    spark, names = report.sparkSession, report.columns
    report.coalesce(1).write.mode("overwrite").json(f"{path}/json")
    rows = spark.read.schema(report.schema).json(f"{path}/json").orderBy(*names).collect()
    numbers = {f.name for f in report.schema if f.dataType.typeName() in ("integer", "long", "double")}
    said = [f"# {title}", "", f"| {' | '.join(names)} |", f"| {' | '.join('---:' if n in numbers else '---' for n in names)} |"]
    said += ["| " + " | ".join(f"{v:,}" if isinstance(v, int) else "" if v is None else str(v) for v in r) + " |" for r in rows]
    lines = spark.createDataFrame(list(enumerate(said)), "at int, line string")
    lines.coalesce(1).sortWithinPartitions("at").select("line").write.mode("overwrite").text(f"{path}/markdown")
    return lines


def freeze(master: DataFrame, identity: str = "record_id") -> DataFrame:
    """The validation and test rows; an error where a split is unknown, a group is in several splits, or none is left."""
    group = next((g for g in GROUPS if g in master.columns), None)
    if group is None or not {"split", "source", "family"} <= set(master.columns):
        raise ValueError("split, source, family and a group are needed")
    if not master.filter(~F.coalesce(F.col("split").isin("train", "val", "test"), F.lit(False))).isEmpty():
        raise ValueError("unknown split")
    key = F.coalesce(F.nullif(F.col(group).cast("string"), F.lit("")), F.concat(F.lit("record:"), F.col(identity).cast("string")))
    if not leaks(master.withColumn("_group", key), "_group").isEmpty():
        raise ValueError("a group is in several splits")
    cohort = master.filter(F.col("split").isin("val", "test"))
    if cohort.isEmpty():
        raise ValueError("no validation or test rows")
    return cohort


def leaks(df: DataFrame, group: str, split: str = "split") -> DataFrame:
    """(group): groups whose rows are in several splits; smallest and largest split are told apart before the shuffle."""
    return df.groupBy(group).agg(F.min(split).alias("lo"), F.max(split).alias("hi")).filter("lo != hi").select(group)


def keep_frozen(cohort: DataFrame, frozen: DataFrame | None, identity: str = "record_id") -> DataFrame:
    """``cohort``, unless another one is frozen already: then an error. The order of rows doesn't matter."""
    names = sorted(set(cohort.columns) & set(frozen.columns)) if frozen is not None else [identity]
    if frozen is not None and (set(cohort.columns) != set(frozen.columns) or records.fingerprint(cohort, names).first() != records.fingerprint(frozen, names).first()):
        raise ValueError("a different cohort is frozen")
    return cohort


def accuracy(truth: DataFrame, ranked: DataFrame, identity: str, label: str, dimensions: list[str]) -> DataFrame:
    """(dimension, value, n, top1, top5) over ``truth`` (identity, label, dimensions) of guesses (identity, guess, nth): overall as ('all', '') and by each dimension, in one pass."""
    place = ranked.select(identity, F.col("guess").alias("_guess"), "nth")
    hit = truth.join(place, (truth[identity] == place[identity]) & (truth[label].cast("string") == F.col("_guess")), "left").select(*[truth[c] for c in dict.fromkeys([label, *dimensions])], "nth")
    each = F.array(F.struct(F.lit("all").alias("dimension"), F.lit("").alias("value")), *[F.struct(F.lit(c).alias("dimension"), F.col(c).cast("string").alias("value")) for c in dimensions])
    rows = hit.select(F.explode(each).alias("x"), "nth").select("x.*", "nth")
    return rows.groupBy("dimension", "value").agg(F.count("*").alias("n"), F.count_if(F.col("nth") == 1).alias("top1"), F.count_if(F.col("nth") <= 5).alias("top5"))


class Evaluation(NamedTuple):
    """What ``evaluate`` found: metrics and confusions by head, means by rank, and the cohort's digest."""

    metrics: DataFrame
    confusions: DataFrame
    means: DataFrame
    digest: str


def evaluate(df: DataFrame, heads: DataFrame, k: int = 5, pairs: int = 50, identity: str = "record_id", vector: str = "embedding") -> Evaluation:
    """Heads on the validation and test rows of ``df`` (identity, source, split, ranks, label_quality, embedding, maybe source_split), each asked at the row's true parent.

    ``metrics``: (rank, parent, dimension, value, n, top1, top5, rate1, rate5) over all rows of a head, by source, split and
    source split, blank ones apart. ``confusions``: (rank, parent, truth, predicted, n, nth), the ``pairs`` most frequent errors of
    a head, of equal ones by name. ``means``: (rank, dimension, value, n, rate1, rate5), weighted by rows over a rank's heads. Rows of
    classes that no head knows don't count. ``digest`` is that of the rows' ids, splits and names, whatever their order.
    """
    rows = df.filter(F.col("split").isin("val", "test"))
    asked = cut(learning.at_true_heads(rows, heads, k, identity, vector))
    place = F.get(F.filter("candidates", lambda c: c["taxon"] == F.col("taxon")), 0)["nth"]
    first = F.get("candidates", 0)["taxon"]
    kinds = [c for c in ("source", "split", "source_split") if c in asked.columns]
    each = [F.struct(F.lit("all").alias("dimension"), F.lit("").alias("value")), *[F.when(F.coalesce(c, F.lit("")) != "", F.struct(F.lit(c).alias("dimension"), F.col(c).alias("value"))) for c in kinds]]
    spread = asked.select("rank", "parent", F.explode(F.filter(F.array(*each), lambda x: x.isNotNull())).alias("x"), place.alias("nth")).select("rank", "parent", "x.*", "nth")
    hits = [F.count("*").alias("n"), F.count_if(F.col("nth") == 1).alias("top1"), F.count_if(F.col("nth") <= 5).alias("top5")]
    rates = {f"rate{i}": F.round(F.col(f"top{i}") / F.col("n"), 6) for i in (1, 5)}
    metrics = cut(spread.groupBy("rank", "parent", "dimension", "value").agg(*hits).withColumns(rates))
    means = metrics.groupBy("rank", "dimension", "value").agg(*[F.sum(c).alias(c) for c in ("n", "top1", "top5")]).withColumns(rates).drop("top1", "top5")
    wrong = asked.select("rank", "parent", F.col("taxon").alias("truth"), first.alias("predicted")).filter("truth <> predicted").groupBy("rank", "parent", "truth", "predicted").agg(F.count("*").alias("n"))
    nth = F.row_number().over(Window.partitionBy("rank", "parent").orderBy(F.desc("n"), "truth", "predicted"))
    confusions = wrong.withColumn("nth", nth).filter(F.col("nth") <= pairs)
    digest = records.fingerprint(rows, [identity, "split", *learning.RANKS]).first()["digest"]
    return Evaluation(metrics, confusions, means, digest)


def compare(reports: dict[str, tuple[str, DataFrame]]) -> DataFrame:
    """(model, dimension, value, n, top1, top5, rate1, rate5) of several models' ``accuracy``, each with its cohort's digest, which must be one."""
    digests = {digest for digest, _ in reports.values()}
    if len(digests) != 1 or not all(digests):
        raise ValueError("the reports are not of one cohort")
    rate = lambda c: F.round(F.col(c) / F.col("n"), 6)
    named = [r.select(F.lit(model).alias("model"), "*").withColumns({"rate1": rate("top1"), "rate5": rate("top5")}) for model, (_, r) in reports.items()]
    return reduce(DataFrame.unionByName, named)


def topup_problems(selection: DataFrame, families: list[str], minimum: int) -> DataFrame:
    """(problem, subject): what is wrong with a saved top-up selection (processid, family, archive_group, archive_member)."""
    say = lambda rows, problem, subject: rows.select(F.lit(problem).alias("problem"), subject.cast("string").alias("subject"))
    t = selection.select(*[S.clean(F.col(c)).alias(c) for c in ("processid", "family", "archive_group", "archive_member")])
    wanted = t.sparkSession.createDataFrame([(f.lower(),) for f in dict.fromkeys(families)], "family string")
    n = t.groupBy(F.lower("family").alias("family")).agg(F.count("*").alias("n"))
    quotas = wanted.withColumn("wanted", F.lit(True)).join(n, "family", "full")
    repeated = t.filter("processid != ''").groupBy("processid").agg(F.count("*").alias("n")).filter("n > 1")
    return reduce(DataFrame.unionByName, [
        say(t.filter("processid = ''"), "blank_id", F.col("archive_member")),
        say(repeated, "repeated_id", F.col("processid")),
        say(t.filter(~F.col("archive_group").isin(*ARCHIVE_GROUPS) | (F.col("archive_member") == "")), "archive_location", F.col("processid")),
        say(quotas.filter("wanted IS NULL"), "family_out_of_scope", F.col("family")),
        say(quotas.filter(F.col("wanted") & (F.coalesce("n", F.lit(0)) < minimum)), "shortfall", F.col("family")),
    ])


def setting_conflicts(shards: DataFrame, shard: str, settings: list[str]) -> DataFrame:
    """(setting, least, most): settings that differ between shards, or between a run and the one it resumes. Missing counts as a value."""
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("setting"), F.coalesce(F.col(c).cast("string"), F.lit("")).alias("value")) for c in settings]))
    return shards.select(shard, each.alias("x")).groupBy("x.setting").agg(F.min("x.value").alias("least"), F.max("x.value").alias("most")).filter("least != most")


def gate_problems(report: DataFrame, manifest: DataFrame, shards: DataFrame, shard_size: int, identity: str = "record_id") -> DataFrame:
    """(problem, expected, found) where a gate's report (accepted_rows), its manifest and the index of shards (shard_id, rows, of the manifest) disagree; all are whole-table counts."""
    rows, ids = (F.count("*").alias("rows"), F.count_distinct(identity).alias("ids"))
    m = manifest.agg(rows, ids)
    s = shards.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("sharded"), F.count("*").alias("shards"), F.coalesce(F.max("rows"), F.lit(0)).alias("largest"), F.count_distinct("shard_id").alias("names"))
    both = report.select(F.col("accepted_rows").cast("long").alias("accepted")).join(F.broadcast(m)).join(F.broadcast(s))  # one row each
    checks = (
        ("manifest_rows", "accepted", "rows"), ("repeated_ids", "rows", "ids"), ("sharded_rows", "rows", "sharded"), ("repeated_shards", "shards", "names"),
    )
    found = [F.struct(F.lit(p).alias("problem"), F.col(a).alias("expected"), F.col(b).alias("found")) for p, a, b in checks] + [F.struct(F.lit("shard_too_large").alias("problem"), F.lit(shard_size).cast("long").alias("expected"), F.col("largest").alias("found"))]
    x = both.select(F.explode(F.array(*found)).alias("x")).select("x.*")
    return x.filter(F.when(F.col("problem") == "shard_too_large", F.col("found") > F.col("expected")).otherwise(F.col("found") != F.col("expected")))


def quota_problems(available: DataFrame, requested: dict[str, int], total: int) -> DataFrame:
    """(problem, subject, requested, available): targets that aren't positive, that don't add up to ``total``, or that a source (source, available) can't meet."""
    wanted = available.sparkSession.createDataFrame([(s, n) for s, n in requested.items()], "subject string, requested long")
    both = wanted.join(available.select(F.col("source").alias("subject"), "available"), "subject", "left").withColumn("available", F.coalesce("available", F.lit(0)).cast("long"))
    short = both.select(F.when(F.col("requested") <= 0, "not_positive").when(F.col("available") < F.col("requested"), "shortfall").alias("problem"), "subject", "requested", "available").filter("problem IS NOT NULL")
    sums = wanted.agg(F.coalesce(F.sum("requested"), F.lit(0)).alias("requested")).filter(F.col("requested") != total).select(F.lit("total").alias("problem"), F.lit("").alias("subject"), "requested", F.lit(total).cast("long").alias("available"))
    return short.unionByName(sums)
