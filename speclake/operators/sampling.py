"""Deterministic, balanced selection."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from speclake.functions import scalars as S
from speclake.sources.shared import cut, sized

#: Rows of a stratum up to which each task keeps the lowest itself.
FEW = 1000


def granted(limits: list[int], weigh, total: int) -> list[int]:
    """Rounds of floored shares, at least 1, clipped by free capacity and by what is left; ``weigh(free, i)`` is a part's weight."""
    given, left = [0] * len(limits), min(total, sum(limits))
    while left > 0:
        active = [i for i, n in enumerate(limits) if given[i] < n]
        weights = [weigh(limits[i] - given[i], i) for i in active]
        spread, whole = left, sum(weights)
        for i, w in zip(active, weights, strict=True):
            more = min(max(1, math.floor(spread * w / whole)), limits[i] - given[i], left)
            given[i], left = given[i] + more, left - more
    return given


def allocate(strata: DataFrame, total: str, taxon: str, available: str, cap: int) -> DataFrame:
    """Square-root budgets of each source's taxa: ``strata`` has source, taxon, available and its source's total."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(taxon)
        limits = [min(n, cap) for n in rows[available].tolist()]
        return rows.assign(budget=granted(limits, lambda free, _: math.sqrt(free), int(rows[total].iloc[0])))

    return strata.groupBy("source").applyInPandas(run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in strata.schema) + ", budget long")


def lowest(df: DataFrame, strata: list[str], limit: int | str, seed: int, identity: str, ahead: str | None = None, digits: int = 4) -> DataFrame:
    """The rows with the lowest seeded scores of each stratum, those where ``ahead`` holds first: ``limit`` is a number or a column of the stratum's own.

    A number of at most ``FEW`` filters before the shuffle: each task keeps so many rows of a stratum. Else counts by the first ``digits``
    hex digits of the score tell in which range the budget ends: rows of lower ranges are taken as they are, and only those of that range,
    one of 16**digits, are ordered. So no task sorts a stratum, however large it and its budget are. A null stratum is one like any other; a null limit takes none.
    """
    first = F.lit("") if ahead is None else F.when(F.col(ahead), "0").otherwise("1")
    score = F.concat(first, S.score(F.col(identity).cast("string"), seed))
    if isinstance(limit, int) and limit <= FEW:
        nth = F.row_number().over(Window.partitionBy(*strata).orderBy(score, identity))
        return df.withColumn("_nth", nth).filter(F.col("_nth") <= limit).drop("_nth")
    rows = df.withColumns({"_score": score, "_limit": F.lit(limit) if isinstance(limit, int) else F.col(limit)})
    rows = rows.withColumn("_range", F.substring("_score", 1, digits + (ahead is not None)))
    counts = rows.groupBy(*strata, "_range").agg(F.count("*").alias("_n"), F.greatest(F.lit(0), F.coalesce(F.max("_limit"), F.lit(0))).alias("_limit"))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy(*strata).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ends = counts.withColumn("_left", F.col("_limit") - before).filter((F.col("_left") >= 0) & (F.col("_left") < F.col("_n")))  # a row a stratum at most
    ends = sized(cut(ends.select(*[F.col(c).alias(f"_s{i}") for i, c in enumerate(strata)], F.col("_range").alias("_end"), "_left")))
    on = [F.col(c).eqNullSafe(F.col(f"_s{i}")) for i, c in enumerate(strata)]
    near = rows.join(ends, on, "left").filter(F.col("_end").isNull() | (F.col("_range") <= F.col("_end")))
    whole = near.filter(F.col("_end").isNull() | (F.col("_range") < F.col("_end")))
    nth = F.row_number().over(Window.partitionBy(*strata).orderBy("_score", identity))
    last = near.filter(F.col("_range") == F.col("_end")).withColumn("_nth", nth).filter(F.col("_nth") <= F.col("_left"))
    return whole.select(*df.columns).unionAll(last.select(*df.columns))


def plan(df: DataFrame, requested: dict[str, int], total: int, cap: int, seed: int, identity: str = "record_id", bucket: str = "bucket") -> DataFrame:
    """The training plan: sources share ``total`` by request, their taxa by square roots under ``cap``; 0 keeps every row of a requested source."""
    eligible = df.filter(F.col("source").isin(*requested))
    if total == 0:
        return eligible
    strata = eligible.groupBy("source", bucket).agg(F.count("*").alias("available"))
    dealt = budgets(strata, requested, total, cap, bucket)
    return lowest(eligible.join(dealt.select("source", bucket, "budget"), ["source", bucket]), ["source", bucket], "budget", seed, identity).drop("budget")


def budgets(strata: DataFrame, requested: dict[str, int], total: int, cap: int, bucket: str) -> DataFrame:
    """``strata`` (source, bucket, available) with ``budget``: sources share ``total`` by request, their taxa by square roots under ``cap``."""
    there = {r[0]: r[1] for r in strata.groupBy("source").agg(F.sum("available")).collect()}  # one row a requested source
    names = [s for s in requested if there.get(s)]
    shares = dict(zip(names, granted([there[s] for s in names], lambda _, i: max(requested[names[i]], 1), total), strict=True))
    share = F.create_map(*[F.lit(x) for pair in shares.items() for x in pair]) if shares else F.create_map()
    return allocate(strata.withColumn("share", share[F.col("source")].cast("long")), "share", bucket, "available", cap)


def select_balanced(df: DataFrame, targets: dict[str, int], total: int, cap: int, seed: int, identity: str = "processid", split: str = "split") -> DataFrame:
    """Eligible rows (see ``records.selection_eligible``) balanced over official splits and taxa, with their place in the archive.

    Splits share ``total`` by ``targets``, the taxa of a split by square roots under ``cap``; of each taxon the
    rows with the lowest seeded scores. A taxon is the species, else genus, else family. Two passes: one
    counts, one selects. Adds bucket, archive_group and archive_member (needs chunk).
    """
    rank, taxon = S.taxon_bucket(F.col("species"), F.col("genus"), F.col("family"))
    rows = df.withColumns({"bucket": F.when(rank != "", F.concat(rank, F.lit(":"), taxon)).otherwise(""), split: F.lower(F.trim(split))}).filter("bucket != ''")
    chosen = plan(rows.withColumn("_source", F.col("source") if "source" in df.columns else F.lit("")).withColumn("source", F.col(split)), targets, total, cap, seed, identity)
    restored = chosen.withColumn("source", F.col("_source")) if "source" in df.columns else chosen.drop("source")
    return restored.select(*df.columns, "bucket").withColumns({"archive_group": S.archive_group(F.col(split)), "archive_member": S.archive_member(F.col(split), F.coalesce("chunk", F.lit("")), F.col(identity))})


def pilot(df: DataFrame, taxon: str, least: int, per_source: int, per_taxon: int, seed: int, identity: str) -> DataFrame:
    """Of taxa with ``least`` rows at most ``per_source`` of each source, then ``per_taxon`` in all."""
    kinds = df.groupBy(taxon).agg(F.count("*").alias("_n")).filter(F.col("_n") >= least).select(F.col(taxon).alias("_taxon"))
    common = df.join(kinds, F.col(taxon) == F.col("_taxon"), "left_semi")
    return lowest(lowest(common, [taxon, "source"], per_source, seed, identity), [taxon], per_taxon, seed, identity)


def group_order(df: DataFrame, group: str, parts: int = 256) -> DataFrame:
    """(group, size, at): all groups numbered from 0, large ones first, of equal size by hash.

    A group's number is its place among groups of its size and hash range, plus how many come before that
    range; so neither one task nor one window holds all groups of a size, and only counts a range are ordered.
    """
    digest = F.coalesce(F.sha2(F.col(group).cast("string"), 256), F.lit(""))  # a null is a group, too
    part = F.coalesce(F.floor(F.conv(F.substring(F.nullif(digest, F.lit("")), 1, 4), 16, 10).cast("int") * parts / 65536).cast("int"), F.lit(0))
    groups = df.groupBy(group).agg(F.count("*").alias("size")).withColumn("part", part).withColumn("digest", digest)
    ranges = groups.groupBy("size", "part").agg(F.count("*").alias("n"))
    # One row a size, whose counts by range are summed up in an array; the sizes themselves are few.
    sizes = ranges.groupBy("size").agg(F.sum("n").alias("n"))
    above = sizes.select("size", F.coalesce(F.sum("n").over(Window.orderBy(F.desc("size")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("above"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("size").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = ranges.select("size", "part", before.alias("before")).join(above, "size").select("size", "part", (F.col("before") + F.col("above")).alias("first"))
    nth = F.row_number().over(Window.partitionBy("size", "part").orderBy("digest")) - 1
    return groups.withColumn("nth", nth).join(offsets, ["size", "part"]).select(group, "size", (F.col("nth") + F.col("first")).alias("at"))


def packed(sizes: list[tuple[int, int]], shards: int) -> list[list[tuple[int, int]]]:
    """For each (size, count of groups) of falling size the (shard, groups) that greedy packing deals out, each group in turn to the emptiest shard, the first of equal ones.

    Groups of one size fill the shards like water: all places below a level are taken, then those at it by number. So the
    work grows with distinct sizes and shards, not with groups.
    """
    loads, numbers, dealt = np.zeros(shards, np.int64), np.arange(shards), []
    for size, count in sizes:
        low, high = int(loads.min()), int(loads.min()) + size * (count // shards + 2) + int(loads.max() - loads.min())
        while low < high:  # the highest level below which at most ``count`` places are
            level = (low + high + 1) // 2
            if int(np.maximum(0, -((loads - level) // size)).sum()) <= count:
                low = level
            else:
                high = level - 1
        n = np.maximum(0, -((loads - low) // size))
        at = numbers[(loads <= low) & ((low - loads) % size == 0)][: count - int(n.sum())]
        n[at] += 1
        loads += n * size
        dealt.append([(int(i), int(n[i])) for i in np.nonzero(n)[0]])
    return dealt


def assign_shards(df: DataFrame, group: str, shard_size: int, width: int = 64) -> DataFrame:
    """shard_id for each row: groups stay whole; large ones first, each goes to the shard with the fewest rows (``packed``), of a size by hash, shards in order.

    The packing needs only how many groups have which size; it comes out as ranges of ``group_order``'s numbers, a row for each shard and size at most,
    which are joined in pieces of ``width`` numbers. Null groups are one group.
    """
    spark = df.sparkSession
    ordered = cut(group_order(df, group))
    sizes = [(r["size"], r["n"]) for r in ordered.groupBy("size").agg(F.count("*").alias("n")).orderBy(F.desc("size")).collect()]
    rows, n = sum(s * k for s, k in sizes), sum(k for _, k in sizes)
    shards = max(1, min(n, -(-rows // shard_size)))
    ranges, at = [], 0
    for part in packed(sizes, shards):
        for shard, k in part:
            ranges.append((at, at + k, shard))
            at += k
    if not ranges:
        return df.withColumn("shard_id", F.lit(None).cast("int"))
    table = spark.createDataFrame(pd.DataFrame(ranges, columns=["_first", "_stop", "shard_id"]), "_first long, _stop long, shard_id int")
    pieces = sized(table.withColumn("_piece", F.explode(F.sequence(F.floor(F.col("_first") / width), F.floor((F.col("_stop") - 1) / width)))))
    placed = ordered.select(F.col(group).alias("_group"), "at", F.floor(F.col("at") / width).alias("_piece"))
    dealt = placed.join(pieces, "_piece").filter((F.col("at") >= F.col("_first")) & (F.col("at") < F.col("_stop"))).select("_group", "shard_id")
    return df.join(dealt, F.col(group).eqNullSafe(F.col("_group"))).drop("_group")


def shard_index(df: DataFrame, group: str, shard: str = "shard_id", identity: str = "record_id") -> DataFrame:
    """(shard, rows, groups, digest) of each shard; the digest is that of its ids in any order."""
    from speclake.operators.records import digest_of

    return df.groupBy(shard).agg(F.count("*").alias("rows"), F.count_distinct(F.coalesce(F.col(group).cast("string"), F.lit(""))).alias("groups"), digest_of([identity]))
