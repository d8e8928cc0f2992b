"""Mixing sources to target weights by subset-sum budget fitting."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from speclake.llm.common import WORD, cut

WEIGHTS = (3, 1, 2)


def source_targets(totals: DataFrame, weights: tuple[int, ...], budget: float, limit: int) -> DataFrame:
    """Shares ``budget`` times all words among the sources by weight.

    ``totals`` has a row per source (source, source_size). Weights repeat over the sources in
    code-point order, null last. No target exceeds ``limit`` times its source; what is above is
    shared again by weight until nothing is above: a level is sought at which the capped targets
    add up to the budget. The windows here see one row per source.
    """
    everything = Window.partitionBy()
    order = Window.orderBy(F.col("source").asc_nulls_last())
    by_ratio = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)), F.col("nth") % len(weights) + 1)
    ranked = (
        totals.withColumn("nth", F.row_number().over(order) - 1)
        .withColumn("weight", weight.cast("double"))
        .withColumn("roof", F.col("source_size") * float(limit))
        .withColumn("ratio", F.col("roof") / F.col("weight"))
        .withColumn("budget", F.sum("source_size").over(everything) * budget)
    )
    level = (F.col("budget") - F.coalesce(F.sum("roof").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))) / F.sum("weight").over(
        by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    )
    leveled = ranked.withColumn("level", level).withColumn("at", F.row_number().over(by_ratio))
    first = F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("at", "level"))).over(everything)
    return leveled.select("source", "source_size", F.least("roof", F.coalesce(first["level"] * F.col("weight"), F.col("roof"))).alias("target"))


def fill_budget(lengths: list[int], counts: list[int], budget: int, window: int) -> list[int]:
    """How many documents of each length to take so that their words come as near ``budget`` from below as can be found.

    Each length first gives its proportional part, then the longest lengths that fit bring the rest
    down to about ``window`` words, and a bounded-knapsack dynamic programme over a bit set of sums
    (each length split into binary multiples) fills these.
    """
    total = sum(n * c for n, c in zip(lengths, counts, strict=True))
    taken = [c * budget // total if total and n else 0 for n, c in zip(lengths, counts, strict=True)]
    rest = budget - sum(n * k for n, k in zip(lengths, taken, strict=True))
    down = sorted((i for i, n in enumerate(lengths) if n), key=lambda i: -lengths[i])
    for i in down:
        more = min(counts[i] - taken[i], max(0, rest - window) // lengths[i])
        taken[i] += more
        rest -= more * lengths[i]
    sums, full, steps = 1, (1 << (rest + 1)) - 1, []
    for i in down:
        left, part = min(counts[i] - taken[i], rest // lengths[i]), 1
        while left and not sums >> rest & 1:
            part = min(part, left)
            steps.append((i, part, sums))
            sums = (sums | sums << lengths[i] * part) & full
            left -= part
            part *= 2
    at = sums.bit_length() - 1
    for i, part, before in reversed(steps):
        if not before >> at & 1:
            taken[i] += part
            at -= part * lengths[i]
    return taken


def mix_sources(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, budget: float = 1.5, limit: int = 2, seed: int = 42, window: int = 1 << 14, buckets: int = 256, bucket_rows: int = 1 << 16) -> DataFrame:
    """Draws documents so that each source's words meet its target.

    ``docs``: doc_id, text, source. The size of a document is its number of words (null or empty
    text: 0). Targets: see ``source_targets``. A source's target is met by whole passes over it and,
    for the remaining budget, by documents chosen per exact length (``fill_budget``); within a length
    the documents with the smallest seeded hash are chosen. Documents are counted by (source, length,
    hash bucket), so what one source's fit sees is its histogram: at most sqrt(2 x words) lengths.
    Within a length the choice runs in each hash bucket on its own. There are ``buckets`` of them, or one for
    each ``bucket_rows`` documents where that is more, so a bucket of one source and length stays bounded
    however many documents are alike.

    Returns doc_id, size, source_size, target, taken (words taken, repeats counted). Repeated rows
    are drawn one by one; ties between them change no value. A null source is a source of its own.
    Null ids are allowed. An empty table gives an empty result.
    """
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    measured = cut(docs.select("doc_id", "source", size.alias("size")))
    bucket = F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(max(buckets, -(-measured.count() // bucket_rows)))).cast("int")
    rows = measured.withColumn("bucket", bucket)
    counts = cut(rows.groupBy("source", "size", "bucket").agg(F.count("*").alias("n")))
    totals = counts.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    targets = cut(source_targets(totals, weights, budget, limit))

    def fit(key: tuple, lengths: pd.DataFrame) -> pd.DataFrame:
        lengths = lengths.sort_values("size")
        all_words, goal = int(lengths["source_size"].iloc[0]), float(lengths["target"].iloc[0])
        passes = min(int(goal // all_words), limit) if all_words else 0
        rest = 0 if passes == limit else min(all_words, round(goal - passes * all_words))
        chosen = fill_budget(lengths["size"].tolist(), lengths["n"].tolist(), rest, window)
        return lengths[["source", "size"]].assign(passes=passes, chosen=chosen)

    histogram = counts.groupBy("source", "size").agg(F.sum("n").alias("n"))
    fitted = (
        histogram.join(F.broadcast(targets) if targets.count() <= 100_000 else targets, histogram["source"].eqNullSafe(targets["source"]))
        .drop(targets["source"])
        .groupBy("source")
        .applyInPandas(fit, "source string, size long, passes int, chosen long")
    )
    before = Window.partitionBy("source", "size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    same = lambda a, b, *names: [a[x].eqNullSafe(b[x]) for x in names]
    lower = counts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    quota = lower.join(fitted, same(lower, fitted, "source", "size")).select(
        lower["source"], lower["size"], "bucket", "passes", F.least("n", F.greatest(F.lit(0), F.col("chosen") - F.col("before"))).alias("quota")
    )
    nth = Window.partitionBy(rows["source"], rows["size"], rows["bucket"]).orderBy(F.xxhash64(F.lit(seed), rows["doc_id"]), rows["doc_id"])
    drawn = rows.join(quota, same(rows, quota, "source", "size", "bucket")).withColumn("nth", F.row_number().over(nth))
    drawn = drawn.select(rows["doc_id"], rows["source"], rows["size"], "passes", (F.col("nth") <= F.col("quota")).cast("long").alias("extra"))
    small = F.broadcast(targets) if targets.count() <= 100_000 else targets
    return drawn.join(small, drawn["source"].eqNullSafe(targets["source"])).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * (F.col("passes") + F.col("extra"))).alias("taken")
    )
