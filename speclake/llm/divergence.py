"""Source divergence audit: how far the term distributions of a language's sources lie apart, by count-level bitmaps."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from speclake.llm.common import cut, sized

#: Bytes to bytes: letters A-Z in lower case, all other ASCII but a-z as a blank.
LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
SCALE = 10**9
PAIR_ROWS = "lang string, source string, item string, value long"


def term_counts(docs: DataFrame, flush: int = 300_000) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents of each term by group, summed up in tasks as far as ``flush`` entries go; a term may have several rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        entries = 0

        def tables() -> Iterator[pa.RecordBatch]:
            for (lang, source), (n, within) in seen.items():
                terms = list(n)
                columns = [*[pa.array([x] * len(terms), pa.string()) for x in (lang, source)], pa.array(terms, pa.string()), pa.array(n.values(), pa.int64()), pa.array(map(within.__getitem__, terms), pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["lang", "source", "term", "n", "docs"])

        for batch in batches:
            for lang, source, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                n, within = seen.setdefault((lang, source), (Counter(), Counter()))
                words = text.as_py().translate(LETTERS).split()
                entries -= len(n)
                n.update(words)
                within.update(set(words))
                entries += len(n)
                if entries >= flush:
                    yield from tables()
                    seen.clear()
                    entries = 0
        yield from tables()

    rows = docs.select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source")], F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    return rows.mapInArrow(run, "lang string, source string, term string, n long, docs long")


def kept_terms(docs: DataFrame, least: int) -> DataFrame:
    """(lang, term, n, cells): the terms in ``least`` documents of a language at least, with their count in each source as cells (source, n). One shuffle."""
    dealt = term_counts(docs).repartition("lang", "term")
    cells = dealt.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    terms = cells.groupBy("lang", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"), F.collect_list(F.struct("source", "n")).alias("cells"))
    return terms.filter(F.col("docs") >= least).select("lang", "term", "n", "cells")


def levels(counts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(values, bits): the counts above zero that occur among a block's terms, and for each the bitmap of the terms that have it, in 64-bit words."""
    values, level = np.unique(counts, return_inverse=True)
    marks = np.zeros((len(values), min(width, -(-len(counts) // 64) * 64)), bool)
    marks[level, np.arange(len(counts))] = True
    bits = np.packbits(marks, axis=1, bitorder="little").view(np.uint64)
    return (values[1:], bits[1:]) if values[0] == 0 else (values, bits)


def probability(counts: np.ndarray, n: int, v: int) -> np.ndarray:
    """1 + floor(10**9 (count + 1) / (n + v)), in integers of any length where 64 bits don't do."""
    if int(counts.max(initial=0)) < 2**63 // SCALE - 1:
        return 1 + SCALE * (counts + 1) // (n + v)
    return np.array([1 + SCALE * (int(c) + 1) // (n + v) for c in counts], np.int64)


def distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // q


def _blocks(most: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of terms ordered by falling count: 64 terms where counts are high, so many levels, up to 2**16 where they are low."""
    at = 0
    while at < len(most):
        width = 64 * max(1, min(1024, (1 << 12) // max(1, int(most[at]))))
        yield at, width
        at += width


def pair_sums(counts: np.ndarray, n: list[int], v: int) -> np.ndarray:
    """sums[g, h]: the distance of group g from h, summed over all terms of ``counts`` (group, term).

    For each two levels of a pair AND and popcount tell in how many terms they meet; a level's other terms are those
    where the other group has none, and what is then left are terms that neither has.
    """
    counts = counts[:, np.argsort(-counts.max(axis=0, initial=0), kind="stable")]
    sums = np.zeros((len(counts), len(counts)), np.int64)
    zero = [probability(np.zeros(1, np.int64), x, v) for x in n]
    for at, width in _blocks(counts.max(axis=0, initial=0)):
        part = counts[:, at : at + width]
        made = [levels(row, width) for row in part]
        p = [np.concatenate([probability(values, x, v), z]) for (values, _), x, z in zip(made, n, zero, strict=True)]
        sizes = [np.bitwise_count(bits).sum(axis=1, dtype=np.int64) for _, bits in made]
        for g, (_, a) in enumerate(made):
            for h in range(g + 1, len(made)):
                b = made[h][1]
                cells = np.zeros((len(a) + 1, len(b) + 1), np.int64)
                if len(a) and len(b):
                    cells[:-1, :-1] = np.bitwise_count(a[:, None, :] & b[None, :, :]).sum(axis=2, dtype=np.int64)
                cells[:-1, -1] = sizes[g] - cells[:-1, :-1].sum(axis=1)
                cells[-1, :-1] = sizes[h] - cells[:-1, :-1].sum(axis=0)
                cells[-1, -1] = part.shape[1] - cells.sum()
                sums[g, h] += (cells * distance(p[g][:, None], p[h][None, :])).sum()
                sums[h, g] += (cells * distance(p[h][None, :], p[g][:, None])).sum()
    return sums


def _sum_part(terms: pa.Table, groups: pa.Table) -> pa.Table:
    """The sums of a language's pairs over the terms of one part."""
    order = groups.sort_by("source")
    sources, n, v = order["source"].to_pylist(), order["total"].to_pylist(), order["v"][0].as_py()
    counts = np.zeros((len(sources), terms.num_rows), np.int64)
    if terms.num_rows:
        cells = terms["cells"].combine_chunks()
        flat = cells.flatten()
        at = pc.index_in(flat.field("source"), value_set=pa.array(sources, pa.string())).to_numpy(zero_copy_only=False)
        counts[at, pc.list_parent_indices(cells).to_numpy()] = flat.field("n").to_numpy()
    sums = pair_sums(counts, n, v)
    g, h = np.nonzero(~np.eye(len(sources), dtype=bool))
    names = pa.array(sources, pa.string())
    return pa.table({"lang": pa.array([order["lang"][0].as_py()] * len(g), pa.string()), "source": names.take(pa.array(g)), "item": names.take(pa.array(h)), "value": pa.array(sums[g, h], pa.int64())})


def _p(count: Column | str, total: str) -> Column:
    """``probability`` as a Column; 10**9 times a count may need more than 64 bits."""
    scaled = (F.col(count) if isinstance(count, str) else count).cast("decimal(19,0)") + F.lit(1)
    return F.lit(1) + F.call_function("div", (scaled * F.lit(SCALE)).cast("decimal(38,0)"), (F.col(total) + F.col("v")).cast("decimal(20,0)"))


def audit_sources(docs: DataFrame, least: int = 3, top: int = 200, part_terms: int = 16_384) -> DataFrame:
    """(lang, source, part, item, value, rank): for each (lang, source) group of ``docs`` (text, lang, source) its distance from each other source of the language, and the ``top`` terms that it has more often than the language.

    A language keeps the terms in ``least`` of its rows at least; v of them with n occurrences in all give a term that
    occurs count times p = 1 + floor(10**9 (count + 1) / (n + v)); the distance of p from q is floor((p - q)**2 / q). Part
    'pair': value is the distance summed over all kept terms, from each other source. Part 'term': the kept terms of the
    group with p above the language's, by their distance from it. Ranks by falling value, then item.

    A language's terms are dealt to parts of about ``part_terms`` by hash; each adds up its pairs by bitmaps, so no task holds
    a whole language. The result has a row for each pair of a language's sources; their number is the only one that no part divides.
    Null texts, languages and sources are ''; repeated rows count each; groups without terms, and languages without
    kept terms, have pairs (of value 0 without kept terms); an empty table gives an empty result; other columns are ignored.
    """
    docs = docs.select("text", "lang", "source")
    kept = cut(kept_terms(docs, least))
    within = kept.groupBy("lang").agg(F.sum("n").alias("whole"), F.count("*").alias("v"))
    sums = kept.select("lang", F.explode("cells").alias("c")).groupBy("lang", "c.source").agg(F.sum("c.n").alias("total"))
    named = docs.select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source")]).distinct()
    groups = named.join(sums, ["lang", "source"], "left").join(within, "lang", "left").na.fill(0, ["total", "whole", "v"])
    groups = sized(cut(groups.withColumn("parts", F.ceil((F.col("v") + 1) / part_terms).cast("int"))))

    parts = groups.select("lang", "parts").distinct()
    dealt = kept.join(parts, "lang").select("lang", F.pmod(F.xxhash64("term"), F.col("parts")).cast("int").alias("part"), "cells")
    each = groups.select("lang", "source", "total", "v", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    pairs = dealt.groupBy("lang", "part").cogroup(each.groupBy("lang", "part")).applyInArrow(_sum_part, PAIR_ROWS).groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))

    cells = kept.select("lang", F.col("term").alias("item"), F.col("n").alias("all"), F.explode("cells").alias("c")).select("lang", "item", "all", "c.source", "c.n")
    terms = cells.join(groups.select("lang", "source", "total", "whole", "v"), ["lang", "source"]).withColumns({"p": _p("n", "total"), "q": _p("all", "whole")}).filter("p > q")
    terms = terms.select("lang", "source", "item", F.call_function("div", (F.col("p") - F.col("q")) * (F.col("p") - F.col("q")), F.col("q")).alias("value"))
    ranked = lambda df, part: df.withColumns({"part": F.lit(part), "rank": F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))})
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return ranked(pairs, "pair").select(columns).unionByName(ranked(terms, "term").filter(F.col("rank") <= top).select(columns))
