"""Operators over manifest rows: caching, archives, top-ups, quotas, cohorts, nested documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from speclake.functions import documents
from speclake.functions import scalars as S
from speclake.operators.sampling import lowest

#: The least probability at which a rank is accepted, broad ranks first.
ACCEPTED_FROM = {"family": 0.40, "genus": 0.50, "species": 0.65}


def grade_in(value: Column, grades: list[str]) -> Column:
    """Whether a quality grade is wanted, spaces and underscores alike; no grades want all."""
    return F.lower(F.replace(S.clean(value), F.lit("_"), F.lit(" "))).isin(*[g.lower().replace("_", " ") for g in grades]) if grades else F.lit(True)


def selection_eligible(df: DataFrame, order: str, identity: str, splits: list[str], ranks: list[str], scope: DataFrame | None = None) -> DataFrame:
    """The rows that a selection may take: of an order, with an id, in one of ``splits``, named at each of ``ranks``, of a family in ``scope`` (family) if that is given. Case doesn't matter."""
    named = [S.clean(F.col(c)) != "" for c in (identity, *ranks)]
    rows = df.filter((F.lower(S.clean(F.col("order"))) == order.lower()) & F.lower(S.clean(F.col("split"))).isin(*splits))
    for holds in named:
        rows = rows.filter(holds)
    if scope is None:
        return rows
    families = scope.select(F.lower(S.clean(F.col("family"))).alias("_family")).distinct()
    return rows.join(families, F.lower(S.clean(F.col("family"))) == F.col("_family"), "left_semi")


def plan_eligible(df: DataFrame, bucket: str = "bucket", scope: DataFrame | None = None) -> DataFrame:
    """The rows that a training plan may take: eligible, in a sampling bucket, with an image's place, of a family in ``scope`` (family) if that is given."""
    placed = (S.clean(F.col("image_url")) != "") | (S.clean(F.col("local_path")) != "")
    rows = df.filter(S.as_bool(F.col("eligible_supervised")) & (F.coalesce(bucket, F.lit("")) != "") & placed)
    if scope is None:
        return rows
    families = scope.select(F.lower("family").alias("_family")).distinct()
    return rows.join(families, F.lower("family") == F.col("_family"), "left_semi")


def cache_status(plan: DataFrame, listing: DataFrame, results: DataFrame, identity: str = "record_id") -> DataFrame:
    """``plan`` with local_path, eligible_supervised and exclusion_reason after a download: licence, file, location and result decide in this order.

    ``listing`` (identity, local_path) holds the files that are there, ``results`` (identity, error) what was fetched, '' for success.
    """
    there = listing.select(identity, F.col("local_path").alias("_path"))
    joined = plan.join(there, identity, "left").join(results.select(identity, F.col("error").alias("_error")), identity, "left")
    reason = (
        F.when(~F.col("image_license").isin(*S.OPEN_LICENSES), F.concat(F.lit("license:"), "image_license"))
        .when(F.col("_path").isNotNull(), "")
        .when(F.coalesce("image_url", F.lit("")) == "", "missing_image_location")
        .when(F.col("_error") != "", F.concat(F.lit("download_error:"), "_error"))
        .when(F.col("_error").isNull(), "not_fetched")
        .otherwise("")
    )
    return joined.withColumns({"local_path": F.coalesce("_path", F.lit("")), "exclusion_reason": reason, "eligible_supervised": reason == ""}).drop("_path", "_error")


def segments(path: Column) -> Column:
    """A path's parts: backslashes are slashes, empty and '.' parts are left out."""
    return F.filter(F.split(F.replace(path, F.lit("\\"), F.lit("/")), "/"), lambda p: (p != "") & (p != "."))


def match_archive(selection: DataFrame, listing: DataFrame, member: str, path: str) -> DataFrame:
    """``selection`` with ``path``, the first path that ends in its member's whole segments, however many.

    A path's ends become keys, but only those with as many segments as some member of its base name has; so this is an
    equi-join, no pair of equal base names is made, and a path has at most as many keys as its name has lengths.
    """
    wanted = selection.select(member, segments(F.col(member)).alias("_m")).filter(F.size("_m") > 0)
    lengths = wanted.select(F.element_at("_m", -1).alias("_base"), F.size("_m").alias("_n")).distinct()
    paths = listing.select(F.col(path).alias("_path"), segments(F.col(path)).alias("_p")).filter(F.size("_p") > 0).withColumn("_base", F.element_at("_p", -1))
    ends = paths.join(lengths, "_base").filter(F.size("_p") >= F.col("_n")).select(F.array_join(F.slice("_p", -F.col("_n"), F.col("_n")), "/").alias("_end"), "_path")
    keys = ends.groupBy("_end").agg(F.min("_path").alias(path))
    return selection.join(keys, F.array_join(segments(selection[member]), "/") == keys["_end"], "left").drop("_end")


def accepted_rank(probabilities: dict[str, Column], rejected: Column | None = None) -> Column:
    """The deepest rank reached before the first that fails its threshold or is ``rejected`` (a rank's name, null for none), else null."""
    said, passed = F.lit(None).cast("string"), F.lit(True)
    for rank, least in ACCEPTED_FROM.items():
        passed = passed & (F.coalesce(probabilities[rank], F.lit(0.0)) >= least)
        if rejected is not None:
            passed = passed & ~F.coalesce(rejected == rank, F.lit(False))
        said = F.when(passed, rank).otherwise(said)
    return said


def tiles(width: Column, height: Column, grid: int) -> Column:
    """Boxes of a grid over an image, edges rounded half to even, row by row."""
    cell = lambda at, size: F.bround(at * size / grid).cast("long")
    row, column = (lambda k: F.floor(k / grid)), (lambda k: k % grid)
    return F.transform(F.sequence(F.lit(0), F.lit(grid * grid - 1)), lambda k: F.struct(
        k.alias("tile"), cell(column(k), width).alias("x1"), cell(row(k), height).alias("y1"), cell(column(k) + 1, width).alias("x2"), cell(row(k) + 1, height).alias("y2")))


def digest_of(columns: list[str]) -> Column:
    """An aggregate that the order of rows doesn't change: of each row's SHA-256 the eight 32-bit parts, xored, and their sums modulo 2**32, in hex."""
    row = F.sha2(F.concat_ws("\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]), 256)
    parts = [F.conv(F.substring(row, 1 + 8 * k, 8), 16, 10).cast("long") for k in range(8)]
    mixed = [F.coalesce(F.bit_xor(p), F.lit(0)) for p in parts] + [F.coalesce(F.sum(p), F.lit(0)) % (1 << 32) for p in parts]
    return F.concat(*[F.lower(F.lpad(F.hex(m.cast("long")), 8, "0")) for m in mixed]).alias("digest")


def fingerprint(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row (n, digest): the number of rows and their ``digest_of``."""
    return df.agg(F.count("*").alias("n"), digest_of(columns))


def topup(rows: DataFrame, base: DataFrame, family: str, identity: str, minimum: int, seed: int) -> DataFrame:
    """Up to ``minimum`` rows a family, those in ``base`` (identity) first, then others, each by seeded score; in_base tells which."""
    marked = rows.join(base.select(identity).distinct().withColumn("_in", F.lit(True)), identity, "left").withColumn("in_base", F.coalesce("_in", F.lit(False))).drop("_in")
    return lowest(marked, [family], minimum, seed, identity, "in_base")


def topup_report(chosen: DataFrame, requested: DataFrame, family: str, minimum: int) -> DataFrame:
    """Of each requested family: target, from_base, new, total, shortfall."""
    counts = chosen.groupBy(family).agg(F.count_if("in_base").alias("from_base"), F.count_if(~F.col("in_base")).alias("new"))
    n = lambda c: F.coalesce(c, F.lit(0))
    return requested.join(counts, family, "left").select(
        family, F.lit(minimum).alias("target"), n("from_base").alias("from_base"), n("new").alias("new"), (n("from_base") + n("new")).alias("total"), (minimum - n("from_base") - n("new")).alias("shortfall"))


def even_quotas(families: DataFrame, family: str, limit: int) -> DataFrame:
    """``limit`` dealt evenly to the families (a row each), the remainder to the first by name."""
    nth = F.row_number().over(Window.orderBy(family)) - 1  # a row a family
    n = families.count()
    return families.select(family, (F.lit(limit // max(n, 1)) + (nth < limit % max(n, 1)).cast("int")).alias("quota"))


def running_grants(parts: DataFrame, name: str, wanted: str, budget: int) -> DataFrame:
    """One budget round: parts in order get what they want until the budget is used up. ``parts`` has a row a stratum."""
    before = F.coalesce(F.sum(wanted).over(Window.orderBy(name).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return parts.withColumn("granted", F.greatest(F.lit(0), F.least(F.col(wanted), F.lit(budget) - before)))


def with_picked(df: DataFrame, document: str, names: list[str], target: str) -> DataFrame:
    """``df`` with ``target``: the first scalar with text, in document order, whose key ends in one of ``names``, at any depth; '' if there is none."""
    return df.withColumn(target, documents.first_named(document, *names))


def first_seen_values(df: DataFrame, keys: str, values: str) -> DataFrame:
    """``df`` with the array ``values`` in order, each once without regard to case, blank ones gone; rows with none are left out. Each row's values are sorted in the row, without a shuffle."""
    marked = F.filter(F.transform(values, lambda x, i: F.struct(F.lower(x).alias("low"), i.alias("at"), x.alias("x"))), lambda s: F.trim(s["x"]) != "")
    # The explode of one element keeps the sort out of the lambda below, where it would run once a value.
    rows = df.select(keys, F.explode(F.array(F.array_sort(marked))).alias("_s"))
    first = F.filter("_s", lambda s, i: (i == 0) | (F.get("_s", i - 1)["low"] != s["low"]))
    return rows.select(keys, F.transform(F.array_sort(F.transform(first, lambda s: F.struct(s["at"].alias("at"), s["x"].alias("x")))), lambda s: s["x"]).alias(values)).filter(F.size(values) > 0)
