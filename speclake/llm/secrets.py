"""Secret scans with multipart credential linking, by DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from speclake.llm.common import cut

ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
#: Weak parts, which mean nothing alone.
IDENTIFIER = r"""(?<![A-Za-z0-9])(?i:user(?:name)?|login|account|client_?id|access_?key(?:_?id)?)["']?\x20*[:=]\x20*["']?[A-Za-z0-9._@-]{3,}"""
SECRET = r"(?<![A-Za-z0-9+/=_-])[A-Za-z0-9+/]{20,}={0,2}(?![A-Za-z0-9+/=_-])"
ENDPOINT = r"""https?://[^\s"'<>]+"""
BREAK = r"\n[\x20\t]*\n"
#: (kind, pattern, role, is it reported by itself). A run of 18 or more characters of ACCESS, or 16 of HEX, is the whole run either way.
KINDS = (
    ("assign", ASSIGN, "secret", True),
    ("access", ACCESS, "identifier", True),
    ("hex", HEX, "secret", True),
    ("identifier", IDENTIFIER, "identifier", False),
    ("secret", SECRET, "secret", False),
    ("endpoint", ENDPOINT, "endpoint", False),
    ("break", BREAK, "break", False),
)


def _holds(kind: str, match: Column) -> Column:
    if kind == "assign":
        return F.length(F.regexp_extract(match, ASSIGN, 2)) >= 12
    if kind == "secret":  # letters of either case and a digit
        return match.rlike("[a-z]") & match.rlike("[A-Z]") & match.rlike("[0-9]")
    return F.lit(True)


def find_parts(docs: DataFrame) -> DataFrame:
    """(row, doc_id, rank, kind, role, base, start, end): all parts of each text, in code points, end exclusive, and a row of nulls for the text itself.

    Where a pattern's k-th match begins follows from the lengths of the k matches before and of the
    k + 1 gaps that splitting by the pattern leaves.
    """
    text = F.coalesce("text", F.lit(""))
    found = [F.when(text.rlike(p), F.struct(F.regexp_extract_all(text, F.lit(p), F.lit(0)).alias("m"), F.split(text, p, -1).alias("gaps"))).alias(kind) for kind, p, _, _ in KINDS]
    # The explode of one element keeps the optimizer from moving the splits into the lambda, where they would run once a match.
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.explode(F.array(F.struct(*found))).alias("found"))

    def listed(rank: int, kind: str) -> Column:
        gaps = F.col(f"found.{kind}.gaps")
        part = lambda m, i: F.struct(F.lit(rank).alias("rank"), i.alias("at"), F.length(F.get(gaps, i)).alias("gap"), F.length(m).alias("size"), _holds(kind, m).alias("holds"))
        return F.coalesce(F.transform(f"found.{kind}.m", part), F.array().cast("array<struct<rank:int,at:int,gap:int,size:int,holds:boolean>>"))

    itself = F.array(F.lit(None).cast("struct<rank:int,at:int,gap:int,size:int,holds:boolean>"))
    parts = rows.select("row", "doc_id", F.explode(F.concat(itself, *[listed(i, k[0]) for i, k in enumerate(KINDS)])).alias("part")).select("row", "doc_id", "part.*")
    end = F.sum(F.col("gap") + F.col("size")).over(Window.partitionBy("row", "rank").orderBy("at"))
    names, roles = (F.array(*[F.lit(k[j]) for k in KINDS]) for j in (0, 2))
    base = F.array(*[F.lit(k[3]) for k in KINDS])
    placed = parts.withColumn("end", end).filter(F.col("rank").isNull() | F.col("holds"))
    return placed.select("row", "doc_id", "rank", F.get(names, "rank").alias("kind"), F.get(roles, "rank").alias("role"), F.get(base, "rank").alias("base"), (F.col("end") - F.col("size")).alias("start"), "end")


def link_weak(parts: DataFrame, reach: int) -> DataFrame:
    """The weak parts that complementary ones stand by: same text, same section between blank lines, starts at most ``reach`` apart, no character in both.

    An identifier needs a secret, a secret an identifier, an endpoint one of each that belong together. The
    interval join bins starts by ``reach`` and looks into the own bin and its two neighbours; matches of
    a kind don't overlap, so a bin holds at most about ``reach`` / 8 parts of each, however long the text.
    """
    order = Window.partitionBy("row").orderBy("start", "rank").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    scoped = parts.filter("rank is not null").withColumn("scope", F.sum((F.col("role") == "break").cast("int")).over(order)).filter("role != 'break'")
    scoped = cut(scoped.withColumn("bin", F.floor(F.col("start") / reach)))
    span = ["rank", "kind", "base", "start", "end"]

    def beside(asked: DataFrame, others: DataFrame) -> DataFrame:
        """Each row of ``asked`` with each of ``others`` in reach of it, as a struct ``other``."""
        around = asked.withColumn("bin", F.explode(F.array(F.col("bin") - 1, F.col("bin"), F.col("bin") + 1)))
        both = around.join(others.select("row", "scope", "bin", F.struct("role", *span).alias("other")), ["row", "scope", "bin"])
        apart = (F.col("other.start") >= F.col("end")) | (F.col("other.end") <= F.col("start"))
        return both.filter((F.abs(F.col("other.start") - F.col("start")) <= reach) & apart)

    linked = cut(beside(scoped.filter("role = 'identifier'"), scoped.filter("role = 'secret'")))
    ends = linked.select("row", "doc_id", "scope", "role", *span).unionByName(linked.select("row", "doc_id", "scope", "other.*"))
    ends = ends.distinct().withColumn("bin", F.floor(F.col("start") / reach))
    met = beside(scoped.filter("role = 'endpoint'"), ends).groupBy("row", "doc_id", *span).agg(F.collect_set("other.role").alias("roles")).filter(F.size("roles") == 2)
    found = ends.select("row", "doc_id", *span).unionByName(met.select("row", "doc_id", *span))
    return found.filter(~F.col("base")).select("row", "doc_id", "rank", "kind", "start", "end")


def scan_secrets(docs: DataFrame, reach: int = 200) -> DataFrame:
    """Secrets of every whole text: ``docs`` (doc_id, text) to (doc_id, found), found an array of (start, rank, kind, end, base) in order.

    Base spans of a kind are its leftmost non-overlapping matches of the required length: ``assign``,
    ``access`` and ``hex``. To them come the weak parts of ``link_weak``: identifiers, bare secrets and
    endpoints; a span is never its own complement. Null texts are empty; repeated rows stay; an empty table gives an empty result.
    """
    parts = cut(find_parts(docs))
    columns = ["row", "doc_id", "start", "rank", "kind", "end"]
    reported = parts.filter(F.coalesce("base", F.col("rank").isNull())).select(*columns, F.lit(True).alias("base"))
    linked = link_weak(parts, reach).select(*columns, F.lit(False).alias("base"))
    span = F.when(F.col("rank").isNotNull(), F.struct("start", "rank", "kind", "end", "base"))
    return reported.unionByName(linked).groupBy("row", "doc_id").agg(F.array_sort(F.collect_list(span)).alias("found")).drop("row")
