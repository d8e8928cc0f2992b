"""Benchmark decontamination with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from speclake.llm.common import BROADCAST_ROWS, ascii_lower, cut, sized

#: Words are runs of digits, letters A-Z, a-z and characters beyond ASCII; these are between them.
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]++"


def words(text: Column) -> Column:
    return F.coalesce(F.transform(F.array_remove(F.split(text, BETWEEN), ""), ascii_lower), F.array().cast("array<string>"))


def _sketch(words: Column | str, start: Column, width: Column) -> Column:
    """A hash of a window's first, middle and last word."""
    middle = F.floor(width / 2).cast("int")
    return F.xxhash64(F.get(words, start), F.get(words, start + middle), F.get(words, start + width - 1))


def item_windows(benchmark: DataFrame, width: int) -> DataFrame:
    """(win, length, h, items): each distinct window of the items, its sketch and the ids of the items that hold it, as strings."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), F.explode(F.array(words(F.col("text")))).alias("words")).filter(F.size("words") > 0)
    length = F.least(F.size("words"), F.lit(width))
    parts = items.select("item", F.explode(F.transform(F.sequence(F.lit(1), F.size("words") - length + 1), lambda i: F.slice("words", i, length))).alias("part"))
    return parts.groupBy("part").agg(F.collect_set("item").alias("items")).select(F.array_join("part", " ").alias("win"), F.size("part").alias("length"), _sketch("part", F.lit(0), F.size("part")).alias("h"), "items")


def _hash_set(windows: DataFrame) -> tuple[Column, int]:
    """The windows' sketches as a set of slots, a byte each in one binary value, and the number of slots: 32 a window, 2**20 (1 MB) at most.

    It only spares the scan from handing on windows that can't match; whatever passes is verified.
    """
    slots = 1 << max(12, min(20, (32 * windows.count()).bit_length()))
    held = bytearray(slots)
    for row in windows.select(F.pmod("h", F.lit(slots)).alias("slot")).distinct().collect():  # as many rows as slots at most
        held[row["slot"]] = 1
    return F.lit(bytes(held)), slots


def _spots(width: int, held: Column, slots: int) -> Column:
    """The windows of ``width`` in words (n of them) whose sketch is in the set: array of (start, end, win)."""
    starts = F.when(F.col("n") >= width, F.sequence(F.lit(0), F.col("n") - width)).otherwise(F.array().cast("array<int>"))
    slot = lambda i: F.pmod(_sketch("words", i, F.lit(width)), F.lit(slots)).cast("int")
    at = F.filter(starts, lambda i: F.substr(held, slot(i) + 1, F.lit(1)) == F.lit(b"\x01"))
    return F.transform(at, lambda i: F.struct(i.alias("start"), (i + width).alias("end"), F.array_join(F.slice("words", i + 1, width), " ").alias("win")))


def find_contamination(docs: DataFrame, benchmark: DataFrame, width: int = 10, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Per row of ``docs`` the words that lie inside any occurrence of a benchmark window.

    ``docs``: doc_id, text; ``benchmark``: item_id, text. A window is ``width`` consecutive words of an
    item; an item of fewer words, but not none, is one window. The scan tests each text window against
    a bounded hash set and hands on those in it; an exact join on the window's text verifies them
    (broadcast up to ``broadcast_rows`` windows, else shuffled), and the spans are merged per row.

    Returns doc_id, n_words, n_hit, n_items, items (array of ids as strings), spans (array of
    (start, end) in words from 0, end exclusive, as found, sorted). Null or empty texts have no words;
    repeated rows stay rows of their own; empty tables on either side give no hits; null item ids count
    as no item; ids may be null.
    """
    windows = cut(item_windows(benchmark, width))
    lengths = sorted(r[0] for r in windows.select("length").distinct().collect())
    # The explode of one element keeps the optimizer from putting the word split into the lambdas below, where it would run once a window.
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.explode(F.array(words(F.col("text")))).alias("words"))
    rows = rows.withColumn("n", F.size("words"))
    found: list[Column] = []
    if lengths:
        held, slots = _hash_set(windows)
        found = [_spots(k, held, slots) for k in lengths]
    spots = F.concat(*found) if found else F.array().cast("array<struct<start:int,end:int,win:string>>")
    spots = rows.select("row", "doc_id", "n", F.explode_outer(spots).alias("spot"))
    spots = spots.select("row", "doc_id", "n", "spot.start", "spot.end", F.coalesce("spot.win", F.concat(F.lit("\t"), F.col("row") % 1000)).alias("win"))
    hits = spots.join(sized(windows.select("win", "items"), broadcast_rows), "win", "left")
    span = F.when(F.col("items").isNotNull(), F.struct("start", "end"))
    found = hits.groupBy("row", "doc_id", "n").agg(F.array_sort(F.collect_list(span)).alias("spans"), F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"))
    zero = F.struct(F.lit(0).alias("last"), F.lit(0).alias("n"))
    step = lambda a, s: F.struct(F.greatest(a["last"], s["end"]).alias("last"), (a["n"] + F.greatest(F.lit(0), s["end"] - F.greatest(a["last"], s["start"]))).alias("n"))
    return found.select(
        "doc_id",
        F.col("n").cast("long").alias("n_words"),
        F.aggregate("spans", zero, step)["n"].cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.array_sort("items").alias("items"),
        "spans",
    )


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, width: int = 10) -> DataFrame:
    """``docs`` without the rows that hold a benchmark window; columns as given.

    Columns of any name stay. Rows are told apart by id and text, so rows that share an id are judged each on its own. The keys
    of contaminated rows are counted and broadcast if few, else joined by shuffle.
    """
    key = F.xxhash64("doc_id", F.md5("text"))
    flagged = find_contamination(docs.select(F.struct("doc_id", key.alias("key")).alias("doc_id"), "text"), benchmark, width)
    bad = cut(flagged.filter("n_hit > 0").select(F.col("doc_id.doc_id").alias("bad_id"), F.col("doc_id.key").alias("bad_key")).distinct())
    bad = sized(bad)
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["bad_id"]) & (F.xxhash64(docs["doc_id"], F.md5(docs["text"])) == bad["bad_key"]), "left_anti")
