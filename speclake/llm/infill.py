"""Fill-in-middle transformation: texts cut at line ends by one repeated-capture match."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A line with its end, or the rest of the text. The regex library keeps each repetition of the group.
LINES = r"([^\n]*+\n|[^\n]++)*+"
PREFIX, SUFFIX, MIDDLE = MARKS = ("<P>", "<S>", "<M>")


def draws(seed: int, doc_id: int | None) -> list[int]:
    """Four unsigned 32-bit numbers from the hash of ``seed:doc_id``; a null id is the empty text."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[k : k + 8], 16) for k in range(0, 32, 8)]


def infill(text: str, drawn: list[int], units: regex.Pattern, rate: int, spm: int) -> tuple[int, str, str, int | None, int | None]:
    """(n, form, output, prefix length, middle length) of a text; lengths are null where it stays plain."""
    ends = [0, *units.fullmatch(text).ends(1)]
    n = len(ends) - 1
    if not text or drawn[2] % 100 >= rate or any(m in text for m in MARKS):
        return n, "plain", text, None, None
    a, b = sorted(ends[h % (n + 1)] for h in drawn[:2])
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if drawn[3] % 100 < spm:
        return n, "spm", f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}", a, b - a
    return n, "psm", f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}", a, b - a


def restored(output: Column, form: Column) -> Column:
    """The text that ``fill_in_middle`` was given, rebuilt from its output and form.

    A part ends where the next mark first occurs: no part holds a mark, and none can arise across a border, as marks hold '<' at their start only.
    """
    after = lambda text, part: F.substring(text, F.length(part) + len(PREFIX) + 1, F.length(text))
    rest = F.substring(output, F.lit(len(PREFIX) + 1), F.length(output))
    first = F.when(form == "psm", F.substring_index(rest, SUFFIX, 1)).otherwise(F.substring_index(rest, PREFIX, 1))
    behind = after(rest, first)
    second = F.substring_index(behind, MIDDLE, 1)
    middle = after(behind, second)
    return F.when(form == "plain", output).when(form == "psm", F.concat(first, middle, second)).otherwise(F.concat(second, middle, first))


def fill_in_middle(docs: DataFrame, seed: int = 7, rate: int = 100, spm: int = 50, unit: str = LINES) -> DataFrame:
    """``docs`` (doc_id, text) to (doc_id, n, form, prefix_chars, middle_chars, output): each text as prefix, suffix and middle behind marks.

    ``unit`` is a repeated group that matches any text; its n repetitions are the units, between which both cuts are
    drawn by ``seed`` and doc_id. ``rate`` of 100 texts are changed, ``spm`` of 100 of these with the suffix first. Texts that are
    empty, null (taken as empty) or hold a mark stay plain, with null lengths. Rows of equal id are cut at equal draws;
    repeated rows stay; a null id draws as an empty one; other columns are ignored; an empty table gives an empty result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = regex.compile(unit)
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                ids, texts = (batch.column(i)[k : k + 256] for i in (0, 1))
                made = [infill(t.as_py() or "", draws(seed, i), units, rate, spm) for i, t in zip(ids.to_pylist(), texts, strict=True)]
                n, form, output, prefix, middle = map(list, zip(*made, strict=True))
                yield pa.RecordBatch.from_arrays([ids, pa.array(n, pa.int64()), pa.array(form), pa.array(prefix, pa.int64()), pa.array(middle, pa.int64()), pa.array(output, pa.string())], names)

    names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string")
