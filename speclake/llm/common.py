"""Helpers that several training-data operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from speclake.sources.shared import BROADCAST_ROWS, cut, shuffles_freed, sized

__all__ = ["BROADCAST_ROWS", "UPPER", "WORD", "ascii_lower", "cut", "shuffles_freed", "sized", "table"]

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: The six ASCII white-space characters that end a word.
WORD = r"[^\x20\x09-\x0D]++"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z only; every other character stays. lower() is fast and right for text of ASCII alone."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))
