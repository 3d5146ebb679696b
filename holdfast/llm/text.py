"""Shared text rules: words, ASCII case, and the columns that every operator reads.

An operator selects its identifier and text at once under its own names, so further columns of the input, whatever
they are called, never clash with what it computes.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Words between ASCII white space, and words of letters and digits (any byte above ASCII counts as a letter).
SPACED = r"[^\x20\x09-\x0D]+"
LETTERED = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: The same two rules for UTF-8 bytes that are already in lower case.
LETTERED_BYTES = re.compile(rb"[a-z0-9\x80-\xff]+")


def ascii_lower(c: Column) -> Column:
    """A-Z to a-z, other letters untouched."""
    return F.translate(c, UPPER, LOWER)


def words(c: Column, pattern: str = SPACED) -> Column:
    """Array of words; NULL counts as empty."""
    return F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(pattern), F.lit(0))


def total_bytes(df: DataFrame, text: str) -> int:
    """UTF-8 bytes of a text column: one small aggregation."""
    return df.agg(F.sum(F.octet_length(F.col(text)))).first()[0] or 0


def cores(spark: SparkSession) -> int:
    return max(2, spark.sparkContext.defaultParallelism)
