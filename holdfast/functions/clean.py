"""Cleaning of raw customer columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Java's parser accepts a trailing type letter ("1d", "2f"), which is not a number here.
_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def to_number(col: Column, dtype: str = "double") -> Column:
    """Text to number; blank or malformed text gives NULL."""
    text = col.cast("string")
    return F.when(text.rlike(_NUMBER), F.trim(text)).try_cast(dtype)


def to_number_or_zero(col: Column, dtype: str = "double") -> Column:
    return F.coalesce(to_number(col, dtype), F.lit(0).cast(dtype))


def label_strict(col: Column) -> Column:
    """1 for exactly 'Yes', 0 for anything else, NULL included."""
    return F.when(col == "Yes", 1).otherwise(0)


def label_lenient(col: Column) -> Column:
    """1 for yes / 1 / true in any case and with blanks around, else 0."""
    text = F.lower(F.trim(col.cast("string")))
    return F.when(text.isin("yes", "1", "true"), 1).otherwise(0)


def observed_months(tenure: Column) -> Column:
    """Tenure as an observation time: accounts of month 0 count as half a month."""
    t = tenure.cast("double")
    return F.when(t == 0, F.lit(0.5)).otherwise(t)
