"""Kaplan-Meier retention curves per stratum."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.functions.clean import observed_months
from holdfast.operators.scan import running_totals

# A survival of exactly one half must count as reached whatever the last bit says.
_HALF = 0.5 + 1e-12


def _curve(df: DataFrame, stratum: str, duration: str, event: str) -> DataFrame:
    """Points of the curves, unrounded: the start (0, 1) and every event time.

    Rows collapse to one per stratum and distinct time before any ordering.
    """
    t = observed_months(F.col(duration))
    times = (
        df.where(F.col(stratum).isNotNull() & F.col(duration).isNotNull())
        .groupBy(F.col(stratum).alias("stratum"), t.alias("t"))
        .agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(event) == 1).alias("d"))
    )
    # Running from the longest duration down gives the number still at risk.
    # The total of d is read as well, so that both sides of the scan need the same
    # columns and Spark shuffles the table once for the two of them.
    at_risk = running_totals(
        times, ["t"], None, {"n": "sum", "d": "sum"}, keys=["stratum"], descending=True, keep_cell="cell"
    ).where(F.col("all_d") >= 0)
    none = F.lit(0).cast("bigint")

    def point(t: Column, d: Column, keep: Column) -> Column:
        return F.struct(t.alias("t"), F.col("cum_n").alias("n_at_risk"), d.alias("d"), keep.alias("keep"))

    # The shortest duration has everyone at risk; it also yields the start of its curve.
    start = F.when(F.col("cum_n") == F.col("all_n"), point(F.lit(0.0), none, F.lit(1.0)))
    step = F.when(F.col("d") > 0, point(F.col("t"), F.col("d"), 1 - F.col("d") / F.col("cum_n")))
    # The start lies before all times of its cell, so the cells of the first scan serve the second.
    points = at_risk.select(
        "stratum", "cell", F.explode(F.array_compact(F.array(start, step))).alias("p")
    ).select("stratum", "cell", "p.*")
    return running_totals(
        points, ["t"], F.col("cell"), {"keep": "product"}, keys=["stratum"]
    ).select("stratum", "t", "n_at_risk", "d", F.col("cum_keep").alias("survival"))


def km_curve(df: DataFrame, stratum: str, duration: str, event: str) -> DataFrame:
    """(stratum, t, n_at_risk, d, survival), starting at (0, 1) in each stratum."""
    return _curve(df, stratum, duration, event).withColumn("survival", F.round("survival", 6))


def km_median(df: DataFrame, stratum: str, duration: str, event: str) -> DataFrame:
    """(stratum, n, median): the first time survival is at most one half, NULL if never."""
    return (
        _curve(df, stratum, duration, event)
        .groupBy("stratum")
        .agg(F.max("n_at_risk").alias("n"),
             F.min(F.when(F.col("survival") <= _HALF, F.col("t"))).alias("median"))
        .orderBy("stratum")
    )
