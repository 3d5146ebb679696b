"""Exact quality measures of a score against a 0/1 label.

The table first collapses to one row per distinct score; ranking measures then
need only running totals over those (see ``scan``).  Work is cut at quantiles of the scores, or at
ascending ``bounds`` that a caller knows; neither changes the result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.functions.exact import cents, div_half_up, hundredths, mean_money, money
from holdfast.functions.rules import DECISION_THRESHOLD, decision_flag
from holdfast.operators.scan import bounded_cells, running_totals


def _ranked(df: DataFrame, score: str, label: str, bounds: Sequence[float] | None = None) -> DataFrame:
    """(s, pos, neg, cum_pos, cum_neg, all_pos, all_neg): totals from the top score down."""
    groups = (
        df.where(F.col(score).isNotNull() & F.col(label).isNotNull())
        .groupBy(F.col(score).cast("double").alias("s"))
        .agg(F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) != 1).alias("neg"))
    )
    cell = None if bounds is None else bounded_cells(F.col("s"), bounds)
    return running_totals(groups, ["s"], cell, {"pos": "sum", "neg": "sum"}, descending=True)


def _ratio(num: Column, den: Column) -> Column:
    return num / F.when(den != 0, den)


def _roc_auc(digits: int) -> Column:
    pos, neg = F.max("all_pos").cast("double"), F.max("all_neg").cast("double")
    lost = F.sum(F.col("pos").cast("double") * (F.col("cum_neg") - F.col("neg") / 2))
    return F.round(1 - _ratio(lost, pos * neg), digits).alias("roc_auc")


def _avg_precision(digits: int) -> Column:
    at = F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))
    area = _ratio(F.sum(F.col("pos") * at), F.max("all_pos"))
    return F.round(F.coalesce(area, F.lit(0.0)), digits).alias("avg_precision")


def roc_auc(
    df: DataFrame, score: str, label: str, digits: int = 8, bounds: Sequence[float] | None = None
) -> DataFrame:
    """One row: area under the ROC curve, tied pairs counting one half; NULL for one class."""
    return _ranked(df, score, label, bounds).agg(_roc_auc(digits))


def roc_auc_by(df: DataFrame, key: str, score: str, label: str, digits: int = 8) -> DataFrame:
    """(key, roc_auc): the exact area for each value of ``key``, all from one scan."""
    groups = (
        df.where(F.col(score).isNotNull() & F.col(label).isNotNull())
        .groupBy(F.col(key).alias("key"), F.col(score).cast("double").alias("s"))
        .agg(F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) != 1).alias("neg"))
    )
    ranked = running_totals(groups, ["s"], None, {"pos": "sum", "neg": "sum"}, keys=["key"], descending=True)
    return ranked.groupBy("key").agg(_roc_auc(digits)).withColumnRenamed("key", key)


def avg_precision(
    df: DataFrame, score: str, label: str, digits: int = 8, bounds: Sequence[float] | None = None
) -> DataFrame:
    """One row: sum of precision times the step in recall (no trapezoids); 0 without positives."""
    return _ranked(df, score, label, bounds).agg(_avg_precision(digits))


def ranking_quality(
    df: DataFrame, score: str, label: str, digits: int = 8, bounds: Sequence[float] | None = None
) -> DataFrame:
    """Both of the above from one scan."""
    return _ranked(df, score, label, bounds).agg(_roc_auc(digits), _avg_precision(digits))


def pr_curve(
    df: DataFrame, score: str, label: str, digits: int = 8, bounds: Sequence[float] | None = None
) -> DataFrame:
    """(threshold, precision, recall) per distinct score, and the end point (NULL, 1, 0)."""
    ranked = _ranked(df, score, label, bounds)
    points = ranked.select(
        F.col("s").alias("threshold"),
        F.round(F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg")), digits).alias("precision"),
        F.round(F.coalesce(_ratio(F.col("cum_pos"), F.col("all_pos")), F.lit(1.0)), digits).alias("recall"),
    )
    end = df.sparkSession.range(1).select(
        F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall")
    )
    return points.unionByName(end)


def pr_at_threshold(curve: DataFrame, threshold: float) -> DataFrame:
    """The point of a ``pr_curve`` nearest to ``threshold``; the lower one of two equally near."""
    return (
        curve.where(F.col("threshold").isNotNull())
        .orderBy(F.abs(F.col("threshold") - F.lit(threshold)), "threshold").limit(1)
    )


def confusion(
    df: DataFrame, score: str, label: str, threshold: float = DECISION_THRESHOLD
) -> DataFrame:
    """One row (tn, fp, fn, tp)."""
    hit, pos = decision_flag(F.col(score), threshold) == 1, F.col(label) == 1
    return df.agg(
        F.count_if(~hit & ~pos).alias("tn"), F.count_if(hit & ~pos).alias("fp"),
        F.count_if(~hit & pos).alias("fn"), F.count_if(hit & pos).alias("tp"),
    )


def _or_zero(num: Column, den: Column) -> Column:
    return F.coalesce(_ratio(num, den), F.lit(0.0))


def _f1(hit: Column, missed: Column, wrong: Column) -> Column:
    return _or_zero(2 * hit, 2 * hit + missed + wrong)


def class_report(matrix: DataFrame, digits: int = 8) -> DataFrame:
    """Precision, recall, F1 and support per class, accuracy and averages, from ``confusion``."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    n0, n1 = tn + fp, fn + tp
    n = n0 + n1
    none = F.lit(None).cast("double")
    per_class = {
        "precision": (_or_zero(tn, tn + fn), _or_zero(tp, tp + fp)),
        "recall": (_or_zero(tn, n0), _or_zero(tp, n1)),
        "f1": (_f1(tn, fp, fn), _f1(tp, fn, fp)),
    }
    accuracy = _or_zero(tn + tp, n)

    def row(name: str, support: Column, values: list[Column]) -> Column:
        return F.struct(
            F.lit(name).alias("class"),
            *[F.round(v, digits).alias(m) for m, v in zip(per_class, values)],
            support.alias("support"),
        )

    rows = [
        row("0", n0, [v[0] for v in per_class.values()]),
        row("1", n1, [v[1] for v in per_class.values()]),
        row("accuracy", n, [none, none, accuracy]),
        row("macro avg", n, [(a + b) / 2 for a, b in per_class.values()]),
        row("weighted avg", n, [_or_zero(a * n0 + b * n1, n) for a, b in per_class.values()]),
    ]
    return matrix.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def recall_at(matrix: DataFrame, digits: int = 8) -> DataFrame:
    return matrix.select(F.round(_or_zero(F.col("tp"), F.col("tp") + F.col("fn")), digits).alias("recall"))


def cost_framing(
    matrix: DataFrame, customers: DataFrame, charge: str, offer_cost: float = 10.0
) -> DataFrame:
    """One row of business cost: ``matrix`` of the holdout, average charge of *all* customers."""
    offer_cents = F.lit(round(offer_cost * 100)).cast("bigint")
    charged = customers.agg(
        F.struct(F.sum(cents(charge)).alias("c"), F.count(F.col(charge)).alias("n")).alias("s")
    ).scalar()
    row = matrix.select("fn", charged.alias("s"))
    year = F.col("s.c") * 12
    return row.select(
        F.col("fn").alias("missed_churners"),
        mean_money(F.col("fn").cast("decimal(38,0)") * year.cast("decimal(38,0)"), F.col("s.n"))
        .alias("annual_revenue_lost"),
        mean_money(year, F.col("s.n")).alias("false_negative_cost"),
        money(offer_cents).alias("false_positive_cost"),
        hundredths(div_half_up(year.cast("decimal(38,0)") * 100, F.col("s.n") * offer_cents)).alias("cost_ratio"),
    )
