"""Chi-square tests of churn between two groups."""

from __future__ import annotations

import math
from collections.abc import Mapping

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from holdfast.functions.exact import rate_pct
from holdfast.functions.rules import HIGH_CHARGE, MONTHLY
from holdfast.schema import Roles


def standard_tests(roles: Roles = Roles()) -> dict[str, tuple[Column, Column]]:
    """The five named comparisons: (first group, second group)."""
    contract, tenure = F.col(roles.contract), F.col(roles.tenure)
    support, security = F.col(roles.support), F.col(roles.security)
    high = (contract == MONTHLY) & (F.col(roles.charge) > HIGH_CHARGE)
    high = F.coalesce(high, F.lit(False))
    return {
        "contract_monthly_vs_two_year": (contract == MONTHLY, contract == "Two year"),
        "tenure_under_12_vs_rest": (tenure < 12, tenure >= 12),
        "support_no_vs_yes": (support == "No", support == "Yes"),
        "security_no_vs_yes": (security == "No", security == "Yes"),
        "high_charge_monthly_vs_rest": (high, ~high),
    }


def chi2_tests(df: DataFrame, tests: Mapping[str, tuple[Column, Column]], label: str) -> DataFrame:
    """One row per test, all counted in a single pass over the table.

    2 x 2 table with the continuity correction; NULL where a margin is zero.
    """
    y = F.col(label) == 1
    counts = []
    for i, (a, b) in enumerate(tests.values()):
        counts += [
            F.count_if(a & y).alias(f"a1_{i}"), F.count_if(a).alias(f"an_{i}"),
            F.count_if(b & y).alias(f"b1_{i}"), F.count_if(b).alias(f"bn_{i}"),
        ]
    rows = F.explode(F.array(*[
        F.struct(
            F.lit(name).alias("test"),
            F.col(f"a1_{i}").alias("a_churned"), F.col(f"an_{i}").alias("a_n"),
            F.col(f"b1_{i}").alias("b_churned"), F.col(f"bn_{i}").alias("b_n"),
        )
        for i, name in enumerate(tests)
    ]))
    flat = df.agg(*counts).select(rows.alias("r")).select("r.*")

    a, b = F.col("a_churned").cast("double"), F.col("b_churned").cast("double")
    r1, r2 = F.col("a_n").cast("double"), F.col("b_n").cast("double")
    c, d = r1 - a, r2 - b
    n, c1, c2 = r1 + r2, a + b, c + d
    gap = F.greatest(F.abs(a * d - b * c) - n / 2, F.lit(0.0))
    margins = r1 * r2 * c1 * c2
    chi2 = F.when(margins > 0, n * gap * gap / F.when(margins > 0, margins))
    return flat.select(
        "test", "a_n", "a_churned", "b_n", "b_churned",
        rate_pct(F.col("a_churned"), F.col("a_n")).alias("a_rate_pct"),
        rate_pct(F.col("b_churned"), F.col("b_n")).alias("b_rate_pct"),
        F.round(chi2, 6).alias("chi2"),
    ).orderBy("test")


@F.pandas_udf(T.DoubleType())  # a type object: this runs before any session exists
def _chi2_p_value(chi2: pd.Series) -> pd.Series:
    return chi2.map(lambda x: math.erfc(math.sqrt(x / 2)), na_action="ignore")


def chi2_pvalues(tests: DataFrame) -> DataFrame:
    """Add the p-value (one degree of freedom) to the few rows of ``chi2_tests``.

    Spark has no error function, so these rows pass through Python.
    """
    return tests.withColumn("p_value", _chi2_p_value("chi2"))
