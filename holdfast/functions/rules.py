"""Segmentation rules, each written once and used by training, SQL and scoring alike."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.schema import Roles

# The segment boundaries and labels.
TENURE_STEPS = ((12, "0-1yr"), (24, "1-2yr"), (48, "2-4yr"))
TENURE_LAST = "4+yr"
TENURE_DOMAIN = ("0-1yr", "1-2yr", "2-4yr", "4+yr")
CHARGE_STEPS = ((35, "Low"), (65, "Medium"))
CHARGE_LAST = "High"
MONTHLY = "Month-to-month"
HIGH_CHARGE = 65
RISK_LEVELS = ((0.3, "Low"), (0.6, "Medium"), (1.0, "High"))
DECISION_THRESHOLD = 0.35


def first_match(rules: Sequence[tuple[Column, object]], default: object = None) -> Column:
    """The value of the first rule whose predicate is true, as one CASE expression."""
    (cond, value), *rest = rules
    chain = F.when(cond, F.lit(value))
    for cond, value in rest:
        chain = chain.when(cond, F.lit(value))
    return chain.otherwise(F.lit(default))


def below_steps(col: Column, steps: Sequence[tuple[float, str]], last: str) -> Column:
    """Label of the first step the value lies under; ``last`` beyond all of them and for NULL."""
    return first_match([(col < bound, label) for bound, label in steps], last)


def tenure_bucket(tenure: Column) -> Column:
    return below_steps(tenure, TENURE_STEPS, TENURE_LAST)


def charge_tier(charge: Column) -> Column:
    return below_steps(charge, CHARGE_STEPS, CHARGE_LAST)


def risk_flag(contract: Column, charge: Column) -> Column:
    monthly = contract == MONTHLY
    return first_match(
        [(monthly & (charge > HIGH_CHARGE), "High Risk"), (monthly, "Medium Risk")],
        "Low Risk",
    )


def risk_level(score: Column) -> Column:
    """Right-closed bands [0, .3] Low, (.3, .6] Medium, (.6, 1] High; NULL outside."""
    bands = [(score < 0, None)] + [(score <= top, name) for top, name in RISK_LEVELS]
    return first_match(bands).cast("string")


def decision_flag(score: Column, threshold: float = DECISION_THRESHOLD) -> Column:
    return (score >= F.lit(threshold)).cast("int")


def with_segments(df: DataFrame, roles: Roles = Roles()) -> DataFrame:
    """Add tenure_bucket, charge_tier and risk_flag: a projection, no shuffle."""
    return df.withColumns({
        "tenure_bucket": tenure_bucket(F.col(roles.tenure)),
        "charge_tier": charge_tier(F.col(roles.charge)),
        "risk_flag": risk_flag(F.col(roles.contract), F.col(roles.charge)),
    })
