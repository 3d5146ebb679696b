"""Scoring customers with a fitted model."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.functions.clean import label_lenient, to_number_or_zero
from holdfast.functions.rules import DECISION_THRESHOLD, decision_flag, risk_level, with_segments
from holdfast.operators.training import input_columns, positive_probability
from holdfast.schema import Roles, require_columns

SCORE, FLAG, LEVEL = "Churn_Probability", "Predicted_Churn", "Risk_Level"
DERIVED = ("tenure_bucket", "charge_tier", "risk_flag")


def score(
    df: DataFrame, model: PipelineModel, roles: Roles = Roles(),
    threshold: float = DECISION_THRESHOLD, keep_label: bool = False,
) -> DataFrame:
    """The input columns with probability, decision and risk level.

    Cleans and derives as in training; a label is not needed.  One that is there is
    dropped, or kept as 0/1 with ``keep_label``.  All of it is one projection.
    """
    needed = [roles.tenure, roles.charge, roles.contract]
    needed += [c for c in input_columns(model) if c not in DERIVED]
    require_columns(df, list(dict.fromkeys(needed)))
    shown = [c for c in df.columns if c != roles.label]
    ready = df
    if roles.total in df.columns:
        ready = ready.withColumn(roles.total, to_number_or_zero(F.col(roles.total)))
    if keep_label and roles.label in df.columns:
        ready = ready.withColumn(roles.label, label_lenient(F.col(roles.label)))
        shown.append(roles.label)
    probability = positive_probability()
    scored = model.transform(with_segments(ready, roles))
    return scored.select(*shown, probability.alias(SCORE)).withColumns({
        FLAG: decision_flag(F.col(SCORE), threshold),
        LEVEL: risk_level(F.col(SCORE)),
    })
