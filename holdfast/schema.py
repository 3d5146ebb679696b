"""Column roles and schemas.

Operators never hard-code a column name: they take a ``Roles`` that says which
column is the identifier, the label, the tenure and so on.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T


@dataclass(frozen=True)
class Roles:
    """Names of the columns that play each part in a customer table."""

    id: str = "customerID"
    label: str = "Churn"
    tenure: str = "tenure"
    charge: str = "MonthlyCharges"
    total: str = "TotalCharges"
    contract: str = "Contract"
    payment: str = "PaymentMethod"
    internet: str = "InternetService"
    support: str = "TechSupport"
    security: str = "OnlineSecurity"
    extras: tuple[str, ...] = ("gender", "SeniorCitizen", "Partner", "Dependents")

    def feature_table_columns(self) -> list[str]:
        """The stored columns of the derived feature table, in order."""
        return [
            self.id, self.tenure, self.charge, self.total, self.contract,
            self.payment, self.internet, self.support, self.security, self.label,
        ]


# Raw customer file: total arrives as text with blanks, the label as Yes/No.
CUSTOMER_SCHEMA = T.StructType([
    T.StructField("customerID", T.StringType()),
    T.StructField("gender", T.StringType()),
    T.StructField("SeniorCitizen", T.IntegerType()),
    T.StructField("Partner", T.StringType()),
    T.StructField("Dependents", T.StringType()),
    T.StructField("tenure", T.IntegerType()),
    T.StructField("InternetService", T.StringType()),
    T.StructField("OnlineSecurity", T.StringType()),
    T.StructField("TechSupport", T.StringType()),
    T.StructField("Contract", T.StringType()),
    T.StructField("PaymentMethod", T.StringType()),
    T.StructField("MonthlyCharges", T.DecimalType(18, 2)),
    T.StructField("TotalCharges", T.StringType()),
    T.StructField("Churn", T.StringType()),
])


def split_by_type(df: DataFrame, exclude: Iterable[str] = ()) -> tuple[list[str], list[str]]:
    """(numeric, categorical) column names, decided by the schema alone."""
    skip = set(exclude)
    numeric, categorical = [], []
    for field in df.schema.fields:
        if field.name in skip:
            continue
        (numeric if isinstance(field.dataType, T.NumericType) else categorical).append(field.name)
    return numeric, categorical


def drop_present(df: DataFrame, *names: str) -> DataFrame:
    """Drop the named columns; absent ones are ignored."""
    return df.drop(*names)


def missing_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    present = set(df.columns)
    return [c for c in required if c not in present]


def require_columns(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Return ``df`` unchanged, or raise naming every required column it lacks."""
    missing = missing_columns(df, required)
    if missing:
        raise ValueError("missing required columns: " + ", ".join(missing))
    return df
