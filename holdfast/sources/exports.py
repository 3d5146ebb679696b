"""Result tables written for people and other tools."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.operators.campaign import high_risk_customers
from holdfast.plans.presets import export_sheets
from holdfast.schema import Roles

def export_results(results: Mapping[str, DataFrame], folder: str, fmt: str = "csv") -> dict[str, str]:
    """Write each result under its name, one folder each; returns name -> path."""
    if fmt not in ("csv", "parquet"):
        raise ValueError("fmt must be 'csv' or 'parquet'")
    paths = {name: f"{folder}/{name}" for name in results}
    for name, df in results.items():
        writer = df.write.mode("overwrite")
        writer.option("header", True).csv(paths[name]) if fmt == "csv" else writer.parquet(paths[name])
    return paths


def export_dashboard(features: DataFrame, folder: str, roles: Roles = Roles(), fmt: str = "csv") -> dict[str, str]:
    """The five dashboard tables, from one scan."""
    return export_results(export_sheets(features, roles), folder, fmt)


def read_export(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """Read an exported CSV table back with the schema it was written from."""
    return spark.read.schema(like.schema).option("header", True).csv(path)


def export_high_risk(scored: DataFrame, score: str, id_col: str, path: str) -> None:
    """All high-risk customers as CSV, part files in order of falling score."""
    high_risk_customers(scored, score, id_col).write.mode("overwrite").option("header", True).csv(path)


def export_drivers(drivers: DataFrame, path: str, k: int = 5) -> None:
    """The first ``k`` of a ranking (feature, mean_abs) as 'name TAB value' lines."""
    (
        drivers.orderBy(F.desc("mean_abs"), "feature").limit(k)
        .select("feature", F.format_string("%.6f", F.col("mean_abs")).alias("value"))
        .write.mode("overwrite").option("sep", "\t").csv(path)
    )
