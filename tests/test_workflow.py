"""The whole batch job on a small file with the default column names."""

import random

from pyspark.sql import functions as F

from holdfast.plans.workflow import run_all
from holdfast.schema import CUSTOMER_SCHEMA, Roles
from holdfast.sources import storage


def rows(n):
    rng = random.Random(5)
    for i in range(n):
        contract = rng.choice(["Month-to-month", "One year", "Two year"])
        tenure = rng.randrange(0, 73)
        charge = rng.randrange(1800, 11000) / 100
        churn = rng.random() < (0.6 if contract == "Month-to-month" else 0.1)
        service = rng.choice(["Yes", "No", "No internet service"])
        yield (f"c{i}", rng.choice(["Male", "Female"]), rng.randrange(2), rng.choice(["Yes", "No"]),
               rng.choice(["Yes", "No"]), tenure, rng.choice(["DSL", "Fiber optic", "No"]), service, service,
               contract, rng.choice(["Mailed check", "Electronic check"]), charge,
               " " if tenure == 0 else f"{charge * tenure:.2f}", "Yes" if churn else "No")


def test_run_all(spark, tmp_path):
    columns = CUSTOMER_SCHEMA.fieldNames()
    source, out = tmp_path / "customers.csv", str(tmp_path / "out")
    lines = [",".join(columns)] + [",".join(map(str, r)) for r in rows(600)]
    source.write_text("\n".join(lines) + "\n")

    trained = run_all(spark, str(source), out, sample_size=100, maxIter=3)

    raw = spark.read.parquet(f"{out}/raw_data")
    assert raw.count() == 600 and raw.columns == columns
    assert raw.where(F.col("TotalCharges").isNull()).count() == 0
    assert {r[0] for r in raw.select("Churn").distinct().collect()} == {0, 1}
    features = spark.read.parquet(f"{out}/churn_features")
    assert features.columns == [*Roles().feature_table_columns(), "tenure_bucket", "charge_tier", "risk_flag"]
    assert trained.metrics["roc_auc"] > 0.6
    for name in ("exports/01_kpis", "exploration/03_numeric_distributions", "findings/significance",
                 "top5_drivers", "model/metadata"):
        assert storage.path_exists(spark, f"{out}/{name}"), name
    assert spark.read.option("header", True).csv(f"{out}/findings/median_retention").count() == 3
