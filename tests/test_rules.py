"""Boundaries of the cleaning and segmentation rules, on hand-made rows."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from holdfast.functions import clean, exact, rules
from holdfast.schema import Roles, drop_present, missing_columns, require_columns, split_by_type


def values(spark, rows, dtype, build):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(rows)], f"i int, v {dtype}")
    return [r[0] for r in df.orderBy("i").select(build(F.col("v"))).collect()]


def test_tenure_bucket(spark):
    assert values(spark, [11, 12, 23, 24, 47, 48, None], "int", rules.tenure_bucket) == [
        "0-1yr", "1-2yr", "1-2yr", "2-4yr", "2-4yr", "4+yr", "4+yr"]


def test_charge_tier(spark):
    assert values(spark, [34.99, 35.0, 64.99, 65.0, 65.01], "double", rules.charge_tier) == [
        "Low", "Medium", "Medium", "High", "High"]


def test_risk_flag_boundary_differs_from_tier(spark):
    df = spark.createDataFrame(
        [(1, "Month-to-month", 65.0), (2, "Month-to-month", 65.01), (3, "Two year", 100.0), (4, None, 100.0)],
        "i int, c string, m double")
    got = df.orderBy("i").select(rules.risk_flag(F.col("c"), F.col("m")), rules.charge_tier(F.col("m"))).collect()
    assert [tuple(r) for r in got] == [
        ("Medium Risk", "High"), ("High Risk", "High"), ("Low Risk", "High"), ("Low Risk", "High")]


def test_risk_level(spark):
    assert values(spark, [0.0, .3, .30001, .6, .60001, 1.0, 1.1, -0.1, None], "double", rules.risk_level) == [
        "Low", "Low", "Medium", "Medium", "High", "High", None, None, None]


def test_decision_flag(spark):
    assert values(spark, [.34999, .35, .36], "double", rules.decision_flag) == [0, 1, 1]


def test_to_number(spark):
    texts = [" ", "12.5", " 12.5 ", "x", None, "1d", "1e2", "-3", ""]
    assert values(spark, texts, "string", clean.to_number_or_zero) == [0, 12.5, 12.5, 0, 0, 0, 100, -3, 0]
    assert values(spark, texts, "string", clean.to_number) == [
        None, 12.5, 12.5, None, None, None, 100, -3, None]


def test_labels(spark):
    assert values(spark, ["Yes", "yes", None, "No"], "string", clean.label_strict) == [1, 0, 0, 0]
    assert values(spark, [" YES ", "1", "True", "no", None], "string", clean.label_lenient) == [1, 1, 1, 0, 0]
    assert values(spark, [1, 0], "int", clean.label_lenient) == [1, 0]


def test_observed_months(spark):
    assert values(spark, [0, 1, None], "int", clean.observed_months) == [0.5, 1.0, None]


@pytest.mark.parametrize("hits, n, pct", [(1, 3, 33.33), (2, 3, 66.67), (1, 8, 12.5), (1, 800, 0.13), (0, 5, 0.0)])
def test_rate_is_half_up(spark, hits, n, pct):
    row = spark.createDataFrame([(hits, n)], "h bigint, n bigint").select(
        exact.rate_pct(F.col("h"), F.col("n"))).first()
    assert row[0] == pct


def test_exact_money(spark):
    df = spark.createDataFrame(
        [(Decimal("1.00"),), (Decimal("1.01"),), (None,)], "m decimal(18,2)")
    row = df.agg(exact.mean_money(F.sum(exact.cents("m")), F.count("m")).alias("a"),
                 exact.money(F.sum(exact.cents("m"))).alias("s")).first()
    assert tuple(row) == (1.01, 2.01)
    negative = spark.range(1).select(exact.div_half_up(F.lit(-5), F.lit(2)), exact.div_half_up(F.lit(1), F.lit(0)))
    assert tuple(negative.first()) == (-3, None)
    # sums beyond 64 bits in the numerator
    wide = spark.range(1).select(exact.rate_pct(F.lit(9 * 10**17), F.lit(10**18)))
    assert wide.first()[0] == 90.0


def test_columns(spark):
    df = spark.createDataFrame([("a", 1, 2.0, True)], "s string, i int, d double, b boolean")
    assert split_by_type(df, exclude=["i"]) == (["d"], ["s", "b"])
    assert drop_present(df, "i", "absent").columns == ["s", "d", "b"]
    assert missing_columns(df, ["s", "x", "y"]) == ["x", "y"]
    with pytest.raises(ValueError, match="x, y"):
        require_columns(df, ["s", "x", "y"])


def test_feature_table_has_the_required_columns(spark):
    from holdfast.sources.tables import clean_customers, feature_table

    roles = Roles()
    raw = spark.createDataFrame(
        [("a", 3, 70.0, " ", "Month-to-month", "Mailed check", "DSL", "No", "No", "Yes"),
         ("b", 60, 20.0, "1200", "Two year", "Mailed check", "No", "No internet service", "No internet service", "No")],
        "customerID string, tenure int, MonthlyCharges double, TotalCharges string, Contract string, "
        "PaymentMethod string, InternetService string, TechSupport string, OnlineSecurity string, Churn string")
    table = feature_table(clean_customers(raw, roles), roles)
    required = {"tenure", "MonthlyCharges", "TotalCharges", "Contract", "PaymentMethod", "InternetService",
                "TechSupport", "OnlineSecurity", "tenure_bucket", "charge_tier", "risk_flag", "Churn"}
    assert required <= set(table.columns)
    assert table.where(F.col("TotalCharges").isNull()).count() == 0
    assert [tuple(r) for r in table.orderBy("customerID").select("Churn", "tenure_bucket", "risk_flag").collect()] == [
        (1, "0-1yr", "High Risk"), (0, "4+yr", "Low Risk")]
