"""Every registered query against its SQL twin."""

import pytest

import __spark_entry__ as entry_points
from holdfast.plans import catalog, oracle
from oracle import compare, connect

QUERIES, SQL = catalog.queries(), oracle.oracle_sql()
# Results that SQL cannot state; each has a test of its own elsewhere.
ROWS_ONLY = {
    "chi2_pvalues", "score", "train", "tune", "cv_report", "driver_export", "shap_values",
    "global_drivers", "customer_drivers", "shap_points", "rank_drivers",
}
TYPES = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR"}


def test_every_query_has_a_twin():
    assert set(QUERIES) - set(SQL) == ROWS_ONLY
    assert set(SQL) <= set(QUERIES) <= set(entry_points.queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows(spark, small, name):
    con = connect(small)
    df = QUERIES[name](spark, small)
    assert compare(df, con, SQL[name]) == []
    types = {r[0]: r[1] for r in con.execute(f"DESCRIBE {SQL[name]}").fetchall()}
    assert {n: TYPES[t] for n, t in df.dtypes} == types
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


@pytest.mark.parametrize("partitions", [1, 40])
@pytest.mark.parametrize("name", [
    "export_contract", "km_curve", "kde_by_label", "box_stats", "roc_auc", "pr_curve", "campaign_grid",
    "stratified_split", "stratified_folds"])
def test_same_rows_when_nothing_is_small_enough_to_broadcast(spark, small, name, partitions):
    """As on a large table: no automatic broadcast, other numbers of partitions."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        assert compare(QUERIES[name](spark, small), connect(small), SQL[name]) == []
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("name", sorted(ROWS_ONLY - {"tune", "cv_report"}))
def test_rows(spark, small, name):
    assert QUERIES[name](spark, small).count() > 0


def test_entry(spark):
    assert entry_points.entry(spark).count() == 3
