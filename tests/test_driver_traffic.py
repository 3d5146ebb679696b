"""What tasks of the attribution queries send to the driver, training included, as Spark's event log tells it."""

import json
import os
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
QUERIES = ("global_drivers", "shap_points", "shap_points_check")
RUN = """
import json, sys, time
from pyspark.sql import SparkSession
import __spark_entry__
from holdfast.plans import catalog

top = sys.argv[1]
spark = SparkSession.builder.master("local[4]").config(map={
    "spark.ui.enabled": "false", "spark.driver.host": "127.0.0.1", "spark.sql.session.timeZone": "UTC", "spark.sql.shuffle.partitions": "4",
    "spark.checkpoint.dir": f"{top}/shared", "spark.local.dir": f"{top}/local", "spark.sql.warehouse.dir": f"{top}/warehouse",
    "spark.eventLog.enabled": "true", "spark.eventLog.dir": f"file://{top}/events", "spark.eventLog.compress": "false",
    "spark.eventLog.rolling.enabled": "false"}).getOrCreate()
made = {
    "orders": "SELECT id AS o_orderkey, id % 10000 AS o_custkey, 1000.0D * (id % 311) AS o_totalprice, TIMESTAMP_NTZ '1996-01-01 00:00:00' "
              "+ make_dt_interval(id % 2000) AS o_orderdate, element_at(array('1-URGENT', '2-HIGH', '3-MEDIUM', '5-LOW'), CAST(id % 4 + 1 AS INT)) "
              "AS o_orderpriority FROM range(20000)",
    "customer": "SELECT id AS c_custkey, CAST(id % 5 AS INT) AS c_nationkey, xxhash64(id) / 1e14D AS c_acctbal, 'AUTO' AS c_mktsegment FROM range(20000)",
    "nation": "SELECT CAST(id AS INT) AS n_nationkey, CAST(id % 2 AS INT) AS n_regionkey FROM range(5)",
    "region": "SELECT CAST(id AS INT) AS r_regionkey, 'r' || id AS r_name FROM range(2)",
    "lineitem": "SELECT id % 17000 AS l_orderkey, element_at(array('R', 'A', 'N'), CAST(id % 3 + 1 AS INT)) AS l_returnflag, "
                "IF(id % 5 < 2, 'F', 'O') AS l_linestatus FROM range(60000)",
}
for name, sql in made.items():
    spark.sql(sql).write.parquet(f"{top}/in/{name}.parquet")
spans = {}
for name in ("training", *sys.argv[2:]):
    began = time.time()
    if name == "training":
        catalog.fitted(spark, f"{top}/in")
    else:
        __spark_entry__.queries()[name](spark, f"{top}/in").write.parquet(f"{top}/out/{name}")
    spans[name] = [1000 * began, 1000 * time.time()]
print(json.dumps({"spans": spans, "check": list(spark.read.parquet(f"{top}/out/shap_points_check").first())}))
spark.stop()
"""


@pytest.fixture(scope="module")
def told(tmp_path_factory):
    """Bytes of each task's result, by step, over 20,000 accounts beside 20,000 customers."""
    top = tmp_path_factory.mktemp("traffic")
    (top / "events").mkdir()
    env = {**os.environ, "PYTHONPATH": str(ROOT), "SPARK_LOCAL_IP": "127.0.0.1", "PYSPARK_SUBMIT_ARGS": "--driver-memory 2g pyspark-shell"}
    done = subprocess.run([sys.executable, "-c", RUN, str(top), *QUERIES], env=env, capture_output=True, text=True, timeout=600)
    assert done.returncode == 0, done.stderr[-2000:]
    said = json.loads(done.stdout.splitlines()[-1])
    assert said["check"] == [20_000, 0]
    found = {name: [] for name in said["spans"]}
    (log,) = (top / "events").iterdir()
    for event in map(json.loads, log.read_text().splitlines()):
        if event["Event"] == "SparkListenerTaskEnd":
            at = event["Task Info"]["Launch Time"]
            for name, (began, ended) in said["spans"].items():
                if began <= at <= ended:
                    found[name].append(event["Task Metrics"]["Result Size"])
    return found


def test_no_task_sends_rows_that_grow(told):
    """Some metrics of its operators, and of the ranking a bounded number of rows; no customers on their way to a broadcast."""
    assert all(len(sizes) > 10 for sizes in told.values())
    assert {name: max(sizes) for name, sizes in told.items() if max(sizes) > 40_000} == {}


def test_fit_reports_no_plan_with_every_task(told):
    assert sum(told["training"]) < 6_000 * len(told["training"])
