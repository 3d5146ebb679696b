"""A customer table derived from the order tables, for tests, checks and benchmarks.

One account per order.  Label and score are planted: a hash draw against a known
probability, so that every engine derives the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.schema import Roles

ACCOUNT_ROLES = Roles(
    id="account_id", label="churned", tenure="tenure", charge="monthly_charges",
    total="total_charges_text", contract="contract", payment="payment_method",
    internet="internet_service", support="tech_support", security="online_security",
    extras=("gender", "senior", "partner", "dependents"),
)

# Columns of the account table that carry the planted answer or repeat another column.
NOT_FEATURES = ("account_key", "u", "p", "score", "churn_text", "total_charges_text")


# The columns read, so that opening a table costs no job of its own.
_SCHEMAS = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_totalprice double, o_orderdate timestamp_ntz, "
              "o_orderpriority string",
    "customer": "c_custkey bigint, c_nationkey int, c_acctbal double, c_mktsegment string",
    "nation": "n_nationkey int, n_regionkey int",
    "region": "r_regionkey int, r_name string",
    "lineitem": "l_orderkey bigint, l_returnflag string, l_linestatus string",
    "documents": "doc_id bigint, lang string, source string, n_chars bigint",
    "labels": "doc_id bigint, quality int, toxic int",
}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(_SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, customer, nation, region, lineitem = (
        _table(spark, sf_dir, name) for name in ("orders", "customer", "nation", "region", "lineitem")
    )
    # Grouped by the key of the join below, so the two share one shuffle of the line items.
    lines = lineitem.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("cnt"),
        F.expr("count_if(l_returnflag = 'R')").alias("r_cnt"),
        F.expr("count_if(l_linestatus = 'F')").alias("f_cnt"),
    )
    joined = (
        # Where both sides grow with the data: a join that sorts and spills, never a broadcast.
        orders.join(customer.hint("merge"), F.expr("o_custkey = c_custkey"))
        .join(nation, F.expr("c_nationkey = n_nationkey"))
        .join(region, F.expr("n_regionkey = r_regionkey"))
        .join(lines.hint("merge"), F.expr("o_orderkey = l_orderkey"), "left")
    )
    base = joined.selectExpr(
        "o_orderkey AS account_key",
        "CAST(o_orderkey AS STRING) AS account_id",
        "CAST(least(datediff(DATE '2001-08-01', CAST(o_orderdate AS DATE)) div 30, 72) AS INT) AS tenure",
        "CAST((CAST(round(o_totalprice * 100) AS BIGINT) div 4000 + 1800) / 100.0D AS DECIMAL(18,2)) AS monthly_charges",
        """CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'Month-to-month'
                WHEN o_orderpriority = '3-MEDIUM' THEN 'One year' ELSE 'Two year' END AS contract""",
        "c_mktsegment AS payment_method",
        "r_name AS internet_service",
        _three_way("r_cnt", "tech_support"),
        _three_way("f_cnt", "online_security"),
        "CASE WHEN o_custkey % 2 = 0 THEN 'Female' ELSE 'Male' END AS gender",
        "CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END AS senior",
        "CASE WHEN n_nationkey % 2 = 0 THEN 'Yes' ELSE 'No' END AS partner",
        "CASE WHEN coalesce(cnt, 0) > 4 THEN 'Yes' ELSE 'No' END AS dependents",
        "CAST(conv(substr(md5(CAST(o_orderkey AS STRING)), 1, 8), 16, 10) AS BIGINT) / 4294967296.0D AS u",
    )
    planted = base.selectExpr("*", """0.05D
        + CASE WHEN contract = 'Month-to-month' THEN 0.35D WHEN contract = 'One year' THEN 0.08D ELSE 0.0D END
        + CASE WHEN tenure < 12 THEN 0.20D ELSE 0.0D END
        + CASE WHEN monthly_charges > 65 THEN 0.10D ELSE 0.0D END
        + CASE WHEN tech_support = 'No' THEN 0.08D ELSE 0.0D END AS p""")
    return planted.selectExpr(
        "*",
        "CASE WHEN u < p THEN 1 ELSE 0 END AS churned",
        """CASE WHEN tenure = 0 THEN ' '
                ELSE CAST(CAST(monthly_charges * tenure AS DECIMAL(18,2)) AS STRING) END AS total_charges_text""",
        "CASE WHEN u < p THEN 'Yes' ELSE 'No' END AS churn_text",
        "p + ((account_key * 7919) % 997) / 9970.0D AS score",
    )


def _three_way(count: str, name: str) -> str:
    return (f"CASE WHEN coalesce({count}, 0) = 0 THEN 'Yes' WHEN {count} = 1 THEN 'No internet service' "
            f"ELSE 'No' END AS {name}")


def labelled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with their quality and toxicity labels: a second, unrelated schema."""
    return _table(spark, sf_dir, "documents").join(_table(spark, sf_dir, "labels"), "doc_id")
