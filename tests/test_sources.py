"""Files in, files out, and rules the library code must keep."""

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from holdfast.plans.catalog import ACCOUNT_CSV, ROLES
from holdfast.operators.segments import grouped_sets
from holdfast.plans.presets import EXPORT_SHEETS, export_sheets, named_query
from holdfast.functions.rules import with_segments
from holdfast.sources import exports, storage, tables
from holdfast.sources.accounts import accounts

PACKAGE = Path(__file__).resolve().parents[1] / "holdfast"


def test_corrupt_rows_are_kept(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text("account_id,tenure\na,1\nb,many\n")
    df = tables.read_customers_csv(spark, str(path), ACCOUNT_CSV.__class__([ACCOUNT_CSV["account_id"], ACCOUNT_CSV["tenure"]]))
    rows = {r["account_id"]: r for r in df.cache().collect()}
    assert rows["a"]["tenure"] == 1 and rows["a"][tables.CORRUPT] is None
    assert rows["b"]["tenure"] is None and rows["b"][tables.CORRUPT] == "b,many"


def test_write_table(spark, tmp_path):
    path = str(tmp_path / "t")
    one, two = spark.range(1), spark.range(2)
    assert not storage.path_exists(spark, path)
    assert tables.write_table(one, path).count() == 1
    assert tables.write_table(two, path, if_exists="skip").count() == 1
    assert tables.write_table(two, path).count() == 2
    with pytest.raises(ValueError):
        tables.write_table(two, path, if_exists="append")


def test_versions_of_a_table(spark, tmp_path):
    path = str(tmp_path / "t")
    assert storage.current_version(spark, path) is None
    with pytest.raises(FileNotFoundError):
        tables.read_table(spark, path)
    first = tables.store_table(spark.range(5), path)
    second = tables.store_table(spark.range(7), path)
    assert first.count() == 5 and second.count() == 7  # a reader of the version before goes on
    with pytest.raises(Exception, match="broken"):
        tables.store_table(spark.range(3).select(F.raise_error(F.lit("broken")).cast("long").alias("id")), path)
    with pytest.raises(ValueError, match="not so"):
        tables.store_table(spark.range(3), path, verify=lambda: (_ for _ in ()).throw(ValueError("not so")))
    assert tables.read_table(spark, path).count() == 7
    assert tables.store_table(spark.range(9), path, if_exists="skip").count() == 7
    tables.store_table(spark.range(1), path)
    folders = [p.name for p in Path(path).iterdir() if p.is_dir()]
    assert len(folders) == 2 and tables.read_table(spark, path).count() == 1  # the first version is gone
    assert spark.read.parquet(storage.current_version(spark, path)).count() == 1


def test_joined_frame_with_null_and_repeated_identifiers(spark, customers, tmp_path):
    raw = spark.createDataFrame(customers.limit(20).collect(), customers.schema)
    raw = spark.createDataFrame(raw.collect()[:19], raw.schema).unionByName(raw.limit(1).withColumn("account_id", F.lit(None).cast(raw.schema["account_id"].dataType)))
    derived = with_segments(raw, ROLES).select("account_id", *tables.SEGMENTS)
    path = str(tmp_path / "joined")
    stored = tables.store_training_frame(raw, derived, path, ROLES)
    assert stored.count() == raw.count() and stored.where("tenure_bucket IS NULL").count() == 0
    assert tables.training_frame(raw, derived, ROLES).where("account_id IS NULL AND risk_flag IS NULL").count() == 0
    with pytest.raises(ValueError, match=r"3 identifiers .* \(5 rows too many\)"):
        more = derived.limit(3).unionByName(derived.limit(2))
        tables.store_training_frame(raw, derived.unionByName(more), path, ROLES)
    assert tables.read_table(spark, path).count() == raw.count()
    assert tables.store_training_frame(raw, derived.limit(0), path, ROLES).where("risk_flag IS NULL").count() == raw.count()


def test_types_of_further_columns(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text("a,b,c,d,e,f\n1, 2.5 ,x,,007,1d\n-3,1e3,4, ,9223372036854775808,2\n,,5,,1,3\n")
    schema = T.StructType([T.StructField("a", T.IntegerType())])
    df = tables.read_customers_csv(spark, str(path), schema, infer=True)
    assert dict(df.dtypes) == {
        "a": "int", "b": "double", "c": "string", "d": "string", "e": "double", "f": "string", tables.CORRUPT: "string"}
    assert [r["b"] for r in df.collect()] == [2.5, 1000.0, None]
    from holdfast.schema import split_by_type
    assert split_by_type(df)[0] == ["a", "b", "e"]


def test_dashboard_from_one_scan(spark, customers, tmp_path):
    table = with_segments(customers, ROLES)
    for roles_table in (table, table.limit(0), table.withColumn("contract", F.lit(None).cast("string"))):
        for sheet, df in export_sheets(roles_table, ROLES).items():
            assert df.collect() == named_query(EXPORT_SHEETS[sheet], roles_table, ROLES).collect()
    stored = tables.write_table(table, str(tmp_path / "features"))
    plan = grouped_sets(stored, [[], ["contract"], ["contract", "risk_flag"]], ROLES)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Expand" in plan


def test_dashboard_export(spark, customers, tmp_path):
    table = with_segments(customers, ROLES)
    for fmt in ("csv", "parquet"):
        paths = exports.export_dashboard(table, str(tmp_path / fmt), ROLES, fmt)
        assert set(paths) == set(EXPORT_SHEETS)
        for sheet, query in EXPORT_SHEETS.items():
            df = named_query(query, table, ROLES)
            back = exports.read_export(spark, paths[sheet], df) if fmt == "csv" else spark.read.parquet(paths[sheet])
            assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
    counts = {"01_kpis": 1, "02_churn_by_contract": 3, "03_churn_by_tenure_bucket": 4, "05_action_segments_top20": 16}
    for sheet, n in counts.items():
        assert spark.read.parquet(str(tmp_path / "parquet" / sheet)).count() == n


def test_long_names_are_kept(spark, tmp_path):
    long = "x" * 40
    paths = exports.export_results({long: spark.range(2), long + "y": spark.range(3)}, str(tmp_path))
    assert [spark.read.option("header", True).csv(p).count() for p in paths.values()] == [2, 3] and list(paths) == [long, long + "y"]


CSV_TYPES = T.StructType([T.StructField("id", T.StringType()), T.StructField("n", T.IntegerType()), T.StructField("x", T.StringType())])


def test_csv_columns_are_found_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text("more,x,n,id,rest\nm1,x1,1,i1,r1\nm2,x2,two,i2,r2\nm3,x3\nm4,,4,i4,\n")
    read = tables.read_customers_csv(spark, str(tmp_path / "a.csv"), CSV_TYPES, {"rest": T.StringType()})
    assert read.columns == ["id", "n", "x", "more", "rest", tables.CORRUPT]
    good, bad = tables.split_rejects(read)
    assert sorted(map(tuple, good.collect())) == [("i1", 1, "x1", "m1", "r1"), ("i4", 4, None, "m4", None)]
    assert sorted(r[tables.CORRUPT] for r in bad.collect()) == ["m2,x2,two,i2,r2", "m3,x3"]


def test_csv_names_absent_columns(spark, tmp_path):
    (tmp_path / "a.csv").write_text("n,other\n1,2\n")
    with pytest.raises(ValueError, match="id, x"):
        tables.read_customers_csv(spark, str(tmp_path / "a.csv"), CSV_TYPES)


def test_scripts_are_cut_at_their_semicolons():
    script = "-- one; still a comment\nSELECT ';' AS a, `b;c`, \"d;\" FROM t; /* two; */ SELECT 1 - 1;\n;"
    assert tables.statements(script) == ["SELECT ';' AS a, `b;c`, \"d;\" FROM t", "SELECT 1 - 1"]


def test_unlisted_values_are_kept(spark):
    from holdfast.operators import segments
    from holdfast.schema import Roles

    df = spark.createDataFrame([("a", "Maybe", 1), ("a", "Yes", 0), ("b", None, 1), (None, "Yes", 1)], "r string, c string, Churn int")
    rows = segments.rate_matrix(df, "r", "c", ("Yes",), Roles()).collect()
    assert [tuple(r) for r in rows] == [("a", 0.0, 100.0), ("b", None, None)]
    axis = segments.rate_by_domain(df, "c", ("No", "Yes"), Roles()).collect()
    assert [tuple(r) for r in axis] == [(1, "No", 0, None), (2, "Yes", 2, 50.0), (3, "Maybe", 1, 100.0), (3, None, 1, 100.0)]


def test_driver_file(spark, tmp_path):
    drivers = spark.createDataFrame([("b", 0.5), ("a", 0.5), ("c", 1.23456789)], "feature string, mean_abs double")
    exports.export_drivers(drivers, str(tmp_path / "d"), k=2)
    text = next((tmp_path / "d").glob("part-*.csv")).read_text()
    assert text == "c\t1.234568\na\t0.500000\n"


def test_high_risk_file_is_in_order(spark, tmp_path):
    df = spark.createDataFrame([("a", .7, "High"), ("b", .9, "High"), ("c", .2, "Low")], "id string, p double, Risk_Level string")
    exports.export_high_risk(df, "p", "id", str(tmp_path / "h"))
    lines = [line for f in sorted((tmp_path / "h").glob("part-*.csv")) for line in f.read_text().splitlines()[1:]]
    assert lines == ["b,0.9,High", "a,0.7,High"]


def test_sql_on_views(spark, customers, tmp_path):
    tables.register_views(customers, ROLES)
    file = tmp_path / "q.sql"
    file.write_text("SELECT contract, COUNT(*) AS n FROM churn_features GROUP BY contract;\n")
    assert tables.run_sql(spark, file).agg(F.sum("n")).first()[0] == customers.count()
    assert tables.run_sql(spark, "SELECT COUNT(*) AS n FROM raw_data WHERE total_charges IS NULL").first()["n"] == 0


def test_training_frame_join_keeps_every_row(spark, customers):
    derived = with_segments(customers, ROLES).where("account_id <> '7'")
    out = tables.training_frame(customers, derived, ROLES)
    assert out.count() == customers.count()
    assert out.where("risk_flag IS NULL").select("account_id").collect() == [("7",)]
    assert tables.duplicate_ids(customers, "account_id").count() == 0
    assert tables.duplicate_ids(customers.union(customers.limit(1)), "account_id").first()["n"] == 2


def test_member_filter(spark, customers):
    out = tables.member_filter(customers, "contract", ["One year"])
    assert {r[0] for r in out.select("contract").distinct().collect()} == {"One year"}


# Results of bounded size that the library itself reads: model parameters, one-row
# metrics, category lists and tree nodes.
READS = {
    "operators/training.py": 5, "operators/attribution.py": 1, "operators/stages.py": 2,  # trees x leaves
    "plans/catalog.py": 1,  # twenty names
    "sources/tables.py": 1,  # counts per column
}


def test_no_rows_through_the_driver():
    for path in PACKAGE.rglob("*.py"):
        if "llm" in path.parts:  # has its own tests
            continue
        text = path.read_text()
        name = str(path.relative_to(PACKAGE))
        assert not re.search(r"toPandas|toLocalIterator|localCheckpoint|crossJoin|\.rdd\b", text), name
        found = len(re.findall(r"\.(?:collect|first|take|head)\(\)|\.take\(", text))
        assert found == READS.get(name, 0), (name, found)


def test_accounts_send_no_growing_table_to_the_driver(spark, tmp_path):
    """Orders, customers and line items grow with the data: only nations and regions are broadcast."""
    made = {
        "orders": "SELECT id AS o_orderkey, id % 7 AS o_custkey, 100.0D * id AS o_totalprice, "
                  "TIMESTAMP_NTZ '2000-01-01 00:00:00' AS o_orderdate, '3-MEDIUM' AS o_orderpriority FROM range(40)",
        "customer": "SELECT id AS c_custkey, CAST(id % 3 AS INT) AS c_nationkey, 1.0D * id AS c_acctbal, 'AUTO' AS c_mktsegment FROM range(6)",
        "nation": "SELECT CAST(id AS INT) AS n_nationkey, CAST(id % 2 AS INT) AS n_regionkey FROM range(3)",
        "region": "SELECT CAST(id AS INT) AS r_regionkey, 'r' || id AS r_name FROM range(2)",
        "lineitem": "SELECT id % 30 AS l_orderkey, 'R' AS l_returnflag, 'F' AS l_linestatus FROM range(90)",
    }
    for name, sql in made.items():
        spark.sql(sql).write.parquet(f"{tmp_path}/{name}.parquet")
    df = accounts(spark, str(tmp_path))
    assert df.count() == sum(i % 7 < 6 for i in range(40))
    plan = df._jdf.queryExecution().executedPlan().toString()
    shared = [line for line in plan.splitlines() if "BroadcastHashJoin" in line]
    assert len(shared) == 2 and not any("custkey" in line or "orderkey" in line for line in shared)


def test_kept_rows_carry_no_plan(spark):
    """Folds are read from the checkpoint folder: the partitions and rows of the table, nothing of how it was made, no cache left."""
    df = spark.range(1000).repartition(7, "id").groupBy((F.col("id") % 10).alias("k")).count()
    partitions, rows = df.persist().rdd.getNumPartitions(), sorted(df.collect())
    df.unpersist()
    kept = storage.kept(df)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert sorted(kept.collect()) == rows and kept.rdd.getNumPartitions() == partitions
    assert "ExistingRDD" in plan and "InMemory" not in plan and "Exchange" not in plan
    assert not df.storageLevel.useMemory
