"""Statistics on small hand-made or brute-force-checked inputs."""

import math
import bisect
import random

import pytest
from pyspark.sql import functions as F

from holdfast.operators import campaign, explore, metrics, sampling, scan, segments, significance, survival


def frame(spark, rows, schema, parts=3):
    return spark.createDataFrame(rows, schema).repartition(parts)


# Published chi-square statistics and p-values.
@pytest.mark.parametrize("chi2, p", [
    (881.5, 1.032e-193), (709.1, 3.140e-156), (414.3, 4.248e-92), (433.8, 2.420e-96), (1105.6, 2.003e-242)])
def test_p_values(spark, chi2, p):
    got = significance.chi2_pvalues(spark.createDataFrame([(chi2,)], "chi2 double")).first()["p_value"]
    assert math.isclose(got, p, rel_tol=1e-3)


def test_p_value_of_an_undefined_test(spark):
    df = spark.createDataFrame([(1, 1)], "x int, y int")
    tests = significance.chi2_tests(df, {"t": (F.col("x") == 1, F.col("x") == 2)}, "y")
    row = significance.chi2_pvalues(tests).first()
    assert row["chi2"] is None and row["p_value"] is None and row["b_rate_pct"] is None


def test_survival(spark):
    df = frame(spark, [("a", 1, 1), ("a", 2, 1), ("a", 2, 0), ("a", 3, 1), ("b", 5, 0)], "s string, t int, e int")
    curve = {(r["stratum"], r["t"]): r["survival"] for r in survival.km_curve(df, "s", "t", "e").collect()}
    assert curve == {("a", 0.0): 1.0, ("a", 1.0): .75, ("a", 2.0): .5, ("a", 3.0): 0.0, ("b", 0.0): 1.0}
    assert [tuple(r) for r in survival.km_median(df, "s", "t", "e").collect()] == [("a", 4, 2.0), ("b", 1, None)]


def test_survival_invariants(spark, customers):
    rows = survival.km_curve(customers, "contract", "tenure", "churned").orderBy("stratum", "t").collect()
    sizes = {r[0]: r[1] for r in customers.groupBy("contract").count().collect()}
    last = {}
    for r in rows:
        if r["t"] == 0:
            assert r["n_at_risk"] == sizes[r["stratum"]]
            last[r["stratum"]] = 1.0
        assert 0 <= r["survival"] <= last[r["stratum"]]
        last[r["stratum"]] = r["survival"]


def brute_auc(pairs):
    pos = [s for s, y in pairs if y == 1]
    neg = [s for s, y in pairs if y == 0]
    wins = sum((p > n) + (p == n) / 2 for p in pos for n in neg)
    return wins / (len(pos) * len(neg))


def brute_ap(pairs):
    total, area, before = sum(y for _, y in pairs), 0.0, 0.0
    for t in sorted({s for s, _ in pairs}, reverse=True):
        taken = [y for s, y in pairs if s >= t]
        recall = sum(taken) / total
        area += (recall - before) * sum(taken) / len(taken)
        before = recall
    return area


@pytest.mark.parametrize("levels", [3, 1000])
def test_ranking_metrics_with_ties(spark, levels):
    rng = random.Random(1)
    pairs = [(rng.randrange(levels) / levels * 1.4 - 0.2, int(rng.random() < 0.4)) for _ in range(400)]
    df = frame(spark, pairs, "s double, y int")
    quality = metrics.ranking_quality(df, "s", "y").first()
    assert quality["roc_auc"] == pytest.approx(brute_auc(pairs), abs=1e-8)
    assert quality["avg_precision"] == pytest.approx(brute_ap(pairs), abs=1e-8)
    assert metrics.ranking_quality(df, "s", "y", bounds=[0.1, 0.5]).first() == quality
    curve = metrics.pr_curve(df, "s", "y").collect()
    assert len(curve) == len({s for s, _ in pairs}) + 1
    assert [r for r in curve if r["threshold"] is None] == [(None, 1.0, 0.0)]


def test_metrics_of_one_class(spark):
    df = frame(spark, [(0.1, 0), (0.9, 0)], "s double, y int")
    assert metrics.roc_auc(df, "s", "y").first()[0] is None
    assert metrics.avg_precision(df, "s", "y").first()[0] == 0.0
    report = {r["class"]: r for r in metrics.class_report(metrics.confusion(df, "s", "y")).collect()}
    assert report["1"]["precision"] == 0.0 and report["1"]["support"] == 0
    assert report["accuracy"]["f1"] == 0.5


def test_confusion_adds_up(spark, customers):
    row = metrics.confusion(customers, "score", "churned").first()
    assert sum(row) == customers.count()


def test_nearest_point_prefers_the_lower(spark):
    df = frame(spark, [(0.2, 1), (0.4, 0)], "s double, y int")
    assert metrics.pr_at_threshold(metrics.pr_curve(df, "s", "y"), 0.3).first()["threshold"] == 0.2


@pytest.mark.parametrize("partitions", [1, 4, 64])
def test_running_totals_do_not_depend_on_cells_or_partitions(spark, partitions):
    rng = random.Random(2)
    rows = [(k, v, rng.randrange(10)) for k in "ab" for v in rng.sample(range(1000), 200)]
    expected = {}
    for k in "ab":
        total = 0
        for _, v, w in sorted(r for r in rows if r[0] == k):
            total += w
            expected[k, v] = total
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        df = frame(spark, rows, "k string, v int, w int")
        for cell in (F.lit(0), None, scan.even_cells(F.col("v"), 100, 300, 7),
                     scan.bounded_cells(F.col("v"), [10, 500, 900])):
            out = scan.running_totals(df, ["v"], cell, {"w": "sum"}, keys=["k"]).collect()
            assert {(r["k"], r["v"]): r["cum_w"] for r in out} == expected
            assert {r["all_w"] for r in out if r["k"] == "a"} == {max(c for (k, _), c in expected.items() if k == "a")}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_cells_never_decrease(spark):
    values = [-1.0, 0.0, 1e-15, 1e-9, 0.001, 0.0010001, 0.3, 0.499999, 0.5, 0.500001, 0.7, 0.999, 1 - 1e-9, 1.0, 7.0]
    df = spark.createDataFrame([(v,) for v in values], "v double").orderBy("v")
    for cut in (scan.with_range_cells(df, ["v"], "c", 8), df.withColumn("c", scan.even_cells(F.col("v"), 0, 1))):
        cells = [r[0] for r in cut.orderBy("v").select("c").collect()]
        assert cells == sorted(cells) and len(set(cells)) > 5


@pytest.mark.parametrize(("lo", "hi"), [(1000.0, 1001.0), (0.300, 0.301), (-5e9, 5e-9)])
def test_cells_are_even_for_any_range(spark, lo, hi):
    df = spark.range(200_000).select((F.lit(lo) + F.col("id") / 200_000 * (hi - lo)).alias("v"))
    sizes = [r["count"] for r in scan.with_range_cells(df, ["v"], "c", 64).groupBy("c").count().collect()]
    assert len(sizes) == 64 and max(sizes) < 3 * 200_000 / 64


def test_running_totals_of_one_hot_key(spark):
    rows = [("hot", i, 1) for i in range(300)] + [("cold", 1, 1)]
    df = frame(spark, rows, "k string, v int, w int")
    out = scan.running_totals(df, ["v"], None, {"w": "sum"}, keys=["k"], descending=True)
    got = {(r["k"], r["v"]): r["cum_w"] for r in out.collect()}
    assert got == {**{("hot", i): 300 - i for i in range(300)}, ("cold", 1): 1}


def quantile(xs, q):
    xs, at = sorted(xs), (len(xs) - 1) * q
    lo = math.floor(at)
    return xs[lo] + (xs[math.ceil(at)] - xs[lo]) * (at - lo)


def test_box_stats(spark):
    rng = random.Random(3)
    rows = [(y, round(rng.gauss(0, 10), 1)) for y in (0, 1) for _ in range(101)] + [(0, 500.0), (1, -500.0)]
    got = {r["label"]: r for r in explore.box_stats(frame(spark, rows, "y int, v double"), "y", "v").collect()}
    for y in (0, 1):
        xs = [v for label, v in rows if label == y]
        q1, q2, q3 = (quantile(xs, q) for q in (.25, .5, .75))
        inside = [x for x in xs if q1 - 1.5 * (q3 - q1) <= x <= q3 + 1.5 * (q3 - q1)]
        assert got[y]["q1"] == pytest.approx(q1, abs=1e-6) and got[y]["median"] == pytest.approx(q2, abs=1e-6)
        assert got[y]["q3"] == pytest.approx(q3, abs=1e-6) and got[y]["outliers"] == len(xs) - len(inside) >= 1
        assert (got[y]["whisker_lo"], got[y]["whisker_hi"]) == (min(inside), max(inside))


def test_density_integrates_to_one(spark, customers):
    curves = {}
    for r in explore.density(customers, "churned", ["tenure", "monthly_charges"]).collect():
        curves.setdefault((r["label"], r["measure"]), []).append((r["x"], r["density"]))
    assert len(curves) == 4
    for points in curves.values():
        points.sort()
        assert len(points) == 200
        area = sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(points, points[1:]))
        assert area == pytest.approx(1, abs=0.01)


def test_correlation_of_a_constant_is_null(spark):
    df = frame(spark, [(1.0, 2.0), (2.0, 2.0), (3.0, 2.0)], "a double, b double")
    got = {(r["x"], r["y"]): r["r"] for r in explore.correlation_matrix(df, ["a", "b"]).collect()}
    assert got == {("a", "a"): 1.0, ("a", "b"): None, ("b", "a"): None, ("b", "b"): None}


def test_limit_is_decided_by_the_keys(spark):
    rows = [(f"g{i}", 1, 10.0) for i in range(9)]
    df = frame(spark, rows, "g string, Churn int, MonthlyCharges double")
    out = segments.segment_summary(df, ["g"], {"m": "rev_at_risk"}, order=["-m"], limit=5).collect()
    assert [r["g"] for r in out] == ["g0", "g1", "g2", "g3", "g4"]


def test_empty_bucket_stays_on_the_axis(spark):
    df = frame(spark, [("0-1yr", 1), ("4+yr", 0)], "tenure_bucket string, Churn int")
    out = segments.rate_by_domain(df, "tenure_bucket", ("0-1yr", "1-2yr", "2-4yr", "4+yr")).collect()
    assert [tuple(r)[1:] for r in out] == [("0-1yr", 1, 100.0), ("1-2yr", 0, None), ("2-4yr", 0, None), ("4+yr", 1, 0.0)]


def test_segments_add_up(spark, customers):
    from holdfast.plans.catalog import ROLES
    from holdfast.functions.rules import with_segments
    from holdfast.plans.presets import PRESETS, named_query

    table = with_segments(customers, ROLES)
    total, churned = customers.agg(F.count("*"), F.sum("churned")).first()
    for name, preset in PRESETS.items():
        out = named_query(name, table, ROLES)
        for column, metric in preset.metrics.items():
            if metric in ("n", "churned"):
                assert out.agg(F.sum(column)).first()[0] == (total if metric == "n" else churned)


def test_split_and_folds(spark, customers):
    split = sampling.stratified_split(customers, "account_id", "churned").groupBy("churned", "split").count()
    counts = {(r[0], r[1]): r[2] for r in split.collect()}
    for y in (0, 1):
        n = counts[y, "test"] + counts[y, "train"]
        assert counts[y, "test"] == math.floor(n * 0.2 + 0.5)
    assert sum(counts.values()) == customers.count()
    folds = sampling.stratified_folds(customers, "account_id", "churned").groupBy("churned", "fold").count()
    sizes = {}
    for y, fold, n in folds.collect():
        sizes.setdefault(y, []).append(n)
    assert all(len(s) == 5 and max(s) - min(s) <= 1 for s in sizes.values())


@pytest.mark.parametrize("fraction", [0.0, 1.0])
def test_split_extremes(spark, customers, fraction):
    split = sampling.stratified_split(customers, "account_id", "churned", fraction)
    assert {r[0] for r in split.select("split").distinct().collect()} == {"test" if fraction else "train"}


def test_sample_is_reproducible(spark, customers):
    ids = {r[0] for r in sampling.sample_n(customers, "account_id", 50).select("account_id").collect()}
    again = {r[0] for r in sampling.sample_n(customers.repartition(7), "account_id", 50).select("account_id").collect()}
    assert len(ids) == 50 and ids == again


def test_campaign_with_ties_and_small_tables(spark):
    rows = [(i, s) for i, s in enumerate([0.9, 0.5, 0.5, 0.5, 0.1])]
    df = frame(spark, rows, "i int, s double")
    got = {r["top_n"]: r for r in campaign.campaign_grid(df, "s", [2, 4, 100], [0.5], 100.0, 10.0).collect()}
    assert {n: r["targeted"] for n, r in got.items()} == {2: 2, 4: 4, 100: 5}
    assert {n: r["expected_churners"] for n, r in got.items()} == {2: 1.4, 4: 2.4, 100: 2.5}
    assert got[2]["net_benefit"] == 50.0 and got[2]["roi_pct"] == 250.0
    free = campaign.campaign_roi(df, "s", 2, 0.5, 100.0, 0.0).first()
    assert free["roi_pct"] == 0.0


def test_rank_outside_the_pool(spark, customers):
    with pytest.raises(ValueError):
        campaign.customer_at_rank(customers, "score", "account_id", 300, pool=300)
    assert campaign.customer_at_rank(customers, "score", "account_id", 300).count() == 1


def test_sweep_has_all_thresholds_even_without_rows(spark):
    df = spark.createDataFrame([], "s double, y int")
    out = campaign.threshold_sweep(df, "s", "y").collect()
    assert len(out) == 19 and {r["flagged"] for r in out} == {0}


def test_sketches_merge(spark):
    df = spark.range(100_000).select((F.col("id") % 7).alias("k"), (F.col("id") * 37 % 100_003).cast("double").alias("v"))
    stored = explore.quantile_sketches(df, ["k"], "v")
    whole = explore.sketched_quantiles(explore.merged_sketches(stored, []), {"p10": 0.1, "p50": 0.5, "p90": 0.9}).first()
    values = sorted(r["v"] for r in df.collect())
    assert (whole["n"], whole["lo"], whole["hi"]) == (100_000, values[0], values[-1])
    for name, q in (("p10", 0.1), ("p50", 0.5), ("p90", 0.9)):
        assert abs(bisect.bisect(values, whole[name]) / 100_000 - q) < 0.01
    assert explore.quantile_sketches(df.limit(0), ["k"], "v").count() == 0


def test_binned_density_of_many_values(spark):
    df = spark.range(60_000).select((F.col("id") % 2).cast("int").alias("y"), (F.rand(3) * 50 + F.randn(4)).alias("v")).persist()
    key = ["label", "measure", "i"]
    exact = explore.density(df, "y", ["v"], points=40).withColumnRenamed("density", "want").drop("x")
    both = explore.density(df, "y", ["v"], points=40, binned=True).join(exact, key)
    assert both.count() == 80 and both.agg(F.max(F.abs(F.col("density") - F.col("want")))).first()[0] <= 1e-6
    df.unpersist()
