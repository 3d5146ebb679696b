"""Training, scoring and attribution."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from holdfast.operators import scoring, stages, training
from holdfast.operators.attribution import LOG_ODDS, Explainer, LeafRules, _attribute, _groups
from holdfast.plans import catalog
from holdfast.plans.catalog import ROLES
from holdfast.schema import Roles
from holdfast.sources.accounts import NOT_FEATURES


def test_quality(fitted):
    assert fitted.metrics["roc_auc"] > 0.65
    assert len(fitted.feature_names) == 39


def test_unknown_category_is_all_zero(spark, customers, fitted):
    frame = training.model_frame(customers, ROLES, NOT_FEATURES).limit(1).withColumn("contract", F.lit("never seen"))
    encoder = training.PipelineModel(stages=fitted.model.stages[:-1])
    set_ = {r["feature"] for r in training.one_hot(frame, encoder, "account_id").collect()}
    assert len(set_) == 10 and not any(f.startswith("contract_") for f in set_)


def test_score_contract(spark, small, fitted):
    raw = catalog.raw_customers(spark, small)
    out = scoring.score(raw, fitted.model, ROLES)
    assert out.columns == [c for c in raw.columns if c != "churned"] + [
        "Churn_Probability", "Predicted_Churn", "Risk_Level"]
    bad = out.where(~F.col("Churn_Probability").between(0, 1) | F.col("Risk_Level").isNull())
    assert bad.count() == 0 and out.count() == raw.count()
    without = scoring.score(raw.drop("churned"), fitted.model, ROLES)
    assert without.columns == out.columns
    kept = scoring.score(raw, fitted.model, ROLES, keep_label=True)
    assert {r[0] for r in kept.select("churned").distinct().collect()} == {0, 1}
    with pytest.raises(ValueError, match="tech_support"):
        scoring.score(raw.drop("tech_support"), fitted.model, ROLES)
    extra = scoring.score(raw.withColumn("note", F.lit("x")), fitted.model, ROLES)
    assert "note" in extra.columns


def test_scores_agree_with_training_frame(spark, small, customers, fitted):
    a = scoring.score(catalog.raw_customers(spark, small), fitted.model, ROLES)
    b = training.probabilities(training.model_frame(customers, ROLES, NOT_FEATURES), fitted.model)
    gap = a.join(b.select("account_id", "score"), "account_id").agg(
        F.max(F.abs(F.col("score") - F.col("Churn_Probability")))).first()[0]
    assert gap < 1e-12


def test_too_many_levels(spark, customers):
    with pytest.raises(ValueError, match="account_id"):
        training.check_levels(customers, ["account_id", "contract"], most=100)


def test_draws():
    draws = training.draw_params(20)
    assert len({tuple(d.items()) for d in draws}) == 20
    assert draws == training.draw_params(20)
    assert all(d[k] in training.SEARCH_SPACE[k] for d in draws for k in d)
    assert len(training.draw_params(99, space={"a": [1, 2], "b": [3, 4]})) == 4
    assert training.spark_params({"gamma": 0.1, "min_child_weight": 3}, 100) == {
        "minInfoGain": 0.001, "minInstancesPerNode": 3}


def test_search(spark, customers):
    space = {"maxIter": [1], "maxDepth": [1, 2], "gamma": [0.0, 0.1]}
    tuned = training.tune(customers, ROLES, NOT_FEATURES, n_iter=2, folds=2, space=space)
    report = training.search_report(customers, tuned).collect()
    assert len(report) == 2 and sum(r["best"] for r in report) == 1
    best = next(r for r in report if r["best"])
    assert best["mean_roc_auc"] == max(r["mean_roc_auc"] for r in report) > 0.6


@pytest.fixture(scope="module")
def encoded(customers):
    frame = training.model_frame(customers, ROLES, NOT_FEATURES)
    encoder = training.fit_features(frame, ROLES)
    rows = training._encoded(frame, encoder, ROLES, 2.0, "account_id").persist()
    yield rows, training.classifier(ROLES, maxIter=6, maxDepth=3).fit(rows)
    rows.unpersist()


def test_an_ensemble_holds_its_shorter_ones(encoded):
    rows, trees = encoded
    table = stages.leaves(trees, rows)
    readings = [stages.Reading(n) for n in (2, 4, 6)]
    placed = stages.with_leaves(rows, trees, "account_id")
    got = {r[0]: r[1] for r in stages.readings_scored(placed, [table] * 3, readings, ["account_id"]).collect()}
    for k, n in enumerate((2, 4, 6)):
        own = trees if n == 6 else training.classifier(ROLES, maxIter=n, maxDepth=3).fit(rows)
        alone = own.transform(rows).select("account_id", training.positive_probability().alias("p")).collect()
        assert max(abs(got[r["account_id"]][k] - r["p"]) for r in alone) < 1e-12


def test_penalised_leaves(encoded):
    rows, trees = encoded
    table = stages.leaves(trees, rows)
    placed = stages.with_leaves(rows, trees, "churned", training.WEIGHT).persist()
    sums = {(r["tree"], r["leaf"]): r for r in stages.leaf_sums(placed, table, "churned", training.WEIGHT).collect()}
    plain = {}
    for r in placed.collect():
        margin = 0.0
        for t, leaf in enumerate(r["leaf"]):
            p = 1 / (1 + math.exp(-2 * margin))
            n, g, h = plain.get((t, int(leaf)), (0, 0.0, 0.0))
            plain[t, int(leaf)] = n + 1, g + r[training.WEIGHT] * (p - r["churned"]), h + r[training.WEIGHT] * p * (1 - p)
            margin += table.values[t, int(leaf)]
    assert set(sums) == set(plain)
    for k, (n, g, h) in plain.items():
        assert sums[k]["n"] == n and sums[k]["g"] == pytest.approx(g, abs=1e-8) and sums[k]["h"] == pytest.approx(h)
    l1, l2 = 5.0, 20.0
    cut = stages.penalised(table, stages.leaf_sums(placed, table, "churned", training.WEIGHT), l1, l2)
    for (t, leaf), (_, g, h) in plain.items():
        want = table.values[t, leaf] * max(abs(g) - l1, 0) / abs(g) * h / (h + l2)
        assert cut.values[t, leaf] == pytest.approx(want, abs=1e-12)
    assert np.abs(cut.values).sum() < np.abs(table.values).sum()
    # the stored model and the readings agree
    model = stages.refitted(trees, cut, rows)
    told = stages.readings_scored(stages.with_leaves(rows, trees, "account_id"), [cut], [stages.Reading(6)], ["account_id"])
    both = model.transform(rows).select("account_id", training.positive_probability().alias("p")).join(told, "account_id")
    assert both.agg(F.max(F.abs(F.col("p") - F.col("scores")[0]))).first()[0] < 1e-12


def test_draws_share_fits():
    draws = training.draw_params(20, space=catalog.CHECK_SPACE)
    groups = training.grown(draws)
    assert len(draws) == 20 and len(groups) <= 4 and sorted(i for own in groups.values() for i in own) == list(range(20))


def test_search_with_penalties(customers):
    space = {"maxIter": [1, 2], "maxDepth": [1], "reg_lambda": [1.0, 50.0], "reg_alpha": [0.0, 0.1]}
    tuned = training.tune(customers, ROLES, NOT_FEATURES, n_iter=8, folds=2, space=space)
    assert len(tuned.averages) == 8 and min(tuned.averages) > 0.5 and tuned.metrics["roc_auc"] > 0.5


def _made(spark, rows: int = 400):
    """Customers of a schema of their own, behind a shuffle."""
    out = [(f"c{i}", ("Month-to-month", "One year", "Two year")[i % 3], float(i % 60), float(20 + i % 80), int((i * 7) % 10 < (6 if i % 3 else 2)))
           for i in range(rows)]
    df = spark.createDataFrame(out, "id string, Contract string, tenure double, MonthlyCharges double, churned int")
    return df.repartition(8, "id"), Roles(id="id", label="churned", tenure="tenure")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_training_rows_carry_no_plan(spark):
    """What a fit and the holdout read comes from the checkpoint folder: no cached plan, join or shuffle behind it."""
    df, roles = _made(spark)
    rows, held = training._train_and_holdout(df, roles, (), 0.2, 42)
    assert rows.count() == 320 and held.count() == 80
    for part in (rows, held):
        assert "ExistingRDD" in _plan(part)
        assert not any(step in _plan(part) for step in ("InMemory", "Join", "Exchange"))
        assert "ShuffledRowRDD" not in part.rdd.toDebugString().decode()
    told = training.train(df, roles, maxIter=1)
    assert told.holdout.count() == 80 and "InMemory" not in _plan(told.holdout)


def test_cross_validation(spark, customers):
    rows = training.cross_validate(customers, ROLES, NOT_FEATURES, folds=2, maxIter=1).collect()
    assert {r["metric"] for r in rows} == {"recall", "roc_auc", "avg_precision"}
    assert all(0 < r["mean"] <= 1 for r in rows)


def brute_shapley(x, rules: LeafRules, n_features: int) -> np.ndarray:
    """Shapley values from the definition: all subsets of all features."""
    def value(known):
        total = 0.0
        for r in range(len(rules.value)):
            path = 1.0
            for k in range(rules.feature.shape[1]):
                lo, hi = rules.low[r, k], rules.high[r, k]
                passes = float(lo < x[rules.feature[r, k]] <= hi)
                path *= passes if rules.feature[r, k] in known or rules.share[r, k] == 1 else rules.share[r, k]
            total += rules.value[r] * path
        return total

    phi = np.zeros(n_features)
    for f in range(n_features):
        others = [j for j in range(n_features) if j != f]
        for size in range(n_features):
            weight = math.factorial(size) * math.factorial(n_features - size - 1) / math.factorial(n_features)
            for subset in itertools.combinations(others, size):
                phi[f] += weight * (value({*subset, f}) - value(set(subset)))
    return phi


@pytest.mark.parametrize("depth", [1, 2, 3])
def test_attribution_equals_the_definition(depth):
    rng = np.random.default_rng(depth)
    rules, features = 6, 4
    picked = np.array([rng.choice(features, depth, replace=False) for _ in range(rules)])
    low = np.where(rng.random((rules, depth)) < .5, -np.inf, rng.random((rules, depth)) / 2)
    high = np.where(np.isinf(low), rng.random((rules, depth)), np.inf)
    made = LeafRules(rng.normal(size=rules), picked, low, high, rng.random((rules, depth)) * 0.9)
    x = rng.random((5, features))
    got = _attribute(x, made, _groups(picked), features)
    for row, phi in zip(x, got):
        assert phi == pytest.approx(brute_shapley(row, made, features), abs=1e-12)


@pytest.fixture(scope="module")
def explained(spark, customers, fitted):
    return Explainer.of(spark, fitted.model), training.model_frame(customers, ROLES, NOT_FEATURES)


def test_attributions_add_up(explained):
    ex, frame = explained
    assert ex.additivity_gap(frame, "account_id").agg(F.max(F.abs("gap"))).first()[0] < 1e-9


def test_drivers(explained):
    ex, frame = explained
    top = ex.global_drivers(frame, 5).collect()
    assert [r["mean_abs"] for r in top] == sorted((r["mean_abs"] for r in top), reverse=True)
    assert top[0]["feature"] == "contract_Month-to-month"
    by_hand = ex.values(frame, "account_id").groupBy("feature").agg(F.avg(F.abs("phi")).alias("m"))
    expected = {r["feature"]: r["m"] for r in by_hand.collect()}
    assert all(r["mean_abs"] == pytest.approx(expected[r["feature"]]) for r in top)

    one = frame.where("account_id = '7'")
    five = ex.customer_drivers(one, "account_id").orderBy("rank").collect()
    values = {r["feature"]: r["phi"] for r in ex.values(one, "account_id").collect()}
    ranked = sorted(values, key=lambda f: (-abs(values[f]), f))[:5]
    assert [r["feature"] for r in five] == ranked and [r["rank"] for r in five] == [1, 2, 3, 4, 5]
    assert all(values[r["feature"]] == r["phi"] for r in five)


def test_attribution_runs_once_a_row(explained):
    """No filter that runs the function a second time, and no rows that Python must first hand to Spark."""
    ex, frame = explained
    told = [ex.global_drivers(frame), ex.global_drivers(frame, 5), ex.values(frame, "account_id"), ex.customer_drivers(frame, "account_id"),
            ex.values(frame, "account_id", by_column=True)]
    for df in told:
        assert _plan(df).count("ArrowEvalPython") == 1 and "ExistingRDD" not in _plan(df)


@pytest.mark.parametrize("by_column", [False, True])
@pytest.mark.parametrize("k", [1, 5, 60])
def test_drivers_of_every_customer(explained, k, by_column):
    """Ranked in Arrow batches, no comparison at a time; equal ones, zeros above all, by name; keys may repeat or be missing."""
    ex, frame = explained
    some = frame.where("account_id < '2'").withColumn("id", F.when(F.col("tenure") % 5 == 0, "twice").when(F.col("tenure") % 5 > 1, F.col("account_id")))
    told = ex.customer_drivers(some, "account_id", k, by_column)
    assert "sort" not in _plan(told.select("account_id", "feature")).split("ArrowEvalPython")[0].lower()
    values, got = {}, {}
    for r in ex.values(some, "account_id", by_column).collect():
        values.setdefault(r["account_id"], {})[r["feature"]] = r["phi"]
    for r in told.collect():
        got.setdefault(r["account_id"], []).append((r["rank"], r["feature"], r["phi"]))
    assert len(got) == len(values) > 50
    for account, v in values.items():
        ranked = sorted(v, key=lambda f: (-abs(v[f]), f))[:k]
        full = {f for _, f, _ in got[account]}
        assert full <= set(v) and len(full) == min(k, len(v))
        assert sorted(got[account]) == [(i + 1, f, v[f]) for i, f in enumerate(ranked)]
    keys = ex.customer_drivers(some, "id", k, by_column).groupBy("id").count()
    rows = some.groupBy("id").agg((F.count(F.lit(1)) * len(full)).alias("want"))
    assert keys.join(rows, keys["id"].eqNullSafe(rows["id"]), "full").where("NOT count <=> want").count() == 0


@pytest.mark.parametrize("name", ["global_drivers", "shap_points", "shap_points_check"])
def test_explaining_broadcasts_nothing_that_grows(spark, small, name):
    """Customers, orders and attributions never go through the driver; nations and regions may."""
    shared = [line for line in _plan(catalog.queries()[name](spark, small)).splitlines() if "BroadcastHashJoin" in line]
    assert shared and all("[c_nationkey" in line or "[n_regionkey" in line for line in shared)


def test_check_of_drivers_moves_no_ranked_row_again(spark, small):
    """The account deals both sides of the check, so the ranked rows stay where their ranking put them."""
    plan = _plan(catalog.queries()["customer_drivers_check"](spark, small))
    assert "rank" not in "".join(line for line in plan.splitlines() if "hashpartitioning" in line)


def test_column_view_sums_the_slots(explained):
    ex, frame = explained
    one = frame.where("account_id = '7'")
    slots = {r["feature"]: r["phi"] for r in ex.values(one, "account_id").collect()}
    columns = {r["feature"]: r["phi"] for r in ex.values(one, "account_id", by_column=True).collect()}
    contract = sum(v for f, v in slots.items() if f.startswith("contract_"))
    assert columns["contract"] == pytest.approx(contract) and len(columns) == 15


def test_points_pair_values_with_attributions(explained):
    ex, frame = explained
    dots = ex.points(frame.where("account_id = '7'"), "account_id", ["tenure", "contract_Two year"]).collect()
    row = frame.where("account_id = '7'").first()
    got = {r["feature"]: r["value"] for r in dots}
    assert got == {"tenure": float(row["tenure"]), "contract_Two year": float(row["contract"] == "Two year")}
    assert LOG_ODDS == 2.0


def test_attribution_of_thousands_of_slots(spark):
    """Far more slots than rules: no dense row is made, and what no rule reads is zero."""
    rng = np.random.default_rng(4)
    rows = [(f"c{i}", f"level{i % 5000}", float(rng.integers(0, 60)), int(rng.random() < (0.8 if i % 7 == 0 else 0.2)), float(i % 7 == 0))
            for i in range(10_000)]
    df = spark.createDataFrame(rows, "id string, town string, tenure double, churned int, seven double")
    roles = Roles(id="id", label="churned", tenure="tenure")
    model = training.fit(df, roles, maxIter=3, maxDepth=2)
    ex = Explainer.of(spark, model)
    assert len(ex.names()) == 5002 and len(ex.read()) <= 9
    few = df.limit(50)
    assert ex.additivity_gap(few, "id").agg(F.max(F.abs("gap"))).first()[0] < 1e-9
    assert ex.values(few, "id").count() == 50 * 5002
    assert ex.global_drivers(df).count() == 5002 and ex.global_drivers(df, 1).first()["feature"] == "seven"
    assert ex.customer_drivers(few, "id").groupBy("id").count().where("count <> 5").count() == 0
    dots = ex.points(few, "id", ["seven", "town_level3"]).collect()
    assert len(dots) == 100 and all(r["phi"] == 0 for r in dots if r["feature"] == "town_level3" and "town_level3" not in ex.read())
    assert {r["id"]: r["value"] for r in dots if r["feature"] == "seven"} == {r["id"]: r["seven"] for r in few.collect()}
