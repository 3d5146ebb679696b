"""Boosted trees over binned columns, against Spark's own classifier and in all their ways."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from holdfast.operators import boosting, training
from holdfast.plans import catalog
from holdfast.schema import Roles

ROLES = Roles(id="id", label="churned", tenure="tenure")


def made(spark, rows=3000):
    """Three numbers of few values and two categories, one of them with NULLs."""
    rng = np.random.default_rng(3)
    out = []
    for i in range(rows):
        a, b, c = int(rng.integers(0, 30)), int(rng.integers(0, 25)), int(rng.integers(0, 2))
        town, plan = ["x", "y", "z", None][int(rng.integers(0, 4))], ["k", "l"][int(rng.integers(0, 2))]
        p = 0.1 + 0.3 * (a < 11) + 0.3 * (town == "y") * (b > 8) + 0.2 * (plan == "k") * (a > 17)
        out.append((f"c{i}", town, plan, float(a), float(b), c, int(rng.random() < p)))
    return spark.createDataFrame(out, "id string, town string, plan string, tenure double, b double, c int, churned int").repartition(3)


def encoder(spark):
    return training.fit_features(made(spark), ROLES)


@pytest.fixture(scope="module")
def rows(spark):
    training.ensure_checkpoint_dir(spark)
    train = training._encoded(made(spark), encoder(spark), ROLES, 1.7, "id").checkpoint()
    data = boosting.binned(train, training.FEATURES, "churned", training.WEIGHT)
    yield train, data
    data.release()


def scores(model, df):
    return np.array([r[1] for r in sorted(model.transform(df).select("id", training.positive_probability()).collect())])


@pytest.mark.parametrize("depth, least, gain", [(0, 1, 0.0), (2, 1, 0.0), (4, 60, 0.0), (3, 1, 0.01)])
def test_trees_are_those_of_sparks_classifier(rows, depth, least, gain):
    """Where all rows and features are used and no number has more than 32 values, nothing is left to draws or to cuts."""
    train, data = rows
    setup = training.classifier(
        ROLES, maxIter=6, maxDepth=depth, subsamplingRate=1.0, featureSubsetStrategy="all", minInstancesPerNode=least, minInfoGain=gain)
    own, other = boosting.fitted(setup, data), setup.fit(train)
    assert own.totalNumNodes == other.totalNumNodes and own.treeWeights == other.treeWeights
    assert np.abs(scores(own, train) - scores(other, train)).max() < 1e-9
    assert np.abs(own.featureImportances.toArray() - other.featureImportances.toArray()).max() < 1e-9


def test_one_task_and_many_jobs_grow_the_same(rows, monkeypatch):
    train, data = rows
    setup = training.classifier(ROLES, maxIter=20, maxDepth=3, featureSubsetStrategy="0.6", subsamplingRate=0.8)
    one = scores(boosting.fitted(setup, data), train)
    monkeypatch.setattr(boosting, "FEW_NODES", 0)  # built by Spark's reader
    assert np.array_equal(one, scores(boosting.fitted(setup, data), train))
    monkeypatch.setattr(boosting, "ROWS", 700)
    assert data.partitions == 5
    assert np.abs(one - scores(boosting.fitted(setup, data), train)).max() < 1e-9
    # a saved model is the model
    model = boosting.fitted(setup, data)
    path = boosting.fresh_path(train.sparkSession, "model")
    model.write().save(path)
    assert np.array_equal(scores(type(model).load(path), train), scores(model, train))


def test_cuts_see_all_rows(monkeypatch):
    """Equal shares of all values, however the rows are cut into summaries; one rare value of few still has its cut."""
    x = np.random.default_rng(1).exponential(size=200_000)
    parts = [boosting._summary(p) for p in np.array_split(np.sort(x), 9)]
    cuts = boosting._cuts(*(np.concatenate([p[k] for p in parts]) for k in (0, 1)))
    assert len(cuts) == 31 and np.abs(np.searchsorted(np.sort(cuts), x).mean() - 15.5) < 0.2
    shares = np.bincount(np.searchsorted(cuts, x)) / len(x)
    assert shares.max() < 1.2 / 32 and shares.min() > 0.8 / 32
    assert boosting._cuts(*boosting._summary(np.array([0.0] * 9999 + [1.0]))).tolist() == [0.5]


def test_codes_come_apart():
    columns = boosting.Columns(7, ((0, 3), (3, 2)), np.array([5, 6]), (np.array([1.5, 2.5]), np.arange(700.0)))
    assert [sorted(own) for own in columns.groups] == [[0, 1, 2], [3]]
    rng = np.random.default_rng(0)
    cells = np.stack([rng.integers(0, w, 500) for w in columns.widths])
    codes = [np.ravel_multi_index(tuple(cells[own]), size) for own, size in zip(columns.groups, columns.sizes)]
    h = np.concatenate([np.bincount(c, minlength=np.prod(size)) for c, size in zip(codes, columns.sizes)])[None, None]
    want = np.concatenate([np.bincount(c, minlength=w) for c, w in zip(cells, columns.widths)])
    assert np.array_equal(columns.apart(h)[0, 0], want)


def test_labels_and_weights_are_checked(spark, rows):
    train, _ = rows
    with pytest.raises(Exception, match="labels must be 0 or 1"):
        boosting.binned(train.withColumn("churned", F.lit(2.0)), training.FEATURES, "churned", training.WEIGHT)
    with pytest.raises(Exception, match="labels must be 0 or 1"):
        boosting.binned(train.withColumn("churned", F.lit(None).cast("double")), training.FEATURES, "churned", training.WEIGHT)
    unknown = training._encoded(made(spark, 50).withColumn("tenure", F.lit(None).cast("double")), encoder(spark), ROLES, 1.0)
    with pytest.raises(Exception, match="must not be NaN"):
        boosting.binned(unknown, training.FEATURES, "churned", training.WEIGHT)
    with pytest.raises(ValueError, match="differ"):
        boosting.binned(train.withColumn(training.WEIGHT, F.rand(1)), training.FEATURES, "churned", training.WEIGHT)
    with pytest.raises(ValueError, match="no rows"):
        boosting.binned(train.limit(0), training.FEATURES, "churned", training.WEIGHT)


# --- what the registered queries ask for ---------------------------------------------

def told(monkeypatch, name):
    """The settings a registered query gives to a function of ``training``, which is not run."""
    class Asked(Exception):
        pass

    seen = {}

    def instead(df, roles, drop=(), **more):
        seen.update(more)
        raise Asked

    monkeypatch.setattr(training, name, instead)
    return seen, Asked


def test_report_grows_all_trees(spark, small, monkeypatch):
    """all trees in every fold."""
    seen, asked = told(monkeypatch, "cross_validate")
    with pytest.raises(asked):
        catalog.queries()["cv_report"](spark, small)
    assert seen == {}


def test_explained_model_has_all_trees(fitted):
    """the model behind the attributions."""
    assert fitted.model.stages[-1].getNumTrees == training.MODEL_PARAMS["maxIter"] == 400
    assert fitted.params == training.MODEL_PARAMS


def test_search_draws_from_all_lists(spark, small, monkeypatch):
    """F8: 20 draws over 5 folds from the full lists."""
    seen, asked = told(monkeypatch, "tune")
    with pytest.raises(asked):
        catalog.queries()["tune"](spark, small)
    assert seen == {} and max(training.SEARCH_SPACE["maxIter"]) == 900
