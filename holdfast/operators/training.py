"""Training, tuning and validating the churn classifier with Spark ML."""

from __future__ import annotations

import random
import statistics
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import OneHotEncoder, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from holdfast.functions.rules import DECISION_THRESHOLD, with_segments
from holdfast.operators import metrics
from holdfast.operators.boosting import Binned, binned, fitted
from holdfast.operators.sampling import SEED, stratified_folds, stratified_split
from holdfast.operators.segments import class_weight
from holdfast.operators.stages import Reading, leaf_sums, leaves, penalised, readings_scored, refitted, with_leaves
from holdfast.schema import Roles, split_by_type
from holdfast.sources.storage import ensure_checkpoint_dir, kept

FEATURES, WEIGHT = "features", "__weight"

# The tuned model, and the lists the search draws from. ``spark_params``
# translates the names; the penalties are applied to the leaves afterwards (see ``stages``).
MODEL_PARAMS: dict[str, object] = {
    "maxIter": 400, "maxDepth": 2, "stepSize": 0.05,
    "subsamplingRate": 0.9, "featureSubsetStrategy": "0.8",
}
SEARCH_SPACE: dict[str, list] = {
    "maxIter": [300, 400, 500, 700, 900],
    "maxDepth": [2, 3, 4, 5],
    "stepSize": [0.015, 0.02, 0.03, 0.05],
    "subsamplingRate": [0.8, 0.9, 1.0],
    "featureSubsetStrategy": ["0.8", "0.9", "1.0"],
    "min_child_weight": [1, 2, 3, 5],
    "gamma": [0.0, 0.1, 0.2],
    "reg_lambda": [1.0, 1.5, 2.0],
    "reg_alpha": [0.0, 0.05, 0.1],
}
# What a draw sets after the trees have grown.
READ = ("maxIter", "reg_lambda", "reg_alpha")


def spark_params(draw: Mapping[str, object], rows: int) -> dict[str, object]:
    """A draw in the names of Spark's classifier.

    ``gamma`` is the least gain of a split summed over all rows; Spark's is per row.
    """
    out = dict(draw)
    if "min_child_weight" in out:
        out["minInstancesPerNode"] = out.pop("min_child_weight")
    if "gamma" in out:
        out["minInfoGain"] = out.pop("gamma") / max(rows, 1)
    return out


def positive_probability(column: str = "probability") -> Column:
    return vector_to_array(F.col(column))[1]


# --- features ------------------------------------------------------------------------

def model_frame(df: DataFrame, roles: Roles = Roles(), drop: Sequence[str] = ()) -> DataFrame:
    """Cleaned customers with the derived segments and without the columns named in ``drop``."""
    return with_segments(df, roles).drop(*drop)


def feature_stages(df: DataFrame, roles: Roles = Roles()) -> list:
    """One column per known category, then the numeric columns as they are.

    Categories get an index with one more slot for unknown values; that last slot is
    dropped, so a value never seen in training becomes all zeros.
    """
    numeric, categorical = split_by_type(df, exclude=(roles.id, roles.label, WEIGHT, "split", "fold"))
    indexed, slots = [f"{c}__index" for c in categorical], [f"{c}__slots" for c in categorical]
    stages = []
    if categorical:
        stages = [
            StringIndexer(inputCols=categorical, outputCols=indexed, handleInvalid="keep",
                          stringOrderType="alphabetAsc"),
            OneHotEncoder(inputCols=indexed, outputCols=slots, dropLast=True),
        ]
    return [*stages, VectorAssembler(inputCols=slots + numeric, outputCol=FEATURES, handleInvalid="keep")]


def check_levels(df: DataFrame, columns: Sequence[str], most: int | None) -> None:
    """Refuse text columns with more than ``most`` values, if that is asked for.

    The category list of each column reaches the driver, so a caller who does not know the columns can bound it.
    """
    if not columns or most is None:
        return
    counts = df.agg(*[F.approx_count_distinct(c).alias(c) for c in columns]).first()
    wide = [f"{c} (~{counts[c]})" for c in columns if counts[c] > most]
    if wide:
        raise ValueError(f"more than {most} categories in: " + ", ".join(wide))


def fit_features(df: DataFrame, roles: Roles = Roles(), most_levels: int | None = None) -> PipelineModel:
    stages = feature_stages(df, roles)
    if isinstance(stages[0], StringIndexer):
        check_levels(df, stages[0].getInputCols(), most_levels)
    return Pipeline(stages=stages).fit(df)


def _stage(model: PipelineModel, kind: type):
    return next((s for s in model.stages if isinstance(s, kind)), None)


def category_levels(model: PipelineModel) -> dict[str, list[str]]:
    indexer = _stage(model, StringIndexerModel)
    return {} if indexer is None else dict(zip(indexer.getInputCols(), map(list, indexer.labelsArray)))


def input_columns(model: PipelineModel) -> list[str]:
    """Columns a table must have to be scored."""
    levels = category_levels(model)
    numeric = [c for c in _stage(model, VectorAssembler).getInputCols() if not c.endswith("__slots")]
    return [*levels, *numeric]


def feature_sources(model: PipelineModel) -> list[tuple[str, str]]:
    """(feature name, source column) per slot of the feature vector, in order."""
    levels = category_levels(model)
    slots = [(f"{c}_{level}", c) for c, values in levels.items() for level in values]
    return slots + [(c, c) for c in input_columns(model) if c not in levels]


def feature_names(df: DataFrame, model: PipelineModel) -> DataFrame:
    """(position, feature, source) of the feature vector."""
    rows = [(i, name, source) for i, (name, source) in enumerate(feature_sources(model))]
    return df.sparkSession.createDataFrame(rows, "position int, feature string, source string")


def one_hot(df: DataFrame, model: PipelineModel, id_col: str) -> DataFrame:
    """(id, feature): the categorical features that are set for each row."""
    slots = [name for name, source in feature_sources(model) if source in category_levels(model)]
    values = vector_to_array(F.col(FEATURES))
    pair = F.posexplode(F.slice(values, 1, len(slots))).alias("i", "v")
    names = F.array(*[F.lit(s) for s in slots])
    return (
        model.transform(df).select(id_col, pair).where(F.col("v") != 0)
        .select(id_col, names[F.col("i")].alias("feature"))
    )


# --- model ---------------------------------------------------------------------------

def classifier(roles: Roles = Roles(), seed: int = SEED, **params: object) -> GBTClassifier:
    settings = {**MODEL_PARAMS, **params}
    return GBTClassifier(
        featuresCol=FEATURES, labelCol=roles.label, weightCol=WEIGHT, lossType="logistic",
        seed=seed, checkpointInterval=10, cacheNodeIds=True, maxMemoryInMB=512, **settings,
    )


def label_balance(df: DataFrame, label: str) -> tuple[int, float]:
    """Rows, and negatives per positive, as numbers for the fit (one row is read)."""
    row = class_weight(df, label).first()
    return row["neg"] + row["pos"], row["weight"]


def _encoded(df: DataFrame, encoder: PipelineModel, roles: Roles, weight: float, *keep: str) -> DataFrame:
    """The columns a fit reads: features, label and class weight."""
    y = F.col(roles.label)
    return encoder.transform(df).select(
        FEATURES, y.cast("double").alias(roles.label),
        F.when(y == 1, F.lit(weight)).otherwise(F.lit(1.0)).alias(WEIGHT), *keep,
    )


def grow(train: DataFrame, roles: Roles, seed: int, rows: int, **params: object) -> GBTClassificationModel:
    """Boosted trees over encoded rows; leaves with the penalties asked for."""
    l1, l2 = (float(params.pop(k, 0.0)) for k in ("reg_alpha", "reg_lambda"))
    data = binned(train, FEATURES, roles.label, WEIGHT)
    try:
        trees = fitted(classifier(roles, seed, **spark_params(params, rows)), data)
    finally:
        data.release()
    if not l1 and not l2:
        return trees
    plain = leaves(trees, train)
    sums = leaf_sums(with_leaves(train, trees, roles.label, WEIGHT), plain, roles.label, WEIGHT)
    return refitted(trees, penalised(plain, sums, l1, l2), train)


def fit(df: DataFrame, roles: Roles = Roles(), seed: int = SEED, **params: object) -> PipelineModel:
    """Fit encoder and boosted trees; positives weigh negatives / positives.

    ``params`` are those of Spark's classifier or of ``SEARCH_SPACE``.
    """
    ensure_checkpoint_dir(df.sparkSession)
    encoder = fit_features(df, roles)
    n, weight = label_balance(df, roles.label)
    trees = grow(_encoded(df, encoder, roles, weight), roles, seed, n, **params)
    return PipelineModel(stages=[*encoder.stages, trees])


def probabilities(df: DataFrame, model: PipelineModel, name: str = "score") -> DataFrame:
    """Add the probability of churn, keeping only the columns of ``df``."""
    return model.transform(df).select(*df.columns, positive_probability().alias(name))


def evaluate(
    scored: DataFrame, roles: Roles = Roles(), score: str = "score", threshold: float = DECISION_THRESHOLD
) -> dict[str, float]:
    """Exact ROC-AUC, average precision and the counts at ``threshold``; two one-row results.

    The scored rows are cached, so that the model runs once.
    """
    scored = scored.select(score, roles.label).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        matrix = metrics.confusion(scored, score, roles.label, threshold).first().asDict()
        quality = metrics.ranking_quality(scored, score, roles.label).first().asDict()
    finally:
        scored.unpersist()
    found = matrix["tp"] + matrix["fn"]
    recall = matrix["tp"] / found if found else 0.0
    return {**quality, "recall": recall, **matrix}


@dataclass(frozen=True)
class Trained:
    model: PipelineModel
    metrics: dict[str, float]
    holdout: DataFrame  # scored holdout rows
    params: dict[str, object] = field(default_factory=dict)

    @property
    def feature_names(self) -> list[str]:
        return [name for name, _ in feature_sources(self.model)]


def train(
    df: DataFrame, roles: Roles = Roles(), drop: Sequence[str] = (), test_fraction: float = 0.2,
    seed: int = SEED, threshold: float = DECISION_THRESHOLD, path: str | None = None, **params: object,
) -> Trained:
    """Derive, split, weight, fit and evaluate; with ``path`` also save the model there."""
    rows, held = _train_and_holdout(df, roles, drop, test_fraction, seed)
    model = fit(rows, roles, seed, **params)
    holdout = probabilities(held, model)
    found = evaluate(holdout, roles, threshold=threshold)
    if path is not None:
        save(model, path)
    return Trained(model, found, holdout, {**MODEL_PARAMS, **params})


def _train_and_holdout(
    df: DataFrame, roles: Roles, drop: Sequence[str], test_fraction: float, seed: int
) -> tuple[DataFrame, DataFrame]:
    """Training rows and holdout rows, from one table in the checkpoint folder.

    The split reads the rows three times and its checkpoint twice, so they are worked out once and cached until it is there.
    """
    ensure_checkpoint_dir(df.sparkSession)
    frame = model_frame(df, roles, drop).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        split = stratified_split(frame, roles.id, roles.label, test_fraction, seed).checkpoint()
    finally:
        frame.unpersist()
    return split.where(F.col("split") == "train").drop("split"), split.where(F.col("split") == "test").drop("split")


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)


# --- search --------------------------------------------------------------------------

def draw_params(n: int, seed: int = SEED, space: Mapping[str, Sequence] = SEARCH_SPACE) -> list[dict]:
    """``n`` different combinations of the lists in ``space``, drawn with a seed."""
    total = 1
    for values in space.values():
        total *= len(values)
    out = []
    for number in random.Random(seed).sample(range(total), min(n, total)):
        combination = {}
        for name, values in space.items():
            number, at = divmod(number, len(values))
            combination[name] = values[at]
        out.append(combination)
    return out


@dataclass(frozen=True)
class Tuned:
    model: PipelineModel
    draws: list[dict]
    averages: list[float]
    deviations: list[float]
    metrics: dict[str, float]

    @property
    def best(self) -> int:
        return max(range(len(self.averages)), key=self.averages.__getitem__)


def grown(draws: Sequence[Mapping]) -> dict[tuple, list[int]]:
    """Draws that differ only in what is set after growing, by the parameters they share."""
    groups: dict[tuple, list[int]] = {}
    for i, draw in enumerate(draws):
        groups.setdefault(tuple(sorted((k, v) for k, v in draw.items() if k not in READ)), []).append(i)
    return groups


def _reading(draw: Mapping[str, object]) -> Reading:
    return Reading(int(draw.get("maxIter", MODEL_PARAMS["maxIter"])), float(draw.get("reg_alpha", 0.0)), float(draw.get("reg_lambda", 0.0)))


def _fold_areas(
    train: DataFrame, data: Binned, held: DataFrame, shared: Mapping[str, object], draws: Sequence[Mapping], rows: int, roles: Roles, seed: int
) -> list[float]:
    """ROC-AUC on encoded ``held`` of draws that share how trees grow: one fit of the longest, read in all their ways."""
    readings = [_reading(d) for d in draws]
    longest = max(r.trees for r in readings)
    trees = fitted(classifier(roles, seed, **spark_params({**shared, "maxIter": longest}, rows)), data)
    plain = leaves(trees, train)
    sums = None
    tables = {(0.0, 0.0): plain}
    for r in readings:
        if (r.l1, r.l2) not in tables:
            if sums is None:
                sums = leaf_sums(with_leaves(train, trees, roles.label, WEIGHT), plain, roles.label, WEIGHT).persist()
            tables[r.l1, r.l2] = penalised(plain, sums, r.l1, r.l2)
    if sums is not None:
        sums.unpersist()
    scored = readings_scored(
        with_leaves(held, trees, roles.label), [tables[r.l1, r.l2] for r in readings], readings, [roles.label])
    long = scored.select(roles.label, F.posexplode("scores").alias("reading", "score"))
    found = {r["reading"]: r["roc_auc"] for r in metrics.roc_auc_by(long, "reading", "score", roles.label).collect()}
    return [found.get(i) or 0.0 for i in range(len(draws))]


def tune(
    df: DataFrame, roles: Roles = Roles(), drop: Sequence[str] = (), n_iter: int = 20, folds: int = 5,
    test_fraction: float = 0.2, seed: int = SEED, threshold: float = DECISION_THRESHOLD,
    space: Mapping[str, Sequence] = SEARCH_SPACE, parallelism: int = 4, path: str | None = None,
) -> Tuned:
    """Randomised search by cross-validated ROC-AUC, refit on all training rows.

    Each fold fits its encoder and class weight on its own training rows.  Draws that differ only in the number of trees and in
    leaf penalties share one fit per fold.  ``parallelism`` fits run at a time.
    """
    ensure_checkpoint_dir(df.sparkSession)
    rows, held = _train_and_holdout(df, roles, drop, test_fraction, seed)
    draws = draw_params(n_iter, seed, space)
    groups = grown(draws)
    areas: list[list[float]] = [[] for _ in draws]
    folded = kept(stratified_folds(rows, roles.id, roles.label, folds, seed))
    for k in range(folds):
        train, test, n = _encoded_fold(folded, k, roles)
        train.persist(StorageLevel.MEMORY_AND_DISK)
        test.persist(StorageLevel.MEMORY_AND_DISK)
        data = binned(train, FEATURES, roles.label, WEIGHT)
        try:
            with ThreadPoolExecutor(parallelism) as pool:
                done = [
                    (own, pool.submit(_fold_areas, train, data, test, dict(shared), [draws[i] for i in own], n, roles, seed))
                    for shared, own in groups.items()
                ]
            for own, job in done:
                for i, area in zip(own, job.result()):
                    areas[i].append(area)
        finally:
            data.release()
            train.unpersist()
            test.unpersist()
    averages = [statistics.fmean(a) for a in areas]
    best = draws[max(range(len(draws)), key=averages.__getitem__)]
    model = fit(rows, roles, seed, **best)
    quality = evaluate(probabilities(held, model), roles, threshold=threshold)
    if path is not None:
        save(model, path)
    return Tuned(model, draws, averages, [statistics.pstdev(a) for a in areas], quality)


def _encoded_fold(folded: DataFrame, k: int, roles: Roles) -> tuple[DataFrame, DataFrame, int]:
    """Training and held rows of a fold, encoded by what the training rows alone tell, and the number of the former."""
    train, held = (folded.where(c).drop("fold") for c in (F.col("fold") != k, F.col("fold") == k))
    n, weight = label_balance(train, roles.label)
    encoder = fit_features(train, roles)
    return _encoded(train, encoder, roles, weight), _encoded(held, encoder, roles, weight), n


def search_report(df: DataFrame, tuned: Tuned) -> DataFrame:
    """(draw, params, mean_roc_auc, std_roc_auc, best), one row per combination tried."""
    rows = [
        (i, ", ".join(f"{k}={v}" for k, v in d.items()), float(m), float(s), i == tuned.best)
        for i, (d, m, s) in enumerate(zip(tuned.draws, tuned.averages, tuned.deviations))
    ]
    return df.sparkSession.createDataFrame(
        rows, "draw int, params string, mean_roc_auc double, std_roc_auc double, best boolean")


def cross_validate(
    df: DataFrame, roles: Roles = Roles(), drop: Sequence[str] = (), folds: int = 5, seed: int = SEED,
    threshold: float = DECISION_THRESHOLD, **params: object,
) -> DataFrame:
    """(metric, mean, std) of ROC-AUC, average precision and recall over stratified folds."""
    ensure_checkpoint_dir(df.sparkSession)
    frame = model_frame(df, roles, drop).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        folded = kept(stratified_folds(frame, roles.id, roles.label, folds, seed))
    finally:
        frame.unpersist()
    results = []
    for k in range(folds):
        train, held, n = _encoded_fold(folded, k, roles)
        trees = grow(train, roles, seed, rows=n, **params)
        scored = trees.transform(held).select(roles.label, positive_probability().alias("score"))
        results.append(evaluate(scored, roles, threshold=threshold))
    rows = []
    for name in ("recall", "roc_auc", "avg_precision"):
        values = [r[name] for r in results if r[name] is not None]
        rows.append((name, statistics.fmean(values), statistics.pstdev(values)))
    return df.sparkSession.createDataFrame(rows, "metric string, mean double, std double")
