"""Boosted ensembles read at several lengths and with penalised leaves: many settings of a search from one fit.

Boosting is nested: the first n trees of an ensemble are the ensemble of n trees. A row's margin after each tree is a
running sum of leaf values, so one pass scores a table under all lengths. Penalties change leaf values, not splits: with the sums of
gradients G and curvatures H of the rows in a leaf, at the margin before its tree, the penalised value is the fitted one times
soft(G, l1) / G * H / (H + l2). One aggregation by tree and leaf serves all penalties.

What reaches the driver is bounded by trees x leaves, which the parameters set.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.sources.storage import fresh_path, removed, replaced

ROWS = 512
LEAF = "__leaf"
_NODE = ("treeID", "nodeData.id", "nodeData.prediction", "nodeData.leftChild", "nodeData.rightChild")


@dataclass(frozen=True)
class Reading:
    """One way to read an ensemble: its first ``trees`` trees, with leaf penalties."""

    trees: int
    l1: float = 0.0
    l2: float = 0.0


@dataclass(frozen=True)
class Leaves:
    """Leaf values times the tree's weight, by (tree, leaf from the left), padded with 0; and each leaf's node."""

    values: np.ndarray
    nodes: np.ndarray


def leaves(model: GBTClassificationModel, df: DataFrame) -> Leaves:
    spark = df.sparkSession
    path = fresh_path(spark, "trees")
    model.write().save(path)
    by_tree: dict[int, dict[int, object]] = {}
    for n in spark.read.parquet(f"{path}/data").select(*[F.col(c).alias(c.split(".")[-1]) for c in _NODE]).collect():
        by_tree.setdefault(n["treeID"], {})[n["id"]] = n
    removed(spark, path)
    found = []
    for tree, weight in enumerate(model.treeWeights):
        own, todo = [], [0]
        while todo:
            node = by_tree[tree][todo.pop()]
            if node["leftChild"] < 0:
                own.append((weight * node["prediction"], node["id"]))
            else:
                todo += [node["rightChild"], node["leftChild"]]
        found.append(own)
    shape = (len(found), max(map(len, found)))
    values, nodes = np.zeros(shape), np.full(shape, -1)
    for t, own in enumerate(found):
        values[t, :len(own)], nodes[t, :len(own)] = zip(*own)
    return Leaves(values, nodes)


def with_leaves(df: DataFrame, model: GBTClassificationModel, *keep: str) -> DataFrame:
    """(keep..., leaf): the leaf that each row falls in, per tree."""
    placed = model.copy({model.leafCol: LEAF}).transform(df)
    return placed.select(*keep, vector_to_array(LEAF, "float32").alias("leaf"))


def _places(column: pa.Array, trees: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, trees).astype(np.intp)


def leaf_sums(placed: DataFrame, table: Leaves, label: str, weight: str) -> DataFrame:
    """(tree, leaf, n, g, h) over rows of (leaf, label, weight): gradients and curvatures of the log-loss in log-odds."""
    values = table.values
    trees, width = values.shape
    at = np.arange(trees)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((3, trees * width))
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                part = batch.slice(start, ROWS)
                leaf = _places(part.column(0), trees)
                y, w = (part.column(k).to_numpy(zero_copy_only=False).astype(float)[:, None] for k in (1, 2))
                step = values[at, leaf]
                before = np.cumsum(step, axis=1) - step
                p = 1 / (1 + np.exp(-2 * before))
                cell = (at * width + leaf).ravel()
                for k, v in enumerate((np.ones_like(p), w * (p - y), w * p * (1 - p))):
                    sums[k] += np.bincount(cell, v.ravel(), trees * width)
        cells = np.flatnonzero(sums[0])
        yield pa.RecordBatch.from_arrays(
            [pa.array((cells // width).astype(np.int32)), pa.array((cells % width).astype(np.int32)),
             pa.array(sums[0, cells].astype(np.int64)), pa.array(sums[1, cells]), pa.array(sums[2, cells])],
            ["tree", "leaf", "n", "g", "h"])

    rows = placed.select("leaf", F.col(label).cast("double"), F.col(weight).cast("double"))
    return rows.mapInArrow(run, "tree int, leaf int, n long, g double, h double").groupBy("tree", "leaf").agg(
        *[F.sum(c).alias(c) for c in ("n", "g", "h")])


def penalised(table: Leaves, sums: DataFrame, l1: float, l2: float) -> Leaves:
    """Leaf values under the penalties; a leaf without rows keeps its value."""
    if not l1 and not l2:
        return table
    ratio = np.ones_like(table.values)
    for r in sums.collect():  # trees x leaves rows at most
        g = abs(r["g"])
        soft = max(g - l1, 0.0) / g if g else 1.0
        ratio[r["tree"], r["leaf"]] = soft * (r["h"] / (r["h"] + l2) if r["h"] + l2 > 0 else 1.0)
    return Leaves(table.values * ratio, table.nodes)


def readings_scored(
    placed: DataFrame, tables: Sequence[Leaves], readings: Sequence[Reading], keep: Sequence[str], name: str = "scores"
) -> DataFrame:
    """(keep..., scores): the probability under each reading; tables[i] holds the leaves of readings[i]."""
    trees = tables[0].values.shape[0]
    at = np.arange(trees)
    distinct = {id(t): t for t in tables}
    picks = {k: [i for i, t in enumerate(tables) if id(t) == k] for k in distinct}
    last = {k: np.array([readings[i].trees for i in own]) - 1 for k, own in picks.items()}

    @F.arrow_udf("array<double>")
    def scores(leaf: pa.Array) -> pa.Array:
        place = _places(leaf, trees)
        out = np.empty((len(place), len(readings)))
        for start in range(0, len(place), ROWS):
            part = place[start:start + ROWS]
            for k, table in distinct.items():
                out[start:start + ROWS, picks[k]] = np.cumsum(table.values[at, part], axis=1)[:, last[k]]
        ends = np.arange(0, out.size + 1, len(readings), dtype=np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array((1 / (1 + np.exp(-2 * out))).ravel()))

    return placed.select(*keep, scores("leaf").alias(name))


def refitted(model: GBTClassificationModel, table: Leaves, df: DataFrame) -> GBTClassificationModel:
    """The model with the leaf values of ``table``: saved, its node table changed, and loaded again."""
    spark = df.sparkSession
    path = fresh_path(spark, "trees")
    model.write().save(path)
    rows = [
        (t, int(node), float(table.values[t, k] / weight)) for t, weight in enumerate(model.treeWeights)
        for k, node in enumerate(table.nodes[t]) if node >= 0 and weight
    ]
    new = spark.createDataFrame(rows, "treeID int, __id int, __value double")
    data = spark.read.parquet(f"{path}/data")
    on = (data["treeID"] == new["treeID"]) & (data["nodeData.id"] == new["__id"])
    value = F.coalesce("__value", "nodeData.prediction")
    changed = data.join(new, on, "left").select(
        *[F.col("nodeData").withField("prediction", value).alias(c) if c == "nodeData" else data[c] for c in data.columns])
    changed.write.parquet(f"{path}/data-new")
    replaced(spark, f"{path}/data-new", f"{path}/data")
    found = GBTClassificationModel.load(path)
    removed(spark, path)
    return found
