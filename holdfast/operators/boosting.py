"""Gradient-boosted trees over binned columns: the fit of Spark's ``GBTClassifier``, without its jobs per tree.

The method is Spark's: logistic loss on labels -1 and 1, the first tree on the labels, further ones on the gradients with the step size
as their weight, splits by the gain in weighted variance, a share of the features per node, a share of the rows per tree, at most 32
bins of a number. What differs is what a level costs. Rows are binned once: one cell per source column, as the slots of a category
exclude each other, and one code for several columns of few cells. Blocks of codes are dealt to partitions of about ``ROWS`` rows, and a level is one histogram over them. A table of one
partition is fitted inside one task; a larger one takes one job per level, whose tasks send a histogram each. Margins are kept with the
blocks and brought up to date every ``KEPT`` trees.

Cuts come from summaries of all rows (256 values and their weights per task and a million rows), not from a sample of them. Node tables go
through the shared folder. What the driver holds is bounded by trees x nodes and by cells x nodes of a level.
"""

from __future__ import annotations

import functools
import json
import math
import time
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel, TaskContext
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.common import _py2java
from pyspark.ml.linalg import DenseVector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.sources.storage import fresh_path, read_small, removed

ROWS = 1 << 20
BLOCK = 1 << 14
BINS = 32
#: Columns are counted together while the cells of all of them side by side are no more than this.
JOINT = 1024
SUMMARY = 256
KEPT = 16
#: Above this number of nodes Spark's own reader builds the model, below one call per node.
FEW_NODES = 4096
#: Gains that differ by less than this share are equal.
EQUAL = 1e-9
POSITIVE = float(1 << 26)
NODE_SCHEMA = (
    "treeID int, id int, prediction double, stats array<double>, raw long, gain double, left int, right int, "
    "feature int, cut array<double>, categories int")


def picked(vectors: pa.Array, slots: np.ndarray) -> np.ndarray:
    """Values of ``slots`` (ascending) of unwrapped vectors, without a dense row for a sparse one."""
    x = np.zeros((len(vectors), len(slots)))
    if not len(slots):
        return x
    row, index, value = entries(vectors)
    at = np.minimum(np.searchsorted(slots, index), len(slots) - 1)
    hit = slots[at] == index
    x[row[hit], at[hit]] = value[hit]
    return x


def entries(vectors: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, slot and value of what unwrapped vectors hold."""
    kind, indices, values = (vectors.field(k) for k in ("type", "indices", "values"))
    dense = kind.to_numpy(zero_copy_only=False) == 1
    lengths = np.diff(values.offsets.to_numpy())
    row = np.repeat(np.arange(len(vectors)), lengths)
    value = values.flatten().to_numpy(zero_copy_only=False)
    index = np.empty(len(value), np.int64)
    own = dense[row]
    index[~own] = indices.flatten().to_numpy(zero_copy_only=False)
    index[own] = (np.arange(len(value)) - np.repeat(np.cumsum(lengths) - lengths, lengths))[own]
    return row, index, value


# --- columns -------------------------------------------------------------------------

@dataclass(frozen=True)
class Columns:
    """Source columns of a feature vector: runs of slots of one category each, then numbers with their cuts."""

    size: int
    runs: tuple[tuple[int, int], ...]  # first slot, number of slots
    numbers: np.ndarray                # slots
    cuts: tuple[np.ndarray, ...]       # a number is in bin b if it is above cut b - 1 and not above cut b

    @functools.cached_property
    def widths(self) -> np.ndarray:
        """Cells per column: a category has one for no slot, a number one more than cuts."""
        return np.array([n + 1 for _, n in self.runs] + [len(c) + 1 for c in self.cuts], np.int64)

    @functools.cached_property
    def offsets(self) -> np.ndarray:
        return np.concatenate([[0], np.cumsum(self.widths)[:-1]]).astype(np.int64)

    @property
    def cells(self) -> int:
        return int(self.widths.sum())

    @functools.cached_property
    def groups(self) -> list[list[int]]:
        """Columns that share one code, the last of a group varying fastest."""
        out, size = [], JOINT + 1
        for k in np.argsort(self.widths, kind="stable").tolist():
            size *= int(self.widths[k])
            if size > JOINT:
                out.append([])
                size = int(self.widths[k])
            out[-1].append(k)
        return out

    @functools.cached_property
    def sizes(self) -> list[tuple[int, ...]]:
        """Cells of the columns of each group."""
        return [tuple(self.widths[own].tolist()) for own in self.groups]

    @property
    def kind(self) -> np.dtype:
        most = max(map(math.prod, self.sizes))
        return np.dtype(np.uint8 if most <= 1 << 8 else np.uint16 if most <= 1 << 16 else np.uint32)

    def coded(self, vectors: pa.Array) -> np.ndarray:
        """(group, row): the code of each row."""
        out = np.empty((len(self.runs) + len(self.numbers), len(vectors)), np.int64)
        if self.runs:
            for k, (_, n) in enumerate(self.runs):
                out[k] = n
            row, index, value = entries(vectors)
            first = np.array([f for f, _ in self.runs])
            run = np.searchsorted(first, index, side="right") - 1
            here = (run >= 0) & (value != 0)
            row, index, run = row[here], index[here], run[here]
            inside = index < (first + np.array([n for _, n in self.runs]))[run]
            out[run[inside], row[inside]] = (index - first[run])[inside]
        x = picked(vectors, self.numbers)
        for k, cuts in enumerate(self.cuts):
            out[len(self.runs) + k] = np.searchsorted(cuts, x[:, k])
        joint = [np.ravel_multi_index(tuple(out[own]), size) for own, size in zip(self.groups, self.sizes)]
        return np.stack(joint).astype(self.kind)

    def apart(self, h: np.ndarray) -> np.ndarray:
        """(stat, node, cell of a column) of (stat, node, code of a group)."""
        out, start = np.empty((*h.shape[:2], self.cells)), 0
        for own, size in zip(self.groups, self.sizes):
            joint = h[:, :, start:start + math.prod(size)].reshape(*h.shape[:2], *size)
            start += math.prod(size)
            for axis, k in enumerate(own):
                others = tuple(2 + j for j in range(len(own)) if j != axis)
                out[:, :, self.offsets[k]:self.offsets[k] + self.widths[k]] = joint.sum(axis=others)
        return out


def _slots(df: DataFrame, features: str) -> tuple[int, list[tuple[int, int]], list[int]]:
    """Size of the vector, runs of slots of one category and slots of numbers, as the column's metadata tells."""
    told = df.schema[features].metadata["ml_attr"]
    attrs = sorted((a["idx"], kind, a.get("name", "")) for kind, own in told["attrs"].items() for a in own)
    runs: list[list] = []
    numbers = []
    for i, kind, name in attrs:
        if kind != "binary":
            numbers.append(i)
            continue
        source = name.split("__slots_")[0] if "__slots_" in name else f"{i}"
        if runs and runs[-1][2] == source and runs[-1][0] + runs[-1][1] == i:
            runs[-1][1] += 1
        else:
            runs.append([i, 1, source])
    return told["num_attrs"], [(f, n) for f, n, _ in runs], numbers


def _summary(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """At most ``SUMMARY`` values that stand for all of ``x``, and for how many each."""
    values, n = np.unique(x, return_counts=True)
    if len(values) <= SUMMARY:
        return values, n.astype(float)
    total = n.sum()
    at = np.searchsorted(np.cumsum(n), (np.arange(SUMMARY) + 0.5) * total / SUMMARY)
    return values[at], np.full(SUMMARY, total / SUMMARY)


def _cuts(values: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Between all values if they are few, else at equal shares of the rows."""
    values, place = np.unique(values, return_inverse=True)
    n = np.bincount(place, n, len(values))
    if len(values) <= 1:
        return np.zeros(0)
    between = (values[:-1] + values[1:]) / 2
    if len(values) <= BINS:
        return between
    at = np.searchsorted(np.cumsum(n), np.arange(1, BINS) * n.sum() / BINS)
    return between[np.unique(at[at < len(between)])]


def columns_of(df: DataFrame, features: str) -> Columns:
    size, runs, numbers = _slots(df, features)
    slots = np.array(numbers, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0

        def told() -> pa.RecordBatch:
            x = np.concatenate(held)
            found = [_summary(x[:, k]) for k in range(len(slots))]
            kind = pa.list_(pa.float64())
            return pa.RecordBatch.from_arrays(
                [pa.array(slots, pa.int64()), *(pa.array([f[j].tolist() for f in found], kind) for j in (0, 1))], ["slot", "x", "n"])

        for batch in batches:
            held.append(picked(batch.column(0), slots))
            if not np.isfinite(held[-1]).all():
                raise ValueError("vector values must not be NaN or infinite")  # as Spark's classifier has it
            rows += batch.num_rows
            if rows >= ROWS:
                yield told()
                held, rows = [], 0
        if rows:
            yield told()

    parts: dict[int, list] = {s: [] for s in numbers}
    if numbers:
        lean = df.select(F.unwrap_udt(features).alias("v"))
        for r in lean.mapInArrow(run, "slot long, x array<double>, n array<double>").collect():
            parts[r["slot"]].append((r["x"], r["n"]))
    cuts = tuple(
        _cuts(*(np.concatenate([np.array(p[j], float) for p in parts[s]] or [np.zeros(0)]) for j in (0, 1))) for s in numbers)
    return Columns(size, tuple(runs), slots, cuts)


# --- blocks --------------------------------------------------------------------------

@dataclass(frozen=True)
class Binned:
    """Rows of a fit as blocks (part, block, rows, codes, labels), and the weights of its two classes."""

    columns: Columns
    blocks: DataFrame
    rows: int
    weights: tuple[float, float]

    @property
    def partitions(self) -> int:
        return max(1, -(-self.rows // ROWS))

    def dealt(self) -> DataFrame:
        return self.blocks.select("part", "block", "rows", "codes", "y").repartition(self.partitions, "part", "block")

    def release(self) -> None:
        self.blocks.unpersist()


def binned(df: DataFrame, features: str, label: str, weight: str) -> Binned:
    """The rows of ``df``, whose weight depends on the label alone; call ``release`` at the end."""
    columns = columns_of(df, features)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK):
                piece = batch.slice(start, BLOCK)
                y = piece.column(1).to_numpy(zero_copy_only=False).astype(float)
                if not np.isin(y, (0.0, 1.0)).all():
                    raise ValueError("labels must be 0 or 1")
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part], pa.int64()), pa.array([number], pa.int64()), pa.array([piece.num_rows], pa.int64()),
                     pa.array([columns.coded(piece.column(0)).tobytes()], pa.binary()), pa.array([y.astype(np.int8).tobytes()], pa.binary()),
                     *(pa.array([_range(piece.column(2).to_numpy(zero_copy_only=False)[y == k])], pa.list_(pa.float64())) for k in (0, 1))],
                    ["part", "block", "rows", "codes", "y", "w0", "w1"])
                number += 1

    lean = df.select(F.unwrap_udt(features).alias("v"), F.col(label).cast("double"), F.col(weight).cast("double"))
    made = lean.mapInArrow(
        run, "part long, block long, rows long, codes binary, y binary, w0 array<double>, w1 array<double>").persist(StorageLevel.MEMORY_AND_DISK)
    ends = [f(F.col(c)[k]) for c in ("w0", "w1") for k, f in ((0, F.min), (1, F.max))]
    rows, *ends = made.agg(F.sum("rows"), *ends).first()
    if not rows:
        raise ValueError("no rows to fit")
    if ends[0] != ends[1] or ends[2] != ends[3]:
        raise ValueError("the weights of a class differ")
    return Binned(columns, made, rows, tuple(1.0 if w is None else w for w in ends[::2]))


def _range(x: np.ndarray) -> list[float] | None:
    return [float(x.min()), float(x.max())] if len(x) else None


@dataclass
class _Block:
    key: tuple[int, int]
    codes: np.ndarray   # (group, row)
    y: np.ndarray       # -1 or 1
    margin: np.ndarray


def _block(columns: Columns, part: int, number: int, rows: int, codes: bytes, y: bytes) -> _Block:
    return _Block(
        (part, number), np.frombuffer(codes, columns.kind).reshape(-1, rows), 2.0 * np.frombuffer(y, np.int8) - 1.0, np.zeros(rows))


# --- trees ---------------------------------------------------------------------------

@dataclass
class Tree:
    """A tree as a heap: node i has the children 2i + 1 and 2i + 2. ``pick`` is the place of a split among all, -1 in a leaf."""

    pick: np.ndarray
    value: np.ndarray
    count: np.ndarray
    weight: np.ndarray
    gain: np.ndarray
    there: np.ndarray
    depth: int = 0      # levels that have been split

    @classmethod
    def root(cls, depth: int) -> Tree:
        n = 2 ** (depth + 1) - 1
        return cls(np.full(n, -1), np.zeros(n), np.zeros(n), np.zeros(n), np.zeros(n), np.arange(n) == 0)


@dataclass(frozen=True)
class Settings:
    """What a fit sets; ``features`` is the number of features a node may split on."""

    trees: int
    depth: int
    step: float
    rows: float
    features: int
    least: int
    gain: float
    seed: int


class _Splits:
    """All splits of the columns: where a row goes right, and the sums of what goes left."""

    def __init__(self, columns: Columns) -> None:
        self.columns = columns
        runs, offsets = columns.runs, columns.offsets
        self.categories = sum(n for _, n in runs)
        parts = [(np.arange(f, f + n), np.full(n, k), np.arange(n)) for k, (f, n) in enumerate(runs)]
        parts += [
            (np.full(len(c), slot), np.full(len(c), k), np.arange(len(c)))
            for k, (slot, c) in enumerate(zip(columns.numbers, columns.cuts), len(runs))]
        self.slot, self.column, self.at = (np.concatenate([p[j] for p in parts]).astype(np.int64) for j in range(3))
        self.cell = (offsets[self.column] + self.at)[:self.categories]
        sizes = [math.prod(size) for size in columns.sizes]
        self.codes = sum(sizes)
        self.starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
        self.place = {k: (g, axis) for g, own in enumerate(columns.groups) for axis, k in enumerate(own)}
        self.sides: dict[int, np.ndarray] = {}

    def right(self, codes: np.ndarray, pick: int) -> np.ndarray:
        group, axis = self.place[int(self.column[pick])]
        if pick not in self.sides:
            size = self.columns.sizes[group]
            cell = np.arange(size[axis])
            goes = cell == self.at[pick] if pick < self.categories else cell > self.at[pick]
            shape = [-1 if j == axis else 1 for j in range(len(size))]
            self.sides[pick] = np.broadcast_to(goes.reshape(shape), size).ravel()
        return self.sides[pick][codes[group]]

    def left(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(stat, node, split) of what goes left, and (stat, node, 1) of all, from (stat, node, cell)."""
        offsets, widths = self.columns.offsets, self.columns.widths
        runs = len(self.columns.runs)
        # any column's cells add up to the node
        total = h[:, :, offsets[0]:offsets[0] + widths[0]].sum(axis=2, keepdims=True)
        out = [total - h[:, :, self.cell]]
        for k in range(runs, len(widths)):
            out.append(np.cumsum(h[:, :, offsets[k]:offsets[k] + widths[k] - 1], axis=2))
        return np.concatenate(out, axis=2), total

    def node(self, pick: int) -> tuple[int, list[float], int]:
        """Slot, cut or left categories, and number of categories, as Spark stores them."""
        slot = int(self.slot[pick])
        if pick < self.categories:
            return slot, [0.0], 2
        column = self.column[pick] - len(self.columns.runs)
        return slot, [float(self.columns.cuts[column][self.at[pick]])], -1


def _moved(splits: _Splits, tree: Tree, codes: np.ndarray) -> np.ndarray:
    """Place of each row in the lowest level of ``tree``; below a leaf it is always the left one."""
    place = np.zeros(codes.shape[1], np.uint8 if tree.depth <= 8 else np.int64)
    for level in range(tree.depth):
        right = np.zeros(len(place), bool)
        for i in range(2 ** level):
            pick = tree.pick[2 ** level - 1 + i]
            if pick >= 0:
                side = splits.right(codes, pick)
                right |= side & (place == i) if level else side
        place = place * 2 + right
    return place


def _lowest(tree: Tree) -> np.ndarray:
    """Values by place in the lowest level, those of leaves above handed down."""
    value = tree.value[:1]
    for level in range(tree.depth):
        first = 2 ** level - 1
        split = tree.pick[first:first + 2 ** level] >= 0
        below = tree.value[2 * first + 1:2 * first + 1 + 2 ** (level + 1)]
        value = np.where(np.repeat(split, 2), below, np.repeat(value, 2))
    return value


def _add(splits: _Splits, block: _Block, tree: Tree, weight: float) -> None:
    block.margin = block.margin + (weight * _lowest(tree))[_moved(splits, tree, block.codes)]


def _histogram(splits: _Splits, block: _Block, tree: Tree, number: int, s: Settings, weights: tuple[float, float]) -> np.ndarray:
    """(positives, negatives, gradients) by node of the lowest level and code, over the rows that the tree takes."""
    y = block.y
    residual = y if number == 0 else 4.0 * y / (1.0 + np.exp(2.0 * y * block.margin))
    kind = np.where(y > 0, POSITIVE, 1.0)
    weighed = residual * np.where(y > 0, weights[1], weights[0])
    if s.rows < 1.0:
        taken = np.random.default_rng([s.seed, number, *block.key]).random(len(y)) < s.rows
        kind, weighed = kind * taken, weighed * taken
    nodes, codes = 2 ** tree.depth, splits.codes
    keys = (block.codes + splits.starts[:, None] + _moved(splits, tree, block.codes).astype(np.int64) * codes).ravel()
    groups = len(block.codes)
    packed = np.bincount(keys, np.tile(kind, groups), nodes * codes)
    sums = np.bincount(keys, np.tile(weighed, groups), nodes * codes)
    positive = np.floor(packed / POSITIVE)
    return np.stack([positive, packed - positive * POSITIVE, sums]).reshape(3, nodes, codes)


def _split(splits: _Splits, tree: Tree, h: np.ndarray, number: int, s: Settings, weights: tuple[float, float]) -> bool:
    """Splits the lowest level where that gains; whether any node was."""
    level = tree.depth
    first, nodes = 2 ** level - 1, 2 ** level
    left, total = splits.left(h)
    both = np.concatenate([left, total], axis=2)
    counts, w, g = both[0] + both[1], weights[1] * both[0] + weights[0] * both[1], both[2]
    n, weight, sums = counts[:, -1:], w[:, -1:], g[:, -1:]
    if level == 0:
        tree.count[0], tree.weight[0] = n[0, 0], weight[0, 0]
        tree.value[0] = sums[0, 0] / weight[0, 0] if weight[0, 0] > 0 else 0.0
        if s.depth == 0:
            return False
    counts, w, g = counts[:, :-1], w[:, :-1], g[:, :-1]
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = (g ** 2 / w + (sums - g) ** 2 / (weight - w) - sums ** 2 / weight) / weight
    fits = (counts >= max(s.least, 1)) & (n - counts >= max(s.least, 1)) & (w > 0) & (weight - w > 0)
    size = splits.columns.size
    if s.features < size:
        drawn = np.random.default_rng([s.seed, number, level]).random((nodes, size))
        chosen = np.zeros((nodes, size), bool)
        np.put_along_axis(chosen, np.argpartition(drawn, s.features - 1, axis=1)[:, :s.features], True, axis=1)
        fits &= chosen[:, splits.slot]
    gain = np.where(fits, gain, -1.0)
    any_split = False
    for i in range(nodes):
        if not tree.there[first + i] or gain[i].max(initial=-1.0) <= 0:
            continue
        best = int((gain[i] >= gain[i].max() * (1 - EQUAL)).argmax())  # the first of equal ones, in whatever order sums were added
        if gain[i, best] < s.gain:
            continue
        any_split = True
        node, low = first + i, 2 * (first + i) + 1
        tree.pick[node], tree.gain[node] = best, gain[i, best]
        tree.there[low:low + 2] = True
        tree.count[low:low + 2] = counts[i, best], n[i, 0] - counts[i, best]
        tree.weight[low:low + 2] = w[i, best], weight[i, 0] - w[i, best]
        tree.value[low:low + 2] = g[i, best] / w[i, best], (sums[i, 0] - g[i, best]) / (weight[i, 0] - w[i, best])
    tree.depth += 1
    return any_split


def _grown(splits: _Splits, blocks: Sequence[_Block], s: Settings, weights: tuple[float, float]) -> list[Tree]:
    """The whole ensemble, from blocks at hand."""
    trees = []
    for number in range(s.trees):
        tree = Tree.root(s.depth)
        while tree.depth < max(s.depth, 1):
            h = splits.columns.apart(sum(_histogram(splits, b, tree, number, s, weights) for b in blocks))
            if not _split(splits, tree, h, number, s, weights):
                break
        for b in blocks:
            _add(splits, b, tree, _weight(number, s))
        trees.append(tree)
    return trees


def _weight(number: int, s: Settings) -> float:
    return 1.0 if number == 0 else s.step


def _grown_by_jobs(splits: _Splits, blocks: RDD, s: Settings, weights: tuple[float, float]) -> list[Tree]:
    """The same, one job per level; ``blocks`` hold margins of a number of trees, the rest is added in the tasks."""
    trees: list[Tree] = []
    held, base = blocks.persist(StorageLevel.MEMORY_AND_DISK), 0

    def brought(part: Iterator[_Block], new: Sequence[tuple[Tree, float]]) -> Iterator[_Block]:
        for b in part:
            for tree, weight in new:
                _add(splits, b, tree, weight)
            yield b

    try:
        for number in range(s.trees):
            if number - base >= KEPT:
                done = [(trees[k], _weight(k, s)) for k in range(base, number)]
                before, base = held, number
                held = held.mapPartitions(lambda part, done=done: brought(part, done)).persist(StorageLevel.MEMORY_AND_DISK)
                held.foreachPartition(lambda part: None)
                before.unpersist()
            new = [(trees[k], _weight(k, s)) for k in range(base, number)]
            tree = Tree.root(s.depth)
            while tree.depth < max(s.depth, 1):
                def summed(part: Iterator[_Block], tree: Tree = tree, number: int = number, new: list = new) -> Iterator[np.ndarray]:
                    h = sum(_histogram(splits, b, tree, number, s, weights) for b in brought(part, new))
                    if not np.isscalar(h):  # a partition without blocks
                        yield splits.columns.apart(h)

                h = sum(held.mapPartitions(summed).collect())
                if not _split(splits, tree, h, number, s, weights):
                    break
            trees.append(tree)
    finally:
        held.unpersist()
    return trees


# --- models --------------------------------------------------------------------------

def _node_rows(splits: _Splits, trees: Sequence[Tree]) -> Iterator[tuple]:
    """Rows of ``NODE_SCHEMA``; children come after their parents."""
    for t, tree in enumerate(trees):
        nodes = np.flatnonzero(tree.there).tolist()
        place = {node: i for i, node in enumerate(nodes)}
        for node in nodes:
            pick = int(tree.pick[node])
            slot, cut, categories = splits.node(pick) if pick >= 0 else (-1, [], -1)
            w, v = float(tree.weight[node]), float(tree.value[node])
            yield (
                t, place[node], v, [w, w * v, 0.0], int(tree.count[node]), float(tree.gain[node]) if pick >= 0 else -1.0,
                place.get(2 * node + 1, -1) if pick >= 0 else -1, place.get(2 * node + 2, -1) if pick >= 0 else -1, slot, cut, categories)


def _settings(classifier: GBTClassifier, size: int) -> Settings:
    strategy = classifier.getFeatureSubsetStrategy()
    if strategy in ("all", "auto"):
        features = size
    elif strategy in ("sqrt", "log2", "onethird"):
        features = int(np.ceil({"sqrt": size ** 0.5, "log2": max(1.0, np.log2(size)), "onethird": size / 3}[strategy]))
    elif strategy.isdigit() and int(strategy) >= 1:
        features = min(int(strategy), size)
    else:
        features = int(np.ceil(float(strategy) * size))
    return Settings(
        classifier.getMaxIter(), classifier.getMaxDepth(), classifier.getStepSize(), classifier.getSubsamplingRate(), min(max(features, 1), size),
        classifier.getMinInstancesPerNode(), classifier.getMinInfoGain(), classifier.getSeed())


def fitted(classifier: GBTClassifier, data: Binned) -> GBTClassificationModel:
    """A model of Spark's own kind with the settings of ``classifier``."""
    spark = data.blocks.sparkSession
    splits, s = _Splits(data.columns), _settings(classifier, data.columns.size)
    columns, weights = data.columns, data.weights
    path = fresh_path(spark, "grown")
    if data.partitions == 1:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            blocks = [
                _block(columns, *(c[i].as_py() for c in batch.columns)) for batch in batches for i in range(batch.num_rows)]
            blocks.sort(key=lambda b: b.key)
            rows = list(_node_rows(splits, _grown(splits, blocks, s, weights))) if blocks else []
            kinds = [
                pa.int32(), pa.int32(), pa.float64(), pa.list_(pa.float64()), pa.int64(), pa.float64(), pa.int32(), pa.int32(), pa.int32(),
                pa.list_(pa.float64()), pa.int32()]
            names = [c.split()[0] for c in NODE_SCHEMA.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names)

        nodes = data.dealt().mapInArrow(run, NODE_SCHEMA)
    else:
        def loaded(part: Iterator) -> Iterator[_Block]:
            return iter(sorted((_block(columns, *row) for row in part), key=lambda b: b.key))

        trees = _grown_by_jobs(splits, data.dealt().rdd.mapPartitions(loaded), s, weights)
        nodes = spark.createDataFrame(_node_rows(splits, trees), NODE_SCHEMA)
    nodes.select("treeID", F.struct(
        "id", "prediction", F.lit(0.0).alias("impurity"), F.col("stats").alias("impurityStats"), F.col("raw").alias("rawCount"), "gain",
        F.col("left").alias("leftChild"), F.col("right").alias("rightChild"), F.struct(
            F.col("feature").alias("featureIndex"), F.col("cut").alias("leftCategoriesOrThreshold"),
            F.col("categories").alias("numCategories")).alias("split")).alias("nodeData")).write.parquet(f"{path}/data")
    told = read_small(spark, f"{path}/data")
    if told.num_rows <= FEW_NODES:
        model = _by_calls(spark, classifier, told, s, data.columns.size)
    else:
        model = _by_reader(spark, classifier, path, s, data.columns.size)
    removed(spark, path)
    return model


def _by_calls(spark: SparkSession, classifier: GBTClassifier, told: pa.Table, s: Settings, size: int) -> GBTClassificationModel:
    """The model built node by node, without a job."""
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    # each look-up of a name is a call, so names are looked up once
    ml, kinds = jvm.org.apache.spark.ml, jvm.org.apache.spark.ml.tree
    leaf, internal, number, category = kinds.LeafNode, kinds.InternalNode, kinds.ContinuousSplit, kinds.CategoricalSplit
    calculator, regressor = jvm.org.apache.spark.mllib.tree.impurity.VarianceCalculator, ml.regression.DecisionTreeRegressionModel
    part, unset = jvm.java.util.Arrays.copyOfRange, gateway.new_array(jvm.double, 1)
    by_tree: list[dict] = [{} for _ in range(s.trees)]
    rows = told.to_pylist()
    stats = _py2java(spark.sparkContext, DenseVector([x for row in rows for x in row["nodeData"]["impurityStats"]])).values()
    for k, row in enumerate(rows):
        by_tree[row["treeID"]][row["nodeData"]["id"]] = 3 * k, row["nodeData"]
    models, weights = gateway.new_array(regressor, s.trees), gateway.new_array(jvm.double, s.trees)
    for t, nodes in enumerate(by_tree):
        built = {}
        for i in sorted(nodes, reverse=True):
            at, n = nodes[i]
            sums = calculator(part(stats, at, at + 3), n["rawCount"])
            if n["leftChild"] < 0:
                built[i] = leaf(n["prediction"], n["impurity"], sums)
                continue
            slot, cut, categories = (n["split"][k] for k in ("featureIndex", "leftCategoriesOrThreshold", "numCategories"))
            split = number(slot, cut[0]) if categories == -1 else category(slot, unset, categories)
            built[i] = internal(n["prediction"], n["impurity"], n["gain"], built[n["leftChild"]], built[n["rightChild"]], split, sums)
        models[t], weights[t] = regressor(f"dtr_{uuid.uuid4().hex[:12]}", built[0], size), _weight(t, s)
    found = ml.classification.GBTClassificationModel(classifier.uid, models, weights, size, 2)
    classifier._transfer_params_to_java()
    classifier._java_obj.copyValues(found, classifier._java_obj.extractParamMap())
    return GBTClassificationModel(found)


def _by_reader(spark: SparkSession, classifier: GBTClassifier, path: str, s: Settings, size: int) -> GBTClassificationModel:
    """The model read by Spark from the folder that holds its nodes already."""
    def metadata(kind: str, uid: str, values: dict, **more: object) -> str:
        return json.dumps({
            "class": kind, "timestamp": int(time.time() * 1000), "sparkVersion": spark.version, "uid": uid, "paramMap": values,
            "defaultParamMap": {}, **more})

    values = {p.name: v for p, v in classifier.extractParamMap().items()}
    text = metadata("org.apache.spark.ml.classification.GBTClassificationModel", classifier.uid, values, numFeatures=size, numTrees=s.trees)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(f"{path}/metadata")
    kind = "org.apache.spark.ml.regression.DecisionTreeRegressionModel"
    rows = [(t, metadata(kind, f"dtr_{uuid.uuid4().hex[:12]}", {}), _weight(t, s)) for t in range(s.trees)]
    spark.createDataFrame(rows, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")
    return GBTClassificationModel.load(path)
