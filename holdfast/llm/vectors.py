"""Near-duplicate embeddings: every pair with a cosine of at least a threshold, by a tiled comparison in PCA order.

1. Equal vectors become one node with a weight, by an aggregation that combines copies before it shuffles.
2. Nodes are turned to the principal axes (about the origin, as cosines are), so that the leading dimensions hold most of
   a product. One sum of D x D products finds the axes.
3. Nodes are cut into tiles along the first axis at approximate quantiles; a tile of many equal coordinates is dealt on by a hash.
   Unit vectors further apart than sqrt(2 - 2 t) on any axis cannot reach t, so tiles are paired only with those within reach;
   a node is sent once to each pair its tile is in. A pair's task holds two tiles of a fixed number of rows, whatever the data.
4. A task compares blocks: products of the leading dimensions, plus the product of the two suffix norms, bound the
   cosine from above; pairs that cannot reach the threshold stop there. Those left add the next dimensions, are bounded again, and
   are at last decided by the product of the vectors as given, in double precision.
5. A task returns no pairs but per node its number of links (copies counted) and a spanning forest of the links it found. Components
   come from the forests, so a group of thousands of near copies yields a row per node and task.

Bounds are raised by what rounding can take, so no pair at or above the threshold is lost. The work grows with the
square of the number of distinct vectors where the first axis tells nothing apart; memory and rows do not.

Defined cases: a vector that is NULL, all zero, or holds NULL or non-finite entries, or has another length than most usable
vectors (the smaller of two equally frequent lengths), links with nothing: n_links 0, its own component. Repeated rows are vectors of
their own that link with each other. A NULL identifier counts as a vector and is never a component's name unless all its
members have none; kept is then true. An empty table gives no rows. Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.llm.components import components
from holdfast.sources.storage import fresh_path

TILE_ROWS = 16_384
BLOCK = 1024
#: What rounding may take from a bound: sums of float32 products of unit vectors.
SLACK = 1e-4


# --- nodes ---------------------------------------------------------------------------

def _usable(vectors: DataFrame, id_col: str, vec_col: str) -> tuple[DataFrame, DataFrame, int]:
    """(id, v) of vectors that can link, the ids of all others, and the length of the first."""
    v = F.col(f"`{vec_col}`")
    lean = vectors.select(F.col(f"`{id_col}`").alias("id"), v.alias("v"))
    v = F.col("v")
    finite = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    good = F.coalesce(v.isNotNull() & finite & F.exists(v, lambda c: c != 0), F.lit(False))
    most = lean.where(good).groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    width = most["d"] if most else 0
    good = good & (F.size(v) == width)
    return lean.where(good), lean.where(~F.coalesce(good, F.lit(False))).select("id"), width


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width).astype(np.float64)


def unit(x: np.ndarray) -> np.ndarray:
    """Rows at length one; scaled first, so that squares neither overflow nor vanish."""
    x = x / np.abs(x).max(axis=1, keepdims=True, initial=0)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def principal_axes(nodes: DataFrame, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Axes (columns) and energies of the unit vectors about the origin, the largest first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            u = unit(_matrix(batch.column(0), width))
            total += u.T @ u
        yield pa.RecordBatch.from_arrays([pa.array(range(width * width), pa.int32()), pa.array(total.ravel())], ["i", "s"])

    found = nodes.select("v").mapInArrow(run, "i int, s double").groupBy("i").agg(F.sum("s").alias("s")).collect()
    values, axes = np.linalg.eigh(np.array([r["s"] for r in sorted(found)]).reshape(width, width))
    return axes[:, ::-1], values[::-1]


def leading(energies: np.ndarray, share: float = 0.3) -> int:
    """How many leading dimensions the first bound reads: those with this share of the energy."""
    held = np.cumsum(np.maximum(energies, 0)) / max(energies.sum(), 1e-300)
    return int(np.searchsorted(held, share) + 1)


# --- tiles ---------------------------------------------------------------------------

def _tiled(nodes: DataFrame, width: int, axes: np.ndarray, least: float, tile_rows: int) -> DataFrame:
    """(a, b, tile, node, w, v): each node once per pair of tiles (a <= b) that its tile is in."""
    axis = np.ascontiguousarray(axes[:, 0])

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = unit(_matrix(batch.column(2), width)) @ axis
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(p)], [*batch.schema.names, "p"])

    kind = nodes.schema["v"].dataType.simpleString()
    placed = nodes.select("node", "w", "v").mapInArrow(first, f"node long, w long, v {kind}, p double")
    n = nodes.count()
    parts = max(1, ceil(n / tile_rows))
    cuts = placed.approxQuantile("p", [k / parts for k in range(1, parts)], 0.2 / parts) if parts > 1 else []
    cuts = np.unique(np.array(cuts, np.float64))
    spark = nodes.sparkSession
    shared = spark.sparkContext.broadcast(cuts)  # one number per tile_rows rows

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.searchsorted(shared.value, batch.column(3).to_numpy(), "right").astype(np.int32)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(at)], ["node", "w", "v", "cut"])

    dealt = placed.mapInArrow(cut, f"node long, w long, v {kind}, cut int")
    held = {r["cut"]: r["count"] for r in dealt.groupBy("cut").count().collect()}
    # a cut that holds far more than a tile, as many nodes share a coordinate, is several tiles of the same range
    reach = sqrt(max(0.0, 2 - 2 * least)) + 1e-9
    ranges, start, rows = [], {}, []
    for c in sorted(held):
        start[c] = len(ranges)
        low = cuts[c - 1] if c > 0 else -np.inf
        high = cuts[c] if c < len(cuts) else np.inf
        ranges += [(low, high)] * max(1, round(held[c] / tile_rows))
        rows.append((c, start[c], len(ranges) - start[c]))
    lows, highs = (np.array([r[k] for r in ranges]) for k in (0, 1))
    near = [(t, int(np.searchsorted(highs, lo - reach)), int(np.searchsorted(lows, hi + reach, "right"))) for t, (lo, hi) in
            enumerate(ranges)]
    # both tables have one row per tile; Spark decides by their size how to join them
    tiles = spark.createDataFrame(rows, "cut int, start int, parts int")
    partners = spark.createDataFrame(near, "tile int, low int, past int")
    tile = (F.col("start") + F.pmod(F.xxhash64("node"), F.col("parts"))).cast("int").alias("tile")
    sent = dealt.join(tiles, "cut").select("node", "w", "v", tile).join(partners, "tile")
    other = F.explode(F.sequence("low", F.col("past") - 1)).alias("other")
    return sent.select("tile", "node", "w", "v", other).select(
        F.least("tile", "other").alias("a"), F.greatest("tile", "other").alias("b"), "tile", "node", "w", "v")


# --- one pair of tiles ---------------------------------------------------------------

def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest place in each place's component."""
    parent = np.arange(n)
    while len(a):
        x, y = parent[a], parent[b]
        apart = x != y
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(parent, np.maximum(x, y), np.minimum(x, y))
        while True:
            up = parent[parent]
            if np.array_equal(up, parent):
                break
            parent = up
    return parent


class _Side:
    """One tile in principal order: leading dimensions and suffix norm in float32, the rest, and the unit vectors."""

    def __init__(self, v: np.ndarray, axes: np.ndarray, steps: tuple[int, int]):
        self.unit = unit(v)
        turned = self.unit @ axes
        lead, more = steps
        rest = np.sqrt((turned[:, lead:] ** 2).sum(axis=1, keepdims=True))
        self.lead = np.hstack([turned[:, :lead], rest]).astype(np.float32)
        self.next = turned[:, lead:more].astype(np.float32)
        self.rest = np.sqrt((turned[:, more:] ** 2).sum(axis=1)).astype(np.float32)


def _linked_pairs(x: _Side, i: slice, y: _Side, j: slice, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Places (from the slices' starts) of the pairs that reach the threshold."""
    bound = x.lead[i] @ y.lead[j].T  # the last column adds the product of the suffix norms
    p, q = np.nonzero(bound >= least - SLACK)
    if len(p) * 8 > bound.size:  # dense: one product decides all
        return np.nonzero(x.unit[i] @ y.unit[j].T >= least)
    if len(p):
        p0, q0 = p + i.start, q + j.start
        lead = bound[p, q] - x.lead[p0, -1] * y.lead[q0, -1]
        held = lead + np.einsum("ij,ij->i", x.next[p0], y.next[q0]) + x.rest[p0] * y.rest[q0] >= least - SLACK
        p, q = p[held], q[held]
        sure = np.einsum("ij,ij->i", x.unit[p + i.start], y.unit[q + j.start]) >= least
        p, q = p[sure], q[sure]
    return p, q


def compared(
    nodes: np.ndarray, weights: np.ndarray, v: np.ndarray, first: np.ndarray, same: bool, axes: np.ndarray, least: float,
    steps: tuple[int, int],
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(node, links, root) of the nodes of two tiles that link; `first` marks the first tile, `same` that there is but one."""
    order = np.argsort(~first, kind="stable")
    nodes, weights, v = nodes[order], weights[order], v[order]
    total, half = len(nodes), int(first.sum())
    side = _Side(v, axes, steps)
    links = np.zeros(total)
    kept: list[np.ndarray] = []
    rows, columns = (half, (0, half)) if same else (half, (half, total))
    for s in range(0, rows, BLOCK):
        i = slice(s, min(s + BLOCK, rows))
        for t in range(s if same else columns[0], columns[1], BLOCK):
            j = slice(t, min(t + BLOCK, columns[1]))
            p, q = _linked_pairs(side, i, side, j, least)
            p, q = p + s, q + t
            if same and s == t:
                p, q = p[p < q], q[p < q]
            if not len(p):
                continue
            links += np.bincount(p, weights[q], total) + np.bincount(q, weights[p], total)
            ends, place = np.unique(np.concatenate([p, q]), return_inverse=True)
            root = ends[_roots(len(ends), place[:len(p)], place[len(p):])]
            kept.append(np.stack([ends, root])[:, ends != root])
        if len(kept) > 64:
            kept = [_forest(total, kept)]
    at = np.flatnonzero(links)
    root = _roots(total, *np.concatenate(kept, axis=1)) if kept else np.arange(total)
    return nodes[at], links[at].astype(np.int64), nodes[root[at]]


def _forest(n: int, kept: list[np.ndarray]) -> np.ndarray:
    root = _roots(n, *np.concatenate(kept, axis=1))
    at = np.flatnonzero(root != np.arange(n))
    return np.stack([at, root[at]])


# --- operator ------------------------------------------------------------------------

def linked(nodes: DataFrame, width: int, least: float = 0.95, tile_rows: int = TILE_ROWS) -> DataFrame:
    """(node, n, root) over (node, w, v): links of each node per pair of tiles, and a spanning forest of them."""
    axes, energies = principal_axes(nodes, width)
    lead = leading(energies)
    steps = (lead, min(width, 2 * lead))

    def run(table: pa.Table) -> pa.Table:
        a, b = table.column("a")[0].as_py(), table.column("b")[0].as_py()
        v = table.column("v").combine_chunks()
        found = compared(
            table.column("node").to_numpy(), table.column("w").to_numpy(), _matrix(v, width),
            table.column("tile").to_numpy() == a, a == b, axes, least, steps)
        return pa.table(list(map(pa.array, found)), names=["node", "n", "root"])

    return _tiled(nodes, width, axes, least, tile_rows).groupBy("a", "b").applyInArrow(run, "node long, n long, root long")


def report(
    vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", least: float = 0.95, tile_rows: int = TILE_ROWS
) -> DataFrame:
    """(id, n_links, component_id, kept) of every row."""
    spark = vectors.sparkSession
    good, others, width = _usable(vectors, id_col, vec_col)
    alone = others.select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    if width:
        # numbers given while the nodes are written stay theirs
        path = fresh_path(spark, "nodes")
        grouped = good.groupBy("v").agg(F.count(F.lit(1)).alias("w"), F.min("id").alias("least"))
        grouped.select(F.monotonically_increasing_id().alias("node"), "w", "least", "v").write.parquet(path)
        nodes = spark.read.parquet(path)
        path = fresh_path(spark, "links")
        linked(nodes, width, least, tile_rows).write.parquet(path)
        found = spark.read.parquet(path)
        counts = found.groupBy("node").agg(F.sum("n").alias("n"))
        member = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
        named = (
            nodes.select("node", "least", "w", "v").join(member, "node", "left").join(counts, "node", "left")
            .withColumn("root", F.coalesce("root", "node"))
        )
        names = named.groupBy("root").agg(F.min("least").alias("component_id"))
        node = named.join(names, "root").select("v", (F.coalesce("n", F.lit(0)) + F.col("w") - 1).alias("n_links"), "component_id")
        # a vector of a third of all rows is a hot key of this join, whose other side has one row per vector
        alone = good.join(node, "v").select("id", "n_links", "component_id").unionByName(alone)
    same = F.col("id").eqNullSafe(F.col("component_id"))
    return alone.select(F.col("id").alias(id_col), "n_links", "component_id", same.alias("kept"))
