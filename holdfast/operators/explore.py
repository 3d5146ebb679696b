"""Distributions and correlations: the numbers behind the exploratory plots."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.operators.scan import running_totals, with_range_cells


# exp(-REACH^2 / 2) is below 2^-53, the precision of a double.
REACH = 9.0
# Bins per bandwidth of a binned density.
BINS = 400
# Size of a quantile sketch: ranks within about 0.4 percent.
SKETCH = 800


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Long Pearson matrix (x, y, r) of all pairs, from one aggregation.

    A pair uses the rows where both columns are present; NULL if one is constant.
    """
    pairs = list(combinations(columns, 2))
    d = {c: F.col(c).cast("double") for c in columns}
    row = df.agg(*[_pearson(d[a], d[b]).alias(f"r{i}") for i, (a, b) in enumerate(pairs)],
                 *[_pearson(d[c], d[c]).alias(f"d{i}") for i, c in enumerate(columns)])
    cells = [(a, b, f"r{i}") for i, (a, b) in enumerate(pairs)]
    cells += [(b, a, r) for a, b, r in cells]
    cells += [(c, c, f"d{i}") for i, c in enumerate(columns)]
    return row.select(F.explode(F.array(*[
        F.struct(F.lit(x).alias("x"), F.lit(y).alias("y"), F.round(F.col(r), 6).alias("r"))
        for x, y, r in cells
    ])).alias("c")).select("c.*").orderBy("x", "y")


def _pearson(x: Column, y: Column) -> Column:
    # The built-in correlation divides by zero on a constant column.
    x, y = F.when(y.isNotNull(), x), F.when(x.isNotNull(), y)
    spread = F.stddev_pop(x) * F.stddev_pop(y)
    return F.covar_pop(x, y) / F.when(spread > 0, spread)


def _stack(df: DataFrame, label: str, measures: Sequence[str]) -> DataFrame:
    """Distinct (label, measure, value) with their number of rows; the label is 0 or 1."""
    long = df.where(F.col(label).isin(0, 1)).select(
        F.col(label).alias("label"),
        F.explode(F.array(*[
            F.struct(F.lit(m).alias("measure"), F.col(m).cast("double").alias("value")) for m in measures
        ])).alias("mv"),
    )
    return (
        long.groupBy("label", F.col("mv.measure").alias("measure"), F.col("mv.value").alias("value"))
        .agg(F.count(F.lit(1)).alias("w"))
        .where(F.col("value").isNotNull())
    )


def density(
    df: DataFrame, label: str, measures: Sequence[str], points: int = 200, cut: float = 3.0, binned: bool = False
) -> DataFrame:
    """Gaussian density curve per measure and label, each label normalised alone.

    (label, measure, i, x, density) on an even grid from min - cut*h to max + cut*h
    with h = sd * n^(-1/5).  Rows collapse to weighted distinct values first; every
    value then adds its kernel to the grid points within reach, in a partial
    aggregation, so what is shuffled is one row per grid point and task.  Beyond REACH
    bandwidths a kernel is below the last digit of a double, and as h shrinks with n,
    the larger the table the fewer points each value touches.  A group of one distinct
    value has no density.

    ``binned`` is for measures with millions of distinct values: each value is shared out linearly between the two nearest of bins that are
    1 / BINS bandwidths wide, and the bins' kernels are summed instead. Linear sharing errs by at most an eighth of the squared bin
    width times the kernel's second derivative, so densities differ by less than BINS^-2 / (20 h) from the exact ones; bins number
    BINS times the range in bandwidths, whatever the number of values.
    """
    # Each value expands to many grid points, so the values are spread over a fixed
    # number of partitions; by size alone they would be merged into too few.
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    values = _stack(df, label, measures).repartition(partitions, "value")
    # A sum of squares loses digits, so the spread is taken about the mean.  Means and
    # spreads are broadcast: two labels times the listed measures, whatever the data.
    means = values.groupBy("label", "measure").agg(
        F.sum("w").alias("n"),
        (F.sum(F.col("value") * F.col("w")) / F.sum("w")).alias("mean"),
        F.min("value").alias("lo"), F.max("value").alias("hi"),
    )
    spread = (
        values.join(F.broadcast(means), ["label", "measure"])
        .groupBy("label", "measure", "n", "lo", "hi")
        .agg(F.sqrt(F.sum(F.col("w") * F.pow(F.col("value") - F.col("mean"), 2)) / (F.col("n") - 1)).alias("sd"))
        .where((F.col("n") > 1) & (F.col("hi") > F.col("lo")))
        .withColumn("h", F.col("sd") * F.pow(F.col("n").cast("double"), F.lit(-0.2)))
        .select("label", "measure", "n", "h",
                (F.col("lo") - F.lit(cut) * F.col("h")).alias("start"),
                ((F.col("hi") - F.col("lo") + F.lit(2 * cut) * F.col("h")) / (points - 1)).alias("step"))
    )
    if binned:
        values = _bins(values, spread).repartition(partitions, "value")
    x = F.col("start") + F.col("i") * F.col("step")
    z = (x - F.col("value")) / F.col("h")

    def nearest(offset: float) -> Column:
        return (F.col("value") + F.lit(offset) * F.col("h") - F.col("start")) / F.col("step")

    first = F.greatest(F.ceil(nearest(-REACH)), F.lit(0))
    last = F.least(F.floor(nearest(REACH)), F.lit(points - 1))
    masses = (
        values.join(F.broadcast(spread), ["label", "measure"])
        .withColumn("i", F.explode(F.when(first <= last, F.sequence(first, last))))
        .select("label", "measure", "i", (F.col("w") * F.exp(z * z * -0.5)).alias("mass"))
        .groupBy("label", "measure", "i").agg(F.sum("mass").alias("mass"))
    )
    # The full grid, so that points out of every value's reach appear with density 0.
    grid = spread.withColumn("i", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(points - 1).cast("bigint"))))
    norm = F.col("n") * F.col("h") * F.lit(math.sqrt(2 * math.pi))
    return (
        grid.join(masses, ["label", "measure", "i"], "left")
        .select("label", "measure", F.col("i").cast("int").alias("i"), F.round(x, 6).alias("x"),
                F.round(F.coalesce("mass", F.lit(0.0)) / norm, 8).alias("density"))
    )


def _bins(values: DataFrame, spread: DataFrame) -> DataFrame:
    """(label, measure, value, w): weights of values shared out to the two nearest bins, summed per bin."""
    at = F.col("value") * F.lit(BINS) / F.col("h")
    low = F.floor(at)
    part = at - low
    shares = F.explode(F.array(
        F.struct(low.alias("bin"), (F.col("w") * (1 - part)).alias("w")),
        F.struct((low + 1).alias("bin"), (F.col("w") * part).alias("w")),
    )).alias("s")
    return (
        values.join(F.broadcast(spread.select("label", "measure", "h")), ["label", "measure"])
        .select("label", "measure", "h", shares)
        .groupBy("label", "measure", "h", F.col("s.bin").alias("bin")).agg(F.sum("s.w").alias("w"))
        .select("label", "measure", (F.col("bin") * F.col("h") / F.lit(BINS)).alias("value"), "w")
    )


def scatter_points(df: DataFrame, x: str, y: str, label: str) -> DataFrame:
    """(x, y, label, n): every point that is drawn, with the number of rows that fall on it."""
    return df.groupBy(x, y, label).agg(F.count(F.lit(1)).alias("n"))


def box_stats(df: DataFrame, label: str, measure: str) -> DataFrame:
    """Quartiles, whiskers and outlier count of a measure per label, all exact.

    Quartiles interpolate linearly between ranks.  They are looked up in running
    counts of distinct values, so no task ever holds a whole group.
    """
    values = with_range_cells(_stack(df, label, [measure]).select("label", "value", "w"), ["value"], "cell")
    ranked = running_totals(
        values, ["value"], F.col("cell"), {"w": "sum"}, keys=["label"]
    )
    placed = ranked.withColumnRenamed("all_w", "n").withColumn("before", F.col("cum_w") - F.col("w"))

    def at_rank(rank: Column) -> Column:
        return F.max(F.when((F.col("before") <= rank) & (rank < F.col("cum_w")), F.col("value")))

    aggs = []
    for name, q in (("q1", 0.25), ("median", 0.5), ("q3", 0.75)):
        rank = (F.col("n") - 1) * F.lit(q)
        aggs += [at_rank(F.floor(rank)).alias(f"{name}_lo"), at_rank(F.ceil(rank)).alias(f"{name}_hi")]

    def between(name: str, q: float) -> Column:
        rank = (F.col("n") - 1) * F.lit(q)
        lo, hi = F.col(f"{name}_lo"), F.col(f"{name}_hi")
        return (lo + (hi - lo) * (rank - F.floor(rank))).alias(name)

    quartiles = placed.groupBy("label", "n").agg(*aggs).select(
        "label", "n", between("q1", 0.25), between("median", 0.5), between("q3", 0.75)
    )
    reach = (F.col("q3") - F.col("q1")) * 1.5
    inside = (F.col("value") >= F.col("q1") - reach) & (F.col("value") <= F.col("q3") + reach)
    return (
        values.join(F.broadcast(quartiles), "label")  # one row per label, 0 and 1
        .groupBy("label", "n", "q1", "median", "q3")
        .agg(
            F.min(F.when(inside, F.col("value"))).alias("whisker_lo"),
            F.max(F.when(inside, F.col("value"))).alias("whisker_hi"),
            F.coalesce(F.sum(F.when(~inside, F.col("w"))), F.lit(0).cast("bigint")).alias("outliers"),
        )
        .select("label", "n", *[F.round(c, 6).alias(c) for c in
                                ("q1", "median", "q3", "whisker_lo", "whisker_hi")], "outliers")
        .orderBy("label")
    )


def quantile_sketches(df: DataFrame, keys: Sequence[str], measure: str, size: int = SKETCH) -> DataFrame:
    """(keys..., n, lo, hi, sketch): a mergeable sketch of the measure per group, to be stored and merged later.

    A few kilobytes per group however many rows it has, built in partial aggregations.
    """
    value = F.col(measure).cast("double")
    return df.where(value.isNotNull()).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.min(value).alias("lo"), F.max(value).alias("hi"),
        F.kll_sketch_agg_double(value, size).alias("sketch"))


def merged_sketches(sketches: DataFrame, keys: Sequence[str], size: int = SKETCH) -> DataFrame:
    """Sketches of fewer keys from stored ones, without the rows they were made of."""
    return sketches.groupBy(*keys).agg(
        F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.kll_merge_agg_double("sketch", size).alias("sketch"))


def sketched_quantiles(sketches: DataFrame, quantiles: Mapping[str, float]) -> DataFrame:
    """Adds a column per named quantile, read from the sketch, and drops the sketch."""
    return sketches.withColumns({
        name: F.kll_sketch_get_quantile_double("sketch", F.lit(float(q))) for name, q in quantiles.items()
    }).drop("sketch")
