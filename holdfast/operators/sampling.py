"""Reproducible splits, folds and samples, decided by a hash of the row identifier.

Membership depends only on identifier, label and seed: not on file order, number
of partitions, or a task being run again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from holdfast.operators.scan import hash_cells, running_totals

SEED = 42


def digest(id_col: str, seed: int = SEED) -> Column:
    return F.md5(F.concat(F.col(id_col).cast("string"), F.lit(f":{seed}")))


def sample_n(df: DataFrame, id_col: str, n: int = 1000, seed: int = SEED) -> DataFrame:
    """At most ``n`` rows: those of smallest digest."""
    return (
        df.withColumn("__h", digest(id_col, seed)).orderBy("__h", id_col).limit(n).drop("__h")
    )


def stratified_split(
    df: DataFrame, id_col: str, label: str, test_fraction: float = 0.2, seed: int = SEED
) -> DataFrame:
    """Add ``split`` ('test' / 'train'): in each class, the smallest digests are the test rows.

    The test rows of a class are exactly the rounded fraction of it.  No row is
    shuffled: counts per digest cell find the cell in which the quota ends, the
    rows of that one cell are ranked, and their last test row becomes a limit
    that every row is compared with.
    """
    keyed = df.select(
        F.col(id_col).alias("__id"), F.col(label).alias("__y"), digest(id_col, seed).alias("__h")
    ).where(F.col("__y").isin(0, 1)).withColumn("__cell", hash_cells(F.col("__h"), 4))
    by_cell = Window.partitionBy("__y").orderBy("__cell")
    cells = (
        keyed.groupBy("__y", "__cell").agg(F.count(F.lit(1)).alias("n"))
        .withColumn("after", F.sum("n").over(by_cell))
        .withColumn("quota", F.floor(F.sum("n").over(Window.partitionBy("__y")) * F.lit(test_fraction) + 0.5))
    )
    last_cell = cells.where(
        (F.col("after") >= F.col("quota")) & (F.col("after") - F.col("n") < F.col("quota"))
    ).select("__y", "__cell", (F.col("quota") - F.col("after") + F.col("n")).alias("take"))
    # Broadcasts below: one row per class, and the classes are 0 and 1.
    inside = Window.partitionBy("__y").orderBy("__h", "__id")
    limits = (
        keyed.join(F.broadcast(last_cell), ["__y", "__cell"])
        .withColumn("rank", F.row_number().over(inside))
        .where(F.col("rank") == F.col("take"))
        .select(F.col("__y").alias(label), F.col("__h").alias("__last_h"), F.col("__id").alias("__last_id"))
    )
    h = digest(id_col, seed)
    test = (h < F.col("__last_h")) | ((h == F.col("__last_h")) & (F.col(id_col) <= F.col("__last_id")))
    return (
        df.join(F.broadcast(limits), label, "left")
        .select(*df.columns, F.when(test, "test").otherwise("train").alias("split"))
    )


def stratified_folds(
    df: DataFrame, id_col: str, label: str, folds: int = 5, seed: int = SEED
) -> DataFrame:
    """Add ``fold`` (0 .. folds-1): rows of a class are dealt out in digest order."""
    keyed = df.withColumns({
        "__y": F.coalesce(F.col(label), F.lit(-1)),
        "__h": digest(id_col, seed),
        "__one": F.lit(1).cast("bigint"),
    })
    dealt = running_totals(
        keyed, ["__h", id_col], hash_cells(F.col("__h"), 4), {"__one": "sum"}, keys=["__y"]
    )
    return dealt.select(*df.columns, F.pmod(F.col("cum___one") - 1, F.lit(folds)).cast("int").alias("fold"))
