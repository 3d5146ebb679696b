"""Connected components of a link table, by alternating large and small stars.

Each round re-hangs every node on its smallest known neighbour with one aggregation (partial sums run before the shuffle)
and one equi-join, so a node with a third of all links is neither one task nor one list. A round's links are
checkpointed in the cluster's shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.sources.storage import ensure_checkpoint_dir


def _large_star(e: DataFrame) -> DataFrame:
    both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(e: DataFrame) -> DataFrame:
    least = e.groupBy("a").agg(F.min("b").alias("m"))
    own = least.select("a", F.col("m").alias("b"))
    return e.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(own)


def components(links: DataFrame) -> DataFrame:
    """(a, b) links between ids of one type -> (node, root) of every linked node, root being its component's smallest.

    Links to itself or NULL are ignored; no links give no rows.
    """
    ensure_checkpoint_dir(links.sparkSession)
    e = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct().checkpoint()
    before = None
    while True:
        state = e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if state == before or state[0] == 0:
            break
        before = state
        e = _small_star(_large_star(e).distinct()).distinct().checkpoint()
    roots = e.select(F.col("b").alias("node")).distinct()
    return e.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots.withColumn("root", F.col("node")))
