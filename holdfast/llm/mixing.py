"""Mixing sources to target weights by systematic sampling.

Within a source every document expects the same number of copies (target / size of the source). Documents are put in an
order of rising size, expected copies are summed up in that order, one offset per source is added, and a document is emitted
once for each whole number that its stretch of the sum crosses. As neighbours have nearly the same size, the words taken
come near the target.

The running sum is made in two levels, so that a source with a third of all rows is not one task: documents fall into cells
(source, size class, hash class), cells are counted and summed up (a bounded number per source), and each cell numbers its
own rows.

Defined cases: NULL source is a source of its own, last in the order of sources; NULL or empty text has size 0, may be
emitted, and takes no words; rows repeated in full are separate documents; sources without words have target 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from holdfast.llm.text import words

#: Weights of the sources in their order, repeated.
WEIGHTS = (5, 2, 1)
HASH_CLASSES = 64


def targets(sizes: DataFrame, share: float = 1.5, limit: float = 2.0, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """Words each source gives: (source, source_size) -> with weight and target.

    Targets are level * weight, cut at limit * source_size, with the level at which they add up to share * all sizes. Sources
    fill up in order of size per weight, so the level follows from running sums over the sources (one row each).
    """
    ranked = sizes.withColumn("rank", F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())))
    pick = F.array(*(F.lit(float(w)) for w in weights))
    rows = ranked.withColumn("weight", F.get(pick, (F.col("rank") - 1) % len(weights)))
    by = W.orderBy(F.col("source_size") / F.col("weight"), "rank")
    before = by.rowsBetween(W.unboundedPreceding, -1)
    full = F.coalesce(F.sum("source_size").over(before), F.lit(0)) * limit
    left = F.sum("weight").over(by.rowsBetween(0, W.unboundedFollowing))
    level = (F.sum("source_size").over(W.partitionBy()) * share - full) / left
    rows = rows.withColumns({"level": level, "cut": F.col("source_size") * limit})
    # the first source that its level does not fill sets the level of all that follow
    rows = rows.withColumn("open", F.when(F.col("level") * F.col("weight") <= F.col("cut"), F.col("level")))
    rows = rows.withColumn("final", F.first("open", True).over(by.rowsBetween(W.unboundedPreceding, 0)))
    target = F.when(F.col("final").isNull(), F.col("cut")).otherwise(F.col("final") * F.col("weight"))
    return rows.select("source", "source_size", "weight", F.least(target, F.col("cut")).alias("target"))


def mixed(
    docs: DataFrame, source_col: str = "source", size_col: str = "size", share: float = 1.5, limit: float = 2.0, seed: int = 7
) -> DataFrame:
    """The documents with mix_source_size, mix_target and mix_copies (times each is emitted, 0 included).

    size_col: words of the document. Two equal rows are told apart by nothing but their number, so reruns agree.
    """
    own = [F.col(f"`{c}`") for c in docs.columns]
    source, size = F.col(f"`{source_col}`"), F.col(f"`{size_col}`")
    rows = docs.withColumns({
        "mix_source": source.cast("string"), "mix_size": size, "mix_key": F.xxhash64(*own),
        "mix_class": F.floor(F.log2(size + 1.0) * 8).cast("int"),
    })
    rows = rows.withColumn("mix_part", F.pmod("mix_key", F.lit(HASH_CLASSES)).cast("int"))
    # one text key, so that the window and the join share a shuffle; the leading digit tells NULL from an empty name
    name = F.concat(F.when(F.col("mix_source").isNull(), "0").otherwise("1"), F.coalesce("mix_source", F.lit("")))
    rows = rows.withColumn("mix_cell", F.concat_ws("|", "mix_class", "mix_part", name))
    cells = rows.groupBy("mix_cell", F.col("mix_source").alias("source"), "mix_class", "mix_part").agg(
        F.count(F.lit(1)).alias("n"), F.sum("mix_size").alias("words")
    )
    plan = targets(cells.groupBy("source").agg(F.sum("words").alias("source_size")), share, limit)
    before = F.sum("n").over(W.partitionBy("source").orderBy("mix_class", "mix_part").rowsBetween(W.unboundedPreceding, -1))
    cells = cells.withColumn("rows_before", F.coalesce(before, F.lit(0)))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    offset = F.pmod(F.xxhash64("c.source", F.lit(seed)), F.lit(1 << 20)) / float(1 << 20)
    cells = cells.alias("c").join(plan.alias("p"), F.col("c.source").eqNullSafe(F.col("p.source"))).select(
        "mix_cell", "rows_before", rate.alias("rate"), offset.alias("offset"),
        F.col("source_size").alias("mix_source_size"), F.col("target").alias("mix_target"),
    )
    order = W.partitionBy("mix_cell").orderBy("mix_size", "mix_key")
    rows = rows.withColumn("mix_row", F.row_number().over(order)).join(cells, "mix_cell")
    crossed = lambda n: F.floor(n * F.col("rate") + F.col("offset"))
    done = F.col("rows_before") + F.col("mix_row")
    copies = F.least(crossed(done) - crossed(done - 1), F.lit(int(limit)))
    rows = rows.withColumn("mix_copies", copies.cast("long"))
    return rows.select(*own, "mix_source_size", "mix_target", "mix_copies")


def emitted(mix: DataFrame) -> DataFrame:
    """The mix itself: each document as often as it is emitted, with `copy` counted from 1."""
    some = mix.filter(F.col("mix_copies") > 0)
    return some.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("mix_copies").cast("int"))))


def n_words(text_col: str = "text") -> Column:
    return F.size(words(F.col(text_col))).cast("long")


def report(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken. The text is read for its size only, never shuffled."""
    mix = mixed(docs.select("doc_id", "source", n_words().alias("size")))
    return mix.select(
        "doc_id", "size", F.col("mix_source_size").alias("source_size"), F.col("mix_target").alias("target"),
        (F.col("mix_copies") * F.col("size")).alias("taken"),
    )
