"""Running totals over an ordered table without putting it in one task.

An ordered window without partitions runs in a single task.  Here the rows fall
into *cells*: a cell is any column that never decreases along the order.  Each
cell is scanned on its own, the cell totals (one row per cell) are scanned in a
small second window, and the two are added.  The result does not depend on how
the cells are cut; only the balance of the work does.

Where a caller knows no cells, the rows are range-partitioned along the order and
a row's cell is its partition.  Spark samples the ranges from the shuffle that it
has already made, so nothing is scanned twice, and merges ranges that are small.

Both windows read the same table.  Where a caller uses every total it asks for,
the two sides need the same columns and Spark shuffles that table only once.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from holdfast.sources.storage import ensure_checkpoint_dir

CELLS = 4096

_AGG = {"sum": F.sum, "product": F.product}
_START = {"sum": 0, "product": 1.0}


def even_cells(col: Column, lo: float, hi: float, n: int = CELLS) -> Column:
    """Equal-width cells; values outside [lo, hi] join the first or last cell."""
    at = F.floor((col.cast("double") - F.lit(float(lo))) * F.lit(n / (hi - lo)))
    return F.coalesce(F.least(F.greatest(at, F.lit(0)), F.lit(n - 1)), F.lit(-1)).cast("int")


def bounded_cells(col: Column, bounds: Sequence[float]) -> Column:
    """Cells cut at ascending bounds, for example those of ``DataFrame.approxQuantile``."""
    return F.coalesce(sum((F.when(col >= F.lit(b), 1).otherwise(0) for b in bounds), F.lit(0)), F.lit(0))


def with_range_cells(df: DataFrame, order: Sequence[str], name: str, parts: int | None = None) -> DataFrame:
    """Add cells of about equally many rows, whatever the values: the partition of a range partitioning.

    The rows are checkpointed with their cells.  Ranges are sampled, and a table that is planned twice might be cut in two
    ways; so the cut is made once, and a lost executor cannot change it.
    """
    ensure_checkpoint_dir(df.sparkSession)
    by = [F.col(c) for c in order]
    ranged = df.repartitionByRange(*by) if parts is None else df.repartitionByRange(parts, *by)
    return ranged.withColumn(name, F.spark_partition_id()).checkpoint()


def hash_cells(hexdigest: Column, digits: int = 3) -> Column:
    """Cells of a hex digest in digest order: even by construction."""
    return F.conv(F.substring(hexdigest, 1, digits), 16, 10).cast("int")


def running_totals(
    df: DataFrame,
    order: Sequence[str],
    cell: Column | None,
    totals: Mapping[str, str],
    keys: Sequence[str] = (),
    descending: bool = False,
    keep_cell: str | None = None,
) -> DataFrame:
    """Add ``cum_<c>`` and ``all_<c>`` for each column of ``totals`` (column -> 'sum' or 'product').

    ``cum_`` is the running value, the row itself included; ``all_`` that of the
    whole group.  Without ``cell`` the work is cut into ranges of ``order``.  ``keys`` must not be NULL and ``order`` must be unique within
    them.  ``descending`` runs from the largest value down.  ``keep_cell`` names a column that returns the cells, for a second scan.
    """
    df = with_range_cells(df, order, "__cell") if cell is None else df.withColumn("__cell", cell)
    way = (lambda c: F.col(c).desc()) if descending else (lambda c: F.col(c).asc())
    inside = (
        Window.partitionBy(*keys, "__cell").orderBy(*[way(c) for c in order])
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    earlier = (
        Window.partitionBy(*keys).orderBy(way("__cell"))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    whole = Window.partitionBy(*keys)
    offsets = (
        df.groupBy(*keys, "__cell").agg(*[_AGG[how](c).alias(f"__t_{c}") for c, how in totals.items()])
        .select(
            *[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)],
            F.col("__cell").alias("__at"),
            *[F.coalesce(_AGG[how](f"__t_{c}").over(earlier), F.lit(_START[how])).alias(f"__o_{c}")
              for c, how in totals.items()],
            *[_AGG[how](f"__t_{c}").over(whole).alias(f"all_{c}") for c, how in totals.items()],
        )
    )
    local = df.withColumns({f"__l_{c}": _AGG[how](c).over(inside) for c, how in totals.items()})
    on = F.col("__cell") == F.col("__at")
    for i, k in enumerate(keys):
        on = on & (F.col(k) == F.col(f"__k{i}"))
    joined = local.join(offsets, on)
    return joined.select(
        *[c for c in df.columns if c != "__cell"],
        *([F.col("__cell").alias(keep_cell)] if keep_cell else []),
        *[(F.col(f"__l_{c}") + F.col(f"__o_{c}") if how == "sum"
           else F.col(f"__l_{c}") * F.col(f"__o_{c}")).alias(f"cum_{c}")
          for c, how in totals.items()],
        *[F.col(f"all_{c}") for c in totals],
    )
