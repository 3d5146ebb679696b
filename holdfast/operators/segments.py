"""Segment aggregates: counts, churn rates and revenue at risk per group.

Everything here is one hash aggregation whose partial step runs before the
shuffle, so a group that holds most of the table costs one row per task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from holdfast.functions.exact import cents, div_half_up, mean_money, money, rate_pct
from holdfast.schema import Roles

# Base aggregates; the optimizer drops those that no requested metric reads.
_N, _RATED, _CHURNED = "__n", "__rated", "__churned"
_CHARGE, _CHARGED, _TOTAL, _TOTALLED, _RISK = "__charge", "__charged", "__total", "__totalled", "__risk"


def _base_aggregates(df: DataFrame, roles: Roles) -> list[Column]:
    label = F.col(roles.label)
    aggs = [
        F.count(F.lit(1)).alias(_N),
        F.count(label).alias(_RATED),
        F.sum(label.cast("bigint")).alias(_CHURNED),
    ]
    if roles.charge in df.columns:
        charge = cents(roles.charge)
        aggs += [
            F.sum(charge).alias(_CHARGE),
            F.count(F.col(roles.charge)).alias(_CHARGED),
            F.coalesce(F.sum(F.when(label == 1, charge)), F.lit(0).cast("bigint")).alias(_RISK),
        ]
    if roles.total in df.columns:
        aggs += [F.sum(cents(roles.total)).alias(_TOTAL), F.count(F.col(roles.total)).alias(_TOTALLED)]
    return aggs


def _wide(name: str) -> Column:
    return F.col(name).cast("decimal(38,0)")


# Metric name -> expression over the base aggregates.
METRICS: Mapping[str, callable] = {
    "n": lambda: F.col(_N),
    "churned": lambda: F.col(_CHURNED),
    "churn_rate_pct": lambda: rate_pct(F.col(_CHURNED), F.col(_RATED)),
    "avg_charge": lambda: mean_money(F.col(_CHARGE), F.col(_CHARGED)),
    "avg_total": lambda: mean_money(F.col(_TOTAL), F.col(_TOTALLED)),
    # churned times the average charge of all rows of the group
    "rev_at_risk_proxy": lambda: money(div_half_up(_wide(_CHURNED) * _wide(_CHARGE), F.col(_CHARGED))),
    # what the churned rows are charged
    "rev_at_risk": lambda: money(F.col(_RISK)),
    "annual_rev_at_risk": lambda: money(F.col(_RISK) * 12),
}


def segment_summary(
    df: DataFrame,
    keys: Sequence[str],
    metrics: Mapping[str, str],
    roles: Roles = Roles(),
    order: Sequence[str] = (),
    limit: int | None = None,
) -> DataFrame:
    """Group by ``keys`` and compute ``metrics`` (output name -> metric name).

    ``order`` lists output columns, ``-`` in front for descending; the keys are
    appended, so that the order, and what ``limit`` keeps, is always unique.
    """
    return summarised(df.groupBy(*keys).agg(*_base_aggregates(df, roles)), keys, metrics, order, limit)


def summarised(
    grouped: DataFrame, keys: Sequence[str], metrics: Mapping[str, str], order: Sequence[str] = (), limit: int | None = None
) -> DataFrame:
    """The metrics, order and limit of ``segment_summary`` over base aggregates."""
    out = grouped.select(*keys, *[METRICS[m]().alias(name) for name, m in metrics.items()])
    if order or limit is not None:
        named = [c.lstrip("-") for c in order]
        out = out.orderBy(*[_direction(c) for c in [*order, *[k for k in keys if k not in named]]])
    return out if limit is None else out.limit(limit)


def _direction(name: str) -> Column:
    return F.col(name[1:]).desc() if name.startswith("-") else F.col(name).asc()


def _kpi_aggregates(roles: Roles) -> list[Column]:
    label, charge = F.col(roles.label), cents(roles.charge)
    high = F.col("risk_flag") == "High Risk"
    return [
        F.count(label).alias("rated"),
        F.sum(label.cast("bigint")).alias("hits"),
        F.sum(F.when(label == 1, charge).otherwise(0)).alias("risk"),
        F.count(F.when(label == 1, charge)).alias("risk_n"),
        F.count_if(high).alias("high_n"),
        F.count(F.when(high, label)).alias("high_rated"),
        F.sum(F.when(high, label.cast("bigint"))).alias("high_hits"),
    ]


def kpis(df: DataFrame, roles: Roles = Roles()) -> DataFrame:
    """One row: overall rate, revenue at risk, size and rate of the high-risk group."""
    return _kpis_of(df.agg(*_kpi_aggregates(roles)))


def _kpis_of(agg: DataFrame) -> DataFrame:
    return agg.select(
        rate_pct(F.col("hits"), F.col("rated")).alias("overall_churn_rate_pct"),
        money(F.col("risk")).alias("monthly_revenue_at_risk"),
        F.col("high_n").alias("high_risk_customers_count"),
        rate_pct(F.col("high_hits"), F.col("high_rated")).alias("high_risk_churn_rate_pct"),
        mean_money(F.col("risk"), F.col("risk_n")).alias("avg_monthly_charges_of_churners"),
    )


def grouped_sets(df: DataFrame, sets: Sequence[Sequence[str]], roles: Roles = Roles()) -> DataFrame:
    """Aggregates of several groupings from one scan: every key (NULL where a grouping has it not), ``set`` as the grouping's
    place in ``sets``, the base aggregates and, for a grouping without keys, those of ``kpis``.
    """
    keys = list(dict.fromkeys(k for s in sets for k in s))
    # a grouping's number has a bit per key, the first key's highest, set where the key is not part of it
    number = {sum(1 << (len(keys) - 1 - i) for i, k in enumerate(keys) if k not in s): n for n, s in enumerate(sets)}
    place = F.create_map(*(F.lit(x) for pair in number.items() for x in pair))
    # keys stand apart from the columns they are made of, as those are aggregated too
    told = df.withColumns({f"__key{i}": F.col(k) for i, k in enumerate(keys)})
    sides = [[F.col(f"__key{keys.index(k)}") for k in s] for s in sets]
    found = told.groupingSets(sides, *(F.col(f"__key{i}") for i in range(len(keys)))).agg(
        F.grouping_id().cast("int").alias("__set"), *_base_aggregates(df, roles), *_kpi_aggregates(roles))
    whole = {f"__key{i}": k for i, k in enumerate(keys)}
    return found.withColumn("set", place[F.col("__set")]).drop("__set").withColumnsRenamed(whole)


def kpis_of_set(found: DataFrame, place: int) -> DataFrame:
    """``kpis`` from the grouping without keys; one row also where the table, and so every grouping, is empty."""
    own = found.where(F.col("set") == place)
    sums = [F.sum(c).alias(c) for c in ("rated", "hits", "risk", "risk_n", "high_rated", "high_hits")]
    return _kpis_of(own.agg(*sums, F.coalesce(F.sum("high_n"), F.lit(0)).cast("bigint").alias("high_n")))


def conditional_rates(df: DataFrame, conditions: Mapping[str, Column], roles: Roles = Roles()) -> DataFrame:
    """One row with the churn rate of each condition's rows; NULL where none match."""
    label = F.col(roles.label)
    aggs = []
    for name, cond in conditions.items():
        aggs += [
            F.sum(F.when(cond, label.cast("bigint"))).alias(f"{name}__hits"),
            F.count(F.when(cond, label)).alias(f"{name}__n"),
        ]
    return df.agg(*aggs).select(
        *[rate_pct(F.col(f"{c}__hits"), F.col(f"{c}__n")).alias(c) for c in conditions]
    )


def segment_share(df: DataFrame, condition: Column, roles: Roles = Roles()) -> DataFrame:
    """One row: churn rate of a segment and its share of all churners."""
    label = F.col(roles.label)
    agg = df.agg(
        F.count(F.when(condition, label)).alias("n"),
        F.sum(F.when(condition, label.cast("bigint"))).alias("hits"),
        F.count_if(condition & (label == 1)).alias("seg_churned"),
        F.count_if(label == 1).alias("churned"),
    )
    return agg.select(
        rate_pct(F.col("hits"), F.col("n")).alias("segment_churn_rate_pct"),
        rate_pct(F.col("seg_churned"), F.col("churned")).alias("share_of_all_churners_pct"),
    )


def label_distribution(df: DataFrame, roles: Roles = Roles()) -> DataFrame:
    """Rows and percent of the whole per label value."""
    counts = df.groupBy(roles.label).agg(F.count(F.lit(1)).alias("n"))
    whole = F.sum("n").over(Window.partitionBy())  # one row per label value
    return counts.withColumn("pct", rate_pct(F.col("n"), whole)).orderBy(roles.label)


def rate_by_category(df: DataFrame, columns: Sequence[str], roles: Roles = Roles()) -> DataFrame:
    """Churn rate per value of several columns, in one scan and one aggregation."""
    pairs = F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value")) for c in columns
    ]))
    label = F.col(roles.label)
    long = df.select(pairs.alias("kv"), label.cast("bigint").alias("y"))
    return (
        long.groupBy(F.col("kv.feature").alias("feature"), F.col("kv.value").alias("value"))
        .agg(F.count(F.lit(1)).alias("n"), F.count("y").alias("rated"), F.sum("y").alias("churned"))
        .where(F.col("value").isNotNull())
        .select("feature", "value", "n", rate_pct(F.col("churned"), F.col("rated")).alias("churn_rate_pct"))
        .orderBy("feature", F.desc("churn_rate_pct"), "value")
    )


OTHER = "other"


def rate_by_domain(df: DataFrame, column: str, domain: Sequence[str], roles: Roles = Roles()) -> DataFrame:
    """Churn rate along a fixed axis: every domain value in its order, empty ones as NULL.

    Values off the axis follow behind it, in the order of their names, NULL last.
    """
    label = F.col(roles.label)
    position = F.array_position(F.array(*[F.lit(v) for v in domain]), F.col(column))
    present = (
        df.groupBy(column)
        .agg(F.count(label).alias("rated"), F.sum(label.cast("bigint")).alias("churned"),
             F.count(F.lit(1)).alias("n"))
    )
    axis = df.sparkSession.range(1).select(
        F.posexplode(F.array(*[F.lit(v) for v in domain])).alias("at", column)
    )
    on_axis = axis.join(present.where(position > 0), column, "left").withColumn("position", F.col("at") + 1)
    beyond = present.where(F.coalesce(position, F.lit(0)) == 0).withColumn("position", F.lit(len(domain) + 1))
    return (
        on_axis.unionByName(beyond, allowMissingColumns=True)
        .select("position", column, F.coalesce("n", F.lit(0)).alias("n"),
                rate_pct(F.col("churned"), F.col("rated")).alias("churn_rate_pct"))
        .orderBy("position", F.col(column).asc_nulls_last())
    )


def rate_matrix(
    df: DataFrame, row: str, column: str, values: Sequence[str], roles: Roles = Roles()
) -> DataFrame:
    """Churn rate with one row per ``row`` value, one column per listed ``column`` value and one for all others.

    NULL keys form no row and no column, as in a spreadsheet pivot.
    """
    label = F.col(roles.label)
    aggs = []
    named = {v: F.col(column) == v for v in values} | {OTHER: ~F.col(column).isin(*values)}
    for v, test in named.items():
        here = F.when(test, label)
        aggs += [F.sum(here.cast("bigint")).alias(f"{v}__hits"), F.count(here).alias(f"{v}__n")]
    return (
        df.where(F.col(row).isNotNull()).groupBy(row).agg(*aggs)
        .select(row, *[rate_pct(F.col(f"`{v}__hits`"), F.col(f"`{v}__n`")).alias(v) for v in named])
        .orderBy(row)
    )


def scatter_grid(
    df: DataFrame, x: str, y: str, x_step: float, y_step: float, label: str
) -> DataFrame:
    """Rows per cell of a two-dimensional grid and label: a scatter plot of any size.

    Spark counts cells instead of drawing points, so the result is bounded by the grid.
    """
    def cell(c: str, step: float) -> Column:
        return F.floor(F.col(c).cast("double") / F.lit(float(step)))

    return (
        df.groupBy(cell(x, x_step).alias("x_cell"), cell(y, y_step).alias("y_cell"), label)
        .agg(F.count(F.lit(1)).alias("n"))
    )


def class_weight(df: DataFrame, label: str) -> DataFrame:
    """One row: negatives, positives and negatives per positive (1 without positives)."""
    agg = df.agg(F.count_if(F.col(label) == 0).alias("neg"), F.count_if(F.col(label) == 1).alias("pos"))
    ratio = F.when(F.col("pos") == 0, F.lit(1.0)).otherwise(
        F.col("neg").cast("double") / F.greatest(F.col("pos"), F.lit(1))
    )
    return agg.select("neg", "pos", ratio.alias("weight"))


def dashboard_segments(segments: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Roll an exported segment table up to ``keys``; the rate is recomputed, not summed."""
    return (
        segments.groupBy(*keys)
        .agg(
            F.sum("customers").alias("customers"),
            F.sum("churned").alias("churned"),
            F.sum(cents("monthly_revenue_at_risk")).alias("m"),
            F.sum(cents("annual_revenue_at_risk")).alias("a"),
        )
        .select(
            *keys, "customers", "churned",
            rate_pct(F.col("churned"), F.col("customers")).alias("churn_rate_pct"),
            money(F.col("m")).alias("monthly_revenue_at_risk"),
            money(F.col("a")).alias("annual_revenue_at_risk"),
        )
        .orderBy(F.desc("monthly_revenue_at_risk"), *keys)
    )
