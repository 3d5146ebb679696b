"""What a retention campaign costs and brings, from scores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.functions.rules import DECISION_THRESHOLD, decision_flag
from holdfast.operators.scan import running_totals

# Default revenue per customer and month, offer cost, campaign size and acceptance.
AVG_MONTHLY = 65.0
OFFER_COST = 10.0
TOP_N = 500
ACCEPTANCE = 0.30
THRESHOLDS = tuple(round(0.05 * i, 2) for i in range(1, 20))
SIZES = tuple(range(50, 2001, 50))
ACCEPTANCES = tuple(i / 100 for i in range(5, 81, 5))


def _money_columns(flagged: Column, avg_monthly: float, offer_cost: float) -> list[Column]:
    revenue, cost = flagged * F.lit(float(avg_monthly)), flagged * F.lit(float(offer_cost))
    return [
        F.round(revenue, 2).alias("revenue_at_risk"),
        F.round(cost, 2).alias("campaign_cost"),
        F.round(revenue - cost, 2).alias("net_saving"),
    ]


def retention_kpis(
    df: DataFrame, score: str, threshold: float = DECISION_THRESHOLD,
    avg_monthly: float = AVG_MONTHLY, offer_cost: float = OFFER_COST,
) -> DataFrame:
    """One row: customers flagged at ``threshold`` and the money at stake."""
    flagged = df.agg(F.count_if(decision_flag(F.col(score), threshold) == 1).alias("flagged"))
    return flagged.select("flagged", *_money_columns(F.col("flagged"), avg_monthly, offer_cost))


def threshold_sweep(
    df: DataFrame, score: str, label: str, thresholds: Sequence[float] = THRESHOLDS,
    avg_monthly: float = AVG_MONTHLY, offer_cost: float = OFFER_COST,
) -> DataFrame:
    """Precision, recall and campaign money at each threshold, from one pass.

    A row counts once, under the number of thresholds it reaches; the at most
    len(thresholds) + 1 counts are then added up per threshold.
    """
    steps = sorted(thresholds)
    reached = sum((F.when(F.col(score) >= F.lit(t), 1).otherwise(0) for t in steps), F.lit(0))
    counts = df.groupBy(reached.alias("k")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col(label) == 1).alias("pos")
    )
    # len(steps) + 1 rows at most
    together = counts.agg(F.collect_list(F.struct("k", "n", "pos")).alias("g"))
    each = together.select("g", F.posexplode(F.array(*[F.lit(t) for t in steps])).alias("i", "threshold"))

    def total(field: str, above: Column) -> Column:
        picked = F.filter("g", lambda e: e["k"] > above)
        return F.aggregate(picked, F.lit(0).cast("bigint"), lambda acc, e: acc + e[field])

    each = each.select(
        "threshold", total("n", F.col("i")).alias("flagged"), total("pos", F.col("i")).alias("caught"),
        total("pos", F.lit(-1)).alias("churned"),
    )

    def share(den: str) -> Column:
        den = F.col(den)
        return F.round(F.coalesce(F.col("caught") / F.when(den != 0, den), F.lit(0.0)), 8)

    return each.select(
        "threshold", share("flagged").alias("precision"), share("churned").alias("recall"), "flagged",
        *_money_columns(F.col("flagged"), avg_monthly, offer_cost),
    )


def campaign_grid(
    df: DataFrame, score: str, sizes: Sequence[int] = SIZES, acceptances: Sequence[float] = ACCEPTANCES,
    annual_value: float = AVG_MONTHLY * 12, offer_cost: float = OFFER_COST,
) -> DataFrame:
    """What-if table: target the ``top_n`` highest scores, of whom a share accepts.

    Rows collapse to distinct scores; among equal scores it does not matter who is
    taken.  A size beyond the table targets everyone.
    """
    groups = (
        df.where(F.col(score).isNotNull())
        .groupBy(F.col(score).cast("double").alias("s")).agg(F.count(F.lit(1)).alias("n"))
    )
    ranked = running_totals(groups, ["s"], None, {"n": "sum"}, descending=True)
    before = F.col("cum_n") - F.col("n")
    wanted = F.array(*[F.lit(int(n)).cast("bigint") for n in sizes])
    per_size = (
        ranked.where(before < max(sizes))
        .select("s", "n", before.alias("before"), F.explode(wanted).alias("top_n"))
        .where(F.col("before") < F.col("top_n"))
        .select("top_n", "s", F.least(F.col("n"), F.col("top_n") - F.col("before")).alias("take"))
        .groupBy("top_n")
        .agg(F.sum("take").alias("targeted"), F.sum(F.col("s") * F.col("take")).alias("expected"))
    )
    each = per_size.select(
        "*", F.explode(F.array(*[F.lit(float(a)) for a in acceptances])).alias("acceptance")
    )
    saved = F.col("expected") * F.col("acceptance")
    revenue = saved * F.lit(float(annual_value))
    cost = F.col("targeted") * F.lit(float(offer_cost))
    roi = F.when(cost > 0, (revenue - cost) / F.when(cost > 0, cost) * 100).otherwise(F.lit(0.0))
    return each.select(
        "top_n", "acceptance", "targeted",
        F.round("expected", 6).alias("expected_churners"), F.round(saved, 6).alias("expected_saved"),
        F.round(revenue, 2).alias("saved_revenue"), F.round(cost, 2).alias("campaign_cost"),
        F.round(revenue - cost, 2).alias("net_benefit"), F.round(roi, 4).alias("roi_pct"),
    )


def campaign_roi(
    df: DataFrame, score: str, top_n: int = TOP_N, acceptance: float = ACCEPTANCE,
    annual_value: float = AVG_MONTHLY * 12, offer_cost: float = OFFER_COST,
) -> DataFrame:
    """One row of ``campaign_grid``."""
    return campaign_grid(df, score, [top_n], [acceptance], annual_value, offer_cost)


def _riskiest(df: DataFrame, score: str, id_col: str) -> DataFrame:
    return df.orderBy(F.col(score).desc(), F.col(id_col).asc())


def top_risk(df: DataFrame, score: str, id_col: str, columns: Sequence[str], n: int = 20) -> DataFrame:
    """The ``n`` highest scores with those display columns that exist."""
    shown = [c for c in columns if c in df.columns]
    return _riskiest(df.select(*dict.fromkeys([id_col, *shown, score])), score, id_col).limit(n)


def customer_at_rank(
    df: DataFrame, score: str, id_col: str, rank: int, pool: int | None = None
) -> DataFrame:
    """The customer at ``rank`` (0 = highest score), if given among the first ``pool``; no row beyond the last."""
    if rank < 0 or (pool is not None and rank >= pool):
        raise ValueError("rank must not be negative" if pool is None else f"rank must lie in 0..{pool - 1}")
    return _riskiest(df, score, id_col).offset(rank).limit(1)


def high_risk_customers(df: DataFrame, score: str, id_col: str, level: str = "Risk_Level") -> DataFrame:
    """Everyone in the high band, highest score first."""
    return _riskiest(df.where(F.col(level) == "High"), score, id_col)
