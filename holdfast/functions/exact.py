"""Percentages and money that come out the same on every run and every engine.

Adding doubles depends on the order of addition, and rounding a double at a tie
depends on the engine.  Money is therefore summed as whole cents (bigint, which
stays in generated code) and every quotient is an integer division rounded half
away from zero; the cast to double comes last.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_WIDE = "decimal(38,0)"


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def div_half_up(num: Column, den: Column) -> Column:
    """num / den as bigint, rounded half away from zero; NULL when den is 0."""
    num, den = num.cast(_WIDE), den.cast(_WIDE)
    den = F.when(den != 0, den)
    two = F.lit(2).cast(_WIDE)
    half_up = _div(F.abs(num) * two + den, den * two)
    return F.when(num < 0, -half_up).otherwise(half_up)


def hundredths(units: Column) -> Column:
    """Whole hundredths (cents, basis points) to a double with two decimals."""
    return units.cast("double") / F.lit(100.0)


def rate_pct(hits: Column, n: Column) -> Column:
    """100 * hits / n with two decimals."""
    return hundredths(div_half_up(hits.cast(_WIDE) * F.lit(10000).cast(_WIDE), n))


def cents(amount: str | Column) -> Column:
    """Money of any numeric type as whole cents."""
    col = F.col(amount) if isinstance(amount, str) else amount
    return (col.cast("decimal(18,2)") * 100).cast("bigint")


def money(total_cents: Column) -> Column:
    return hundredths(total_cents)


def mean_money(total_cents: Column, n: Column) -> Column:
    """Average money per row with two decimals; NULL over no rows."""
    return hundredths(div_half_up(total_cents, n))
