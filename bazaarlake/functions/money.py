"""Exact money arithmetic.

Amounts are stored as doubles with two decimals. Adding doubles gives results
that depend on the order of addition, so sums run over whole cents (bigint)
and averages are divided and rounded half up in integers. Everything stays in
generated code; the only decimals are on already-aggregated rows.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round2(x: Column) -> Column:
    """``round(x, 2)``, half up, without the decimal detour for plain values.

    Unless ``x`` lies near a half cent the nearest cent is the answer, which
    ``rint`` finds in generated code. Only the rest goes through ``F.round``.
    """
    scaled = x * 100
    near = F.rint(scaled)
    return F.when(F.abs(scaled - near) < 0.49, near / 100).otherwise(F.round(x, 2))


def cents(x: Column) -> Column:
    """Whole cents of an amount that already has two decimals."""
    return F.rint(x * 100).cast("bigint")


def amount(c: Column) -> Column:
    """Whole cents back to a double amount."""
    return c.cast("double") / 100


def sum_cents(x: Column) -> Column:
    return F.sum(cents(x))


def ratio(num: Column, den: Column, digits: int = 2) -> Column:
    """``round(num / den, digits)`` for integers; NULL when ``den`` is 0.

    Exact: the quotient is rounded half away from zero in integer arithmetic.
    """
    scaled = num * F.lit(10**digits) if digits else num
    twice = F.abs(scaled) * 2 + den
    whole = F.when(den != 0, _int_div(twice, den * 2))
    return F.signum(num.cast("double")) * whole.cast("double") / 10**digits


def mean_amount(total_cents: Column, n: Column) -> Column:
    """Average amount, rounded to cents, from a sum of cents and a count."""
    return ratio(total_cents, n, 0) / 100


def _int_div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def sum_money(x: Column) -> Column:
    """Aggregate: exact total of a two-decimal amount."""
    return amount(sum_cents(x))


def mean_money(x: Column) -> Column:
    """Aggregate: mean of a two-decimal amount, rounded to cents."""
    return mean_amount(sum_cents(x), F.count(x))


def mean_int(x: Column) -> Column:
    """Aggregate: mean of an integer column, rounded to two decimals."""
    return ratio(F.sum(x), F.count(x))


def percent(part: Column, whole: Column) -> Column:
    """``part`` of ``whole`` in %, rounded to two decimals."""
    return ratio(part * 100, whole)
