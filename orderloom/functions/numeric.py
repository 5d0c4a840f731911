"""Exact money arithmetic.

Prices are DECIMAL(10,2). Their sums are kept as whole cents in a bigint, which Spark adds
up about twice as fast as wide decimals and shuffles in half the space. They do not depend
on the order in which partitions arrive. A bigint holds 92 quadrillion units; beyond that
ANSI mode, Spark's default, raises an error.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from orderloom.schemas import MONEY, MONEY_SUM


def sum_cents(price: Column | str) -> Column:
    """Sum of a column in cents; a double counts as the nearest amount of money."""
    price = F.col(price) if isinstance(price, str) else price
    return F.sum((price.cast(MONEY) * 100).cast("bigint"))


def money(cents: Column | str) -> Column:
    """Cents as DECIMAL(38,2)."""
    cents = F.col(cents) if isinstance(cents, str) else cents
    return (cents.cast("decimal(20,0)") * F.lit(Decimal("0.01"))).cast(MONEY_SUM)


def units(cents: Column | str) -> Column:
    """Cents as a double, the nearest one to the decimal amount."""
    cents = F.col(cents) if isinstance(cents, str) else cents
    return cents.cast("double") / 100


def mean_of(amount: Column, rows: Column) -> Column:
    """An exact sum divided once, as a double; NULL over no rows."""
    return F.try_divide(amount.cast("double"), rows.cast("double"))


def round2(x: Column) -> Column:
    """Two decimals, half away from zero on the decimal digits rather than on the binary ones."""
    return F.round(x.cast("decimal(28,10)"), 2).cast("double")


def percent_change(current: Column, previous: Column) -> Column:
    """Change of a double against `previous` in percent; NULL where `previous` is NULL or 0."""
    return round2(F.try_divide(current - previous, previous) * 100)
