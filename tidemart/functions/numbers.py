"""Money and rounding that give the same result in any row order.

Adding doubles depends on the order in which tasks finish, and at 10^12 rows the
error reaches the cents. Money is therefore added as decimals with nine places, exact and
repeatable after a task retry, and rounded once, after the sum.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: 29 digits before the point: sums of sums fit as well.
MONEY = "decimal(38,9)"


def exact(c: Column | str) -> Column:
    """A double as a decimal fit to be added up. NaN and infinities count as NULL; amounts of
    10^29 or more raise an error (in ANSI mode) instead of dropping out of a sum."""
    c = F.col(c) if isinstance(c, str) else c
    return F.nanvl(c, F.lit(None).cast("double")).cast(MONEY)


def amount(total: Column, digits: int = 2) -> Column:
    """A sum of exact amounts as a double, half-up rounded."""
    return F.round(total, digits).cast("double")


def mean_amount(total: Column, n: Column, digits: int = 2) -> Column:
    """Half-up rounded mean of ``n`` exact amounts; NULL when there are none."""
    return F.round(total / F.nullif(n, F.lit(0)), digits).cast("double")


def ratio(num: Column, den: Column, digits: int | None = None) -> Column:
    """``num / den`` as double, NULL for an empty denominator.

    The inner rounding absorbs the last-place noise of a sum of doubles, so that a
    tie such as 2.125 always rounds the same way.
    """
    value = num.cast("double") / F.nullif(den.cast("double"), F.lit(0.0))
    return value if digits is None else F.round(F.round(value, 9), digits)


def points(c: Column | str) -> Column:
    """A score or count as a decimal: sums of it do not depend on the order of rows."""
    c = F.col(c) if isinstance(c, str) else c
    return c.try_cast("decimal(28,12)")


def mean(c: Column | str, digits: int) -> Column:
    """Rounded average over non-NULL values (aggregate expression)."""
    return ratio(F.sum(points(c)), F.count(c), digits)
