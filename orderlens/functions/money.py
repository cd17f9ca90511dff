"""Exact money arithmetic and exactly rounded averages.

Sums of doubles depend on the order rows arrive in, so the same data can give
different last digits on different partitionings (and a different value after
rounding). Measures with at most four decimals (money, scores) are rounded
half away from zero to four decimals and summed as DECIMAL(18,4), integer
measures as longs: exact on any cluster layout. A value of 10^14 or more in
size, an infinity or NaN is no amount of money: it counts as null (``is_money``
tells), and never fails the job; the sums have 24 digits before the point.

Published averages and ratios are rounded to 2 or 4 places half away from
zero. Rounding the double quotient would round the binary approximation
(556.675 may become 556.67), so ``round_div`` rounds the exact rational
sum/count with integer arithmetic instead.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,4)"
MONEY_SCALE = 4
MONEY_LIMIT = 1e14
_INT = "decimal(38,0)"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_money(c: Column | str) -> Column:
    """Whether a double is an amount: not null, finite and below 10^14 in size."""
    return F.coalesce(F.abs(_c(c)) < MONEY_LIMIT, F.lit(False))


def money(c: Column | str) -> Column:
    return F.when(is_money(c), _c(c)).try_cast(MONEY)


def money_sum(c: Column | str) -> Column:
    """Exact sum of a money column (null when there are no values)."""
    return F.sum(money(c))


def to_cents(exact: Column) -> Column:
    """Round an exact decimal to 2 places (half away from zero) as a double."""
    return F.round(exact, 2).cast("double")


def ratio(num: Column, den: Column) -> Column:
    """num / den as a double; null when den is 0 (ANSI-safe). For ordering."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def round_div(num: Column, den: Column, digits: int, num_scale: int = 0) -> Column:
    """num / den rounded to ``digits`` places, half away from zero, exactly.

    ``num`` is an integer or a decimal with ``num_scale`` places, ``den`` a
    positive count. Computed as sign(n) * floor((2|n| + d) / 2d) / 10^digits
    on DECIMAL(38,0) integers; null when den is 0 or num is null.
    """
    n = (num * F.lit(10**num_scale)).cast(_INT)
    d = den.cast(_INT)
    if digits >= num_scale:
        n = n * F.lit(10 ** (digits - num_scale))
    else:
        d = d * F.lit(10 ** (num_scale - digits))
    a = F.abs(n) * 2 + d
    b = d * 2
    q = (a - a % b) / b  # exact integer quotient
    value = F.signum(n) * q.cast("double") / F.lit(float(10**digits))
    return F.when(den > 0, value)

