"""Sums that don't depend on the order of the rows.

A sum of doubles is rounded at every step, so its last bits change with the partitions of a run. Here every value is cut
by exact steps (powers of two, ``floor``, differences) into four integers of 26 bits; their sums are exact
whatever their order, and one rounding at the end gives the double nearest to the sum. What is cut off of a value lies
below 2**-52. All of it is built-in arithmetic on partial aggregates, within code generation.

Values from 2**52 on, infinities and NaN make the plain sum of their group (such sums have no fraction to lose, but do depend on
the order). Missing values are left out; a group without known values is NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import WindowSpec

_PART = float(1 << 26)
_MASK = (1 << 26) - 1
_LIMIT = float(1 << 52)


def _over(c: Column, w: WindowSpec | None) -> Column:
    return c.over(w) if w is not None else c


def is_float(kind: T.DataType) -> bool:
    return isinstance(kind, (T.DoubleType, T.FloatType))


def sum_exact(c: Column | str, w: WindowSpec | None = None) -> Column:
    """Sum of doubles, the same bits in whatever order they are summed."""
    x = (F.col(c) if isinstance(c, str) else c).cast("double")
    fits = F.abs(x) < F.lit(_LIMIT)
    v = F.when(fits, x)
    whole = F.floor(v)
    rest = (v - whole.cast("double")) * F.lit(_PART)
    third = F.floor(rest)
    first = F.floor(v / F.lit(_PART))
    parts = (first, whole - first * F.lit(1 << 26), third, F.floor((rest - third.cast("double")) * F.lit(_PART)))
    high, low, mid, tail = (_over(F.sum(p), w) for p in parts)
    # carries, from the last part up
    mid = mid + F.shiftright(tail, 26)
    low = low + F.shiftright(mid, 26)
    high = high + F.shiftright(low, 26)
    integer = high.cast("double") * F.lit(_PART) + low.bitwiseAND(F.lit(_MASK)).cast("double")
    fraction = mid.bitwiseAND(F.lit(_MASK)) * F.lit(1 << 26) + tail.bitwiseAND(F.lit(_MASK))
    return F.when(_over(F.bool_or(~fits), w), _over(F.sum(x), w)).otherwise(integer + fraction.cast("double") / F.lit(_LIMIT))


def mean_exact(c: Column | str, w: WindowSpec | None = None) -> Column:
    """Mean of the known values, from their exact sum."""
    return F.try_divide(sum_exact(c, w), _over(F.count(c), w).cast("double"))


def slope_exact(y: Column | str, x: Column | str) -> Column:
    """Least-squares slope of y over x from exact sums; NULL for fewer than two pairs or a single x."""
    y, x = (F.col(c) if isinstance(c, str) else c for c in (y, x))
    both = y.isNotNull() & x.isNotNull()
    y, x = (F.when(both, c.cast("double")) for c in (y, x))
    n = F.count(F.when(both, F.lit(1))).cast("double")
    sx, sy = sum_exact(x), sum_exact(y)
    spread = n * sum_exact(x * x) - sx * sx
    return F.when((n >= 2) & (spread > 0), (n * sum_exact(x * y) - sx * sy) / spread)
