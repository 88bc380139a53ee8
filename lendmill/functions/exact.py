"""Sums and means of doubles that do not depend on the order of the rows.

Every value is cut into whole numbers by fixed powers of two, and the pieces are summed as
longs, which no order can change. What lies under 2**-48 of a value is cut off. The pieces
are so short that half a million million rows of one group cannot overflow; beyond that
Spark raises. NaN, infinity and values of 2**96 or more are summed as doubles beside.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lendmill.functions.columns import ColumnOrName, as_column

HALF_BITS = 24
BITS = 2 * HALF_BITS
HALF, UNIT = 2.0**HALF_BITS, 2.0**BITS


def exact_sum(value: ColumnOrName) -> Column:
    """An aggregate: the sum as a double, null over no values."""
    x = as_column(value).cast("double")
    plain = ~F.isnan(x) & (F.abs(x) < UNIT * UNIT)
    large = F.when(plain, (x / UNIT).cast("long"))
    rest = x - large * UNIT
    whole = F.when(plain, rest.cast("long"))
    part = ((rest - whole) * UNIT).cast("long")
    total = _whole_sum(large) * UNIT + _whole_sum(whole) + _whole_sum(part) / UNIT
    odd = F.sum(F.when(~plain, x))
    return F.coalesce(total + odd, total, odd)


def exact_mean(value: ColumnOrName) -> Column:
    """An aggregate: the exact sum by the number of values."""
    return F.try_divide(exact_sum(value), F.count(as_column(value)))


def _whole_sum(number: Column) -> Column:
    """The sum of longs below 2**48 in size, as a double, from the sums of their halves."""
    high = F.shiftright(number, HALF_BITS)
    low = number.bitwiseAND(F.lit((1 << HALF_BITS) - 1).cast("long"))
    return F.sum(high) * HALF + F.sum(low)
