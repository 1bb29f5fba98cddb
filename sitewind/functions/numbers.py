"""Two-place rounding and sums that do not depend on the order of the rows.

A measure is rounded half-up on its decimal text, as ``round(x, 2)`` does. Its total is kept in
whole numbers: a rounded value is taken apart into hundredths and two larger units by divisions
and subtractions that are exact in doubles, and each part is summed as BIGINT. Integer sums are
exact and cheap, where decimal sums allocate an object per row.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# A value is  hundredths / 100 + middle * 2**24 + top * 2**58,  where hundredths are at most 2**23 * 100,
# and the middle at most 2**34, on either side of zero. So 2**29 rows of any values can be summed, and
# 2**32 of values below 2**23. The top holds values to 1e36; a value or a total that does not fit
# is an error.
_MIDDLE = float(1 << 24)
_TOP = float(1 << 58)
_PARTS = ("hundredths", "middle", "top")

# Doubles of this size and more are further apart than hundredths.
_SPARSE = float(1 << 46)
_MOST_HUNDREDTHS = 1e16  # as a value, not in hundredths


def _plainly_rounded(x: Column) -> Column:
    """True where scaled binary arithmetic gives the same second place as the decimal text: the
    value is below 1e9, where the product is off by less than 1e-4, and not near a tie."""
    scaled = x * F.lit(100.0)
    return (F.abs(x) < F.lit(1e9)) & (F.abs(scaled - F.floor(scaled) - F.lit(0.5)) > F.lit(1e-3))


def rounded(x: Column) -> Column:
    """``round(x, 2)`` as DOUBLE; NULL for NULL, NaN and infinities. Values of 1e16 or more are whole
    and stay as they are."""
    return F.when(
        _plainly_rounded(x), F.floor(x * F.lit(100.0) + F.lit(0.5)) / F.lit(100.0)
    ).when(F.abs(x) < F.lit(float("inf")), F.round(x, 2))


def _top(r: Column) -> Column:
    # A cast cuts off what follows the point, and is an error for what a BIGINT does not hold.
    return (r / F.lit(_TOP)).cast("bigint")


def _below_top(r: Column) -> Column:
    return r - _top(r).cast("double") * F.lit(_TOP)


def _middle(r: Column) -> Column:
    # Nearest, not cut off: of small values, negative ones too, nothing is left over.
    return F.floor(F.rint(_below_top(r) / F.lit(_MIDDLE)))


def _hundredths(r: Column) -> Column:
    low = _below_top(r) - _middle(r).cast("double") * F.lit(_MIDDLE)
    # Where several places stand for one double, its text has the shortest of them.
    tenths = F.rint(low * F.lit(10.0))
    short = (F.abs(r) >= F.lit(_SPARSE)) & (r - low + tenths / F.lit(10.0) == r)
    return F.when(short, tenths * F.lit(10.0)).otherwise(F.rint(low * F.lit(100.0))).cast("bigint")


def hundredths(x: Column) -> Column:
    """``round(x, 2) * 100`` as BIGINT; NULL for NULL, NaN and infinities, and for values of 1e16
    or more."""
    r = rounded(F.when(F.abs(x) < F.lit(_MOST_HUNDREDTHS), x))
    return _middle(r) * F.lit(100 << 24) + _hundredths(r)


def small_hundredths(r: Column) -> Column:
    """The same of a rounded value, and NULL from 2**24 on: for angles."""
    return F.when(F.abs(r) < F.lit(_MIDDLE), F.rint(r * F.lit(100.0)).cast("bigint"))


def total_parts(r: Column, name: str) -> list[Column]:
    """Aggregates: the parts of the exact total of a column of rounded values.

    The parts are taken from a value inside the sums, not in columns of their own: what a sum reads is
    compiled apart from it, and the method that runs over the rows stays small.
    """
    found = zip(_PARTS, (_hundredths(r), _middle(r), _top(r)), strict=True)
    return [F.sum(part).alias(f"{name}_{of}") for of, part in found]


def sum_of_totals(name: str) -> list[Column]:
    """Aggregates: the parts of the sum of totals, NULL if all of them are."""
    return [F.sum(f"{name}_{of}").alias(f"{name}_{of}") for of in _PARTS]


def has_total(name: str) -> Column:
    """Whether anything was summed."""
    return F.col(f"{name}_hundredths").isNotNull()


def total(name: str) -> Column:
    """A total as DOUBLE: the value nearest to the exact decimal."""
    low, middle, top = (F.col(f"{name}_{of}") for of in _PARTS)
    # Below 2**53 hundredths one division rounds correctly; larger totals go through decimals.
    small = (top == 0) & (F.abs(middle) < F.lit(1 << 21)) & (F.abs(low) < F.lit(1 << 52))
    units = top.cast("decimal(20,0)") * F.lit(Decimal(1 << 58)) + middle.cast("decimal(20,0)") * F.lit(
        Decimal(1 << 24)
    )
    exact = units.cast("decimal(38,2)") + low.cast("decimal(20,0)") * F.lit(Decimal("0.01"))
    return F.when(small, (middle * F.lit(100 << 24) + low) / F.lit(100.0)).otherwise(
        exact.cast("decimal(38,2)").cast("double")
    )


def mean(name: str, count: Column) -> Column:
    """Mean from an exact total; NULL when nothing was counted."""
    return F.try_divide(total(name), count)
