"""Fixed-point arithmetic with nine decimals, rounding half away from zero."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NUM = "decimal(38,9)"
#: Operands of at most 9 whole digits multiply exactly before the one rounding.
_NARROW = "decimal(18,9)"
_RATIO = "decimal(24,9)"
_SAFE = 10**9


def num(value: Column | str) -> Column:
    return (F.col(value) if isinstance(value, str) else value).cast(NUM)


def mul9(a: Column, b: Column) -> Column:
    """a * b to nine decimals. Beyond 9 whole digits the product keeps fewer decimals."""
    fits = (F.abs(a) < _SAFE) & (F.abs(b) < _SAFE)
    exact = a.try_cast(_NARROW) * b.try_cast(_NARROW)
    return F.when(fits, exact.cast(NUM)).otherwise((a.cast(_RATIO) * b.cast(_RATIO)).cast(NUM))


def div9(a: Column, b: Column) -> Column:
    """a / b to nine decimals; null where b is zero."""
    return F.try_divide(a.cast(_RATIO), b.cast(_RATIO)).cast(NUM)


def half(total: Column) -> Column:
    return (total.cast(_RATIO) / F.lit(2).cast("decimal(1,0)")).cast(NUM)


def times(value: Column, factor: str) -> Column:
    """value times a short decimal literal, to nine decimals."""
    return (value.cast(_RATIO) * F.lit(factor).cast("decimal(10,6)")).cast(NUM)


def whole(value: Column) -> Column:
    """Round half away from zero to a whole number."""
    return F.round(value).cast("bigint")
