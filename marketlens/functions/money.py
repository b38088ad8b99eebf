"""Exact money sums on long integers.

``SUM`` over ``DECIMAL(12,2)`` returns ``DECIMAL(22,2)``; past 18 digits Spark
accumulates in ``java.math.BigDecimal`` objects, about twice as slow as a
long sum.  A decimal whose declared precision is at most 15 digits is
converted to exact integer units (value x 10^scale, below 2^53, so the
double round trip is exact), summed as ``long``, and turned into a double
only at the end: ``units / 10^scale`` is the correctly rounded value of the
exact decimal sum, i.e. the same double ``CAST(SUM(x) AS DOUBLE)`` gives.
Other types are summed as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, DataType, DecimalType, IntegerType, LongType, ShortType

MAX_EXACT_DIGITS = 15


def unit_scale(dtype: DataType) -> int | None:
    if isinstance(dtype, DecimalType) and dtype.precision <= MAX_EXACT_DIGITS:
        return dtype.scale
    if isinstance(dtype, (ByteType, ShortType, IntegerType, LongType)):
        return 0
    return None


def units(df: DataFrame, col: str) -> tuple[Column, int | None]:
    """(column of exact integer units, scale); scale None means 'sum the column as is'."""
    scale = unit_scale(df.schema[col].dataType)
    c = F.col(col)
    if scale is None:
        return c, None
    if scale == 0:
        return c.cast("long"), 0
    return F.rint(c.cast("double") * float(10 ** scale)).cast("long"), scale


#: Decimal places that doubles are carried with where sums must be whole numbers.
DOUBLE_SCALE = 6


def whole_units(df: DataFrame, col: str) -> tuple[Column, int]:
    """(column of whole-number units, scale) of any numeric money column.

    Doubles are taken to ``DOUBLE_SCALE`` decimal places, which is exact for
    money below 9e9; long decimals keep their own scale.
    """
    c, scale = units(df, col)
    if scale is not None:
        return c, scale
    dtype = df.schema[col].dataType
    if isinstance(dtype, DecimalType):
        return (F.col(col).cast(DecimalType(38, dtype.scale)) * F.lit(10 ** dtype.scale)).cast("long"), dtype.scale
    return F.rint(F.col(col).cast("double") * float(10 ** DOUBLE_SCALE)).cast("long"), DOUBLE_SCALE


def to_double(total: Column, scale: int | None) -> Column:
    """A unit sum back to the double value of the exact decimal sum."""
    d = total.cast("double")
    return d / float(10 ** scale) if scale else d


def units_at(df: DataFrame, cols: list[str]) -> tuple[list[Column], int | None]:
    """Several money columns as exact integer units on one common scale (or as they are)."""
    types = [df.schema[c].dataType for c in cols]
    scales = [unit_scale(t) for t in types]
    if any(sc is None for sc in scales):
        return [F.col(c) for c in cols], None
    scale = max(scales)
    if scale == 0:
        return [F.col(c).cast("long") for c in cols], 0
    # integer digits + common scale must stay within MAX_EXACT_DIGITS for an exact round trip
    if any(isinstance(t, DecimalType) and t.precision - t.scale + scale > MAX_EXACT_DIGITS for t in types):
        return [F.col(c) for c in cols], None
    return [F.rint(F.col(c).cast("double") * float(10 ** scale)).cast("long") for c in cols], scale


def whole_units_at(df: DataFrame, cols: list[str]) -> tuple[list[Column], int]:
    """Several money columns as whole-number units on one common scale, as of ``whole_units``."""
    found = [whole_units(df, c) for c in cols]
    scale = max(s for _, s in found)
    return [u * F.lit(10 ** (scale - s)) if s < scale else u for u, s in found], scale
