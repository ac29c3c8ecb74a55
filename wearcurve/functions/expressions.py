"""Column expressions. All stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import WindowSpec

from wearcurve.schema import RATIO_EPSILON, ROLL_ROWS


def nan_to_null(col: Column, dtype: T.DataType = T.DoubleType()) -> Column:
    """Missing readings are null from here on; Spark aggregates skip nulls but not NaN."""
    return F.nullif(col, F.lit(float("nan")).cast(dtype))


def reading(token: Column) -> Column:
    """Text token -> double; anything unreadable is null."""
    return nan_to_null(token.try_cast("double"))


def identifier(token: Column) -> Column:
    """Text token -> int, also when written as ``1.0``."""
    return reading(token).try_cast("int")


def ratio(numerator: Column, denominator: Column, dtype: T.DataType = T.FloatType()) -> Column:
    """``a / (b + eps)`` at the precision of the inputs; null where the denominator is zero.

    Spark divides floats as doubles. Rounding that quotient once to float equals a float division.
    """
    guarded = denominator + F.lit(RATIO_EPSILON).cast(dtype)
    safe = F.nullif(guarded, F.lit(0).cast(dtype))
    return (numerator.cast("double") / safe.cast("double")).cast(dtype)


def trailing_mean(col: Column, ordered: WindowSpec, rows: int = ROLL_ROWS) -> Column:
    """Mean over the current and the previous ``rows - 1`` rows, however many of them exist."""
    return F.avg(col).over(ordered.rowsBetween(1 - rows, 0))


def first_difference(col: Column, ordered: WindowSpec, dtype: T.DataType = T.FloatType()) -> Column:
    """Change since the previous row; 0 on the first row and next to a missing reading."""
    return F.coalesce(col - F.lag(col, 1).over(ordered), F.lit(0).cast(dtype))


def seeded_digest(seed: int, *cols: Column) -> Column:
    """Hex digest that orders ids pseudo-randomly and identically on every run."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[c.cast("string") for c in cols]))


def digest_number(digest: Column, digits: int = 8) -> Column:
    """First hex digits of a digest as a non-negative number."""
    return F.conv(F.substring(digest, 1, digits), 16, 10).cast("bigint")
