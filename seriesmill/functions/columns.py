"""Scalar expressions: typing, range rules, hash keys and lexicographic comparison."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesmill.spec import OTHER_SENSOR, safe_name

# Up to here the product of a double and a power of ten is less than a thousandth off.
_SAFE = 2.0**42


def numeric(column: Column) -> Column:
    """Double, with text that is no number and NaN both as null."""
    value = column.try_cast("double")
    return F.when(~F.isnan(value), value)


def within(column: Column, low: float, high: float) -> Column:
    """The reading, or null outside the inclusive range."""
    return F.when(column.between(low, high), column)


def is_finite(column: Column) -> Column:
    return column.isNotNull() & ~F.isnan(column) & (F.abs(column) != F.lit(float("inf")))


def finite_or_zero(column: Column) -> Column:
    return F.when(is_finite(column), column).otherwise(F.lit(0.0))


def rounded(column: Column, digits: int = 6) -> Column:
    """Round, and turn a negative zero into zero.

    Spark rounds a double through its decimal text.  Arithmetic gives the very same double unless the value is large or next
    to a half; only then the text is taken.
    """
    scaled = column * F.lit(10.0**digits)
    whole = F.rint(scaled)
    plain = (F.abs(scaled) < _SAFE) & (F.abs(scaled - whole) < 0.499)
    return F.when(plain, whole / F.lit(10.0**digits)).otherwise(F.round(column, digits)) + F.lit(0.0)


def share(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def hash_key(key: Sequence[str], seed: int) -> Column:
    """Hex digest that orders rows pseudo-randomly but the same way on every run."""
    return F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in key], F.lit(str(seed))))


def sensor_of(feature: Column, sensors: Sequence[str]) -> Column:
    """First sensor whose name, hyphens aside, starts the feature name."""
    plain = F.translate(feature, "-", "_")
    tests = [(plain.startswith(safe_name(s)), F.lit(s)) for s in sensors]
    chain = F.when(*tests[0])
    for test in tests[1:]:
        chain = chain.when(*test)
    return chain.otherwise(F.lit(OTHER_SENSOR))


def display_name(feature: Column) -> Column:
    return F.regexp_replace(feature, "_norm", "")


def sortable(df: DataFrame, name: str) -> Column:
    """A value with the order of column ``name`` that survives a trip to the driver."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.TimestampNTZType):
        return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', `{name}`)")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(F.col(name))
    if isinstance(kind, T.DateType):
        return F.unix_date(F.col(name))
    return F.col(name)


def from_sortable(df: DataFrame, name: str, value: object) -> Column:
    """The literal of column ``name`` for a value of :func:`sortable`."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.TimestampNTZType):
        return F.expr(f"timestampadd(MICROSECOND, {value}L, TIMESTAMP_NTZ'1970-01-01 00:00:00')")
    if isinstance(kind, T.TimestampType):
        return F.timestamp_micros(F.lit(value))
    if isinstance(kind, T.DateType):
        return F.date_from_unix_date(F.lit(value))
    return F.lit(value)


def before(columns: Sequence[Column], values: Sequence[object]) -> Column:
    """True where the tuple of columns sorts before the tuple of values, nulls last.

    Elsewhere false or null.
    """
    result = F.lit(False)
    for column, value in reversed(list(zip(columns, values, strict=True))):
        if value is None:
            less, same = column.isNotNull(), column.isNull()
        else:
            less = column < F.lit(value)
            same = column.eqNullSafe(F.lit(value))
        result = less | (same & result)
    return result
