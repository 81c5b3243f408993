"""Row conditions, built from native expressions so that they reach the scan.

Each one takes the DataFrame as well as the column name: a column that is
already typed gets a plain comparison, a text column is read with ``try_cast``
first. Both behave the same with ANSI mode on and off.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cabrank.schema import TIME_FORMAT


#: A number as people write it.
DECIMAL = r"\s*[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?\s*"
#: What else a cast takes (``60d``, ``1f``, ``0x1p3``, ``NaN``, ``Infinity``) has one of these.
LETTERS = "[dDfFxXnN]"


def number(df: DataFrame, name: str) -> Column:
    """The column as a number; text that is not a plain decimal becomes NULL."""
    if isinstance(df.schema[name].dataType, T.NumericType):
        return F.col(name)
    text = F.col(name).cast("string")
    return F.when(~text.rlike(LETTERS), text.try_cast("double"))


def non_negative(df: DataFrame, name: str) -> Column:
    """True for finite values from zero up.

    Spark orders NaN above every number, so ``< Infinity`` removes both NaN and
    Infinity while staying a comparison that Parquet can evaluate.
    """
    value = number(df, name)
    if isinstance(df.schema[name].dataType, (T.IntegralType, T.DecimalType)):
        return value >= 0
    return (value >= 0) & (value < F.lit(float("inf")))


def is_timestamp(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, (T.TimestampType, T.TimestampNTZType))


def well_formed_time(df: DataFrame, name: str, fmt: str = TIME_FORMAT) -> Column:
    """True where the value is a moment written to the whole second."""
    if is_timestamp(df, name):
        return F.col(name).isNotNull() & (F.date_trunc("second", name) == F.col(name))
    return F.try_to_timestamp(F.col(name).cast("string"), F.lit(fmt)).isNotNull()


def between_times(df: DataFrame, name: str, start: str, end: str, month: str | None = None) -> Column:
    """``start <= value < end`` for ISO bounds, taken in the type of the column.

    Casting the bounds and not the column keeps the condition pushable. A text
    column is compared as text, which orders ISO dates correctly. ``month`` names
    the column by which the table is stored, if it holds the month of this very
    time: then months outside the range are not listed.
    """
    kind = df.schema[name].dataType
    within = (F.col(name) >= F.lit(start).cast(kind)) & (F.col(name) < F.lit(end).cast(kind))
    if month is not None:
        first = datetime.fromisoformat(start)
        last = datetime.fromisoformat(end) - timedelta(microseconds=1)
        within &= F.col(month).between(first.year * 100 + first.month, last.year * 100 + last.month)
    return within


def finite(df: DataFrame, name: str) -> tuple[Column, Column]:
    """The column as a number, and whether it is neither NaN nor infinite; comparisons that Parquet can evaluate."""
    value = number(df, name)
    if isinstance(df.schema[name].dataType, (T.IntegralType, T.DecimalType)):
        return value, value.isNotNull()
    return value, (value < F.lit(float("inf"))) & (value > F.lit(float("-inf")))


def expensive_short(
    df: DataFrame,
    *,
    time: str,
    fare: str = "fare_amount",
    distance: str = "trip_distance",
    first_day: date = date(2023, 1, 1),
    last_day: date = date(2023, 1, 7),
    min_fare: float = 50,
    max_distance: float = 1,
    month: str | None = None,
) -> Column:
    """Trips of the given days, both included, that cost much and went nowhere.

    Their time must be well formed and both amounts finite numbers, whether the
    rows were cleaned before or not.
    """
    (paid, paid_right), (went, went_right) = finite(df, fare), finite(df, distance)
    return (
        between_times(df, time, str(first_day), str(last_day + timedelta(days=1)), month)
        & well_formed_time(df, time)
        & (paid > min_fare)
        & paid_right
        & (went < max_distance)
        & went_right
    )
