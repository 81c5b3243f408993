"""Dropping malformed trips and giving the rest their types."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cabrank.functions.conditions import non_negative, number, well_formed_time
from cabrank.schema import AMOUNTS, FAILED, MONTH, TIME_FORMAT, TRIP_TYPES, WRITTEN


def as_text(df: DataFrame) -> DataFrame:
    """Every column as text, names kept."""
    return df.select([F.col(name).cast("string").alias(name) for name in df.columns])


def wall_clock(df: DataFrame, name: str, fmt: str = TIME_FORMAT, zone: str | None = None) -> Column:
    """The time as read off a clock, without a zone.

    Text is parsed by its format with no zone in between. An instant becomes the
    wall clock of ``zone``, by default the session's, which the caller then
    answers for.
    """
    kind = df.schema[name].dataType
    if isinstance(kind, T.TimestampNTZType):
        return F.col(name)
    if isinstance(kind, T.TimestampType):
        shown = F.current_timezone() if zone is None else F.lit(zone)
        return F.convert_timezone(F.current_timezone(), shown, F.col(name).cast("timestamp_ntz"))
    if fmt == TIME_FORMAT:
        return F.col(name).try_cast("timestamp_ntz")
    options = {"timestampNTZFormat": fmt, "sep": "\u0001", "mode": "PERMISSIVE"}
    return F.from_csv(F.col(name).cast("string"), "at timestamp_ntz", options)["at"]


def typed(df: DataFrame, times: tuple[str, ...] = (), fmt: str = TIME_FORMAT, zone: str | None = None) -> DataFrame:
    """Give the columns of a trip their types; unknown columns stay as they are.

    Ids go through double, as some files write them as ``2.0``. Columns that are
    numbers or timestamps already are kept, but for ids with a decimal point.
    """

    def column(name: str) -> Column:
        kind = df.schema[name].dataType
        if name in times:
            return wall_clock(df, name, fmt, zone)
        if name not in TRIP_TYPES:
            return F.col(name)
        value = number(df, name)
        whole = TRIP_TYPES[name] == "int" and not isinstance(kind, T.IntegralType)
        return value.try_cast("int") if whole else value

    return df.select([column(name).alias(name) for name in df.columns])


def checks(
    df: DataFrame,
    pickup: str | None = None,
    dropoff: str | None = None,
    amounts: tuple[str, ...] = AMOUNTS,
    fmt: str = TIME_FORMAT,
) -> dict[str, Column]:
    """What a trip must meet, by the column that it is about."""
    found = {name: well_formed_time(df, name, fmt) for name in (pickup, dropoff) if name is not None}
    return found | {name: non_negative(df, name) for name in amounts}


def clean_trips(
    df: DataFrame,
    pickup: str | None = None,
    dropoff: str | None = None,
    amounts: tuple[str, ...] = AMOUNTS,
    fmt: str = TIME_FORMAT,
    zone: str | None = None,
) -> DataFrame:
    """Trips with well-formed times and non-negative amounts, typed.

    The caller names the time columns, so nothing is read to plan the filter.
    NULL in any checked column drops the trip. ``fmt`` is how text columns write
    times, ``zone`` the one in which instants are read off the clock.
    """
    times = tuple(name for name in (pickup, dropoff) if name is not None)
    found = checks(df, pickup, dropoff, amounts, fmt)
    kept = df.filter(reduce(and_, found.values())) if found else df
    return typed(kept, times, fmt, zone)


def judged_trips(
    df: DataFrame,
    pickup: str | None = None,
    dropoff: str | None = None,
    amounts: tuple[str, ...] = AMOUNTS,
    fmt: str = TIME_FORMAT,
    zone: str | None = None,
) -> DataFrame:
    """All trips, typed, with the checks that each fails: those that fail none are what ``clean_trips`` gives.

    ``FAILED`` has a bit for each check, in the order of ``checks``. A trip that
    fails any keeps its values as they were written, as JSON in ``WRITTEN``, for
    its columns may have become NULL by their types.
    """
    times = tuple(name for name in (pickup, dropoff) if name is not None)
    found = checks(df, pickup, dropoff, amounts, fmt)
    bits = [F.when(F.coalesce(check, F.lit(False)), 0).otherwise(1 << n) for n, check in enumerate(found.values())]
    mask = reduce(Column.bitwiseOR, bits, F.lit(0))
    written = F.when(F.col(FAILED) != 0, F.to_json(F.struct(*df.columns)))
    marked = df.withColumn(FAILED, mask).withColumn(WRITTEN, written)
    return typed(marked, times, fmt, zone)


def reason_counts(judged: DataFrame, names: tuple[str, ...]) -> DataFrame:
    """Trips per failed check; a trip that fails several counts for each. ``names`` are those of the checks, in order."""
    each = F.array(*(F.when(F.col(FAILED).bitwiseAND(1 << n) != 0, name) for n, name in enumerate(names)))
    reasons = judged.filter(F.col(FAILED) != 0).groupBy(FAILED).agg(F.count("*").alias("count"))
    exploded = reasons.select(F.explode(F.array_compact(each)).alias("reason"), "count")
    return exploded.groupBy("reason").agg(F.sum("count").alias("count"))


def with_month(trips: DataFrame, pickup: str) -> DataFrame:
    """Trips with the month of their pickup, such as 202306, to be stored by it."""
    return trips.withColumn(MONTH, F.year(pickup) * 100 + F.month(pickup))
