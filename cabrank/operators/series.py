"""Trips over time.

Every function groups by a cheap value (a date, a month number) and formats the
handful of groups afterwards, not the trips.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cabrank.functions.conditions import between_times
from cabrank.functions.text import month_name

HIGH, LOW, NORMAL = "High Anomaly", "Low Anomaly", "Normal"


def in_range(df: DataFrame, time: str, start: str, end: str, month: str | None = None) -> DataFrame:
    """Rows with ``start <= time < end``; ``month`` is the column the table is stored by, if it was made from ``time``."""
    return df.filter(between_times(df, time, start, end, month))


def daily_counts(
    df: DataFrame, time: str, start: str | None = None, end: str | None = None, month: str | None = None
) -> DataFrame:
    """Trips per day, for days that have any, from ``start`` on and before ``end``, where given."""
    if start is not None and end is not None:
        df = in_range(df, time, start, end, month)
    elif start is not None:
        df = df.filter(F.col(time) >= F.lit(start).cast(df.schema[time].dataType))
    elif end is not None:
        df = df.filter(F.col(time) < F.lit(end).cast(df.schema[time].dataType))
    return df.groupBy(F.col(time).try_cast("date").alias("pickup_day")).agg(F.count("*").alias("total_trips"))


def mean_day(daily: DataFrame) -> DataFrame:
    """One row: the mean number of trips over the days present."""
    return daily.agg(F.avg("total_trips").alias("mean_trips"))


def label_days(daily: DataFrame, high: float = 1.1, low: float = 0.9) -> DataFrame:
    """Days labelled by how they compare with the mean day.

    The mean is a scalar subquery over the same series; Spark reuses the daily
    counts for it, so the trips are read once and no value visits the caller.
    """
    mean = mean_day(daily).scalar()
    label = (
        F.when(F.col("total_trips") > mean * high, HIGH)
        .when(F.col("total_trips") < mean * low, LOW)
        .otherwise(NORMAL)
    )
    return daily.withColumn("anomaly", label)


def daily_anomalies(daily: DataFrame, high: float = 1.1, low: float = 0.9, labelled: bool = False) -> DataFrame:
    """The days that depart from the mean, in date order."""
    days = label_days(daily, high, low).filter(F.col("anomaly").isin(HIGH, LOW)).orderBy("pickup_day")
    return days if labelled else days.drop("anomaly")


def filtered_daily(df: DataFrame, time: str, condition: Column) -> DataFrame:
    """Rows that meet a condition, counted per day, in date order."""
    days = df.filter(condition).groupBy(F.col(time).try_cast("date").alias("day")).agg(F.count("*").alias("count"))
    return days.select(F.date_format("day", "yyyy-MM-dd").alias("Date"), "count").orderBy("Date")


def _month_counts(df: DataFrame, time: str) -> DataFrame:
    months = df.groupBy(F.month(F.col(time).try_cast("date")).alias("month")).agg(F.count("*").alias("count"))
    return months.select(month_name(F.col("month")).alias("pickup_month"), "count")


def trips_per_month(df: DataFrame, time: str) -> DataFrame:
    """Trips per month name, in name order; the years share a row."""
    return _month_counts(df, time).orderBy("pickup_month")


def peak_month(df: DataFrame, time: str) -> DataFrame:
    """The month with most trips, the first by name among equals.

    Trips without a time form a group too; if they are the largest there is no
    peak month and the result is empty.
    """
    return peak_of(_month_counts(df, time))


def peak_of(months: DataFrame) -> DataFrame:
    """The same from counts per month that exist already."""
    top = months.orderBy(F.desc("count"), "pickup_month").limit(1)
    return top.filter(F.col("pickup_month").isNotNull()).select("pickup_month", F.col("count").alias("trip_count"))
