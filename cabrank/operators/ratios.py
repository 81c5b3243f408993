"""Price per distance, with outliers flagged."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cabrank.functions.conditions import number


def ratio_outliers(
    df: DataFrame,
    numerator: str = "fare_amount",
    denominator: str = "trip_distance",
    factor: float = 1000,
    ratio: str = "fare_per_mile",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """The ratio of two columns per row, flagged where it exceeds ``factor`` means.

    A zero denominator gives a NULL ratio and a NULL flag, and stays out of the
    mean. Text is read as a number. The mean is a scalar subquery: a second, pruned scan, while the rows
    themselves are neither shuffled nor sorted.
    """
    rows = df.select(*keep, F.try_divide(number(df, numerator), number(df, denominator)).alias(ratio))
    mean = rows.agg(F.avg(ratio)).scalar()
    return rows.withColumn("outlier", F.col(ratio) > mean * factor)
