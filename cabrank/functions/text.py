"""Formatting for printed figures."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_name(month: Column) -> Column:
    """Full English name of a month number."""
    return F.date_format(F.make_date(F.lit(2000), month, F.lit(1)), "MMMM")


def percent(value: Column) -> Column:
    """A percentage with two decimals, such as ``73.12%``; NULL stays NULL."""
    return F.when(value.isNotNull(), F.format_string("%.2f%%", value))
