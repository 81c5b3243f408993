"""Counts per group, top-k groups and shares.

Counts per zone group never join the trips themselves: trips are counted per
zone id first, where partial aggregation folds even the busiest zone to one row
per task, and the few counts are then carried over to the lookup's groups.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cabrank.functions.conditions import number
from cabrank.functions.text import month_name
from cabrank.schema import MONTH_ROLE, ROLES, ZONE_KEY


def count_by(df: DataFrame, key: str, count: str = "count") -> DataFrame:
    """Rows per value of a column; NULL is a group of its own."""
    return df.groupBy(key).agg(F.count("*").alias(count))


def carry_counts(
    counts: DataFrame, lookup: DataFrame, key: str, lookup_key: str, group: str, name: str, count: str = "count"
) -> DataFrame:
    """Counts per key turned into counts per lookup attribute.

    Equal to joining the counted rows with the lookup and counting again, also
    where the lookup has no or several entries for a key. The counts arrive
    partitioned by ``key``, so joining a large lookup moves only the lookup.
    """
    entries = lookup.select(F.col(lookup_key).alias("_key"), F.col(group).alias("_group"))
    return (
        counts.join(entries, F.col(key) == F.col("_key"), "left")
        .groupBy(F.col("_group").alias(name))
        .agg(F.sum(count).alias(count))
    )


def zone_counts(
    trips: DataFrame, lookup: DataFrame, key: str, name: str, count: str = "count", group: str = "Borough"
) -> DataFrame:
    """Trips per zone group of one role, for example per pickup borough."""
    return carry_counts(count_by(trips, key, count), lookup, key, ZONE_KEY, group, name, count)


def fleet_counts(trips: DataFrame, lookup: DataFrame, pickup: str, roles: dict[str, str] = ROLES, group: str = "Borough") -> DataFrame:
    """Trips per zone group of every role and per month, in one pass: ``role``, ``name`` and ``count``.

    Grouping sets count the ids of all roles and the months together, folded to a
    row for each id or month in each task; the few counts are then carried over to
    the lookup's groups and the months' names. A role's rows equal its
    ``zone_counts``, those of ``MONTH_ROLE`` equal ``trips_per_month``; NULL is a
    name of its own. Ids must be numbers, as ``typed`` makes them.
    """
    keys = {role: F.col(key) for role, key in roles.items()} | {MONTH_ROLE: F.month(F.col(pickup).try_cast("date"))}
    narrow = trips.select([key.cast("bigint").alias(role) for role, key in keys.items()])
    counts = narrow.groupingSets([[role] for role in keys], *keys).agg(
        F.count("*").alias("count"), *(F.grouping(role).alias(f"_{role}") for role in keys)
    )
    role = F.coalesce(*(F.when(F.col(f"_{name}") == 0, name) for name in keys))
    key = F.coalesce(*keys)
    counts = counts.select(role.alias("role"), key.alias("key"), "count")
    entries = lookup.select(F.col(ZONE_KEY).cast("bigint").alias("_key"), F.col(group).alias("_group"))
    zones = (F.col("key") == F.col("_key")) & (F.col("role") != MONTH_ROLE)
    name = F.when(F.col("role") == MONTH_ROLE, month_name(F.col("key"))).otherwise(F.col("_group"))
    return counts.join(entries, zones, "left").groupBy("role", name.alias("name")).agg(F.sum("count").alias("count"))


def counts_of(counts: DataFrame, role: str, name: str, count: str = "count") -> DataFrame:
    """One role of ``fleet_counts`` as a report of its own."""
    return counts.filter(F.col("role") == role).select(F.col("name").alias(name), F.col("count").alias(count))


def top_k(counts: DataFrame, key: str, k: int = 5, count: str = "count") -> DataFrame:
    """The k largest counts, largest first; equal counts are ordered by key."""
    return counts.orderBy(F.desc(count), F.asc_nulls_first(key)).limit(k)


def share(df: DataFrame, condition: Column, name: str) -> DataFrame:
    """One row: the percentage of rows that meet a condition, NULL without rows.

    Rows where the condition is NULL count towards the total only.
    """
    return df.agg((F.try_divide(F.count_if(condition), F.count("*")) * 100).alias(name))


def solo_share(trips: DataFrame, passengers: str = "passenger_count") -> DataFrame:
    """The percentage of trips with exactly one passenger; a count in text is read as a number."""
    return share(trips, number(trips, passengers) == 1, "percentage_solo")
