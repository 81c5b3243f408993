"""Attaching pickup and dropoff zones to trips."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cabrank.operators.lookup import fits_broadcast, left_lookup
from cabrank.schema import ZONE_COLUMNS, ZONE_KEY


def attach_zone(
    trips: DataFrame,
    lookup: DataFrame,
    key: str,
    role: str,
    keys_from: DataFrame | None = None,
    small: bool | None = None,
    spread_on: Sequence[str] | None = None,
) -> DataFrame:
    """Trips with the lookup's columns under one role, ``Pickup_Borough`` and so on.

    Every trip is kept; an id that is NULL or not in the lookup gives NULLs.
    """
    role_key = f"{role}_{ZONE_KEY}"
    zones = lookup.select(
        F.col(ZONE_KEY).alias(role_key), *[F.col(name).alias(f"{role}_{name}") for name in ZONE_COLUMNS]
    )
    return left_lookup(trips, zones, key, role_key, keys_from, small, spread_on).drop(role_key)


def enrich_zones(
    trips: DataFrame,
    lookup: DataFrame,
    pickup_key: str = "PULocationID",
    dropoff_key: str = "DOLocationID",
    keys_from: DataFrame | None = None,
    small: bool | None = None,
    spread_on: Sequence[str] | None = None,
) -> DataFrame:
    """Trips with the zone of their pickup and of their dropoff.

    The lookup is measured once for both roles. A report that needs one role
    only should use ``attach_zone``, as Spark cannot drop the unused left join.
    """
    if small is None:
        small = fits_broadcast(lookup.select(ZONE_KEY, *ZONE_COLUMNS))
    base = trips if keys_from is None else keys_from
    picked = attach_zone(trips, lookup, pickup_key, "Pickup", base, small, spread_on)
    return attach_zone(picked, lookup, dropoff_key, "Dropoff", base, small, spread_on)


def summary(df: DataFrame) -> DataFrame:
    """One row with the number of rows and the number of columns."""
    return df.agg(F.count("*").alias("row_count"), F.lit(len(df.columns)).alias("column_count"))
