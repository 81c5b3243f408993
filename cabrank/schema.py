"""Names and types shared by every trip function."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
MONTH = "trip_month"
#: Which checks a trip fails, one bit for each, and its values as they were written if it fails any.
FAILED, WRITTEN = "failed_checks", "written"


@dataclass(frozen=True)
class Fleet:
    """The columns in which a fleet records when a trip began and ended."""

    taxi_type: str
    title: str
    pickup: str
    dropoff: str


YELLOW = Fleet("yellow_taxi", "Yellow", "tpep_pickup_datetime", "tpep_dropoff_datetime")
GREEN = Fleet("green_taxi", "Green", "lpep_pickup_datetime", "lpep_dropoff_datetime")

AMOUNTS = ("trip_distance", "fare_amount")
TRIP_TYPES = {
    "trip_distance": "double",
    "fare_amount": "double",
    "passenger_count": "double",
    "PULocationID": "int",
    "DOLocationID": "int",
}

#: Which column holds the zone id of each role that a zone plays for a trip.
ROLES = {"Pickup": "PULocationID", "Dropoff": "DOLocationID"}
#: The role under which counts per month stand beside them.
MONTH_ROLE = "Month"

ZONE_KEY = "LocationID"
ZONE_COLUMNS = ("Borough", "Zone", "service_zone")
LOOKUP_SCHEMA = T.StructType(
    [T.StructField(ZONE_KEY, T.IntegerType())]
    + [T.StructField(name, T.StringType()) for name in ZONE_COLUMNS]
)
