"""The trip reports over order tables.

A shipped line item plays a trip: its status names the fleet, its ship date is
the pickup time, the supplier's nation is where it starts and the customer's
nation where it ends. Nations with their regions are the zone lookup. Suppliers
and customers grow with the line items, so finding the two nations takes joins
that a taxi trip, which carries its zone ids, does not need.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cabrank.functions.conditions import between_times, expensive_short
from cabrank.functions.udfs import expensive_short_udf
from cabrank.operators.counts import carry_counts, count_by
from cabrank.operators.enrich import attach_zone, enrich_zones
from cabrank.operators.lookup import all_fits, fits_broadcast, join_stored, key_sample, left_lookup, store_lookup
from cabrank.plans.taxi_reports import stage_fleet
from cabrank.schema import TIME_FORMAT, YELLOW
from cabrank.sinks.reports import shared_folder, write_report, write_rows
from cabrank.sources.trips import read_lookup, read_trips

ROLES = ("Pickup", "Dropoff")
FIRST_WEEK = {"first_day": date(1998, 1, 1), "last_day": date(1998, 1, 7)}
LIMITS = {"min_fare": 50_000, "max_distance": 20}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fleet(spark: SparkSession, sf_dir: str, status: str) -> DataFrame:
    """The line items of one fleet."""
    return table(spark, sf_dir, "lineitem").filter(F.col("l_linestatus") == status)


def zone_lookup(spark: SparkSession, sf_dir: str, without: str | None = None) -> DataFrame:
    """Nations as zones and regions as boroughs, if need be lacking one region."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    zones = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left").select(
        F.col("n_nationkey").alias("LocationID"),
        F.col("r_name").alias("Borough"),
        F.col("n_name").alias("Zone"),
        F.col("n_regionkey").cast("string").alias("service_zone"),
    )
    return zones if without is None else zones.filter(F.col("Borough") != without)


def nation_counts(spark: SparkSession, sf_dir: str, status: str, role: str, count: str = "count") -> DataFrame:
    """Trips of a fleet per nation of one role.

    Counts travel from key to key, folded at every step, so neither a popular
    supplier nor a busy customer ever has its line items in one place.
    """
    trips = fleet(spark, sf_dir, status)
    if role == "Pickup":
        per_supplier = count_by(trips, "l_suppkey", count)
        suppliers = table(spark, sf_dir, "supplier")
        return carry_counts(per_supplier, suppliers, "l_suppkey", "s_suppkey", "s_nationkey", "nation", count)
    per_order, orders = count_by(trips, "l_orderkey", count), table(spark, sf_dir, "orders")
    per_customer = carry_counts(per_order, orders, "l_orderkey", "o_orderkey", "o_custkey", "o_custkey", count)
    customers = table(spark, sf_dir, "customer")
    return carry_counts(per_customer, customers, "o_custkey", "c_custkey", "c_nationkey", "nation", count)


def zone_group_counts(
    spark: SparkSession,
    sf_dir: str,
    status: str,
    role: str,
    group: str,
    name: str,
    count: str,
    without: str | None = None,
) -> DataFrame:
    """Trips of a fleet per region (``Borough``) or nation (``Zone``) of one role."""
    counts = nation_counts(spark, sf_dir, status, role, count)
    return carry_counts(counts, zone_lookup(spark, sf_dir, without), "nation", "LocationID", group, name, count)


ITEM = ("l_orderkey", "l_linenumber")


def with_pickup_id(
    spark: SparkSession, sf_dir: str, trips: DataFrame, keys_from: DataFrame | None = None, small: bool | None = None
) -> DataFrame:
    """Line items with the nation of their supplier."""
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_nationkey").alias("PULocationID"))
    return left_lookup(trips, suppliers, "l_suppkey", "s_suppkey", keys_from, small, ITEM).drop("s_suppkey")


def with_dropoff_id(
    spark: SparkSession,
    sf_dir: str,
    trips: DataFrame,
    keys_from: DataFrame | None = None,
    small: bool | None = None,
    few_customers: bool | None = None,
) -> DataFrame:
    """Line items with the nation of their customer, by way of the order.

    Orders get the nation first, as they are the narrower side to move. There is
    one row of them either way, so their own size decides about a broadcast.
    """
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    customers = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("DOLocationID"))
    located = left_lookup(orders, customers, "o_custkey", "c_custkey", small=few_customers, spread_on=["o_orderkey"])
    located = located.drop("c_custkey", "o_custkey")
    if small is None:
        small = fits_broadcast(orders)
    return left_lookup(trips, located, "l_orderkey", "o_orderkey", keys_from, small, ITEM).drop("o_orderkey")


def enriched_trips(spark: SparkSession, sf_dir: str, small: bool | None = None) -> DataFrame:
    """All line items with the zones of both roles. ``small`` answers for all three lookups, else each is measured."""
    trips = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate"
    )
    zones = zone_lookup(spark, sf_dir)
    if small is None:
        keys = (("supplier", "s_suppkey", "s_nationkey"), ("orders", "o_orderkey", "o_custkey"), ("customer", "c_custkey"))
        suppliers, orders, customers, areas = all_fits(
            [*(table(spark, sf_dir, name).select(*columns) for name, *columns in keys), zones]
        )
    else:
        suppliers = orders = customers = small
        areas = None
    sample = None if suppliers and orders else key_sample(trips, "l_suppkey", "l_orderkey")
    picked = with_pickup_id(spark, sf_dir, trips, sample, suppliers)
    located = with_dropoff_id(spark, sf_dir, picked, sample, orders, customers)
    return enrich_zones(located, zones, small=areas)


def enriched_from_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with suppliers and located orders stored by their keys, as for many such runs over one set of lookups."""
    trips = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate"
    )
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_nationkey").alias("PULocationID"))
    customers = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("DOLocationID"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    located = left_lookup(orders, customers, "o_custkey", "c_custkey", spread_on=["o_orderkey"]).drop("c_custkey", "o_custkey")
    by_supplier = store_lookup(suppliers, "s_suppkey", "suppliers")
    by_order = store_lookup(located, "o_orderkey", "orders")
    sample = key_sample(trips, "l_suppkey", "l_orderkey")
    picked = join_stored(trips, by_supplier, "l_suppkey", "s_suppkey", sample, ITEM).drop("s_suppkey")
    dropped = join_stored(picked, by_order, "l_orderkey", "o_orderkey", sample, ITEM).drop("o_orderkey")
    return enrich_zones(dropped, zone_lookup(spark, sf_dir))


def pickup_trips(spark: SparkSession, sf_dir: str, without: str) -> DataFrame:
    """All line items with their pickup zone, from a lookup that lacks a region."""
    trips = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    located = with_pickup_id(spark, sf_dir, trips)
    return attach_zone(located, zone_lookup(spark, sf_dir, without), "PULocationID", "Pickup")


def written_week(trips: DataFrame, python: bool = False) -> Column:
    """The same condition on trips in text, in either form."""
    if not python:
        return expensive_short(trips, time=YELLOW.pickup, **FIRST_WEEK, **LIMITS)
    return expensive_short_udf(**FIRST_WEEK, **LIMITS)(YELLOW.pickup, "fare_amount", "trip_distance")


def first_week(trips: DataFrame, python: bool = False) -> Column:
    """Dear and small shipments of the first week of 1998, as a condition.

    The Python variant keeps the native range beside it, which reaches the scan,
    so that only the rows of the week travel to Python.
    """
    if not python:
        return expensive_short(
            trips, time="l_shipdate", fare="l_extendedprice", distance="l_quantity", **FIRST_WEEK, **LIMITS
        )
    text = [F.col(name).cast("string") for name in ("l_shipdate", "l_extendedprice", "l_quantity")]
    week = between_times(trips, "l_shipdate", "1998-01-01", "1998-01-08")
    return week & expensive_short_udf(**FIRST_WEEK, **LIMITS)(*text)


def text_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders written as trips in text, some of them malformed.

    The order priority decides how the pickup time is written, the status how
    the distance is; fares below the offset come out negative.
    """
    written = F.col("o_orderdate").cast("string")
    priority, status = F.col("o_orderpriority"), F.col("o_orderstatus")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("o_orderkey"),
        F.when(priority == "1-URGENT", F.translate(written, " ", "T"))
        .when(priority == "2-HIGH", F.col("o_orderdate").cast("date").cast("string"))
        .when(priority == "3-MEDIUM", F.concat(written, F.lit(".5")))
        .otherwise(written)
        .alias("pickup"),
        F.when(status == "P", F.lit("NaN"))
        .when(status == "F", (F.col("o_totalprice") / 100).cast("string"))
        .otherwise(F.lit("0.0"))
        .alias("trip_distance"),
        (F.col("o_totalprice") - 100_000).cast("string").alias("fare_amount"),
    )


def text_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with their figures as text, ids with a decimal point, some fares not numbers."""
    fare = F.when(F.col("l_returnflag") == "R", F.lit("n/a")).otherwise(F.col("l_extendedprice").cast("string"))
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        F.col("l_quantity").cast("string").alias("trip_distance"),
        fare.alias("fare_amount"),
        F.col("l_linenumber").cast("string").alias("passenger_count"),
        F.col("l_suppkey").cast("double").cast("string").alias("PULocationID"),
        F.concat(F.lit(" "), F.col("l_partkey").cast("string")).alias("DOLocationID"),
    )


def written_trips(spark: SparkSession, sf_dir: str, fmt: str = TIME_FORMAT) -> DataFrame:
    """Line items as a taxi fleet writes its trips, all in text, some of them malformed.

    The line number decides what is wrong: a pickup without a time of day, a
    dropoff with a fraction of a second, a distance that is not a number, or a
    fare in a spelling that is no plain decimal.
    """
    line, fare = F.col("l_linenumber"), F.col("l_extendedprice").cast("string")
    arrival = F.expr("l_shipdate + make_dt_interval(0, cast(l_quantity as int))")
    day, moment = F.date_format("l_shipdate", fmt.split(" ")[0]), F.date_format("l_shipdate", fmt)
    dropoff = F.date_format(arrival, fmt)
    return table(spark, sf_dir, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("trip"),
        F.when(line == 2, day).otherwise(moment).alias(YELLOW.pickup),
        F.when(line == 3, F.concat(dropoff, F.lit(".5"))).otherwise(dropoff).alias(YELLOW.dropoff),
        F.when(line == 4, "NaN").otherwise(F.col("l_quantity").cast("string")).alias("trip_distance"),
        F.when(line == 5, F.concat(fare, F.lit("d")))
        .when(line == 6, "0x1p3")
        .when(line == 7, "Infinity")
        .otherwise(fare)
        .alias("fare_amount"),
        line.cast("string").alias("passenger_count"),
        (F.col("l_suppkey") % 25).cast("double").cast("string").alias("PULocationID"),
        (F.col("l_partkey") % 25).cast("string").alias("DOLocationID"),
    )


def stored_fleet(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Trips and zones by the way of a report run: CSV files, typed scan, cleaning, staging."""
    trips_path, zones_path = shared_folder(spark, "trips"), shared_folder(spark, "zones")
    write_rows(written_trips(spark, sf_dir), trips_path)
    zones = zone_lookup(spark, sf_dir).withColumn("LocationID", F.col("LocationID").cast("int"))
    write_report(zones, zones_path, single_file=True)
    trips = stage_fleet(read_trips(spark, trips_path, fleet=YELLOW), YELLOW, shared_folder(spark, "clean"), by_month=True)
    return trips, read_lookup(spark, zones_path)
