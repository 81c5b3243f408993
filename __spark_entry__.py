"""Registered queries over the generated tables, each with its SQL counterpart."""

from __future__ import annotations

import os
import warnings
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cabrank.functions.text import percent
from cabrank.operators.clean import as_text, checks, clean_trips, judged_trips, reason_counts, typed, with_month
from cabrank.operators.counts import count_by, fleet_counts, solo_share, top_k, zone_counts
from cabrank.operators.enrich import summary
from cabrank.operators.ratios import ratio_outliers
from cabrank.operators.series import (
    daily_anomalies,
    daily_counts,
    filtered_daily,
    in_range,
    label_days,
    mean_day,
    peak_month,
    trips_per_month,
)
from cabrank.plans import order_trips as trips
from cabrank.plans.taxi_reports import ReportRun, split_fleet
from cabrank.schema import MONTH, YELLOW
from cabrank.sinks.partials import DayCounts
from cabrank.sinks.reports import latest_report, shared_folder, stage_table, write_report, write_rows
from cabrank.sources.inference import merged_types, type_states
from cabrank.sources.trips import read_folder, read_lookup, read_table, read_trips

try:
    import corpus_pipeline
    from cabrank.llm import queries as corpus
except ModuleNotFoundError as missing:
    parts = str(missing.name).split(".")
    if parts[0] == "cabrank" and parts[1:2] != ["llm"]:
        raise
    warnings.warn(f"no corpus queries: {missing.name} is not there", stacklevel=1)
    corpus = None

Query = Callable[[SparkSession, str], DataFrame]

FLEETS = ("O", "F")
JUNE = ("1998-06-01", "1998-07-01")
MARCH = ("1998-03-01", "1998-04-01")
US_TIME = "MM/dd/yyyy HH:mm:ss"


def _region_counts(role: str, status: str) -> Query:
    name, count = f"{role}_Borough", f"{status}_{role}_Count"
    return lambda spark, sf_dir: trips.zone_group_counts(spark, sf_dir, status, role, "Borough", name, count)


def _top_nations(role: str, status: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        name = f"{role}_Zone"
        return top_k(trips.zone_group_counts(spark, sf_dir, status, role, "Zone", name, "count"), name)

    return run


def _june_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_counts(trips.table(spark, sf_dir, "lineitem"), "l_shipdate", *JUNE)


def _first_week(python: bool) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        items = trips.table(spark, sf_dir, "lineitem")
        return filtered_daily(items, "l_shipdate", trips.first_week(items, python))

    return run


def _price_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    march = in_range(trips.table(spark, sf_dir, "lineitem"), "l_shipdate", *MARCH)
    return ratio_outliers(march, "l_extendedprice", "l_discount", factor=5, keep=("l_orderkey", "l_linenumber"))


def _solo(status: str) -> Query:
    return lambda spark, sf_dir: solo_share(trips.fleet(spark, sf_dir, status), "l_linenumber")


def _solo_text(status: str) -> Query:
    return lambda spark, sf_dir: _solo(status)(spark, sf_dir).select(
        percent(F.col("percentage_solo")).alias("percentage_solo")
    )


def _months(status: str) -> Query:
    return lambda spark, sf_dir: trips_per_month(trips.fleet(spark, sf_dir, status), "l_shipdate")


def _peak(status: str) -> Query:
    return lambda spark, sf_dir: peak_month(trips.fleet(spark, sf_dir, status), "l_shipdate")


def _clean_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_trips(trips.table(spark, sf_dir, "customer"), amounts=("c_acctbal",))


def _clean_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_trips(trips.text_trips(spark, sf_dir).select("o_orderkey", "pickup"), pickup="pickup", amounts=())


def _clean_fractions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event times kept to the second where they were recorded so."""
    events = trips.table(spark, sf_dir, "events")
    whole = F.when(F.col("event_type") == "error", F.date_trunc("second", "ts").cast("timestamp_ntz"))
    mixed = events.select("event_id", F.coalesce(whole, "ts").alias("ts"), "value")
    return clean_trips(mixed, "ts", amounts=("value",))


def _clean_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_trips(trips.text_trips(spark, sf_dir), pickup="pickup")


def _csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = trips.table(spark, sf_dir, "orders")
    path = shared_folder(spark, "orders")
    write_rows(orders, path)
    return read_table(spark, path, schema=orders.schema)


def _csv_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark, "suppliers")
    write_rows(trips.table(spark, sf_dir, "supplier"), path)
    return read_table(spark, path)


def _csv_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark, "customers")
    write_rows(trips.table(spark, sf_dir, "customer"), path)
    return read_table(spark, path, infer=True)


def _march_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = trips.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    return in_range(items, "l_shipdate", *MARCH)


def _stored_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """March again, from items stored by month."""
    items = trips.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    stored = stage_table(with_month(items, "l_shipdate"), shared_folder(spark, "items"), MONTH)
    return in_range(stored, "l_shipdate", *MARCH, month=MONTH).drop(MONTH)


def _dear_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = trips.table(spark, sf_dir, "lineitem")
    return items.filter(trips.first_week(items)).select("l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity")


def _stored_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ratios as a row-level report in the order of their time."""
    march = in_range(trips.table(spark, sf_dir, "lineitem"), "l_shipdate", *MARCH)
    ratios = ratio_outliers(march, "l_extendedprice", "l_discount", factor=5, keep=("l_shipdate",))
    return write_rows(ratios, shared_folder(spark, "ratios"), order_by="l_shipdate")


def _stored_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return write_report(_june_days(spark, sf_dir), shared_folder(spark, "daily"))


def _ordered_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with its time, which it is ordered by."""
    march = in_range(trips.table(spark, sf_dir, "lineitem"), "l_shipdate", *MARCH)
    ratios = ratio_outliers(march, "l_extendedprice", "l_discount", factor=5, keep=("l_shipdate",))
    return write_rows(ratios, shared_folder(spark, "ratios"), order_by="l_shipdate", keep_order=True)


def _second_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items stored by the month of one time, taken by another that may lie in a later month."""
    items = trips.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_shipdate", F.expr("l_shipdate + make_dt_interval(cast(l_quantity as int))").alias("arrival")
    )
    stored = stage_table(with_month(items, "l_shipdate"), shared_folder(spark, "items"), MONTH)
    return in_range(stored, "arrival", *MARCH).drop(MONTH)


def _clean_both_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    written = trips.written_trips(spark, sf_dir, US_TIME)
    return clean_trips(written, YELLOW.pickup, YELLOW.dropoff, fmt=US_TIME)


def _csv_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark, "trips")
    write_rows(trips.written_trips(spark, sf_dir), path)
    return clean_trips(read_trips(spark, path, fleet=YELLOW), YELLOW.pickup, YELLOW.dropoff)


def _csv_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips whose files differ in the order, the number and the spelling of their columns."""
    written = trips.written_trips(spark, sf_dir)
    kinds = [
        written,
        written.select(*reversed(written.columns)).withColumn("Airport_fee", F.lit("1.25")),
        written.withColumn("airport_fee", F.lit("2.5")).withColumnRenamed("fare_amount", "Fare_amount"),
    ]
    paths = [shared_folder(spark, f"mixed-{n}") for n in range(len(kinds))]
    for n, (rows, path) in enumerate(zip(kinds, paths, strict=True)):
        write_rows(rows.filter(F.col("passenger_count").cast("int") % len(kinds) == n), path)
    return clean_trips(read_folder(spark, paths, YELLOW), YELLOW.pickup, YELLOW.dropoff)


def _clean_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_trips(trips.written_trips(spark, sf_dir), YELLOW.pickup, YELLOW.dropoff)


def _fleet_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fleet_counts(_clean_written(spark, sf_dir), trips.zone_lookup(spark, sf_dir), YELLOW.pickup)


def _reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    written = trips.written_trips(spark, sf_dir)
    names = tuple(checks(written, YELLOW.pickup, YELLOW.dropoff))
    return reason_counts(judged_trips(written, YELLOW.pickup, YELLOW.dropoff), names)


def _rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rejected trips as they are stored apart, with one of their values as it was written."""
    split = split_fleet(trips.written_trips(spark, sf_dir), YELLOW, shared_folder(spark, "split"))
    return split.rejected.select("trip", "failed_checks", F.get_json_object("written", "$.fare_amount").alias("fare"))


def _staged_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What was counted while the trips were stored by month."""
    split = split_fleet(trips.written_trips(spark, sf_dir), YELLOW, shared_folder(spark, "split"), by_month=True)
    return spark.range(1).select(*(F.lit(rows).cast("long").alias(name) for name, rows in split.counts.items()))


def _counts_added(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items per day, of files that come in two lots; the second time only the new ones are read."""
    items, path = trips.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_shipdate"), shared_folder(spark, "lots")
    counts = DayCounts(spark, shared_folder(spark, "days"))
    for lot in (0, 1):
        items.filter(F.col("l_orderkey") % 2 == lot).write.mode("append").parquet(path)
        counts.update(path, "l_shipdate")
    return counts.daily()


def _latest_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of three runs the last is not complete, so its report does not count yet."""
    out = shared_folder(spark, "out")
    for n, status in enumerate(("O", "F", "O")):
        run = ReportRun(out, f"r{n}", preview=False)
        run.publish(trips_per_month(trips.fleet(spark, sf_dir, status), "l_shipdate"), "task8", "month")
        if n < 2:
            run.commit(spark)
    return latest_report(spark, out, "task8", "month")


def _inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Types of the columns of orders in text, from states of each status merged."""
    return merged_types(type_states(as_text(trips.table(spark, sf_dir, "orders")).withColumn("part", F.col("o_orderstatus")), "part"))


def _csv_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark, "zones")
    zones = trips.zone_lookup(spark, sf_dir).withColumn("LocationID", F.col("LocationID").cast("int"))
    write_report(zones, path, single_file=True)
    return read_lookup(spark, path)


def _stored(name: str) -> Query:
    """A table as a report, read back."""
    return lambda spark, sf_dir: write_report(trips.table(spark, sf_dir, name), shared_folder(spark, name))


def _job_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored, zones = trips.stored_fleet(spark, sf_dir)
    counts = zone_counts(stored, zones, "PULocationID", "Pickup_Borough", "Yellow_Pickup_Count")
    return write_report(counts, shared_folder(spark, "counts"), single_file=True)


def _job_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored, _ = trips.stored_fleet(spark, sf_dir)
    march = in_range(stored, YELLOW.pickup, *MARCH, month=MONTH)
    return write_rows(ratio_outliers(march, factor=5), shared_folder(spark, "ratios"))


def _written_week(python: bool) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        written = trips.written_trips(spark, sf_dir)
        return filtered_daily(written, YELLOW.pickup, trips.written_week(written, python))

    return run


def _solo_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    return solo_share(trips.written_trips(spark, sf_dir))


def queries() -> dict[str, Query]:
    """Every registered query, as a function of the session and the table folder."""
    found: dict[str, Query] = {
        "clean_nonneg": _clean_amounts,
        "clean_timestamps": _clean_times,
        "clean_fractions": _clean_fractions,
        "clean_trips": _clean_orders,
        "as_text": lambda spark, sf_dir: as_text(trips.table(spark, sf_dir, "orders")),
        "enrich_zones": trips.enriched_trips,
        "enrich_summary": lambda spark, sf_dir: summary(trips.enriched_trips(spark, sf_dir)),
        "enrich_unmatched": lambda spark, sf_dir: trips.pickup_trips(spark, sf_dir, "EUROPE"),
        "pickup_region_unmatched": lambda spark, sf_dir: trips.zone_group_counts(
            spark, sf_dir, "O", "Pickup", "Borough", "Pickup_Borough", "O_Pickup_Count", without="EUROPE"
        ),
        "expensive_short_daily": _first_week(python=False),
        "expensive_short_daily_udf": _first_week(python=True),
        "daily_counts": _june_days,
        "mean_day": lambda spark, sf_dir: mean_day(_june_days(spark, sf_dir)),
        "daily_labels": lambda spark, sf_dir: label_days(_june_days(spark, sf_dir)),
        "daily_anomalies": lambda spark, sf_dir: daily_anomalies(_june_days(spark, sf_dir)),
        "in_range": _march_items,
        "stored_by_month": _stored_by_month,
        "expensive_short": _dear_items,
        "typed_columns": lambda spark, sf_dir: typed(trips.text_items(spark, sf_dir)),
        "count_by": lambda spark, sf_dir: count_by(trips.table(spark, sf_dir, "orders"), "o_custkey"),
        "ratio_outliers": _price_ratios,
        "stored_ratios": _stored_ratios,
        "csv_round_trip": _csv_round_trip,
        "csv_text": _csv_text,
        "csv_inferred": _csv_inferred,
        "stored_report": _stored_report,
        "enrich_zones_spread": lambda spark, sf_dir: trips.enriched_trips(spark, sf_dir, small=False),
        "enrich_zones_stored": trips.enriched_from_stored,
        "enrich_summary_spread": lambda spark, sf_dir: summary(trips.enriched_trips(spark, sf_dir, small=False)),
        "stored_second_time": _second_time,
        "clean_both_times": _clean_both_times,
        "expensive_short_text": _written_week(python=False),
        "expensive_short_text_udf": _written_week(python=True),
        "csv_trips_typed": _csv_trips,
        "csv_lookup": _csv_lookup,
        "csv_conversations": _stored("conversations"),
        "csv_events": _stored("events"),
        "ordered_ratios": _ordered_ratios,
        "csv_mixed_headers": _csv_mixed,
        "fleet_counts": _fleet_counts,
        "rejected_reasons": _reasons,
        "rejected_trips": _rejected,
        "staged_counts": _staged_counts,
        "daily_counts_added": _counts_added,
        "latest_report": _latest_report,
        "inferred_types": _inferred,
        "job_pickup_counts": _job_counts,
        "job_fare_per_mile": _job_ratios,
        "daily_counts_from": lambda spark, sf_dir: daily_counts(
            trips.table(spark, sf_dir, "lineitem"), "l_shipdate", start=JUNE[0]
        ),
        "solo_share_text": _solo_written,
    }
    for status in FLEETS:
        for role in trips.ROLES:
            found[f"{role.lower()}_region_{status}"] = _region_counts(role, status)
            found[f"top5_{role.lower()}_nation_{status}"] = _top_nations(role, status)
        found[f"solo_share_{status}"] = _solo(status)
        found[f"solo_text_{status}"] = _solo_text(status)
        found[f"trips_per_month_{status}"] = _months(status)
        found[f"peak_month_{status}"] = _peak(status)
    if corpus is not None:
        found |= corpus.queries() | {"pipeline": corpus_pipeline.run}
    return found


def entry(spark: SparkSession) -> DataFrame:
    """Trips per pickup region, on the tables of ``ENTRY_SF_DIR`` or else the smallest generated ones."""
    return queries()["pickup_region_O"](spark, os.environ.get("ENTRY_SF_DIR", "/root/testdata/sf0.001"))


ZONES = """(select n_nationkey as location, r_name as borough, n_name as zone,
            cast(n_regionkey as varchar) as service_zone
            from nation left join region on n_regionkey = r_regionkey)"""

NATIONS = {
    "Pickup": "lineitem left join supplier on l_suppkey = s_suppkey left join {zones} z on s_nationkey = location",
    "Dropoff": """lineitem left join orders on l_orderkey = o_orderkey left join customer on o_custkey = c_custkey
                  left join {zones} z on c_nationkey = location""",
}

ENRICHED = f"""select l_orderkey, l_linenumber, l_suppkey, l_quantity, l_extendedprice, l_shipdate,
    s_nationkey as "PULocationID", c_nationkey as "DOLocationID",
    p.borough as "Pickup_Borough", p.zone as "Pickup_Zone", p.service_zone as "Pickup_service_zone",
    d.borough as "Dropoff_Borough", d.zone as "Dropoff_Zone", d.service_zone as "Dropoff_service_zone"
    from lineitem left join supplier on l_suppkey = s_suppkey
    left join orders on l_orderkey = o_orderkey left join customer on o_custkey = c_custkey
    left join {ZONES} p on s_nationkey = p.location left join {ZONES} d on c_nationkey = d.location"""

WEEK = """select strftime(l_shipdate, '%Y-%m-%d') as "Date", count(*) as "count" from lineitem
    where l_shipdate >= timestamp '1998-01-01' and l_shipdate < timestamp '1998-01-08'
    and l_extendedprice > 50000 and l_quantity < 20 group by 1 order by 1"""

DAILY = """select cast(l_shipdate as date) as pickup_day, count(*) as total_trips from lineitem
    where l_shipdate >= timestamp '1998-06-01' and l_shipdate < timestamp '1998-07-01' group by 1"""

LABELLED = f"""select pickup_day, total_trips,
    case when total_trips > mean_trips * 1.1::double then 'High Anomaly'
         when total_trips < mean_trips * 0.9::double then 'Low Anomaly' else 'Normal' end as anomaly
    from ({DAILY}) series, (select avg(total_trips) as mean_trips from ({DAILY}) again) mean"""

TEXT_TRIPS = """(select cast(o_orderkey as varchar) as o_orderkey,
    case o_orderpriority when '1-URGENT' then strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S')
         when '2-HIGH' then strftime(o_orderdate, '%Y-%m-%d')
         when '3-MEDIUM' then strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') || '.5'
         else strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') end as pickup,
    case o_orderstatus when 'P' then 'nan'::double when 'F' then o_totalprice / 100 else 0 end as trip_distance,
    o_totalprice - 100000 as fare_amount from orders) written"""

MARCH_SQL = "l_shipdate >= timestamp '1998-03-01' and l_shipdate < timestamp '1998-04-01'"

PARSED = "try_strptime(pickup, '%Y-%m-%d %H:%M:%S')"


WRITTEN = """(select l_orderkey || '-' || l_linenumber as trip, l_linenumber, l_shipdate as tpep_pickup_datetime,
    l_shipdate + to_hours(l_quantity::integer) as tpep_dropoff_datetime,
    case when l_linenumber <> 4 then l_quantity end as trip_distance,
    case when l_linenumber < 5 then l_extendedprice end as fare_amount, l_linenumber::double as passenger_count,
    (l_suppkey % 25)::integer as "PULocationID", (l_partkey % 25)::integer as "DOLocationID" from lineitem) written"""

KEPT = f"""(select * exclude (l_linenumber) from {WRITTEN}
    where l_linenumber not in (2, 3) and trip_distance >= 0 and fare_amount >= 0) kept"""

NUMBER = r"\s*[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?\s*"

#: What is wrong with a written trip, by its line number: one bit, or one name, for each check.
FAILED_BITS = "case when l_linenumber >= 5 then 8 when l_linenumber >= 2 then 1 << (l_linenumber - 2)::integer else 0 end"
FAILED_NAMES = """[case l_linenumber when 2 then 'tpep_pickup_datetime' when 3 then 'tpep_dropoff_datetime'
    when 4 then 'trip_distance' when 5 then 'fare_amount' when 6 then 'fare_amount' when 7 then 'fare_amount' end]"""
WRITTEN_WEEK = f"""select strftime(tpep_pickup_datetime, '%Y-%m-%d') as "Date", count(*) as "count" from {WRITTEN}
    where l_linenumber <> 2 and tpep_pickup_datetime >= timestamp '1998-01-01'
    and tpep_pickup_datetime < timestamp '1998-01-08' and fare_amount > 50000 and trip_distance < 20 group by 1"""


def _region_sql(role: str, status: str, zones: str = ZONES) -> str:
    return f"""select z.borough as "{role}_Borough", count(*) as "{status}_{role}_Count"
        from {NATIONS[role].format(zones=zones)} where l_linestatus = '{status}' group by 1"""


def _top_sql(role: str, status: str) -> str:
    return f"""select z.zone as "{role}_Zone", count(*) as "count"
        from {NATIONS[role].format(zones=ZONES)} where l_linestatus = '{status}'
        group by 1 order by 2 desc, 1 nulls first limit 5"""


def _solo_sql(status: str) -> str:
    return f"""select (count(*) filter (where l_linenumber = 1))::double / count(*) * 100 as percentage_solo
        from lineitem where l_linestatus = '{status}'"""


def _months_sql(status: str) -> str:
    return f"""select monthname(l_shipdate) as pickup_month, count(*) as "count"
        from lineitem where l_linestatus = '{status}' group by 1"""


def oracle_sql() -> dict[str, str]:
    """The same queries in SQL, written without regard to how they are run above."""
    no_europe = f"(select * from {ZONES} every_zone where borough <> 'EUROPE')"
    found = {
        "clean_nonneg": "select * from customer where c_acctbal >= 0",
        "clean_timestamps": f"select o_orderkey, {PARSED} as pickup from {TEXT_TRIPS} where {PARSED} is not null",
        "clean_fractions": """select event_id, ts, value from (select event_id, value,
            case event_type when 'error' then date_trunc('second', ts) else ts end as ts from events) recorded
            where ts = date_trunc('second', ts) and value >= 0""",
        "clean_trips": f"""select o_orderkey, {PARSED} as pickup, trip_distance, fare_amount from {TEXT_TRIPS}
            where {PARSED} is not null and not isnan(trip_distance) and trip_distance >= 0 and fare_amount >= 0""",
        "as_text": """select o_orderkey::varchar as o_orderkey, o_custkey::varchar as o_custkey, o_orderstatus,
            o_totalprice::varchar as o_totalprice, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') as o_orderdate,
            o_orderpriority from orders""",
        "enrich_zones": ENRICHED,
        "enrich_summary": f"select count(*) as row_count, 14 as column_count from ({ENRICHED}) enriched",
        "enrich_unmatched": f"""select l_orderkey, l_linenumber, l_suppkey, s_nationkey as "PULocationID",
            z.borough as "Pickup_Borough", z.zone as "Pickup_Zone", z.service_zone as "Pickup_service_zone"
            from {NATIONS["Pickup"].format(zones=no_europe)}""",
        "pickup_region_unmatched": _region_sql("Pickup", "O", no_europe),
        "expensive_short_daily": WEEK,
        "expensive_short_daily_udf": WEEK,
        "daily_counts": DAILY,
        "mean_day": f"select avg(total_trips) as mean_trips from ({DAILY}) series",
        "daily_labels": LABELLED,
        "daily_anomalies": f"""select pickup_day, total_trips from ({LABELLED}) labelled
            where anomaly <> 'Normal' order by 1""",
        "ratio_outliers": f"""with ratios as (select l_orderkey, l_linenumber,
                l_extendedprice / nullif(l_discount, 0) as fare_per_mile from lineitem where {MARCH_SQL})
            select l_orderkey, l_linenumber, fare_per_mile,
            fare_per_mile > (select avg(fare_per_mile) from ratios) * 5 as outlier from ratios""",
        "in_range": f"select l_orderkey, l_linenumber, l_shipdate from lineitem where {MARCH_SQL}",
        "stored_by_month": f"select l_orderkey, l_linenumber, l_shipdate from lineitem where {MARCH_SQL}",
        "expensive_short": """select l_orderkey, l_linenumber, l_extendedprice, l_quantity from lineitem
            where l_shipdate >= timestamp '1998-01-01' and l_shipdate < timestamp '1998-01-08'
            and l_extendedprice > 50000 and l_quantity < 20""",
        "typed_columns": """select l_orderkey, l_quantity as trip_distance,
            case when l_returnflag <> 'R' then l_extendedprice end as fare_amount,
            l_linenumber::double as passenger_count, l_suppkey::integer as "PULocationID",
            l_partkey::integer as "DOLocationID" from lineitem""",
        "count_by": """select o_custkey, count(*) as "count" from orders group by 1""",
        "stored_ratios": f"""with ratios as (select l_extendedprice / nullif(l_discount, 0) as fare_per_mile
                from lineitem where {MARCH_SQL})
            select fare_per_mile, fare_per_mile > (select avg(fare_per_mile) from ratios) * 5 as outlier from ratios""",
        "csv_round_trip": "select * from orders",
        "csv_text": """select s_suppkey::varchar as s_suppkey, s_name, s_nationkey::varchar as s_nationkey,
            s_acctbal::varchar as s_acctbal from supplier""",
        "csv_inferred": "select * from customer",
        "stored_report": DAILY,
        "enrich_zones_spread": ENRICHED,
        "enrich_zones_stored": ENRICHED,
        "enrich_summary_spread": f"select count(*) as row_count, 14 as column_count from ({ENRICHED}) enriched",
        "stored_second_time": """select * from (select l_orderkey, l_linenumber, l_shipdate,
            l_shipdate + to_days(l_quantity::integer) as arrival from lineitem) items
            where arrival >= timestamp '1998-03-01' and arrival < timestamp '1998-04-01'""",
        "clean_both_times": f"select * from {KEPT}",
        "expensive_short_text": WRITTEN_WEEK,
        "expensive_short_text_udf": WRITTEN_WEEK,
        "csv_trips_typed": f"select * from {KEPT}",
        "csv_lookup": f"""select location::integer as "LocationID", borough as "Borough", zone as "Zone", service_zone
            from {ZONES} z""",
        "csv_mixed_headers": f"""select *, case passenger_count::integer % 3 when 1 then '1.25' when 2 then '2.5' end
            as "Airport_fee" from {KEPT}""",
        "fleet_counts": f"""select 'Pickup' as role, borough as name, count(*) as "count"
                from {KEPT} left join {ZONES} z on "PULocationID" = location group by 2
            union all select 'Dropoff', borough, count(*)
                from {KEPT} left join {ZONES} z on "DOLocationID" = location group by 2
            union all select 'Month', monthname(tpep_pickup_datetime), count(*) from {KEPT} group by 2""",
        "rejected_reasons": f"""select reason, count(*) as "count" from (select unnest({FAILED_NAMES}) as reason
            from {WRITTEN}) failed where reason is not null group by 1""",
        "rejected_trips": f"""select l_orderkey || '-' || l_linenumber as trip, ({FAILED_BITS})::integer as failed_checks,
            case l_linenumber when 5 then l_extendedprice || 'd' when 6 then '0x1p3' when 7 then 'Infinity'
                else l_extendedprice::varchar end as fare from lineitem where l_linenumber >= 2""",
        "staged_counts": f"""select count(*) as "rows", count(*) filter ({FAILED_BITS} <> 0) as rejected,
            count(*) filter (l_linenumber = 2) as tpep_pickup_datetime,
            count(*) filter (l_linenumber = 3) as tpep_dropoff_datetime,
            count(*) filter (l_linenumber = 4) as trip_distance,
            count(*) filter (l_linenumber >= 5) as fare_amount from {WRITTEN}""",
        "daily_counts_added": "select cast(l_shipdate as date) as pickup_day, count(*) as total_trips from lineitem group by 1",
        "latest_report": _months_sql("F"),
        "inferred_types": f"""with cells as (unpivot (select o_orderkey::varchar as o_orderkey, o_custkey::varchar as o_custkey,
                o_orderstatus, o_totalprice::varchar as o_totalprice,
                strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') as o_orderdate, o_orderpriority from orders)
                on columns(*) into name "column" value text),
            fits as (select "column", text, regexp_full_match(text, '[+-]?[0-9]{{1,18}}') as whole,
                regexp_full_match(text, '{NUMBER}') as number,
                try_strptime(text, '%Y-%m-%d %H:%M:%S') is not null as moment from cells)
            select "column", count(*) as filled, count(*) filter (whole) as as_bigint, count(*) filter (number) as as_double,
            count(*) filter (moment) as as_timestamp_ntz, min(text) filter (not whole) as against_bigint,
            min(text) filter (not number) as against_double, min(text) filter (not moment) as against_timestamp_ntz,
            case when bool_and(whole) then 'bigint' when bool_and(number) then 'double'
                when bool_and(moment) then 'timestamp_ntz' else 'string' end as type from fits group by 1""",
        "csv_conversations": "select * from conversations",
        "csv_events": "select * from events",
        "ordered_ratios": f"""with ratios as (select l_shipdate, l_extendedprice / nullif(l_discount, 0)
                as fare_per_mile from lineitem where {MARCH_SQL})
            select l_shipdate, fare_per_mile, fare_per_mile > (select avg(fare_per_mile) from ratios) * 5 as outlier
            from ratios""",
        "job_pickup_counts": f"""select borough as "Pickup_Borough", count(*) as "Yellow_Pickup_Count"
            from {KEPT} left join {ZONES} z on "PULocationID" = location group by 1""",
        "job_fare_per_mile": f"""with ratios as (select fare_amount / nullif(trip_distance, 0) as fare_per_mile
                from {KEPT} where tpep_pickup_datetime >= timestamp '1998-03-01'
                and tpep_pickup_datetime < timestamp '1998-04-01')
            select fare_per_mile, fare_per_mile > (select avg(fare_per_mile) from ratios) * 5 as outlier from ratios""",
        "daily_counts_from": """select cast(l_shipdate as date) as pickup_day, count(*) as total_trips from lineitem
            where l_shipdate >= timestamp '1998-06-01' group by 1""",
        "solo_share_text": """select (count(*) filter (where l_linenumber = 1))::double / count(*) * 100
            as percentage_solo from lineitem""",
    }
    for status in FLEETS:
        for role in trips.ROLES:
            found[f"{role.lower()}_region_{status}"] = _region_sql(role, status)
            found[f"top5_{role.lower()}_nation_{status}"] = _top_sql(role, status)
        found[f"solo_share_{status}"] = _solo_sql(status)
        found[f"solo_text_{status}"] = f"""select printf('%.2f%%', percentage_solo) as percentage_solo
            from ({_solo_sql(status)}) share"""
        found[f"trips_per_month_{status}"] = _months_sql(status)
        found[f"peak_month_{status}"] = f"""select pickup_month, "count" as trip_count from ({_months_sql(status)}) m
            order by 2 desc, 1 limit 1"""
    if corpus is not None:
        found |= corpus.oracle_sql()
    return found
