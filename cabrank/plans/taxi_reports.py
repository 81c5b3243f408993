"""All reports over a year of taxi trips, for spark-submit.

    spark-submit cabrank/plans/taxi_reports.py --yellow DIR --green DIR --zones FILE --out DIR

Both fleets are read and judged once and stored as Parquet, rejected trips apart
with what is wrong with them; the reports read the few columns they need from
there, and all counts per zone and month come from one pass. Connection settings of an object store
belong to spark-submit (``--conf spark.hadoop.fs.s3a.*``).
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cabrank.functions.conditions import expensive_short
from cabrank.functions.text import percent
from cabrank.operators.clean import checks, judged_trips, with_month
from cabrank.operators.counts import counts_of, fleet_counts, solo_share, top_k
from cabrank.operators.enrich import enrich_zones, summary
from cabrank.operators.ratios import ratio_outliers
from cabrank.operators.series import daily_anomalies, daily_counts, filtered_daily, in_range, mean_day, peak_of
from cabrank.schema import FAILED, GREEN, MONTH, MONTH_ROLE, ROLES, TIME_FORMAT, WRITTEN, YELLOW, ZONE_KEY, Fleet
from cabrank.sinks.reports import (
    Split,
    commit_run,
    report_path,
    run_stamp,
    stage_split,
    stage_table,
    write_report,
    write_rows,
)
from cabrank.sources.trips import read_lookup, read_trips

class ReportRun:
    """Where the reports of one run go, and what they are called."""

    def __init__(self, out: str, run_id: str, preview: bool = True):
        self.out, self.run_id, self.preview = out, run_id, preview
        self.reports: list[tuple[str, str, StructType]] = []

    def path(self, task: str, name: str) -> str:
        return report_path(self.out, task, name, self.run_id)

    def publish(self, df: DataFrame, task: str, name: str) -> DataFrame:
        """Write an aggregated report, show it from the stored file, return that."""
        stored = write_report(df, self.path(task, name), single_file=True)
        self.reports.append((task, name, stored.schema))
        if self.preview:
            stored.show()
        return stored

    def publish_rows(self, df: DataFrame, task: str, name: str) -> DataFrame:
        """Write a row-level report from all tasks."""
        stored = write_rows(df, self.path(task, name))
        self.reports.append((task, name, stored.schema))
        return stored

    def commit(self, spark: SparkSession) -> None:
        """Make the run count: only now ``latest_report`` finds its reports."""
        commit_run(spark, self.out, self.run_id, self.reports)


def split_fleet(trips: DataFrame, fleet: Fleet, path: str, by_month: bool = False, fmt: str = TIME_FORMAT) -> Split:
    """Judge the trips of a fleet and store them, rejected ones apart, in one pass that also counts them.

    ``counts`` has the rows read, those rejected, and those that fail each check.
    """
    names = tuple(checks(trips, fleet.pickup, fleet.dropoff))
    judged = judged_trips(trips, fleet.pickup, fleet.dropoff, fmt=fmt)
    bad = F.col(FAILED) != 0
    counts = {"rejected": bad} | {name: F.col(FAILED).bitwiseAND(1 << n) != 0 for n, name in enumerate(names)}
    if by_month:
        judged = with_month(judged, fleet.pickup)
    return stage_split(judged, path, bad, counts, MONTH if by_month else None)


def stage_fleet(trips: DataFrame, fleet: Fleet, path: str, by_month: bool = False) -> DataFrame:
    """The clean trips of a fleet, stored."""
    return split_fleet(trips, fleet, path, by_month).kept.drop(FAILED, WRITTEN)


def summary_of(kept: DataFrame, rows: int, zones: DataFrame) -> DataFrame:
    """The summary of the trips with their zones, from rows that were counted on the way.

    They are as many as before if no zone id has several entries; else they are
    counted.
    """
    enriched = enrich_zones(kept, zones)
    enriched.printSchema()
    if zones.groupBy(ZONE_KEY).count().filter("count > 1").isEmpty():
        columns = F.lit(len(enriched.columns)).alias("column_count")
        return kept.sparkSession.range(1).select(F.lit(rows).cast("long").alias("row_count"), columns)
    return summary(enriched)


def fleet_reports(run: ReportRun, fleet: Fleet, split: Split, zones: DataFrame) -> None:
    """The reports that exist for every fleet; all counts come from one pass over its trips."""
    title, prefix = fleet.title, fleet.title.lower()
    trips = split.kept.drop(FAILED, WRITTEN)

    dropped = " ".join(f"{name}={rows}" for name, rows in split.counts.items())
    print(f"{title}: {dropped}")
    summary_of(trips, split.counts["rows"] - split.counts["rejected"], zones).show()

    counts = stage_table(fleet_counts(trips, zones, fleet.pickup), run.path("counts", fleet.taxi_type))
    for role in ROLES:
        borough, column = f"{role}_Borough", f"{title}_{role}_Count"
        stored = run.publish(counts_of(counts, role, borough, column), "task2", f"{prefix}_{role.lower()}_counts")
        top = top_k(stored.withColumnRenamed(column, "count"), borough)
        run.publish(top, "task4", f"top_{prefix}_{role.lower()}")

    solo_share(trips).select(F.lit(title).alias("fleet"), percent(F.col("percentage_solo")).alias("solo")).show()
    run.publish(peak_of(counts_of(counts, MONTH_ROLE, "pickup_month")), "task8", f"month_{prefix}")


def yellow_reports(run: ReportRun, trips: DataFrame, year: int, month: str | None = None) -> None:
    """The reports about particular weeks of the yellow fleet; ``month`` is the column its pickups are stored by."""
    time = YELLOW.pickup
    dear = expensive_short(trips, time=time, first_day=date(year, 1, 1), last_day=date(year, 1, 7), month=month)
    run.publish(filtered_daily(trips, time, dear), "task3", "daily_trip_counts")

    june = daily_counts(trips, time, f"{year}-06-01", f"{year}-07-01", month)
    stored = run.publish(june, "task5", "trip_count")
    mean_day(stored).show()
    run.publish(daily_anomalies(stored), "task5", "anomalies")

    march = in_range(trips, time, f"{year}-03-01", f"{year}-04-01", month)
    run.publish_rows(ratio_outliers(march), "task6", "fare_per_mile")


def run_reports(
    spark: SparkSession,
    yellow: str,
    green: str,
    zones: str,
    out: str,
    run_id: str | None = None,
    fmt: str = "csv",
    by_month: bool = False,
    preview: bool = True,
    year: int = 2023,
) -> ReportRun:
    """Read, clean, store, and write every report under ``out``."""
    run = ReportRun(out, run_id or run_stamp(), preview)
    lookup = read_lookup(spark, zones)
    staged = {
        fleet: split_fleet(read_trips(spark, path, fmt, fleet), fleet, run.path("trips", fleet.taxi_type), by_month)
        for fleet, path in ((YELLOW, yellow), (GREEN, green))
    }
    for fleet, split in staged.items():
        fleet_reports(run, fleet, split, lookup)
    yellow_reports(run, staged[YELLOW].kept, year, MONTH if by_month else None)
    run.commit(spark)
    return run


def main(argv: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Reports over a year of taxi trips")
    parser.add_argument("--yellow", required=True, help="folder of yellow trips")
    parser.add_argument("--green", required=True, help="folder of green trips")
    parser.add_argument("--zones", required=True, help="zone lookup, CSV")
    parser.add_argument("--out", required=True, help="folder for the reports")
    parser.add_argument("--run-id", help="name of the run, by default its time")
    parser.add_argument("--format", default="csv", choices=("csv", "parquet"), help="format of the trips")
    parser.add_argument("--by-month", action="store_true", help="store the cleaned trips by pickup month")
    parser.add_argument("--year", type=int, default=2023, help="year of the trips")
    args = parser.parse_args(argv)

    spark = SparkSession.builder.appName("taxi-reports").getOrCreate()
    run_reports(
        spark,
        args.yellow,
        args.green,
        args.zones,
        args.out,
        run_id=args.run_id,
        fmt=args.format,
        by_month=args.by_month,
        year=args.year,
    )
    spark.stop()


if __name__ == "__main__":
    main()
