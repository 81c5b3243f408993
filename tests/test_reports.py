"""Report functions on the hand-made trips and on published figures."""

from datetime import date

import fixtures
import pytest
from cabrank.functions.conditions import expensive_short
from cabrank.functions.text import percent
from cabrank.functions.udfs import expensive_short_udf
from cabrank.operators.counts import carry_counts, count_by, share, solo_share, top_k, zone_counts
from cabrank.operators.enrich import attach_zone, enrich_zones, summary
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
from cabrank.schema import YELLOW
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

PICKUP = YELLOW.pickup


def pairs(df):
    return sorted((tuple(row) for row in df.collect()), key=str)


@pytest.mark.parametrize("small", [True, False, None])
def test_enrich_keeps_every_trip(ansi, trips, zones, small):
    rows = enrich_zones(trips, zones, small=small)
    assert rows.columns == fixtures.TRIP_COLUMNS + [
        f"{role}_{name}" for role in ("Pickup", "Dropoff") for name in ("Borough", "Zone", "service_zone")
    ]
    shown = rows.select("id", "Pickup_Borough", "Pickup_Zone", "Dropoff_Borough", "Dropoff_service_zone")
    got = {row[0]: tuple(row[1:]) for row in shown.collect()}
    assert len(got) == rows.count() == 10
    assert got["y01"] == ("Manhattan", "Z1", "Queens", "Boro Zone")
    assert got["y04"] == ("Manhattan", "Z1", "Unknown", "N/A")
    assert got["y05"] == (None, None, None, None)
    assert got["y06"] == ("Queens", "Z2", "Manhattan", "Yellow Zone")


def test_summary(trips, zones):
    assert summary(enrich_zones(trips, zones)).collect() == [(10, 15)]


def test_zone_counts(ansi, trips, zones):
    picked = zone_counts(trips, zones, "PULocationID", "Pickup_Borough", "Yellow_Pickup_Count")
    assert picked.dtypes == [("Pickup_Borough", "string"), ("Yellow_Pickup_Count", "bigint")]
    assert pairs(picked) == pairs_of({"Manhattan": 6, "Queens": 3, None: 1})
    dropped = zone_counts(trips, zones, "DOLocationID", "Dropoff_Borough")
    assert pairs(dropped) == pairs_of({"Manhattan": 6, "Queens": 2, "Unknown": 1, None: 1})


def pairs_of(counts):
    return sorted(counts.items(), key=str)


def test_counting_first_equals_joining_first(trips, zones):
    doubled = zones.union(zones.filter("LocationID = 2").withColumn("Borough", F.lit("Elsewhere")))
    joined = count_by(attach_zone(trips, doubled, "PULocationID", "Pickup"), "Pickup_Borough")
    assert pairs(zone_counts(trips, doubled, "PULocationID", "Pickup_Borough")) == pairs(joined)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    keys=st.lists(st.one_of(st.none(), st.integers(0, 4)), max_size=30),
    entries=st.lists(
        st.tuples(st.one_of(st.none(), st.integers(0, 6)), st.one_of(st.none(), st.sampled_from("ab"))), max_size=8
    ),
)
def test_counting_first_on_any_data(spark, keys, entries):
    rows = spark.createDataFrame([(key,) for key in keys], "k int")
    lookup = spark.createDataFrame(entries, "lk int, name string")
    joined = count_by(rows.join(lookup, F.col("k") == F.col("lk"), "left"), "name")
    assert pairs(carry_counts(count_by(rows, "k"), lookup, "k", "lk", "name", "name")) == pairs(joined)


def test_carry_counts_on_empty_input(trips, zones):
    none = count_by(trips.limit(0), "PULocationID")
    assert carry_counts(none, zones, "PULocationID", "LocationID", "Borough", "b").collect() == []


@pytest.mark.parametrize("report", sorted(fixtures.BOROUGHS))
def test_top_boroughs_of_published_counts(spark, report):
    counts = spark.createDataFrame(fixtures.BOROUGHS[report], "borough string, count bigint")
    top = top_k(counts, "borough").collect()
    assert [row.borough for row in top] == fixtures.TOP_BOROUGHS[report]
    assert [tuple(row) for row in top] == sorted(fixtures.BOROUGHS[report], key=lambda row: -row[1])[:5]


def test_top_k_orders_equal_counts_by_key(spark):
    counts = spark.createDataFrame([("b", 1), ("c", 2), (None, 1), ("a", 1)], "k string, count bigint")
    assert [row.k for row in top_k(counts, "k", 3).collect()] == ["c", None, "a"]


def june(spark):
    rows = [(date(2023, 6, day), count) for day, count in enumerate(fixtures.JUNE_2023, 1)]
    return spark.createDataFrame(rows, "pickup_day date, total_trips bigint")


def test_anomalies_of_published_series(spark, ansi):
    daily = june(spark)
    assert mean_day(daily).first().mean_trips == pytest.approx(109199.633333)
    found = daily_anomalies(daily)
    assert found.columns == ["pickup_day", "total_trips"]
    assert [row.pickup_day.day for row in found.collect()] == sorted(fixtures.HIGH_DAYS + fixtures.LOW_DAYS)
    labels = {row.pickup_day.day: row.anomaly for row in label_days(daily).collect()}
    assert [day for day in sorted(labels) if labels[day] == "High Anomaly"] == fixtures.HIGH_DAYS
    assert [day for day in sorted(labels) if labels[day] == "Low Anomaly"] == fixtures.LOW_DAYS
    assert daily_anomalies(daily, labelled=True).columns == ["pickup_day", "total_trips", "anomaly"]


def test_a_day_on_the_threshold_is_normal(spark):
    # Mean 100: exactly 75 and 125 at these factors.
    days = [(date(2023, 6, 1), 75), (date(2023, 6, 2), 125), (date(2023, 6, 3), 100)]
    daily = spark.createDataFrame(days, "pickup_day date, total_trips bigint")
    assert daily_anomalies(daily, 1.25, 0.75).count() == 0
    assert daily_anomalies(daily, 1.24, 0.76).count() == 2


def test_no_days_no_anomalies(spark, ansi, trips):
    daily = daily_counts(trips, PICKUP, "2030-01-01", "2030-02-01")
    assert daily_anomalies(daily).collect() == []
    assert mean_day(daily).first().mean_trips is None


def test_daily_counts(ansi, trips):
    daily = daily_counts(trips, PICKUP, "2023-01-01", "2023-01-08")
    assert daily.dtypes == [("pickup_day", "date"), ("total_trips", "bigint")]
    assert pairs(daily) == [(date(2023, 1, 1), 1), (date(2023, 1, 2), 2), (date(2023, 1, 7), 1)]
    assert daily_counts(trips, PICKUP).agg(F.sum("total_trips")).first()[0] == 10


def test_range_is_half_open_on_text_and_typed_columns(ansi, raw_trips, trips):
    for rows in (trips, raw_trips.filter(F.col("id").startswith("y"))):
        march = in_range(rows, PICKUP, "2023-03-01", "2023-04-01")
        assert sorted(row.id for row in march.collect()) == ["y06", "y07", "y08"]


def test_expensive_short_days(ansi, trips):
    found = filtered_daily(trips, PICKUP, expensive_short(trips, time=PICKUP))
    assert found.dtypes == [("Date", "string"), ("count", "bigint")]
    assert [tuple(row) for row in found.collect()] == [("2023-01-01", 1), ("2023-01-07", 1)]


def test_expensive_short_udf_agrees(ansi, raw_trips):
    """On raw text too, where both must survive NULL and junk."""
    keep = expensive_short_udf()(F.col(PICKUP), F.col("fare_amount"), F.col("trip_distance"))
    udf = {row.id for row in raw_trips.filter(keep).collect()}
    native = {row.id for row in raw_trips.filter(expensive_short(raw_trips, time=PICKUP)).collect()}
    assert udf == native == {"y01", "y02"}


def test_fare_per_mile(ansi, trips):
    march = in_range(trips, PICKUP, "2023-03-01", "2023-04-01")
    found = ratio_outliers(march, factor=1.5, keep=("id",))
    assert found.dtypes == [("id", "string"), ("fare_per_mile", "double"), ("outlier", "boolean")]
    assert pairs(found) == [("y06", None, None), ("y07", 5.0, False), ("y08", 20000.0, True)]
    assert ratio_outliers(march).columns == ["fare_per_mile", "outlier"]
    assert ratio_outliers(march).filter("outlier").count() == 0


def test_fare_per_mile_without_any_ratio(ansi, trips):
    still = trips.filter("trip_distance = 0")
    assert ratio_outliers(still).collect() == [(None, None)]


def test_solo_share(ansi, trips):
    share_row = solo_share(trips)
    assert share_row.dtypes == [("percentage_solo", "double")]
    assert share_row.first()[0] == pytest.approx(60.0)
    assert solo_share(trips.limit(0)).collect() == [(None,)]
    assert share(trips, F.col("passenger_count").isNull(), "unknown").first()[0] == pytest.approx(10.0)


def test_percent_text(spark):
    shown = spark.createDataFrame([(73.1234,), (79.066,), (None,), (100.0,)], "p double").select(percent(F.col("p")))
    assert [row[0] for row in shown.collect()] == ["73.12%", "79.07%", None, "100.00%"]


def test_months(ansi, trips):
    months = trips_per_month(trips, PICKUP)
    assert months.dtypes == [("pickup_month", "string"), ("count", "bigint")]
    assert [tuple(row) for row in months.collect()] == [("April", 1), ("January", 5), ("March", 4)]
    peak = peak_month(trips, PICKUP)
    assert peak.dtypes == [("pickup_month", "string"), ("trip_count", "bigint")]
    assert peak.collect() == [("January", 5)]


def test_peak_month_ties_and_gaps(spark):
    def moments(*texts):
        rows = spark.createDataFrame([(text,) for text in texts], "at string")
        return rows.withColumn("at", F.col("at").cast("timestamp_ntz"))

    assert peak_month(moments("2023-05-01", "2023-04-01"), "at").collect() == [("April", 1)]
    assert peak_month(moments(None, None, "2023-04-01"), "at").collect() == []
    assert peak_month(moments("2023-04-01").limit(0), "at").collect() == []


def test_totals_agree(trips, zones):
    rows = trips.count()
    for key in ("PULocationID", "DOLocationID"):
        assert zone_counts(trips, zones, key, "b").agg(F.sum("count")).first()[0] == rows
    assert trips_per_month(trips, PICKUP).agg(F.max("count")).first()[0] == peak_month(trips, PICKUP).first().trip_count


def test_either_bound_of_a_series_holds_alone(trips):
    both = {row.pickup_day: row.total_trips for row in daily_counts(trips, PICKUP).collect()}
    first = min(day for day in both if day is not None and str(day) >= "2023-03")
    after = daily_counts(trips, PICKUP, start=str(first)).collect()
    before = daily_counts(trips, PICKUP, end=str(first)).collect()
    assert {r.pickup_day for r in after} == {d for d in both if d >= first}
    assert {r.pickup_day for r in before} == {d for d in both if d < first}


def test_text_in_shares_and_ratios(spark, ansi):
    rows = spark.createDataFrame([("1.0", "10"), ("1.9", "x"), ("2", "0x1p3"), (None, "5")], "passenger_count string, f string")
    assert solo_share(rows).first().percentage_solo == 25
    ratios = ratio_outliers(rows, "f", "passenger_count", keep=("f",))
    assert {r.f: r.fare_per_mile for r in ratios.collect()} == {"10": 10.0, "x": None, "0x1p3": None, "5": None}


MONTHS = "pickup timestamp_ntz, dropoff timestamp_ntz"


def test_a_second_time_is_not_pruned_by_the_month_of_the_first(spark):
    from datetime import datetime

    from cabrank.operators.clean import with_month

    rows = spark.createDataFrame([(datetime(2023, 5, 31, 23, 50), datetime(2023, 6, 1, 0, 10))], MONTHS)
    stored = with_month(rows, "pickup")
    assert in_range(stored, "dropoff", "2023-06-01", "2023-07-01").count() == 1
    assert in_range(stored, "pickup", "2023-05-01", "2023-06-01", month="trip_month").count() == 1


@pytest.mark.parametrize("value", ["6", "'June'"])
def test_another_column_of_that_name_does_not_matter(spark, ansi, value):
    rows = spark.sql(f"select timestamp_ntz '2023-06-05 00:00:00' as at, {value} as trip_month")
    assert in_range(rows, "at", "2023-06-01", "2023-07-01").count() == 1


def test_the_month_of_the_exclusive_end_is_not_listed(spark):
    from cabrank.functions.conditions import between_times

    rows = spark.sql("select timestamp_ntz '2023-06-05 00:00:00' as at, 202306 as m")
    text = str(between_times(rows, "at", "2023-06-01", "2023-07-01", "m"))
    assert "202306" in text and "202307" not in text


def test_both_forms_of_the_condition_agree_on_uncleaned_text(spark, ansi):
    from cabrank.functions.conditions import expensive_short
    from cabrank.functions.udfs import expensive_short_udf

    good = ("2023-01-02 10:00:00", "60", "0.5")
    changed = {0: ["2023-01-02 10:00:00.5", "2023-01-02", "x", None, "2023-01-08 00:00:00"], 1: ["NaN", "60d", "Infinity", "50", " 61 ", "6e1", None],
               2: ["0x1p-3", "-Infinity", "NaN", "1", "", None]}
    rows = [good] + [tuple(v if i == k else x for i, x in enumerate(good)) for k, vs in changed.items() for v in vs]
    table = spark.createDataFrame(rows, "t string, f string, d string")
    native = table.filter(expensive_short(table, time="t", fare="f", distance="d")).collect()
    python = table.filter(expensive_short_udf()("t", "f", "d")).collect()
    assert sorted(native) == sorted(python) == sorted([good, (good[0], " 61 ", good[2]), (good[0], "6e1", good[2])])
