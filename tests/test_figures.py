"""Known figures of the generated tables, independent of the SQL beside the queries."""

import __spark_entry__ as registry
import pytest


@pytest.fixture
def run(spark, sf_dir):
    return lambda name: registry.queries()[name](spark, sf_dir).collect()


def test_pickup_regions(run):
    assert {row[0]: row[1] for row in run("pickup_region_O")} == {
        "MIDDLE EAST": 8069, "AMERICA": 7385, "ASIA": 6007, "EUROPE": 4528, "AFRICA": 4075,
    }


def test_a_missing_region_becomes_the_null_group(run):
    counts = {row[0]: row[1] for row in run("pickup_region_unmatched")}
    assert counts[None] == 4528 and "EUROPE" not in counts
    rows = run("enrich_unmatched")
    assert len(rows) == 60_000 and all(row.PULocationID is not None for row in rows)


def test_expensive_small_shipments(run):
    assert [row["count"] for row in run("expensive_short_daily")] == [5, 7, 8, 3, 5, 5, 3]
    assert run("expensive_short_daily_udf") == run("expensive_short_daily")
    assert len(run("expensive_short")) == 36


def test_june(run):
    labels = [row.anomaly for row in run("daily_labels")]
    assert len(labels) == 30
    assert (labels.count("High Anomaly"), labels.count("Low Anomaly")) == (7, 10)
    assert len(run("daily_anomalies")) == 17
    assert run("mean_day")[0][0] == pytest.approx(24.27, abs=0.005)


def test_price_ratios(run):
    rows = run("ratio_outliers")
    assert len(rows) == 752
    assert sum(row.fare_per_mile is not None for row in rows) == 714
    assert sum(row.outlier is True for row in rows) == 15


def test_shares_and_months(run):
    assert run("solo_share_O")[0][0] == pytest.approx(14.4525, abs=1e-4)
    assert run("solo_share_F")[0][0] == pytest.approx(14.1802, abs=1e-4)
    assert run("peak_month_O") == [("August", 2688)]
    assert run("peak_month_F") == [("July", 2634)]


def test_clean_customers(run):
    assert len(run("clean_nonneg")) == 1_500 - 122


def test_totals(run):
    for status in ("O", "F"):
        totals = {sum(row[1] for row in run(f"{role}_region_{status}")) for role in ("pickup", "dropoff")}
        totals.add(sum(row["count"] for row in run(f"trips_per_month_{status}")))
        assert len(totals) == 1
    assert run("enrich_summary") == [(60_000, 14)]


def test_top_nations_lead_all_nations(spark, sf_dir, run):
    from cabrank.plans.order_trips import zone_group_counts

    every = zone_group_counts(spark, sf_dir, "F", "Dropoff", "Zone", "zone", "n").collect()
    best = sorted(((-row.n, row.zone) for row in every))[:5]
    assert [(row[0], row["count"]) for row in run("top5_dropoff_nation_F")] == [(zone, -n) for n, zone in best]
