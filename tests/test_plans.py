"""What the physical plans must and must not contain."""

import contextlib
import io
import re

import __spark_entry__ as registry
import pytest
from cabrank.operators.enrich import enrich_zones
from cabrank.operators.series import daily_counts, in_range, label_days
from cabrank.plans import order_trips
from test_registered import own


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()


@pytest.fixture
def plan_of(spark, small_dir):
    return lambda name: plan(registry.queries()[name](spark, small_dir))


@pytest.mark.parametrize("name", own(registry.queries()))
def test_no_cross_join_and_no_global_window(plan_of, name):
    text = plan_of(name)
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text
    assert "Window" not in text


@pytest.mark.parametrize("name", own(set(registry.queries()) - {"expensive_short_daily_udf", "expensive_short_text_udf"}))
def test_no_python_in_the_plan(plan_of, name):
    assert "Python" not in plan_of(name) and "Pandas" not in plan_of(name)


def test_python_variant_runs_through_arrow(plan_of):
    assert "ArrowEvalPython" in plan_of("expensive_short_daily_udf")


@pytest.mark.parametrize(
    ("name", "pushed"),
    [
        ("clean_nonneg", "GreaterThanOrEqual(c_acctbal,0.0)"),
        ("daily_counts", "LessThan(l_shipdate,1998-07-01T00:00)"),
        ("ratio_outliers", "LessThan(l_shipdate,1998-04-01T00:00)"),
        ("expensive_short_daily", "GreaterThan(l_extendedprice,50000.0)"),
        ("expensive_short_daily", "LessThan(l_quantity,20.0)"),
        ("solo_share_O", "EqualTo(l_linestatus,O)"),
        ("pickup_region_O", "EqualTo(l_linestatus,O)"),
    ],
)
def test_filters_reach_the_scan(spark, small_dir, name, pushed):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        registry.queries()[name](spark, small_dir).explain("formatted")
    assert pushed in out.getvalue()


@pytest.mark.parametrize(
    ("name", "columns"),
    [
        ("daily_counts", {"l_shipdate"}),
        ("peak_month_O", {"l_linestatus", "l_shipdate"}),
        ("solo_share_F", {"l_linenumber", "l_linestatus"}),
        ("ratio_outliers", {"l_orderkey", "l_linenumber", "l_extendedprice", "l_discount", "l_shipdate"}),
    ],
)
def test_only_needed_columns_are_read(spark, small_dir, name, columns):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        registry.queries()[name](spark, small_dir).explain("formatted")
    read = re.search(r"ReadSchema: struct<([^>]*)>", out.getvalue()).group(1)
    assert {part.split(":")[0] for part in read.split(",")} == columns


def test_row_level_ratios_are_not_shuffled(plan_of):
    outside = re.sub(r"\n[ :]*\+- Subquery.*?(?=\n   \+- )", "", plan_of("ratio_outliers"), flags=re.S)
    assert "Exchange" not in outside


def test_zones_within_the_bound_leave_the_trips_in_place(spark, small_dir):
    text = plan(order_trips.enriched_trips(spark, small_dir, small=True))
    assert not re.search(r"Exchange (hash|range)partitioning", text)


def test_trips_are_counted_before_any_join(plan_of):
    """Below every join the trips are already partial counts."""
    for name in ("pickup_region_O", "top5_dropoff_nation_F"):
        text = plan_of(name)
        scan = text.index("linestatus")
        assert text.index("partial_count") < scan
        assert "partial_count" not in text[scan:]


def test_top_k_keeps_k_rows_per_task(plan_of):
    assert "TakeOrderedAndProject(limit=5" in plan_of("top5_pickup_nation_O")
    assert "TakeOrderedAndProject(limit=1" in plan_of("peak_month_F")


def test_the_mean_reuses_the_daily_counts(spark, small_dir):
    days = label_days(daily_counts(order_trips.table(spark, small_dir, "lineitem"), "l_shipdate"))
    days.collect()
    final = plan(days).split("Initial Plan")[0]
    assert "ReusedExchange" in plan(days) or final.count("FileScan") == 1


def test_both_roles_share_one_broadcast(spark, small_dir):
    zones = order_trips.zone_lookup(spark, small_dir)
    trips = order_trips.table(spark, small_dir, "lineitem").selectExpr(
        "cast(l_suppkey % 25 as int) as PULocationID", "cast(l_partkey % 25 as int) as DOLocationID"
    )
    rows = enrich_zones(trips, zones, small=True)
    rows.collect()
    assert "ReusedExchange" in plan(rows).split("Initial Plan")[0]


def test_other_months_are_not_listed(spark, trips, tmp_path):
    from cabrank.operators.clean import with_month
    from cabrank.schema import YELLOW
    from cabrank.sinks.reports import stage_table

    stored = stage_table(with_month(trips, YELLOW.pickup), str(tmp_path / "trips"), "trip_month")
    march = in_range(stored, YELLOW.pickup, "2023-03-01", "2023-04-01", month="trip_month")
    assert sorted(row.id for row in march.collect()) == ["y06", "y07", "y08"]
    assert "trip_month" in re.search(r"PartitionFilters: \[(.*?)\]", plan(march)).group(1)
