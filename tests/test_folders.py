"""Folders of files with other headers, counts that grow with the files, complete runs, and scratch."""

import importlib.util
import sys
import time
from pathlib import Path
from types import SimpleNamespace

import fixtures
import pytest
from cabrank.operators.clean import checks, clean_trips, judged_trips, reason_counts
from cabrank.operators.counts import counts_of, fleet_counts, zone_counts
from cabrank.operators.series import daily_counts, trips_per_month
from cabrank.plans.taxi_reports import ReportRun, split_fleet
from cabrank.schema import FAILED, MONTH_ROLE, ROLES, WRITTEN, YELLOW
from cabrank.sinks import reports
from cabrank.sinks.partials import DayCounts
from cabrank.sinks.reports import latest_report, shared_folder
from cabrank.sources.inference import merged_types, type_states
from cabrank.sources.trips import headers, list_files, read_folder, read_trips
from pyspark.sql import functions as F

ROOT = Path(__file__).resolve().parent.parent


def write(folder, name, *lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("".join(f"{line}\n" for line in lines))


@pytest.fixture
def mixed(tmp_path):
    folder = tmp_path / "mixed"
    write(folder, "a.csv", "VendorID,tpep_pickup_datetime,fare_amount,PULocationID", "1,2023-01-01 00:00:00,5.0,7")
    write(folder, "b.csv", "fare_amount,PULocationID,VendorID,tpep_pickup_datetime", "6.5,8,2,2023-02-01 00:00:00")
    write(folder, "c.csv", "vendorid,tpep_pickup_datetime,fare_amount,PULocationID,Airport_fee", "3,2023-03-01 00:00:00,7.0,9,1.25")
    write(folder, "d.csv", "VendorID,tpep_pickup_datetime,fare_amount,PULocationID", "4,2023-04-01 00:00:00,-1,10")
    write(folder, "e.csv", "VendorID,tpep_pickup_datetime,fare_amount,PULocationID")
    (folder / "f.csv").write_text("")
    (folder / "_SUCCESS").write_text("")
    return str(folder)


def test_files_of_several_headers(spark, ansi, mixed):
    trips = read_folder(spark, mixed, YELLOW)
    assert trips.columns == ["VendorID", "tpep_pickup_datetime", "fare_amount", "PULocationID", "Airport_fee"]
    rows = {row.VendorID: (str(row.tpep_pickup_datetime)[:10], row.fare_amount, row.PULocationID, row.Airport_fee) for row in trips.collect()}
    assert rows == {
        "1": ("2023-01-01", "5.0", 7.0, None),
        "2": ("2023-02-01", "6.5", 8.0, None),
        "3": ("2023-03-01", "7.0", 9.0, "1.25"),
        "4": ("2023-04-01", "-1", 10.0, None),
    }
    assert sorted(read_trips(spark, mixed, fleet=YELLOW).collect(), key=str) == sorted(trips.collect(), key=str)


def test_a_scan_for_each_header_with_its_filters(spark, mixed):
    found = read_folder(spark, mixed, YELLOW).filter("PULocationID > 8").select("VendorID")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan csv") == 3 and plan.count("GreaterThan(PULocationID,8.0)") == 3 and "fare_amount" not in plan
    assert sorted(row.VendorID for row in found.collect()) == ["3", "4"]


def test_origin_of_rows(spark, mixed):
    rows = read_folder(spark, mixed, file="origin").collect()
    assert {row.VendorID: Path(row.origin).name for row in rows} == {"1": "a.csv", "2": "b.csv", "3": "c.csv", "4": "d.csv"}
    known = {row.file for row in list_files(spark, mixed).collect()}
    assert {row.origin for row in rows} < known


def test_headers_are_read_for_each_file(spark, mixed):
    files = sorted(row.path for row in list_files(spark, mixed).collect())
    assert [len(columns) for columns in headers(spark, files).values()] == [4, 4, 5, 4, 4]


def test_a_column_twice_is_an_error(spark, tmp_path):
    write(tmp_path / "twice", "a.csv", "fare,Fare,x", "1,2,3")
    with pytest.raises(Exception, match="header"):
        read_folder(spark, str(tmp_path / "twice")).collect()


def test_one_pass_for_all_counts(spark, trips, zones):
    counts = fleet_counts(trips, zones, YELLOW.pickup)
    for role, key in ROLES.items():
        single = zone_counts(trips, zones, key, "name")
        assert sorted(counts_of(counts, role, "name").collect(), key=str) == sorted(single.collect(), key=str)
    months = trips_per_month(trips, YELLOW.pickup).collect()
    assert sorted(counts_of(counts, MONTH_ROLE, "pickup_month").collect()) == sorted(months)


def test_counts_read_the_trips_once(spark, trips, zones, tmp_path):
    trips.write.parquet(str(tmp_path / "trips"))
    counts = fleet_counts(spark.read.parquet(str(tmp_path / "trips")), zones, YELLOW.pickup)
    assert counts._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def test_judged_trips(spark, ansi, raw_trips):
    judged = judged_trips(raw_trips, YELLOW.pickup, YELLOW.dropoff)
    kept = judged.filter(F.col(FAILED) == 0)
    clean = clean_trips(raw_trips, YELLOW.pickup, YELLOW.dropoff)
    assert kept.drop(FAILED, WRITTEN).schema == clean.schema
    assert sorted(kept.drop(FAILED, WRITTEN).collect(), key=str) == sorted(clean.collect(), key=str)
    assert kept.filter(F.col(WRITTEN).isNotNull()).count() == 0
    names = tuple(checks(raw_trips, YELLOW.pickup, YELLOW.dropoff))
    rejected = judged.filter(F.col(FAILED) != 0)
    assert rejected.count() == len(fixtures.DROPPED)
    values = [F.get_json_object(WRITTEN, f"$.{name}") for name in fixtures.TRIP_COLUMNS]
    expected = [tuple(row) for row in raw_trips.collect() if row.id in {dropped[0] for dropped in fixtures.DROPPED}]
    assert sorted(map(tuple, rejected.select(values).collect()), key=str) == sorted(expected, key=str)
    counts = {row.reason: row["count"] for row in reason_counts(judged, names).collect()}
    for name, check in checks(raw_trips, YELLOW.pickup, YELLOW.dropoff).items():
        assert counts.get(name, 0) == raw_trips.filter(~F.coalesce(check, F.lit(False))).count()


@pytest.mark.parametrize("by_month", [False, True])
def test_counts_on_the_way(spark, raw_trips, tmp_path, by_month):
    split = split_fleet(raw_trips, YELLOW, str(tmp_path / "split"), by_month)
    assert split.counts["rows"] == raw_trips.count() == split.kept.count() + split.rejected.count()
    assert split.counts["rejected"] == split.rejected.count() == len(fixtures.DROPPED)
    assert split.kept.filter(F.col(FAILED) != 0).count() == 0
    assert (tmp_path / "split" / "rejected=true").is_dir()


def test_nothing_rejected(spark, tmp_path):
    none = spark.createDataFrame([], "tpep_pickup_datetime string, tpep_dropoff_datetime string, trip_distance string, fare_amount string")
    split = split_fleet(none, YELLOW, str(tmp_path / "none"))
    assert split.counts["rows"] == split.kept.count() == split.rejected.count() == 0


def days(counts):
    return {str(row.pickup_day): row.total_trips for row in counts.daily().collect()}


def test_added_files_alone_are_read(spark, tmp_path):
    folder, seen = str(tmp_path / "lots"), []

    def read(session, paths):
        seen.append(paths)
        return session.read.parquet(*paths).select("*", F.col("_metadata.file_path").alias("_origin"))

    def lot(day, rows):
        moments = spark.range(rows).select(F.lit(f"2023-01-0{day} 10:00:00").cast("timestamp_ntz").alias("at"))
        moments.coalesce(1).write.mode("append").parquet(folder)

    counts = DayCounts(spark, str(tmp_path / "days"), read)
    assert counts.daily().count() == 0
    lot(1, 3)
    first = counts.update(folder, "at")
    lot(2, 4)
    lot(1, 5)
    second = counts.update(folder, "at")
    assert len(first) == 1 and len(second) == 2 and not set(first) & set(second)
    assert seen == [first, second]
    assert days(counts) == {"2023-01-01": 8, "2023-01-02": 4}
    assert counts.update(folder, "at") == [] and len(seen) == 2
    everything = daily_counts(spark.read.parquet(folder), "at")
    assert days(counts) == {str(row.pickup_day): row.total_trips for row in everything.collect()}
    Path(first[0].removeprefix("file:")).unlink()
    assert counts.update(folder, "at") == []
    assert days(counts) == {"2023-01-01": 5, "2023-01-02": 4}


def test_half_an_update_is_none(spark, tmp_path):
    folder = str(tmp_path / "lots")
    spark.range(4).select(F.lit("2023-01-01 10:00:00").cast("timestamp_ntz").alias("at")).coalesce(1).write.parquet(folder)

    def fails(session, paths):
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        DayCounts(spark, str(tmp_path / "days"), fails).update(folder, "at")
    counts = DayCounts(spark, str(tmp_path / "days"))
    assert days(counts) == {}
    spark.createDataFrame([], counts.counts().schema).write.parquet(str(tmp_path / "days" / "batches" / "unlisted"))
    assert len(counts.update(folder, "at")) == 1
    assert days(counts) == {"2023-01-01": 4}


def test_latest_complete_run(spark, tmp_path):
    out = str(tmp_path / "out")
    for run_id, value in (("r1", 1), ("r2", 2), ("r3", 3)):
        run = ReportRun(out, run_id, preview=False)
        run.publish(spark.createDataFrame([("x", value)], "name string, count long"), "task2", "counts")
        if run_id != "r3":
            run.commit(spark)
            time.sleep(0.01)
    assert [tuple(row) for row in latest_report(spark, out, "task2", "counts").collect()] == [("x", 2)]
    with pytest.raises(ValueError, match="no complete run"):
        latest_report(spark, out, "task2", "other")


def test_scratch_of_a_run(spark, tmp_path, monkeypatch):
    shared = spark.conf.get("spark.checkpoint.dir")
    path = shared_folder(spark, "rows")
    assert path.startswith(f"{shared}/run-{spark.sparkContext.applicationId}/rows-") and shared_folder(spark, "rows") != path
    monkeypatch.setattr(reports, "shared_folder", lambda session, name: f"{tmp_path}/run-this/{name}-1")
    for run in ("this", "other"):
        spark.range(3).write.parquet(f"{tmp_path}/run-{run}/rows-1")
    assert reports.drop_scratch(spark)
    assert sorted(folder.name for folder in tmp_path.iterdir()) == ["run-other"]
    assert not reports.drop_scratch(spark)


@pytest.mark.parametrize(("master", "settings", "expected"), [
    ("local[2]", {"spark.sql.warehouse.dir": "file:/w/"}, "file:/w/scratch/run-app/rows-"),
    ("yarn", {"spark.sql.warehouse.dir": "file:/w", "spark.checkpoint.dir": "hdfs:///c/"}, "hdfs:///c/run-app/rows-"),
    ("yarn", {"spark.sql.warehouse.dir": "file:/w"}, None),
])
def test_shared_folder_without_a_local_one(master, settings, expected):
    context = SimpleNamespace(master=master, applicationId="app")
    session = SimpleNamespace(conf=settings, sparkContext=context)
    if expected is None:
        with pytest.raises(ValueError, match="checkpoint"):
            shared_folder(session, "rows")
    else:
        assert shared_folder(session, "rows").startswith(expected)


@pytest.mark.parametrize("package", ["tiktoken", "xxhash", "zstandard", "public_tokenizers", "cabrank.llm"])
def test_registry_without_a_package_of_the_corpus_queries(monkeypatch, package):
    for name in [name for name in sys.modules if name == "corpus_pipeline" or name.startswith("cabrank.llm")]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, package, None)
    spec = importlib.util.spec_from_file_location("registry_alone", ROOT / "__spark_entry__.py")
    module = importlib.util.module_from_spec(spec)
    with pytest.warns(UserWarning, match="no corpus queries"):
        spec.loader.exec_module(module)
    assert len(module.queries()) > 50 and set(module.queries()) == set(module.oracle_sql())
    assert not any(name.startswith("op") for name in module.queries())


def test_registry_without_the_core(monkeypatch):
    monkeypatch.setitem(sys.modules, "cabrank.operators.series", None)
    spec = importlib.util.spec_from_file_location("registry_alone", ROOT / "__spark_entry__.py")
    with pytest.raises(ModuleNotFoundError):
        spec.loader.exec_module(importlib.util.module_from_spec(spec))




def test_states_of_types_merge(spark, ansi, mixed):
    rows = read_folder(spark, mixed, file="origin")
    each = type_states(rows, "origin")
    merged = {row.column: row for row in merged_types(each).collect()}
    whole = {row.column: row for row in merged_types(type_states(rows.drop("origin"))).collect()}
    assert merged == whole
    kinds = {name: row.type for name, row in merged.items()}
    assert kinds == {
        "VendorID": "bigint", "PULocationID": "bigint", "fare_amount": "double", "tpep_pickup_datetime": "timestamp_ntz", "Airport_fee": "double",
    }
    assert merged["fare_amount"].against_bigint == "5.0" and merged["fare_amount"].as_bigint == 1
    assert merged["Airport_fee"].filled == 1
    more = spark.createDataFrame([("x9",)], "VendorID string")
    added = merged_types(type_states(rows.select("VendorID")).unionAll(type_states(more))).first()
    assert added.type == "string" and added.against_bigint == added.against_double == "x9"
    empty = merged_types(type_states(more.limit(0))).first()
    assert empty.type == "string" and empty.filled == 0
