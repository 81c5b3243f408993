from datetime import datetime

import fixtures
import pytest
from cabrank.schema import LOOKUP_SCHEMA
from cabrank.sinks.reports import report_path, run_stamp, shared_folder, stage_table, write_report, write_rows
from cabrank.sources.trips import read_lookup, read_table, read_trips
from pyspark.sql import functions as F


def parts(path):
    return sorted(path.glob("part-*"))


def test_names():
    assert run_stamp(datetime(2023, 6, 1, 7, 8, 9)) == "20230601T070809"
    assert report_path("s3a://out/", "task2", "counts", "r1") == "s3a://out/task2/counts_r1"


def test_report_is_one_file_in_order(spark, tmp_path):
    counts = spark.createDataFrame(fixtures.BOROUGHS["yellow_pickup"], "Pickup_Borough string, count bigint")
    path = tmp_path / "report"
    for _ in range(2):  # the second run replaces the first
        stored = write_report(counts.repartition(4).orderBy(F.desc("count")), str(path), single_file=True)
    (part,) = parts(path)
    lines = part.read_text().splitlines()
    assert lines[0] == "Pickup_Borough,count" and lines[1] == "Manhattan,19596373" and len(lines) == 8
    assert stored.schema == counts.schema
    assert sorted(stored.collect()) == sorted(counts.collect())


def test_null_group_survives(spark, tmp_path):
    counts = spark.createDataFrame([(None, 1), ("Queens", 2)], "b string, count bigint")
    assert sorted(write_report(counts, str(tmp_path / "r")).collect(), key=str) == sorted(counts.collect(), key=str)


def test_rows_are_written_by_all_tasks(spark, tmp_path):
    rows = spark.range(0, 1_000, 1, 4)
    stored = write_rows(rows, str(tmp_path / "rows"))
    assert len(parts(tmp_path / "rows")) == 4
    assert stored.count() == 1_000


def test_ordered_rows_keep_order_across_files(spark, tmp_path):
    rows = spark.range(0, 5_000, 1, 4).select(
        F.when(F.col("id") % 3 == 0, 50).otherwise(F.pmod(F.hash("id"), F.lit(100))).alias("at"), F.col("id").alias("v")
    )
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        stored = write_rows(rows, str(tmp_path / "rows"), order_by="at")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert stored.columns == ["v"]
    at = {row.v: row.at for row in rows.collect()}
    files = [[int(line) for line in part.read_text().splitlines()[1:]] for part in parts(tmp_path / "rows")]
    written = [at[v] for lines in files for v in lines]
    assert written == sorted(written) and len(written) == 5_000
    assert sum(any(at[v] == 50 for v in lines) for lines in files) > 1  # the busy moment spans files


def test_stage_table(spark, trips, tmp_path):
    stored = stage_table(trips, str(tmp_path / "staged"))
    assert stored.schema == trips.schema and stored.count() == trips.count()


def test_staging_by_a_column_splits_large_values(spark, tmp_path):
    """Tasks write few files each, and a value with most of the rows gets several."""
    value = F.when(F.col("id") % 3 == 0, F.col("id") % 5).otherwise(1)
    rows = spark.range(0, 120_000, 1, 16).select(value.alias("m"), F.sha2(F.col("id").cast("string"), 512))
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1MB")
    try:
        stored = stage_table(rows, str(tmp_path / "staged"), "m")
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    files = {folder.name: len(parts(folder)) for folder in (tmp_path / "staged").glob("m=*")}
    assert set(files) == {f"m={value}" for value in range(5)}
    assert files["m=1"] > 3 and sum(files.values()) < 16 * 5
    assert sorted(map(tuple, stored.groupBy("m").count().collect())) == sorted(
        map(tuple, rows.groupBy("m").count().collect())
    )


def test_staging_no_rows(spark, trips, tmp_path):
    """Partitioned by a column, an empty table has no files to tell its schema."""
    stored = stage_table(trips.limit(0), str(tmp_path / "staged"), "taxi_type")
    assert stored.count() == 0 and set(stored.columns) == set(trips.columns)


def test_shared_folder_is_the_sessions(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    first, second = shared_folder(spark, "x"), shared_folder(spark, "x")
    assert first.startswith(f"{base}/run-{spark.sparkContext.applicationId}/x-") and first != second


def test_csv_folder_is_text_named_by_the_header(spark, raw_trips, tmp_path):
    write_rows(raw_trips.repartition(3), str(tmp_path / "trips"))
    read = read_trips(spark, str(tmp_path / "trips"))
    assert read.schema == raw_trips.schema
    assert sorted(read.collect(), key=str) == sorted(raw_trips.collect(), key=str)


def test_lookup_file_with_schema(spark, zones, tmp_path):
    write_report(zones, str(tmp_path / "zones"), single_file=True)
    (file,) = parts(tmp_path / "zones")
    assert read_lookup(spark, str(file)).schema == LOOKUP_SCHEMA
    assert sorted(read_lookup(spark, str(file)).collect()) == sorted(zones.collect())


def test_header_must_agree_with_the_schema(spark, zones, tmp_path):
    write_report(zones.select("Borough", "LocationID", "Zone", "service_zone"), str(tmp_path / "zones"))
    with pytest.raises(Exception, match="(?i)header"):
        read_lookup(spark, str(tmp_path / "zones")).collect()


def test_inferred_and_parquet(spark, trips, tmp_path):
    write_rows(trips, str(tmp_path / "csv"))
    inferred = dict(read_table(spark, str(tmp_path / "csv"), infer=True).dtypes)
    assert inferred["PULocationID"] == "int" and inferred["fare_amount"] == "double"
    trips.write.parquet(str(tmp_path / "parquet"))
    assert read_trips(spark, str(tmp_path / "parquet"), "parquet").schema == trips.schema


def test_values_come_back_as_they_were(spark, ansi, tmp_path):
    texts = ["a\nb", "\r\n", " x ", "", None, "back\\slash", "\\n", "\\\\\n", 'say "hi", ok', '"', "\\", "\\N", "\u0001\t", "é\U0001f600"]
    rows = [(i, text, datetime(2023, 1, 2, 3, 4, 5, 123456 + i)) for i, text in enumerate(texts)]
    table = spark.createDataFrame(rows, "n int, text string, at timestamp_ntz")
    table = table.withColumn("instant", F.col("at").cast("timestamp"))
    stored = write_report(table, str(tmp_path / "r"))
    assert sorted(stored.collect()) == sorted(table.collect())
    lines = sum(len(part.read_bytes().split(b"\n")) - 1 for part in parts(tmp_path / "r"))
    assert lines == len(rows) + len(parts(tmp_path / "r"))


def test_an_ordered_report_can_keep_its_order_column(spark, tmp_path):
    rows = spark.range(0, 100).select((F.col("id") * 37 % 100).alias("at"), "id")
    stored = write_rows(rows, str(tmp_path / "r"), order_by="at", keep_order=True)
    written = [line.split(",")[0] for part in parts(tmp_path / "r") for line in part.read_text().splitlines()[1:]]
    assert stored.columns == ["at", "id"] and written == [str(n) for n in range(100)]


@pytest.mark.parametrize("infer", [False, True])
def test_headers_in_another_order_are_refused(spark, tmp_path, infer):
    (tmp_path / "trips").mkdir()
    (tmp_path / "trips/a.csv").write_text("at,fare\n2023-01-01 00:00:00,5\n")
    (tmp_path / "trips/b.csv").write_text("fare,at\n6,2023-01-01 00:00:00\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_table(spark, str(tmp_path / "trips"), infer=infer).collect()
