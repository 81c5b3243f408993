"""Reading trips and the zone lookup from CSV or Parquet."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import partial, reduce
from itertools import chain

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.types import StructField, StructType

from cabrank.schema import AMOUNTS, LOOKUP_SCHEMA, TIME_FORMAT, TRIP_TYPES, Fleet

HEADER_JOBS = 16


def read_table(
    spark: SparkSession,
    path: str | list[str],
    fmt: str = "csv",
    schema: StructType | None = None,
    infer: bool = False,
    **options: str,
) -> DataFrame:
    """A file, or all files of a folder, or some of either.

    CSV files carry a header. Without a schema every CSV column is text, named
    by the header of one file, which costs no pass over the data. ``infer=True``
    asks Spark for the types, at the price of reading the files once more. The
    headers of all files must agree with the schema, given or found;
    ``read_folder`` takes files whose headers differ.
    """
    reader = spark.read.format(fmt).options(**options)
    if fmt != "csv":
        return (reader if schema is None else reader.schema(schema)).load(path)
    reader = reader.option("header", True)
    if schema is None:
        schema = reader.option("inferSchema", infer).load(path).schema
    return reader.option("enforceSchema", False).schema(schema).load(path) if schema.fields else reader.load(path)


def list_files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The files of a folder: path, the same as ``_metadata`` has it, length and time of change. No content is read."""
    files = spark.read.format("binaryFile").load(path)
    return files.select("path", F.col("_metadata.file_path").alias("file"), "length", "modificationTime")


def headers(spark: SparkSession, files: list[str], **options: str) -> dict[str, tuple[str, ...]]:
    """The column names of each CSV file.

    One small job for each file reads its first line, several at a time; a file
    without a line has no columns.
    """

    def header(file: str) -> tuple[str, ...]:
        return tuple(spark.read.options(**options).option("header", True).csv(file).columns)

    with ThreadPoolExecutor(HEADER_JOBS) as jobs:
        return dict(zip(files, jobs.map(header, files), strict=True))


def trip_schema(columns: list[str] | tuple[str, ...], fleet: Fleet | None) -> StructType:
    """Types for the known columns of a fleet; the others are text, as are all without a fleet.

    Ids are read as numbers with a decimal point, which some files give them;
    cleaning makes them integers. Amounts stay text: only cleaning can tell a
    plain decimal from other spellings that a cast would take.
    """

    def kind(name: str) -> T.DataType:
        if fleet is None:
            return T.StringType()
        if name in (fleet.pickup, fleet.dropoff):
            return T.TimestampNTZType()
        return T.DoubleType() if name in TRIP_TYPES and name not in AMOUNTS else T.StringType()

    return StructType([StructField(name, kind(name)) for name in columns])


def read_folder(
    spark: SparkSession, path: str | list[str], fleet: Fleet | None = None, file: str | None = None, **options: str
) -> DataFrame:
    """All CSV files of a folder, whatever the order and number of columns of each.

    Files are grouped by header, each group is scanned with its own columns, and
    the scans are united by name; a column that a file lacks is NULL there. Names
    that differ in case only are one column, named as in the first group, unless
    the session tells them apart. Groups are in the order of their first file by
    path, and so are columns. A name that a header has twice ends the scan. Filters and column selection reach every scan.
    ``file`` names a column for the path that a row comes from.
    """
    files = sorted(row.path for row in list_files(spark, path).select("path").collect())
    found = headers(spark, files, **options)
    groups: dict[tuple[str, ...], list[str]] = {}
    for name, columns in found.items():
        if columns:
            groups.setdefault(columns, []).append(name)
    if not groups:
        return spark.createDataFrame([], StructType())
    same = str if spark.conf.get("spark.sql.caseSensitive") == "true" else str.lower
    spelt: dict[str, str] = {}
    for column in chain.from_iterable(groups):
        spelt.setdefault(same(column), column)

    def scan(columns: tuple[str, ...]) -> DataFrame:
        # Each scan is typed by the common spelling, and reads its files by the header that they have.
        kinds = trip_schema([spelt[same(column)] for column in columns], fleet)
        own = StructType([StructField(column, kind.dataType) for column, kind in zip(columns, kinds, strict=True)])
        rows = read_table(spark, groups[columns], schema=own, timestampNTZFormat=TIME_FORMAT, **options)
        origin = [] if file is None else [F.col("_metadata.file_path").alias(file)]
        return rows.select(*(F.col(f"`{column}`").alias(spelt[same(column)]) for column in columns), *origin)

    return reduce(partial(DataFrame.unionByName, allowMissingColumns=True), map(scan, groups))


def read_trips(
    spark: SparkSession,
    path: str,
    fmt: str = "csv",
    fleet: Fleet | None = None,
    schema: StructType | None = None,
    infer: bool = False,
) -> DataFrame:
    """Trips of one fleet.

    Naming the fleet of CSV trips lets the scan itself produce typed columns,
    which is cheaper than text that cleaning has to parse. The column names come
    from the headers, which may differ from file to file; a value that does not
    fit its type is read as NULL, and cleaning drops the trip if it matters.
    """
    if fmt != "csv" or fleet is None or schema is not None or infer:
        return read_table(spark, path, fmt, schema, infer)
    return read_folder(spark, path, fleet)


def read_lookup(
    spark: SparkSession, path: str, fmt: str = "csv", schema: StructType | None = LOOKUP_SCHEMA
) -> DataFrame:
    """The zone lookup, one row per zone."""
    return read_table(spark, path, fmt, schema)
