"""Writing reports, and the folder a run may use for written tables."""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


#: Names the folder of a run, and the column that tells rejected rows.
RUN, REJECTED = "run", "rejected"


def run_stamp(at: datetime | None = None) -> str:
    """Names a run by its time, without the colons that some stores refuse."""
    return (at or datetime.now()).strftime("%Y%m%dT%H%M%S")


def report_path(base: str, task: str, name: str, run_id: str) -> str:
    return f"{base.rstrip('/')}/{task}/{name}_{run_id}"


#: Quotes are doubled, white space is kept, and moments have all their digits.
LAYOUT = {
    "header": True,
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}
#: An empty text is quoted and a NULL is not; a NULL value that no file contains keeps them apart.
READING = LAYOUT | {"nullValue": "\u0000", "emptyValue": "", "enforceSchema": False}


def _escaped(df: DataFrame) -> DataFrame:
    """Line breaks as ``\\n`` and ``\\r``, and backslashes doubled, so that a row is a line."""

    def column(field: StructField) -> Column:
        if not isinstance(field.dataType, StringType):
            return F.col(field.name)
        out = F.col(field.name)
        for sign, written in (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r")):
            out = F.replace(out, F.lit(sign), F.lit(written))
        return out.alias(field.name)

    return df.select([column(field) for field in df.schema.fields])


def _unescaped(df: DataFrame) -> DataFrame:
    def column(field: StructField) -> Column:
        if not isinstance(field.dataType, StringType):
            return F.col(field.name)
        breaks = F.transform(
            F.split(field.name, r"\\\\"),
            lambda part: F.replace(F.replace(part, F.lit("\\n"), F.lit("\n")), F.lit("\\r"), F.lit("\r")),
        )
        return F.array_join(breaks, "\\").alias(field.name)

    return df.select([column(field) for field in df.schema.fields])


def read_report(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A stored report, its values as they were written."""
    return _unescaped(spark.read.options(**READING).schema(schema).csv(path))


def write_report(df: DataFrame, path: str, single_file: bool = False) -> DataFrame:
    """Write a report as CSV with a header and return it as stored.

    Reading the result back lets callers preview it, or derive a further report
    from it, without computing it again. ``single_file`` is for aggregated
    reports of a few rows, whose order it keeps; otherwise every task writes.
    """
    out = _escaped(df.coalesce(1) if single_file else df)
    out.write.mode("overwrite").options(**LAYOUT).csv(path)
    return read_report(df.sparkSession, path, df.schema)


RUNS = "runs"
RUN_SCHEMA = "run_id string, at timestamp, task string, name string, schema string"


def commit_run(spark: SparkSession, base: str, run_id: str, reports: list[tuple[str, str, StructType]]) -> None:
    """List a run's reports (task, name, schema) as complete, in one row for each, after all of them are written."""
    at = datetime.now()
    rows = [(run_id, at, task, name, schema.json()) for task, name, schema in reports]
    spark.createDataFrame(rows, RUN_SCHEMA).coalesce(1).write.mode("append").parquet(f"{base.rstrip('/')}/{RUNS}")


def latest_report(spark: SparkSession, base: str, task: str, name: str) -> DataFrame:
    """A report as the last complete run wrote it. Reports of a run that was not committed do not count."""
    runs = spark.read.schema(RUN_SCHEMA).parquet(f"{base.rstrip('/')}/{RUNS}")
    wanted = runs.filter((F.col("task") == task) & (F.col("name") == name))
    last = wanted.orderBy(F.desc("at"), F.desc("run_id")).first()
    if last is None:
        raise ValueError(f"no complete run has {task}/{name}")
    return read_report(spark, report_path(base, task, name, last.run_id), StructType.fromJson(json.loads(last.schema)))


def write_rows(df: DataFrame, path: str, order_by: str | None = None, keep_order: bool = False) -> DataFrame:
    """Write a row-level result from all tasks, in range order if asked for.

    The ordering column need not be part of the result: it is dropped after the
    sort unless ``keep_order`` is set, and the numbered part files keep the order.
    Rows of one moment are ordered by a hash of the row, so that a busy moment can
    span several tasks; the input partition in it does the same for exact copies.
    """
    if order_by is None:
        return write_report(df, path)
    tie = F.xxhash64(F.spark_partition_id(), *map(F.col, df.columns))
    out = df.withColumn("_tie", tie).orderBy(order_by, "_tie").drop("_tie")
    return write_report(out if keep_order else out.drop(order_by), path)


def stage_table(df: DataFrame, path: str, partition_by: str | None = None) -> DataFrame:
    """Write a table as Parquet and return it, so that later passes start there.

    Partitioning the folder by a column moves the rows once, so that a task
    writes to few folders and not one small file to each. Adaptive execution
    splits a large value over several tasks and packs small ones together; it
    must be on for that.
    """
    if partition_by is None:
        df.write.mode("overwrite").parquet(path)
    else:
        moved = df.hint("rebalance", F.col(partition_by))
        moved.write.mode("overwrite").partitionBy(partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@dataclass(frozen=True)
class Split:
    """A table stored in two parts, and what was counted on the way."""

    kept: DataFrame
    rejected: DataFrame
    counts: dict[str, int]


def stage_split(df: DataFrame, path: str, rejected: Column, counts: dict[str, Column], partition_by: str | None = None) -> Split:
    """Write a table once, rejected rows apart from the others, counting rows while they are written.

    ``counts`` are conditions; the rows that meet each are counted, and all
    ``rows``. The counts come from the tasks that write, after any move of rows,
    so a task that has to be run again counts once.
    """
    if REJECTED in df.columns:
        raise ValueError(f"the column {REJECTED} tells the parts of the stored table apart")
    marked = df.withColumn(REJECTED, F.coalesce(rejected, F.lit(False)))
    if partition_by is not None:
        marked = marked.hint("rebalance", F.col(partition_by))
    seen = Observation()
    metrics = [F.count_if(condition).alias(name) for name, condition in counts.items()]
    folders = [REJECTED] if partition_by is None else [REJECTED, partition_by]
    observed = marked.observe(seen, F.count("*").alias("rows"), *metrics)
    observed.write.mode("overwrite").partitionBy(*folders).parquet(path)
    stored = df.sparkSession.read.schema(marked.schema).parquet(path)
    kept, gone = (stored.filter(F.col(REJECTED) == flag).select(df.columns) for flag in (False, True))
    return Split(kept, gone, dict(seen.get))


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder of this session's run, below the one that all executors share.

    The shared folder is the session's ``spark.checkpoint.dir``. A local session
    without the setting takes one in its warehouse; a cluster without it is an
    error. ``drop_scratch`` removes the run's folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/scratch"
    return f"{base.rstrip('/')}/{RUN}-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def _file_system(spark: SparkSession, path: str) -> tuple:
    """The store of a path, as Spark itself finds it, and the path in it."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()), found


def exists(spark: SparkSession, path: str) -> bool:
    store, found = _file_system(spark, path)
    return bool(store.exists(found))


def drop_scratch(spark: SparkSession) -> bool:
    """Remove all that this session's application has staged; whether there was anything.

    Tables read from there are gone, too, so results have to be written elsewhere
    before. Other applications' folders are left alone.
    """
    store, folder = _file_system(spark, shared_folder(spark, "").rpartition("/")[0])
    return bool(store.delete(folder, True))
