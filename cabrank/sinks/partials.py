"""Counts per input file and day, in a table that grows with the files.

A folder that gets new files every day need not be counted from the start each
time: counts per file and day add up to the counts of all. An update lists the
folder, counts the files that it does not know by path, length and time of
change, and stores their counts as a batch. The manifest names the batch last, so
half an update is no update, and the one after it does the work again.

Only counts of files that the latest listing has are summed: a file that was
removed no longer counts, one that was changed counts as it is now.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cabrank.sinks.reports import exists
from cabrank.sources.trips import list_files

FILE = "file string, length long, changed timestamp"
ORIGIN = "_origin"


def read_parquet_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    return spark.read.parquet(*paths).select("*", F.col("_metadata.file_path").alias(ORIGIN))


class DayCounts:
    """The stored counts below ``folder``.

    ``read`` gives the rows of some files, with the path of each row's file as
    ``_metadata`` has it in ``ORIGIN``; by default the files are Parquet.
    """

    def __init__(
        self,
        spark: SparkSession,
        folder: str,
        read: Callable[[SparkSession, list[str]], DataFrame] = read_parquet_files,
    ) -> None:
        self.spark, self.folder, self.read = spark, folder.rstrip("/"), read

    def _stored(self, path: str | list[str], schema: str) -> DataFrame:
        """What is stored in a folder, or in each of some; nothing where there is none."""
        paths = [path] if isinstance(path, str) else path
        if not paths or not exists(self.spark, paths[0]):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def batches(self) -> list[str]:
        """Names of the batches that the manifest lists, the oldest first."""
        rows = self._stored(f"{self.folder}/manifest", "number long, batch string")
        return [row.batch for row in rows.orderBy("number", "batch").collect()]

    def files(self) -> DataFrame:
        """The files of the latest listing."""
        return self._stored([f"{self.folder}/files/{batch}" for batch in self.batches()[-1:]], FILE)

    def counts(self) -> DataFrame:
        """Rows per file and day; a file without rows has one row without a day.

        Two updates at a time may both count a file; it counts once.
        """
        each = self._stored([f"{self.folder}/batches/{batch}" for batch in self.batches()], f"{FILE}, day date, count long")
        return each.groupBy("file", "length", "changed", "day").agg(F.max("count").alias("count"))

    def update(self, path: str | list[str], time: str) -> list[str]:
        """Count the files that are new or changed; their paths."""
        listed = list_files(self.spark, path)
        listed = listed.select("path", "file", "length", F.col("modificationTime").alias("changed"))
        known = self.counts().select("file", "length", "changed").distinct()
        new = listed.join(known, ["file", "length", "changed"], "left_anti").collect()
        batch = uuid.uuid4().hex
        if new:
            rows = self.read(self.spark, [row.path for row in new])
            days = rows.groupBy(F.col(ORIGIN).alias("file"), F.col(time).try_cast("date").alias("day"))
            counts = days.agg(F.count("*").alias("count"))
            files = self.spark.createDataFrame([(row.file, row.length, row.changed) for row in new], FILE)
            each = files.join(counts, "file", "left").fillna(0, ["count"])
        else:
            each = self.spark.createDataFrame([], f"{FILE}, day date, count long")
        each.write.parquet(f"{self.folder}/batches/{batch}")
        listed.drop("path").coalesce(1).write.parquet(f"{self.folder}/files/{batch}")
        manifest = self.spark.createDataFrame([(len(self.batches()), batch)], "number long, batch string")
        manifest.coalesce(1).write.mode("append").parquet(f"{self.folder}/manifest")
        return [row.path for row in new]

    def daily(self) -> DataFrame:
        """Trips per day over all files of the latest listing, as ``daily_counts`` gives them."""
        live = self.counts().join(self.files(), ["file", "length", "changed"], "left_semi").filter("count > 0")
        return live.groupBy(F.col("day").alias("pickup_day")).agg(F.sum("count").alias("total_trips"))
