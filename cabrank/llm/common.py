"""What the operators share: reading tables, staging, and free column names."""

from __future__ import annotations

import ctypes
import io
import zipfile
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from cabrank.llm.storage import committed
from cabrank.sinks.reports import shared_folder, stage_table

BATCH_BYTES = 1 << 20
ARCHIVE = "cabrank-package.zip"
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc alone


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def with_package(spark: SparkSession) -> SparkSession:
    """The session, its executors able to import this library, wherever the program was started.

    The sources are sent once for each application, unless the library was
    itself sent to the driver as an archive.
    """
    context, package = spark.sparkContext, Path(__file__).parent.parent
    if package.is_dir() and not any(path.endswith(ARCHIVE) for path in context.listFiles):
        content = io.BytesIO()
        with zipfile.ZipFile(content, "w") as archive:
            for path in sorted(package.rglob("*.py")):
                archive.write(path, path.relative_to(package.parent))
        folder = shared_folder(spark, "package")
        with committed(folder, ARCHIVE) as stream:
            stream.write(content.getvalue())
        context.addPyFile(f"{folder}/{ARCHIVE}")
    return spark


def staged(df: DataFrame, name: str, lean: bool = False) -> DataFrame:
    """The same rows, written once under the folder that all executors share.

    Later passes start from the files, so neither a lost executor nor a second
    consumer computes them again. ``lean`` has Spark remove what it shuffled for
    them as soon as they are written, and not when the driver next clears up.
    """
    conf, path = df.sparkSession.conf, shared_folder(df.sparkSession, name)
    before = conf.get(CLEANUP, "false")
    conf.set(CLEANUP, "true" if lean else before)
    try:
        return stage_table(df, path)
    finally:
        conf.set(CLEANUP, before)


def tasks_for(df: DataFrame, files: int) -> int:
    """How many tasks write or read so many files: the session's shuffle partitions, or one for each if those are more."""
    return max(1, min(files, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))))


def give_back() -> None:
    """Return what the allocators of this process hold, and nothing uses, to the system.

    Workers are used again by later tasks, and two of them share an executor's
    memory with its JVM: what a large batch took would stay with them.
    """
    pa.default_memory_pool().release_unused()
    if TRIM:
        TRIM(0)


def text_blocks(batches: Iterator[pa.RecordBatch], text: str, most: int = BATCH_BYTES) -> Iterator[tuple]:
    """Blocks of rows with at most so many bytes of text, a longer text being a block of its own.

    Yields the rows of a batch (without the text) and their texts as bytes, NULL
    being empty.
    """
    for batch in batches:
        rest = batch.drop_columns([text])
        texts = batch.column(text).cast(pa.binary())
        start, size = 0, 0
        for i, n in enumerate(pa.compute.binary_length(texts).to_pylist()):
            if size and size + (n or 0) > most:
                yield rest.slice(start, i - start), [x or b"" for x in texts.slice(start, i - start).to_pylist()]
                start, size = i, 0
            size += n or 0
        if start < batch.num_rows:
            yield rest.slice(start), [x or b"" for x in texts.slice(start).to_pylist()]
        del batch, rest, texts
        give_back()
