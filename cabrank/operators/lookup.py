"""Left joins of many rows with a lookup, whatever the lookup's size or skew."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cabrank.sinks.reports import shared_folder, stage_table

BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64 << 20
SAMPLED_PER_PART = 100
SEED = 11


def fits_broadcast(
    lookup: DataFrame, rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> bool:
    """Whether the lookup is small enough to copy to every executor.

    Counted, not estimated. Counting stops at one row beyond the bound: a lookup
    that reaches it is too large, any other has been measured whole. Pass a table
    as it was read, not one that takes a large join to produce.
    """
    return all_fits([lookup], rows, max_bytes)[0]


def all_fits(lookups: Sequence[DataFrame], rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> list[bool]:
    """The same of several lookups, measured in one job."""

    def size(number: int, lookup: DataFrame) -> DataFrame:
        width = [F.coalesce(F.octet_length(F.col(name).cast("string")), F.lit(0)) + 16 for name in lookup.columns]
        probe = lookup.select(sum(width, F.lit(0)).alias("width")).limit(rows + 1)
        return probe.agg(F.lit(number).alias("number"), F.count("*").alias("rows"), F.sum("width").alias("bytes"))

    found = reduce(DataFrame.unionAll, [size(n, lookup) for n, lookup in enumerate(lookups)]).collect()
    return [row["rows"] <= rows and (row["bytes"] or 0) <= max_bytes for row in sorted(found, key=lambda row: row.number)]


def left_lookup(
    rows: DataFrame,
    lookup: DataFrame,
    key: str,
    lookup_key: str,
    keys_from: DataFrame | None = None,
    small: bool | None = None,
    spread_on: Sequence[str] | None = None,
) -> DataFrame:
    """All rows with the columns of their lookup entry, NULL where there is none.

    A lookup within the broadcast bound joins without moving the rows. A larger
    one goes through a shuffle in which heavy keys are spread out. Column names
    of the two sides must differ. ``keys_from`` is where to look for heavy keys,
    by default ``rows``; pass a ``key_sample`` of the narrower table the rows were
    built from. ``small`` skips the size check where the answer is known.
    ``spread_on`` names the columns that tell the rows of a heavy key apart, by
    default all; name few, so that the others need not be read for it.
    """
    if small is None:
        small = fits_broadcast(lookup)
    if small:
        return rows.join(F.broadcast(lookup), F.col(key) == F.col(lookup_key), "left")
    heavy = heavy_keys(rows if keys_from is None else keys_from, key, shuffle_parts(rows))
    return _spread_lookup(rows, lookup, key, lookup_key, heavy, rows.columns if spread_on is None else spread_on)


def shuffle_parts(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def key_sample(df: DataFrame, *keys: str) -> DataFrame:
    """Some rows of the key columns, staged: about a hundred for each shuffle partition.

    One scan serves the heavy keys of all the columns. A sample decides only how
    rows travel, never a result.
    """
    wanted = SAMPLED_PER_PART * shuffle_parts(df)
    fraction = min(1.0, wanted / max(1, df.count()))
    sampled = df.select(*keys) if fraction == 1.0 else df.select(*keys).sample(fraction, SEED)
    return stage_table(sampled, shared_folder(df.sparkSession, "keys"))


def heavy_keys(df: DataFrame, key: str, most: int) -> DataFrame:
    """The values of a column that hold more than ``1 / most`` of the rows, and over how many parts to spread each.

    Found by counting a sample (a small table whole), for keys of any type and
    any ``most``. There are fewer than ``most`` of them and their parts add up to
    less than three times ``most``, whatever the data. They stay a table.
    """
    total = df.count()
    fraction = min(1.0, SAMPLED_PER_PART * most / max(1, total))
    sampled = df if fraction == 1.0 else df.sample(fraction, SEED)
    counts = sampled.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("heavy_key")).agg(F.count("*").alias("n"))
    share = F.col("n") * (most / max(1.0, total * fraction))
    return counts.filter(share > 1).select("heavy_key", F.ceil(2 * share).cast("int").alias("parts"))


def _spread_lookup(
    rows: DataFrame, lookup: DataFrame, key: str, lookup_key: str, heavy: DataFrame, spread_on: Sequence[str]
) -> DataFrame:
    """Shuffle join on the key and a part: rows of a heavy key are dealt over its parts, each of which gets its entries.

    Rows without a key are dealt out as well, and as their key equals none, they
    meet no entry. The heavy keys are fewer than the shuffle has partitions, so
    they can be sent to every task.
    """
    heavy = stage_table(heavy, shared_folder(rows.sparkSession, "heavy"))
    row_parts = heavy.select(F.col("heavy_key").alias("_row_key"), F.col("parts").alias("_row_parts"))
    entry_parts = heavy.select(F.col("heavy_key").alias("_entry_key"), F.col("parts").alias("_entry_parts"))

    marked = rows.join(F.broadcast(row_parts), F.col(key) == F.col("_row_key"), "left")
    dealt = F.when(F.col(key).isNull(), _scatter(spread_on)).otherwise(
        F.coalesce(F.pmod(_scatter(spread_on), F.col("_row_parts")), F.lit(0))
    )
    marked = marked.withColumn("_row_part", dealt).drop("_row_key", "_row_parts")

    copied = lookup.join(F.broadcast(entry_parts), F.col(lookup_key) == F.col("_entry_key"), "left")
    copies = F.explode(F.sequence(F.lit(0), F.coalesce("_entry_parts", F.lit(1)) - 1))
    copied = copied.withColumn("_entry_part", copies).drop("_entry_key", "_entry_parts")

    on = (F.col(key) == F.col(lookup_key)) & (F.col("_row_part") == F.col("_entry_part"))
    return marked.join(copied, on, "left").drop("_row_part", "_entry_part")


def store_lookup(lookup: DataFrame, key: str, name: str) -> DataFrame:
    """A large lookup as a table bucketed and sorted by its key, for joins that recur.

    It is moved and sorted once, here: a join by ``join_stored`` reads it as it
    lies. There are as many buckets as the session has shuffle partitions, each one
    file. The table lies in the run's folder, which ``drop_scratch`` removes.
    """
    spark, parts = lookup.sparkSession, shuffle_parts(lookup)
    table = f"{name}_{uuid.uuid4().hex}"
    writer = lookup.repartition(parts, key).write.format("parquet").bucketBy(parts, key).sortBy(key)
    writer.option("path", shared_folder(spark, name)).saveAsTable(table)
    return spark.table(table)


def join_stored(
    rows: DataFrame,
    stored: DataFrame,
    key: str,
    lookup_key: str,
    keys_from: DataFrame | None = None,
    spread_on: Sequence[str] | None = None,
) -> DataFrame:
    """As ``left_lookup``, with a lookup from ``store_lookup``, none of which is moved.

    Rows of heavy keys and rows without a key stay where they are and meet the few
    entries that are theirs; should those not be few, they go the way of
    ``left_lookup``. The other rows are moved to the buckets of their keys.
    """
    heavy = heavy_keys(rows if keys_from is None else keys_from, key, shuffle_parts(rows))
    heavy = stage_table(heavy, shared_folder(rows.sparkSession, "heavy"))
    marks = heavy.select(F.col("heavy_key").alias("_heavy"))
    marked = rows.join(F.broadcast(marks), F.col(key) == F.col("_heavy"), "left")
    apart = F.col("_heavy").isNotNull() | F.col(key).isNull()
    on = F.col(key) == F.col(lookup_key)
    moved = marked.filter(~apart).drop("_heavy").join(stored.hint("merge"), on, "left")
    entries = stored.join(F.broadcast(marks), F.col(lookup_key) == F.col("_heavy"), "left_semi")
    entries = stage_table(entries, shared_folder(rows.sparkSession, "entries"))
    staying = marked.filter(apart).drop("_heavy")
    if fits_broadcast(entries):
        return moved.unionByName(staying.join(F.broadcast(entries), on, "left"))
    names = rows.columns if spread_on is None else spread_on
    return moved.unionByName(_spread_lookup(staying, entries, key, lookup_key, heavy, names))


def _scatter(columns: Sequence[str]) -> Column:
    """A hash of the row and its input partition.

    A retried task sees both again, so a lost executor cannot move rows between
    partitions. The partition number separates exact copies.
    """
    return F.hash(F.spark_partition_id(), *map(F.col, columns))
