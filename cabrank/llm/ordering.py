"""Training order on disk: sequences as fixed-stride records in a keyed random order.

Documents become sequences of at most ``length`` ids. A sequence has a number:
the place of its document times the most sequences a document can have, plus its
own place in it. A keyed Feistel network with cycle walking permutes the range of
these numbers, and the slot of a sequence is its rank among the permuted numbers,
0 .. n - 1 without gaps. So the order needs no count of tokens beforehand, and
texts are tokenised once.

The permuted range is cut into equal parts, each of which becomes a shard: about
``records`` records of ``HEADER + 2 * length`` bytes. The manifest says with which
slot a shard begins, so the record of a slot starts at a known byte of a known
file, and reading can resume at any slot.

A record: document id and token count (little-endian 64 and 32 bits), piece
number (32 bits), then the ids in 16 bits each, filled up with ``PAD``. Empty and
NULL texts have no sequence; a very long text is tokenised whole, so a task holds
its ids. Ids of documents are cast to long, and fail where they are no numbers. A NULL id is written as ``NO_ID``. Equal rows are
sequences of their own. An empty table writes no shard.

The documents must come in the same places whenever they are read, as a table of
files does: places number the sequences.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cabrank.llm.common import staged, tasks_for
from cabrank.llm.storage import committed, open_folder
from cabrank.llm.tokens import RANKS, rows_of, token_ids
from cabrank.sinks.reports import shared_folder

ROUNDS = 6
ROW_BITS = 33  # of a row in its partition, in monotonically_increasing_id
HEADER = 16
PAD = 0xFFFF
BYTES_A_TOKEN = 2.5  # for the number of shards only
NO_ID = -(1 << 63)
MIX = np.uint64(0x9E3779B97F4A7C15)  # odd, so multiplying by it loses nothing


@dataclass(frozen=True)
class Layout:
    """``length``: ids of a record; ``records``: about so many in a shard; ``key``: of the order."""

    length: int = 512
    records: int = 8192
    key: int = 20240601

    @property
    def stride(self) -> int:
        return HEADER + 2 * self.length


def _scramble(values: np.ndarray, key: int) -> np.ndarray:
    """A keyed 64-bit hash of each value."""
    mixed = (values + np.uint64(key & 0xFFFFFFFFFFFFFFFF)) * MIX
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    return mixed ^ (mixed >> np.uint64(32))


def permute(rows: np.ndarray, n: int, key: int) -> np.ndarray:
    """Slots of row numbers: a bijection of 0 .. n - 1.

    The network permutes the smallest even number of bits that holds n values;
    a result of n or more goes through it again until it falls below n. Less
    than four values in one are beyond n, so few walks are long.
    """
    half = max(1, ((max(n, 2) - 1).bit_length() + 1) // 2)
    mask, shift = np.uint64((1 << half) - 1), np.uint64(half)
    slots = rows.astype(np.uint64)
    todo = np.arange(len(slots))
    while len(todo):
        left, right = slots[todo] >> shift, slots[todo] & mask
        for step in range(ROUNDS):
            left, right = right, left ^ (_scramble(right, key * ROUNDS + step) & mask)
        slots[todo] = (left << shift) | right
        todo = todo[slots[todo] >= np.uint64(n)]
    return slots.astype(np.int64)


@dataclass(frozen=True)
class Numbering:
    """Rows of the largest partition, sequences of the longest document, size of the range, and of a part of it."""

    rows: int
    pieces: int
    size: int
    width: int

    @classmethod
    def of(cls, docs: DataFrame, layout: Layout) -> Numbering:
        """From counts and text lengths alone; a token has a byte at least."""
        octets = F.coalesce(F.octet_length("text"), F.lit(0))
        each = docs.groupBy(F.spark_partition_id().alias("part")).agg(
            F.count("*").alias("rows"), F.max(octets).alias("longest"), F.sum(octets).alias("octets")
        )
        found = each.agg(F.max("part"), F.max("rows"), F.max("longest"), F.sum("octets"), F.sum("rows")).first()
        parts, rows, longest, total, count = (x or 0 for x in found)
        pieces = max(1, -(-longest // layout.length))
        size = max(1, (parts + 1) * rows * pieces)
        expected = total / (BYTES_A_TOKEN * layout.length) + count / 2
        return cls(rows, pieces, size, -(-size // max(1, round(expected / layout.records))))

    def permuted(self, places: np.ndarray, pieces: np.ndarray, key: int) -> np.ndarray:
        documents = (places >> ROW_BITS) * self.rows + (places & ((1 << ROW_BITS) - 1))
        return permute(documents * self.pieces + pieces, self.size, key)


def sequences(docs: DataFrame, layout: Layout, numbering: Numbering, path: str = RANKS) -> DataFrame:
    """Documents (``doc_id``, ``text``) cut into sequences, each with its permuted number and the shard that it belongs to."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in rows_of(batches, "place", "doc_id", "text"):
            out = []
            for place, key, content in rows:
                found = token_ids(content, path).astype("<u2")
                for n, at in enumerate(range(0, len(found), layout.length)):
                    out.append((place, n, key, found[at : at + layout.length].tobytes()))
            if not out:
                continue
            places, pieces, keys, ids = zip(*out, strict=True)
            order = numbering.permuted(np.array(places, np.int64), np.array(pieces, np.int64), layout.key)
            columns = [pa.array(order // numbering.width, pa.int64()), pa.array(order, pa.int64())]
            columns += [pa.array(keys, pa.int64()), pa.array(pieces, pa.int32()), pa.array(ids, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["shard", "number", "doc_id", "piece", "ids"])

    placed = docs.withColumn("place", F.monotonically_increasing_id())
    return placed.mapInArrow(cut, "shard long, number long, doc_id long, piece int, ids binary")


def write_order(docs: DataFrame, uri: str, layout: Layout = Layout(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Write the shards below ``uri``; one row for each: shard, file, first slot, records, CRC-32 of the file.

    A task has a range of shards, sorts their sequences and writes one file after
    the other; there are as many tasks as shuffle partitions, or shards if those
    are fewer. The manifest is staged when all shards are in place; files that it
    does not list do not count.
    """
    named = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    numbering = Numbering.of(named, layout)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, records = None, []
        for rows in rows_of(batches, "shard", "doc_id", "piece", "ids", most=1024):
            for number, key, piece, ids in rows:
                if number != shard and records:
                    yield _store(uri, shard, records)
                    records = []
                shard = number
                head = np.array([NO_ID if key is None else key], "<i8").tobytes()
                head += np.array([len(ids) // 2, piece], "<i4").tobytes()
                records.append(head + ids + b"\xff" * (2 * layout.length - len(ids)))
        if records:
            yield _store(uri, shard, records)

    shards = -(-numbering.size // numbering.width)
    tasks = tasks_for(docs, shards)
    dealt = sequences(named, layout, numbering).repartitionById(tasks, F.floor(F.col("shard") * tasks / shards).cast("int"))
    written = dealt.sortWithinPartitions("shard", "number").mapInArrow(write, "shard long, file string, records long, crc32 long")
    return staged(with_starts(staged(written, "shards")), "manifest")


def with_starts(shards: DataFrame) -> DataFrame:
    """Shards with their first slot: records before them in their thousand of shards, and in the thousands before."""
    group = F.floor(F.col("shard") / 1000)
    grouped = shards.withColumn("thousand", group)
    totals = grouped.groupBy("thousand").agg(F.sum("records").alias("total"))
    before = Window.orderBy("thousand").rowsBetween(Window.unboundedPreceding, -1)
    within = Window.partitionBy("thousand").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("thousand", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    inside = grouped.withColumn("inside", F.coalesce(F.sum("records").over(within), F.lit(0)))
    return inside.join(totals, "thousand").withColumn("start", F.col("base") + F.col("inside")).drop(
        "thousand", "base", "inside"
    )


def _store(uri: str, shard: int, records: list[bytes]) -> pa.RecordBatch:
    name, content = f"shard-{shard:08d}.bin", b"".join(records)
    with committed(uri, name) as stream:
        stream.write(content)
    row = {"shard": [shard], "file": [name], "records": [len(records)], "crc32": [zlib.crc32(content)]}
    return pa.RecordBatch.from_pydict(row)


def read_order(manifest: DataFrame, uri: str, layout: Layout = Layout(), start: int = 0, stop: int | None = None) -> DataFrame:
    """Records of the slots from ``start`` up to ``stop``, read from their bytes in the listed shards."""
    wanted = manifest.filter(F.col("start") + F.col("records") > start)
    if stop is not None:
        wanted = wanted.filter(F.col("start") < stop)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, folder = open_folder(uri)
        for rows in rows_of(batches, "shard", "file", "start", "records"):
            for shard, name, first, records in rows:
                low = max(0, start - first)
                high = records if stop is None else min(records, stop - first)
                with system.open_input_file(f"{folder}/{name}") as stream:
                    for at in range(low, high, 1024):
                        many = min(1024, high - at)
                        yield _records(stream.read_at(many * layout.stride, at * layout.stride), shard, first, at, layout)

    schema = "slot long, doc_id long, piece int, n_tokens int, ids_crc32 long, shard long, position long"
    return wanted.repartition(tasks_for(wanted, wanted.count()), "shard").mapInArrow(read, schema)


def _records(content: bytes, shard: int, first: int, at: int, layout: Layout) -> pa.RecordBatch:
    rows = np.frombuffer(content, np.uint8).reshape(-1, layout.stride)
    keys = np.ascontiguousarray(rows[:, :8]).view("<i8").ravel()
    counts, numbers = np.ascontiguousarray(rows[:, 8:HEADER]).view("<i4").T
    sums = [zlib.crc32(row[HEADER : HEADER + 2 * n].tobytes()) for row, n in zip(rows, counts, strict=True)]
    position = np.arange(at, at + len(rows))
    return pa.RecordBatch.from_arrays(
        [
            pa.array(position + first, pa.int64()),
            pa.array(keys, pa.int64(), mask=keys == NO_ID),
            pa.array(numbers, pa.int32()),
            pa.array(counts, pa.int32()),
            pa.array(sums, pa.int64()),
            pa.array(np.full(len(rows), shard), pa.int64()),
            pa.array(position * layout.stride, pa.int64()),
        ],
        ["slot", "doc_id", "piece", "n_tokens", "ids_crc32", "shard", "position"],
    )


def training_order(docs: DataFrame, layout: Layout = Layout(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Write all documents in training order under the shared folder and read every record back."""
    uri = shared_folder(docs.sparkSession, "order")
    return read_order(write_order(docs, uri, layout, doc_id, text), uri, layout)
