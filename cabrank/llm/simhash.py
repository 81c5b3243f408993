"""Near copies by 64-bit SimHash fingerprints that differ in few bits.

Fingerprints are indexed by the bytes at their positions. A posting list belongs
to some of the eight positions and the bytes there: lists of single bytes would
each hold a 256th of the corpus. For up to three differing bits there are
fourteen lists for each fingerprint, of four positions each: the quadruples of
positions, as numbers of three bits, whose exclusive or is zero. Any three
positions lie together in one of them, and every other pair, triple and so on
equally often, so bits that differ spoil as few lists as can be. For four bits
there are the 56 triples of positions.

1. *Tally.* For each pair of fingerprints that meet, the lists that they share are counted.
2. *Count filter.* Pairs below the number that is left when the differing bits lie
   in as many positions, and in the worst of them, fall: for one, two and three
   bits 7, 3 and 1 of 14, for four 4 of 56.
3. *Verification.* The rest is held against the differing bits.

A list of more than ``LIST`` fingerprints would give too many pairs. Its members
are linked by midpoints instead, which is exact as well: two fingerprints differ
in at most ``d`` bits if and only if some value differs from one of them in at
most half as many, rounded down, and from the other in the rest. Every member
names the values around it, and those that name one value are linked to the
smallest that is near enough to be in reach of all.

Only different fingerprints are indexed and linked, so copies cost nothing. NULL
text has no words and fingerprint zero, which is linked like any other. Rows with
equal ids each get a row; NULL ids never are the smallest of a component, and one
with NULL ids only has a NULL component id. Empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import accumulate, combinations
from operator import xor

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cabrank.llm.common import give_back, staged
from cabrank.llm.components import components

SHINGLE = 3
DISTANCE = 2
SEED = 42
LIST = 128
MOST_DISTANCE = 4
POSITIONS = 8
SUM_ROWS = 60_000
#: Four 16-bit counters, one for each bit of half a byte.
LANES = np.array([sum((x >> b & 1) << 16 * b for b in range(4)) for x in range(16)], np.uint64)


def shingle_hashes(text: str | None, shingle: int = SHINGLE) -> list[int]:
    """XXH64 of each run of so many words; a shorter text is one shingle, one without words has none."""
    words = text.encode().lower().split() if text else []
    if not words:
        return []
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return [digest(joined, SEED)]
    ends = list(accumulate(len(word) + 1 for word in words))
    starts = [0, *ends]
    return [digest(joined[a : b - 1], SEED) for a, b in zip(starts, ends[shingle - 1 :], strict=False)]


def fingerprints(hashes: list[list[int]]) -> np.ndarray:
    """For each list of hashes the bits that are set in over half of them."""
    sizes = np.array([len(x) for x in hashes])
    counts = np.zeros((len(hashes), 64), np.int64)
    if sizes.sum():
        flat = np.fromiter((h for x in hashes for h in x), np.uint64, sizes.sum())
        firsts = np.cumsum(sizes) - sizes
        parts = [(d, a) for d, (f, n) in enumerate(zip(firsts, sizes, strict=True)) for a in range(f, f + n, SUM_ROWS)]
        owners, starts = np.array(parts).T
        for nibble in range(16):
            sums = np.add.reduceat(LANES[(flat >> np.uint64(4 * nibble)) & np.uint64(15)], starts)
            for bit in range(4):
                lane = (sums >> np.uint64(16 * bit)) & np.uint64(0xFFFF)
                np.add.at(counts[:, 4 * nibble + bit], owners, lane.astype(np.int64))
    bits = counts * 2 > sizes[:, None]
    return (bits.astype(np.uint64) << np.arange(64, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)


def fingerprint(text: str = "text", shingle: int = SHINGLE) -> Column:
    """The fingerprint of each whole text, its 64 bits as a signed number."""

    @F.pandas_udf("long")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            parts = [texts[at : at + 128] for at in range(0, len(texts), 128)]
            found = [fingerprints([shingle_hashes(x, shingle) for x in part]).view(np.int64) for part in parts]
            del texts, parts
            yield pd.Series(np.concatenate(found) if found else np.empty(0, np.int64))
            give_back()

    return of(F.col(text))


def hexadecimal(value: Column) -> Column:
    return F.lower(F.lpad(F.hex(value), 16, "0"))


def lists_of(distance: int) -> list[tuple[int, ...]]:
    """The positions of each posting list."""
    if distance == MOST_DISTANCE:
        return list(combinations(range(POSITIONS), 3))
    return [c for c in combinations(range(POSITIONS), 4) if reduce(xor, c) == 0]


def guaranteed(distance: int) -> int:
    """How many lists a pair shares at least, wherever its differing bits are."""
    lists = lists_of(distance)
    return min(sum(not set(spoilt) & set(own) for own in lists) for spoilt in combinations(range(POSITIONS), distance))


def postings(prints: DataFrame, distance: int) -> DataFrame:
    """Each fingerprint under the number of every list and the bytes there."""
    byte = [F.shiftrightunsigned(F.col("fp"), 8 * i).bitwiseAND(255) for i in range(POSITIONS)]
    keys = [
        reduce(lambda key, i: F.shiftleft(key, 8).bitwiseOR(byte[i]), own, F.lit(n).cast("long"))
        for n, own in enumerate(lists_of(distance))
    ]
    return prints.select("fp", F.explode(F.array(*keys)).alias("key"))


def tallied(entries: DataFrame) -> DataFrame:
    """Pairs of fingerprints that share lists, and how many."""
    a = entries.select("key", F.col("fp").alias("a"))
    pairs = a.join(entries.select("key", F.col("fp").alias("b")), "key").filter("a < b")
    return pairs.groupBy("a", "b").agg(F.count("*").alias("lists"))


def links(prints: DataFrame, distance: int = DISTANCE, most: int = LIST) -> DataFrame:
    """Pairs of different fingerprints that connect all that differ in at most ``distance`` bits (at most 4)."""
    if not 0 <= distance <= MOST_DISTANCE:
        raise ValueError("the index is for at most four differing bits")
    entries = postings(prints, distance)
    sizes = entries.groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") > 1)
    met = staged(entries.join(sizes, "key"), "postings")
    enough = tallied(met.filter(F.col("n") <= most)).filter(F.col("lists") >= guaranteed(distance))
    pairs = enough.filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance)
    crowded = met.filter(F.col("n") > most).select("fp").distinct()
    return pairs.select("a", "b").unionAll(_midpoints(crowded, distance)).distinct()


def _midpoints(prints: DataFrame, distance: int) -> DataFrame:
    """Stars that connect all fingerprints in reach of each other, without a pair for each.

    A value in reach of a fingerprint by half the distance is a centre: all that
    name the value by the rest of the distance are in reach of the centre.
    """
    near, far = distance // 2, distance - distance // 2
    masks = [sum(1 << bit for bit in bits) for n in range(far + 1) for bits in combinations(range(64), n)]
    masks = [mask - (1 << 64) if mask >> 63 else mask for mask in masks]
    named = prints.select("fp", F.explode(F.lit(masks)).alias("mask"))
    named = named.select("fp", F.col("fp").bitwiseXOR(F.col("mask")).alias("value"), (F.bit_count("mask") <= near).alias("near"))
    shared = named.groupBy("value").agg(F.min(F.when(F.col("near"), F.col("fp"))).alias("centre"), F.collect_list("fp").alias("fps"))
    starred = shared.filter(F.size("fps") > 1).select("centre", F.explode("fps").alias("fp")).filter("centre <> fp")
    return starred.select(F.least("centre", "fp").alias("a"), F.greatest("centre", "fp").alias("b"))


def grouped(docs: DataFrame, doc_id: str, text: str, shingle: int, distance: int, *keep: str) -> DataFrame:
    """Per document row: id, fingerprint, the group's smallest fingerprint and smallest id, and the columns to keep."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), fingerprint(text, shingle).alias("fp"), *keep)
    rows = staged(rows, "fingerprints")
    prints = staged(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "prints")
    rooted = components(links(prints, distance)).withColumnRenamed("node", "fp")
    rooted = prints.join(rooted, "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    return rows.join(rooted.join(smallest, "root").drop("first"), "fp")


def near_copies(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, distance: int = DISTANCE
) -> DataFrame:
    """Per document row: id, fingerprint and the smallest id that links of at most ``distance`` bits reach."""
    found = grouped(docs, doc_id, text, shingle, distance)
    return found.select("doc_id", hexadecimal(F.col("fp")).alias("fingerprint"), "component_id")


def one_of_each(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, distance: int = DISTANCE
) -> DataFrame:
    """One row of each group, with the columns it came with: the one with the smallest id, NULL being the largest.

    Rows of one id are told apart by a hash of all columns, and of rows equal in
    all of them one stays. Winners are found on ids and hashes alone; texts move
    once, to meet them.
    """
    packed = docs.select(F.struct(*docs.columns).alias("row"), F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    packed = packed.withColumn("hash", F.xxhash64("row"))
    found = grouped(packed, "doc_id", "text", shingle, distance, "hash")
    order = F.struct(F.isnull("doc_id"), F.col("doc_id").alias("id"), F.col("hash").alias("hash"))
    winners = found.groupBy("root").agg(F.min(order).alias("best")).select("best.id", F.col("best.hash").alias("best_hash"))
    meets = (F.col("hash") == F.col("best_hash")) & F.col("doc_id").eqNullSafe(F.col("id"))
    kept = packed.select("row", "doc_id", "hash").join(winners.hint("shuffle_hash"), meets, "left_semi")
    return kept.dropDuplicates(["hash", "doc_id"]).select("row.*")
