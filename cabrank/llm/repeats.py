"""Removing every byte of long strings that occur more than once in a corpus.

A byte goes if a string of ``LEAST`` bytes that covers it also starts anywhere
else, in the same document or another. Strings are judged on the input; matches
never cross documents.

1. *Anchors.* Of all ``GRAM``-byte strings in a window of ``LEAST`` bytes, the one
   with the smallest hash is its anchor (the first of equals). Equal windows have
   equal anchors at equal places, so a window whose anchor occurs once in the
   corpus is unique. Windows that follow each other with one anchor form a run.
   Anchors only say which runs have to be compared.
2. *Shards.* Runs with an anchor that recurs are kept, with a SHA-256 of their text.
   The different texts around one anchor are brought together in shards of bounded
   size, two copies of each text that occurs more than once. Further copies would
   tell nothing new; what is found for a text holds for all runs of its digest.
   Runs that follow each other in both copies are compared in one piece.
3. *Suffix arrays.* Each shard gets a suffix array by Larsson-Sadakane refinement and
   common prefixes by Kasai's scan. They alone tell the windows that recur in it.
4. *Across shards.* Anchors with too many different texts for a shard are dealt
   over several. Their shards send a digest for each different window, sorted;
   binary search among all of them finds those of more than one shard.

Digests are 128 bits of SHA-256 over a secret of the run and the text, so nobody can
prepare texts that share one.

Work and data moved are in proportion to the text; texts travel by document once
to fetch runs and once to be cut. Very long texts are scanned piece by piece.

Documents are told apart by such a digest of id and text, in 64 bits, and their length. Rows equal in both id
and text repeat each other, so all their long strings go. NULL text is empty;
NULL ids are kept. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import secrets
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from cabrank.llm.common import give_back, staged, text_blocks
from cabrank.llm.suffixes import Buffer, repeated
from cabrank.llm.tokens import rows_of

LEAST = 200
GRAM = 64
SHARD_BYTES = 1 << 20
SCAN_BYTES = 1 << 20
STRETCH = 1 << 9
DIGEST = 16  # bytes
PLACE_BITS = np.uint64(22)  # of a place in a scanned block
BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse
BYTE_VALUES = np.random.default_rng(20240601).integers(1, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)


@dataclass(frozen=True)
class Sizes:
    """``bits``: of the hashes that choose anchors; with fewer of them more texts have to be compared, and no result changes."""

    least: int = LEAST
    gram: int = GRAM
    shard: int = SHARD_BYTES
    bits: int = 64

    def __post_init__(self) -> None:
        if not 1 <= self.gram <= self.least or self.least < 8:
            raise ValueError("a gram is at most as long as the strings, which have at least 8 bytes")
        if not 1 <= self.bits <= 64:
            raise ValueError("a hash has 1 to 64 bits")


@lru_cache(maxsize=4)
def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, np.uint64(base))
    out[0] = 1
    return np.multiply.accumulate(out)


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return values ^ (values >> np.uint64(29))


class Hashes:
    """Hashes of all substrings of one length of a block, from one pass over it."""

    def __init__(self, text: np.ndarray) -> None:
        size = 1 << max(21, len(text).bit_length())
        self.sums = np.zeros(len(text) + 1, np.uint64)
        np.cumsum(BYTE_VALUES[text] * _powers(BASE, size)[: len(text)], out=self.sums[1:])
        self.inverse = _powers(pow(BASE, -1, 1 << 64), size)

    def all(self, length: int) -> np.ndarray:
        n = len(self.sums) - length
        return _mixed((self.sums[length:] - self.sums[:n]) * self.inverse[:n])


def digest(text: bytes, secret: bytes) -> bytes:
    return hashlib.sha256(secret + text).digest()[:DIGEST]


def runs_of(texts: list[bytes], sizes: Sizes) -> tuple[np.ndarray, ...]:
    """Anchor hash, text number, start and window count of every run of a block."""
    lengths = np.array([len(t) for t in texts], np.int64)
    firsts = np.cumsum(lengths) - lengths
    text = np.frombuffer(b"".join(texts), np.uint8)
    none = np.empty(0, np.int64)
    if lengths.max(initial=0) < sizes.least:
        return none, none, none, none
    grams = Hashes(text).all(sizes.gram) >> np.uint64(64 - sizes.bits) << np.uint64(64 - sizes.bits)
    place = (np.uint64(1) << PLACE_BITS) - np.uint64(1)
    smallest = (grams & ~place) | np.arange(len(grams), dtype=np.uint64)
    span, width = sizes.least - sizes.gram + 1, 1
    while width * 2 <= span:
        smallest = np.minimum(smallest[:-width], smallest[width:])
        width *= 2
    if width < span:
        rest = span - width
        smallest = np.minimum(smallest[: len(smallest) - rest], smallest[rest:])
    anchors = (smallest & place).astype(np.int64)
    owner = np.repeat(np.arange(len(texts)), lengths)[: len(anchors)]
    whole = np.arange(len(anchors)) + sizes.least <= (firsts + lengths)[owner]
    change = np.ones(len(anchors), bool)
    change[1:] = (anchors[1:] != anchors[:-1]) | (whole[1:] != whole[:-1]) | (owner[1:] != owner[:-1])
    starts = np.flatnonzero(change)
    counts = np.diff(np.append(starts, len(anchors)))
    starts, counts = starts[whole[starts]], counts[whole[starts]]
    return grams[anchors[starts]].view(np.int64), owner[starts], starts - firsts[owner[starts]], counts


def with_key(docs: DataFrame, doc_id: str, text: str, secret: str, *more: str) -> DataFrame:
    """Documents with what tells them apart: a digest of id and text, and the length in bytes."""
    named = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(text, F.lit("")).alias("text"), *more)
    whole = F.concat_ws("\n", F.lit(secret), F.col("doc_id").cast("string"), "text")
    return named.withColumns({"key": F.xxhash64(F.sha2(whole, 256)), "size": F.octet_length("text")})


def anchors(docs: DataFrame, sizes: Sizes) -> DataFrame:
    """The anchor of every run of every document."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, parts in _scanned(batches, sizes):
            yield pa.RecordBatch.from_arrays([pa.array(runs_of([p[2] for p in parts], sizes)[0], pa.int64())], ["anchor"])

    return docs.filter(F.octet_length("text") >= sizes.least).select("text").mapInArrow(scan, "anchor long")


def runs(keyed: DataFrame, sizes: Sizes, secret: str) -> DataFrame:
    """Every run of every document: anchor, digest of its text, document, start and number of windows."""
    names, salt = ["anchor", "content", "key", "size", "start", "windows"], secret.encode()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, parts in _scanned(batches, sizes):
            anchor, part, start, windows = runs_of([p[2] for p in parts], sizes)
            ends = start + windows - 1 + sizes.least
            found = zip(part.tolist(), start.tolist(), ends.tolist(), strict=True)
            contents = [digest(parts[n][2][a:b], salt) for n, a, b in found]
            numbers, offsets = np.array([p[:2] for p in parts], np.int64).T
            own = pa.array(numbers[part])
            columns = [
                pa.array(anchor, pa.int64()),
                pa.array(contents, pa.binary()),
                rows.column("key").take(own),
                rows.column("size").take(own),
                pa.array(offsets[part] + start, pa.int64()),
                pa.array(windows, pa.int32()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names)

    wanted = keyed.filter(F.col("size") >= sizes.least).select("key", "size", "text")
    return wanted.mapInArrow(scan, "anchor long, content binary, key long, size int, start long, windows int")


def _scanned(batches: Iterator[pa.RecordBatch], sizes: Sizes) -> Iterator[tuple[pa.RecordBatch, list[tuple[int, int, bytes]]]]:
    """Some rows, and their texts in pieces: row, offset, bytes."""
    for rows, texts in text_blocks(batches, "text", SCAN_BYTES):
        parts = [(i, at, piece) for i, text in enumerate(texts) for at, piece in _pieces(text, sizes.least)]
        for block in _blocks(parts) if parts else ():
            yield rows, parts[block]


def _pieces(text: bytes, least: int) -> Iterator[tuple[int, bytes]]:
    """A text in pieces of bounded length that overlap so far that each window lies in one of them."""
    for at in range(0, max(1, len(text) - least + 1), SCAN_BYTES):
        yield at, text[at : at + SCAN_BYTES + least - 1]


def _blocks(parts: list[tuple[int, int, bytes]]) -> Iterator[slice]:
    start = size = 0
    for i, part in enumerate(parts):
        if size and size + len(part[2]) > 2 * SCAN_BYTES:
            yield slice(start, i)
            start, size = i, 0
        size += len(part[2])
    yield slice(start, len(parts))


def recurring(keyed: DataFrame, sizes: Sizes, secret: str) -> DataFrame:
    """Runs with an anchor that occurs more than once, staged.

    Counts are folded in each task, and staged: between two plain shuffles,
    adaptive execution deals the many rows of a popular anchor over several tasks.
    """
    counts = anchors(keyed, sizes).groupBy("anchor").agg(F.count("*").alias("n")).filter(F.col("n") > 1).select("anchor")
    return staged(runs(keyed, sizes, secret).join(staged(counts, "anchors", lean=True), "anchor"), "runs", lean=True)


#: The runs of a segment: anchor, digest, place of the first window in the segment, number of windows.
MEMBERS = "array<struct<anchor: bigint, content: binary, place: int, windows: int>>"


def _texts(chosen: DataFrame, keyed: DataFrame, sizes: Sizes) -> DataFrame:
    """The text of each chosen segment, fetched from the documents."""
    columns = ["anchor", "content", "copy", "salt", "split", "members"]
    wanted = chosen.groupBy("key", "size").agg(F.collect_list(F.struct(*columns, "start", "windows")).alias("segments"))
    joined = keyed.select("key", "size", "text").join(wanted.hint("shuffle_hash"), ["key", "size"])

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in text_blocks(batches, "text"):
            found = rows.column("segments")
            segments = found.flatten()
            owners = np.repeat(np.arange(len(texts)), pa.compute.list_value_length(found).to_numpy()).tolist()
            starts, windows = (segments.field(name).to_numpy() for name in ("start", "windows"))
            ends = (starts + windows - 1 + sizes.least).tolist()
            contents = [texts[n][a:b] for n, a, b in zip(owners, starts.tolist(), ends, strict=True)]
            arrays = [*map(segments.field, columns), pa.array(contents, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, [*columns, "text"])

    schema = f"anchor long, content binary, copy int, salt int, split boolean, members {MEMBERS}, text binary"
    return joined.select("text", "segments").mapInArrow(fetch, schema)


def _within_shards(texts: DataFrame, sizes: Sizes, secret: str) -> DataFrame:
    """Repeated windows of each run by the suffix array of its shard; digests of windows where an anchor has several shards.

    Equal rows of the input bring a copy once each; the first is enough.
    """
    salt = secret.encode()

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard: list[pa.RecordBatch] = []
        size, last = 0, None
        for batch in batches:
            columns = [batch.column(name).to_pylist() for name in ("anchor", "salt", "content", "copy")]
            lengths = pa.compute.binary_length(batch.column("text")).to_pylist()
            kept: list[int] = []
            for i, (row, n) in enumerate(zip(zip(*columns, strict=True), lengths, strict=True)):
                if row == last:
                    continue
                if size >= sizes.shard and row[:2] != last[:2]:
                    yield _judged([*shard, batch.take(pa.array(kept, pa.int32()))], sizes, salt)
                    shard, size, kept = [], 0, []
                kept.append(i)
                size += n
                last = row
            shard.append(batch.take(pa.array(kept, pa.int32())))
            del batch
            give_back()
        if size:
            yield _judged(shard, sizes, salt)

    dealt = texts.repartition("anchor", "salt").sortWithinPartitions("anchor", "salt", "content", "copy")
    schema = "anchor long, content binary, spans array<int>, highs array<long>, lows array<long>, places array<int>, single array<boolean>"
    return dealt.mapInArrow(judge, schema)


def _judged(shard: list[pa.RecordBatch], sizes: Sizes, salt: bytes) -> pa.RecordBatch:
    """What the suffix array of a shard tells of each run, by the first copy of its text."""
    rows = pa.concat_batches(shard)
    raw = rows.column("text").to_pylist()
    text = Buffer.of(raw)
    found, first = repeated(text, sizes.least)
    one = np.flatnonzero(rows.column("copy").to_numpy() == 0)
    members = rows.column("members").take(pa.array(one))
    owner = np.repeat(one, pa.compute.list_value_length(members).to_numpy())
    runs = members.flatten()
    place, windows = (runs.field(name).to_numpy().astype(np.int64) for name in ("place", "windows"))
    run = np.repeat(np.arange(len(runs)), windows)  # of each window
    begin = np.cumsum(windows) - windows  # of each run among the windows
    at = np.arange(len(run)) + (text.starts[owner] + place - begin)[run]
    marked = found[at]
    split = rows.column("split").to_numpy(zero_copy_only=False)[owner]
    sent = np.flatnonzero(first[at] & split[run])
    own = owner[run[sent]]
    digests = [
        digest(raw[n][a : a + sizes.least], salt) for n, a in zip(own.tolist(), (at[sent] - text.starts[own]).tolist(), strict=True)
    ]
    highs, lows = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2).T

    fresh = np.zeros(len(run) + 1, bool)
    fresh[begin] = True
    fresh[-1] = True
    low = np.flatnonzero(marked & (fresh[:-1] | ~np.roll(marked, 1)))
    high = np.flatnonzero(marked & (fresh[1:] | ~np.roll(marked, -1)))
    spans = (np.stack([low, high + 1], axis=1) - begin[run[low], None]).ravel()

    def lists(values: np.ndarray, kind: pa.DataType, of: np.ndarray) -> pa.ListArray:
        offsets = np.concatenate([[0], np.cumsum(np.bincount(of, minlength=len(runs)))])
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))

    columns = {
        "anchor": runs.field("anchor"),
        "content": runs.field("content"),
        "spans": lists(spans, pa.int32(), np.repeat(run[low], 2)),
        "highs": lists(highs, pa.int64(), run[sent]),
        "lows": lists(lows, pa.int64(), run[sent]),
        "places": lists(sent - begin[run[sent]], pa.int32(), run[sent]),
        "single": lists(~marked[sent], pa.bool_(), run[sent]),
    }
    return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))


def spans_of(marked: np.ndarray) -> np.ndarray:
    """First and beyond-last places of the marked stretches, one after the other."""
    if marked.all():
        return np.array([0, len(marked)] if len(marked) else [], np.int64)
    edges = np.diff(np.concatenate([[0], marked.astype(np.int8), [0]]))
    return np.flatnonzero(edges)


def _across_shards(judged: DataFrame) -> DataFrame:
    """Windows that are single in their shard and occur in another shard of their anchor.

    Digests are dealt by range and sorted; those of one window are found by
    binary search. There is one for each shard at most.
    """
    each = judged.filter(F.size("highs") > 0).select(
        "anchor", "content", F.inline(F.arrays_zip("highs", "lows", "places", "single"))
    )
    dealt = each.repartitionByRange("highs").sortWithinPartitions("highs", "lows", "anchor")

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            rows = batch if held is None else pa.concat_batches([held, batch])
            highs = rows.column("highs").to_numpy()
            done = int(np.searchsorted(highs, highs[-1], "left")) if len(highs) else 0
            yield _shared(rows.slice(0, done))
            held = rows.slice(done)
        if held is not None:
            yield _shared(held)

    return dealt.mapInArrow(merge, "anchor long, content binary, place int")


def _shared(rows: pa.RecordBatch) -> pa.RecordBatch:
    keys = [rows.column(name).to_numpy() for name in ("highs", "lows", "anchor")]
    change = np.logical_or.reduce([key[1:] != key[:-1] for key in keys])
    window = np.concatenate([[0], np.cumsum(change)]) if rows.num_rows else np.empty(0, np.int64)
    several = np.searchsorted(window, window, "right") - np.searchsorted(window, window, "left") > 1
    keep = pa.array(several & rows.column("single").to_numpy(zero_copy_only=False))
    columns = [rows.column(name).filter(keep) for name in ("anchor", "content", "places")]
    return pa.RecordBatch.from_arrays(columns, ["anchor", "content", "place"])


def _singles(texts: DataFrame, sizes: Sizes) -> DataFrame:
    """Each text of an anchor with several as a segment, twice if it recurs, in the shard that its digest says."""
    shards = F.ceil(2 * F.col("bytes") / sizes.shard).cast("int")
    run = F.struct("anchor", "content", F.lit(0).alias("place"), F.col("first.windows").alias("windows"))
    both = F.when(F.col("n") > 1, F.array("first", "last")).otherwise(F.array("first"))
    copies = texts.select(
        "anchor",
        "content",
        F.pmod(F.xxhash64("content"), shards).cast("int").alias("salt"),
        (shards > 1).alias("split"),
        F.array(run).cast(MEMBERS).alias("members"),
        F.posexplode(both).alias("copy", "place"),
    )
    return copies.select("anchor", "content", "salt", "split", "members", "copy", "place.*")


def _stretches(texts: DataFrame) -> DataFrame:
    """Texts that are the only one of their anchor, and recur: those that follow each other in both copies are one segment.

    So a long passage that two documents share comes once from each, and not as
    runs that overlap. A segment has about ``STRETCH`` windows at most.
    """
    order = Window.partitionBy("first.key", "first.size", "last.key", "last.size").orderBy("first.start", "last.start")
    goes_on = reduce(
        Column.__and__,
        [F.col(f"{copy}.start") == F.lag(F.col(f"{copy}.start") + F.col(f"{copy}.windows")).over(order) for copy in ("first", "last")],
    )
    block = F.floor(F.col("first.start") / STRETCH)
    begins = ~F.coalesce(goes_on & (block == F.lag(block).over(order)), F.lit(False))
    numbered = texts.withColumn("begins", begins.cast("int")).withColumn("stretch", F.sum("begins").over(order))
    run = F.struct(F.col("first.start").alias("start"), F.col("first.windows").alias("windows"), "anchor", "content")
    stretches = numbered.groupBy("first.key", "first.size", "last.key", "last.size", "stretch").agg(
        F.min("first").alias("first"),
        F.min("last").alias("last"),
        F.sum("first.windows").cast("int").alias("windows"),
        F.sort_array(F.collect_list(run)).alias("runs"),
    )
    members = F.transform(
        "runs",
        lambda r: F.struct(r["anchor"], r["content"], (r["start"] - F.col("first.start")).cast("int").alias("place"), r["windows"]),
    )
    place = [F.struct(F.col(f"{copy}.key"), F.col(f"{copy}.size"), F.col(f"{copy}.start"), "windows") for copy in ("first", "last")]
    copies = stretches.select(
        F.col("runs")[0]["anchor"].alias("anchor"),
        F.col("runs")[0]["content"].alias("content"),
        F.lit(0).alias("salt"),
        F.lit(False).alias("split"),
        members.cast(MEMBERS).alias("members"),
        F.posexplode(F.array(*place)).alias("copy", "place"),
    )
    needed = F.when(F.col("copy") == 0, F.col("members")).otherwise(F.array().cast(MEMBERS))
    return copies.select("anchor", "content", "salt", "split", needed.alias("members"), "copy", "place.*")


def repeated_windows(keyed: DataFrame, sizes: Sizes, secret: str) -> DataFrame:
    """Per document with a repeated string: key, size and its stretches of repeated windows.

    ``stretches`` are places of a first window and of the one beyond a last, in
    turn. Equal rows bring the same ones, which are kept once.
    """
    found = recurring(keyed, sizes, secret)
    place = F.struct("key", "size", "start", "windows")
    texts = found.groupBy("anchor", "content").agg(
        F.count("*").alias("n"), F.min(place).alias("first"), F.max(place).alias("last")
    )
    texts = staged(texts, "texts", lean=True)
    variety = texts.groupBy("anchor").agg(
        F.count("*").alias("different"), F.sum(F.col("first.windows") + sizes.least).alias("bytes")
    )
    variety = staged(variety.filter(F.col("different") > 1), "variety", lean=True)
    chosen = _stretches(texts.join(variety, "anchor", "left_anti")).unionByName(_singles(texts.join(variety, "anchor"), sizes))
    judged = staged(_within_shards(_texts(chosen, keyed, sizes), sizes, secret), "judged", lean=True)
    across = _across_shards(judged).groupBy("anchor", "content").agg(
        F.flatten(F.collect_list(F.array(F.col("place"), F.col("place") + 1))).alias("spans")
    )
    marks = judged.filter(F.size("spans") > 0).select("anchor", "content", "spans").unionAll(across)
    hit = found.select("anchor", "content", "key", "size", "start").join(marks, ["anchor", "content"])
    each = hit.groupBy("key", "size").agg(F.collect_set(F.struct("start", "spans")).alias("found"))
    placed = F.transform("found", lambda run: F.transform(run["spans"], lambda place: place + run["start"]))
    return each.select("key", "size", F.flatten(placed).alias("stretches"))


def covered(size: int, stretches: list[int] | None, least: int) -> np.ndarray:
    """Which bytes of a document lie in a repeated window."""
    edges = np.zeros(size + 1, np.int64)
    if stretches is not None and len(stretches):
        flat = np.asarray(stretches, np.int64)
        np.add.at(edges, flat[::2], 1)
        np.add.at(edges, flat[1::2] + least - 1, -1)
    return np.cumsum(edges[:-1]) > 0


def _with_stretches(docs: DataFrame, doc_id: str, text: str, sizes: Sizes, *more: str) -> DataFrame:
    secret = secrets.token_hex(16)
    found = repeated_windows(with_key(docs, doc_id, text, secret), sizes, secret)
    return with_key(docs, doc_id, text, secret, *more).join(found.hint("shuffle_hash"), ["key", "size"], "left")


def dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", sizes: Sizes = Sizes()) -> DataFrame:
    """Per document row: id, lengths, removed runs and the SHA-256 of what is left."""
    id_type = docs.schema[doc_id].dataType
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in rows_of(batches, "doc_id", "text", "stretches"):
            out = []
            for key, content, stretches in rows:
                raw = content.encode()
                gone = covered(len(raw), stretches, sizes.least)
                left = np.frombuffer(raw, np.uint8)[~gone].tobytes() if stretches else raw
                spans = len(spans_of(gone)) // 2 if stretches else 0
                out.append((key, len(raw), len(raw) - len(left), spans, hashlib.sha256(left).hexdigest()))
            kinds = [to_arrow_type(id_type), pa.int64(), pa.int64(), pa.int64(), pa.string()]
            arrays = [pa.array(column, kind) for column, kind in zip(zip(*out, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names)

    marked = _with_stretches(docs, doc_id, text, sizes).select("doc_id", "text", "stretches")
    schema = f"doc_id {id_type.simpleString()}, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return marked.mapInArrow(cut, schema)


def without_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", sizes: Sizes = Sizes()) -> DataFrame:
    """The same rows with repeated strings cut from their text; a character goes with any of its bytes. NULL stays."""

    @F.udf("string", useArrow=True)
    def cut(content, stretches):  # noqa: ANN001, ANN202
        if stretches is None or not len(stretches):
            return content
        raw = np.frombuffer(content.encode(), np.uint8)
        gone = covered(len(raw), stretches, sizes.least)
        character = np.cumsum((raw & 0xC0) != 0x80) - 1
        broken = np.zeros(character[-1] + 1, bool)
        broken[character[gone]] = True
        return raw[~broken[character]].tobytes().decode()

    rest = F.struct(*[F.col(c) for c in docs.columns if c != text]).alias("rest")
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), rest, F.isnull(text).alias("missing"))
    marked = _with_stretches(slim, "doc_id", "text", sizes, "rest", "missing")
    left = F.when(~F.col("missing"), cut("text", "stretches"))
    return marked.select([left.alias(c) if c == text else F.col("rest").getField(c).alias(c) for c in docs.columns])
