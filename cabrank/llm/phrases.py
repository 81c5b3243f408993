"""A positional inverted index of a corpus, and the benchmark passages found in it.

The index is split by documents: a shard holds the postings of some megabytes of
text as one row of a staged table, so neither a frequent word nor a frequent
passage gathers rows anywhere, and every shard is searched on its own. Within a
shard each term has one sorted list of positions; documents follow each other
with an unused position in between, so no phrase crosses them.

A phrase is found by intersecting the lists of its terms, each shifted by the
term's offset in the phrase, from the rarest term on. The benchmark is stored in
files of bounded size; each shard is opened once, and the files are taken through
it one after the other, so neither the driver nor a task holds the whole of it.

Words are runs of a-z (A-Z lower-cased), 0-9 and anything beyond ASCII. NULL
texts have no words. A document row is known by its place in the index, so equal
or NULL ids stay apart. Benchmark rows of one id are one item; rows without an id
are one item named by the empty string. Empty tables are allowed on either side.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, count

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import zstandard as zstd
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from cabrank.llm.common import staged, text_blocks
from cabrank.llm.storage import open_folder
from cabrank.llm.tokens import rows_of
from cabrank.operators.lookup import fits_broadcast
from cabrank.sinks.reports import shared_folder, stage_table

WINDOW = 10
SHARD_BYTES = 4 << 20
ITEM_BYTES = 8 << 20
#: ASCII bytes that are no part of a word, after lower-casing.
BREAKS = bytes(x if 0x30 <= x <= 0x39 or 0x61 <= x <= 0x7A or x >= 0x80 else 0x20 for x in range(256))

Item = tuple[str, list[bytes]]


def words_of(text: bytes) -> list[bytes]:
    return text.lower().translate(BREAKS).split()


def _pack(values: np.ndarray) -> bytes:
    """Differences of whole numbers, compressed."""
    return zstd.ZstdCompressor(level=1).compress(np.diff(values, prepend=0).astype("<i4").tobytes())


def _unpack(content: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(zstd.ZstdDecompressor().decompress(content), "<i4"), dtype=np.int64)


class Shard:
    """The postings of one shard: ``lists[starts[t]:starts[t + 1]]`` are the positions of term ``t``."""

    def __init__(self, terms: list[bytes], starts: np.ndarray, lists: np.ndarray, firsts: np.ndarray) -> None:
        self.numbers = {term: n for n, term in enumerate(terms)}
        self.starts, self.lists, self.firsts = starts, lists, firsts

    def postings(self, term: int) -> np.ndarray:
        return self.lists[self.starts[term] : self.starts[term + 1]]

    def sizes(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Term numbers (-1: absent) and list lengths of some words."""
        numbers = np.array([self.numbers.get(word, -1) for word in words], np.int64)
        return numbers, np.where(numbers >= 0, self.starts[numbers + 1] - self.starts[numbers], 0)

    def documents(self, positions: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.firsts, positions, "right") - 1


def build_index(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Postings of every word of every document, one row for each shard, staged."""
    named = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    id_type = named.schema["doc_id"].dataType
    ids_type = pa.list_(to_arrow_type(id_type))

    def invert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        for n, (rows, texts) in enumerate(text_blocks(batches, "text", shard_bytes)):
            numbers: defaultdict[bytes, int] = defaultdict(count().__next__)
            counts, found = np.empty(len(texts), np.int64), []
            for i, content in enumerate(texts):
                terms = list(map(numbers.__getitem__, words_of(content)))
                counts[i] = len(terms)
                found.append(np.array(terms, np.uint64))
            firsts = np.cumsum(counts + 1) - counts - 1
            at = [np.arange(a, a + c, dtype=np.uint64) for a, c in zip(firsts, counts, strict=True)]
            entries = np.sort((np.concatenate(found) << np.uint64(32)) | np.concatenate(at))
            terms = (entries >> np.uint64(32)).astype(np.int64)
            starts = np.searchsorted(terms, np.arange(len(numbers) + 1))
            lists = (entries & np.uint64(0xFFFFFFFF)).astype(np.int64)
            row = [
                pa.array([(task << 32) + n], pa.int64()),
                pa.array([rows.column("doc_id").to_pylist()], ids_type),
                pa.array([b" ".join(numbers)], pa.binary()),
                *(pa.array([_pack(x)], pa.binary()) for x in (starts, lists, firsts, counts)),
            ]
            yield pa.RecordBatch.from_arrays(row, ["shard", "doc_ids", "terms", "starts", "lists", "firsts", "counts"])

    schema = (
        f"shard long, doc_ids array<{id_type.simpleString()}>, terms binary, starts binary, lists binary,"
        " firsts binary, counts binary"
    )
    return staged(named.mapInArrow(invert, schema), "index")


def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list, np.ndarray, Shard]]:
    """Shard number, document ids, word counts and postings of each row of the index."""
    names = ("shard", "doc_ids", "terms", "starts", "lists", "firsts", "counts")
    for rows in rows_of(batches, *names, most=1):
        for shard, ids, terms, *packed in rows:
            starts, lists, firsts, counts = map(_unpack, packed)
            yield shard, ids, counts, Shard(terms.split(), starts, lists, firsts)


def phrase_hits(shard: Shard, words: list[bytes], window: int = WINDOW) -> np.ndarray:
    """Sorted positions covered by an occurrence of any window of the phrase.

    Windows that share their rarest term start from one list. A candidate is a
    place where the phrase would begin; it stays while the lists of the terms
    next to the rarest one, shifted by their offsets, contain it too.
    """
    numbers, sizes = shard.sizes(words)
    width = min(window, len(words))
    if not width:
        return np.empty(0, np.int64)
    spans = np.lib.stride_tricks.sliding_window_view(sizes, width)
    whole = np.flatnonzero(spans.min(axis=1) > 0)
    rarest = whole + spans[whole].argmin(axis=1) if len(whole) else whole
    covered = []
    for lead in np.unique(rarest):
        windows = whole[rarest == lead]
        low, high = windows.min(), windows.max() + width
        begins = shard.postings(numbers[lead]) - lead
        near = [i for i in (lead - 1, lead + 1) if low <= i < high]
        if near:
            begins = begins[np.logical_or.reduce([_contains(shard.postings(numbers[i]), begins + i) for i in near])]
        if not len(begins):
            continue
        same = np.array([
            _contains(shard.postings(numbers[i]), begins + i) if numbers[i] >= 0 else np.zeros(len(begins), bool)
            for i in range(low, high)
        ])
        for first in windows:
            hits = begins[same[first - low : first - low + width].all(axis=0)] + first
            covered.append((hits[:, None] + np.arange(width)).ravel())
    return np.unique(np.concatenate(covered)) if covered else np.empty(0, np.int64)


def _contains(postings: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    at = np.searchsorted(postings, wanted)
    at[at == len(postings)] = 0
    return postings[at] == wanted


def near_hits(shard: Shard, words: list[bytes], within: int) -> np.ndarray:
    """Positions of the rarest of the words that have every other word at most so many positions away, in one document."""
    numbers, sizes = shard.sizes(words)
    if not len(words) or not sizes.all():
        return np.empty(0, np.int64)
    order = np.argsort(sizes, kind="stable")
    hits = shard.postings(numbers[order[0]])
    for term in numbers[order[1:]]:
        postings = shard.postings(term)
        first = shard.firsts[shard.documents(hits)]
        last = np.append(shard.firsts, np.iinfo(np.int64).max)[shard.documents(hits) + 1] - 1
        low, high = np.maximum(hits - within, first), np.minimum(hits + within, last)
        hits = hits[np.searchsorted(postings, low) < np.searchsorted(postings, high, "right")]
    return hits


def store_items(benchmark: DataFrame, item_id: str = "item_id", text: str = "text", most: int = ITEM_BYTES) -> str:
    """Write the items under the shared folder in files of about ``most`` bytes of text; the folder.

    The table is measured first; there are as many files as its size asks for.
    Equal items count once, so copies of one cannot fill a file.
    """
    named = benchmark.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item"), F.col(text).alias("text"))
    named = staged(named.distinct(), "distinct")
    size = named.agg(F.sum(F.octet_length("item") + F.coalesce(F.octet_length("text"), F.lit(0)))).first()[0] or 0
    folder = shared_folder(benchmark.sparkSession, "items")
    stage_table(named.repartition(size // most + 1, "item", "text"), folder)
    return folder


def item_blocks(folder: str) -> Iterator[list[Item]]:
    """The stored items, the words of one file at a time."""
    system, path = open_folder(folder)
    for file in sorted(file.path for file in system.get_file_info(fs.FileSelector(path))):
        if file.endswith(".parquet"):
            yield _block(folder, file)


@lru_cache(maxsize=1)
def _block(folder: str, file: str) -> list[Item]:
    """Kept until the next file, so that items of a single file are read once by a worker."""
    rows = pq.read_table(file, filesystem=open_folder(folder)[0]).to_pylist()
    return [(row["item"], words_of((row["text"] or "").encode())) for row in rows]


def search(index: DataFrame, items: str, window: int = WINDOW) -> DataFrame:
    """Of every document of the index: words, covered words (as numbers within the document) and items found.

    A task opens a shard once and takes the stored items through it, a file at a time.
    """
    id_type = index.schema["doc_ids"].dataType.elementType

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, ids, counts, shard in opened(batches):
            hits: list[list[np.ndarray]] = [[] for _ in ids]
            found: list[set[str]] = [set() for _ in ids]
            for item, words in chain.from_iterable(item_blocks(items)):
                covered = phrase_hits(shard, words, window)
                if len(covered):
                    documents = shard.documents(covered)
                    for doc in np.unique(documents):
                        hits[doc].append(covered[documents == doc] - shard.firsts[doc])
                        found[doc].add(item)
            columns = [
                pa.array([number] * len(ids), pa.int64()),
                pa.array(range(len(ids)), pa.int32()),
                pa.array(ids, to_arrow_type(id_type)),
                pa.array(counts, pa.int64()),
                pa.array([np.unique(np.concatenate(x)) if x else [] for x in hits], pa.list_(pa.int32())),
                pa.array([sorted(x) for x in found], pa.list_(pa.string())),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["shard", "place", "doc_id", "n_words", "hits", "items"])

    schema = f"shard long, place int, doc_id {id_type.simpleString()}, n_words long, hits array<int>, items array<string>"
    return index.mapInArrow(look, schema)


def near(index: DataFrame, items: str, within: int) -> DataFrame:
    """Proximity matches of stored items: document, item and word number of its rarest word, all its words lying that close."""
    id_type = index.schema["doc_ids"].dataType.elementType

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, ids, _, shard in opened(batches):
            for item, words in chain.from_iterable(item_blocks(items)):
                hits = near_hits(shard, words, within)
                documents = shard.documents(hits)
                columns = [
                    pa.array([ids[d] for d in documents], to_arrow_type(id_type)),
                    pa.array([item] * len(hits), pa.string()),
                    pa.array(hits - shard.firsts[documents], pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "item_id", "position"])

    return index.mapInArrow(look, f"doc_id {id_type.simpleString()}, item_id string, position long")


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    window: int = WINDOW,
    item_bytes: int = ITEM_BYTES,
) -> DataFrame:
    """Per document row: id, words, words hit, items found and whether anything was hit."""
    index = build_index(docs, doc_id, text)
    found = search(index, store_items(benchmark, item_id, "text", item_bytes), window)
    return found.select(
        "doc_id",
        "n_words",
        F.size("hits").cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
    )


def uncontaminated(
    docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW
) -> DataFrame:
    """The rows without any benchmark passage, with the columns they came with.

    The rows to leave out are known by a hash of id and text and the text's
    length; they are sent to all tasks if they are few, which is measured.
    """
    key = F.struct(F.xxhash64(doc_id, text).alias("hash"), F.octet_length(text).alias("size"))
    named = docs.select(key.alias("key"), F.col(text).alias("text"))
    found = contamination(named, benchmark, "key", "text", window=window).filter("contaminated")
    bad = staged(found.select("doc_id.hash", "doc_id.size").distinct(), "contaminated")
    left_out = F.broadcast(bad) if fits_broadcast(bad) else bad
    packed = docs.select(F.struct(*docs.columns).alias("row"), key.alias("key")).select("row", "key.*")
    return packed.join(left_out, ["hash", "size"], "left_anti").select("row.*")
