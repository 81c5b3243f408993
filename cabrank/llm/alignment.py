"""Where the tokens of two tokenizers meet in the bytes of a text, and which ids meet most often.

``a`` is a byte-level vocabulary and encodes a space and the text; ``b`` is a
SentencePiece model, which adds that space itself. Both cut the same bytes.

1. *Spans.* The libraries' own spans are coarse cuts: character offsets of ``a``,
   byte spans of ``b``. They are uncertain inside characters: several tokens of
   ``a`` then name the same characters, and byte pieces of ``b`` name nothing but
   the last one. Between certain cuts, decoded bytes of the tokens tell the ends.
2. *Groups and links.* Offsets where tokens of both end cut the tokens into
   groups; the two that end there are linked.
3. *Counts.* Tasks handle documents in chunks of bounded size, and store for each
   chunk its different pairs of ids with their number. Counts of pairs are summed
   over all chunks, and each chunk asks once for each of its pairs: a pair that is
   in every document is one row for each chunk.

A text whose joined token bytes of ``a`` or ``b`` are not the space and the text has
no tokens, nor has a NULL or empty one. Special strings inside a text are ordinary
text. Equal rows, rows of one id and NULL ids each keep their row and count in
full. Empty tables give no rows.

Both tokenizers start anew at a single space between two signs that are no white
space: the pattern of ``a`` takes a space only in front of what follows, and no
piece of ``b`` has a space behind another sign. So a text is cut, exactly, into
segments there. Segments that a task has met lately are kept; new ones are joined
by spaces and encoded many at a time. A text without such places, however long, is
one segment and encoded as a whole.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
import zstandard as zstd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from tokenizers import Tokenizer

from cabrank.llm.common import staged, text_blocks
from cabrank.llm.tokens import rows_of

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
MODEL = public_tokenizers.path("piece_bpe_32k.model")
CHUNK_BYTES = 4 << 20
LONG = 1 << 12  # characters that are encoded at a time; the libraries slow down on longer texts
SOME_BYTES = 1 << 19
KNOWN = 300_000  # segments that are kept
KNOWN_CHARACTERS = 64  # longer ones are not
BETWEEN = re.compile(r"(?<=\S) (?=\S)")


def byte_alphabet() -> dict[str, int]:
    """The characters by which byte-level vocabularies write bytes: visible ones as they are, the others from 256 on."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [x for x in range(256) if x not in visible]
    return {chr(x): x for x in visible} | {chr(256 + n): x for n, x in enumerate(hidden)}


@dataclass
class Side:
    """Tokens of one tokenizer in one text: ids, and the byte offsets where they end."""

    ids: np.ndarray
    ends: np.ndarray


@dataclass
class Alignment:
    a: Side
    b: Side

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """Places of the tokens of ``a`` and ``b`` that end together."""
        at = np.searchsorted(self.b.ends, self.a.ends)
        meets = np.flatnonzero(self.b.ends[at] == self.a.ends) if len(at) else at
        return meets, at[meets]


#: What is kept of a segment: tokens of both sides, its groups in writing, and its links as pairs of ids in 64 bits.
#: A plain tuple of plain values is nothing that the collector of garbage has to visit.
Segment = tuple[int, int, str, bytes]
NOTHING = Alignment(*(Side(np.empty(0, np.int64), np.empty(0, np.int64)) for _ in range(2)))


def refined(coarse: np.ndarray, certain: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Ends of tokens: coarse ones where certain, elsewhere the bytes decoded since the last certain one are added."""
    total = np.cumsum(sizes)
    last = np.maximum.accumulate(np.where(certain, np.arange(len(sizes)), -1))
    return np.where(last < 0, total, coarse[last] + total - total[last])


class Aligner:
    def __init__(self, vocabulary: str = VOCABULARY, model: str = MODEL) -> None:
        self.a = Tokenizer.from_file(vocabulary)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=model)
        alphabet = byte_alphabet()
        entries = sorted(self.a.get_vocab(with_added_tokens=True).items(), key=lambda entry: entry[1])
        own = {n: bytes(alphabet[x] for x in entry) for entry, n in entries if all(x in alphabet for x in entry)}
        self.a_bytes = [own.get(n, b"") for n in range(entries[-1][1] + 1)]
        pieces = [self.b.id_to_piece(n) for n in range(self.b.get_piece_size())]
        self.b_bytes = [
            bytes([int(piece[1:-1], 16)]) if self.b.is_byte(n) else piece.replace("▁", " ").encode() for n, piece in enumerate(pieces)
        ]
        self.a_sizes, self.b_sizes = (np.array([len(x) for x in table]) for table in (self.a_bytes, self.b_bytes))
        if any(re.search("[^▁]▁", piece) for piece in pieces):
            raise ValueError("pieces that go on behind a space: texts cannot be cut")
        self.known: dict[str, Segment | None] = {}  # met lately
        self.earlier: dict[str, Segment | None] = {}
        self.written = [f"{n}{end}" for n in range(len(self.a_bytes)) for end in ",|"]
        self.written += [f"{n}{end}" for n in range(len(self.b_bytes)) for end in ",;"]

    def _side_a(self, text: str, whole: bytes) -> Side | None:
        found = self.a.encode(text, add_special_tokens=False)
        ids = found.ids
        if b"".join(map(self.a_bytes.__getitem__, ids)) != whole:
            return None
        ids, spans = np.array(ids), np.fromiter(chain.from_iterable(found.offsets), np.int64, 2 * len(ids)).reshape(-1, 2)
        certain = np.append(spans[1:, 0] >= spans[:-1, 1], True)
        coarse = spans[:, 1]
        if len(whole) != len(text):
            characters = np.flatnonzero((np.frombuffer(whole, np.uint8) & 0xC0) != 0x80)
            coarse = np.append(characters, len(whole))[coarse]
        return Side(ids, self._checked(coarse, certain, self.a_sizes[ids]))

    def _side_b(self, text: str, whole: bytes) -> Side | None:
        found = [(p.id, p.begin, p.end) for p in self.b.encode(text, return_type="proto").pieces]
        if b"".join([self.b_bytes[p[0]] for p in found]) != whole:
            return None
        ids, begins, ends = np.fromiter(chain.from_iterable(found), np.int64, 3 * len(found)).reshape(-1, 3).T
        return Side(ids, self._checked(ends + 1, ends > begins, self.b_sizes[ids]))

    def _checked(self, coarse: np.ndarray, certain: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The ends of tokens whose bytes join to the text; where spans contradict the bytes, the bytes are right."""
        ends = refined(coarse, certain, sizes)
        return ends if np.array_equal(np.diff(ends, prepend=0), sizes) else np.cumsum(sizes)

    def align(self, text: str | None, long: int = LONG) -> Alignment:
        parts, size = [], 0
        for part in self._parts(text or "", long):
            whole = b" " + part.encode()
            a = self._side_a(" " + part, whole)
            b = self._side_b(part, whole) if a else None
            if b is None:
                return NOTHING
            parts.append((a.ids, a.ends + size, b.ids, b.ends + size))
            size += len(whole)
        if not parts:
            return NOTHING
        a_ids, a_ends, b_ids, b_ends = (np.concatenate(column) for column in zip(*parts, strict=True))
        return Alignment(Side(a_ids, a_ends), Side(b_ids, b_ends))

    @staticmethod
    def _parts(text: str, long: int) -> Iterator[str]:
        start = 0
        while len(text) - start > long:
            cut = BETWEEN.search(text, start + long)
            if cut is None:
                break
            yield text[start : cut.start()]
            start = cut.end()
        if start < len(text):
            yield text[start:]

    def segments(self, texts: list[str]) -> Iterator[list[Segment] | None]:
        """The segments of some texts; None for a text whose bytes are not those of its tokens."""
        if len(self.known) > KNOWN:
            self.known, self.earlier = {}, self.known
        known, earlier = self.known, self.earlier
        cuts = [BETWEEN.split(text) if text else [] for text in texts]
        held = [list(map(known.get, own)) for own in cuts]
        met = {part for own, kept in zip(cuts, held, strict=True) if None in kept for part, segment in zip(own, kept, strict=True) if segment is None}
        met.difference_update([part for part in met if part in known])  # kept as being without tokens
        found: dict[str, Segment | None] = {part: earlier[part] for part in met if part in earlier}
        new = [part for part in met if part not in found]
        found |= dict.fromkeys(new)
        inner = [part for part in new if not part[0].isspace() and not part[-1].isspace()]
        start = size = 0
        for n, part in enumerate(inner):
            size += len(part)
            if size > LONG:
                self._learn(inner[start : n + 1], found)
                start, size = n + 1, 0
        self._learn(inner[start:], found)
        for part in new:
            if part[0].isspace() or part[-1].isspace():
                self._learn([part], found)
        known |= {part: segment for part, segment in found.items() if len(part) <= KNOWN_CHARACTERS}
        for own, segments in zip(cuts, held, strict=True):
            if None in segments:  # new, or without tokens
                segments = [segment or found.get(part) for part, segment in zip(own, segments, strict=True)]
            yield None if None in segments else segments

    def _learn(self, parts: list[str], found: dict[str, Segment | None]) -> None:
        """Align some segments in one text, or each for itself if the text as a whole has no tokens."""
        if not parts:
            return
        both = self.align(" ".join(parts))
        if not len(both.a.ids):
            if len(parts) > 1:
                for part in parts:
                    self._learn([part], found)
            return
        at_a, at_b = both.links()
        pairs = ((both.a.ids[at_a] << 32) | both.b.ids[at_b]).tobytes()
        groups = self.groups(both).split(";")
        ends = np.cumsum([len(part.encode()) + 1 for part in parts])
        edges_a, edges_b, edges = (
            [0, *np.searchsorted(sorted_ends, ends, "right").tolist()] for sorted_ends in (both.a.ends, both.b.ends, both.a.ends[at_a])
        )
        for n, part in enumerate(parts):
            low, high = edges[n], edges[n + 1]
            n_a, n_b = edges_a[n + 1] - edges_a[n], edges_b[n + 1] - edges_b[n]
            found[part] = n_a, n_b, ";".join(groups[low:high]), pairs[8 * low : 8 * high]

    def groups(self, found: Alignment) -> str:
        """Ids of all groups: ``a1,a2|b1;a3|b2,b3``."""
        at_a, at_b = found.links()
        if not len(at_a):
            return ""
        a, b = found.a.ids, found.b.ids
        group_a = np.searchsorted(at_a, np.arange(len(a)))
        group_b = np.searchsorted(at_b, np.arange(len(b)))
        codes_a, codes_b = a * 2, b * 2 + 2 * len(self.a_bytes)
        codes_a[at_a] += 1
        codes_b[at_b] += 1
        order = np.empty(len(a) + len(b), np.int64)
        order[np.arange(len(a)) + np.append(0, at_b + 1)[group_a]] = codes_a
        order[np.arange(len(b)) + (at_a + 1)[group_b]] = codes_b
        return "".join(map(self.written.__getitem__, order.tolist()))[:-1]


@lru_cache(maxsize=2)
def aligner(vocabulary: str = VOCABULARY, model: str = MODEL) -> Aligner:
    return Aligner(vocabulary, model)


def aligned(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY, model: str = MODEL
) -> DataFrame:
    """Per document row: id, ids and byte ends of both tokenizers' tokens, and the places of the linked ones."""
    id_type = to_arrow_type(docs.schema[doc_id].dataType)
    names = ["a_ids", "a_ends", "b_ids", "b_ends", "a_links", "b_links"]

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = aligner(vocabulary, model)
        for rows, texts in text_blocks(batches, "text"):
            found = [both.align(raw.decode()) for raw in texts]
            lists = zip(*((x.a.ids, x.a.ends, x.b.ids, x.b.ends, *x.links()) for x in found), strict=True)
            columns = [rows.column("doc_id").cast(id_type), *(pa.array(column, pa.list_(pa.int32())) for column in lists)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", *names])

    named = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = docs.schema[doc_id].dataType.simpleString()
    return named.mapInArrow(align, ", ".join([f"doc_id {kind}", *(f"{name} array<int>" for name in names)]))


def _pack(values: np.ndarray, kind: str) -> bytes:
    return zstd.ZstdCompressor(level=1).compress(np.diff(values, prepend=0).astype(kind).tobytes())


def _unpack(content: bytes, kind: str) -> np.ndarray:
    return np.cumsum(np.frombuffer(zstd.ZstdDecompressor().decompress(content), kind), dtype=np.int64)


def _some(texts: list[bytes]) -> Iterator[list[str]]:
    """A few texts at a time, so that what is new in them stays small beside what is kept."""
    held, size = [], 0
    for raw in texts:
        held.append(raw.decode())
        size += len(raw)
        if size > SOME_BYTES:
            yield held
            held, size = [], 0
    yield held


def chunks(docs: DataFrame, doc_id: str, text: str, vocabulary: str, model: str, most: int = CHUNK_BYTES) -> DataFrame:
    """One row for each chunk of documents: their figures, the chunk's different pairs, and each link as the place of its pair. Staged."""
    id_type = docs.schema[doc_id].dataType
    kinds = {
        "chunk": pa.int64(),
        "doc_ids": pa.list_(to_arrow_type(id_type)),
        "n_a": pa.list_(pa.int64()),
        "n_b": pa.list_(pa.int64()),
        "n_links": pa.list_(pa.int64()),
        "groups": pa.list_(pa.string()),
        "pairs": pa.binary(),
        "times": pa.list_(pa.int32()),
        "links": pa.binary(),
    }

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, task = aligner(vocabulary, model), TaskContext.get().partitionId()
        for n, (rows, texts) in enumerate(text_blocks(batches, "text", most)):
            figures, keys = [], bytearray()
            for some in _some(texts):
                for own in both.segments(some):
                    n_a, n_b, written, pairs = zip(*own, strict=True) if own else ((), (), (), ())
                    groups, before = ";".join(written), len(keys)
                    keys += b"".join(pairs)
                    digest = hashlib.sha256(groups.encode()).hexdigest() if groups else ""
                    figures.append((sum(n_a), sum(n_b), (len(keys) - before) // 8, digest))
            pairs, places, times = np.unique(np.frombuffer(keys, np.int64), return_inverse=True, return_counts=True)
            row = [(task << 32) + n, rows.column("doc_id").to_pylist(), *map(list, zip(*figures, strict=True))]
            row += [_pack(pairs, "<i8"), times, _pack(places, "<i4")]
            arrays = [pa.array([value], kind) for value, kind in zip(row, kinds.values(), strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, list(kinds))

    named = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    schema = (
        f"chunk long, doc_ids array<{id_type.simpleString()}>, n_a array<long>, n_b array<long>, n_links array<long>,"
        " groups array<string>, pairs binary, times array<int>, links binary"
    )
    return staged(named.mapInArrow(work, schema), "chunks")


def _asked(found: DataFrame) -> DataFrame:
    """Each different pair of each chunk, with its place there and its number."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in rows_of(batches, "chunk", "pairs", "times", most=1):
            for chunk, packed, times in rows:
                pairs = _unpack(packed, "<i8")
                columns = [np.full(len(pairs), chunk), pairs >> 32, pairs & 0xFFFFFFFF, np.arange(len(pairs)), np.array(times)]
                kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64()]
                arrays = [pa.array(column, kind) for column, kind in zip(columns, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, ["chunk", "a", "b", "place", "n"])

    return found.select("chunk", "pairs", "times").mapInArrow(each, "chunk long, a int, b int, place int, n long")


def counted_pairs(asked: DataFrame) -> DataFrame:
    """Every linked pair of ids with its count, and whether no other id of ``a`` is linked to its id of ``b`` more often.

    An id of ``b`` has at most as many pairs as the vocabulary of ``a`` has entries.
    """
    counts = asked.groupBy("a", "b").agg(F.sum("n").alias("count"))
    most = F.max("count").over(Window.partitionBy("b"))
    return staged(counts.withColumn("best", F.col("count") == most), "pairs")


def alignment_figures(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    vocabulary: str = VOCABULARY,
    model: str = MODEL,
    most: int = CHUNK_BYTES,
) -> DataFrame:
    """Per document row: id, tokens of both, groups, links, links of the best count, sum of counts, SHA-256 of the groups."""
    found = chunks(docs, doc_id, text, vocabulary, model, most)
    asked = _asked(found)
    told = asked.drop("n").join(counted_pairs(asked), ["a", "b"])
    told = told.groupBy("chunk").agg(F.collect_list(F.struct("place", "count", "best")).alias("told"))
    told = told.select("chunk", "told.place", "told.count", "told.best")
    joined = found.drop("pairs", "times").join(told, "chunk", "left")
    id_type = docs.schema[doc_id].dataType
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    columns = ("doc_ids", "n_a", "n_b", "n_links", "groups", "links", "place", "count", "best")

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in rows_of(batches, *columns, most=1):
            for ids, n_a, n_b, n_links, groups, packed, place, count, best in rows:
                counts, bests = np.zeros((2, len(place or ())), np.int64)
                counts[place or ()], bests[place or ()] = count or (), best or ()
                links = _unpack(packed, "<i4")
                totals = [np.append(0, np.cumsum(values[links])) for values in (bests, counts)]
                edges = np.append(0, np.cumsum(n_links))
                both = [total[edges[1:]] - total[edges[:-1]] for total in totals]
                arrays = [
                    pa.array(ids, to_arrow_type(id_type)),
                    *(pa.array(column, pa.int64()) for column in (n_a, n_b, n_links, n_links, *both)),
                    pa.array(groups, pa.string()),
                ]
                yield pa.RecordBatch.from_arrays(arrays, names)

    schema = f"doc_id {id_type.simpleString()}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long"
    return joined.select(*columns).mapInArrow(sums, f"{schema}, groups_sha256 string")
