"""Exact encoding by merge-type SentencePiece models, by backtracking, and decoding.

A merge-type model joins the two neighbouring parts whose union is the best
scored piece (the leftmost of equals) until none is left. The result for a text
is the only sequence of pieces in which every two neighbours are *compatible*:
joined and merged anew on their own, they come apart at the same place. So no
merge has to be run over the text:

1. An Aho-Corasick automaton of the reversed pieces, run over the reversed text,
   tells the longest piece that starts at each place.
2. From the left, the longest piece that is compatible with the one before is
   taken, else its next shorter prefix that is a piece, and so on.
3. If none fits, the place is marked in a bitfield as failed, the piece before is
   taken back, and its next shorter prefix is tried. A place fails once at most.

Characters that no piece holds stand for themselves and become their bytes. If no
piece has white space behind another character, no merge crosses such a place, and
the text is encoded in chunks that start there, of which frequent ones are kept.

The normaliser and ``decode`` are the library's own. Models of another type, with
symbols of their own, unused pieces, or without byte pieces are refused.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator, Sequence
from functools import lru_cache

import ahocorasick
import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from sentencepiece import sentencepiece_model_pb2 as models

from cabrank.llm.common import text_blocks

MODEL = public_tokenizers.path("piece_bpe_32k.model")
SPACE = "▁"
CHUNK = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")
CHUNKS, PAIRS = 400_000, 1_000_000  # entries of the memories
CHUNK_CHARACTERS = 64  # longer ones are not kept
NEVER = float("-inf")
NONE = -1
OTHER = "\0\0"  # for a character of no piece; in no piece itself


class Pieces:
    """A model's pieces, and the encoding of any text by them."""

    def __init__(self, path: str = MODEL) -> None:
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        model = models.ModelProto.FromString(self.library.serialized_model_proto())
        kinds = models.ModelProto.SentencePiece
        if model.trainer_spec.model_type != models.TrainerSpec.BPE or not model.trainer_spec.byte_fallback:
            raise ValueError("not a merge-type model with byte pieces")
        if any(p.type in (kinds.USER_DEFINED, kinds.UNUSED) for p in model.pieces):
            raise ValueError("the model has symbols of its own or unused pieces")
        normal = [(n, p) for n, p in enumerate(model.pieces) if p.type == kinds.NORMAL]
        self.scores = {p.piece: p.score for _, p in normal}
        self.bytes = [self.library.piece_to_id(f"<0x{x:02X}>") for x in range(256)]
        self.in_chunks = not any(re.search(f"[^{SPACE}]{SPACE}", piece) for piece in self.scores)
        # Parts are numbered: pieces by their ids, then characters that occur in pieces only, then any other character.
        inner = sorted({x for piece in self.scores for x in piece} - set(self.scores))
        self.pieces = len(model.pieces)
        self.other = self.pieces + len(inner)
        self.bits = self.other.bit_length()
        self.histories = [[(NEVER, OTHER, OTHER)]] * (self.other + 1)
        self.sizes = [1] * (self.other + 1)
        self.shorter = [NONE] * (self.other + 1)
        self.longest = ahocorasick.Automaton()
        numbers: dict[str, int] = {}
        for number, part in [*enumerate(inner, self.pieces), *((n, p.piece) for n, p in normal)]:
            history = self.merging(part)
            if history[-1][1] == part:
                numbers[part] = number
                self.histories[number] = history
                self.sizes[number] = len(part)
                self.longest.add_word(part[::-1], number)
        for part, number in numbers.items():
            prefixes = (part[:n] for n in range(len(part) - 1, 0, -1))
            self.shorter[number] = next((numbers[p] for p in prefixes if p in numbers), NONE)
        self.longest.make_automaton()
        self.chunks: dict[str, bytes] = {}  # met lately, their ids as 32-bit numbers
        self.earlier: dict[str, bytes] = {}
        self.pairs: dict[int, bool] = {}

    def merging(self, text: str) -> list[tuple[float, str, str]]:
        """How a short text is merged: before each merge its score, and the first and last part; what is left in the end."""
        parts, score, steps = list(text), self.scores.get, []
        ranks = [score(a + b, NEVER) for a, b in zip(parts, parts[1:], strict=False)]
        while ranks and max(ranks) > NEVER:
            at = ranks.index(max(ranks))
            steps.append((ranks[at], parts[0], parts[-1]))
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del ranks[at]
            if at < len(ranks):
                ranks[at] = score(parts[at] + parts[at + 1], NEVER)
            if at:
                ranks[at - 1] = score(parts[at - 1] + parts[at], NEVER)
        return [*steps, (NEVER, parts[0], parts[-1])]

    def compatible(self, a: int, b: int) -> bool:
        """Whether two parts stay apart when their join is merged anew.

        Until a merge crosses their border, each is merged as on its own, so the
        two histories are run side by side, the better merge (the left one of
        equals) first, and the parts at the border are tried at every step.
        """
        if len(self.pairs) >= PAIRS:
            self.pairs.clear()
        apart = self.pairs[a << self.bits | b] = self._stay_apart(self.histories[a], self.histories[b])
        return apart

    def _stay_apart(self, left: list[tuple[float, str, str]], right: list[tuple[float, str, str]]) -> bool:
        i = j = 0
        while True:
            before, _, a = left[i]
            after, b, _ = right[j]
            across = self.scores.get(a + b, NEVER)
            if across > before and across >= after:
                return False
            if before == after == NEVER:
                return True
            if before >= after:
                i += 1
            else:
                j += 1

    def parts(self, text: str) -> list[int]:
        """The parts of a normalised text, by backtracking."""
        n, last = len(text), NONE
        longest = array("i", [self.other]) * n
        for end, number in self.longest.iter(text[::-1]):
            if end != last:  # the longest of an end comes first
                longest[n - 1 - end] = number
                last = end
        sizes, shorter, known, bits = self.sizes, self.shorter, self.pairs.get, self.bits
        failed = bytearray(n // 8 + 1)
        found: list[int] = []
        at, before = 0, NONE
        while at < n:
            part = longest[at]
            while True:
                end = at + sizes[part]
                if not failed[end >> 3] >> (end & 7) & 1:
                    fits = before < 0 or known(before << bits | part)
                    if fits is None:
                        fits = self.compatible(before, part)
                    if fits:
                        found.append(part)
                        at, before = end, part
                        break
                part = shorter[part]
                while part < 0:
                    failed[at >> 3] |= 1 << (at & 7)
                    back = found.pop()
                    at -= sizes[back]
                    before, part = found[-1] if found else NONE, shorter[back]
        return found

    def numbers_of(self, text: str) -> Sequence[int]:
        """Ids of a normalised text."""
        found = self.parts(text)
        if max(found, default=0) < self.pieces:
            return tuple(found)
        out: list[int] = []
        at = 0
        for part in found:
            end = at + self.sizes[part]
            out.extend([part] if part < self.pieces else [self.bytes[x] for x in text[at:end].encode()])
            at = end
        return tuple(out)

    def encode(self, text: str | None) -> list[int]:
        """Ids of a whole text; NULL is empty."""
        return self.ids_of(text).tolist()

    def ids_of(self, text: str | None) -> np.ndarray:
        whole = self.library.normalize(text) if text else ""
        if not self.in_chunks:
            return np.array(self.numbers_of(whole), np.int32)
        chunks = CHUNK.findall(whole)
        found = list(map(self.chunks.get, chunks))
        if None in found:
            found = [known or self._met(chunk) for chunk, known in zip(chunks, found, strict=True)]
        return np.frombuffer(b"".join(found), np.int32)

    def _met(self, chunk: str) -> bytes:
        """The ids of a chunk that was not among those met lately."""
        known = self.chunks.get(chunk) or self.earlier.get(chunk)
        if known is None:
            known = array("i", self.numbers_of(chunk)).tobytes()
        if len(chunk) <= CHUNK_CHARACTERS:
            if len(self.chunks) >= CHUNKS:
                self.chunks, self.earlier = {}, self.chunks
            self.chunks[chunk] = known
        return known

    def decode(self, ids: list[int]) -> str:
        return self.library.decode(ids)


@lru_cache(maxsize=2)
def pieces(path: str = MODEL) -> Pieces:
    return Pieces(path)


def encoded(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str = MODEL) -> DataFrame:
    """Per document row: id, the ids of the whole text, and the text that they decode to.

    Special strings inside a text are ordinary text. NULL and empty texts have no
    ids and decode to the empty text. A very long text is handled whole, its
    chunks one after the other; a chunk without white space, however long, takes
    four bytes and a bit for each character. Rows of one id, equal rows and NULL
    ids each keep their row. An empty table gives no rows.
    """
    id_type = to_arrow_type(docs.schema[doc_id].dataType)
    names = ["doc_id", "ids", "decoded"]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(path)
        for rows, texts in text_blocks(batches, "text"):
            ids = [model.ids_of(raw.decode()) for raw in texts]
            ends = np.cumsum([0, *map(len, ids)], dtype=np.int32)
            columns = [
                rows.column("doc_id").cast(id_type),
                pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids))),
                pa.array([model.decode(x.tolist()) for x in ids], pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names)

    named = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = docs.schema[doc_id].dataType.simpleString()
    return named.mapInArrow(encode, f"doc_id {kind}, ids array<int>, decoded string")


def encoding_digests(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str = MODEL) -> DataFrame:
    """Per document row: id, number of ids, and the SHA-256 of the ids, comma-joined, and of the decoded text."""
    return encoded(docs, doc_id, text, path).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
