"""Vector best-fit packing of documents into sequences.

A document is its token ids and one end id. Longer ones than a sequence are cut
from the back, so that only their first piece may be shorter. Pieces are dealt
into groups of a bounded number of rows, and each group is packed on its own:
pieces in decreasing length, each into the open sequence with room in every
capacity (tokens, documents, attention cost, which is the sum of squared piece
lengths) that is left with the smallest weighted residual norm, or that has the
largest weighted dot product of demand and residual. A piece that is too dear
for the cost alone gets a sequence of its own.

A group ends with a few sequences that are not full; with 20,000 pieces a group
that is far below a thousandth of them. NULL text is an empty document of one
token. A very long text is tokenised whole and cut into as many pieces as it
needs. Rows with equal ids are packed as documents of their own; a NULL id stays
NULL. An empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from cabrank.llm.common import staged
from cabrank.llm.tokens import RANKS, rows_of, token_ids

END_ID = 0
GROUP_PIECES = 20_000


@dataclass(frozen=True)
class Capacity:
    """Limits of a sequence and the weights of each in the choice; cost is the sum of squared lengths.

    At the values that the contract fixes, only the tokens refuse a piece: a
    piece has a token at least, and a sum of squares is at most the square of the
    sum. The other two limits then act through their weights alone. They refuse
    pieces where a caller sets fewer documents than tokens, or a cost below the
    square of the tokens.
    """

    tokens: int = 2048
    documents: int = 2048
    cost: int = 2048 * 2048
    weights: tuple[float, float, float] = (1.0, 0.05, 0.05)
    choice: str = "norm"

    def __post_init__(self) -> None:
        if min(self.tokens, self.documents, self.cost) < 1 or self.choice not in ("norm", "dot"):
            raise ValueError("capacities must be positive and the choice norm or dot")


def pieces(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", tokens: int = 2048, path: str = RANKS) -> DataFrame:
    """The pieces of all documents: id, piece, start, length, CRC-32 of the ids."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in rows_of(batches, "doc_id", "text"):
            out: list[tuple] = []
            for key, content in rows:
                ids = np.append(token_ids(content, path), np.uint32(END_ID)).astype("<u4")
                edges = [0, *range(len(ids) % tokens or tokens, len(ids) + 1, tokens)] if len(ids) > tokens else [0, len(ids)]
                for n, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
                    out.append((key, n, a, b - a, zlib.crc32(ids[a:b].tobytes())))
            yield pa.RecordBatch.from_arrays(
                [pa.array(column, kind) for column, kind in zip(zip(*out, strict=True), kinds, strict=True)], names
            )

    named = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    id_type = named.schema["doc_id"].dataType
    kinds = [to_arrow_type(id_type), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
    schema = f"doc_id {id_type.simpleString()}, piece int, start long, length long, ids_crc32 long"
    return named.mapInArrow(cut, schema)


def fit(lengths: np.ndarray, room: Capacity) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of each piece of one group, in the given order of pieces."""
    order = np.argsort(-lengths, kind="stable")
    limits = np.array([room.tokens, room.documents, room.cost], float)
    weights = np.array(room.weights)[:, None]
    smallest = lengths.min(initial=room.tokens)
    left = np.empty((3, len(lengths)))
    number = np.empty(len(lengths), np.int64)
    bins = np.empty(len(lengths), np.int64)
    offsets = np.empty(len(lengths), np.int64)
    opened = live = 0
    for item in order:
        n = float(lengths[item])
        need = np.array([n, 1.0, n * n])[:, None]
        after = left[:, :live] - need
        fits = np.flatnonzero((after >= 0).all(axis=0))
        if len(fits):
            if room.choice == "norm":
                score = (weights * (after[:, fits] / limits[:, None]) ** 2).sum(axis=0)
            else:
                score = -(weights * (need / limits[:, None]) * (left[:, fits] / limits[:, None])).sum(axis=0)
            at = fits[score.argmin()]
        else:
            at = live
            left[:, at], number[at] = limits, opened
            live, opened = live + 1, opened + 1
        bins[item], offsets[item] = number[at], room.tokens - left[0, at]
        left[:, at] -= need[:, 0]
        if left[0, at] < smallest or left[1, at] < 1 or left[2, at] < smallest * smallest:
            live -= 1
            left[:, at], number[at] = left[:, live], number[live]
    return bins, offsets


def pack_group(room: Capacity) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def pack(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["length", "ids_crc32", "doc_id", "piece", "row"], kind="stable").reset_index(drop=True)
        bins, offsets = fit(group["length"].to_numpy(), room)
        sequence = (group["part"].to_numpy(np.int64) << 32) + bins
        return group.drop(columns=["part", "row"]).assign(sequence_id=sequence, offset=offsets)

    return pack


def pack(cut: DataFrame, room: Capacity = Capacity(), group_pieces: int = GROUP_PIECES) -> DataFrame:
    """Pieces with their sequence and their place in it.

    ``cut`` must give the same rows whenever it is read, as a staged table does:
    a row's group comes from its place in the table, so copies of one document
    spread over the groups.
    """
    groups = -(-cut.count() // group_pieces)
    row = F.monotonically_increasing_id()
    dealt = cut.withColumn("row", row).withColumn("part", F.pmod(F.xxhash64("row"), F.lit(max(1, groups))))
    id_type = cut.schema["doc_id"].dataType.simpleString()
    schema = (
        f"doc_id {id_type}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    )
    return dealt.groupBy("part").applyInPandas(pack_group(room), schema)


def pack_documents(docs: DataFrame, room: Capacity = Capacity(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Tokenise once, stage the pieces (a few numbers each), and pack them."""
    return pack(staged(pieces(docs, doc_id, text, room.tokens), "pieces"), room)
