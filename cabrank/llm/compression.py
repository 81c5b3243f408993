"""Quality by compression: how much better good text's dictionary compresses a document than bad text's.

Two zstandard dictionaries are built from whole labelled texts, one of each
kind. Two size differences tell a document's quality: (bytes with the bad
dictionary - bytes with the good one) / bytes without any, and (plain bytes -
bytes with the good one) / plain bytes, which is near 1 for text that repeats
itself. A logistic curve over the two, the logarithm of the length, their squares,
and the two times the logarithm, as a dictionary saves a smaller part of a longer
text, turns them into a score from 0 to 1. It is fitted on labelled texts that the
dictionaries have not seen, where both kinds weigh the same, and moved by the odds
of all labels, so that of texts with a score of 0.8 about 80 in 100 are good.

Training reads a bounded number of texts of any length: of each kind, the
``PER_KIND`` labelled documents with the smallest keyed hash of their id, half for
the dictionaries and half for the curve. Of several rows with one id the smallest
text is taken. The curve's texts are compressed whole where they lie. The
dictionaries' texts are cut into pieces, all of which reach the driver where they
have at most ``MOST_BYTES / 2`` a kind; else each text gives at most so many, from
hashed places over its whole length, that they do. Scoring reads every text whole.
NULL counts as empty; an empty text has differences 0. With fewer than two
documents of a kind to train on, every score is the share of good ones among them
(1 without any); documents of a kind that are all held out are an error.
"""

from __future__ import annotations

import heapq
import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import zstandard as zstd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cabrank.llm.common import give_back, staged

PER_KIND = 1000
MOST_BYTES = 16 << 20
PIECE_BYTES = 2048
DICTIONARY_BYTES = 110 << 10
LEVEL = 3
THRESHOLD = 0.3
STEPS = 60
VALUES = 8


@dataclass(frozen=True)
class Model:
    good: bytes
    bad: bytes
    weights: np.ndarray
    offset: float


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows kept from training: CRC-32 of the id as text is a multiple of 5."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def marked(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """Labels that may be learnt from, of documents that are there: id, quality and place in hash order. Staged."""
    marks = labels.filter(F.col("quality").isin(0, 1) & ~held_out("doc_id")).groupBy("doc_id").agg(
        F.min("quality").alias("quality")
    )
    there = marks.join(docs.select(F.col(doc_id).alias("doc_id")), "doc_id", "left_semi")
    return staged(there.withColumn("order", F.xxhash64(F.lit("quality"), "doc_id")), "marks")


def labelled(docs: DataFrame, marks: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Training rows (quality, place, text): the sampled documents, numbered in hash order within their kind."""
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    drawn = []
    for q in (0, 1):
        ids = marks.filter(F.col("quality") == q).orderBy("order", "doc_id").limit(PER_KIND).select("doc_id").collect()
        drawn += [(row.doc_id, q, place) for place, row in enumerate(ids)]
    kind = texts.schema["doc_id"].dataType.simpleString()
    places = docs.sparkSession.createDataFrame(drawn, f"doc_id {kind}, quality int, place int")
    rows = texts.join(F.broadcast(places), "doc_id")
    return rows.groupBy("quality", "place").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"))


def differences(texts: list[bytes], good: bytes, bad: bytes) -> np.ndarray:
    """The normalised differences of compressed sizes of each text and its length's logarithm, their squares and products."""
    plain, with_good, with_bad = _compressors(good, bad)
    out = np.zeros((len(texts), VALUES))
    for i, text in enumerate(texts):
        if text:
            alone, as_good, as_bad = (len(c.compress(text)) for c in (plain, with_good, with_bad))
            kind, saved = (as_bad - as_good) / alone, (len(text) - as_good) / len(text)
            size = math.log(len(text))
            out[i] = kind, saved, kind * kind, saved * saved, size, kind * size, saved * size, size * size
    return out


@lru_cache(maxsize=2)
def _compressors(good: bytes, bad: bytes) -> list[zstd.ZstdCompressor]:
    made = [zstd.ZstdCompressor(level=LEVEL, write_content_size=False, write_checksum=False)]
    for content in (good, bad):
        dictionary = zstd.ZstdCompressionDict(content)
        dictionary.precompute_compress(level=LEVEL)
        made.append(zstd.ZstdCompressor(dict_data=dictionary, write_content_size=False, write_dict_id=False))
    return made


def pieces(raw: bytes, most: int, key: int) -> list[bytes]:
    """All pieces of a text, or so many from hashed places over its whole length, in their order."""
    starts = range(0, len(raw), PIECE_BYTES)
    if len(starts) > most:
        starts = sorted(heapq.nsmallest(most, starts, key=lambda at: zlib.crc32(b"%d %d" % (key, at))))
    return [raw[at : at + PIECE_BYTES] for at in starts]


def allowance(sizes: list[int], most: int) -> int:
    """The largest number of pieces that each text may give, so that all together give at most so many."""
    counts = sorted(-(-size // PIECE_BYTES) for size in sizes)
    for i, n in enumerate(counts):
        if n * (len(counts) - i) > most:
            return max(1, most // (len(counts) - i))
        most -= n
    return max(1, *counts)


def dictionary(parts: list[bytes]) -> bytes:
    """A dictionary trained on pieces of texts; their own bytes where there are too few to train on."""
    try:
        return zstd.train_dictionary(DICTIONARY_BYTES, parts).as_bytes()
    except zstd.ZstdError:
        return b"".join(parts)[:DICTIONARY_BYTES].ljust(8, b"\n")


def logistic(values: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights and offset of a logistic curve by Newton's method, kinds weighing the same, with a small penalty."""
    middle, spread = values.mean(axis=0), values.std(axis=0)
    spread[spread == 0] = 1.0
    x = np.column_stack([(values - middle) / spread, np.ones(len(values))])
    balance = np.where(labels == 1, 0.5 / (labels == 1).mean(), 0.5 / (labels == 0).mean())
    penalty = np.diag([0.1] * values.shape[1] + [1e-6])
    w = np.zeros(x.shape[1])
    for _ in range(STEPS):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (balance * (labels - p)) - penalty @ w
        step = np.linalg.solve((x * (balance * p * (1 - p))[:, None]).T @ x + penalty, gradient)
        w += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    weights = w[:-1] / spread
    return weights, float(w[-1] - weights @ middle)


def taken(sample: DataFrame, quality: int, sizes: list[int]) -> list[bytes]:
    """The pieces that build a kind's dictionary: those of its texts at even places, ``MOST_BYTES / 2`` at most."""
    most = allowance(sizes, MOST_BYTES // (2 * PIECE_BYTES))

    @F.pandas_udf("array<binary>")
    def cut(texts: pd.Series, places: pd.Series) -> pd.Series:
        return pd.Series([pieces(x.encode(), most, place) for x, place in zip(texts, places, strict=True)], dtype=object)

    rows = sample.filter((F.col("quality") == quality) & (F.col("place") % 2 == 0)).select("place", cut("text", "place").alias("parts"))
    return [bytes(part) for row in sorted(rows.collect(), key=lambda row: row.place) for part in row.parts]


def measured(sample: DataFrame, good: bytes, bad: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The differences and kinds of the texts at odd places, each compressed whole by the tasks."""

    @F.pandas_udf("array<double>")
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(list(differences([x.encode() for x in texts], good, bad)), dtype=object)

    rows = sample.filter(F.col("place") % 2 == 1).select("quality", "place", found("text").alias("values")).collect()
    rows = sorted(rows, key=lambda row: (row.quality, row.place))
    return np.array([row["values"] for row in rows]), np.array([row.quality for row in rows])


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> Model:
    """Train from the staged sample; the driver gets the dictionaries' pieces and a few numbers for each text of the curve.

    The curve is fitted on as many good texts as bad ones, and its odds are then
    multiplied by those of all labels, so that a score is a share of good texts.
    """
    marks = marked(docs, labels, doc_id)
    sample = staged(labelled(docs, marks, doc_id, text), "labelled")
    rows = sample.select("quality", "place", F.octet_length("text").alias("size")).collect()
    kinds = [row.quality for row in rows]
    if len(set(kinds)) == 1:
        other = labels.filter(F.col("quality") == 1 - kinds[0]).select("doc_id")
        if not docs.select(F.col(doc_id).alias("doc_id")).join(other, "doc_id", "left_semi").isEmpty():
            raise ValueError(f"no document labelled {1 - kinds[0]} is left to train on, as all are held out or labelled both ways")
    if min(kinds.count(0), kinds.count(1)) < 2:
        share = min(max(sum(kinds) / len(kinds) if kinds else 1.0, 1e-6), 1 - 1e-6)
        return Model(b"", b"", np.zeros(VALUES), math.log(share / (1 - share)))
    good, bad = (
        dictionary(taken(sample, q, [row.size for row in rows if row.quality == q and row.place % 2 == 0])) for q in (1, 0)
    )
    weights, offset = logistic(*measured(sample, good, bad))
    counts = {row.quality: row["count"] for row in marks.groupBy("quality").count().collect()}
    return Model(good, bad, weights, offset + math.log(counts[1] / counts[0]))


def score(model: Model, text: str = "text") -> Column:
    """The score of each whole text."""

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            raw = [x.encode() if x else b"" for x in texts]
            found = differences(raw, model.good, model.bad) if model.good else np.zeros((len(raw), VALUES))
            del texts, raw
            yield pd.Series(1 / (1 + np.exp(-np.clip(found @ model.weights + model.offset, -30, 30))))
            give_back()

    return scored(F.col(text))


def classify(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: id, whether it was kept from training, score and prediction."""
    model = fit(docs, labels, doc_id, text)
    scored = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    scored = scored.select("doc_id", held_out().alias("held_out"), score(model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
