"""How far the sources of a language depart in their use of words, from each other and from the language.

1. *Partial counts.* Tasks work on columns: texts are lower-cased and split by
   Arrow kernels, terms become dictionary codes, and hash aggregations count
   them for each document and then for each source. What a task has counted is
   folded whenever it grows, so a common word leaves a task once for each source.
2. *Shards.* Partial counts meet by language and term and are stored, one row for
   each term that enough documents of the language hold, with its counts by source.
3. *Divergences.* Tasks read shards as matrices of terms by sources. They give, for
   each pair of sources, the sum over their terms, and for each source its
   strongest terms; sums and strongest terms of all tasks are then merged.

A share is a whole number of billionths, ``1 + floor(10**9 * (count + 2) / (N +
2 * V))``, for N occurrences of V kept terms; the divergence of two shares is
``floor((p - q)**2 / (p + q))``. All arithmetic is in whole numbers and exact below
9 * 10**15 occurrences in a language.

The sizes of groups are kept in a stored table, of which a task reads the
languages it meets. A task holds a sum for each pair of sources of a language, as
many as the result has rows for that language.

NULL texts have no terms; NULL languages and sources are the empty string. A group
without terms is a group. Equal rows are documents of their own. A very long text
is cut between terms into pieces and counted as one document. An empty table
gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cabrank.llm.common import staged
from cabrank.llm.storage import open_folder
from cabrank.sinks.reports import shared_folder, stage_table

#: What lies between terms, which are runs of letters and of anything beyond ASCII.
BREAKS = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
LEAST_DOCS = 10
TOP = 10
BLOCK_BYTES = 4 << 20
PIECE_BYTES = 8 << 20
FOLD_ROWS = 400_000
CELLS = 1 << 20  # of the matrix of terms by sources held at once
KEYS = ["lang", "source", "term"]


def _tally(texts: pa.Array, rows: pa.Array) -> pa.Table:
    """Occurrences of each term in each document: row number, term, count."""
    found = pc.split_pattern_regex(pc.ascii_lower(texts), pattern=BREAKS)
    terms = pc.list_flatten(found)
    some = pc.not_equal(terms, "")
    coded = terms.filter(some).dictionary_encode()
    owners = rows.take(pc.list_parent_indices(found).filter(some))
    counted = pa.table({"row": owners, "code": coded.indices}).group_by(["row", "code"], use_threads=False)
    counted = counted.aggregate([([], "count_all")])
    terms = coded.dictionary.take(counted["code"].combine_chunks())
    return pa.table({"row": counted["row"], "term": terms, "n": counted["count_all"]})


def _pieces(text: str, most: int) -> Iterator[str]:
    """A long text in pieces that end between terms."""
    gap, start = re.compile(BREAKS), 0
    while len(text) - start > most:
        end = gap.search(text, start + most)
        if end is None:
            break
        yield text[start : end.start()]
        start = end.end()
    yield text[start:]


def _of_long(text: str, row: int, most: int) -> pa.Table:
    """As ``_tally`` for one long text, a piece at a time."""
    total = _tally(pa.array([""]), pa.array([row], pa.int32()))
    for piece in _pieces(text, most):
        both = pa.concat_tables([total, _tally(pa.array([piece]), pa.array([row], pa.int32()))])
        total = both.group_by(["row", "term"], use_threads=False).aggregate([("n", "sum")]).rename_columns(["row", "term", "n"])
    return total


def _blocks(batch: pa.RecordBatch, most: int) -> Iterator[pa.RecordBatch]:
    sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    start = 0
    while start < batch.num_rows:
        before = sizes[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(sizes, before + most, "right")))
        yield batch.slice(start, end - start)
        start = end


def _counted(block: pa.RecordBatch, piece: int) -> pa.Table:
    """Occurrences and documents of each term in each group of a block."""
    rows = pa.array(range(block.num_rows), pa.int32())
    texts = pc.fill_null(block.column("text"), "")
    if block.num_rows == 1 and len(texts[0].as_buffer() or b"") > piece:
        found = _of_long(texts[0].as_py(), 0, piece)
    else:
        found = _tally(texts, rows)
    owners = found["row"].combine_chunks()
    columns = {name: block.column(name).take(owners) for name in ("lang", "source")}
    return _folded(pa.table({**columns, "term": found["term"], "n": found["n"], "docs": pa.repeat(1, found.num_rows)}))


def _folded(counts: pa.Table) -> pa.Table:
    out = counts.group_by(KEYS, use_threads=False).aggregate([("n", "sum"), ("docs", "sum")])
    return out.select([*KEYS, "n_sum", "docs_sum"]).rename_columns([*KEYS, "n", "docs"])


def _group(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def partial_counts(
    docs: DataFrame, lang: str, source: str, text: str, block: int = BLOCK_BYTES, piece: int = PIECE_BYTES, fold: int = FOLD_ROWS
) -> DataFrame:
    """Occurrences and documents of each term by language and source, folded in each task."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        for batch in batches:
            for part in _blocks(batch, block):
                held.append(_counted(part, piece))
                if sum(t.num_rows for t in held) > fold:
                    held = [_folded(pa.concat_tables(held))]
                    if held[0].num_rows > fold // 2:
                        yield from held.pop().combine_chunks().to_batches()
        if held:
            yield from _folded(pa.concat_tables(held)).combine_chunks().to_batches()

    named = docs.select(_group(lang).alias("lang"), _group(source).alias("source"), F.col(text).alias("text"))
    return named.mapInArrow(count, "lang string, source string, term string, n long, docs long")


def shards(partial: DataFrame, least: int = LEAST_DOCS) -> DataFrame:
    """One row for each kept term of a language: its counts by source, staged."""
    dealt = partial.repartition("lang", "term").groupBy("lang", "term", "source")
    counts = dealt.agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    terms = counts.groupBy("lang", "term").agg(
        F.sum("docs").alias("docs"), F.collect_list("source").alias("sources"), F.collect_list("n").alias("counts")
    )
    return staged(terms.filter(F.col("docs") >= least).select("lang", "term", "sources", "counts"), "shards")


def group_sizes(docs: DataFrame, kept: DataFrame, lang: str, source: str, folder: str) -> DataFrame:
    """Of every group: occurrences of kept terms in it and in its language, and the language's kept terms; stored."""
    groups = docs.select(_group(lang).alias("lang"), _group(source).alias("source")).distinct()
    each = kept.select("lang", F.inline(F.arrays_zip("sources", "counts"))).groupBy("lang", F.col("sources").alias("source"))
    sizes = each.agg(F.sum("counts").alias("n"))
    terms = kept.groupBy("lang").agg(F.count("*").alias("v"))
    known = groups.join(sizes, ["lang", "source"], "left").join(terms, "lang", "left").fillna(0, ["n", "v"])
    whole = known.groupBy("lang").agg(F.sum("n").alias("n_lang"))
    return stage_table(known.join(whole, "lang"), folder)


def shares(counts: np.ndarray, total: np.ndarray | int, terms: int) -> np.ndarray:
    """``1 + floor(10**9 * (counts + 2) / (total + 2 * terms))``, by long division with three digits at a time."""
    rest, out = counts + 2, np.zeros_like(counts)
    whole = np.asarray(total, np.int64) + 2 * terms
    for _ in range(3):
        digits, rest = np.divmod(rest * 1000, whole)
        out = out * 1000 + digits
    return out + 1


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


class Language:
    """The sources of one language, and what a task has found about them so far."""

    def __init__(self, sizes: pa.Table, top: int) -> None:
        sizes = sizes.sort_by("source")
        self.sources = sizes["source"].combine_chunks()
        self.totals = sizes["n"].to_numpy()
        self.total, self.terms = sizes["n_lang"][0].as_py(), sizes["v"][0].as_py()
        self.sums = np.zeros((len(self.sources),) * 2, np.int64)
        self.top = top
        self.best = pa.table({"source": pa.array([], pa.int64()), "item": pa.array([], pa.string()), "value": pa.array([], pa.int64())})

    def add(self, rows: pa.RecordBatch) -> None:
        """Take in some terms, all sources of each."""
        most = max(1, CELLS // len(self.sources))
        for at in range(0, rows.num_rows, most):
            part = rows.slice(at, most)
            lists = part.column("sources")
            counts = np.zeros((part.num_rows, len(self.sources)), np.int64)
            places = pc.index_in(pc.list_flatten(lists), value_set=self.sources)
            owners = pc.list_parent_indices(lists).to_numpy()
            counts[owners, places.to_numpy()] = pc.list_flatten(part.column("counts")).to_numpy()
            p = shares(counts, self.totals, self.terms)
            for s in range(len(self.sources) - 1):
                self.sums[s, s + 1 :] += divergence(p[:, s + 1 :], p[:, s : s + 1]).sum(axis=0)
            q = shares(counts.sum(axis=1, keepdims=True), self.total, self.terms)
            term, source = np.nonzero((counts > 0) & (p > q))
            value = divergence(p[term, source], q[term, 0])
            self.keep(pa.table({"source": source, "item": part.column("term").take(pa.array(term)), "value": value}))

    def keep(self, found: pa.Table) -> None:
        """The strongest terms of each source so far, ties by the bytes of the term."""
        order = [("source", "ascending"), ("value", "descending"), ("item", "ascending")]
        found = pa.concat_tables([self.best, found]).sort_by(order)
        owner = found["source"].to_numpy()
        place = np.arange(len(owner)) - np.searchsorted(owner, owner)
        self.best = found.filter(pa.array(place < self.top))

    def results(self, lang: str) -> Iterator[pa.RecordBatch]:
        for s in range(len(self.sources) - 1):
            n = len(self.sources) - s - 1
            pair = [pa.repeat(lang, n), pa.repeat(self.sources[s], n), pa.repeat("pair", n), self.sources.slice(s + 1)]
            yield pa.RecordBatch.from_arrays([*pair, pa.array(self.sums[s, s + 1 :])], RESULT)
        own = self.best.combine_chunks()
        n = own.num_rows
        names = self.sources.take(own["source"].combine_chunks())
        columns = [pa.repeat(lang, n), names, pa.repeat("term", n), own["item"].combine_chunks(), own["value"].combine_chunks()]
        yield pa.RecordBatch.from_arrays(columns, RESULT)


RESULT = ["lang", "source", "part", "item", "value"]


def _by_language(batch: pa.RecordBatch) -> Iterator[tuple[str, pa.RecordBatch]]:
    names = batch.column("lang").dictionary_encode()
    codes = names.indices.to_numpy()
    for code, lang in enumerate(names.dictionary.to_pylist()):
        yield lang, batch.take(pa.array(np.flatnonzero(codes == code)))


def divergences(
    docs: DataFrame,
    lang: str = "lang",
    source: str = "source",
    text: str = "text",
    least: int = LEAST_DOCS,
    top: int = TOP,
    block: int = BLOCK_BYTES,
    piece: int = PIECE_BYTES,
    fold: int = FOLD_ROWS,
) -> DataFrame:
    """Per group, its divergence from every other source of its language, and the terms that it uses most beyond the language.

    ``part`` is ``pair``, with another source as ``item``, or ``term``; ``rank``
    counts from 1 in each group and part, by falling value and then by the bytes
    of the item.
    """
    kept = shards(partial_counts(docs, lang, source, text, block, piece, fold), least)
    folder = shared_folder(docs.sparkSession, "groups")
    groups = group_sizes(docs, kept, lang, source, folder)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = open_folder(folder)
        languages: dict[str, Language] = {}
        for batch in batches:
            for name, rows in _by_language(batch):
                if name not in languages:
                    sizes = pq.read_table(path, filesystem=system, filters=[("lang", "=", name)])
                    languages[name] = Language(sizes, top)
                languages[name].add(rows)
        for name, language in languages.items():
            yield from language.results(name)

    schema = "lang string, source string, part string, item string, value long"
    found = staged(kept.mapInArrow(compare, schema), "divergences")
    sums = found.filter("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    bare = groups.filter("v = 0").select("lang", "source")
    bare = bare.join(bare.withColumnRenamed("source", "item"), "lang").filter("source < item")
    pairs = sums.unionAll(bare.select("lang", "source", F.lit("pair"), "item", F.lit(0).cast("long")))
    both = F.array(F.struct("source", "item"), F.struct(F.col("item").alias("source"), F.col("source").alias("item")))
    pairs = pairs.select("lang", "part", "value", F.explode(both).alias("ends")).select("lang", "ends.source", "part", "ends.item", "value")
    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    ranked = pairs.unionByName(found.filter("part = 'term'")).withColumn("rank", F.row_number().over(order))
    return ranked.filter((F.col("part") == "pair") | (F.col("rank") <= top)).select(*RESULT, "rank")
