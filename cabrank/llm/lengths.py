"""Exact histogram of encoded document lengths, with suffix sums.

One row per occurring length: documents and tokens of that length, documents and
tokens of at least that length, and the tokens that remain if every document is
cut to that length. From these rows totals, quantiles and truncated totals
follow for any context limit without another pass over the corpus.

NULL text has length 0. A very long text is tokenised whole, whatever it is made of. An empty table gives no rows. Equal rows count each.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cabrank.llm.common import staged
from cabrank.llm.tokens import RANKS, encode

SPAN = 1024


def encoded_lengths(docs: DataFrame, text: str = "text", path: str = RANKS) -> DataFrame:
    """The token count of each document."""

    @F.pandas_udf("long")
    def count(texts: pd.Series) -> pd.Series:
        return pd.Series([len(encode(x, path)) for x in texts], dtype="int64")

    return docs.select(count(F.col(text)).alias("length"))


def histogram(lengths: DataFrame) -> DataFrame:
    """Documents per length, folded in each task before anything moves."""
    return lengths.groupBy("length").agg(F.count("*").alias("n_docs"))


def with_suffix_sums(counts: DataFrame) -> DataFrame:
    """Counts with what lies at or above each length.

    Sums run inside spans of lengths, and over the totals of the spans, so no
    task sees more than a span or one row for each span. ``counts`` must be
    cheap to read twice.
    """
    counts = counts.withColumn("n_tokens", F.col("length") * F.col("n_docs"))
    counts = counts.withColumn("span", F.floor(F.col("length") / SPAN))
    spans = counts.groupBy("span").agg(F.sum("n_docs").alias("span_docs"), F.sum("n_tokens").alias("span_tokens"))
    above = Window.orderBy(F.desc("span")).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("span").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    spans = spans.select(
        "span",
        F.sum("span_docs").over(everything).alias("all_docs"),
        F.sum("span_tokens").over(everything).alias("all_tokens"),
        F.coalesce(F.sum("span_docs").over(above), F.lit(0)).alias("docs_above"),
        F.coalesce(F.sum("span_tokens").over(above), F.lit(0)).alias("tokens_above"),
    )
    within = Window.partitionBy("span").orderBy(F.desc("length")).rowsBetween(Window.unboundedPreceding, 0)
    at_least = counts.withColumns(
        {"docs_within": F.sum("n_docs").over(within), "tokens_within": F.sum("n_tokens").over(within)}
    ).join(spans, "span")
    docs, tokens = F.col("docs_within") + F.col("docs_above"), F.col("tokens_within") + F.col("tokens_above")
    shorter = F.col("all_tokens") - F.col("tokens_at_least")
    return (
        at_least.withColumns({"docs_at_least": docs, "tokens_at_least": tokens})
        .select(
            "length",
            "n_docs",
            "n_tokens",
            "docs_at_least",
            "tokens_at_least",
            (shorter + F.col("length") * F.col("docs_at_least")).alias("tokens_if_cut"),
            ((F.col("all_docs") - F.col("docs_at_least") + F.col("n_docs")) / F.col("all_docs")).alias("share_up_to"),
        )
    )


def length_histogram(docs: DataFrame, text: str = "text", path: str = RANKS) -> DataFrame:
    return with_suffix_sums(staged(histogram(encoded_lengths(docs, text, path)), "lengths"))


def at_limits(report: DataFrame, limits: list[int]) -> DataFrame:
    """Documents kept whole, documents cut and remaining tokens for given context limits, from the report alone."""
    pairs = report.withColumn("limit", F.explode(F.array(*[F.lit(int(x)) for x in limits])))
    cut = F.least("length", "limit") * F.col("n_docs")
    return pairs.groupBy("limit").agg(
        F.sum(cut).alias("tokens"),
        F.sum(F.when(F.col("length") <= F.col("limit"), F.col("n_docs")).otherwise(0)).alias("whole_docs"),
        F.sum(F.when(F.col("length") > F.col("limit"), F.col("n_docs")).otherwise(0)).alias("cut_docs"),
    )


def quantiles(report: DataFrame, shares: list[float]) -> DataFrame:
    """The smallest length that at least so large a share of the documents does not exceed."""
    pairs = report.withColumn("share", F.explode(F.array(*[F.lit(float(x)) for x in shares])))
    pairs = pairs.filter(F.col("share_up_to") >= F.col("share"))
    return pairs.groupBy("share").agg(F.min("length").alias("length"))
