"""The registered queries of the operators, with production parameters, and SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cabrank.llm.alignment import alignment_figures
from cabrank.llm.common import table, with_package
from cabrank.llm.compression import classify
from cabrank.llm.divergence import divergences
from cabrank.llm.lengths import length_histogram
from cabrank.llm.ordering import training_order
from cabrank.llm.packing import pack_documents
from cabrank.llm.phrases import contamination
from cabrank.llm.pieces import encoding_digests
from cabrank.llm.repeats import dedup
from cabrank.llm.rules import judge
from cabrank.llm.simhash import near_copies
from cabrank.llm.sql import DIVERGENCE, PASSAGES, PAYLOADS, QUALITY, REPEATS, URLS
from cabrank.llm.urls import judge_urls
from cabrank.llm.warc import archive_pages

Query = Callable[[SparkSession, str], DataFrame]

URL_RULES = """select * from values ('com/', 'allow'), ('example.com/en/', 'block'), ('www.example.com/en/', 'allow'),
    ('net/es/', 'block'), ('net/fr/', 'block') as rules(rule, action)"""


def _urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"), spark.sql(URL_RULES))


def _alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(with_package(spark), sf_dir, "documents")
    return alignment_figures(docs.select(docs.doc_id.cast("long"), "text"))


def on(operator: Callable[..., DataFrame], *names: str) -> Query:
    """The operator on whole tables."""
    return lambda spark, sf_dir: operator(*(table(with_package(spark), sf_dir, name) for name in names))


def queries() -> dict[str, Query]:
    return {
        "op1_training_order": on(training_order, "documents"),
        "op2_suffix_array_dedup": on(dedup, "documents"),
        "op3_url_filters": _urls,
        "op4_best_fit_packing": on(pack_documents, "documents"),
        "op5_quality_rules": on(judge, "documents"),
        "op6_quality_classifier": on(classify, "documents", "labels"),
        "op7_length_histogram": on(length_histogram, "documents"),
        "op8_warc_writer": on(archive_pages, "pages"),
        "op9_decontamination": on(contamination, "documents", "benchmark"),
        "op10_simhash": on(near_copies, "documents"),
        "op11_piece_encoding": on(encoding_digests, "documents"),
        "op12_source_divergence": on(divergences, "documents"),
        "op13_token_alignment": _alignment,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_suffix_array_dedup": REPEATS,
        "op3_url_filters": URLS,
        "op5_quality_rules": QUALITY,
        "op8_warc_writer": PAYLOADS,
        "op9_decontamination": PASSAGES,
        "op12_source_divergence": DIVERGENCE,
    }
