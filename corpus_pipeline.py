"""From raw documents to packed sequences: the stages of the corpus pipeline.

Every stage takes the documents that the one before it kept, all of them, as a
table read from files, and gives documents with the same columns; the last gives
packed pieces. A stage's docstring says what it decides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cabrank.llm.common import staged, table, with_package
from cabrank.llm.compression import THRESHOLD, fit, score
from cabrank.llm.packing import pack_documents
from cabrank.llm.phrases import uncontaminated
from cabrank.llm.repeats import without_repeats
from cabrank.llm.simhash import one_of_each

BATCHES = "spark.sql.execution.arrow.maxBytesPerBatch"
#: A multiple of the blocks that stages cut batches into; as it comes, a batch of texts has 10,000 rows or 64 MB.
BATCH_BYTES = 8 << 20


def prepared(spark: SparkSession) -> SparkSession:
    """The session, its executors able to import the library, and its batches small, unless somebody has set their size.

    A batch lies in the JVM's buffers and in the worker of each task at once, and
    stages follow each other in the same workers.
    """
    if BATCHES not in spark.conf.getAll:
        spark.conf.set(BATCHES, str(BATCH_BYTES))
    return with_package(spark)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier, trained on the labelled ones among them, does not reject.

    NULL and empty texts have one and the same score, of a text that compresses
    like neither kind; as short junk is labelled bad they are rejected where such
    labels are. Equal texts have equal scores, so they stay or go together. A score
    at the threshold stays. Very long texts are scored whole.
    """
    model = fit(docs, table(prepared(spark), sf_dir, "labels"))
    return docs.filter(score(model) >= THRESHOLD)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: three-word shingles, fingerprints linked at two bits or fewer.

    The one with the smallest id stays, NULL being the largest; of rows that are
    equal in every column one stays. Texts without words, NULL among them, have
    fingerprint zero and are a group.
    """
    prepared(spark)
    return one_of_each(docs)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents without the strings of 200 bytes that occur elsewhere too; their length is counted anew.

    Every row stays, if with an empty text. NULL stays NULL, as does its length.
    All copies of a string go, the first included.
    """
    prepared(spark)
    cut = without_repeats(docs)
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without ten consecutive words of a benchmark item.

    NULL and empty texts have no words and stay. An item of fewer words counts as
    a whole, one without words never. Rows of one id are judged each by its own text.
    """
    return uncontaminated(docs, table(prepared(spark), sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences of at most 2048 tokens.

    NULL and empty texts are a piece of one token. Longer documents than a
    sequence have several pieces. Pieces of equal length are interchangeable, so
    which sequence each is in may differ between runs.
    """
    prepared(spark)
    return pack_documents(docs)


STAGES = [
    ("quality", quality),
    ("near_copies", near_copies),
    ("repeats", repeats),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: Training, suffix arrays and tokenisers are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of a folder, each written and read again. An empty table gives no rows."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
