import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

from brute import prose  # noqa: E402

DOC_TYPES = (
    "doc_id long, text string, lang string, source string, n_chars long, `key` string, size int, fp string, `row` int,"
    " words string, hash string, place int, shard int, anchor int, length int, best int"
)
EXTRA = ("k", 1, "f", 2, "w", "h", 3, 4, 5, 6, 7)


def edge_texts():
    base, other = prose(1, 120), prose(2, 90)
    return [
        (0, base),
        (1, base),
        (2, base.replace(base.split()[60], "Changed")),
        (2, base.replace(base.split()[60], "Changed")),
        (3, None),
        (4, ""),
        (5, " \t\n "),
        (None, other),
        (None, other + " end"),
        (None, None),
        (6, "one"),
        (7, "One two"),
        (8, other[:199]),
        (9, "x" + other[:200] + "y"),
        (10, prose(3, 30_000)),
        (11, "é" * 300 + prose(4, 20)),
        (12, "\0" * 250 + "a\0b"),
        (13, "word " * 500),
        (14, "LOUD!! " * 80),
        (15, "# $ % & | < > *\n# $ % & | < > *\n" * 20),
        (16, "a" * 50_000),
        (-5, prose(5, 60) + "\r\n" + prose(5, 60)),
        (17, "line one here\n" * 3 + prose(6, 70) + "  <|endoftext|>"),
    ]


@pytest.fixture(scope="module")
def edge(spark):
    rows = [(key, text, "en", "s", len(text or ""), *EXTRA) for key, text in edge_texts()]
    return spark.createDataFrame(rows, DOC_TYPES).repartition(3).cache()


@pytest.fixture(scope="module")
def edge_rows(edge):
    return [(row.doc_id, row.text) for row in edge.collect()]


@pytest.fixture
def no_docs(spark):
    return spark.createDataFrame([], DOC_TYPES)
