"""Every registered query against its SQL on the generated tables."""

import math
from datetime import date, datetime

import duckdb
import pytest

import __spark_entry__ as registry

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()


@pytest.fixture(scope="module")
def oracle(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.12g}")
    if isinstance(value, datetime):
        return value.isoformat()
    if isinstance(value, date):
        return value.isoformat()
    return value


def table(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(repr([plain(row[i]) for i in order]) for row in rows)


def own(names):
    """Without the queries of the subpackage for corpora, which has tests of its own."""
    return sorted(name for name in names if not name.startswith("op") and name != "pipeline")


def test_every_query_has_sql():
    assert own(registry.queries()) == own(registry.oracle_sql())


@pytest.mark.parametrize("name", own(registry.queries()))
def test_query_equals_sql(spark, oracle, sf_dir, name):
    got = registry.queries()[name](spark, sf_dir)
    cursor = oracle.execute(registry.oracle_sql()[name])
    expected = table([column[0] for column in cursor.description], cursor.fetchall())
    assert table(got.columns, got.collect()) == expected


def test_entry(spark):
    result = registry.entry(spark)
    assert result.columns == ["Pickup_Borough", "O_Pickup_Count"]
    assert result.count() == 5
