"""The registered queries on tables with heavy, missing and unknown keys, against their SQL."""

import __spark_entry__ as registry
import duckdb
import pytest
from cabrank.plans import order_trips
from test_registered import TABLES, table

REPLACED = {
    "lineitem": """select * replace (
        case l_linenumber when 1 then 3 when 2 then 3 when 3 then null when 4 then 999999
             else l_suppkey end as l_suppkey,
        case when l_quantity <= 17 then 5 when l_quantity > 45 then null else l_orderkey end as l_orderkey)""",
    "orders": """select * replace (
        case o_orderstatus when 'F' then 11 when 'P' then o_custkey
             else case when o_orderpriority = '5-LOW' then null else o_custkey end end as o_custkey)""",
    "customer": "select * replace (case when c_acctbal < 0 then null else c_nationkey end as c_nationkey)",
}

QUERIES = sorted(
    name
    for name in registry.queries()
    if name.startswith(("pickup_", "dropoff_", "top5_", "enrich_", "count_by", "solo_", "peak_", "trips_per"))
)


@pytest.fixture(scope="module")
def skewed(small_dir, tmp_path_factory):
    """The smallest tables, a third of the line items on one supplier and another third on one order."""
    folder = tmp_path_factory.mktemp("skewed")
    con = duckdb.connect()
    for name in TABLES:
        rows = f"{REPLACED.get(name, 'select *')} from read_parquet('{small_dir}/{name}.parquet')"
        con.execute(f"copy ({rows}) to '{folder}/{name}.parquet' (format parquet)")
        con.execute(f"create view {name} as select * from read_parquet('{folder}/{name}.parquet')")
    return str(folder), con


@pytest.fixture(params=["10MB", "-1"], ids=["broadcast", "shuffle"])
def threshold(spark, request):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", request.param)
    yield request.param
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def expected(con, name):
    cursor = con.execute(registry.oracle_sql()[name])
    return table([column[0] for column in cursor.description], cursor.fetchall())


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, skewed, threshold, name):
    folder, con = skewed
    got = registry.queries()[name](spark, folder)
    assert table(got.columns, got.collect()) == expected(con, name)


def test_spread_enrichment_equals_sql(spark, skewed, threshold):
    folder, con = skewed
    got = order_trips.enriched_trips(spark, folder, small=False)
    assert table(got.columns, got.collect()) == expected(con, "enrich_zones")
