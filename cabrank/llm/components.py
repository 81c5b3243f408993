"""Connected components of a table of links, in a few rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cabrank.llm.common import staged


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Each node that has a link, with the smallest node it can reach.

    Large and small stars in turn: every node links its larger neighbours, then
    its smaller ones, to the smallest node it sees, until nothing changes. A
    round is a few aggregations and joins on the links; its result is staged, so
    the lineage stays short. Links of a node with itself, repeated links and
    NULL ends are left out.
    """
    ends = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    ends = ends.filter(F.col("u") > F.col("v"))
    stars, before = staged(ends.distinct(), "links"), None
    while True:
        mark = tuple(stars.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if mark == before or not mark[0]:
            return stars.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(
                stars.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        before = mark
        both = stars.unionAll(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        smallest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter(F.col("v") > F.col("u")).join(smallest, "u")
        large = large.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest, "u").select(
            F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v"))))
        )
        stars = staged(small.select("col.*").filter(F.col("u") > F.col("v")).distinct(), "links")
