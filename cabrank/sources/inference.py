"""Which types the columns of a text table could have, from states that merge.

Spark's own inference reads all files again whenever some are added, and does not
say what stands in the way of a narrower type. Here each column has a state for
each part of the table, such as a file: how many values there are, how many of
them each candidate type would take, and the smallest value that it would not.
States of parts add up to the state of the whole, so they can be stored, and the
states of added files merged with them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cabrank.functions.conditions import DECIMAL
from cabrank.schema import TIME_FORMAT

WHOLE = r"[+-]?[0-9]{1,18}"


def candidates(value: Column, fmt: str = TIME_FORMAT) -> dict[str, Column]:
    """Whether a value fits each candidate type, the narrowest type first."""
    return {
        "bigint": value.rlike(f"^({WHOLE})$"),
        "double": value.rlike(f"^({DECIMAL})$"),
        "timestamp_ntz": F.try_to_timestamp(value, F.lit(fmt)).isNotNull(),
    }


def type_states(df: DataFrame, *by: str) -> DataFrame:
    """The state of each text column, for each value of the columns ``by``, in one pass.

    Every state is an aggregate of its own, folded in each task; the table is
    not turned over row by row.
    """
    columns = [name for name in df.columns if name not in by]
    states = []
    for name in columns:
        value = F.col(f"`{name}`")
        fits = candidates(value)
        taken = [F.count_if(fit).alias(f"as_{kind}") for kind, fit in fits.items()]
        against = [F.min(F.when(~fit, value)).alias(f"against_{kind}") for kind, fit in fits.items()]
        states.append(F.struct(F.lit(name).alias("column"), F.count(value).alias("filled"), *taken, *against).alias(name))
    found = df.groupBy(*by).agg(F.array(*states).alias("states"))
    return found.select(*by, F.inline("states"))


def merged_types(states: DataFrame) -> DataFrame:
    """Per column the merged state and the narrowest type that takes every value; text where none does, or without values."""
    kinds = [name.removeprefix("as_") for name in states.columns if name.startswith("as_")]
    whole = states.groupBy("column").agg(
        F.sum("filled").alias("filled"),
        *(F.sum(f"as_{kind}").alias(f"as_{kind}") for kind in kinds),
        *(F.min(f"against_{kind}").alias(f"against_{kind}") for kind in kinds),
    )
    fitting = F.coalesce(*(F.when((F.col("filled") > 0) & (F.col(f"as_{kind}") == F.col("filled")), kind) for kind in kinds))
    return whole.withColumn("type", F.coalesce(fitting, F.lit("string")))
