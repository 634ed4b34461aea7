"""Joins and set operations shared by the operators."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def fixed_rows(spark: SparkSession, rows: list, schema: str) -> DataFrame:
    """A literal table; its size is known, so it is always broadcast."""
    return F.broadcast(spark.createDataFrame(rows, schema))


def attach(df: DataFrame, totals: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left-join settled per-group values to the rows; null keys match each other.

    The written size of ``totals`` decides whether it is broadcast. Otherwise
    rows are shuffled and the adaptive skew join splits a group that holds a
    large share of them.
    """
    names = {k: f"_k_{k}" for k in keys}
    joined = df.join(totals.withColumnsRenamed(names), same_keys(names), "left")
    return joined.drop(*names.values())


def same_keys(pairs: dict) -> Column:
    """Null-safe equality of several column pairs."""
    condition = F.lit(True)
    for left, right in pairs.items():
        condition = condition & F.col(left).eqNullSafe(F.col(right))
    return condition
