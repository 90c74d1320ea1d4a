"""Checks that abort a batch, kept inside the plan: the error fires when the rows are read."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def require(df: DataFrame, condition: Column, message: str) -> DataFrame:
    """The same rows; reading one that fails (or is null on) the condition raises. Used in a filter, so it is never pruned."""
    return df.where(F.when(F.coalesce(condition, F.lit(False)), True).otherwise(F.raise_error(F.lit(message)).cast("boolean")))


def assert_unique(df: DataFrame, keys: Sequence[str], message: str = "duplicate key", *, null_ok: bool = False) -> DataFrame:
    """The same rows; raises if a key repeats. One shuffle on the key, aggregated first, so a key of a third of all rows is small.

    With ``null_ok`` rows whose keys hold a null are not looked at.
    """
    own = df
    if null_ok:
        for k in keys:
            own = own.where(F.col(k).isNotNull())
    bad = duplicates(own, keys).agg(F.count("*").alias("__bad"))
    checked = bad.where(F.when(F.col("__bad") == 0, True).otherwise(F.raise_error(F.concat(F.lit(f"{message}: "), F.col("__bad").cast("string"))).cast("boolean")))
    return df.crossJoin(F.broadcast(checked)).drop("__bad")  # one row of one number


def assert_overlap(left: DataFrame, right: DataFrame, keys: Sequence[str], message: str = "no common key") -> DataFrame:
    """``left``; raises if both sides have rows but share no key."""
    n_left = left.agg(F.count("*").alias("__l"))
    n_right = right.agg(F.count("*").alias("__r"))
    n_both = left.join(right.select(*keys), list(keys), "left_semi").agg(F.count("*").alias("__b"))
    ok = (F.col("__b") > 0) | (F.col("__l") == 0) | (F.col("__r") == 0)
    row = n_left.crossJoin(n_right).crossJoin(n_both)  # one row each
    checked = row.where(F.when(ok, True).otherwise(F.raise_error(F.lit(message)).cast("boolean"))).select(F.lit(1).alias("__ok"))
    return left.crossJoin(F.broadcast(checked)).drop("__ok")


def all_equal(*values: Column) -> Column:
    """True if no value is null and all are the same."""
    out = values[0].isNotNull()
    for v in values[1:]:
        out = out & v.isNotNull() & (v == values[0])
    return out
