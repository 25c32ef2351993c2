"""Joins that stay even when the key is often missing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Opens the stand-in for a missing key; a control character no real key starts with.
NO_KEY = "\x1e"


def left_join_hollow_key(
    left: DataFrame, right: DataFrame, key: str, spread_by: str
) -> DataFrame:
    """Left join on a text key that is NULL for many left rows.

    NULL never matches, yet a shuffled join would send all those rows to one
    task. Joining on a stand-in made from ``spread_by`` deals them out evenly, in
    one pass over the input; the second condition keeps them from ever matching.
    The right side is shuffled by its plain key, so a grouping by that key is not
    shuffled again. A hot real key on the left is left to adaptive skew
    splitting, which repeats only that key's right side.
    """
    spread = F.coalesce(F.col(key), F.concat(F.lit(NO_KEY), F.col(spread_by).cast("string")))
    matches = (spread == F.col("_right_key")) & F.col(key).isNotNull()
    return left.join(right.withColumnRenamed(key, "_right_key"), matches, "left").drop("_right_key")


def missing_from(child: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    """Child rows whose key has no parent. A missing key is not a violation."""
    # Distinct first: the parent may repeat its keys for every night it holds.
    parents = parent.select(F.col(field).alias(column)).where(F.col(column).isNotNull()).distinct()
    return child.where(F.col(column).isNotNull()).join(parents, column, "left_anti")
