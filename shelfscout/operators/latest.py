"""Newest row, newest night, newest attributes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(
    df: DataFrame, keys: list[str], newest: str, then: list[Column]
) -> DataFrame:
    """One row per key: the newest, ties broken by ``then``, which has to be total.

    Ties are real (one load stamp per file), so without it two runs could keep
    different rows.
    """
    return first_per_key(df, keys, [F.col(newest).desc(), *then])


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key: the first in ``order``, which has to be total.

    Spark keeps one row per key and map task before the shuffle, so a hot key
    never travels whole.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_pick", F.row_number().over(window)).where("_pick = 1").drop("_pick")


def latest_date(df: DataFrame, column: str = "snapshot_date") -> Column:
    """The newest night of a feed as a scalar: run once, pushed into scans, and
    on a feed partitioned by night it prunes to that night."""
    return df.select(F.max(column)).scalar()


def latest_attributes(
    df: DataFrame, keys: list[str], date: str, attributes: list[str]
) -> DataFrame:
    """The attributes of the newest line per key, all from the same line.

    First a hash aggregate to distinct attribute sets, which are few because
    attributes drift slowly, then the pick among those. Ordering by the
    attributes after the date leaves no tie that could change the result.
    """
    variants = df.groupBy(*keys, *attributes).agg(F.max(date).alias("_last"))
    newest = F.max(F.struct("_last", *attributes)).alias("_newest")
    return variants.groupBy(*keys).agg(newest).select(
        *keys, F.col("_newest._last").alias(date), *[F.col(f"_newest.{a}") for a in attributes]
    )
