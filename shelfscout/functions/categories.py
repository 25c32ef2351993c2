"""Mapping raw category names to groups by explicit list."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfscout.functions.cleaning import trimmed_fact
from shelfscout.policy import CategoryPolicy


def category_name(c: Column | str) -> Column:
    """The spelling the lists are written in."""
    return F.upper(trimmed_fact(c))


def category_group(name: Column, policy: CategoryPolicy) -> Column:
    return (
        F.when(name.isin(*policy.premium), policy.premium_group)
        .when(name.isin(*policy.other), policy.other_group)
        .otherwise(policy.outside_group)
    )


def category_detail(name: Column, policy: CategoryPolicy) -> Column:
    """The listed name with aliases collapsed, NULL for anything not listed."""
    plain = [listed for listed in policy.listed if listed not in policy.aliases]
    detail = F.when(name.isin(*plain), name)
    for alias, kept in policy.aliases.items():
        detail = detail.when(name == alias, kept)
    return detail


def classify(df: DataFrame, policy: CategoryPolicy, column: str = "category_name") -> DataFrame:
    """Adds ``cat_group`` and ``gin_category``. The name is normalised once per
    row, in a projection of its own, and both columns read that."""
    name = F.col("_category")
    return (
        df.withColumn("_category", category_name(column))
        .withColumns(
            {"cat_group": category_group(name, policy), "gin_category": category_detail(name, policy)}
        )
        .drop("_category")
    )
