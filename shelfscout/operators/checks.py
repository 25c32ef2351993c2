"""Data checks. Each returns the violating rows; an empty result is a pass."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfscout.operators.joins import missing_from


def not_null_rule(column: str) -> Column:
    return F.col(column).isNull()


def accepted_rule(column: str, values: Iterable) -> Column:
    """NULL passes."""
    return F.coalesce(~F.col(column).isin(*values), F.lit(False))


def range_rule(column: str, low=None, high=None) -> Column:
    """Bounds included; NULL passes."""
    rules = []
    if low is not None:
        rules.append(F.col(column) < low)
    if high is not None:
        rules.append(F.col(column) > high)
    return F.coalesce(reduce(lambda a, b: a | b, rules), F.lit(False))


def not_null(df: DataFrame, columns: list[str]) -> DataFrame:
    """Violations per column, all columns in one pass."""
    counts = df.agg(*[F.count_if(not_null_rule(c)).alias(c) for c in columns])
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("violations")) for c in columns]
    )
    return counts.select(F.inline(pairs)).where("violations > 0")


def accepted_values(df: DataFrame, column: str, values: Iterable) -> DataFrame:
    """Each value outside the list with its row count."""
    return (
        df.where(accepted_rule(column, values))
        .groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("row_count"))
    )


def accepted_range(df: DataFrame, column: str, low=None, high=None) -> DataFrame:
    return df.where(range_rule(column, low, high))


def unique(df: DataFrame, column: str) -> DataFrame:
    """Values held by more than one row; NULL does not count."""
    return unique_combination(df.where(F.col(column).isNotNull()), [column])


def unique_combination(df: DataFrame, columns: list[str]) -> DataFrame:
    """Combinations held by more than one row; NULL is a value here."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("row_count")).where("row_count > 1")


def relationships(child: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    return missing_from(child, column, parent, field)


@dataclass
class ModelChecks:
    """The declared checks of one model.

    Row rules are fused into a single aggregate over the model; keyed checks
    (uniqueness, references, comparisons with another model) stay one DataFrame
    of violations each.
    """

    model: str
    data: DataFrame
    row_rules: list[tuple[str, str, Column]] = field(default_factory=list)
    keyed: list[tuple[str, str, DataFrame]] = field(default_factory=list)
    counted: list[tuple[str, DataFrame]] = field(default_factory=list)

    def not_null(self, *columns: str) -> ModelChecks:
        self.row_rules += [("not_null", c, not_null_rule(c)) for c in columns]
        return self

    def accepted_values(self, column: str, values: Iterable) -> ModelChecks:
        self.row_rules.append(("accepted_values", column, accepted_rule(column, values)))
        return self

    def accepted_range(self, column: str, low=None, high=None) -> ModelChecks:
        self.row_rules.append(("accepted_range", column, range_rule(column, low, high)))
        return self

    def unique(self, *columns: str) -> ModelChecks:
        self.keyed += [("unique", c, unique(self.data, c)) for c in columns]
        return self

    def unique_combination(self, *columns: str) -> ModelChecks:
        self.keyed.append(
            ("unique_combination", ",".join(columns), unique_combination(self.data, list(columns)))
        )
        return self

    def relationships(self, column: str, parent: DataFrame, parent_field: str) -> ModelChecks:
        self.keyed.append(
            ("relationships", column, relationships(self.data, column, parent, parent_field))
        )
        return self

    def rows(self, check: str, violations: DataFrame) -> ModelChecks:
        """A check of its own making, given as the rows that break it."""
        self.keyed.append((check, "", violations))
        return self

    def counts(self, check: str, violations: DataFrame) -> ModelChecks:
        """A check whose violations were counted before, in parts: ``violations`` of each part."""
        self.counted.append((check, violations))
        return self

    def __len__(self) -> int:
        return len(self.row_rules) + len(self.keyed) + len(self.counted)

    def result(self) -> DataFrame:
        """One row per check: model, check, column, violations."""
        parts = []
        if self.row_rules:
            counts = self.data.agg(
                *[F.count_if(rule).alias(f"r{i}") for i, (_, _, rule) in enumerate(self.row_rules)]
            )
            pairs = F.array(
                *[
                    F.struct(
                        F.lit(self.model).alias("model"),
                        F.lit(check).alias("check_name"),
                        F.lit(column).alias("column_name"),
                        F.col(f"r{i}").alias("violations"),
                    )
                    for i, (check, column, _) in enumerate(self.row_rules)
                ]
            )
            parts.append(counts.select(F.inline(pairs)))
        whole = [(check, column, bad, F.count(F.lit(1))) for check, column, bad in self.keyed]
        total = F.coalesce(F.sum("violations"), F.lit(0))
        whole += [(check, "", parted, total) for check, parted in self.counted]
        for check, column, bad, violations in whole:
            parts.append(
                bad.agg(violations.alias("violations")).select(
                    F.lit(self.model).alias("model"),
                    F.lit(check).alias("check_name"),
                    F.lit(column).alias("column_name"),
                    "violations",
                )
            )
        return reduce(DataFrame.unionByName, parts)


def run_suite(checks: list[ModelChecks]) -> DataFrame:
    """One row per declared check with its verdict."""
    results = reduce(DataFrame.unionByName, [check.result() for check in checks])
    return results.withColumn("passed", F.col("violations") == 0)
