"""Formatting for people. Rounding is half-even throughout."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def fmt_int(c: Column) -> Column:
    """Whole number with thousands separators."""
    return F.format_number(c.cast("double"), 0)


def fmt_plain_int(c: Column) -> Column:
    """Whole number without separators."""
    return F.replace(fmt_int(c), F.lit(","), F.lit(""))


def fmt_currency(c: Column, symbol: str) -> Column:
    """Missing shows as a dash: no data is not zero."""
    return F.when(c.isNull(), "-").otherwise(F.concat(F.lit(symbol), fmt_int(c)))


def fmt_share(c: Column) -> Column:
    """A share as whole percent; a missing share shows as 0%."""
    percent = F.bround(F.coalesce(c, F.lit(0.0)) * 100, 0).cast("bigint")
    return F.concat(percent.cast("string"), F.lit("%"))


def title_case(c: Column) -> Column:
    """Capital after every non-letter (``o'brien`` to ``O'Brien``), which
    ``initcap`` does only after white space."""
    runs = F.split(F.lower(c), r"(?<=\P{L})")
    return F.array_join(
        F.transform(runs, lambda run: F.concat(F.upper(F.left(run, F.lit(1))), F.substring(run, 2, 1 << 30))),
        "",
    )
