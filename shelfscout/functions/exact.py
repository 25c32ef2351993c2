"""Exact sums of amounts in whole numbers.

A double stands for the decimal it prints as. Nearly every amount prints with
four decimals at most: it is counted in ten-thousandths, as a long cut into a
high and a low limb whose sums cannot overflow before billions of lines. What
does not fit is the rest, a wide decimal that ordinary lines leave empty. The
three sums merge with those of other lines, and are put together once, at the
end, so no line costs decimal arithmetic and no total depends on the order.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Totals hold 22 digits before the point and 15 after it; beyond that a job stops.
# The two addends are that much narrower that Spark keeps all decimals of their sum.
TOTAL, REST, FEW = "decimal(38,15)", "decimal(37,15)", "decimal(36,15)"
PARTS = ("high", "low", "rest")
# Fixed by the range in which doubles and short decimals correspond one to one.
UNITS, MOST = 10_000, 1e11
LOW_BITS = 20
# Sums of limbs that together stay below 18 digits.
MOST_HIGH, MOST_LOW = 1 << 38, 1 << 58


def finite(c: str, kind: T.DataType) -> Column:
    """A double that is no number counts as missing."""
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return F.when(F.abs(F.col(c)) < float("inf"), F.col(c))
    return F.col(c)


def in_parts(kind: T.DataType) -> bool:
    """Whole numbers and decimals add up exactly as they are."""
    return not isinstance(kind, (T.IntegralType, T.DecimalType))


def line_parts(c: str, kind: T.DataType) -> dict[str, Column]:
    """Columns a line needs for ``sums`` of an amount: its ten-thousandths, or its rest."""
    amount = finite(c, kind).cast("double")
    near = F.when(F.abs(amount) < MOST, F.rint(amount * UNITS))
    whole = F.when(near / UNITS == amount, near.cast("bigint"))
    return {f"_{c}_units": whole, f"_{c}_rest": F.when(whole.isNull(), amount.cast(REST))}


def sums(c: str, kind: T.DataType, name: str, condition: Column | None = None) -> list[Column]:
    """Aggregates of an amount over lines, or over those a condition holds for: others
    count 0, and the sum is missing only if no line has a value."""

    def added(value: Column, otherwise: int | None = 0) -> Column:
        if condition is None:
            return F.sum(value)
        chosen = F.when(condition, value)
        return F.sum(chosen if otherwise is None else chosen.otherwise(F.lit(otherwise)))

    if not in_parts(kind):
        value = F.col(c).cast("bigint") if isinstance(kind, T.IntegralType) else F.col(c)
        return [added(value).alias(name)]
    units = F.col(f"_{c}_units")
    return [
        added(F.shiftright(units, LOW_BITS)).alias(f"{name}_high"),
        added(units.bitwiseAND(F.lit((1 << LOW_BITS) - 1))).alias(f"{name}_low"),
        added(F.col(f"_{c}_rest"), None).alias(f"{name}_rest"),
    ]


def merged(name: str, columns: list[str]) -> list[Column]:
    """Sums of sums, by whatever columns ``sums`` has made."""
    held = [name] if name in columns else [f"{name}_{part}" for part in PARTS]
    return [F.sum(one).alias(one) for one in held]


def total(name: str, columns: list[str]) -> Column:
    """The amount the sums stand for; missing if none of them has a value."""
    if name in columns:
        return F.col(name)
    high, low, rest = (F.col(f"{name}_{part}") for part in PARTS)
    # Nearly always there is no rest and the count fits the short decimals.
    short = rest.isNull() & high.between(-MOST_HIGH, MOST_HIGH) & low.between(0, MOST_LOW)
    count = (F.shiftleft(high, LOW_BITS) + low).cast("decimal(18,0)")
    units = high.cast("decimal(20,0)") * F.lit(1 << LOW_BITS).cast("decimal(7,0)") + low.cast("decimal(20,0)")
    amount = (units * F.lit("0.0001").cast("decimal(4,4)")).cast(FEW)
    both = F.coalesce(amount, F.lit(0).cast(FEW)) + F.coalesce(rest.cast(REST), F.lit(0).cast(REST))
    found = F.when(high.isNotNull() | rest.isNotNull(), both.cast(TOTAL))
    return F.when(short, (count * F.lit("0.0001").cast("decimal(4,4)")).cast(TOTAL)).otherwise(found).alias(name)
