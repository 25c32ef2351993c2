"""A dense 1..N rank over the whole table without a one-task window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfscout.session import materialise

# monotonically_increasing_id puts the partition in the upper 31 bits and the
# position inside it in the lower 33.
POSITION_BITS = 33


def number_rows(df: DataFrame, order: list[Column], name: str, label: str = "rank") -> DataFrame:
    """Number all rows 1..N in ``order``, which has to be total.

    Rows are written before they are range-partitioned: the bounds come from a
    sample, and sampling ``df`` itself would compute it twice. They are dealt by
    the full order, so equal leading keys (a tier holding most accounts, say)
    still split on the trailing ones. Each range is sorted and its positions are
    written together with the rows; the write pins them, because sampled bounds
    may differ on a rerun. What remains is one count per range, small by
    construction, and an addition per row.
    """
    positioned = (
        materialise(df, f"{label}-input")
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_at", F.monotonically_increasing_id())
    )
    stored = materialise(positioned, label)
    part = F.shiftright("_at", POSITION_BITS)
    position = F.col("_at").bitwiseAND(F.lit((1 << POSITION_BITS) - 1))
    sizes = stored.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset")
    )
    # One row per shuffle partition, so the broadcast does not grow with the data.
    return (
        stored.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_offset") + position + 1)
        .drop("_part", "_at", "_offset")
    )
