"""Shards of near-equal bytes from global prefix sums.

Rows are laid out in one global order, cut into ranges; the ranges' total bytes
and rows give every range its offset, and a running sum inside the range does
the rest. A shard is the part of the global byte line that a row's middle falls
in, so shards are contiguous and their sizes differ by no more than the rows at
their edges. Built-in functions only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfscout.llm.common import text_of
from shelfscout.session import materialise

EXTRA = 16
# Rows in a range at most, on average, and ranges a pass of the offsets holds together.
ROWS, GROUP = 20_000, 1000


def byte_shards(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``id``, ``size``, ``text_crc32``, ``shard``, ``slot``.

    Size: the text's UTF-8 bytes (null: none) plus 16. The order is that of a
    hash of id and text, so neighbours are unrelated and reruns agree; a null id
    is a value like any other, and rows equal in id and text are interchangeable.
    ``slot`` counts a shard's rows from 0 without gaps. More shards than rows
    leave some empty; an empty table gives no rows. Other columns are not read.
    A text of any length is one row of one shard, which it may exceed.
    """
    if shards < 1:
        raise ValueError("at least one shard")
    text = text_of(text_col)
    rows = materialise(
        docs.select(
            F.col(f"`{id_col}`").alias("id"),
            (F.octet_length(text) + EXTRA).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.xxhash64(F.col(f"`{id_col}`"), text).alias("order"),
        ),
        "shard-rows",
    )
    # The hash is even, so equal slices of its range hold near-equal numbers of rows.
    ranges = max(1, -(-rows.count() // ROWS)) * 4
    width = -(-(1 << 64) // ranges)
    at = F.floor(F.col("order").cast("decimal(20,0)") / F.lit(width).cast("decimal(20,0)"))
    rows = rows.withColumn("range", at.cast("long"))

    totals = rows.groupBy("range").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))
    totals = materialise(totals.withColumn("group", F.floor(F.col("range") / GROUP)), "range-totals")
    offsets = _offsets(totals)
    whole = totals.agg(F.sum("bytes")).first()[0]

    running = Window.partitionBy("range").orderBy("order", "id").rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        rows.withColumn("ahead", F.coalesce(F.sum("size").over(running), F.lit(0)))
        .withColumn("place", F.row_number().over(Window.partitionBy("range").orderBy("order", "id")) - 1)
        .join(offsets, "range")
    )
    middle = 2 * (F.col("bytes_before") + F.col("ahead")) + F.col("size")
    share = (middle.cast("decimal(38,0)") * shards / F.lit(2 * (whole or 1)).cast("decimal(20,0)")).cast("double")
    placed = placed.select(
        "id",
        "size",
        "text_crc32",
        F.least(F.floor(share), F.lit(shards - 1)).cast("int").alias("shard"),
        (F.col("rows_before") + F.col("place")).alias("index"),
    )
    placed = materialise(placed, "shard-places")
    # One row per shard.
    first = placed.groupBy("shard").agg(F.min("index").alias("first"))
    return placed.join(F.broadcast(first), "shard").select(
        "id", "size", "text_crc32", "shard", (F.col("index") - F.col("first")).alias("slot")
    )


def _offsets(totals: DataFrame) -> DataFrame:
    """Bytes and rows before each range: within groups of ranges, then over the groups."""
    groups = totals.groupBy("group").agg(F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows"))
    ahead = Window.orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.select(
        "group",
        F.coalesce(F.sum("bytes").over(ahead), F.lit(0)).alias("group_bytes"),
        F.coalesce(F.sum("rows").over(ahead), F.lit(0)).alias("group_rows"),
    )
    within = Window.partitionBy("group").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    return totals.join(groups, "group").select(
        "range",
        (F.col("group_bytes") + F.coalesce(F.sum("bytes").over(within), F.lit(0))).alias("bytes_before"),
        (F.col("group_rows") + F.coalesce(F.sum("rows").over(within), F.lit(0))).alias("rows_before"),
    )
