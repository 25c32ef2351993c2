"""Tables that grow by whole nights and show a night only once it is complete.

    <table>/load=<id>/snapshot_date=<night>/part-*   the rows, written once, in place
    <table>/_nights/load=<id>/part-*                 the record: one line per night

The record of a load is a single small file, written last, after the rows were
counted again where they lie. Readers take the nights from the records and open
only the folders these name, so a load that dies at any point, or is copied file
by file into an object store, shows nothing; the next load writes a folder of
its own. Of several loads of one night the last recorded one holds. Nothing is
renamed or deleted while a load runs; ``sweep`` removes what no record names.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfscout.operators.latest import first_per_key
from shelfscout.session import folder_names, remove_folder

RECORDS = "_nights"
RECORD = "snapshot_date date, row_count long, recorded_at timestamp, load string"


class SnapshotError(RuntimeError):
    """The load stopped before or after the write because something did not add up."""


def _records(spark: SparkSession, table: str) -> DataFrame:
    """Every record line; none if the table does not exist yet."""
    records = f"{table.rstrip('/')}/{RECORDS}"
    if not folder_names(spark, records):
        return spark.createDataFrame([], RECORD)
    return spark.read.schema(RECORD).json(records)


def held_nights(spark: SparkSession, table: str) -> DataFrame:
    """``snapshot_date``, ``row_count``, ``recorded_at``, ``load`` of every night held.
    Only records are read."""
    order = [F.col("recorded_at").desc(), F.col("load").desc()]
    return first_per_key(_records(spark, table), ["snapshot_date"], order)


def read_nights(
    spark: SparkSession, table: str, nights: Iterable[dt.date] | None = None, schema: str | None = None
) -> DataFrame:
    """The rows of the nights held, or of those among them that are asked for.

    Only the folders of these nights are listed; nights and folders are what
    reaches the driver. Without any row the result is empty if a ``schema`` is
    given, and an error otherwise.
    """
    root, held = table.rstrip("/"), held_nights(spark, table).where("row_count > 0")
    if nights is not None:
        held = held.where(F.col("snapshot_date").isin(list(nights)))
    found = held.orderBy("snapshot_date").collect()
    if found:
        folders = [f"{root}/load={row.load}/snapshot_date={row.snapshot_date}" for row in found]
        return spark.read.option("basePath", root).parquet(*folders).drop("load")
    if schema is None:
        raise SnapshotError(f"{table}: none of the nights asked for holds a row")
    return spark.createDataFrame([], schema)


def commit_load(
    rows: DataFrame, table: str, nights: Iterable[dt.date] = (), load: str | None = None, new_only: bool = False
) -> dict[dt.date, int]:
    """Write ``rows`` as one load and record its nights; returns their rows.

    ``nights`` are recorded even if they have no row. With a ``load`` name of its
    own a load can be repeated: it replaces what an earlier try left. With
    ``new_only`` a night that another load holds stops the load.
    """
    spark, root = rows.sparkSession, table.rstrip("/")
    load = load or f"l{uuid.uuid4().hex}"
    folder = f"{root}/load={load}"
    sent = Observation()
    counted = rows.observe(sent, F.count(F.lit(1)).alias("row_count"))
    counted.write.mode("overwrite").partitionBy("snapshot_date").parquet(folder)
    landed = dict.fromkeys(nights, 0) | _count(spark, folder, rows.schema, sent.get["row_count"])
    if new_only:
        taken = held_nights(spark, root).where(
            (F.col("load") != load) & F.col("snapshot_date").isin(list(landed))
        )
        if again := [str(row.snapshot_date) for row in taken.collect()]:
            raise SnapshotError(f"{table}: several files for one night: {again}")
    _record(spark, root, load, landed)
    return landed


def commit_empty(spark: SparkSession, table: str, nights: Iterable[dt.date]) -> None:
    """Record nights that have no row."""
    _record(spark, table.rstrip("/"), f"l{uuid.uuid4().hex}", dict.fromkeys(nights, 0))


def _count(spark: SparkSession, folder: str, schema: T.StructType, sent: int) -> dict[dt.date, int]:
    """Rows of a load by night, counted where they lie, held against what was sent."""
    landed: dict[dt.date, int] = {}
    if sent:
        stored = spark.read.schema(schema).parquet(folder)
        landed = {row.snapshot_date: row["count"] for row in stored.groupBy("snapshot_date").count().collect()}
    if sum(landed.values()) != sent:
        raise SnapshotError(f"{folder}: sent {sent:,} rows, the destination holds {sum(landed.values()):,}")
    return landed


def _record(spark: SparkSession, root: str, load: str, landed: dict[dt.date, int]) -> None:
    """One file, so that a load is recorded as a whole or not at all."""
    now = dt.datetime.now(dt.UTC)
    lines = [(night, count, now) for night, count in sorted(landed.items())]
    record = spark.createDataFrame(lines, RECORD.removesuffix(", load string"))
    record.coalesce(1).write.mode("overwrite").json(f"{root}/{RECORDS}/load={load}")


def recount(spark: SparkSession, table: str, nights: Iterable[dt.date] | None = None) -> DataFrame:
    """Nights whose rows at the destination are not as many as recorded:
    ``snapshot_date``, ``row_count``, ``landed``. Folders that are gone count 0."""
    held, root = held_nights(spark, table), table.rstrip("/")
    if nights is not None:
        held = held.where(F.col("snapshot_date").isin(list(nights)))
    loads = [row.load for row in held.select("load").distinct().collect()]
    if not loads:
        return held.select("snapshot_date", "row_count", F.lit(0).cast("long").alias("landed"))
    # No column but those of the folder names: no file of a load that died is opened for its schema.
    stored = spark.read.schema("load string, snapshot_date date").parquet(root).where(F.col("load").isin(loads))
    counts = stored.groupBy("load", "snapshot_date").agg(F.count(F.lit(1)).alias("landed"))
    both = held.join(counts, ["load", "snapshot_date"], "left")
    landed = F.coalesce("landed", F.lit(0))
    return both.where(landed != F.col("row_count")).select("snapshot_date", "row_count", landed.alias("landed"))


def sweep(spark: SparkSession, table: str) -> int:
    """Delete load folders that hold no night any more: loads that died, and
    loads all of whose nights were loaded again. Not while a load runs."""
    root = table.rstrip("/")
    held = {f"load={row.load}" for row in held_nights(spark, root).select("load").distinct().collect()}
    stale = [name for name in folder_names(spark, root) if name.startswith("load=") and name not in held]
    for name in stale:
        # The record first: a sweep that stops half way leaves no record without rows.
        remove_folder(spark, f"{root}/{RECORDS}/{name}")
        remove_folder(spark, f"{root}/{name}")
    return len(stale)
