"""Dated exports as a stream: each run picks up only the files it has not seen.

What was read is the state of the stream's checkpoint; what has landed, batch by
batch, is in the records of the destination (``sources.nights``), which may be
the one ``sources.snapshots.sync_feed`` loads as long as each night comes once.
"""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from shelfscout.sources.nights import SnapshotError, commit_load, recount
from shelfscout.sources.snapshots import (
    LINEAGE,
    check_destination_columns,
    csv_options,
    raw_schema,
    with_lineage,
)


def snapshot_stream(
    spark: SparkSession, root: str, feed: str, columns: list[str], multi_line: bool = False
) -> DataFrame:
    """New files of one feed, all text, with lineage; line layout as for the batch load."""
    files = (
        spark.readStream.schema(raw_schema(columns))
        .options(**csv_options(multi_line))
        .option("pathGlobFilter", f"crm_{feed}_*.csv")
        .csv(root)
    )
    return with_lineage(files)


def stream_name(spark: SparkSession, checkpoint: str) -> str:
    """The stream's own id, which its checkpoint keeps over restarts."""
    text = spark.read.text(f"{checkpoint}/metadata").first().value
    return json.loads(text)["id"]


def run_available(stream: DataFrame, table: str, checkpoint: str) -> StreamingQuery:
    """Load whatever has arrived, exactly once, then stop.

    Every batch is a load of its own in the destination, named by the stream and
    the batch and recorded with its nights and rows, so a batch that runs again
    after a crash replaces itself. A batch is counted where it lies before it is
    recorded; at the end all nights this run recorded are counted once more.
    Like the batch load it refuses columns the destination does not have, and a
    second file for a night.
    """
    spark = stream.sparkSession
    check_destination_columns(spark, table, [c for c in stream.columns if c not in LINEAGE])
    nights: set[dt.date] = set()

    def land(batch: DataFrame, number: int) -> None:
        load = f"s{stream_name(spark, checkpoint)}-{number:09d}"
        nights.update(commit_load(batch, table, load=load, new_only=True))

    query = (
        stream.writeStream.foreachBatch(land)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    lost = recount(spark, table, nights).first() if nights else None
    if lost:
        raise SnapshotError(
            f"{table}: {lost.snapshot_date}: {lost.row_count:,} rows recorded, {lost.landed:,} at the destination"
        )
    return query
