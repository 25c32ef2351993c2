"""A derived state that takes in every file of a growing Parquet folder once.

    <state>/load=<id>/part-*          what was derived from the files of one load
    <state>/_files/load=<id>/part-*   the record: those files, and how it was derived

What is derived has to merge: the loads together stand for the whole folder. As
with ``sources.nights`` the record is one file, written last, and only recorded
loads are read. ``made_by`` names the way of deriving; loads made another way do
not count, so a change of it takes in all files again.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfscout.session import folder_names

RECORDS = "_files"
RECORD = "path string, length long, modified timestamp, made_by string, load string"
FILE = ["path", "length", "modified"]


class ChangedSourceError(RuntimeError):
    """Files that were taken in are gone or not what they were: the state needs a rebuild."""


def list_files(spark: SparkSession, source: str) -> DataFrame:
    """``path``, ``length``, ``modified`` of the data files below a folder, and the
    columns its subfolders are named by. Only the listing is read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(source)
    return files.withColumnRenamed("modificationTime", "modified").drop("content")


def records(spark: SparkSession, state: str, made_by: str) -> DataFrame:
    path = f"{state.rstrip('/')}/{RECORDS}"
    if not folder_names(spark, path):
        return spark.createDataFrame([], RECORD)
    return spark.read.schema(RECORD).json(path).where(F.col("made_by") == made_by)


def pending_files(spark: SparkSession, source: str, state: str, made_by: str) -> DataFrame:
    """Files of the folder that the state does not hold yet."""
    known, offered = records(spark, state, made_by), list_files(spark, source)
    lost = known.join(offered, FILE, "left_anti").first()
    if lost:
        raise ChangedSourceError(f"{lost.path} was taken in and is gone or has changed; rebuild {state}")
    return offered.join(known, FILE, "left_anti")


def take_in(
    spark: SparkSession, source: str, state: str, made_by: str, derive: Callable[[DataFrame], DataFrame]
) -> int:
    """Derive from the files the state lacks, and from no others; returns how many."""
    root = state.rstrip("/")
    files = pending_files(spark, source, state, made_by).select(*FILE).collect()
    if not files:
        return 0
    load = f"l{uuid.uuid4().hex}"
    rows = spark.read.option("basePath", source).parquet(*[file.path for file in files])
    derive(rows).write.parquet(f"{root}/load={load}")
    record = spark.createDataFrame([(*file, made_by) for file in files], RECORD.removesuffix(", load string"))
    record.coalesce(1).write.json(f"{root}/{RECORDS}/load={load}")
    return len(files)


def loads_of(spark: SparkSession, state: str, made_by: str) -> list[str]:
    return sorted(row.load for row in records(spark, state, made_by).select("load").distinct().collect())


def read_state(spark: SparkSession, state: str, made_by: str) -> DataFrame:
    """What was derived so far, all loads together."""
    root = state.rstrip("/")
    return spark.read.parquet(*[f"{root}/load={load}" for load in loads_of(spark, state, made_by)])
