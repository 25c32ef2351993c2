"""Derived tables: replace, build once, lay out by key, and a ceiling on what a job may read."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS = 64
# Schemes that Arrow spells differently.
ARROW_SCHEMES = {"s3a": "s3", "s3n": "s3"}


class ScanBudgetError(RuntimeError):
    """The selected input is larger than the ceiling allows."""


def replace_table(spark: SparkSession, path: str, table: str) -> None:
    """Full replace from a Parquet file, which brings its own schema."""
    spark.read.parquet(path).write.mode("overwrite").saveAsTable(table)


def build_table(
    spark: SparkSession,
    build: Callable[[], DataFrame],
    table: str,
    force: bool = False,
    key: str | None = None,
    buckets: int = BUCKETS,
) -> bool:
    """Build a derived table unless it exists; True if it was built. With a
    ``key`` it is laid out for joins on that key, in as many ``buckets`` as keep
    one of them small enough for a task."""
    if spark.catalog.tableExists(table) and not force:
        return False
    if key:
        write_clustered(build(), table, key, buckets)
    else:
        build().write.mode("overwrite").saveAsTable(table)
    return True


def selected_bytes(
    spark: SparkSession, path: str, glob: str | None = None, condition: Column | None = None
) -> int:
    """Size of the input files. Without a condition from the listing alone; with
    one, of the Parquet files that hold rows it selects, whole files at a time:
    partitions it rules out are not opened, of the rest only its columns are read."""
    if condition is not None:
        files = spark.read.parquet(path).where(condition).select("_metadata.file_path", "_metadata.file_size")
        return files.distinct().agg(F.sum("file_size").alias("total")).first().total or 0
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        listing = listing.option("pathGlobFilter", glob)
    return listing.load(path).agg(F.sum("length").alias("total")).first().total or 0


def _uri(path: str) -> str:
    scheme, rest = path.split(":", 1)
    if scheme == "file":
        return "file:///" + rest.lstrip("/")
    return f"{ARROW_SCHEMES.get(scheme, scheme)}:{rest}"


def _chunk_bytes(path: str, columns: set[str], column: str | None, least: Any) -> int:
    """Stored bytes of the columns in the row groups that may hold a value from ``least`` on."""
    from pyarrow import fs
    from pyarrow import parquet as pq

    system, name = fs.FileSystem.from_uri(_uri(path))
    total = 0
    with system.open_input_file(name) as file:
        meta = pq.ParquetFile(file).metadata
        for group in (meta.row_group(i) for i in range(meta.num_row_groups)):
            chunks = [group.column(i) for i in range(group.num_columns)]
            if column is not None:
                held = [c.statistics for c in chunks if c.path_in_schema == column]
                most = held[0].max if held and held[0] is not None and held[0].has_min_max else None
                if isinstance(most, dt.datetime):
                    most = most.date()
                if most is not None and most < least:
                    continue
            total += sum(c.total_compressed_size for c in chunks if c.path_in_schema.split(".")[0] in columns)
    return total


def column_bytes(
    spark: SparkSession,
    files: DataFrame,
    columns: list[str],
    since: tuple[str, dt.date] | None = None,
) -> int:
    """Stored bytes a scan of these columns reads, from the files' footers.

    ``files`` has ``path`` and ``length``, as a listing gives them; only footers
    are read, by tasks. With ``since``, a date column and its first wanted day,
    row groups that end before it do not count; a listing that knows the column
    from its folders leaves whole files out. A file in a store Arrow cannot open
    counts whole, so the estimate is never too low.
    """
    column, least = since or (None, None)
    if column in files.columns:
        files = files.where(F.col(column) >= F.lit(least))
        column = None
    wanted = set(columns)

    def task(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            sizes = []
            for path, length in zip(part.column("path").to_pylist(), part.column("length").to_pylist(), strict=True):
                try:
                    sizes.append(_chunk_bytes(path, wanted, column, least))
                except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError):
                    sizes.append(length)
            yield pa.record_batch([pa.array(sizes, pa.int64())], names=["size"])

    # A listing has about one partition per file.
    listing = files.select("path", "length").coalesce(4 * spark.sparkContext.defaultParallelism)
    return listing.mapInArrow(task, "size long").agg(F.sum("size").alias("total")).first().total or 0


def check_budget(selected: int, ceiling: int, path: str = "the input") -> None:
    """A ceiling of 0 means none."""
    if ceiling and selected > ceiling:
        raise ScanBudgetError(
            f"{path}: {selected:,} bytes selected, {ceiling:,} allowed; raise scan_ceiling_bytes or select less"
        )


def check_scan_budget(
    spark: SparkSession,
    path: str,
    ceiling: int,
    glob: str | None = None,
    condition: Column | None = None,
) -> int:
    """Stop a job before it starts; returns the bytes of the files it would read."""
    selected = selected_bytes(spark, path, glob, condition)
    check_budget(selected, ceiling, path)
    return selected


def write_clustered(df: DataFrame, table: str, key: str, buckets: int = BUCKETS) -> None:
    """Create or replace a table bucketed and sorted by its join key, so that
    joins and groupings on the key need no shuffle."""
    (
        df.repartition(buckets, key)
        .write.mode("overwrite")
        .bucketBy(buckets, key)
        .sortBy(key)
        .saveAsTable(table)
    )


def mark(spark: SparkSession, table: str, name: str, value: str) -> None:
    """Set a property of a table. Replacing the table drops it."""
    quoted = value.replace("'", "\\'")
    spark.sql(f"alter table {table} set tblproperties ('{name}' = '{quoted}')")


def marked(spark: SparkSession, table: str, name: str) -> str | None:
    """A property of a table; None without it, or without the table."""
    if not spark.catalog.tableExists(table):
        return None
    found = spark.sql(f"show tblproperties {table}").where(F.col("key") == name).first()
    return found.value if found else None


def read_ranked(spark: SparkSession, table: str) -> DataFrame:
    """A ranked mart, best first."""
    return spark.table(table).orderBy("target_rank")
