"""Incremental load of dated full-snapshot CSV exports.

A feed arrives as one file per night, ``crm_<feed>_<date>.csv``. The destination
is a table of nights (``sources.nights``): every source column as text plus the
lineage columns, a night visible once its record is written.

Line layout is a property of the feed, stated by the caller and the same at any
file size. Rows end in LF or CRLF; a carriage return anywhere else stops the load.
With ``multi_line`` quoted values may hold line breaks and a file is one task's
work; without it, the default, files are read in splits and a quoted line break
stops the load.

Unquoted empty CSV fields arrive as NULL rather than ''; staging treats both the same.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfscout.functions.cleaning import row_hash
from shelfscout.sources.nights import SnapshotError, commit_load, held_nights, read_nights

# Fixed value: layout of an export file name.
SNAPSHOT_FILE = r"^crm_(\w+)_(\d{4}-\d{2}-\d{2})\.csv$"
FEEDS = ("accounts", "contacts", "opportunities")
LINEAGE = ("snapshot_date", "_source_file", "_loaded_at", "_row_hash")


def base_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)$", 1)


def snapshot_date_of(path: Column) -> Column:
    """Night of an export from its file name or path; NULL if it is no export."""
    return F.try_to_date(F.regexp_extract(base_name(path), SNAPSHOT_FILE, 2), "yyyy-MM-dd")


def require_snapshot_date(path: Column) -> Column:
    """The same, failing on any other name: a file without a date must not load."""
    problem = F.concat(F.lit("not a recognised export file name: "), path)
    return F.coalesce(snapshot_date_of(path), F.raise_error(problem).cast("date"))


def list_snapshots(spark: SparkSession, root: str, feed: str) -> DataFrame:
    """Night, path and size of every export of a feed. Only the listing is read."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", f"crm_{feed}_*.csv")
        .load(root)
        .select("path", "length")
    )
    return files.select(
        require_snapshot_date(F.col("path")).alias("snapshot_date"),
        F.col("path").alias("uri"),
        "length",
    )


def missing_snapshots(available: DataFrame, loaded: DataFrame) -> DataFrame:
    """Offered nights not held yet, oldest first. A night held but no longer
    offered stays held and does not come back."""
    return available.join(loaded.select("snapshot_date"), "snapshot_date", "left_anti").orderBy(
        "snapshot_date"
    )


def loaded_snapshots(spark: SparkSession, table: str) -> DataFrame:
    """Nights in the destination; none if it does not exist yet. Only records are read."""
    return held_nights(spark, table).select("snapshot_date")


def csv_options(multi_line: bool) -> dict[str, str]:
    """How every reader of exports reads them: header, batch and stream.

    ``enforceSchema`` off compares every file's header with the columns, names
    and order; by default Spark would silently swap reordered columns. A row with
    too few or too many fields fails the load rather than losing a value.
    """
    return {
        "header": "true",
        "enforceSchema": "false",
        "multiLine": str(multi_line).lower(),
        "escape": '"',
        "ignoreLeadingWhiteSpace": "false",
        "ignoreTrailingWhiteSpace": "false",
        "mode": "FAILFAST",
    }


def header_of(spark: SparkSession, path: str, multi_line: bool = False) -> list[str]:
    """Column names of one CSV file; only its first row is read."""
    return spark.read.options(**csv_options(multi_line)).csv(path).columns


def raw_schema(columns: list[str]) -> T.StructType:
    """Every source column as text: type guesses may differ from file to file."""
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def layout_breaches(spark: SparkSession, paths: list[str], multi_line: bool = False) -> DataFrame:
    """Lines that break the stated layout, with file and reason. Reads plain lines, in splits."""
    line = F.regexp_replace("value", "\r$", "")
    quotes = F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))
    reason = F.when(F.contains(line, F.lit("\r")), "a carriage return that ends no row")
    if not multi_line:
        reason = reason.when(quotes % 2 == 1, "a line break inside a quoted value; the feed needs multi_line")
    lines = spark.read.option("lineSep", "\n").text(paths)
    return lines.select(F.col("_metadata.file_path").alias("file"), reason.alias("reason")).where("reason is not null")


def check_layout(spark: SparkSession, paths: list[str], multi_line: bool = False) -> None:
    breach = layout_breaches(spark, paths, multi_line).first()
    if breach:
        raise SnapshotError(f"{breach.file}: {breach.reason}")


def read_snapshot_csv(
    spark: SparkSession, paths: list[str], columns: list[str], multi_line: bool = False
) -> DataFrame:
    """All files in one scan, values untouched."""
    return spark.read.schema(raw_schema(columns)).options(**csv_options(multi_line)).csv(paths)


def with_lineage(df: DataFrame) -> DataFrame:
    """Night, file and load time of every row, from the file itself, and a hash
    of the row, which later settles ties without reading its columns."""
    uri = F.col("_metadata.file_path")
    return df.select(
        *df.columns,
        require_snapshot_date(uri).alias("snapshot_date"),
        uri.alias("_source_file"),
        F.current_timestamp().alias("_loaded_at"),
        row_hash(df.columns).alias("_row_hash"),
    )


def check_destination_columns(spark: SparkSession, table: str, columns: list[str]) -> None:
    """Fail if the export's columns are not those the destination already has.

    The reader compares files with each other; drift between two runs shows up
    only against what is stored.
    """
    newest = held_nights(spark, table).where("row_count > 0").agg(F.max("snapshot_date")).first()[0]
    if newest is None:
        return
    stored = [c for c in read_nights(spark, table, [newest]).columns if c not in LINEAGE]
    if stored != columns:
        raise SnapshotError(f"column drift: {table} holds {stored}, the export has {columns}")


def sync_feed(
    spark: SparkSession, root: str, feed: str, table: str, multi_line: bool = False
) -> int:
    """Load the nights of one feed that ``table`` lacks; returns how many.

    One job for the whole gap, written once, in place, counted there and only
    then recorded. A load that stops anywhere before that leaves the nights of
    the destination as they were, and the next run loads the same ones. Only
    nights and paths reach the driver.
    """
    offered = list_snapshots(spark, root, feed)
    gap = missing_snapshots(offered, loaded_snapshots(spark, table)).collect()
    if not gap:
        return 0
    nights, paths = [row.snapshot_date for row in gap], [row.uri for row in gap]
    if len(set(nights)) != len(nights):
        raise SnapshotError(f"{feed}: several files for one night")
    check_layout(spark, paths, multi_line)
    columns = header_of(spark, paths[0], multi_line)
    check_destination_columns(spark, table, columns)
    commit_load(with_lineage(read_snapshot_csv(spark, paths, columns, multi_line)), table, nights)
    return len(nights)


def snapshot_counts(df: DataFrame) -> DataFrame:
    """Rows per night."""
    return df.groupBy("snapshot_date").agg(F.count(F.lit(1)).alias("row_count"))


def snapshot_inventory(df: DataFrame) -> DataFrame:
    """Nights and rows held, as one row."""
    return df.agg(
        F.count_distinct("snapshot_date").alias("snapshots"),
        F.count(F.lit(1)).alias("row_count"),
    )
