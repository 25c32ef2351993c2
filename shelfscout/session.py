"""Session settings and the shared folder for written intermediates."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
# Folders written inside each open ``scratch`` block, innermost last.
_written: list[list[str]] = []


def local_session(
    app: str = "shelfscout",
    cores: int | str = "*",
    shuffle_partitions: int = 8,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """A single-JVM session for tests and the bench. On a cluster, submit with
    your own settings; the library reads nothing from here."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
    )
    for key, value in (conf or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder: on a cluster the
    executors would each write to a disk the others cannot read.
    """
    folder = spark.conf.get(CHECKPOINT_DIR, None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    folder = context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder shared by all executors")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="shelfscout-"))
        folder = context.getCheckpointDir()
    return folder.rstrip("/")


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and continue from the files.

    Cuts the lineage, survives lost executors, and gives the planner real sizes
    and column pruning for everything that reads the result.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    if _written:
        _written[-1].append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever file system its path names."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders right below a path; none if it does not exist."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = root.getFileSystem(spark._jsc.hadoopConfiguration())
    found = system.listStatus(root) if system.exists(root) else []
    return sorted(one.getPath().getName() for one in found if one.isDirectory())


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Deletes at its end what ``materialise`` wrote inside it, and nothing else.

    For jobs that leave tables behind; a frame read from those folders is of no
    use afterwards.
    """
    _written.append([])
    try:
        yield
    finally:
        for path in _written.pop():
            remove_folder(spark, path)
