"""Dated CSV exports into a partitioned table, as a batch and as a stream."""

import datetime as dt

import pytest
from conftest import rows
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from shelfscout.sources import nights as tables_of_nights
from shelfscout.sources import increments, snapshots, tables
from shelfscout.sources.nights import read_nights
from shelfscout.streaming import snapshot_stream

HEADER = "account_id,account_name,city"


def write(root, night, lines, feed="accounts", header=HEADER, name=None):
    root.mkdir(exist_ok=True)
    path = root / (name or f"crm_{feed}_{night}.csv")
    path.write_text("\n".join([header, *lines]) + "\n")


@pytest.fixture
def landing(tmp_path):
    root = tmp_path / "landing"
    write(root, "2025-11-04", ['A1,"Bar, Grill ",', "A2,  ,Ames"])
    write(root, "2025-11-05", ['A1,"two\nlines",Waukee'])
    write(root, "2025-11-04", ["x,y,z"], feed="contacts")
    (root / "crm_accounts_notes.txt").write_text("not a csv")
    return root


def dates_of(spark, names, extract=snapshots.snapshot_date_of):
    df = spark.createDataFrame([(n,) for n in names], "name string")
    return [r[0] for r in df.select(extract(F.col("name"))).collect()]


def test_date_from_name_or_path(spark):
    assert dates_of(
        spark,
        ["crm_accounts_2025-11-04.csv", "crm/crm_opportunities_2026-05-02.csv", "s3a://b/crm/crm_x_2025-01-31.csv"],
    ) == [dt.date(2025, 11, 4), dt.date(2026, 5, 2), dt.date(2025, 1, 31)]


@pytest.mark.parametrize(
    "name",
    ["product_catalogue.parquet", "crm_accounts.csv", "crm_accounts_2025-11.csv",
     "crm_accounts_2025-11-04.txt", "crm_accounts_2025-13-04.csv"],
)
def test_other_names_give_no_date_and_raise_when_one_is_required(spark, name):
    assert dates_of(spark, [name]) == [None]
    with pytest.raises(PySparkException, match="not a recognised export"):
        dates_of(spark, [name], snapshots.require_snapshot_date)


def nights(spark, *days):
    return spark.createDataFrame([(dt.date.fromisoformat(d),) for d in days], "snapshot_date date")


@pytest.mark.parametrize(
    ("offered", "held", "gap"),
    [
        (["2025-11-04", "2025-11-05"], [], ["2025-11-04", "2025-11-05"]),
        (["2025-11-04"], ["2025-11-04"], []),
        (["2025-11-06", "2025-11-04", "2025-11-05"], ["2025-11-04"], ["2025-11-05", "2025-11-06"]),
        (["2025-11-05"], ["2025-11-04", "2025-11-05"], []),
    ],
)
def test_gap(spark, offered, held, gap):
    found = snapshots.missing_snapshots(nights(spark, *offered), nights(spark, *held))
    assert [str(r[0]) for r in found.collect()] == gap


def test_listing_takes_one_feed(spark, landing):
    listed = snapshots.list_snapshots(spark, str(landing), "accounts")
    assert listed.where("length > 0").count() == 2
    assert [r.uri.rsplit("/", 1)[-1] for r in listed.orderBy("snapshot_date").collect()] == [
        "crm_accounts_2025-11-04.csv", "crm_accounts_2025-11-05.csv",
    ]


def test_listing_refuses_an_undated_csv(spark, landing):
    write(landing, "", ["A1,x,y"], name="crm_accounts_latest.csv")
    with pytest.raises(PySparkException, match="not a recognised export"):
        snapshots.list_snapshots(spark, str(landing), "accounts").collect()


def test_sync_loads_the_gap_once(spark, landing, tmp_path):
    table = str(tmp_path / "raw" / "accounts_snapshots")
    assert snapshots.loaded_snapshots(spark, table).count() == 0
    assert snapshots.sync_feed(spark, str(landing), "accounts", table, multi_line=True) == 2
    held = read_nights(spark, table)
    assert held.dtypes == [
        ("account_id", "string"), ("account_name", "string"), ("city", "string"),
        ("_source_file", "string"), ("_loaded_at", "timestamp"), ("_row_hash", "string"), ("snapshot_date", "date"),
    ]
    assert rows(held.select("account_id", "account_name", "city", F.col("snapshot_date").cast("string"))) == rows(
        spark.createDataFrame(
            [("A1", "Bar, Grill ", None, "2025-11-04"), ("A2", "  ", "Ames", "2025-11-04"),
             ("A1", "two\nlines", "Waukee", "2025-11-05")],
            "a string, b string, c string, d string",
        )
    )
    names = {r[0].rsplit("/", 1)[-1] for r in held.select("_source_file").collect()}
    assert names == {"crm_accounts_2025-11-04.csv", "crm_accounts_2025-11-05.csv"}
    assert snapshots.sync_feed(spark, str(landing), "accounts", table) == 0
    write(landing, "2025-11-06", ["A1,x,y", "A2,x,y", "A3,x,y"])
    assert snapshots.sync_feed(spark, str(landing), "accounts", table) == 1
    counts = snapshots.snapshot_counts(read_nights(spark, table))
    assert rows(counts.select(F.col("snapshot_date").cast("string"), "row_count")) == [
        ("2025-11-04", 2), ("2025-11-05", 1), ("2025-11-06", 3),
    ]
    assert rows(snapshots.snapshot_inventory(read_nights(spark, table))) == [(3, 6)]


LAYOUTS = {
    "lf": (b"A1,x,y\nA2,x,y\n", [("A1", "x", "y"), ("A2", "x", "y")]),
    "crlf": (b"A1,x,y\r\nA2,x,y\r\n", [("A1", "x", "y"), ("A2", "x", "y")]),
    "escaped quote": (b'A1,"say ""hi"", x",y\n', [("A1", 'say "hi", x', "y")]),
    "lone cr in a value": (b"A1,x\rz,y\n", "carriage return"),
    "lone cr as a row end": (b"A1,x,y\rA2,x,y\n", "carriage return"),
    "quoted line break": (b'A1,"x\nz",y\n', "line break inside"),
}


@pytest.mark.parametrize("many", [1, 20_000])
@pytest.mark.parametrize("layout", LAYOUTS)
def test_line_layout_gives_the_same_at_any_size(spark, tmp_path, layout, many):
    """The file is far above or below the size of a split."""
    body, expected = LAYOUTS[layout]
    root, table = tmp_path / "landing", str(tmp_path / "raw")
    root.mkdir()
    (root / "crm_accounts_2025-11-04.csv").write_bytes(HEADER.encode() + b"\n" + body * many)
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        if isinstance(expected, str):
            with pytest.raises(snapshots.SnapshotError, match=expected):
                snapshots.sync_feed(spark, str(root), "accounts", table)
            assert snapshots.loaded_snapshots(spark, table).count() == 0
        else:
            snapshots.sync_feed(spark, str(root), "accounts", table)
            counted = read_nights(spark, table).groupBy(*HEADER.split(",")).count()
            assert rows(counted) == sorted((*row, many) for row in expected)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)


def test_feeds_with_line_breaks_say_so(spark, tmp_path):
    root, table = tmp_path / "landing", str(tmp_path / "raw")
    write(root, "2025-11-04", ['A1,"two\nlines, ""quoted""",Ames'], header='account_id,"account\nname",city')
    snapshots.sync_feed(spark, str(root), "accounts", table, multi_line=True)
    held = read_nights(spark, table)
    assert held.columns[:3] == ["account_id", "account\nname", "city"]
    assert held.first()[1] == 'two\nlines, "quoted"'


@pytest.mark.parametrize("header", ["account_id,city,account_name", "account_id,account_name,town", "account_id,account_name"])
def test_column_drift_between_files_stops_the_load(spark, landing, tmp_path, header):
    values = ",".join("xyz"[: header.count(",") + 1])
    write(landing, "2025-11-06", [values], header=header)
    with pytest.raises(Exception, match="CSV header"):
        snapshots.sync_feed(spark, str(landing), "accounts", str(tmp_path / "raw"), multi_line=True)
    assert snapshots.loaded_snapshots(spark, str(tmp_path / "raw")).count() == 0


def test_column_drift_against_the_destination_stops_the_load(spark, landing, tmp_path):
    table = str(tmp_path / "raw")
    snapshots.sync_feed(spark, str(landing), "accounts", table, multi_line=True)
    write(landing, "2025-11-07", ["A1,x,y"], header="account_id,account_name,town")
    with pytest.raises(snapshots.SnapshotError, match="column drift"):
        snapshots.sync_feed(spark, str(landing), "accounts", table)


def test_stream_loads_each_file_once(spark, landing, tmp_path):
    table, state = str(tmp_path / "streamed"), str(tmp_path / "state")

    def run():
        stream = snapshot_stream.snapshot_stream(spark, str(landing), "accounts", HEADER.split(","), multi_line=True)
        snapshot_stream.run_available(stream, table, state)
        return rows(snapshots.snapshot_counts(read_nights(spark, table)).select(F.col("snapshot_date").cast("string"), "row_count"))

    first = [("2025-11-04", 2), ("2025-11-05", 1)]
    assert run() == first
    assert run() == first
    write(landing, "2025-11-06", ["A9,x,y"])
    assert run() == [*first, ("2025-11-06", 1)]


def test_stream_refuses_columns_the_destination_lacks(spark, landing, tmp_path):
    table = str(tmp_path / "raw")
    snapshots.sync_feed(spark, str(landing), "accounts", table, multi_line=True)
    stream = snapshot_stream.snapshot_stream(spark, str(landing), "accounts", ["account_id", "town", "city"])
    with pytest.raises(snapshots.SnapshotError, match="column drift"):
        snapshot_stream.run_available(stream, table, str(tmp_path / "state"))


def test_stream_counts_what_landed(spark, landing, tmp_path, monkeypatch):
    sound = tables_of_nights._record

    def record_one_more(spark, root, load, landed):
        sound(spark, root, load, {night: count + 1 for night, count in landed.items()})

    monkeypatch.setattr(tables_of_nights, "_record", record_one_more)
    stream = snapshot_stream.snapshot_stream(spark, str(landing), "accounts", HEADER.split(","), multi_line=True)
    with pytest.raises(snapshots.SnapshotError, match="rows recorded"):
        snapshot_stream.run_available(stream, str(tmp_path / "s"), str(tmp_path / "state"))


def file_by_file(spark, root):
    return (
        spark.readStream.schema(snapshots.raw_schema(HEADER.split(",")))
        .options(**snapshots.csv_options(False), maxFilesPerTrigger=1)
        .csv(str(root))
    )


def test_the_recount_covers_batches_spark_has_forgotten(spark, tmp_path):
    """More batches than the progress Spark remembers, over a restart, one of them run twice."""
    root, table, state = tmp_path / "landing", str(tmp_path / "s"), tmp_path / "state"
    days = [dt.date(2025, 1, 1) + dt.timedelta(n) for n in range(9)]
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        for n, day in enumerate(days[:6]):
            write(root, day, [f"A{i},x,y" for i in range(n + 1)])
        query = snapshot_stream.run_available(snapshots.with_lineage(file_by_file(spark, root)), table, str(state))
        assert len(query.recentProgress) <= 2
        # As after a crash between the record and the end of the last batch: it runs again.
        last = max((state / "commits").glob("[0-9]*"), key=lambda path: int(path.name))
        last.unlink()
        for name in (state / "commits").glob(".*.crc"):
            name.unlink()
        for n, day in enumerate(days[6:], 6):
            write(root, day, [f"A{i},x,y" for i in range(n + 1)])
        snapshot_stream.run_available(snapshots.with_lineage(file_by_file(spark, root)), table, str(state))
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    counts = snapshots.snapshot_counts(read_nights(spark, table))
    assert rows(counts) == [(day, n + 1) for n, day in enumerate(days)]
    assert tables_of_nights.recount(spark, table).count() == 0


def test_stream_equals_batch(spark, landing, tmp_path):
    stream = snapshot_stream.snapshot_stream(spark, str(landing), "accounts", HEADER.split(","), multi_line=True)
    snapshot_stream.run_available(stream, str(tmp_path / "s"), str(tmp_path / "state"))
    snapshots.sync_feed(spark, str(landing), "accounts", str(tmp_path / "b"), multi_line=True)
    streamed, batch = (read_nights(spark, str(tmp_path / p)).drop("_loaded_at") for p in "sb")
    assert rows(streamed.select(*batch.columns)) == rows(batch)


def test_stream_and_batch_share_a_destination(spark, landing, tmp_path):
    table = str(tmp_path / "raw")
    snapshots.sync_feed(spark, str(landing), "accounts", table, multi_line=True)
    stream = snapshot_stream.snapshot_stream(spark, str(landing), "accounts", HEADER.split(","), multi_line=True)
    with pytest.raises(Exception, match="several files for one night"):
        snapshot_stream.run_available(stream, table, str(tmp_path / "state"))
    assert read_nights(spark, table).count() == 3


def test_replace_and_build_once(spark, tmp_path):
    path = str(tmp_path / "catalogue.parquet")
    spark.range(3).write.parquet(path)
    tables.replace_table(spark, path, "catalogue")
    tables.replace_table(spark, path, "catalogue")
    assert spark.table("catalogue").count() == 3
    assert tables.build_table(spark, lambda: spark.range(5), "derived") is True
    assert tables.build_table(spark, lambda: spark.range(9), "derived") is False
    assert spark.table("derived").count() == 5
    assert tables.build_table(spark, lambda: spark.range(9), "derived", force=True) is True
    assert spark.table("derived").count() == 9


def test_scan_budget(spark, tmp_path):
    tables.check_budget(4 * 1024**3, 10 * 1024**3)
    tables.check_budget(10, 10)
    tables.check_budget(50 * 1024**3, 0)
    with pytest.raises(tables.ScanBudgetError, match="facts: 11 bytes selected, 10 allowed"):
        tables.check_budget(11, 10, "facts")
    path = str(tmp_path / "facts")
    spark.range(1000).withColumn("p", F.col("id") % 2).write.partitionBy("p").parquet(path)
    whole = tables.selected_bytes(spark, path, "*.parquet")
    half = tables.check_scan_budget(spark, f"{path}/p=0", whole, "*.parquet")
    assert 0 < half < whole
    with pytest.raises(tables.ScanBudgetError):
        tables.check_scan_budget(spark, path, whole - 1, "*.parquet")
    assert tables.selected_bytes(spark, path, "*.none") == 0
    assert tables.selected_bytes(spark, path, condition=F.col("p") == 0) == half
    assert tables.selected_bytes(spark, path, condition=F.col("id") < 0) == 0


def test_estimate_by_column_and_date(spark, tmp_path):
    """Against the footers of files written here, read another way."""
    from pyarrow import parquet as pq

    path = tmp_path / "sales"
    days = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") / 100).cast("int"))
    wide = spark.range(4000).select("id", days.alias("date"), F.sha2(F.col("id").cast("string"), 256).alias("name"))
    wide.coalesce(1).sortWithinPartitions("date").write.option("parquet.block.size", 20_000).parquet(str(path))
    (file,) = path.glob("*.parquet")
    meta = pq.ParquetFile(file).metadata
    assert meta.num_row_groups > 3

    def stored(columns, since=dt.date(1, 1, 1)):
        groups = [meta.row_group(i).to_dict()["columns"] for i in range(meta.num_row_groups)]
        ends = [next(c["statistics"]["max"] for c in g if c["path_in_schema"] == "date") for g in groups]
        return sum(c["total_compressed_size"] for g, end in zip(groups, ends, strict=True) if end >= since
                   for c in g if c["path_in_schema"] in columns)

    files = increments.list_files(spark, str(path))
    everything = tables.column_bytes(spark, files, ["id", "date", "name"])
    assert everything == stored(["id", "date", "name"]) <= file.stat().st_size
    fewer = tables.column_bytes(spark, files, ["id", "date"])
    assert fewer == stored(["id", "date"]) < everything
    since = dt.date(2024, 1, 30)
    later = tables.column_bytes(spark, files, ["id", "date"], ("date", since))
    assert 0 < later == stored(["id", "date"], since) < fewer
    assert tables.column_bytes(spark, files, ["id"], ("date", dt.date(2025, 1, 1))) == 0
    foreign = files.withColumn("path", F.lit("viewfs://store/x.parquet"))
    assert tables.column_bytes(spark, foreign, ["id"]) == file.stat().st_size
    by_day = str(tmp_path / "by_day")
    wide.where("id < 1000").repartition("date").write.partitionBy("date").parquet(by_day)
    listed = increments.list_files(spark, by_day)
    part = tables.column_bytes(spark, listed, ["id"], ("date", dt.date(2024, 1, 6)))
    assert 0 < part < tables.column_bytes(spark, listed, ["id"])


def test_increments_take_in_every_file_once(spark, tmp_path):
    source, state = str(tmp_path / "source"), str(tmp_path / "state")

    def derive(rows):
        return rows.groupBy("month").agg(F.sum("id").alias("total"))

    def read(made_by="a"):
        return dict(map(tuple, increments.read_state(spark, state, made_by).groupBy("month").agg(F.sum("total")).collect()))

    spark.range(10).withColumn("month", F.col("id") % 2).coalesce(1).write.partitionBy("month").parquet(source)
    assert increments.take_in(spark, source, state, "a", derive) == 2
    assert increments.take_in(spark, source, state, "a", derive) == 0
    assert read() == {0: 20, 1: 25}
    spark.range(100, 102).withColumn("month", F.lit(2)).coalesce(1).write.mode("append").partitionBy("month").parquet(source)
    seen = []
    increments.take_in(spark, source, state, "a", lambda rows: seen.extend(rows.inputFiles()) or derive(rows))
    assert len(seen) == 1 and "month=2" in seen[0]
    assert read() == {0: 20, 1: 25, 2: 201}
    # A load without its record does not count, nor does what was made another way.
    (tmp_path / "state" / "load=ldead").mkdir()
    assert increments.take_in(spark, source, state, "b", derive) == 3
    assert read() == read("b") == {0: 20, 1: 25, 2: 201}
    next((tmp_path / "source").glob("month=0/*.parquet")).unlink()
    with pytest.raises(increments.ChangedSourceError, match="gone or has changed"):
        increments.take_in(spark, source, state, "a", derive)


def test_clustered_tables_join_without_a_shuffle(spark):
    from conftest import plan

    for name in ("left_side", "right_side"):
        df = spark.range(100).select(F.col("id").cast("string").alias("store_number"), "id")
        tables.write_clustered(df, name, "store_number", buckets=4)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        joined = spark.table("left_side").join(spark.table("right_side"), "store_number")
        assert "Exchange" not in plan(joined)
        assert joined.count() == 100
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_read_ranked(spark):
    spark.createDataFrame([(2, "b"), (1, "a")], "target_rank int, id string").write.saveAsTable("ranked")
    assert [r.id for r in tables.read_ranked(spark, "ranked").collect()] == ["a", "b"]
