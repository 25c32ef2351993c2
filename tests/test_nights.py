"""Tables of nights: what a load that dies shows, what a rerun does, what is counted."""

import datetime as dt
import shutil
from pathlib import Path

import pytest
from conftest import rows

from shelfscout.sources import nights, snapshots

HEADER = "account_id,account_name,city"
FIRST, SECOND = dt.date(2025, 11, 4), dt.date(2025, 11, 5)


def write(root, night, count):
    root.mkdir(exist_ok=True)
    lines = [f"A{i},x,y" for i in range(count)]
    (root / f"crm_accounts_{night}.csv").write_text("\n".join([HEADER, *lines]) + "\n")


@pytest.fixture
def loaded(spark, tmp_path):
    """A landing folder and a destination that holds its first night."""
    root, table = tmp_path / "landing", str(tmp_path / "raw")
    write(root, FIRST, 3)
    assert snapshots.sync_feed(spark, str(root), "accounts", table) == 1
    return root, table


def counts(spark, table):
    return rows(snapshots.snapshot_counts(nights.read_nights(spark, table)))


class Killed(RuntimeError):
    pass


def killed(*_):
    raise Killed


def test_a_load_killed_before_its_record_shows_nothing(spark, loaded, monkeypatch):
    root, table = loaded
    write(root, SECOND, 5)
    with monkeypatch.context() as patch:
        patch.setattr(nights, "_record", killed)
        with pytest.raises(Killed):
            snapshots.sync_feed(spark, str(root), "accounts", table)
    assert counts(spark, table) == [(FIRST, 3)]
    assert snapshots.sync_feed(spark, str(root), "accounts", table) == 1
    assert counts(spark, table) == [(FIRST, 3), (SECOND, 5)]
    assert snapshots.sync_feed(spark, str(root), "accounts", table) == 0


@pytest.mark.parametrize("copied", [0, 1, 2])
def test_a_load_that_dies_while_files_are_copied_shows_nothing(spark, loaded, copied):
    """On a store without rename a folder comes to be file by file."""
    root, table = loaded
    write(root, SECOND, 5)
    (folder,) = Path(table).glob(f"load=*/snapshot_date={FIRST}")
    target = Path(table) / "load=ldead" / f"snapshot_date={SECOND}"
    target.mkdir(parents=True)
    part = next(folder.glob("*.parquet"))
    for number in range(copied):
        shutil.copy(part, target / f"part-{number}.parquet")
    if copied == 2:
        (target / "part-1.parquet").write_bytes(b"PAR1 cut off")
    assert counts(spark, table) == [(FIRST, 3)]
    assert nights.recount(spark, table).count() == 0
    assert snapshots.sync_feed(spark, str(root), "accounts", table) == 1
    assert counts(spark, table) == [(FIRST, 3), (SECOND, 5)]
    assert nights.sweep(spark, table) == 1
    assert not target.exists() and nights.sweep(spark, table) == 0
    assert counts(spark, table) == [(FIRST, 3), (SECOND, 5)]


def test_a_record_that_is_still_being_written_does_not_count(spark, loaded):
    _, table = loaded
    begun = Path(table) / "_nights" / "load=lnew" / "_temporary" / "0"
    begun.mkdir(parents=True)
    (begun / "part-0.json").write_text('{"snapshot_date":"2025-11-05","row_count":3}\n')
    assert counts(spark, table) == [(FIRST, 3)]


def test_rows_are_counted_where_they_lie(spark, loaded, monkeypatch):
    root, table = loaded
    write(root, SECOND, 5)
    sound = nights._count

    def loses_a_file(spark, folder, schema, sent):
        for path in Path(folder).glob("*/*.parquet"):
            path.unlink()
        return sound(spark, folder, schema, sent)

    with monkeypatch.context() as patch:
        patch.setattr(nights, "_count", loses_a_file)
        with pytest.raises(Exception, match="sent 5 rows, the destination holds 0|UNABLE_TO_INFER|PATH_NOT_FOUND"):
            snapshots.sync_feed(spark, str(root), "accounts", table)
    assert counts(spark, table) == [(FIRST, 3)]


def test_the_destination_can_be_counted_again_at_any_time(spark, loaded):
    root, table = loaded
    write(root, SECOND, 5)
    snapshots.sync_feed(spark, str(root), "accounts", table)
    assert rows(nights.recount(spark, table)) == []
    (folder,) = Path(table).glob(f"load=*/snapshot_date={SECOND}")
    shutil.rmtree(folder)
    assert rows(nights.recount(spark, table)) == [(SECOND, 5, 0)]
    assert rows(nights.recount(spark, table, [FIRST])) == []


def test_the_last_load_of_a_night_holds(spark, loaded):
    root, table = loaded
    paths = [str(root / f"crm_accounts_{FIRST}.csv")]
    write(root, FIRST, 2)
    again = snapshots.with_lineage(snapshots.read_snapshot_csv(spark, paths, HEADER.split(",")))
    assert nights.commit_load(again, table) == {FIRST: 2}
    assert counts(spark, table) == [(FIRST, 2)]
    assert nights.sweep(spark, table) == 1
    assert counts(spark, table) == [(FIRST, 2)]
    with pytest.raises(nights.SnapshotError, match="several files for one night"):
        nights.commit_load(again, table, new_only=True)


def test_a_named_load_replaces_itself(spark, tmp_path):
    table = str(tmp_path / "t")
    for count in (4, 2):
        made = spark.range(count).selectExpr("id", f"date'{FIRST}' as snapshot_date")
        nights.commit_load(made, table, load="s1", new_only=True)
    assert counts(spark, table) == [(FIRST, 2)]


def test_a_night_without_rows_is_held(spark, loaded):
    root, table = loaded
    write(root, SECOND, 0)
    assert snapshots.sync_feed(spark, str(root), "accounts", table) == 1
    assert snapshots.sync_feed(spark, str(root), "accounts", table) == 0
    assert counts(spark, table) == [(FIRST, 3)]
    assert rows(snapshots.loaded_snapshots(spark, table)) == [(FIRST,), (SECOND,)]


def test_only_the_nights_asked_for_are_opened(spark, loaded):
    root, table = loaded
    write(root, SECOND, 5)
    snapshots.sync_feed(spark, str(root), "accounts", table)
    read = nights.read_nights(spark, table, [SECOND])
    assert read.count() == 5 and all(f"snapshot_date={SECOND}" in name for name in read.inputFiles())
    with pytest.raises(nights.SnapshotError, match="none of the nights"):
        nights.read_nights(spark, table, [dt.date(2030, 1, 1)])
    assert nights.read_nights(spark, f"{table}x", schema="a int").count() == 0
