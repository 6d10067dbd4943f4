"""Tables as snapshots: a run shows with its commit or not at all; readers keep the version they resolved."""

import pytest

from touchline.sinks import snapshots as S
from touchline.sinks import tables
from touchline.sinks.tables import write_table
from touchline.sources.tables import read_table

COLS = "id bigint, v string, year int, month int, day int"


def days(spark, *rows):
    return spark.createDataFrame([(i, v, 2024, 1, d) for i, v, d in rows], COLS)


def held(df):
    return sorted((r.id, r.v, r.day) for r in df.collect())


def test_a_run_that_dies_before_its_commit_changes_nothing(spark, scratch, monkeypatch):
    path = f"{scratch}/t"
    write_table(days(spark, (1, "a", 1), (2, "b", 2)), path)

    def lost(*args, **kw):
        raise RuntimeError("driver lost")

    real = tables.commit
    monkeypatch.setattr(tables, "commit", lost)
    with pytest.raises(RuntimeError, match="driver lost"):
        write_table(days(spark, (9, "z", 1), (9, "z", 2)), path, owned=lambda v: True)
    assert held(read_table(spark, path)) == [(1, "a", 1), (2, "b", 2)]
    monkeypatch.setattr(tables, "commit", real)
    write_table(days(spark, (3, "c", 2)), path, owned=lambda v: True)
    assert held(read_table(spark, path)) == [(3, "c", 2)]


def test_a_half_written_pointer_is_never_read(spark, scratch, monkeypatch):
    path = f"{scratch}/t"
    write_table(days(spark, (1, "a", 1)), path)

    def lost(spark, target, text):
        from touchline.files import fs_path
        fs, p = fs_path(spark, target.rsplit("/", 1)[0] + "/.aside")
        out = fs.create(p)
        out.write(text[:20].encode())
        out.close()
        raise RuntimeError("driver lost")

    monkeypatch.setattr(S, "publish_file", lost)
    with pytest.raises(RuntimeError):
        write_table(days(spark, (2, "b", 1)), path)
    assert held(read_table(spark, path)) == [(1, "a", 1)]


def test_readers_keep_their_version_during_a_swap(spark, scratch):
    path = f"{scratch}/t"
    write_table(days(spark, (1, "a", 1), (2, "b", 2)), path)
    before = read_table(spark, path)
    for i in range(5):  # later runs, also one that empties the table
        write_table(days(spark, *[(10 + i, "n", 1)] * (i != 2)), path, owned=lambda v: True)
        assert held(before) == [(1, "a", 1), (2, "b", 2)]
    assert held(read_table(spark, path)) == [(14, "n", 1)]
    assert len(S.versions(spark, path)) == 3


def test_old_runs_are_removed_once_no_pointer_names_them(spark, scratch):
    path = f"{scratch}/t"
    for i in range(5):
        write_table(days(spark, (i, "a", 1 + i % 2)), path)
    assert len(S.children(spark, f"{path}/runs")) == 5
    gone = S.vacuum(spark, [path], f"{path}/runs", keep=1, older_seconds=0)
    assert len(gone) == 3 and len(S.versions(spark, path)) == 1
    assert held(read_table(spark, path)) == [(3, "a", 2), (4, "a", 1)]


def test_two_writers_of_one_version(spark, scratch, monkeypatch):
    """The second of two commits to the same version raises; the first one's rows stay."""
    path = f"{scratch}/t"
    write_table(days(spark, (1, "a", 1)), path)
    stale = S.snapshot(spark, path)
    write_table(days(spark, (2, "b", 1)), path)
    monkeypatch.setattr(S, "snapshot", lambda *a: stale)
    with pytest.raises(RuntimeError, match="another writer"):
        write_table(days(spark, (3, "c", 1)), path)
    monkeypatch.undo()
    assert held(read_table(spark, path)) == [(2, "b", 1)]


def test_tables_without_partitions_and_without_rows(spark, scratch):
    path = f"{scratch}/t"
    assert write_table(days(spark, (1, "a", 1)).drop("year", "month", "day"), path, partition_by=(),
                       owned=lambda v: True) == 1
    assert write_table(days(spark).drop("year", "month", "day"), path, partition_by=(), owned=lambda v: True) == 0
    assert read_table(spark, path).columns == ["id", "v"] and read_table(spark, path).count() == 0
    empty = f"{scratch}/e"
    assert write_table(days(spark), empty) == 0
    assert read_table(spark, empty).columns == ["id", "v", "year", "month", "day"]
    assert read_table(spark, empty).count() == 0


def test_partition_filters_reach_the_folders(spark, scratch):
    path = f"{scratch}/t"
    write_table(days(spark, (1, "a", 1), (2, "b", 2)), path)
    plan = read_table(spark, path).where("day = 2")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan
