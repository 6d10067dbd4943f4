"""Writers: dynamic partition overwrite keeps other days; row counts ride on the write."""

from touchline.sinks.publish import publish, to_messages
from touchline.sinks.tables import write_table
from touchline.sources.tables import read_table

COLS = "id bigint, v string, year int, month int, day int"


def test_dynamic_overwrite_keeps_other_days(spark, scratch):
    path = f"{scratch}/t"
    day1 = spark.createDataFrame([(1, "a", 2024, 1, 1), (2, "b", 2024, 1, 1)], COLS)
    day2 = spark.createDataFrame([(3, "c", 2024, 1, 2)], COLS)
    assert write_table(day1, path) == 2
    assert write_table(day2, path) == 1
    # a re-run of day 2 replaces day 2 only
    again = spark.createDataFrame([(4, "d", 2024, 1, 2), (5, "e", 2024, 1, 2)], COLS)
    assert write_table(again, path, sort_by=("id",)) == 2
    got = sorted((r.id, r.day) for r in read_table(spark, path).collect())
    assert got == [(1, 1), (2, 1), (4, 2), (5, 2)]


def test_publish_to_files_roundtrip(spark, scratch):
    df = spark.createDataFrame([(1, "x"), (2, "y")], "id bigint, name string")
    out = f"{scratch}/msgs"
    publish(to_messages(df, "sports.test"), fmt="json", path=out, mode="overwrite")
    back = sorted((r.key, r.topic) for r in spark.read.json(out).collect())
    assert back == [("1", "sports.test"), ("2", "sports.test")]


def test_owned_partitions_are_emptied(spark, scratch):
    """A run replaces all days it owns, also those without rows now; other days stay."""
    path = f"{scratch}/t"
    rows = [(d, "a", 2024, 1, d) for d in (1, 2, 3)]
    write_table(spark.createDataFrame(rows, COLS), path)
    owned = lambda v: int(v["day"]) >= 2
    assert write_table(spark.createDataFrame([(9, "z", 2024, 1, 2)], COLS), path, owned=owned) == 1
    assert sorted(r.id for r in read_table(spark, path).collect()) == [1, 9]
    assert write_table(spark.createDataFrame([], COLS), path, owned=owned) == 0
    assert [r.id for r in read_table(spark, path).collect()] == [1]
