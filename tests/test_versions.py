"""Sealed versions: what readers see before, during and after a publish, lost races, crashes, late rows, cleaning up."""

import datetime as dt

import pytest
from pyspark.sql import types as T

from tickframe.sources import versions

D = dt.date
SCHEMA = T.StructType([T.StructField("x", T.LongType()), T.StructField("ticker", T.StringType()), T.StructField("date", T.DateType())])


@pytest.fixture
def store(spark, tmp_path):
    return versions.Store(spark, str(tmp_path / "store"), SCHEMA)


def rows(spark, *of):
    return spark.createDataFrame([(x, t, D(2024, 1, d)) for x, t, d in of], SCHEMA)


def seen(df):
    return sorted((r.x, r.ticker, r.date.day) for r in df.collect())


def test_an_empty_store(spark, store):
    assert seen(store.read()) == [] and seen(store.quarantined()) == [] and store.commits() == []
    assert store.vacuum() == []


def test_a_crash_before_the_commit_shows_nothing(spark, store):
    store.seal(rows(spark, (1, "A", 1), (2, "A", 1), (3, "B", 1), (9, None, 2)))
    held = store.read()
    name, counts = store.write(rows(spark, (7, "A", 1)))  # dies here
    assert sorted(r.x for r in store.read().collect()) == [1, 2, 3, 9]
    assert store.publish(name, counts) == 1  # taken up again
    assert sorted(r.x for r in store.read().collect()) == [3, 7, 9]
    assert sorted(r.x for r in held.collect()) == [1, 2, 3, 9]  # whoever began before goes on with what there was
    assert sorted(r.x for r in store.read(0).collect()) == [1, 2, 3, 9]


def test_a_manifest_without_a_commit_is_not_read(spark, store):
    store.seal(rows(spark, (1, "A", 1)))
    name, counts = store.write(rows(spark, (2, "A", 1)))
    commit, store._commit = store._commit, lambda number, manifest: (_ for _ in ()).throw(OSError("gone"))
    with pytest.raises(OSError):
        store.publish(name, counts)
    store._commit = commit
    assert seen(store.read()) == [(1, "A", 1)]


def test_two_publishers_lose_nothing(spark, store):
    store.seal(rows(spark, (1, "A", 1), (2, "B", 1)))
    first, second = store.write(rows(spark, (3, "A", 1))), store.write(rows(spark, (4, "B", 1)))
    commit, raced = store._commit, []

    def race(number, manifest):
        if not raced:
            raced.append(number)
            store.publish(*second)  # comes in between
        return commit(number, manifest)

    store._commit = race
    assert store.publish(*first) == 2 and raced == [1]
    assert seen(store.read()) == [(3, "A", 1), (4, "B", 1)]


def test_late_rows_and_reopened_partitions(spark, store):
    store.seal(rows(spark, (1, "A", 1), (2, "B", 1)))
    for _ in range(2):  # the same batch again
        assert seen(store.land(rows(spark, (3, "A", 1), (4, "B", 1), (5, "C", 1)), 0)) == [(5, "C", 1)]
    assert seen(store.quarantined()) == [(3, "A", 1), (4, "B", 1)]
    store.reopen(spark.createDataFrame([("A", D(2024, 1, 1))], "ticker string, date date"))
    assert seen(store.read()) == [(1, "A", 1), (2, "B", 1), (3, "A", 1)] and seen(store.quarantined()) == [(4, "B", 1)]
    store.land(rows(spark, (6, "A", 1)), 1)
    store.seal(rows(spark, (7, "A", 1)))  # sealed anew: what was taken up does not come back
    assert seen(store.quarantined()) == [(4, "B", 1), (6, "A", 1)] and seen(store.read()) == [(2, "B", 1), (7, "A", 1)]


def test_a_reopening_takes_up_what_another_commit_did(spark, store):
    store.seal(rows(spark, (1, "A", 1), (2, "B", 1)))
    store.land(rows(spark, (3, "A", 1)), 0)
    publish, done = store.publish, []

    def first_another(name, counts, *more):
        if more and not done:
            done.append(publish(*store.write(rows(spark, (8, "A", 1)))))
        return publish(name, counts, *more)

    store.publish = first_another
    store.reopen(spark.createDataFrame([("A", D(2024, 1, 1))], "ticker string, date date"))
    assert done == [1] and seen(store.read()) == [(2, "B", 1), (3, "A", 1), (8, "A", 1)]


def test_vacuum_keeps_what_shows(spark, store):
    for x in range(4):
        store.seal(rows(spark, (x, "A", 1)))
    store.seal(rows(spark, (9, "B", 1)))
    assert store.vacuum(keep=2) == []  # too young
    assert len(store.vacuum(keep=2, older_than=dt.timedelta(0))) == 3
    assert seen(store.read()) == [(3, "A", 1), (9, "B", 1)] and seen(store.read(3)) == [(3, "A", 1)]
