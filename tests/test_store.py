import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.schema import SchemaConflict, evolve
from tidemark.sources.change_feed import follow
from tidemark.sources.store import ROW_ID, ArchiveTable, ConcurrentCommit, TableMissing


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_append_read_history_and_time_travel(spark, store):
    t = store.table("s", "t")
    assert not t.exists()
    with pytest.raises(TableMissing):
        t.read()
    t.append(spark.range(3).toDF("a"))
    t.append(spark.range(3, 5).toDF("a"))
    assert rows(t.read()) == [(i,) for i in range(5)]
    assert rows(t.read(version=0)) == [(i,) for i in range(3)]
    t.overwrite(t.read().where("a > 3"))
    assert rows(t.read()) == [(4,)]
    assert [r.operation for r in t.history().collect()] == ["append", "append", "overwrite"]
    assert t.detail()["rows"] == 1


def test_row_ids_are_distinct_grow_and_survive_an_update(spark, store):
    t = store.table("s", "t")
    for start in (0, 1000, 2000):
        t.append(spark.range(start, start + 1000).select(F.col("id").alias("a"), F.lit("x").alias("tag")))
    first = {r.a: r[ROW_ID] for r in t.read(row_id=True).collect()}
    assert len(set(first.values())) == 3000
    assert max(first[a] for a in range(1000)) < min(first[a] for a in range(1000, 2000))
    assert t.update(F.col("a") % 2 == 0, {"tag": F.lit("y")}) is not None
    assert {r.a: r[ROW_ID] for r in t.read(row_id=True).collect()} == first
    t.append(spark.range(5).select(F.col("id").alias("a"), F.lit("z").alias("tag")))
    assert min(r[ROW_ID] for r in t.read(row_id=True).where("tag = 'z'").collect()) > max(first.values())
    assert t.update(F.col("a") < 0, {"tag": F.lit("never")}) is None


def test_schema_widens_at_any_depth_and_types_may_not_change(spark, store):
    t = store.table("s", "t")
    t.append(spark.sql("SELECT 1 AS a, named_struct('x', 1) AS s, array(named_struct('p', 1)) AS l, map('k', named_struct('m', 1)) AS m"))
    t.append(spark.sql("SELECT 2 AS a, named_struct('x', 2, 'y', 'new') AS s, array(named_struct('p', 2, 'q', true)) AS l, map('k', named_struct('m', 2, 'n', 2.5D)) AS m, 'top' AS b"))
    got = {r.a: r for r in t.read().collect()}
    assert got[1].s.y is None and got[1].l[0].q is None and got[1].m["k"].n is None and got[1].b is None
    assert got[2].s.y == "new" and got[2].l[0].q is True and got[2].m["k"].n == 2.5
    with pytest.raises(SchemaConflict):
        t.append(spark.sql("SELECT 'text' AS a"))
    assert t.version() == 1
    with pytest.raises(SchemaConflict):
        evolve(T.MapType(T.StringType(), T.LongType()), T.MapType(T.LongType(), T.LongType()))


def test_two_writers_from_one_version_cannot_both_commit(spark, store):
    a = store.table("s", "t")
    a.append(spark.range(2))
    b = ArchiveTable(spark, a.path)
    base = b.snapshot()
    a.append(spark.range(2))
    with pytest.raises(ConcurrentCommit):
        b._commit(base, "set properties", base.schema, properties={})
    assert b.version() == 1


def test_transactions_commit_once(spark, store):
    t = store.table("s", "t")
    assert t.append(spark.range(2), transaction=("flow", 0)) == 0
    assert t.append(spark.range(2), transaction=("flow", 0)) is None
    assert t.append(spark.range(2), transaction=("other", 0)) == 1
    assert t.read().count() == 4


def test_summaries_spare_the_older_log(spark, store):
    t = store.table("s", "t")
    t.append(spark.range(2))
    for i in range(21):
        t.set_properties({"p": str(i)})
    fresh = ArchiveTable(spark, t.path)
    assert fresh.snapshot().properties == {"p": "20"} and fresh.read().count() == 2
    assert fresh.snapshot(3).properties == {"p": "2"}


def test_changes(spark, store):
    t = store.table("s", "t")
    t.append(spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"))
    t.update(F.col("k") == 1, {"v": F.lit("c")})
    t.overwrite(t.read().where("k = 1"))
    got = [(r._commit_version, r._change_type, r.k, r.v) for r in t.changes(0).collect()]
    assert sorted(got) == [
        (0, "insert", 1, "a"), (0, "insert", 2, "b"), (1, "update_postimage", 1, "c"), (1, "update_preimage", 1, "a"),
        (2, "delete", 1, "c"), (2, "delete", 2, "b"), (2, "insert", 1, "c"),
    ]
    t.set_properties({"x": "1"})
    assert t.changes(3).count() == 0


def test_change_stream_delivers_each_commit_once(spark, store, tmp_path):
    t, seen = store.table("s", "t"), []

    def deliver(changes, version):
        seen.append((version, changes.count()))

    for n in (2, 3):
        t.append(spark.range(n))
        follow(t, deliver, f"file://{tmp_path}/feed").awaitTermination()
    assert seen == [(0, 2), (1, 3)]


def test_any_type_and_an_empty_table_survive(spark, store):
    t = store.table("s", "t")
    df = spark.sql("SELECT DATE'2024-01-01' AS d, TIMESTAMP'2024-01-01 10:00:00' AS ts, TIMESTAMP_NTZ'2024-01-01 10:00:00' AS n, 1.5BD AS dec, CAST('x' AS BINARY) AS b, true AS f, array(1, NULL) AS l")
    t.append(df)
    assert t.read().collect() == df.collect() and [f.dataType for f in t.read().schema] == [f.dataType for f in df.schema]
    e = store.table("s", "e")
    e.append(df.where("1 = 0"))
    assert e.read().count() == 0 and e.read(row_id=True).count() == 0 and e.snapshot().rows == 0
    assert df.first().d == dt.date(2024, 1, 1)


def test_a_failed_check_leaves_the_table_as_it_was(spark, store):
    t = store.table("s", "t")
    t.append(spark.range(2))

    def refuse(written):
        raise ValueError(written.count())

    with pytest.raises(ValueError, match="1"):
        t.overwrite(spark.range(1), check=refuse)
    assert t.version() == 0 and t.read().count() == 2


def test_schemas_are_made_and_dropped(store):
    store.create_schema("x")
    store.create_schema("x")
    store.drop_schema("x")
    assert not store.table("x", "t").exists()


def test_the_feed_shows_the_smallest_change(spark, store):
    """Microseconds, not-a-number, and maps whose entries only stand in another order."""
    t = store.table("s", "t")
    df = spark.sql("SELECT id AS k, timestamp_ntz'2024-01-01 00:00:00.000001' AS ts, CAST('NaN' AS double) AS x, map('a', array(named_struct('m', map(1, 2))), 'b', null) AS m FROM range(4)")
    t.append(df)
    t.update(F.col("k") == 0, {"ts": F.col("ts") + F.expr("INTERVAL '0.000005' SECOND")})
    t.update(F.col("k") == 1, {"m": F.expr("map('b', null, 'a', array(named_struct('m', map(1, 2))))")})  # the same map
    t.update(F.col("k") == 2, {"m": F.expr("map('b', null, 'a', array(named_struct('m', map(1, 3))))")})
    got = [(r.k, r._change_type, r._commit_version) for r in t.changes(1).orderBy("_commit_version", "_change_type").collect()]
    assert got == [(0, "update_postimage", 1), (0, "update_preimage", 1), (2, "update_postimage", 3), (2, "update_preimage", 3)]
