"""The behaviours that dedup and row tracking promise, on small tables."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidemark.functions.keys import as_datetime, survivor_order
from tidemark.operators import dedup, features
from tidemark.operators.merge import missing_rows
from tidemark.plans.registry import TableSpec
from tidemark.sources.store import ReservedName
from tidemark.streaming.flows import Flow

USAGE = "record_id string, usage_date date, tag string"


def day(n):
    return dt.date(2026, 1, n)


def usage(spark, *rows):
    return spark.createDataFrame([(k, day(d), tag) for k, d, tag in rows], USAGE)


def tags(table, key="record_id"):
    return {r[key]: r.tag for r in table.read().collect()}


def test_edited_rows_survive_reappended_copies(spark, store):
    t = store.table("s", "t")
    t.append(usage(spark, ("a", 1, "orig"), ("b", 1, "orig"), ("c", 1, "orig")))
    features.ensure_features(t, "s.t")
    t.update(F.lit(True), {"tag": F.lit("edited")})
    t.append(usage(spark, ("a", 1, "orig"), ("b", 1, "orig"), ("c", 2, "orig")))
    report = dedup.dedup_table(t, "s.t", ["record_id"], "usage_date")
    assert (report["status"], report["ordering"], report["count_before"], report["count_after"], report["duplicates_removed"]) == ("deduped", "row_id", 6, 3, 3)
    assert tags(t) == dict.fromkeys("abc", "edited")


def test_without_row_tracking_the_latest_wins_whatever_the_flag(spark, store):
    for flag in (False, True):
        t = store.table("s", f"t{flag}")
        t.append(usage(spark, ("a", 1, "older"), ("a", 2, "newer"), ("b", 1, "only")))
        report = dedup.dedup_table(t, "s.t", ["record_id"], "usage_date", newest_version_wins=flag)
        assert report["ordering"] == "tiebreaker" and tags(t) == {"a": "newer", "b": "only"}


def test_features_turned_on_later_touch_no_file(spark, store):
    t = store.table("s", "t")
    t.append(usage(spark, ("a", 1, "orig"), ("b", 1, "orig")))
    before = t.detail()
    assert features.ensure_features(t, "s.t")["status"] == "enabled"
    version = t.version()
    again = features.ensure_features(t, "s.t")
    assert (again["status"], again["set"], t.version()) == ("present", [], version)
    assert {**t.detail(), "version": 0} == {**before, "version": 0}
    t.update(F.lit(True), {"tag": F.lit("edited")})
    t.append(usage(spark, ("a", 1, "orig"), ("b", 1, "orig")))
    dedup.dedup_table(t, "s.t", ["record_id"], "usage_date")
    assert tags(t) == {"a": "edited", "b": "edited"}


def test_newest_version_wins_and_ties_go_to_the_first_written(spark, store):
    schema = "workspace_id string, run_id string, update_time timestamp, tag string"
    at = lambda d: dt.datetime(2026, 1, d)
    t = store.table("s", "t")
    t.append(spark.createDataFrame([("w", "r1", at(1), "v1"), ("w", "r2", at(1), "orig")], schema))
    features.ensure_features(t, "s.t")
    t.update(F.col("run_id") == "r2", {"tag": F.lit("edited")})
    t.append(spark.createDataFrame([("w", "r1", at(2), "v2"), ("w", "r2", at(1), "orig")], schema))
    dedup.dedup_table(t, "s.t", ["workspace_id", "run_id"], "update_time", newest_version_wins=True)
    assert tags(t, "run_id") == {"r1": "v2", "r2": "edited"}


def test_null_keys_are_equal(spark, store):
    schema = "listing_id string, consumer_email string, tag string"
    df = spark.createDataFrame([("l", None, "x"), ("l", "e", "y")], schema)
    t = store.table("s", "t")
    t.append(df)
    features.ensure_features(t, "s.t")
    t.append(df)
    dedup.dedup_table(t, "s.t", ["listing_id", "consumer_email"], "tag")
    assert t.read().count() == 2
    assert dedup.count_keys(df.unionByName(df), ["listing_id", "consumer_email"]) == (4, 2)
    assert tuple(dedup.count_keys_by_struct(df.unionByName(df), ["listing_id", "consumer_email"]).first()) == (4, 2)


def test_a_rewrite_clusters_by_key(spark, store, sf_dir):
    """Files have ranges of the key that don't overlap, and the rows were shuffled once; a key of very many rows is combined first."""
    lines, key = spark.read.parquet(f"{sf_dir}/lineitem.parquet"), ["l_orderkey", "l_linenumber"]
    frame = dedup.dedup_frame(lines.repartitionByRange(*key), key, survivor_order("l_shipdate", None))
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "rangepartitioning" in plan
    t = store.table("s", "t")
    t.append(lines)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # else so small a table is one file
    try:
        assert dedup.dedup_table(t, "s.t", key, "l_shipdate")["status"] == "deduped"
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    ends = F.struct(*key)
    ranges = sorted((tuple(r.low), tuple(r.high)) for r in t.read().groupBy(F.col("_metadata.file_name")).agg(F.min(ends).alias("low"), F.max(ends).alias("high")).collect())
    assert len(ranges) > 1 and all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))
    hot = store.table("s", "hot")
    hot.append(lines.withColumn("l_orderkey", F.when(F.col("l_orderkey") % 2 == 0, F.lit(0)).otherwise(F.col("l_orderkey"))))
    assert dedup.dedup_table(hot, "s.hot", key, "l_shipdate")["count_after"] == hot.read().select(*key).distinct().count()


def test_a_rewrite_that_leaves_duplicates_is_not_committed(spark, store, monkeypatch):
    t = store.table("s", "t")
    rows = spark.createDataFrame([(1, 1), (1, 2)], "k int, v int")
    t.append(rows)
    monkeypatch.setattr(dedup, "dedup_frame", lambda df, keys, order: df)
    with pytest.raises(dedup.DuplicateKeys, match="s.t: 2 rows but 1 distinct"):
        dedup.dedup_table(t, "s.t", ["k"], "v")
    assert t.version() == 0 and t.read().count() == 2


def test_columns_may_have_any_name_but_the_tables_own(spark, store):
    df = spark.createDataFrame([(1, 5, 7), (1, 4, 7)], "k int, _row_num int, place int")
    assert [tuple(r) for r in dedup.dedup_frame(df, ["k"], survivor_order("_row_num", None)).collect()] == [(1, 5, 7)]
    for name in ("_row_id", "__stored_row_id"):
        with pytest.raises(ReservedName, match=name):
            store.table("s", "t").append(df.withColumnRenamed("place", name))


def test_a_null_tiebreaker_loses(spark):
    df = spark.createDataFrame([(1, None, "null"), (1, 5, "five")], "k int, t int, tag string")
    assert [r.tag for r in dedup.dedup_frame(df, ["k"], survivor_order("t", None)).collect()] == ["five"]


def test_new_columns_come_through_stream_and_merge(spark, store, tmp_path):
    source, spec = f"file://{tmp_path}/src", TableSpec("s", "sink")
    wide = spark.createDataFrame([("a", "t", "n"), ("b", "t", "n")], "record_id string, tag string, new_col string")
    sink, target = store.table("s", "sink"), store.table("s", "target")
    for t in (sink, target):
        t.append(spark.createDataFrame([("a", "old")], "record_id string, tag string").where("1 = 0" if t is sink else "1 = 1"))
        features.ensure_features(t, "s")
    wide.write.parquet(source)
    Flow(spark, spec, source, sink, f"file://{tmp_path}/state").run()
    target.append(missing_rows(wide, target.read(), ["record_id"]))
    assert sink.read(row_id=True).select("_row_id").distinct().count() == 2 and "new_col" in sink.read().columns
    assert {r.record_id: (r.tag, r.new_col) for r in target.read().collect()} == {"a": ("old", None), "b": ("t", "n")}
    assert features.row_tracking_enabled(sink.snapshot().properties)


def test_change_feed_shows_the_rewrite_and_a_clean_run_writes_nothing(spark, store):
    t = store.table("s", "t")
    t.append(usage(spark, ("a", 1, "x"), ("b", 1, "x")))
    features.ensure_features(t, "s.t")
    t.append(usage(spark, ("a", 1, "x")))
    dedup.dedup_table(t, "s.t", ["record_id"], "usage_date")
    counts = {r._change_type: r["count"] for r in t.changes(1).groupBy("_change_type").count().collect()}
    assert counts == {"insert": 3, "delete": 3}
    version = t.version()
    report = dedup.dedup_table(t, "s.t", ["record_id"], "usage_date")
    assert (report["status"], t.version()) == ("clean", version)


def test_missing_is_skipped_and_empty_is_clean(spark, store):
    assert dedup.dedup_table(store.table("s", "none"), "s.none", ["k"], "t")["status"] == "skipped"
    t = store.table("s", "empty")
    t.append(spark.createDataFrame([], "k int, t int"))
    assert dedup.dedup_table(t, "s.empty", ["k"], "t")["status"] == "clean"


@pytest.mark.parametrize("seed", range(3))
def test_random_copies_match_a_plain_model(spark, seed):
    rnd = random.Random(seed)
    rows = [(rnd.choice([None, 1, 2, 3]), rnd.choice([None, "x", "y"]), rnd.choice([None, 1, 2, 3]), i) for i in range(60)]
    df = spark.createDataFrame(rows, "a int, b string, t int, id int")
    for newest in (False, True):
        want = {}
        for r in rows:
            latest = (r[2] is None, -(r[2] or 0))
            rank = (latest, r[3]) if newest else (r[3], latest)
            want[r[:2]] = min(want.get(r[:2], (rank, r[3])), (rank, r[3]))
        got = dedup.dedup_frame(df, ["a", "b"], survivor_order("t", "id", newest))
        assert {(r.a, r.b): r.id for r in got.collect()} == {k: v[1] for k, v in want.items()}
    groups = {(r.a, r.b) for r in dedup.duplicate_groups(df, ["a", "b"]).collect()}
    assert groups == {k for k in {r[:2] for r in rows} if sum(r[:2] == k for r in rows) > 1}


def test_properties():
    assert features.row_tracking_enabled({features.ROW_TRACKING: " TRUE "})
    assert not features.row_tracking_enabled({features.ROW_TRACKING: "false"}) and not features.row_tracking_enabled({})
    assert features.missing_features({features.ROW_TRACKING: "false", features.CHANGE_FEED: "true"}) == {features.ROW_TRACKING: "true"}
    assert list(features.missing_features({})) == sorted(features.FEATURES)


def test_a_day_is_its_midnight():
    assert as_datetime(day(3)) == dt.datetime(2026, 1, 3)
    assert as_datetime(dt.datetime(2026, 1, 3, 4)) == dt.datetime(2026, 1, 3, 4) and as_datetime(None) is None
