import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tidemark.functions.schema import SchemaConflict
from tidemark.operators import merge
from tidemark.plans.config import EngineConfig
from tidemark.plans.registry import OVERWRITE, TableSpec
from tidemark.streaming.flows import Flow, flow_name, start_flows


def at(hour, day=1):
    return dt.datetime(2024, 1, day, hour)


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "date"])
def test_the_bound_is_inclusive_for_every_time_type(spark, kind):
    df = spark.createDataFrame([(1, at(0, 1)), (2, at(0, 2)), (3, at(0, 3)), (4, None)], "k int, t timestamp").withColumn("t", F.col("t").cast(kind))
    mark = merge.high_water_mark(df.where("k <= 3"), "t")
    assert mark.zoned == (kind == "timestamp") and mark.datetime() == at(0, 3)
    got = {r.k for r in merge.incremental_read(df, "t", mark, 24).collect()}
    assert got == {2, 3}
    assert merge.incremental_read(df, "t", None, 24).count() == 4


def test_the_bound_reaches_the_scan(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    plan = merge.incremental_read(events, "ts", at(3), 4)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "GreaterThanOrEqual(ts,2023-12-31T23:00)" in plan


def test_merge_inserts_what_is_missing_and_changes_nothing(spark, store):
    t = store.table("s", "t")
    schema = "k int, t timestamp_ntz, v string"
    first = spark.createDataFrame([(1, at(1), "old"), (None, at(2), "old")], schema)
    report = merge.process_watermark_table(first, t, "s.t", ["k"], "t")
    assert (report["note"], report["rows_read"]) == ("initial load", 2)
    more = spark.createDataFrame([(1, at(5), "new"), (None, at(5), "new"), (2, at(5), "new"), (2, at(5), "new"), (3, dt.datetime(2023, 1, 1), "late")], schema)
    report = merge.process_watermark_table(more, t, "s.t", ["k"], "t", 4)
    assert report["rows_read"] == 4  # read, not inserted; what is older than mark and buffer is not read
    assert sorted((r.k or 0, r.v) for r in t.read().collect()) == [(0, "old"), (1, "old"), (2, "new"), (2, "new")]


def test_no_source_rows_create_nothing_and_an_empty_archive_is_merged(spark, store):
    t = store.table("s", "t")
    rows = spark.createDataFrame([(1, at(1))], "k int, t timestamp_ntz")
    assert merge.process_watermark_table(rows.where("1 = 0"), t, "s.t", ["k"], "t")["note"] == "no source rows"
    assert not t.exists()
    t.append(rows.where("1 = 0"))
    merge.process_watermark_table(rows, t, "s.t", ["k"], "t")
    assert t.read().count() == 1 and [r.operation for r in t.history().collect()] == ["append", "append"]


def test_a_merge_opens_files_that_can_have_the_keys(spark, store):
    t = store.table("s", "t")
    rows = lambda a, b: spark.range(a, b).select(F.col("id").alias("k"), F.concat(F.lit("n"), F.col("id")).alias("name"), F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id)").alias("t"))
    t.append(rows(0, 10_000).repartitionByRange(10, "k"))
    report = merge.process_watermark_table(rows(9_500, 10_200), t, "s.t", ["k", "name"], "t", 0)
    assert (report["rows_read"], report["files_compared"], report["count_after"]) == (201, 1, 10_200)
    with_null = rows(9_900, 10_300).withColumn("k", F.when(F.col("k") != 10_250, F.col("k")))
    files = len(t.snapshot().files)
    report = merge.process_watermark_table(with_null, t, "s.t", ["k"], "t", 24)
    assert report["count_after"] == 10_300 and report["files_compared"] == files  # a null may be anywhere
    report = merge.process_watermark_table(with_null, t, "s.t", ["k"], "t", 24)
    assert report["count_after"] == 10_300 and t.read().where("k IS NULL").count() == 1


def test_a_small_batch_moves_nothing_of_the_archive(spark, sf_dir, store):
    t = store.table("s", "t")
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    t.append(lines.withColumn("l_returnflag", F.when(F.col("l_linenumber") == 2, F.lit(None)).otherwise(F.col("l_returnflag"))))
    keys = ["l_orderkey", "l_linenumber", "l_returnflag"]
    batch = t.read().limit(20).unionByName(t.read().limit(2).withColumn("l_orderkey", F.lit(-1).cast("long")))
    small, large = merge.missing_rows(batch, t.read(), keys), merge.missing_rows(batch, t.read(), keys, most_sent=0)
    plan = small._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan and "LeftSemi" in plan
    assert [r.l_orderkey for r in small.collect()] == [r.l_orderkey for r in large.collect()] == [-1, -1]


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "date"])
def test_the_log_knows_the_latest_times(spark, store, kind, monkeypatch):
    t = store.table("s", "t")
    df = spark.createDataFrame([(1, at(5, 1)), (2, dt.datetime(2024, 1, 2, 3, 4, 5, 6)), (3, None)], "k int, t timestamp").withColumn("t", F.col("t").cast(kind))
    t.append(df.where("k = 3"))
    assert merge.high_water_mark(t, "t") is None
    t.append(df.where("k < 3").repartition(2))
    scanned = merge.high_water_mark(t.read(), "t")
    monkeypatch.setattr(type(t), "_scan", None)  # no row is read
    assert merge.high_water_mark(t, "t") == scanned is not None


def test_the_null_safe_anti_join_is_hashed(spark):
    a = spark.createDataFrame([(1, "x")], "k int, l string")
    plan = merge.missing_rows(a, a, ["k", "l"])._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_overwrite_replaces_rows_and_schema(spark, store):
    t = store.table("s", "t")
    merge.process_overwrite_table(spark.range(5), t, "s.t")
    report = merge.process_overwrite_table(spark.range(2).select(F.col("id").cast("string").alias("name")), t, "s.t")
    assert report["count_after"] == 2 and t.read().columns == ["name"]


def flow(spark, store, tmp_path, **options):
    spec = TableSpec("s", "t", natural_keys=("id",), tiebreaker="id")
    return Flow(spark, spec, f"file://{tmp_path}/src", store.table("s", "t"), f"file://{tmp_path}/state", **options)


def test_restart_reads_only_new_files_and_refresh_reads_all(spark, store, tmp_path):
    f = flow(spark, store, tmp_path, files_per_batch=1)
    for i in range(3):
        spark.range(i * 10, i * 10 + 10, numPartitions=1).write.mode("append").parquet(f.source)
        f.run()
    assert f.table.read().count() == 30 and f.table.read().distinct().count() == 30
    f.run()
    assert f.table.read().count() == 30
    f.refresh()
    f.run()
    assert f.table.read().count() == 60  # nothing is deleted


def test_deletions_pass_unnoticed_and_rewritten_files_come_again(spark, store, tmp_path):
    f = flow(spark, store, tmp_path)
    spark.range(10).coalesce(1).write.parquet(f.source)
    f.run()
    folder = str(tmp_path / "src")
    part = next(n for n in os.listdir(folder) if n.startswith("part-"))
    os.rename(f"{folder}/{part}", f"{folder}/compacted-{part}")
    for n in os.listdir(folder):
        if n.endswith(".crc"):
            os.remove(f"{folder}/{n}")
    f.run()
    assert f.table.read().count() == 20
    os.remove(f"{folder}/compacted-{part}")
    spark.range(10, 12).coalesce(1).write.mode("append").parquet(f.source)
    f.run()
    assert f.table.read().count() == 22


def test_a_changed_type_fails_the_flow_and_leaves_the_table(spark, store, tmp_path):
    f = flow(spark, store, tmp_path)
    spark.range(3).write.parquet(f.source)
    f.run()
    text = Flow(spark, f.spec, f"file://{tmp_path}/other", f.table, f"file://{tmp_path}/state2")
    spark.createDataFrame([("x",)], "id string").write.parquet(text.source)
    with pytest.raises(Exception, match="cannot become|SchemaConflict"):
        text.run()
    assert f.table.read().count() == 3
    assert issubclass(SchemaConflict, ValueError)


def test_flows_start_for_streamed_tables_that_are_not_excluded(spark, store, tmp_path):
    specs = [TableSpec("s", "a"), TableSpec("s", "b"), TableSpec("s", "c", OVERWRITE)]
    for s in specs:
        spark.range(2).write.parquet(f"file://{tmp_path}/{s.table}")
    config = EngineConfig(store.root, exclude_tables="s.b")
    queries = start_flows(spark, specs, config, lambda s: f"file://{tmp_path}/{s.table}", store, f"file://{tmp_path}/state")
    for q in queries:
        q.awaitTermination()
    assert [q.name for q in queries] == [flow_name(specs[0])] == ["s_a_flow"]
    assert store.table("s", "a").read().count() == 2 and not store.table("s", "b").exists()
