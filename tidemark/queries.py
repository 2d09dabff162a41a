"""The registered queries of the archive engine, each with the SQL that DuckDB answers alike."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.keys import micros, survivor_order
from tidemark.operators import dedup, features, freshness, merge
from tidemark.plans.config import EngineConfig
from tidemark.plans.registry import OVERWRITE, STREAM, WATERMARK, WIRE, TableSpec, builtin
from tidemark.plans.runner import Engine, RunReport, TablesFailed, daily, summary
from tidemark.sources.change_feed import follow
from tidemark.sources.files import Files, shared_root
from tidemark.sources.store import ROW_ID, ArchiveStore, ArchiveTable, ConcurrentCommit
from tidemark.streaming.flows import Flow, start_flows

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def new_store(spark: SparkSession) -> ArchiveStore:
    return ArchiveStore(spark, f"{shared_root(spark)}/archive-{uuid.uuid4().hex[:12]}")


def new_table(spark: SparkSession, name: str) -> ArchiveTable:
    return new_store(spark).table("main", name)


LINE_KEY = ["l_orderkey", "l_linenumber"]
LINE_ORDER = "l_shipdate DESC NULLS LAST, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_discount, l_tax, l_returnflag, l_linestatus"


@query("SELECT * FROM events")
def archive_reappend_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole path: events come twice, duplicates are found, the table is rewritten by row id and verified."""
    table = new_table(spark, "events")
    events = read(spark, sf_dir, "events")
    table.append(events)
    features.ensure_features(table, "main.events")
    table.append(events)
    report = dedup.dedup_table(table, "main.events", ["event_id"], "ts")
    if report["status"] != "deduped":
        raise RuntimeError(report)
    return table.read()


@query(f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {LINE_ORDER}) AS rn FROM lineitem) WHERE rn = 1")
def dedup_tiebreaker(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest row of each order line; further columns make the order total."""
    more = [F.col(c) for c in ("l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus")]
    return dedup.dedup_frame(read(spark, sf_dir, "lineitem"), LINE_KEY, [*survivor_order("l_shipdate", None), *more])


@query("SELECT * FROM events")
def dedup_earliest_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of the rows come again, marked; the copies written first survive."""
    table = new_table(spark, "events")
    events = read(spark, sf_dir, "events")
    table.append(events)
    table.append(events.where("event_id % 3 = 0").withColumn("props", F.lit("again")))
    return dedup.dedup_frame(table.read(row_id=True), ["event_id"], survivor_order("ts", ROW_ID)).drop(ROW_ID)


@query("SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC NULLS LAST, event_id) AS rn FROM events) WHERE rn = 1")
def dedup_newest_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest version of each (user, type)."""
    events = read(spark, sf_dir, "events")
    return dedup.dedup_frame(events, ["user_id", "event_type"], survivor_order("ts", "event_id", newest_version_wins=True))


NULLED = "CASE WHEN doc_id % 7 = 0 THEN NULL ELSE lang END"


@query(f"SELECT * EXCLUDE (rn, g) FROM (SELECT doc_id, {NULLED} AS lang, source, row_number() OVER (PARTITION BY {NULLED}, source ORDER BY doc_id DESC) AS rn, 1 AS g FROM documents) WHERE rn = 1")
def dedup_nullable_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Null keys are equal: one row per (lang or null, source)."""
    docs = read(spark, sf_dir, "documents").select("doc_id", F.expr(NULLED).alias("lang"), "source")
    return dedup.dedup_frame(docs, ["lang", "source"], survivor_order("doc_id", None))


@query("SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def duplicate_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.duplicate_groups(read(spark, sf_dir, "lineitem"), LINE_KEY)


@query("SELECT CASE WHEN count(*) > 0 THEN 1 ELSE 0 END AS has_duplicates FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1 LIMIT 1)")
def duplicate_probe(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = dedup.has_duplicates(read(spark, sf_dir, "lineitem"), LINE_KEY)
    return spark.createDataFrame([(int(found),)], "has_duplicates int")


@query(f"SELECT count(*) AS total_rows, count(DISTINCT row({NULLED}, source)) AS distinct_keys FROM documents")
def verify_unique_nullable(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select(F.expr(NULLED).alias("lang"), "source")
    return dedup.count_keys_by_struct(docs, ["lang", "source"])


HALF = "(SELECT max(event_id) // 2 FROM events)"


def _half(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, ArchiveTable]:
    """All events, and an archive of their first half."""
    events = read(spark, sf_dir, "events")
    middle = events.agg(F.max("event_id")).first()[0] // 2
    table = new_table(spark, "events")
    table.overwrite(events.where(F.col("event_id") < middle))
    return events, table


@query(f"SELECT * FROM events WHERE ts >= (SELECT max(ts) FROM events WHERE event_id < {HALF}) - INTERVAL 4 HOURS")
def watermark_incremental_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    events, table = _half(spark, sf_dir)
    return merge.incremental_read(events, "ts", merge.high_water_mark(table, "ts"), 4)


@query("SELECT * FROM events")
def merge_insert_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    events, table = _half(spark, sf_dir)
    merge.process_watermark_table(events, table, "main.events", ["event_id"], "ts")
    return table.read()


@query("SELECT * FROM orders")
def merge_first_version_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is archived stays, though the source's rows have changed; the missing half comes."""
    orders = read(spark, sf_dir, "orders")
    table = new_table(spark, "orders")
    table.overwrite(orders.where("o_orderkey % 2 = 0"))
    changed = orders.withColumn("o_orderstatus", F.when(F.expr("o_orderkey % 2 = 0"), "changed").otherwise(F.col("o_orderstatus")))
    table.append(merge.missing_rows(changed, table.read(), ["o_orderkey"]))
    return table.read()


@query("SELECT *, CASE WHEN o_orderkey % 2 = 0 THEN NULL ELSE o_orderkey * 2 END AS added FROM orders")
def merge_schema_evolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read(spark, sf_dir, "orders")
    table = new_table(spark, "orders")
    table.overwrite(orders.where("o_orderkey % 2 = 0"))
    wider = orders.withColumn("added", F.col("o_orderkey") * 2)
    table.append(merge.missing_rows(wider, table.read(), ["o_orderkey"]))
    return table.read()


@query(
    "SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN NULL ELSE lang END AS lang, 'old' AS origin FROM documents WHERE doc_id % 2 = 0 UNION ALL "
    "SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN NULL ELSE lang END, 'new' FROM documents d WHERE NOT EXISTS (SELECT 1 FROM documents a WHERE a.doc_id % 2 = 0 "
    "AND (CASE WHEN a.doc_id % 3 = 0 THEN NULL ELSE a.lang END) IS NOT DISTINCT FROM (CASE WHEN d.doc_id % 3 = 0 THEN NULL ELSE d.lang END) AND a.doc_id // 4 = d.doc_id // 4)"
)
def merge_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Insert-only merge on (doc_id div 4, lang), lang partly null: null keys match."""
    docs = read(spark, sf_dir, "documents").select("doc_id", F.expr("CASE WHEN doc_id % 3 = 0 THEN NULL ELSE lang END").alias("lang"), F.expr("doc_id div 4").alias("part"))
    table = new_table(spark, "documents")
    table.overwrite(docs.where("doc_id % 2 = 0").withColumn("origin", F.lit("old")))
    table.append(merge.missing_rows(docs.withColumn("origin", F.lit("new")), table.read(), ["part", "lang"]))
    return table.read().drop("part")


@query("SELECT * FROM supplier")
def initial_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = new_table(spark, "supplier")
    merge.process_watermark_table(read(spark, sf_dir, "supplier"), table, "main.supplier", ["s_suppkey"], "s_suppkey")
    return table.read()


@query("SELECT * FROM nation")
def full_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = new_table(spark, "nation")
    nation = read(spark, sf_dir, "nation")
    for rows in (nation.where("n_nationkey < 5"), nation):
        merge.process_overwrite_table(rows, table, "main.nation")
    return table.read()


@query("SELECT p_partkey, p_size * 2 AS p_size2 FROM part")
def overwrite_schema_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = new_table(spark, "part")
    part = read(spark, sf_dir, "part")
    merge.process_overwrite_table(part, table, "main.part")
    merge.process_overwrite_table(part.select("p_partkey", (F.col("p_size") * 2).alias("p_size2")), table, "main.part")
    return table.read()


EVENTS = TableSpec("main", "events", natural_keys=("event_id",), tiebreaker="ts")


def _event_stream(spark: SparkSession, sf_dir: str, parts: int = 4) -> tuple[str, DataFrame, Flow]:
    store = new_store(spark)
    source = f"{store.root}/source"
    events = read(spark, sf_dir, "events")
    return source, events, Flow(spark, EVENTS, source, store.table("main", "events"), f"{store.root}/state")


@query("SELECT * FROM events")
def stream_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs of a flow: files that have come in between are read once."""
    source, events, flow = _event_stream(spark, sf_dir)
    for part in (0, 1):
        events.where(f"event_id % 2 = {part}").write.mode("append").parquet(source)
        flow.run()
    flow.run()
    return flow.table.read()


@query("SELECT * FROM events")
def stream_full_refresh_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All files come again after a refresh; dedup keeps the copies of the first run."""
    source, events, flow = _event_stream(spark, sf_dir)
    events.write.parquet(source)
    flow.run()
    features.ensure_features(flow.table, EVENTS.name)
    flow.refresh()
    flow.run()
    report = dedup.dedup_table(flow.table, EVENTS.name, ["event_id"], "ts")
    if report["duplicates_removed"] * 2 != report["count_before"]:
        raise RuntimeError(report)
    return flow.table.read()


@query("SELECT event_id, ts, user_id, event_type, value, CASE WHEN event_id % 2 = 0 THEN NULL ELSE props END AS props FROM events")
def stream_schema_evolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, events, flow = _event_stream(spark, sf_dir)
    events.where("event_id % 2 = 0").drop("props").write.parquet(source)
    flow.run()
    events.where("event_id % 2 = 1").write.mode("append").parquet(source)
    flow.run()
    return flow.table.read()


@query(
    "SELECT 'insert' AS change_type, 0::BIGINT AS commit_version, count(*) AS n FROM orders UNION ALL SELECT 'insert', 1, count(*) FROM orders WHERE o_orderkey % 2 = 0 "
    "UNION ALL SELECT 'delete', 2, (SELECT count(*) FROM orders) + (SELECT count(*) FROM orders WHERE o_orderkey % 2 = 0) UNION ALL SELECT 'insert', 2, count(*) FROM orders"
)
def change_feed_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Append, append again, dedup: the rewrite shows as deletion and insertion of every row."""
    table = new_table(spark, "orders")
    orders = read(spark, sf_dir, "orders")
    table.append(orders)
    table.append(orders.where("o_orderkey % 2 = 0"))
    dedup.dedup_table(table, "main.orders", ["o_orderkey"], "o_orderdate")
    return table.changes(0).groupBy(F.col("_change_type").alias("change_type"), F.col("_commit_version").alias("commit_version")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "SELECT 0::BIGINT AS commit_version, 'insert' AS change_type, count(*) AS n, sum(n_nationkey)::BIGINT AS keys FROM nation UNION ALL SELECT 1, t, count(*), sum(n_nationkey)::BIGINT FROM nation, (VALUES ('update_preimage'), ('update_postimage')) v(t) WHERE n_regionkey = 1 GROUP BY t"
)
def change_feed_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed as a stream in two runs: an append, then an update's images."""
    store = new_store(spark)
    table = store.table("main", "nation")
    target = store.table("main", "changes")

    def deliver(changes: DataFrame, version: int) -> None:
        target.append(changes, transaction=("feed", version))

    table.append(read(spark, sf_dir, "nation"))
    follow(table, deliver, f"{store.root}/feed").awaitTermination()
    table.update(F.col("n_regionkey") == 1, {"n_name": F.lower("n_name")})
    follow(table, deliver, f"{store.root}/feed").awaitTermination()
    return target.read().groupBy(F.col("_commit_version").alias("commit_version"), F.col("_change_type").alias("change_type")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("n_nationkey").cast("long")).alias("keys"))


@query("SELECT * FROM orders")
def dedup_few_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row in a thousand comes again, changed: the copies are marked as deleted, and no file is rewritten."""
    table = new_table(spark, "orders")
    orders = read(spark, sf_dir, "orders")
    table.append(orders)
    features.ensure_features(table, "main.orders")
    table.append(orders.where("o_orderkey % 1000 = 1").withColumn("o_orderstatus", F.lit("again")))
    files = table.snapshot().files
    report = dedup.dedup_table(table, "main.orders", ["o_orderkey"], "o_orderdate")
    if report["method"] != "marked" or [f.path for f in table.snapshot().files] != [f.path for f in files]:
        raise RuntimeError(report)
    return table.read()


@query(
    "SELECT 'insert' AS change_type, 0::BIGINT AS commit_version, count(*) AS n, sum(o_orderkey)::BIGINT AS keys FROM orders UNION ALL "
    "SELECT t, v, count(*), sum(o_orderkey)::BIGINT FROM orders, (VALUES ('insert', 1::BIGINT), ('delete', 2)) c(t, v) WHERE o_orderkey % 1000 = 1 GROUP BY t, v"
)
def change_feed_of_few(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the feed has of such a dedup: each copy's deletion, and nothing of the other rows; a compaction adds nothing."""
    table = new_table(spark, "orders")
    orders = read(spark, sf_dir, "orders")
    table.append(orders)
    table.append(orders.where("o_orderkey % 1000 = 1"))
    dedup.dedup_table(table, "main.orders", ["o_orderkey"], "o_orderdate")
    table.compact()
    return table.changes(0).groupBy(F.col("_change_type").alias("change_type"), F.col("_commit_version").alias("commit_version")).agg(F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("keys"))


BETWEEN = "l_orderkey BETWEEN (SELECT max(l_orderkey) // 2 FROM lineitem) AND (SELECT max(l_orderkey) // 2 + max(l_orderkey) // 50 FROM lineitem)"


@query(f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {LINE_ORDER}) AS rn FROM lineitem WHERE {BETWEEN}) WHERE rn = 1")
def clustered_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dedup's rewrite deals rows out by their key; a filter on it opens few of the files."""
    table = new_table(spark, "lineitem")
    lines = dedup_tiebreaker(spark, sf_dir)  # one row a key, so that which one stays is no matter of chance
    table.append(lines.repartitionByRange(32, "l_orderkey", "l_linenumber").sortWithinPartitions("l_orderkey"))
    middle, step = (table.latest("l_orderkey") // n for n in (2, 50))
    opened = table.files_between({"l_orderkey": (middle, middle + step)})
    if len(opened) * 10 > len(table.snapshot().files):
        raise RuntimeError(f"{len(opened)} files")
    return table.read(between={"l_orderkey": (middle, middle + step)})


@query(
    "SELECT 'orders' AS of, count(*) AS n FROM orders WHERE o_totalprice BETWEEN 100000 AND 120000 UNION ALL SELECT 'dates', count(*) FROM orders WHERE o_orderdate BETWEEN (SELECT min(o_orderdate) FROM orders) AND (SELECT min(o_orderdate) + INTERVAL 90 DAYS FROM orders) "
    "UNION ALL SELECT 'customers', count(*) FROM orders WHERE o_custkey <= (SELECT max(o_custkey) // 20 FROM orders)"
)
def clustered_on_a_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders dealt out by customer and date: a filter on either leaves out half of the files or more."""
    table = new_table(spark, "orders")
    table.append(read(spark, sf_dir, "orders"))
    table.cluster(["o_custkey", "o_orderdate"], target=max(1, table.detail()["size_in_bytes"] // 32))
    files = len(table.snapshot().files)
    customers = {"o_custkey": (None, table.latest("o_custkey") // 20)}
    first = table.read().agg(F.min("o_orderdate")).first()[0]
    dates = {"o_orderdate": (first, first + dt.timedelta(days=90))}
    for between in (customers, dates):
        if 2 * len(table.files_between(between)) > files:
            raise RuntimeError(f"{len(table.files_between(between))} of {files} files")
    counted = lambda name, between: table.read(between=between).agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("of"), "n")
    return counted("orders", {"o_totalprice": (100_000, 120_000)}).unionByName(counted("dates", dates)).unionByName(counted("customers", customers))


@query(
    "SELECT * FROM (VALUES ('first', 'clean', 0::BIGINT, true), ('again', 'clean', 0, false), ('more', 'deduped', (SELECT count(*) FROM events WHERE event_id % 100 = 0 AND event_id > (SELECT max(event_id) * 9 // 10 FROM events)), true)) "
    "c(run, status, duplicates_removed, reads) UNION ALL SELECT 'left', 'rows', count(*), true FROM events"
)
def dedup_incremental_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A check after a check reads nothing, one after an append the new rows and the files that can have their keys."""
    table = new_table(spark, "events")
    events = read(spark, sf_dir, "events")
    table.append(events.repartitionByRange(20, "event_id"))
    reports = [dedup.dedup_table(table, "main.events", ["event_id"], "ts") for _ in range(2)]
    late = events.agg(F.max("event_id")).first()[0] * 9 // 10
    table.append(events.where(f"event_id % 100 = 0 AND event_id > {late}").coalesce(1))
    reports.append(dedup.dedup_table(table, "main.events", ["event_id"], "ts"))
    files = table.snapshot().files
    able = sum(f.bounds["event_id"][1] > late for f in files)  # however the ids are spread, only these can have the new rows' keys
    if reports[2]["files_checked"] > able or able == len(files):
        raise RuntimeError(reports[2])
    rows = [(run, r["status"], r["duplicates_removed"], r["files_checked"] > 0) for run, r in zip(("first", "again", "more"), reports)]
    told = spark.createDataFrame(rows, "run string, status string, duplicates_removed long, reads boolean")
    return told.unionByName(table.read().select(F.lit("left").alias("run"), F.lit("rows").alias("status"), F.lit(1).alias("n")).groupBy("run", "status").agg(F.count("n").alias("duplicates_removed")).withColumn("reads", F.lit(True)))


@query("SELECT *, 'committed' AS late_append, 'rejected' AS late_compaction FROM lineitem")
def interleaved_writers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two appends to the same version both stand, with ids of their own; a compaction of files that an update has replaced fails."""
    first = new_table(spark, "lineitem")
    lines = read(spark, sf_dir, "lineitem")
    first.append(lines.where("l_linenumber = 1"))

    def behind() -> ArchiveTable:
        """A writer that has read the version of now, whatever comes until it commits."""
        late = ArchiveTable(spark, first.path)
        held, newest = [late.snapshot()], late.snapshot
        late.snapshot = lambda version=None: held.pop() if held and version is None else newest(version)
        return late

    late = behind()
    first.append(lines.where("l_linenumber = 2"))
    late.append(lines.where("l_linenumber > 2"))
    late = behind()
    first.update(F.col("l_linenumber") == 1, {"l_quantity": F.col("l_quantity")})
    try:
        late.compact()
        outcome = "committed"
    except ConcurrentCommit:
        outcome = "rejected"
    rows = first.read(row_id=True)
    if rows.select(ROW_ID).distinct().count() != rows.count():
        raise RuntimeError("ids")
    return rows.drop(ROW_ID).select("*", F.lit("committed").alias("late_append"), F.lit(outcome).alias("late_compaction"))


@query("SELECT version, rows, swept FROM (VALUES (0::BIGINT, (SELECT count(*) FROM supplier), 1::BIGINT), (1, (SELECT count(*) FROM supplier WHERE s_suppkey > 5), 1)) v(version, rows, swept)")
def orphan_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a killed writer has left goes; every version of the table can still be read."""
    table = new_table(spark, "supplier")
    supplier = read(spark, sf_dir, "supplier")
    table.append(supplier)
    table.overwrite(supplier.where("s_suppkey > 5"))
    supplier.coalesce(1).write.parquet(f"{table.path}/data/left")
    swept = table.sweep(retention_hours=0)
    counted = [table.read(version=v).agg(F.count(F.lit(1)).alias("rows")).select(F.lit(v).cast("long").alias("version"), "rows", F.lit(swept).cast("long").alias("swept")) for v in (0, 1)]
    return counted[0].unionByName(counted[1])


@query("SELECT * EXCLUDE (rn), rn - 1 AS row_id FROM (SELECT *, row_number() OVER (ORDER BY o_orderkey) AS rn FROM orders)")
def compaction_keeps_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many small files become few; every row keeps its id, and the feed has no change."""
    table = new_table(spark, "orders")
    orders = read(spark, sf_dir, "orders")
    parts = max(24, sum(map(table.disk.size, orders.inputFiles())) >> 22)  # about 4 MB each, however large the source is
    table.append(orders.repartitionByRange(parts, "o_orderkey").sortWithinPartitions("o_orderkey"))
    features.ensure_features(table, "main.orders")
    many = len(table.snapshot().files)
    version = table.compact()
    if not len(table.snapshot().files) * 4 < many or not table.changes(version).isEmpty():
        raise RuntimeError(table.detail())
    return table.read(row_id=True).withColumnRenamed(ROW_ID, "row_id")


@query(
    "SELECT event_id, epoch_us(CASE WHEN event_id % 2 = 0 THEN ts ELSE ts + INTERVAL 9000 YEARS END) AS micros, props, CASE WHEN event_id % 2 = 0 THEN NULL ELSE user_id END AS added FROM events "
    "WHERE event_id % 2 = 0 OR event_id % 3 > 0"
)
def append_odd_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names with dots, backticks and other case, and times beyond the year 9999: append, mark, merge, dedup, read with ids."""
    table = new_table(spark, "events")
    events = read(spark, sf_dir, "events")
    even = events.where("event_id % 2 = 0").select("event_id", F.col("ts").alias("the.time"), F.col("props").alias("Props"))
    table.append(even)
    features.ensure_features(table, "main.events")
    later = events.where("event_id % 2 = 1 AND event_id % 3 > 0").select("event_id", F.expr("ts + INTERVAL 9000 YEARS").alias("THE.TIME"), F.col("props").alias("props"), F.col("user_id").alias("a`b"))
    merge.process_watermark_table(later, table, "main.events", ["event_id"], "the.time")
    table.append(even.where("event_id % 100 = 0"))
    dedup.dedup_table(table, "main.events", ["event_id"], "the.time")
    rows = table.read(row_id=True)
    return rows.select("event_id", micros(F.col("`the.time`"), rows.schema["the.time"].dataType).alias("micros"), F.col("Props").alias("props"), F.col("`a``b`").alias("added"))


@query("SELECT count(*) AS total_rows, count(*) AS row_ids, 0::BIGINT AS files_changed FROM lineitem")
def row_id_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row tracking turned on later: every row has an id of its own and no file has changed."""
    table = new_table(spark, "lineitem")
    lines = read(spark, sf_dir, "lineitem")
    for part in (0, 1):
        table.append(lines.where(f"l_linenumber % 2 = {part}"))
    before = table.detail()
    features.ensure_features(table, "main.lineitem")
    after = table.detail()
    changed = int(before["num_files"] != after["num_files"] or before["size_in_bytes"] != after["size_in_bytes"])
    return table.read(row_id=True).agg(F.count(F.lit(1)).alias("total_rows"), F.count_distinct(ROW_ID).alias("row_ids")).withColumn("files_changed", F.lit(changed).cast("long"))


@query("SELECT event_id, ts, user_id, event_type, value, CASE WHEN user_id % 5 = 0 THEN 'edited' ELSE props END AS props FROM events")
def update_survives_reappend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edited rows keep their ids, so they survive when the source's rows come again."""
    table = new_table(spark, "events")
    events = read(spark, sf_dir, "events")
    table.append(events)
    features.ensure_features(table, "main.events")
    table.update(F.expr("user_id % 5 = 0"), {"props": F.lit("edited")})
    table.append(events)
    dedup.dedup_table(table, "main.events", ["event_id"], "ts")
    return table.read()


@query("SELECT version, operation, files_added > 0 AS added, rows_added FROM (VALUES (0::BIGINT, 'append', 1, (SELECT count(*) FROM region)), (1, 'set properties', 0, 0), (2, 'append', 1, (SELECT count(*) FROM region)), (3, 'dedup', 1, (SELECT count(*) FROM region))) h(version, operation, files_added, rows_added)")
def table_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = new_table(spark, "region")
    region = read(spark, sf_dir, "region")
    table.append(region)
    features.ensure_features(table, "main.region")
    features.ensure_features(table, "main.region")  # nothing is missing: no commit
    table.append(region)
    dedup.dedup_table(table, "main.region", ["r_regionkey"], "r_name")
    dedup.dedup_table(table, "main.region", ["r_regionkey"], "r_name")  # clean: no commit
    return table.history().select("version", "operation", (F.col("files_added") > 0).alias("added"), "rows_added")


@query("SELECT * FROM nation")
def time_travel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An overwrite's predecessor stays readable."""
    table = new_table(spark, "nation")
    nation = read(spark, sf_dir, "nation")
    table.append(nation)
    table.overwrite(nation.where("n_nationkey = 0"))
    return table.read(version=0)


STALE_SOURCE = "CASE WHEN event_type = 'view' THEN ts + INTERVAL 30 DAYS ELSE ts END"


@query(
    f"SELECT s.event_type, archive_max, source_max, CASE WHEN archive_max IS NULL OR source_max > archive_max + INTERVAL 48 HOURS THEN 'STALE' ELSE 'OK' END AS status FROM "
    f"(SELECT event_type, max(CASE WHEN event_id % 2 = 0 THEN ts + INTERVAL 3 DAYS ELSE ts END) AS source_max FROM events GROUP BY 1) s LEFT JOIN "
    f"(SELECT event_type, max(ts) AS archive_max FROM events WHERE event_id < {HALF} * 2 - 40 GROUP BY 1) a ON s.event_type = a.event_type"
)
def freshness_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staleness by event type, in one query."""
    events = read(spark, sf_dir, "events")
    middle = events.agg(F.max("event_id")).first()[0] // 2
    source = events.withColumn("ts", F.expr("CASE WHEN event_id % 2 = 0 THEN ts + INTERVAL 3 DAYS ELSE ts END"))
    return freshness.lagging(events.where(F.col("event_id") < middle * 2 - 40), source, ["event_type"], "ts", 48)


@query(
    "SELECT * FROM (VALUES ('fresh', 'OK'), ('stale', 'STALE'), ('at_limit', 'OK'), ('no_archive', 'STALE'), ('no_archive_no_rows', 'OK'), ('empty_archive', 'STALE'), "
    "('empty_both', 'OK'), ('no_source', 'SKIPPED'), ('excluded', 'SKIPPED'), ('broken', 'ERROR')) m(tab, status)"
)
def freshness_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every state of archive and source."""
    events = read(spark, sf_dir, "events")
    none = events.where("1 = 0")
    later = lambda hours: events.withColumn("ts", F.lit(str(last)).cast("timestamp_ntz") + F.expr(f"INTERVAL {hours} HOURS"))
    store = new_store(spark)
    full, empty = store.table("main", "full"), store.table("main", "empty")
    full.append(events)
    empty.append(none)
    last = full.read().agg(F.max("ts")).first()[0]
    missing = lambda: spark.read.parquet(f"{store.root}/nowhere")
    cases = {
        "fresh": (lambda: events, full), "stale": (lambda: later(49), full), "at_limit": (lambda: later(48), full),
        "no_archive": (lambda: events, store.table("main", "none")), "no_archive_no_rows": (lambda: none, store.table("main", "none")),
        "empty_archive": (lambda: events, empty), "empty_both": (lambda: none, empty), "no_source": (missing, full), "broken": (lambda: events.drop("ts"), full),
    }
    rows = [freshness.check_table(name, "ts", source, table, 48) for name, (source, table) in cases.items()]
    rows.append(freshness.check_table("excluded", "ts", missing, full, 48, excluded=True))
    return spark.createDataFrame([(r["table"], r["status"]) for r in rows], "tab string, status string")


@query(
    "SELECT * FROM (VALUES ('excluding', 'nation', false, 0::BIGINT), ('excluding', 'supplier', true, (SELECT count(*) FROM supplier)), ('excluding', 'part', false, 0), ('excluding', 'customer', true, (SELECT count(*) FROM customer)), "
    "('listing', 'nation', true, (SELECT count(*) FROM nation)), ('listing', 'supplier', true, (SELECT count(*) FROM supplier)), ('listing', 'part', true, (SELECT count(*) FROM part)), ('listing', 'customer', false, 0), "
    "('both', 'nation', false, 0), ('both', 'supplier', true, (SELECT count(*) FROM supplier)), ('both', 'part', false, 0), ('both', 'customer', false, 0)) f(run, tab, archived, rows)"
)
def exclude_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch runs over given tables: an exclusion wins over the list; its names may lack the prefix, blanks don't count."""
    specs = [TableSpec("main", name, OVERWRITE) for name in ("nation", "supplier", "part", "customer")]
    excludes, listed = " main.nation, ,system.main.part,", "system.main.nation, system.main.supplier,system.main.part"
    rows = []
    for run, options in {"excluding": {"exclude_tables": excludes}, "listing": {"tables_to_process": listed}, "both": {"tables_to_process": listed, "exclude_tables": excludes}}.items():
        engine = Engine(spark, specs, EngineConfig(new_store(spark).root, **options), lambda s: read(spark, sf_dir, s.table))
        done = {r["table"]: r["count_after"] for r in engine.batch()}
        rows += [(run, s.table, s.name in done, done.get(s.name, 0)) for s in specs]
    return spark.createDataFrame(rows, "run string, tab string, archived boolean, rows long")


@query("SELECT * FROM events")
def read_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table's read options reach the reader of its stream: by one of them it leaves out what else is in the folder."""
    store = new_store(spark)
    events = read(spark, sf_dir, "events")
    events.write.parquet(f"{store.root}/source")
    events.withColumn("props", F.lit("other")).write.option("compression", "zstd").mode("append").parquet(f"{store.root}/source")
    spec = TableSpec("main", "events", natural_keys=("event_id",), tiebreaker="ts", read_options=WIRE | {"pathGlobFilter": "*.snappy.parquet"})
    flow = Flow(spark, spec, f"{store.root}/source", store.table("main", "events"), f"{store.root}/state")
    flow.run()
    return flow.table.read()


@query("SELECT * FROM (VALUES ('stream', 27::BIGINT, 3::BIGINT, 4::BIGINT), ('watermark', 4, 0, 0), ('overwrite', 6, 0, 0)) r(strategy, tables, newest_version_wins, with_options)")
def registry_overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = [(s.strategy, s.newest_version_wins, bool(s.read_options)) for s in builtin()]
    df = spark.createDataFrame(rows, "strategy string, newest boolean, options boolean")
    return df.groupBy("strategy").agg(F.count(F.lit(1)).alias("tables"), F.sum(F.col("newest").cast("long")).alias("newest_version_wins"), F.sum(F.col("options").cast("long")).alias("with_options"))


@query("SELECT strftime(ts, '%Y-%m-%d') AS usage_date, event_type, round(sum(value), 2) AS usage_quantity FROM events WHERE json_extract(props, '$.k') IS NOT NULL GROUP BY ALL ORDER BY usage_date DESC")
def usage_cost_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = read(spark, sf_dir, "events").where(F.get_json_object("props", "$.k").isNotNull())
    daily = events.groupBy(F.date_format("ts", "yyyy-MM-dd").alias("usage_date"), "event_type").agg(F.round(F.sum("value"), 2).alias("usage_quantity"))
    return daily.orderBy(F.desc("usage_date"))


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events WHERE CAST(json_extract_string(props, '$.k') AS BIGINT) > 20")
def nested_field_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A predicate on a field of a struct."""
    events = read(spark, sf_dir, "events").select("event_id", F.from_json("props", "k bigint").alias("props"))
    return events.where("props.k > 20").select("event_id", F.col("props.k").alias("k"))


@query("SELECT event_id, event_type FROM events UNION ALL SELECT event_id, event_type FROM events")
def union_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = read(spark, sf_dir, "events").select("event_id", "event_type")
    return events.unionByName(events)


@query(
    "SELECT * FROM (VALUES ('clean', 1::BIGINT, 0::BIGINT), ('deduped', 1, (SELECT count(*) FROM region)), ('failed', 1, 0), ('skipped', 1, 0)) s(status, tables, duplicates_removed)"
)
def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four tables: without duplicates, with, one whose key doesn't exist, and one that isn't there. The failure waits for the end."""
    store = new_store(spark)
    region, nation = read(spark, sf_dir, "region"), read(spark, sf_dir, "nation")
    store.table("a", "one").append(nation)
    store.table("a", "two").append(region.unionByName(region))
    store.table("b", "three").append(region)
    specs = [TableSpec("a", "one", natural_keys=("n_nationkey",), tiebreaker="n_name"), TableSpec("a", "two", natural_keys=("r_regionkey",), tiebreaker="r_name")]
    specs += [TableSpec("b", "three", natural_keys=("nothing",), tiebreaker="r_name"), TableSpec("b", "four", natural_keys=("x",), tiebreaker="x")]
    report = RunReport.of(specs, lambda s: dedup.dedup_table(store.table(s.schema, s.table), s.name, list(s.natural_keys), s.tiebreaker))
    try:
        report.settle()
        raise RuntimeError("a failure was lost")
    except TablesFailed as e:
        if "b.three" not in str(e):
            raise
    return summary(report.frame(spark)).select("status", "tables", "duplicates_removed")


@query("SELECT * FROM (VALUES ('main.events', 'watermark', 'success', (SELECT count(*) FROM events)), ('main.nation', 'overwrite', 'success', (SELECT count(*) FROM nation))) r(tab, strategy, status, rows_read)")
def batch_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batch task over a small registry."""
    specs = [TableSpec("main", "events", WATERMARK, ("event_id",), "ts"), TableSpec("main", "nation", OVERWRITE)]
    engine = Engine(spark, specs, EngineConfig(new_store(spark).root), lambda s: read(spark, sf_dir, s.table))
    engine.setup()
    return engine.batch(at_once=2).frame(spark).select(F.col("table").alias("tab"), "strategy", "status", "rows_read")


@query("SELECT count(*) AS rows FROM lineitem")
def table_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "lineitem").agg(F.count(F.lit(1)).alias("rows"))


@query("SELECT EXISTS (SELECT 1 FROM events) AS has_rows, EXISTS (SELECT 1 FROM events WHERE ts > TIMESTAMP '2024-01-20') AS has_later, EXISTS (SELECT 1 FROM events WHERE ts > TIMESTAMP '2099-01-01') AS has_much_later")
def existence_probe(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = read(spark, sf_dir, "events")
    beyond = lambda t: not events.where(F.col("ts") > F.lit(t).cast("timestamp_ntz")).isEmpty()
    return spark.createDataFrame([(not events.isEmpty(), beyond("2024-01-20"), beyond("2099-01-01"))], "has_rows boolean, has_later boolean, has_much_later boolean")


@query("SELECT 1::BIGINT AS commit_version, t AS change_type, count(*) AS n, (CASE t WHEN 'update_preimage' THEN 0 ELSE 5 END * count(*))::BIGINT AS micros_added FROM events, (VALUES ('update_preimage'), ('update_postimage')) v(t) WHERE event_id % 10 = 0 GROUP BY t")
def change_feed_precision(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An update that adds five microseconds shows as one; one that sets what is there already doesn't."""
    table = new_table(spark, "events")
    events = read(spark, sf_dir, "events")
    table.append(events)
    table.update(F.expr("event_id % 10 = 0"), {"ts": F.col("ts") + F.expr("INTERVAL '0.000005' SECOND")})
    table.update(F.expr("event_id % 10 = 1"), {"props": F.col("props")})
    changes = table.changes(1).alias("c").join(events.select("event_id", F.col("ts").alias("was")), "event_id")
    micros = F.unix_micros(F.col("ts").cast("timestamp")) - F.unix_micros(F.col("was").cast("timestamp"))
    return changes.groupBy(F.col("_commit_version").alias("commit_version"), F.col("_change_type").alias("change_type")).agg(F.count(F.lit(1)).alias("n"), F.sum(micros).alias("micros_added"))


@query("SELECT event_id, ts, user_id, event_type, value, props, CASE WHEN event_id % 3 = 2 THEN 2::BIGINT ELSE 1 END AS copies FROM events WHERE event_id % 3 <> 0 UNION ALL SELECT event_id, ts, user_id, event_type, value, props, 1 FROM events WHERE event_id % 3 = 0")
def stream_ignores_deletions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A source folder that is deleted after it was read takes nothing away; rows that are written anew come again."""
    source, events, flow = _event_stream(spark, sf_dir)
    files = Files(spark)
    parts = {n: events.where(f"event_id % 3 = {n}") for n in range(3)}
    for n in (0, 1, 2):
        parts[n].write.mode("append").parquet(source)
        flow.run()
        if n == 0:
            files.remove(source)  # gone, and no longer in the source
    parts[2].write.mode("append").parquet(source)  # rewritten
    flow.run()
    return flow.table.read().groupBy(*events.columns).agg(F.count(F.lit(1)).alias("copies"))


@query("SELECT tab, rows FROM (SELECT 'region' AS tab, count(*) AS rows FROM region UNION ALL SELECT 'nation', count(*) FROM nation UNION ALL SELECT 'supplier', NULL FROM range(1))")
def start_all_flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All streamed tables start together; an excluded one doesn't."""
    store = new_store(spark)
    specs = [TableSpec("main", name, natural_keys=("k",), tiebreaker="k") for name in ("region", "nation", "supplier")]
    config = EngineConfig(store.root, exclude_tables="main.supplier")
    for s in specs:
        read(spark, sf_dir, s.table).write.parquet(f"{store.root}/source/{s.table}")
    started = start_flows(spark, specs, config, lambda s: f"{store.root}/source/{s.table}", store, f"{store.root}/state")
    for q in started:
        q.awaitTermination()
    tables = {s.table: store.table("main", s.table) for s in specs}
    return spark.createDataFrame([(name, t.read().count() if t.exists() else None) for name, t in tables.items()], "tab string, rows long")


@query("SELECT * FROM (VALUES (2::BIGINT, 1::BIGINT, 1::BIGINT, 'main.nothing')) e(tables, succeeded, failed, failed_table)")
def exit_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a run hands to its scheduler, read back from its JSON."""
    report = RunReport.of([TableSpec("main", "region"), TableSpec("main", "nothing")], lambda s: {"table": s.name, "status": "success", "rows_read": read(spark, sf_dir, s.table).count()})
    told = spark.createDataFrame([(report.exit_value(),)], "j string")
    parsed = told.select(F.from_json("j", "tables bigint, by_status map<string, bigint>, results array<struct<table string, status string>>").alias("r"))
    return parsed.select("r.tables", F.col("r.by_status")["success"].alias("succeeded"), F.col("r.by_status")["failed"].alias("failed"), F.filter("r.results", lambda x: x["status"] == "failed")[0]["table"].alias("failed_table"))


@query("SELECT * FROM (VALUES ('a', false, false), ('b', true, false)) d(name, there_before, there_after)")
def drop_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A schema is dropped with its tables; one that isn't there is no error."""
    store = new_store(spark)
    region = read(spark, sf_dir, "region")
    store.table("b", "region").append(region)
    before = {n: store.table(n, "region").exists() for n in "ab"}
    for n in "ab":
        store.drop_schema(n)
    return spark.createDataFrame([(n, before[n], store.table(n, "region").exists()) for n in "ab"], "name string, there_before boolean, there_after boolean")


@query("SELECT p.*, n AS rows FROM (VALUES ('plain', false, 2::BIGINT), ('tracked', true, 1), ('both', true, 0)) p(tab, row_tracking, missing), (SELECT count(*) AS n FROM orders)")
def read_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    store, rows = new_store(spark), []
    for name, properties in {"plain": {}, "tracked": {features.ROW_TRACKING: " TRUE "}, "both": dict.fromkeys(features.FEATURES, "true")}.items():
        table = store.table("main", name)
        orders = read(spark, sf_dir, "orders")
        table.create(orders.schema, properties)
        table.append(orders)
        found = table.snapshot().properties
        rows.append((name, features.row_tracking_enabled(found), len(features.missing_features(found)), table.read().count()))
    return spark.createDataFrame(rows, "tab string, row_tracking boolean, missing long, rows long")


@query("SELECT 'rejected' AS second_writer, count(*) AS rows, 1::BIGINT AS version FROM lineitem")
def concurrent_commit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of two writers that have read the same version the second one fails, and nothing of it is seen."""
    first = new_table(spark, "lineitem")
    lines = read(spark, sf_dir, "lineitem")
    first.append(lines.where("l_linenumber = 1"))
    second = ArchiveTable(spark, first.path)
    base = second.snapshot()
    first.append(lines.where("l_linenumber <> 1"))
    second.snapshot = lambda version=None: base  # what it read before
    try:
        second.overwrite(lines.where("1 = 0"))
        outcome = "committed"
    except ConcurrentCommit:
        outcome = "rejected"
    return first.read().agg(F.count(F.lit(1)).alias("rows")).select(F.lit(outcome).alias("second_writer"), "rows", F.lit(first.version()).cast("long").alias("version"))


@query("SELECT * FROM (VALUES ('main.events', 'deduped', true, 0::BIGINT), ('main.nation', 'clean', true, 0), ('main.region', 'failed', false, 0)) m(tab, status, features, warnings)")
def maintenance_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dedup task: a failing table raises at the end and gets no features, the others do; an excluded one is deduped too."""
    specs = [TableSpec("main", "events", natural_keys=("event_id",), tiebreaker="ts"), TableSpec("main", "nation", natural_keys=("n_nationkey",), tiebreaker="n_name"), TableSpec("main", "region", natural_keys=("nothing",), tiebreaker="r_name")]
    engine = Engine(spark, specs, EngineConfig(new_store(spark).root, exclude_tables="main.events"), lambda s: read(spark, sf_dir, s.table))
    engine.setup()
    for s in specs:
        for _ in range(2 if s.table == "events" else 1):
            engine.store.table("main", s.table).append(read(spark, sf_dir, s.table))
    try:
        engine.dedup(at_once=2)
        failed = set()
    except TablesFailed as e:
        failed = {s.name for s in specs if s.name in str(e)}
    rows = []
    for s in specs:
        table = engine.store.table("main", s.table)
        status = "failed" if s.name in failed else "deduped" if table.commit_record(min(2, table.version()))["operation"] == "dedup" else "clean"
        rows.append((s.name, status, not features.missing_features(table.snapshot().properties), len(engine.warnings)))
    return spark.createDataFrame(rows, "tab string, status string, features boolean, warnings long")


@query("SELECT * FROM (VALUES ('events', true, (SELECT count(*) FROM events)), ('orders', true, (SELECT count(*) FROM orders)), ('nation', false, (SELECT count(*) FROM nation))) f(tab, features, rows)")
def feature_scope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Streamed and merged tables get row tracking and the change feed, those that are replaced outright don't."""
    specs = [EVENTS, TableSpec("main", "orders", WATERMARK, ("o_orderkey",), "o_orderdate"), TableSpec("main", "nation", OVERWRITE)]
    engine = Engine(spark, specs, EngineConfig(new_store(spark).root), lambda s: read(spark, sf_dir, s.table))
    engine.store.table("main", "events").append(read(spark, sf_dir, "events"))
    engine.dedup()
    engine.batch()
    tables = {s.table: engine.store.table("main", s.table) for s in specs}
    return spark.createDataFrame([(n, not features.missing_features(t.snapshot().properties), t.read().count()) for n, t in tables.items()], "tab string, features boolean, rows long")


@query("SELECT * FROM (VALUES ('main.nation', 'a warning', 'success')) w(tab, warning, status)")
def feature_warnings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features that can't be turned on are a warning, not a failure of the table."""
    specs = [TableSpec("main", "nation", WATERMARK, ("n_nationkey",), "n_nationkey")]
    engine = Engine(spark, specs, EngineConfig(new_store(spark).root), lambda s: read(spark, sf_dir, s.table))

    class Locked(ArchiveTable):
        def set_properties(self, properties):
            raise PermissionError("a warning")

    engine.store.table = lambda schema, name: Locked(spark, f"{engine.store.root}/{schema}/{name}")
    results = engine.batch()
    return spark.createDataFrame([(w["table"], w["warning"], r["status"]) for w, r in zip(engine.warnings, results)], "tab string, warning string, status string")


@query("SELECT * FROM (VALUES ('stream', 'failed', 0::BIGINT), ('dedup', 'success', (SELECT count(*) FROM events)), ('batch', 'success', (SELECT count(*) FROM supplier))) t(task, state, rows)")
def task_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily run over given tables: its stream has no source, dedup and batch do their work all the same."""
    store = new_store(spark)
    specs = [EVENTS, TableSpec("main", "supplier", WATERMARK, ("s_suppkey",), "s_suppkey")]
    engine = Engine(spark, specs, EngineConfig(store.root), lambda s: read(spark, sf_dir, s.table))
    for _ in range(2):
        store.table("main", "events").append(read(spark, sf_dir, "events"))
    nowhere = Flow(spark, EVENTS, f"{store.root}/nowhere", store.table("main", "events"), f"{store.root}/state")
    done = daily({"stream": nowhere.run, "dedup": engine.dedup, "batch": engine.batch})
    rows = {"stream": 0, "dedup": store.table("main", "events").read().count(), "batch": store.table("main", "supplier").read().count()}
    return spark.createDataFrame([(name, d["state"], rows[name]) for name, d in done.items()], "task string, state string, rows long")


@query(
    "SELECT 'days' AS tab, CASE WHEN max(CAST(ts AS DATE)) + INTERVAL 3 DAYS > CAST(max(CAST(ts AS DATE)) AS TIMESTAMP) + INTERVAL 48 HOURS THEN 'STALE' ELSE 'OK' END AS status FROM events "
    "UNION ALL SELECT 'days_at_limit', CASE WHEN max(CAST(ts AS DATE)) + INTERVAL 2 DAYS > CAST(max(CAST(ts AS DATE)) AS TIMESTAMP) + INTERVAL 48 HOURS THEN 'STALE' ELSE 'OK' END FROM events"
)
def freshness_of_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A day counts as its midnight, in the archive and in the source."""
    days = read(spark, sf_dir, "events").select(F.col("ts").cast("date").alias("day"))
    table = new_table(spark, "days")
    table.append(days)
    rows = [freshness.check_table(name, "day", lambda n=n: days.select(F.date_add("day", n).alias("day")), table, 48) for name, n in (("days", 3), ("days_at_limit", 2))]
    return spark.createDataFrame([(r["table"], r["status"]) for r in rows], "tab string, status string")


@query("SELECT * FROM (VALUES ('main.events', 'OK', 'raised'), ('main.orders', 'STALE', 'raised'), ('main.supplier', 'SKIPPED', 'raised')) f(tab, status, outcome)")
def freshness_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The freshness task over a registry: replaced tables aren't checked, excluded ones are skipped, a stale one raises."""
    specs = [TableSpec("main", "events", STREAM, ("event_id",), "ts"), TableSpec("main", "orders", WATERMARK, ("o_orderkey",), "o_orderdate"), TableSpec("main", "supplier", STREAM, ("s_suppkey",), "s_suppkey"), TableSpec("main", "nation", OVERWRITE)]
    engine = Engine(spark, specs, EngineConfig(new_store(spark).root, exclude_tables="main.supplier"), lambda s: read(spark, sf_dir, s.table))
    engine.setup()
    engine.store.table("main", "events").append(read(spark, sf_dir, "events"))
    results = engine.freshness()
    try:
        freshness.raise_if_stale(results)
        outcome = "passed"
    except freshness.StaleTables:
        outcome = "raised"
    return spark.createDataFrame([(r["table"], r["status"], outcome) for r in results], "tab string, status string, outcome string")


@query("SELECT range AS id FROM range((SELECT count(*) FROM lineitem))")
def row_generator(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As many generated rows as there are order lines, through the store, their row ids being what was generated."""
    table = new_table(spark, "generated")
    rows = read(spark, sf_dir, "lineitem").count()
    table.append(spark.range(0, rows, numPartitions=max(3, -(-rows // 4_000_000))))  # each partition is a range of its own, in order: no shuffle, no sort
    return table.read(row_id=True).where(F.col(ROW_ID) == F.col("id")).select("id")


def clean_up(spark: SparkSession) -> None:
    """Removes the archives that queries have left in the shared folder."""
    root, files = shared_root(spark), Files(spark)
    for name in files.names(root):
        if name.startswith("archive-"):
            files.remove(f"{root}/{name}")
