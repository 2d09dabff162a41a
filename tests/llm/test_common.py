import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import common


def test_words_are_the_same_in_any_block():
    rnd = random.Random(1)
    alphabet = ["a", "B", "é", "日", ".", " ", " ", "\n", "\t", "\x0b", "\xa0", "z" * 9]
    texts = ["", " ", "one", " one  two\r\n", "x" * 500] + ["".join(rnd.choice(alphabet) for _ in range(400)) for _ in range(40)]
    whole, small = common.Words(), common.Words(16)
    by_word = {}
    for text in texts:
        words, hashes = text.encode().lower().split(), whole(text.encode())
        assert len(words) == len(hashes) and np.array_equal(hashes, small(text.encode()))
        for w, h in zip(words, hashes.tolist()):
            assert by_word.setdefault(w, h) == h
    assert len(set(by_word.values())) == len(by_word)
    many = {f"{a}{b}{c}" for a in "abcdefghij" for b in "klmnopqrst" for c in range(300)}
    assert len(set(whole(" ".join(many).encode()).tolist())) == len(many)
    assert np.array_equal(whole(b"Mixed CASE"), whole(b"mixed case")) and whole(b"ab")[0] != whole(b"ba")[0]


@pytest.mark.parametrize("share", [2, 4096])
def test_spread_join_is_a_join(spark, monkeypatch, share):
    monkeypatch.setattr(common, "HOT_SHARE", share)
    rows = spark.range(500).select(F.when(F.col("id") < 300, 0).otherwise(F.col("id") % 50).alias("key"), "id")
    scratch = common.Scratch(spark, "t")
    groups = scratch.write(rows.where("key < 40").groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("most")), "groups")
    got, want = common.spread_join(rows, groups, "key", "n"), rows.join(groups, "key")
    assert sorted(map(tuple, got.select(want.columns).collect())) == sorted(map(tuple, want.collect()))
    none = scratch.write(groups.where("1 = 0"), "none")
    assert common.spread_join(rows, none, "key", "n").count() == 0


def test_a_table_is_sent_by_what_it_takes_in_memory(spark):
    scratch = common.Scratch(spark, "t")
    table = scratch.write(spark.range(1000).select(F.repeat(F.lit("x"), 1000).alias("s"), F.array(F.lit(1)).alias("a")), "table")  # a few bytes on disk
    broadcast = lambda df: "ResolvedHint" in df._jdf.queryExecution().analyzed().toString()
    assert broadcast(scratch.sent(table, "table")) and not broadcast(scratch.sent(table, "table", most=900_000))


def test_the_shared_folder():
    class Session:  # a session with this setting, which can't be changed
        def __init__(self, where):
            self.conf = {"spark.checkpoint.dir": where} if where else {}

    assert common.shared_dir(Session("hdfs://a/b/")) == "hdfs://a/b"
    own = common.shared_dir(Session(None))
    assert own.startswith("file:///") and common.shared_dir(Session(None)) == own


def test_small_tables_of_few_files_are_dealt_out(spark, tmp_path):
    spark.range(1000).coalesce(1).write.parquet(f"file://{tmp_path}/one file")
    df = spark.read.parquet(f"file://{tmp_path}/one file")
    plan = lambda d: d._jdf.queryExecution().optimizedPlan().toString()
    assert "Repartition" in plan(common.dealt_out(df)) and common.dealt_out(df).count() == 1000
    assert "Repartition" not in plan(common.dealt_out(df, most=10)) and "Repartition" not in plan(common.dealt_out(spark.range(5)))
