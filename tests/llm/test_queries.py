"""The registered queries: SQL where there is some, the contract's columns, and the pipeline."""

import importlib
import os
import random
import re
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.test_queries import TABLES, counted
from tidemark.llm import langid, packing, queries

from .conftest import SCHEMA, prose
from .test_jaccard import brute, varied


@pytest.fixture(scope="module")
def duck():
    from tests.conftest import DATA

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_against_sql(spark, duck, sf_dir, name):
    df = queries.QUERIES[name](spark, sf_dir)
    cur = duck.execute(queries.ORACLE_SQL[name])
    columns, want = [d[0] for d in cur.description], cur.fetchall()
    assert sorted(df.columns) == sorted(columns)
    assert counted(df.collect(), df.columns, sorted(columns)) == counted(want, columns, sorted(columns))


CONTRACT = {
    "op2_katz_score": "doc_id held_out n_tokens n_known train_tokens base_score score",
    "op5_jaccard_join": "doc_id n_shingles component_id",
    "op6_packing": "doc_id start length ids_crc32 doc_tokens sequence_id offset",
    "op9_language_id": "doc_id held_out lang_pred score",
    "op10_license_scan": "doc_id n_words n_base first_word last_word base_labels labels score",
}


@pytest.mark.parametrize("name", sorted(CONTRACT))
def test_columns(spark, sf_dir, name):
    df = queries.QUERIES[name](spark, sf_dir)
    assert set(CONTRACT[name].split()) <= set(df.columns)
    ids = {r.doc_id for r in df.select("doc_id").distinct().collect()}
    assert len(ids) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()


def test_pipeline(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
    out = corpus_pipeline.run(spark, sf_dir).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    ids = {r.doc_id for r in out}
    assert ids <= set(texts) and len({texts[i] for i in ids}) == len(ids)  # no exact copies
    tokens = {r.doc_id: r.doc_tokens for r in out}
    assert all(sum(r.length for r in out if r.doc_id == i) % n == 0 for i, n in list(tokens.items())[:20])


def test_each_stage_against_a_plain_version(spark, tmp_path, odd_docs):
    """What each stage keeps of all that its predecessor kept, held against plain code or SQL."""
    rnd = random.Random(11)
    rows = [r for r in odd_docs if len(r[1] or "") < 5000] + [(50, "!!! 123", "en", "src0", 1)]
    for i in range(40):
        base = prose(rnd, 80, [f"word{j}" for j in range(500)])
        rows += [(200 + 10 * i + j, varied(rnd, base, j), ["en", "de"][i % 2], f"src{i % 3}", 1) for j in range(1 + i % 4)]
    path = f"{tmp_path}/documents.parquet"
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"file://{path}")
    docs = spark.read.parquet(f"file://{path}")
    stages = dict(corpus_pipeline.STAGES)
    told = lambda df: sorted(((r.doc_id, r.text) for r in df.collect()), key=repr)

    def after(name, df):
        out = stages[name](spark, df, f"file://{tmp_path}")
        if name != "packing":
            assert out.columns == docs.columns
        out.write.parquet(f"file://{tmp_path}/{name}")
        return spark.read.parquet(f"file://{tmp_path}/{name}")

    model = langid.train(docs.where(~langid.held_out("doc_id")))
    of = [(r.doc_id, r.text, r.of) for r in docs.select("doc_id", "text", langid.predict(docs, model, F.col("text")).alias("of")).collect()]
    kept = after("language ID", docs)
    assert told(kept) == sorted(((i, t) for i, t, x in of if x.lang != langid.UNDETERMINED and x.score >= 0.5), key=repr) and kept.count() < docs.count()

    best = {}
    for i, t in told(kept):
        key = re.sub(r"[\x20\x09-\x0d]", "", t)
        best[key] = min(best.get(key, (1, 0, 0, t)), (-len(t), i is None, i or 0, t))
    distinct = after("exact dedup", kept)
    assert told(distinct) == sorted(((None if b[1] else b[2], b[3]) for b in best.values()), key=repr) and distinct.count() < kept.count()

    components = {}
    for i, _, c in brute(told(distinct)):
        components.setdefault(c, []).append(i)
    single = after("n-gram Jaccard join", distinct)
    assert sorted(r.doc_id for r in single.collect() if r.doc_id is not None) == sorted(c for c in components if c is not None) and single.count() < distinct.count()

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/n-gram Jaccard join/*.parquet'")
    cur = con.execute(queries.ORACLE_SQL["op7_mixing"])
    at = [d[0] for d in cur.description].index("copies")
    want = [r[0] for r in cur.fetchall() for _ in range(r[at])]
    mixed = after("mixing to target weights", single)
    assert sorted(map(repr, (r.doc_id for r in mixed.collect()))) == sorted(map(repr, want))

    packed = after("packing", mixed).groupBy("doc_id").agg(F.sum("length").alias("n")).collect()
    encode = packing.encoder(packing.vocabulary("byte_bpe_50k.json"), packing.vocabulary("byte_bpe_50k.tiktoken"))
    tokens = Counter()
    for i, t in told(mixed):
        tokens[i] += len(encode(t or "")) // 4 + 1
    assert {r.doc_id: r.n for r in packed} == dict(tokens)


@pytest.mark.parametrize("stage", range(4))
def test_stages_and_columns_of_any_name(spark, tmp_path, odd_docs, stage):
    """Extra columns come through, though they are called like what the stages use inside; an empty table stays empty."""
    name, work = corpus_pipeline.STAGES[stage]
    docs = spark.createDataFrame([r for r in odd_docs if len(r[1] or "") < 5000], SCHEMA)
    for c in ("_place", "place", "_out", "_at", "_copies", "_copy", "copy", "copies", "row", "of", "a.b", "label"):
        docs = docs.withColumn(c, F.lit("extra"))
    docs.write.parquet(f"file://{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"file://{tmp_path}/documents.parquet")
    out = work(spark, docs, f"file://{tmp_path}")
    assert out.columns == docs.columns and out.count() > 0 and out.where("_place <> 'extra' OR `a.b` <> 'extra' OR copies <> 'extra'").count() == 0
    none = work(spark, docs.where("1 = 0"), f"file://{tmp_path}")
    assert none.columns == docs.columns and none.count() == 0


def test_the_pipeline_does_not_hide_missing_parts():
    source = open(os.path.join(os.path.dirname(corpus_pipeline.__file__), "corpus_pipeline.py")).read()
    assert "except" not in source and importlib.import_module("tidemark.llm.queries")


@pytest.mark.parametrize("name", ["op4_url_filter", "op7_mixing", "op10_license_scan"])
def test_native_queries_run_no_python(spark, sf_dir, name):
    plan = queries.QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"(Python|Pandas|Arrow)\w*( |$|\()", plan)
