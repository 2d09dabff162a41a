import hashlib
import re
from collections import defaultdict

from pyspark.sql import functions as F

from tidemark.llm import exact_dedup as X


def brute(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[re.sub(r"[\x20\x09-\x0d]", "", r[1] or "")].append(r)
    out = []
    for norm, members in groups.items():
        best = min(members, key=lambda r: (-len(r[1] or ""), r[0] is None, r[0]))
        out += [(r[0], best[0], len(members), hashlib.sha256(norm.encode()).hexdigest()) for r in members]
    return sorted(out, key=repr)


def got(df):
    return sorted([(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in df.collect()], key=repr)


def test_against_brute_force(docs, odd_docs):
    out = X.exact_dedup(docs)
    assert got(out) == brute(odd_docs)
    kept = [r for r in out.collect() if r.kept]
    assert len(kept) == len({r.text_sha256 for r in out.collect()})  # of repeated rows one stays


def test_digest_collisions_are_split_by_the_texts(spark, docs, odd_docs):
    run = X.ExactDedup(spark, digest=lambda norm: F.substring(X.sha256(norm), 1, 1))
    run.ingest(docs)
    out = run.result().collect()
    want = {(d, k, n) for d, k, n, _ in brute(odd_docs)}
    assert {(r.doc_id, r.keep_id, r.group_size) for r in out} == want and len(out) == len(odd_docs)


def test_state_goes_on_between_loads_and_sessions(spark, tmp_path):
    loads = [[(1, "a b"), (2, "c"), (9, "x")], [(3, "a  b"), (4, "d"), (5, "c"), (9, "x")], [(6, "c "), (9, "x"), (None, None), (7, " ")]]
    whole = brute([r for rows in loads for r in rows])
    path = f"file://{tmp_path}/state"
    for digest in (X.sha256, lambda norm: F.lit("same")):
        path += "x"
        for rows in loads:  # each load by an object and a session of its own
            session = spark.newSession()
            run = X.ExactDedup(session, digest=digest, path=path)
            run.ingest(session.createDataFrame(rows, "doc_id long, text string"))
        out = X.ExactDedup(spark.newSession(), digest=digest, path=path).result().collect()
        assert sorted([(r.doc_id, r.keep_id, r.group_size) for r in out], key=repr) == sorted([w[:3] for w in whole], key=repr)
        assert sum(r.kept for r in out) == len({w[3] for w in whole})


def test_the_same_rows_in_two_loads(spark, tmp_path):
    path = f"file://{tmp_path}"
    spark.createDataFrame([(1, "one"), (1, "one"), (2, "two")], "doc_id long, text string").write.parquet(f"{path}/docs and more")
    for docs in (spark.read.parquet(f"{path}/docs and more"), spark.createDataFrame([(1, "one"), (2, "two")], "doc_id long, text string")):
        run = X.ExactDedup(spark)
        assert [run.ingest(docs), run.ingest(docs)] == [1, 2]
        out = run.result().collect()
        assert len(out) == 2 * docs.count() and sum(r.kept for r in out) == 2


def test_a_load_that_is_run_again_counts_once(spark, tmp_path):
    docs = spark.createDataFrame([(1, "one"), (2, "o ne")], "doc_id long, text string")
    for _ in range(2):
        X.ExactDedup(spark, path=f"file://{tmp_path}/s").ingest(docs, load=1)
    assert {(r.doc_id, r.keep_id, r.group_size) for r in X.ExactDedup(spark, path=f"file://{tmp_path}/s").result().collect()} == {(1, 2, 2), (2, 2, 2)}


def test_kept_rows_have_all_columns(clashing, odd_docs):
    out = X.kept_rows(clashing)
    assert out.columns == clashing.columns and out.count() == len({w[3] for w in brute(odd_docs)})


def test_empty(empty):
    assert X.exact_dedup(empty).count() == 0 and X.kept_rows(empty).count() == 0
