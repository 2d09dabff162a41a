"""Every registered query of the archive engine against DuckDB, or its rows where there is no SQL."""

import collections
import datetime as dt
import os

import duckdb
import pytest

from tidemark import queries

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, (dt.datetime, dt.date)):
        return str(v)
    return v


def counted(rows, columns, order):
    at = [columns.index(c) for c in order]
    return collections.Counter(tuple(plain(r[i]) for i in at) for r in rows)


@pytest.fixture(scope="module")
def duck():
    from tests.conftest import DATA

    con = duckdb.connect()
    for t in TABLES:
        path = f"{DATA}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path}'")
    return con


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, duck, sf_dir, name):
    df = queries.QUERIES[name](spark, sf_dir)
    got = df.collect()
    sql = queries.ORACLE_SQL[name]
    cur = duck.execute(sql)
    columns, want = [d[0] for d in cur.description], cur.fetchall()
    assert sorted(df.columns) == sorted(columns)
    order = sorted(columns)
    assert counted(got, df.columns, order) == counted(want, columns, order)


def test_entry_imports_without_the_corpus_operators(tmp_path):
    """The driver takes the llm folders away: what is left must still import."""
    import shutil
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    shutil.copytree(os.path.join(root, "tidemark"), tmp_path / "tidemark", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(os.path.join(root, "__spark_entry__.py"), tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'merge_insert_only' in q and not any(n.startswith('op') for n in q) and 'pipeline' not in q; assert set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"})
