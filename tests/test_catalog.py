"""Every registered query against its SQL on the smallest tables."""

import os
from concurrent.futures import ThreadPoolExecutor

import duckdb
import pytest

SF = "/root/testdata/sf0.001"
TABLES = "documents embeddings pages benchmark labels conversations".split()


def rows(columns, found):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(r[i] for i in order) for r in found), key=str)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")
def test_queries_match_their_sql(spark):
    from trovespark.plans import catalog

    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    assert len(catalog.queries()) > 160 and set(catalog.oracle_sql()) <= set(catalog.queries())

    def differs(name):
        df = catalog.queries()[name](spark, SF)
        got = rows(df.columns, [tuple(r) for r in df.collect()])
        if name not in catalog.oracle_sql():
            return None
        result = db.cursor().execute(catalog.oracle_sql()[name])
        want = rows([d[0] for d in result.description], result.fetchall())
        return None if got == want and sorted(df.columns) == sorted(d[0] for d in result.description) else name

    with ThreadPoolExecutor(4) as pool:
        assert [name for name in pool.map(differs, sorted(catalog.queries())) if name] == []


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert {"bm25_top10", "eval_summary"} <= set(e.queries()) and set(e.oracle_sql()) <= set(e.queries())


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")
def test_all_embeddings_are_clustered(spark):
    from trovespark.plans import catalog

    got = [r.place for r in catalog.queries()["facet_clusters"](spark, SF).collect()]
    assert sorted(got) == sorted(r.vec_id for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()) and len(got) > 200


def test_queries_are_listed_without_a_session():
    import subprocess
    import sys

    code = "import __spark_entry__ as e; assert len(e.queries()) > 160 and set(e.oracle_sql()) <= set(e.queries())"
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    subprocess.run([sys.executable, "-c", code], check=True, cwd=root)
