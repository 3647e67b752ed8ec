import subprocess
import sys

import pytest

import __spark_entry__ as entry
from tablewright import queries


@pytest.fixture(scope="module")
def duck(data):
    import duckdb

    con = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        con.execute(f"create view {t} as select * from '{data}/{t}.parquet'")
    return con


def rows(columns, found):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return sorted(tuple(repr(round(r[k], 9) if isinstance(r[k], float) else r[k]) for k in order) for r in found)


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_oracle(spark, data, duck, name):
    df = queries.QUERIES[name](spark, data)
    rel = duck.sql(queries.ORACLE[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert rows(df.columns, df.collect()) == rows(rel.columns, rel.fetchall())


def test_report(spark, data):
    assert "r_name: {'note': ['name']}" in queries.metadata_report(spark, data).first().report


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(queries.QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


def test_core_does_not_need_the_subpackage():
    code = "import sys; sys.modules['tablewright.llm'] = None; import __spark_entry__ as e; assert 'datafn_simple_math' in e.queries() and not [q for q in e.queries() if q.startswith('op')]"
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
