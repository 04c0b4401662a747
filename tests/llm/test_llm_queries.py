"""Registered text queries against their SQL, and the guard around their folder."""

import glob
import os
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import DATA
from storelens.llm.oracle import ORACLE_SQL
from storelens.llm.queries import QUERIES
from tools.compare import table

FOLDER = f"{DATA}/sf0.01"
ROOT = os.path.dirname(os.path.abspath(entry.__file__))


@pytest.mark.parametrize("name", list(ORACLE_SQL))
def test_query_equals_sql(spark, name):
    db = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        db.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    result = db.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    df = entry.queries()[name](spark, FOLDER)
    assert sorted(df.columns) == sorted(columns)
    assert table(df.collect(), df.columns) == table(result.fetchall(), columns)


def test_one_query_for_each_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
    assert {*QUERIES, "pipeline"} <= set(entry.queries())


def test_the_entry_works_without_the_folder(tmp_path):
    for name in ("__spark_entry__.py", "oracle"):
        os.symlink(f"{ROOT}/{name}", tmp_path / name)
    os.mkdir(tmp_path / "storelens")
    for name in os.listdir(f"{ROOT}/storelens"):
        if name != "llm":
            os.symlink(f"{ROOT}/storelens/{name}", tmp_path / "storelens" / name)
    code = "import __spark_entry__ as e; assert 'pipeline' not in e.queries() and set(e.queries()) == set(e.PLANS) == set(e.oracle_sql())"
    env = {**os.environ, "PYTHONPATH": str(tmp_path)}
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, check=True)
