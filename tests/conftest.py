import os
import sys
import tempfile
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"
DATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark():
    from corpusloom.session import build_session

    session = build_session(
        "local[4]", "tests", spark__sql__shuffle__partitions="4", spark__driver__memory="4g",
        spark__ui__showConsoleProgress="false", spark__local__dir=tempfile.mkdtemp(prefix="spark-"),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def normal(value):
    """Values as text that do not depend on the engine."""
    if isinstance(value, float):
        return "None" if value != value else repr(round(value, 9))
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(map(normal, value)) + "]"
    return str(value)


@pytest.fixture(scope="session")
def duck():
    """duck(sf_dir, sql) -> (columns, rows)"""
    import duckdb

    from corpusloom.plans.dialect import TABLES

    def run(sf_dir, sql):
        con = duckdb.connect()
        for t in TABLES:
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
        cur = con.execute(sql)
        return [c[0] for c in cur.description], cur.fetchall()

    return run


@pytest.fixture(scope="session")
def same(spark, duck):
    """Asserts that a query and its SQL give the same rows."""

    def check(query, sql, sf_dir):
        df = query(spark, sf_dir)
        columns = sorted(df.columns)
        names, rows = duck(sf_dir, sql)
        assert sorted(names) == columns
        want = sorted(tuple(normal(r[names.index(c)]) for c in columns) for r in rows)
        got = sorted(tuple(normal(r[c]) for c in columns) for r in df.collect())
        assert got == want

    return check
