"""Every registered query of the library's own operators gives the rows of its SQL."""

from __future__ import annotations

from decimal import Decimal
from pathlib import Path

import duckdb
import pytest

import __spark_entry__
from tidewell.plans.queries import ORACLE_SQL, QUERIES

FOLDER = "/root/testdata/sf0.001"
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")


def plain(v):
    if isinstance(v, (float, Decimal)) and not isinstance(v, bool):
        return str(round(float(v), 9) + 0.0)
    return str(float(v)) if isinstance(v, int) and not isinstance(v, bool) else str(v)


@pytest.fixture(scope="module")
def db():
    with duckdb.connect() as con:
        for t in TABLES:
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
        yield con


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, db, name):
    out = QUERIES[name](spark, FOLDER)
    rows = out.collect()
    if name not in ORACLE_SQL:
        assert rows
        return
    want = db.sql(ORACLE_SQL[name])
    assert sorted(out.columns) == sorted(want.columns)
    place, other = sorted(range(len(out.columns)), key=lambda i: out.columns[i]), sorted(range(len(want.columns)), key=lambda i: want.columns[i])
    assert sorted(tuple(plain(r[i]) for i in place) for r in rows) == sorted(tuple(plain(r[i]) for i in other) for r in want.fetchall())


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0 and set(ORACLE_SQL) <= set(__spark_entry__.queries())
