"""Every registered query of the library itself against its SQL, on the smallest tables."""

import os

import duckdb
import pytest

from leafray.plans import files, registry, sky, workflows  # noqa: F401

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events embeddings".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def engine():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def text(value):
    if value is None or value != value:
        return "~"
    return f"{value + 0.0:.6g}" if isinstance(value, float) or hasattr(value, "as_tuple") else str(value)


def rows(names, data):
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(tuple(text(float(r[i]) if hasattr(r[i], "as_tuple") else r[i]) for i in order) for r in data)


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query(spark, engine, name):
    got = registry.QUERIES[name](spark, SF)
    want = engine.execute(registry.ORACLES[name])
    names = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(names)
    assert rows(got.columns, [tuple(r) for r in got.collect()]) == rows(names, want.fetchall())
