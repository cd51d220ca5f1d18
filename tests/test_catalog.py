"""Every query of the library against its SQL, over the smallest tables."""

import math
import os

import duckdb
import pytest

from seekframe.plans import catalog

catalog.load()
DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def value(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 5)
    if type(v).__name__ == "Decimal":
        return round(float(v), 5)
    return v.isoformat() if hasattr(v, "isoformat") else v


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return c


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no tables here")
@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, duck, name):
    df = catalog.QUERIES[name](spark, DATA)
    rows = [r.asDict() for r in df.collect()]
    if name not in catalog.ORACLES:
        return
    want = duck.sql(catalog.ORACLES[name])
    assert sorted(want.columns) == sorted(df.columns)
    key = lambda r: repr([(k, value(r[k])) for k in sorted(df.columns)])
    assert sorted(map(key, rows)) == sorted(key(dict(zip(want.columns, r))) for r in want.fetchall())
