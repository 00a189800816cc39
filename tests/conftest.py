from __future__ import annotations

import decimal
import math
import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


@pytest.fixture(scope="session")
def spark():
    from txlake.session import build_session
    ckpt = tempfile.mkdtemp(prefix="txlake-test-ckpt-")
    s = build_session("local[8]", app="txlake-tests", shuffle_partitions=8, conf={"spark.checkpoint.dir": ckpt})
    s.sparkContext.setCheckpointDir(ckpt)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    yield con
    con.close()


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        return (1, "nan" if math.isnan(v) else repr(v))
    if isinstance(v, decimal.Decimal):
        return (3, str(v.normalize()) if v == v.to_integral_value() else str(v))
    if hasattr(v, "isoformat"):
        return (2, v.isoformat())
    return (4, str(v))


def as_multiset(cols, rows):
    """Rows as a sorted list with columns ordered by name (the driver's comparison)."""
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in order], sorted(tuple(_norm(r[i]) for i in order) for r in rows)


def df_multiset(df):
    return as_multiset(df.columns, [tuple(r) for r in df.collect()])
