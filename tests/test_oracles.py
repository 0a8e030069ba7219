"""Every batch query equals its DuckDB oracle at sf0.01 (the driver's gate)."""

import hashlib
import math

import pandas as pd
import pytest

import __spark_entry__ as entry
from eventide.plans import ORACLE, QUERIES

from .conftest import SF01

BATCH = [k for k in QUERIES if not k.startswith("stream_") and k in ORACLE]


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "NULL"
    try:
        if not isinstance(v, (list, tuple, str)) and pd.isna(v):
            return "NULL"
    except (TypeError, ValueError):
        pass
    if isinstance(v, float):
        return f"{v:.6g}"
    if hasattr(v, "isoformat"):
        return pd.Timestamp(v).strftime("%Y-%m-%d %H:%M:%S.%f")
    return str(v)


def _digest(df):
    cols = sorted(df.columns)
    lines = sorted("|".join(_norm(r[c]) for c in cols) for r in df.to_dict("records"))
    return hashlib.sha1("\n".join(lines).encode()).hexdigest()


@pytest.mark.parametrize("name", BATCH)
def test_query_matches_oracle(spark, duck, name):
    sql = entry.oracle_sql()[name]
    got = entry.queries()[name](spark, SF01).toPandas()
    want = duck.sql(sql).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    assert _digest(got) == _digest(want)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert [f.name for f in df.schema.fields] == ["window_start", "window_end", "pv", "uv", "ratio"]
