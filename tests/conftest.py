import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    import tempfile
    from eventide.session import build_session
    s = build_session(shuffle_partitions=8, extra={
        "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="warehouse-", dir="/tmp")})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb
    from eventide.sources.tables import TABLES, table_path
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(SF01, t)}')")
    return con


def rows(df, cols=None):
    """Sorted list of tuples for order-insensitive comparison."""
    pdf = df.toPandas() if hasattr(df, "toPandas") else df
    cols = cols or sorted(pdf.columns)
    def fix(v):
        return None if isinstance(v, float) and v != v else v
    return sorted((tuple(fix(v) for v in r) for r in pdf[cols].itertuples(index=False, name=None)),
                  key=lambda t: tuple((x is None, str(x)) for x in t))
