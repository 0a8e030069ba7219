"""Registered queries against their DuckDB SQL."""

import pytest
from eventide.llm.queries import ORACLE, QUERIES

from tests.conftest import SF01, rows


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, duck, name):
    got, want = QUERIES[name](spark, SF01).toPandas(), duck.execute(ORACLE[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    cols = sorted(got.columns)

    def clean(pdf):
        pdf = pdf[cols].astype(object)
        return sorted((tuple(None if v is None or v != v else v for v in r)
                       for r in pdf.where(pdf.notna(), None).itertuples(index=False, name=None)), key=str)
    assert clean(got) == clean(want)


def test_every_operator_is_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
