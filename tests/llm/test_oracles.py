"""Queries of this package that SQL can say, against that SQL; every query runs over whole tables."""

import pandas as pd
import pytest

from sluice.llm.cases import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"


def rows(frame):
    columns = sorted(frame.columns)
    # Whole numbers come as floats where a column has nulls.
    shown = lambda v: "NULL" if pd.isna(v) else str(int(v) if isinstance(v, float) and v == int(v) else v)
    return sorted(tuple(map(shown, row)) for row in frame[columns].itertuples(index=False))


def test_thirteen_operators():
    assert {int(name[2:].split("_")[0]) for name in QUERIES} == set(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    got = QUERIES[name](spark, SF_DIR).toPandas()
    want = duck.execute(ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)
