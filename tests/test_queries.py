"""Every registered query against its SQL on the smallest data."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

from check_queries import normalised
from tallyline.plans.queries import REGISTRY

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in Path(SF).glob("*.parquet"):
        connection.execute(f"create view {file.stem} as select * from '{file}'")
    return connection


@pytest.mark.parametrize("name", list(REGISTRY))
def test_query_matches_its_sql(spark, duck, name):
    query, text = REGISTRY[name]
    df = query(spark, SF)
    got = [tuple(r) for r in df.collect()]
    assert got
    if text is None:
        return
    cursor = duck.execute(text)
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    by_name = sorted(columns)
    want = normalised(cursor.fetchall(), [columns.index(c) for c in by_name])
    assert normalised(got, [df.columns.index(c) for c in by_name]) == want
