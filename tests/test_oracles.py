"""Each registered query against its SQL twin."""

from __future__ import annotations

import os
from pathlib import Path

import duckdb
import pytest

from cdc_lake.plans.oracles import ORACLES
from cdc_lake.plans.queries import QUERIES

from .conftest import TESTDATA

SCALE = os.environ.get("ORACLE_SF", "sf0.001")


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for file in Path(f"{TESTDATA}/{SCALE}").glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return connection


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


SAME_TYPE = {
    "INTEGER": "int",
    "BIGINT": "bigint",
    "DOUBLE": "double",
    "VARCHAR": "string",
    "BOOLEAN": "boolean",
}


def _canonical(names, values):
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted((tuple(row[i] for i in order) for row in values), key=repr)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_oracle(spark, oracle, name):
    frame = QUERIES[name](spark, f"{TESTDATA}/{SCALE}")
    result = oracle.execute(ORACLES[name])
    wanted = {column[0]: SAME_TYPE[str(column[1])] for column in result.description}
    assert dict(frame.dtypes) == wanted
    got = _canonical(frame.columns, [tuple(row) for row in frame.collect()])
    want = _canonical(list(wanted), result.fetchall())
    assert len(got) == len(want)
    assert got == want
