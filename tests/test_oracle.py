"""Every query with an oracle: same columns, same rows as the SQL engine gives."""

import math
from pathlib import Path

import duckdb
import pytest

from riskweave.plans import catalog

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for f in Path(SF).glob("*.parquet"):
        con.execute(f"create view {f.stem} as select * from '{f}'")
    return con


def canon(columns, rows):
    order = [columns.index(c) for c in sorted(columns)]

    def cell(v):
        if v is None or (isinstance(v, float) and math.isnan(v)):
            return ""
        return repr(v) if isinstance(v, float) else str(v)

    return sorted(tuple(cell(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", list(catalog.ORACLES))
def test_matches_sql(spark, db, name):
    df = catalog.QUERIES[name](spark, SF)
    expected = db.execute(catalog.ORACLES[name])
    names = [c[0] for c in expected.description]
    assert sorted(df.columns) == sorted(names)
    got = canon(df.columns, [tuple(r) for r in df.collect()])
    want = canon(names, expected.fetchall())
    assert got == want
