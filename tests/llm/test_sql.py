"""Every query of this folder that has SQL: same columns and rows as the SQL engine gives."""

import pytest

from riskweave.llm.queries import ORACLES, QUERIES
from tests.test_oracle import canon, db  # noqa: F401

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", [n for n, sql in ORACLES.items() if sql])
def test_matches_sql(spark, db, name):  # noqa: F811
    df = QUERIES[name](spark, SF)
    expected = db.execute(ORACLES[name])
    names = [c[0] for c in expected.description]
    assert sorted(df.columns) == sorted(names)
    assert canon(df.columns, [tuple(r) for r in df.collect()]) == canon(names, expected.fetchall())
