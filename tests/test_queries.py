"""Every registered query against its oracle at the smallest scale."""

import pytest
from compare import canonical, oracle_rows

from tidelog.plans import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query(spark, key):
    df = QUERIES[key](spark, SF)
    got = canonical(df.columns, [tuple(r) for r in df.collect()])
    assert len(set(df.columns)) == len(df.columns)
    if key in ORACLES:
        assert got == canonical(*oracle_rows(SF, ORACLES[key]))
    else:
        assert got[1]


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
