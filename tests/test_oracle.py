"""Every registered query equals its DuckDB oracle (rows, columns, values) at sf0.001."""

import pytest

from daycast.plans.oracle_queries import ORACLE_SQL
from daycast.plans.queries import QUERIES
from tools.oracle_check import canon, duck

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE_SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    sdf = QUERIES[name](spark, SF)
    srows = [tuple(r) for r in sdf.collect()]
    res = con.execute(ORACLE_SQL[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(sdf.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert canon(srows, sdf.columns) == canon(drows, dcols)
