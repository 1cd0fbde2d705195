"""Every registered query with an SQL twin must match it (row count, columns, values)."""

import pytest

import __spark_entry__ as E
from tests.util import canon

ORACLES = E.oracle_sql()
QUERIES = E.queries()


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 1 and set(df.columns) >= {"accuracy", "f1", "auc_hard"}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, sf, duck, name):
    sdf = QUERIES[name](spark, sf)
    scols, srows = sdf.columns, [tuple(r) for r in sdf.collect()]
    res = duck.execute(ORACLES[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(scols) == sorted(ocols)
    assert len(srows) == len(orows)
    assert canon(scols, srows) == canon(ocols, orows)
