"""The registered queries against their SQL, on the smallest test tables."""

import pytest

from verification.compare import difference, duck
from verification.oracle import ORACLE
from verification.queries import QUERIES



@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


def test_every_query_has_sql():
    assert set(ORACLE) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, sf_dir, name):
    rows, text = difference(spark, con, QUERIES[name], ORACLE[name], sf_dir)
    assert not text
    # The smallest tables overfill no day.
    assert rows > 0 or name.endswith("_validity")


def test_entry(spark):
    from __spark_entry__ import entry, oracle_sql, queries

    assert entry(spark).count() > 0
    assert set(QUERIES) <= set(queries()) and set(ORACLE) <= set(oracle_sql()) <= set(queries())
