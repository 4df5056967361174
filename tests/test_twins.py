"""Every query with an SQL twin gives the twin's columns, types and rows; the others give rows."""

import pytest

from check_twins import compare, duck
from punctual.catalog import REGISTRY

# Long paths have their own tests in test_plans.py.
PATHS = {"clustered_tables", "regression_path"}


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", [n for n, q in REGISTRY.items() if q.sql])
def test_twin(spark, sf_dir, con, name):
    problem = compare(REGISTRY[name].run(spark, sf_dir), con.sql(REGISTRY[name].sql))
    assert problem in (None, "no rows")


@pytest.mark.parametrize("name", [n for n, q in REGISTRY.items() if not q.sql and n not in PATHS])
def test_rows(spark, sf_dir, name):
    assert REGISTRY[name].run(spark, sf_dir).count() > 0


def test_entry(spark):
    import __spark_entry__

    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
    assert __spark_entry__.entry(spark).count() > 0
