"""The queries of this subpackage that have SQL, beside it."""

import pytest

from check_twins import compare, duck
from punctual.llm.queries import QUERIES, SQL


@pytest.mark.parametrize("name", list(SQL))
def test_twin(spark, sf_dir, name):
    assert compare(QUERIES[name](spark, sf_dir), duck(sf_dir).sql(SQL[name])) is None
