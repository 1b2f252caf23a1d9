"""Every query with SQL against that SQL."""

import pytest

from compare import connect, difference
from featuremart.llm import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, data_dir, name):
    assert difference(QUERIES[name](spark, data_dir), connect(data_dir), ORACLES[name]) is None
