"""Every registered query against its SQL, and plan checks."""

from pathlib import Path

import pytest

from compare import connect, difference
from workload import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con(data_dir):
    return connect(data_dir)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, con, data_dir, name):
    assert difference(QUERIES[name](spark, data_dir), con, ORACLES[name]) is None


# Queries over keys that repeat in the larger tables only.
REPEATED = ("labelled_rows", "label_merges", "label_store", "gold_roundtrip", "roc_auc_by_group", "stratified_split", "drift_history")


@pytest.mark.parametrize("name", REPEATED)
def test_equals_sql_where_keys_repeat(spark, data_dir, name):
    folder = str(Path(data_dir).parent / "sf0.01")
    assert difference(QUERIES[name](spark, folder), connect(folder), ORACLES[name]) is None
