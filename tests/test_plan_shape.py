"""Physical plans: no Python in the data path, no all-pairs joins, pruned and pushed-down scans."""

import re

import pytest

from workload import QUERIES

TREES = {"gbt_train_score", "grid_search", "feature_importance_topk", "prediction_contract", "grid_contract", "importance_contract"}


def plan(spark, data_dir, name):
    return QUERIES[name](spark, data_dir)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - TREES))
def test_no_python_and_no_all_pairs(spark, data_dir, name):
    text = plan(spark, data_dir, name)
    for bad in ("EvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in text


def test_scan_reads_only_what_is_used(spark, data_dir):
    text = plan(spark, data_dir, "label_store")
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    columns = {c.split(":")[0] for s in schemas for c in s.split(",")}
    assert "l_returnflag" not in columns and "o_orderpriority" not in columns
    assert "l_linenumber" in columns


def test_split_is_assigned_without_a_shuffle(spark, data_dir):
    assert "hashpartitioning" not in plan(spark, data_dir, "stratified_split")


def test_token_columns_need_no_shuffle(spark, data_dir):
    assert "Exchange" not in plan(spark, data_dir, "token_pivot")


def test_trees_score_every_row(spark, data_dir):
    labels = spark.read.parquet(f"{data_dir}/labels.parquet").count()
    scored = QUERIES["gbt_train_score"](spark, data_dir)
    assert scored.count() == labels
    assert scored.filter("prediction_proba < 0 or prediction_proba > 1 or prediction_proba is null").count() == 0
    assert QUERIES["grid_search"](spark, data_dir).count() == 4
    top = QUERIES["feature_importance_topk"](spark, data_dir).collect()
    assert len(top) == 3 and top[0]["importance"] >= top[1]["importance"] >= top[2]["importance"]


def test_instalments_are_dealt_by_loan(spark, data_dir):
    """Also where the join is a broadcast: few row groups would mean as few tasks."""
    text = plan(spark, data_dir, "label_store")
    assert "BroadcastHashJoin" in text and re.search(r"Exchange hashpartitioning\(l_orderkey#\d+L?, \d+\), REPARTITION_BY_COL", text)
