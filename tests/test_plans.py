"""Physical-plan assertions: pushdown, pruning, join strategies, no
cartesian products in the as-of / range joins, no Python in the
catalog expressions."""

import contextlib
import io

import pytest

from marquee.plans import registry


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


@pytest.fixture(scope="module")
def q():
    return registry.queries()


def test_filters_and_columns_reach_the_scan(spark, sf_dir, q):
    p = plan(q["scan_parquet"](spark, sf_dir))
    assert "PushedFilters: [IsNotNull(l_quantity), IsNotNull(l_shipdate), GreaterThan(l_quantity,45.0)" in p
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double,l_shipdate:timestamp_ntz>" in p


def test_partition_pruning(spark, sf_dir, q):
    p = plan(q["partitioned_write"](spark, sf_dir))
    assert "PartitionFilters: [isnotnull(o_orderstatus" in p


@pytest.mark.parametrize("name,op", [("join_broadcast", "BroadcastHashJoin"), ("join_merge_hint", "SortMergeJoin"),
                                     ("join_shuffle_hash", "ShuffledHashJoin")])
def test_join_strategy_hints(spark, sf_dir, q, name, op):
    assert op in plan(q[name](spark, sf_dir))


@pytest.mark.parametrize("name", ["asof_backward", "asof_nearest", "join_range", "sessions_batch", "win_range", "rolling"])
def test_no_pair_explosion(spark, sf_dir, q, name):
    p = plan(q[name](spark, sf_dir))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


@pytest.mark.parametrize("name", ["catalog_pipeline", "page_fields", "parse_rating", "duration_minutes", "clean_marker",
                                  "fill_defaults", "list_flatten", "sink_project", "width_guard"])
def test_catalog_expressions_stay_in_the_jvm(spark, sf_dir, q, name):
    p = plan(q[name](spark, sf_dir))
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p and "MapInPandas" not in p
