"""Every registered query against its SQL text, and the shape of its plan."""

import os

import pytest

import __spark_entry__ as entry
from shelfwise.plans import registry
from tests.compare import DATA, compare, connect

# The optional operators are tested beside their code; here are the others.
entry.queries()
QUERIES, CHECKS = registry.QUERIES, registry.CHECKS
SCALE = os.environ.get("SHELFWISE_SF", "sf0.001")
FOLDER = f"{DATA}/{SCALE}"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables here")

FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroups"]


@pytest.fixture(scope="module")
def checker():
    con = connect(FOLDER)
    yield con
    con.close()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, checker, name):
    _, _, problem = compare(spark, checker, FOLDER, name, QUERIES, CHECKS)
    assert problem is None


def test_every_check_has_a_query():
    assert set(CHECKS) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not n.startswith("stream_")))
def test_plan_has_no_pair_enumeration_and_no_python(spark, name):
    plan = QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert [word for word in FORBIDDEN if word in plan] == []


def _plan(spark, name):
    return QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()


def test_merge_has_one_shuffle_of_rows(spark):
    plan = _plan(spark, "merge_feeds")
    # One exchange merges the rows; the other two carry batch ids only (a row per feed and batch).
    shuffles = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert len(shuffles) == 3 and len([s for s in shuffles if "product_url" in s]) == 1
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_ranks_are_cut_before_the_shuffle(spark):
    for name in ("section_rank", "dedupe_first", "top_reviews"):
        plan = _plan(spark, name)
        assert "WindowGroupLimit" in plan and "Partial" in plan


def test_filters_and_columns_reach_the_scan(spark):
    plan = _plan(spark, "today_count")
    assert "PushedFilters: [IsNotNull(ts)" in plan or "GreaterThanOrEqual(ts" in plan
    assert "ReadSchema: struct<ts:timestamp_ntz>" in plan


def test_latest_batch_reads_one_partition_per_feed(spark):
    from shelfwise.operators.listing import FEEDS, latest_batch
    from shelfwise.plans.views import view
    from shelfwise.session import shared_dir

    path = shared_dir(spark, "listing")
    view(spark, FOLDER, "listing").write.partitionBy("source", "batch_id").parquet(path)
    rows = latest_batch(spark.read.parquet(path), {"source": FEEDS}).select("listing_id", "source", "batch_id")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan and "ReadSchema: struct<listing_id:bigint>" in plan


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns[0] == "product_url" and df.count() > 0
