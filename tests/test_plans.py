"""Plan shapes that matter at scale."""

from importlib import import_module

import pytest

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
PLANS = {}
# The library's own queries; those of optional modules have tests of their own.
NAMES = {n for name in entry.PLANS for n in import_module(f"dishframe.plans.{name}").catalog.queries}


def plan(spark, name):
    if name not in PLANS:
        PLANS[name] = build(spark, name)
    return PLANS[name]


def build(spark, name):
    return entry.queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["option_index", "item_page_prices", "dietary_badges", "review_snippets", "page_links"])
def test_row_local_queries_do_not_shuffle_by_key(spark, name):
    assert "hashpartitioning" not in plan(spark, name)


@pytest.mark.parametrize("name", sorted(NAMES))
def test_no_cross_join(spark, name):
    shown = plan(spark, name)
    assert "CartesianProduct" not in shown and "BroadcastNestedLoopJoin" not in shown


def test_top_k_is_cut_before_the_exchange(spark):
    shown = plan(spark, "host_filter")
    assert shown.index("WindowGroupLimit") < shown.rindex("Exchange") and "Partial" in shown


@pytest.mark.parametrize("name, most", [("price_bounds", 1), ("equal_price_once", 2), ("equal_price_times", 2), ("required_note_parts", 3), ("page_signals", 0)])
def test_one_exchange_per_grouping(spark, name, most):
    assert plan(spark, name).count("Exchange hashpartitioning") <= most


def test_filters_and_columns_reach_the_scan(spark):
    shown = plan(spark, "exclude_filter")
    assert "ReadSchema: struct<p_partkey:bigint,p_name:string>" in shown
    assert "PushedFilters: [In(l_returnflag" in plan(spark, "price_bounds")


def test_python_runs_only_where_it_must(spark):
    uses = {n for n in NAMES if any(x in plan(spark, n) for x in ("Pandas", "ArrowEvalPython", "MapInArrow"))}
    assert uses == {"json_items", "json_props", "structured_ratings", "graph_ratings", "review_like_objects"}


@pytest.mark.parametrize("name", ["ordered_ref_join", "rollup_fold_by_id", "prefer_flagged_join", "token_match", "near_miss", "content_sources"])
def test_no_data_job_while_a_query_is_built(spark, name):
    group = f"build-{name}"
    spark.sparkContext.setJobGroup(group, "building")
    entry.queries()[name](spark, FOLDER)
    spark.sparkContext.setJobGroup("other", "")
    status = spark.sparkContext.statusTracker()
    for job in status.getJobIdsForGroup(group):
        stages = [status.getStageInfo(s) for s in status.getJobInfo(job).stageIds]
        # Reading a Parquet footer is a job of one task.
        assert all(s is None or s.numTasks <= 1 for s in stages) and len(stages) == 1


@pytest.mark.parametrize("name", ["badge_counts", "option_index", "dietary_badges", "item_page_prices", "cross_sell", "option_tree_rows"])
def test_item_pages_are_built_in_many_tasks(spark, name):
    """One small file of parts is one split: its rows are dealt out before the trees are built."""
    assert "RoundRobinPartitioning" in plan(spark, name)
    assert name == "badge_counts" or entry.queries()[name](spark, FOLDER).rdd.getNumPartitions() >= 8
