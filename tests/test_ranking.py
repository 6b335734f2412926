"""Positions in runs of a range exchange, beside plain window functions."""

import pytest
from pyspark.sql import Window, functions as F

import __spark_entry__ as entry
from dishframe.operators import ordering, ranking

FOLDER = "/root/testdata/sf0.001"


def same(left, right):
    return sorted(map(str, left.collect())) == sorted(map(str, right.collect()))


@pytest.mark.parametrize("runs", [1, 2, 7, 40])
def test_prefix_sums_over_runs(spark, runs):
    sizes = [(r, (r * 7 + 3) % 11 + 1) for r in range(runs)]
    got = {r["_run"]: r["_before"] for r in ranking.before_runs(spark.createDataFrame(sizes, "_run int, _n long")).collect()}
    assert got == {r: sum(n for q, n in sizes if q < r) for r in range(runs)}


def test_prefix_sums_with_gaps(spark):
    got = {r["_run"]: r["_before"] for r in ranking.before_runs(spark.createDataFrame([(3, 5), (1023, 2), (70_000, 9)], "_run int, _n long")).collect()}
    assert got == {3: 0, 1023: 5, 70_000: 7}


@pytest.mark.parametrize("partitions", [None, 1, 13])
def test_index_of_a_table(spark, partitions):
    df = spark.range(997).select((F.col("id") * 31 % 17).alias("a"), F.col("id").alias("b"))
    plain = df.withColumn("index", F.row_number().over(Window.orderBy(F.desc("a"), "b")))
    assert same(ranking.global_index(df, [F.desc("a"), "b"], partitions=partitions), plain)


@pytest.mark.parametrize("partitions", [None, 9])
def test_index_of_groups_one_of_them_large(spark, partitions):
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, None).otherwise((F.col("id") % 20).cast("string"))
    df = spark.range(2000).select(key.alias("k"), (F.col("id") % 7).alias("k2"), (F.col("id") * 37 % 101).alias("v"), "id")
    for keys in (["k"], ["k", "k2"]):
        plain = df.withColumn("index", F.row_number().over(Window.partitionBy(*keys).orderBy("v", "id")))
        assert same(ranking.group_index(df, keys, ["v", "id"], partitions=partitions), plain)


def test_index_of_an_empty_table(spark):
    empty = spark.range(0).withColumn("k", F.lit("x"))
    assert ranking.global_index(empty, ["id"]).count() == 0 and ranking.group_index(empty, ["k"], ["id"]).count() == 0


def test_equal_leads_of_a_large_group_are_cut_by_their_ties(spark):
    df = spark.range(8000).select(F.lit("page").alias("k"), F.lit(1).alias("y"), "id")
    runs = ranking.sorted_runs(df, ["k", "y", "id"], 16).groupBy("_run").count().collect()
    assert len(runs) >= 12 and max(r["count"] for r in runs) < 1500


def test_oversized_page_spreads_over_many_tasks(spark):
    """The page that holds a third of all blocks is cut into its share of the runs."""
    blocks = spark.read.parquet(f"{FOLDER}/lineitem.parquet").withColumn("page", F.when(F.col("l_orderkey") % 3 == 0, 0).otherwise(F.col("l_orderkey")))
    by = ["page", "l_quantity", "l_suppkey", "l_partkey", "l_linenumber", "l_orderkey"]
    runs = ranking.sorted_runs(blocks, by, 24).groupBy("_run").agg(F.count_if(F.col("page") == 0).alias("n")).filter("n > 0").collect()
    assert len(runs) >= 6
    shown = ordering.reading_order(blocks, ["page"], "l_suppkey", "l_quantity", F.lit(50), by[2:])._jdf.queryExecution().executedPlan().toString()
    assert "Window" in shown and "SinglePartition" not in shown


@pytest.mark.parametrize("name", ["running_index", "table_index"])
def test_no_task_sees_all_rows_or_all_runs(spark, name):
    shown = entry.queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in shown and "Window" not in shown
