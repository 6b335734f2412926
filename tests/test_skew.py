"""Chunked and salted building blocks against their plain forms, with tiny chunks and salts."""

import random

from pyspark.sql import Window, functions as F

from dishframe.operators import skew


def table(spark, seed=1, n=400):
    """One group holds most rows; positions are dense inside a group."""
    rng = random.Random(seed)
    groups, rows = {}, []
    for i in range(n):
        g = "hot" if rng.random() < 0.6 else rng.choice("abc")
        pos = groups.get(g, 0)
        groups[g] = pos + 1
        rows.append((g, pos, i, rng.choice([None, f"h{i}"]) if rng.random() < 0.3 else None, rng.randrange(20)))
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "g string, pos int, id int, heading string, v int")


def same(a, b):
    columns = sorted(a.columns)
    key = lambda df: sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
    return sorted(b.columns) == columns and key(a) == key(b)


def test_row_numbers(spark):
    df = table(spark)
    plain = df.withColumn("n", F.row_number().over(Window.partitionBy("g").orderBy("v", "id")).cast("bigint"))
    assert same(skew.row_numbers(df, ["g"], F.col("v"), ["id"], "n", 3), plain)
    whole = df.withColumn("n", F.row_number().over(Window.partitionBy(F.lit(1)).orderBy("id")).cast("bigint"))
    assert same(skew.row_numbers(df, [], F.col("id"), [], "n", 50), whole)


def test_carry_forward(spark):
    df = table(spark)
    over = Window.partitionBy("g").orderBy("pos")
    plain = df.withColumn("section", F.last("heading", ignorenulls=True).over(over))
    assert same(skew.carry_forward(df, ["g"], "pos", F.col("heading"), "section", 7), plain)


def test_with_context(spark):
    df = table(spark).select("g", "pos", "id")
    plain = df.withColumn("c", F.collect_list("id").over(Window.partitionBy("g").orderBy("pos").rowsBetween(-2, 4)))
    for width in (7, 8, 10000):
        assert same(skew.with_context(df, ["g"], "pos", "id", "c", 2, 4, width), plain)


def test_salted_lookup(spark):
    rows = table(spark).withColumn("g", F.when(F.col("v") > 1, F.col("g")))
    lookup = spark.createDataFrame([("hot", 1), ("a", 2), ("zz", 3)], "g string, x int")
    for how in ("left", "inner"):
        for heavy in (None, skew.heavy_keys(rows, ["g"], min_rows=10)):
            assert same(skew.salted_lookup(rows, lookup, ["g"], ["id"], how, heavy), rows.join(lookup, "g", how))


def test_heavy_rows_are_spread(spark):
    rows = table(spark)
    heavy = skew.heavy_keys(rows, ["g"], min_rows=20)
    spread = skew.salt_rows(rows, heavy, ["g"], ["id"]).filter("g = 'hot'").groupBy("_salt").count().collect()
    assert len(spread) > 8 and max(r["count"] for r in spread) < 40


def test_k_bounds(spark):
    df = table(spark).withColumn("k", F.when(F.col("g") == "hot", 3).otherwise(500))
    rank = lambda order: F.row_number().over(Window.partitionBy("g").orderBy(order))
    plain = df.withColumn("u", rank(F.col("v").asc())).withColumn("d", rank(F.col("v").desc())).groupBy("g").agg(
        F.count("*").alias("n"), F.min("v").alias("floor"), F.max("v").alias("ceiling"), F.max("k").alias("k"),
        F.sum(F.when(F.col("u") <= F.col("k"), F.col("v"))).alias("low"), F.sum(F.when(F.col("d") <= F.col("k"), F.col("v"))).alias("high"),
    )
    assert same(skew.k_bounds(df, ["g"], "v", F.col("k")), plain)


def test_sized_lookup_deals_large_keys_out(spark):
    """Rows of large keys, of a null key and of small ones all get their value; no task of the join holds a large key."""
    df = table(spark).select(F.when(F.col("g") != "c", F.col("g")).alias("g"), "id", "v")
    sides = df.groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("last"))
    got = skew.sized_lookup(df, sides, ["g"], ["last"], F.col("n"), ["id"], large=50)
    want = df.withColumn("last", F.max("id").over(Window.partitionBy("g")))
    assert same(got, want)
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        met = skew.sized_lookup(df, sides, ["g"], ["last"], F.col("n"), ["id"], large=50)
        per_task = met.withColumn("task", F.spark_partition_id()).select("g", "task").collect()
        assert len({r.task for r in per_task if r.g == "hot"}) > 4
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
