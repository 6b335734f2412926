"""Positions in a total order, for tables and groups of any size.

Rows are cut into runs of neighbours by a range exchange over the group and its order: Spark samples
the borders, so a group that holds a third of all rows is cut into many runs, also within equal
leads as long as the ties differ. The runs are written once, sorted; a retried task reads them again
instead of sampling other borders. Every row then knows its run and its place in it, and only one row
a run takes part in the sums over earlier runs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from dishframe.operators.skew import sized_lookup
from dishframe.session import written

#: Spark numbers the rows of a task from task << 33.
RUN_BITS = 33
#: Runs are numbered below 2^20, far above any number of shuffle partitions.
LEVELS = 20


def sorted_runs(df: DataFrame, by: Sequence[Column | str], partitions: int | None = None) -> DataFrame:
    """The rows with _run (number of the run, in order) and _at (place in the run, from 0), written once."""
    ranged = df.repartitionByRange(partitions, *by) if partitions else df.repartitionByRange(*by)
    numbered = written(ranged.sortWithinPartitions(*by).withColumn("_id", F.monotonically_increasing_id()))
    run = F.shiftrightunsigned("_id", RUN_BITS).cast("int")
    return numbered.withColumns({"_run": run, "_at": F.col("_id").bitwiseAND((1 << RUN_BITS) - 1)}).drop("_id")


def before_runs(counts: DataFrame) -> DataFrame:
    """Per _run of (_run, _n): the sum of _n over all earlier runs, as _before.

    Every run adds to one block per level (runs of a block share all but their last bits), and a run's
    prefix is the sum of one block for each bit set in its number: joins and sums, no task sees all runs.
    """
    levels = F.sequence(F.lit(0), F.lit(LEVELS - 1))
    shifted = lambda level: F.call_function("shiftright", F.col("_run"), level)
    of_level = counts.select("_run", "_n", F.explode(levels).alias("_level"))
    blocks = of_level.groupBy("_level", shifted(F.col("_level")).alias("_block")).agg(F.sum("_n").alias("_sum"))
    bits = F.filter(levels, lambda level: shifted(level) % 2 == 1)
    wanted = counts.select("_run", F.explode(bits).alias("_level")).select(
        "_run", "_level", (shifted(F.col("_level")) - 1).alias("_block")
    )
    sums = wanted.join(blocks, ["_level", "_block"]).groupBy("_run").agg(F.sum("_sum").alias("_before"))
    return counts.select("_run").join(sums, "_run", "left").select("_run", F.coalesce("_before", F.lit(0)).alias("_before"))


def global_index(df: DataFrame, by: Sequence[Column | str], name: str = "index", partitions: int | None = None) -> DataFrame:
    """Dense 1-based index of every row of the table in the order of `by`."""
    runs = sorted_runs(df, by, partitions)
    before = before_runs(runs.groupBy("_run").agg(F.count(F.lit(1)).alias("_n")))
    # One row a shuffle partition: its size is bounded by their number.
    return runs.join(F.broadcast(before), "_run").withColumn(name, F.col("_before") + F.col("_at") + 1).drop("_run", "_at", "_before")


def group_index(
    df: DataFrame, keys: Sequence[str], by: Sequence[Column | str], name: str = "index", partitions: int | None = None
) -> DataFrame:
    """Dense 1-based index of every row within its group, in the order of `by`; null keys are a group."""
    if not keys:
        return global_index(df, by, name, partitions)
    runs = sorted_runs(df, [*keys, *by], partitions)
    parts = runs.groupBy(*keys, "_run").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(*keys).orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first") + 1
    start = parts.withColumn("_shift", shift)
    placed = sized_lookup(runs, start, [*keys, "_run"], ["_shift"], F.col("_n"), ["_at"])
    return placed.withColumn(name, F.col("_at") + F.col("_shift")).select(*df.columns, name)
