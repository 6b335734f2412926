"""A harvest that can stop at any time: increments with commit markers, resumed from the last one.

Layout under one shared folder: `data/version=N` holds the rows of an increment, `commits/version=N` one
line that names it, written only after the rows are there. Rows without their commit line do not
count and are written anew by the next attempt; a committed increment is never touched again. A
snapshot is the last state of each key over the committed increments, so a step of a long harvest
writes its own rows, not all rows so far. One writer at a time.

Defined cases: no commit yet is an empty snapshot; rows without a key, or with an empty one, are left out;
a row without a payload is a failed fetch and does not count as held; of a key repeated in an
increment the row with a payload stays, then the one of the greater position, then the greater payload; an empty
work list commits one complete, empty increment.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

COMMIT = "version int, complete boolean, n_rows long"


def commits(spark: SparkSession, path: str) -> DataFrame:
    """(version, complete, n_rows) of the committed increments; a few rows."""
    try:
        return spark.read.schema(COMMIT).json(f"{path}/commits")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], COMMIT)


def write_increment(rows: DataFrame, path: str, version: int) -> None:
    """Rows of an increment that does not count yet; an earlier attempt at it is replaced."""
    rows.write.mode("overwrite").parquet(f"{path}/data/version={version}")


def commit(spark: SparkSession, path: str, version: int, complete: bool) -> None:
    """Make a written increment count."""
    n = spark.read.parquet(f"{path}/data/version={version}").count()
    line = spark.createDataFrame([(version, complete, n)], COMMIT).coalesce(1)
    line.write.mode("error").json(f"{path}/commits/version={version}")


def snapshot(spark: SparkSession, path: str, schema: str, key: str, payload: str, position: str) -> DataFrame:
    """Last state of each key over the committed increments, with its version."""
    done = [r.version for r in commits(spark, path).select("version").collect()]
    if not done:
        return spark.createDataFrame([], f"{schema}, version int")
    folders = [f"{path}/data/version={v}" for v in sorted(done)]
    rows = spark.read.schema(f"{schema}, version int").option("basePath", f"{path}/data").parquet(*folders)
    fields = [c for c in rows.columns if c != key]
    last = F.struct(F.col(payload).isNotNull(), "version", position, payload)
    named = rows.filter(F.coalesce(F.col(key).cast("string"), F.lit("")) != "")
    return named.groupBy(key).agg(F.max_by(F.struct(*fields), last).alias("_s")).select(key, "_s.*").select(*rows.columns)


def remaining(items: DataFrame, held: DataFrame, key: str, payload: str) -> DataFrame:
    """Items without a payload so far."""
    return items.join(held.filter(F.col(payload).isNotNull()).select(key), key, "left_anti").select(*items.columns)


def harvest(
    spark: SparkSession,
    path: str,
    items: DataFrame,
    fetch: Callable[[DataFrame], DataFrame],
    schema: str,
    key: str = "item_id",
    payload: str = "item_page",
    position: str = "menu_position",
    steps: int = 1,
    portion: Column | None = None,
) -> DataFrame:
    """Fetch what is not held yet in `steps` portions, each committed by itself; the snapshot after the last.

    `fetch` turns items into rows of `schema`. `portion` deals items to steps (by default a hash of the
    key). Running it again after a stop goes on with the items that no committed increment holds.
    """
    seen = commits(spark, path).agg(F.max("version")).first()[0]
    held = snapshot(spark, path, schema, key, payload, position)
    todo = remaining(items, held, key, payload).withColumn("_step", F.pmod(F.xxhash64(key) if portion is None else portion, F.lit(steps)))
    for step in range(steps):
        version = (0 if seen is None else seen + 1) + step
        write_increment(fetch(todo.filter(F.col("_step") == step).drop("_step")), path, version)
        commit(spark, path, version, step == steps - 1)
    return snapshot(spark, path, schema, key, payload, position)
