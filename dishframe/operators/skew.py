"""Building blocks that keep one very large key from landing in one task.

Positional operators cut each group into chunks of `width` positions, work inside a
chunk, and carry a small per-chunk summary across chunks. Lookups salt the few keys that
are heavy and leave all others alone.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

CHUNK = 65536
SALTS = 64
# No key outside the N heaviest can hold more than 1/N of the rows, so N rows are enough.
HEAVY_KEYS = 1000
SKETCH_ITEMS = 10_000
HEAVY_ROWS = 1_000_000

# Hash of a heavy key -> number of salts, as heavy_keys() finds them; None: join plainly.
Heavy = Mapping[int, int] | None


def chunk_of(position: Column, width: int = CHUNK) -> Column:
    return F.floor(position / F.lit(width))


def salt_of(spread: Sequence[str], salts: int = SALTS) -> Column:
    """Stable salt: a retried task sends each row to the same place."""
    return F.pmod(F.xxhash64(*spread), F.lit(salts)).cast("int")


def sized_lookup(
    rows: DataFrame, lookup: DataFrame, keys: Sequence[str], values: Sequence[str], size: Column, spread: Sequence[str], large: int = CHUNK
) -> DataFrame:
    """Add the values of a lookup that holds every key of the rows once, and knows how many rows have it.

    Keys of at least `large` rows, so at most one in `large` rows, are held by every task; their rows are
    dealt evenly over the tasks of the join with all others. No task sorts a whole large key. Null
    keys are equal.
    """
    side = lookup.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], *[F.col(v).alias(f"_v{i}") for i, v in enumerate(values)], size.alias("_size"))

    def same(tag: str) -> Column:
        out = F.lit(True)
        for i, k in enumerate(keys):
            out &= F.col(k).eqNullSafe(F.col(f"_{tag}k{i}"))
        return out

    held = side.filter(F.col("_size") >= large)
    held = F.broadcast(held.select(*[F.col(c).alias(f"_h{c[1:]}") for c in held.columns]))
    # Rows of large keys have salts above 0, which no key of the other side has. A literal 0 there would
    # be taken out of the join's keys by the optimizer, and a large key would be one task again.
    marked = rows.join(held, same("h"), "left").withColumn(
        "_salt", F.when(F.col("_hsize").isNotNull(), salt_of(spread, CHUNK) + 1).otherwise(0)
    )
    own = side.withColumn("_own", F.when(F.col("_size") >= large, -1).otherwise(0))
    met = marked.join(own, same("") & (F.col("_salt") == F.col("_own")), "left")
    return met.select(*rows.columns, *[F.coalesce(f"_hv{i}", f"_v{i}").alias(v) for i, v in enumerate(values)])


def preceding_rows(df: DataFrame, keys: Sequence[str], chunk: str) -> DataFrame:
    """Per (keys, chunk): how many rows of the group lie in earlier chunks."""
    counts = df.groupBy(*keys, chunk).agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(*keys).orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)
    return counts.select(*keys, chunk, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))


def row_numbers(
    df: DataFrame,
    keys: Sequence[str],
    lead: Column,
    ties: Sequence[Column | str],
    name: str,
    width: float = CHUNK,
) -> DataFrame:
    """row_number() over (keys order by lead, ties), ranked chunk by chunk.

    `lead` is a non-null number; equal leads share a chunk, so pick `width` for about a
    hundred thousand rows per chunk of the largest group.
    """
    staged = df.withColumn("_lead", lead).withColumn("_chunk", chunk_of(F.col("_lead"), width))
    before = preceding_rows(staged, keys, "_chunk")
    within = Window.partitionBy(*keys, "_chunk").orderBy("_lead", *ties)
    return (
        staged.withColumn("_rank", F.row_number().over(within))
        .join(before, [*keys, "_chunk"])
        .withColumn(name, F.col("_rank") + F.col("_before"))
        .drop("_lead", "_chunk", "_rank", "_before")
    )


def carry_forward(
    df: DataFrame, keys: Sequence[str], position: str, value: Column, name: str, width: int = CHUNK
) -> DataFrame:
    """Last non-null value at or before each row, in position order within the group."""
    staged = df.withColumn("_value", value).withColumn("_chunk", chunk_of(F.col(position), width))
    tails = staged.groupBy(*keys, "_chunk").agg(
        F.max_by("_value", F.when(F.col("_value").isNotNull(), F.col(position))).alias("_tail")
    )
    earlier = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = tails.select(*keys, "_chunk", F.last("_tail", ignorenulls=True).over(earlier).alias("_carried"))
    within = (
        Window.partitionBy(*keys, "_chunk")
        .orderBy(position)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        staged.withColumn("_seen", F.last("_value", ignorenulls=True).over(within))
        .join(carried, [*keys, "_chunk"])
        .withColumn(name, F.coalesce("_seen", "_carried"))
        .drop("_value", "_chunk", "_seen", "_carried")
    )


def with_context(
    df: DataFrame,
    keys: Sequence[str],
    position: str,
    value: str,
    name: str,
    before: int,
    after: int,
    width: int = CHUNK,
) -> DataFrame:
    """Array of the values at positions -before..+after around each row.

    Positions are 0, 1, 2, ... without gaps. Rows next to a chunk border are copied into
    the neighbouring chunk, so every window is complete inside one chunk.
    """
    if width <= before + after:
        raise ValueError("chunk width must exceed the context")
    own = chunk_of(F.col(position), width)
    offset = F.pmod(F.col(position), F.lit(width))
    chunks = F.array_compact(
        F.array(
            own,
            F.when((offset < after) & (F.col(position) >= width), own - 1),
            F.when(offset >= width - before, own + 1),
        )
    )
    around = Window.partitionBy(*keys, "_chunk").orderBy(position).rowsBetween(-before, after)
    return (
        df.withColumn("_own", own)
        .withColumn("_chunk", F.explode(chunks))
        .withColumn(name, F.collect_list(value).over(around))
        .filter(F.col("_chunk") == F.col("_own"))
        .drop("_own", "_chunk")
    )


def heavy_keys(rows: DataFrame, keys: Sequence[str], min_rows: int = HEAVY_ROWS) -> dict[int, int]:
    """Hashes of the keys worth salting, each with its number of salts: one per min_rows rows.

    A frequent-items sketch finds them in one pass without a shuffle by key. It holds at most
    HEAVY_KEYS keys and cannot miss one with more than a thousandth of the rows. The pairs are
    fetched once, as both sides of a join must agree on them and two runs of a sketch may not.
    """
    sketch = F.call_function("approx_top_k", F.xxhash64(*keys), F.lit(HEAVY_KEYS), F.lit(SKETCH_ITEMS))
    top = rows.agg(sketch.alias("top")).first()["top"] or []
    return {t["item"]: math.ceil(t["count"] / min_rows) for t in top if t["count"] > min_rows}


def _with_salts(df: DataFrame, heavy: Mapping[int, int], keys: Sequence[str]) -> DataFrame:
    table = df.sparkSession.createDataFrame(list(heavy.items()), "_key_hash bigint, _salts int")
    return df.withColumn("_key_hash", F.xxhash64(*keys)).join(F.broadcast(table), "_key_hash", "left").drop("_key_hash")


def salt_rows(rows: DataFrame, heavy: Mapping[int, int], keys: Sequence[str], spread: Sequence[str]) -> DataFrame:
    """Add _salt: rows of a heavy key, or of a heavy NULL, are spread by the hash of other columns."""
    if not heavy:
        return rows.withColumn("_salt", F.lit(0))
    salt = F.pmod(F.xxhash64(*spread), F.coalesce("_salts", F.lit(1))).cast("int")
    return _with_salts(rows, heavy, keys).withColumn("_salt", salt).drop("_salts")


def replicate(lookup: DataFrame, heavy: Mapping[int, int], keys: Sequence[str]) -> DataFrame:
    """One copy of a lookup row per salt of its key."""
    if not heavy:
        return lookup.withColumn("_salt", F.lit(0))
    salts = F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)
    return _with_salts(lookup, heavy, keys).withColumn("_salt", F.explode(salts)).drop("_salts")


def salted_lookup(
    rows: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    spread: Sequence[str],
    how: str = "left",
    heavy: Heavy = None,
) -> DataFrame:
    """Join rows to a lookup unique on keys.

    Skew is left to adaptive execution, which splits large partitions of rows in left and inner
    joins. A caller that knows its heavy keys (heavy_keys) may give them: their rows are salted.
    """
    keys = list(keys)
    if not heavy:
        return rows.join(lookup, keys, how)
    left = salt_rows(rows, heavy, keys, spread)
    return left.join(replicate(lookup, heavy, keys), [*keys, "_salt"], how).drop("_salt")


def k_bounds(df: DataFrame, keys: Sequence[str], value: str, k: Column) -> DataFrame:
    """Per group: n, floor and ceiling of the values, the greatest k, and the sums of the k smallest
    (low) and of the k largest (high); of all when there are fewer.

    One exchange: the ranks and the sums share the partitioning by keys.
    """
    keys = list(keys)
    group = Window.partitionBy(*keys)
    ranked = df.select(
        *keys,
        F.col(value).alias("_value"),
        k.alias("_k"),
        F.row_number().over(group.orderBy(F.col(value).asc())).alias("_up"),
        F.row_number().over(group.orderBy(F.col(value).desc())).alias("_down"),
    )
    return ranked.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.min("_value").alias("floor"),
        F.max("_value").alias("ceiling"),
        F.max("_k").alias("k"),
        F.sum(F.when(F.col("_up") <= F.col("_k"), F.col("_value"))).alias("low"),
        F.sum(F.when(F.col("_down") <= F.col("_k"), F.col("_value"))).alias("high"),
    )
