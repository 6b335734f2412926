"""Error metrics between two numeric arrays, split by region or by weight."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F


def absolute_differences(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: F.abs(x.cast("double") - y.cast("double")))


def region_sums(differences: Column, inside, tolerances: Mapping[str, float]) -> Column:
    """Struct (n, total, exact, <tolerance name>...) over the positions for which `inside(i)` holds."""
    kept = F.filter(F.transform(differences, lambda d, i: F.when(inside(i), d)), lambda d: d.isNotNull())
    within = lambda limit: F.size(F.filter(kept, lambda d: d <= limit)).cast("bigint")
    return F.struct(
        F.size(kept).cast("bigint").alias("n"),
        F.aggregate(kept, F.lit(0.0), lambda acc, d: acc + d).alias("total"),
        within(0.0).alias("exact"),
        *[within(limit).alias(name) for name, limit in tolerances.items()],
    )


def region_metrics(
    pairs: DataFrame, keys: Sequence[str], a: str, b: str, regions: Mapping[str, object], tolerances: Mapping[str, float]
) -> DataFrame:
    """(keys, region) rows: coverage, mean absolute error, exact and within-tolerance percentages.

    Sums are taken inside each row and then added up, so no array is exploded.
    """
    difference = absolute_differences(F.col(a), F.col(b))
    staged = pairs.withColumn("_d", difference)
    sums = F.array(
        *[
            F.struct(
                F.lit(name).alias("region"),
                F.size("_d").cast("bigint").alias("size"),
                region_sums(F.col("_d"), inside, tolerances).alias("s"),
            )
            for name, inside in regions.items()
        ]
    )
    rows = staged.select(*keys, F.inline(sums)).select(*keys, "region", "size", "s.*")
    percent = lambda c: F.lit(100.0) * F.sum(c) / F.sum("n")
    return rows.groupBy(*keys, "region").agg(
        (F.lit(100.0) * F.sum("n") / F.sum("size")).alias("coverage_pct"),
        (F.sum("total") / F.sum("n")).alias("mae"),
        percent("exact").alias("exact_pct"),
        *[percent(name).alias(f"{name}_pct") for name in tolerances],
    )


def weighted_mae(pairs: DataFrame, keys: Sequence[str], a: str, b: str, weight: str) -> DataFrame:
    """sum(|a - b| * w) / sum(w) over all positions of all rows of a key."""
    difference = absolute_differences(F.col(a), F.col(b))
    weighted = F.zip_with(difference, F.col(weight), lambda d, w: d * w.cast("double"))
    add = lambda values: F.aggregate(values, F.lit(0.0), lambda acc, v: acc + v)
    total_weight = F.aggregate(F.col(weight), F.lit(0.0), lambda acc, w: acc + w.cast("double"))
    return pairs.groupBy(*keys).agg((F.sum(add(weighted)) / F.sum(total_weight)).alias("weighted_mae"))
