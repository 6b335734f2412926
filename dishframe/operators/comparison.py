"""Several models' versions of one menu: parsing, alignment, coverage and disagreements.

After latest_per_model a key has at most one row per model, so sets and lists below are
bounded by the number of models, not by the data.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from dishframe.functions.text import strip
from dishframe.operators.folding import keep_last

# Column headings of the three row layouts.
SEVEN_COLUMNS = (
    "dish name", "original category", "canonical category", "base price", "sides number", "side choices", "description",
)
SEVEN_FIELDS = (
    "dish", "original_category", "canonical_category", "price", "sides_number", "side_choices", "description",
)
SIX_FIELDS = ("dish", "category", "price", "sides_number", "side_choices", "description")
FOUR_FIELDS = ("dish", "category", "price", "description")

RULE_LINE = r"^\|?\s*:?-{3,}:?\s*(\|\s*:?-{3,}:?\s*)+\|?$"


def _bare_lines(lines: DataFrame, line: str) -> DataFrame:
    """Data lines without their outer pipes, as _bare."""
    text = F.col("_text")
    rule = text.contains("---") & text.rlike(RULE_LINE)
    kept = lines.withColumn("_text", strip(F.col(line))).filter((text != "") & ~text.startswith("<!--") & ~rule)
    return kept.withColumn("_bare", F.btrim(text, F.lit("|"))).drop("_text")


def row_lines(lines: DataFrame, line: str = "line", headings: Sequence[str] = ()) -> DataFrame:
    """Data lines of pipe tables: blanks, comments, rules and heading rows dropped, cells split."""
    kept = _bare_lines(lines, line).withColumn("cells", F.transform(F.split("_bare", r"\|", -1), strip)).drop("_bare")
    if headings:
        kept = kept.filter(F.transform("cells", F.lower) != F.array(*[F.lit(h) for h in headings]))
    return kept


def well_formed(rows: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Rows with exactly the expected number of cells, as named columns."""
    return rows.filter(F.size("cells") == len(fields)).select(
        *[c for c in rows.columns if c != "cells"],
        *[F.get("cells", F.lit(i)).alias(f) for i, f in enumerate(fields)],
    )


def model_summary(rows: DataFrame, n_fields: int, model: str = "model") -> DataFrame:
    fits = F.size("cells") == n_fields
    return rows.groupBy(model).agg(
        F.count_if(fits).alias("parsed_rows"),
        F.count(F.lit(1)).alias("raw_rows"),
        F.count_if(~fits).alias("malformed_rows"),
    )


def line_summary(lines: DataFrame, n_fields: int, model: str = "model", line: str = "line") -> DataFrame:
    """model_summary straight from the lines: cells are counted by their borders, none is cut out."""
    borders = F.length("_bare") - F.length(F.replace("_bare", F.lit("|"), F.lit("")))
    kept = _bare_lines(lines, line).select(model, (borders + 1 == n_fields).alias("_fits"))
    return kept.groupBy(model).agg(
        F.count_if("_fits").alias("parsed_rows"), F.count(F.lit(1)).alias("raw_rows"), F.count_if(~F.col("_fits")).alias("malformed_rows")
    )


def latest_per_model(items: DataFrame, keys: Sequence[str], model: str = "model", order: str = "line_no") -> DataFrame:
    """One row per (key, model): the last one a model printed."""
    return keep_last(items, [*keys, model], [order])


def coverage_gaps(aligned: DataFrame, keys: Sequence[str], models: DataFrame, model: str = "model") -> DataFrame:
    """Keys that some models lack: who has them, who does not.

    `models` lists every model once; its set enters as a scalar, not through a cross join.
    """
    everyone = models.select(F.array_sort(F.collect_set(model))).scalar()
    present = aligned.groupBy(*keys).agg(F.array_sort(F.collect_set(model)).alias("present"))
    return present.withColumn("missing", F.array_except(everyone, "present")).filter(F.size("missing") > 0)


def disagreements(
    aligned: DataFrame,
    keys: Sequence[str],
    value: Column,
    normalizer: Callable[[Column], Column] = lambda v: v,
    model: str = "model",
    blank: str = "[blank]",
) -> DataFrame:
    """Keys with more than one normalized value, as 'value: models; value: models'."""
    grouped = (
        aligned.withColumn("_value", normalizer(value))
        .groupBy(*keys, "_value")
        .agg(F.array_join(F.array_sort(F.collect_set(model)), ", ").alias("_models"))
    )
    entries = F.array_sort(F.collect_list(F.struct("_value", "_models")))
    per_key = grouped.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_values"), entries.alias("_entries"))
    shown = F.transform(
        "_entries",
        lambda e: F.concat(
            F.when(F.coalesce(e["_value"], F.lit("")) == "", F.lit(blank)).otherwise(e["_value"]), F.lit(": "), e["_models"]
        ),
    )
    return per_key.filter(F.col("n_values") > 1).select(*keys, "n_values", F.array_join(shown, "; ").alias("values_by_model"))


def split_check(items: DataFrame, expected: Sequence[str], dish_key: Column, in_category: Column, model: str = "model") -> DataFrame:
    """Per model: which of the expected dishes occur in a category, and which do not."""
    wanted = F.array(*[F.lit(name) for name in sorted(expected)])
    found = items.groupBy(model).agg(
        F.collect_set(F.when(in_category & dish_key.isin(*expected), dish_key)).alias("_found")
    )
    listed = lambda names: F.coalesce(F.nullif(F.array_join(names, ", "), F.lit("")), F.lit("-"))
    return found.select(
        model,
        listed(F.array_sort(F.array_intersect(wanted, "_found"))).alias("present"),
        listed(F.array_sort(F.array_except(wanted, F.col("_found")))).alias("missing"),
    )


def flagged_rows(items: DataFrame, flags: dict[str, Column], model: str = "model", dish: str = "dish") -> DataFrame:
    """(model, flag, dish) rows of unsupported sides, invalid prices and the like, one per finding."""
    tests = F.array_compact(F.array(*[F.when(test, F.lit(name)) for name, test in flags.items()]))
    return items.select(model, F.explode(tests).alias("flag"), dish)
