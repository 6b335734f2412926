"""Writers. All of them write from the executors; nothing is gathered first."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from dishframe.operators import poi


def sorted_json(df: DataFrame, path: str) -> None:
    """JSON lines with columns in name order; NULL fields are left out."""
    df.select(*sorted(df.columns)).write.mode("overwrite").json(path)


def routed_features(features: DataFrame, path: str) -> None:
    """One pass over the features, one folder per route; a feature may go to several."""
    poi.with_routes(features).withColumn("route", F.explode("routes")).drop("routes").write.mode(
        "overwrite"
    ).partitionBy("route").json(path)


def menu_documents(items: DataFrame, menu: Sequence[str], item_fields: Sequence[str]) -> DataFrame:
    """Nested menus: sections by first appearance, items by position. One menu is one document."""
    item = F.struct("pos", F.struct(*item_fields).alias("i"))
    sections = items.groupBy(*menu, "section").agg(
        F.min("pos").alias("_first"), F.array_sort(F.collect_list(item), lambda a, b: F.sign(a["pos"] - b["pos"]).cast("int")).alias("_items")
    )
    listed = F.array_sort(
        F.collect_list(F.struct("_first", "section", F.col("_items")["i"].alias("items"))),
        lambda a, b: F.sign(a["_first"] - b["_first"]).cast("int"),
    )
    return sections.groupBy(*menu).agg(listed.alias("_s")).select(
        *menu,
        F.transform("_s", lambda s: F.struct(s["section"].alias("section"), s["items"].alias("items"))).alias("menu_sections"),
    )


def write_menus(items: DataFrame, menu: Sequence[str], item_fields: Sequence[str], path: str) -> None:
    menu_documents(items, menu, item_fields).write.mode("overwrite").json(path)


def menu_lines(items: DataFrame, menu: Sequence[str], item_fields: Sequence[str]) -> DataFrame:
    """Nested menus in long form, for menus larger than a task: one row per item, no group in one row.

    `line` is the item as JSON with the text that opens or closes its section and menu around it, so the
    lines in order of menu_key, section_at, pos read as one document per menu. Borders come from least
    and greatest positions, not from neighbours. `pos` is set and unique within a menu; a menu or section
    without a name is one of its own.
    """
    key = lambda names: F.to_json(F.struct(*names))
    opened = lambda k, then: F.concat(F.expr(f"left({k}, length({k}) - 1)"), F.when(F.col(k) != "{}", ",").otherwise(""), F.lit(then))
    keyed = items.withColumn("menu_key", key(menu)).withColumn("_section", key(["section"]))
    sections = keyed.groupBy("menu_key", "_section").agg(F.min("pos").alias("section_at"), F.max("pos").alias("_last"))
    menus = sections.groupBy("menu_key").agg(F.min("section_at").alias("_head"), F.max("section_at").alias("_tail"))
    at, first = F.col("pos"), F.col("section_at")
    begins, ends = at == first, at == F.col("_last")
    either = lambda test, yes, no="": F.when(test, yes).otherwise(F.lit(no))
    line = F.concat(
        either(at == F.col("_head"), opened("menu_key", '"menu_sections":['), ","),
        either(begins, opened("_section", '"items":[')),
        key(item_fields),
        either(ends, F.lit("]}")),
        either(ends & (first == F.col("_tail")), F.lit("]}")),
    )
    placed = keyed.join(sections.join(menus, "menu_key"), ["menu_key", "_section"])
    return placed.select(*menu, "section", "pos", "menu_key", "section_at", line.alias("line"))


def write_menu_lines(items: DataFrame, menu: Sequence[str], item_fields: Sequence[str], path: str) -> None:
    """The long form as text; its files in name order are the documents, a menu may go on in the next file."""
    ordered_text(menu_lines(items, menu, item_fields), ["menu_key", "section_at", "pos"], path)


def ordered_text(lines: DataFrame, order: Sequence[str], path: str, line: str = "line") -> None:
    """Text files that read in order when taken by file name."""
    lines.repartitionByRange(*order).sortWithinPartitions(*order).select(line).write.mode("overwrite").text(path)


def tag_counts(features: DataFrame, path: str) -> None:
    poi.tag_value_counts(features).write.mode("overwrite").json(path)


def name_lists(facts: DataFrame, path: str) -> None:
    """Cuisine lines, unknown-cuisine names, and whole records without a name."""
    poi.cuisine_lines(facts).write.mode("overwrite").text(f"{path}/cuisine_lines")
    poi.unknown_cuisine_names(facts).write.mode("overwrite").text(f"{path}/unknown_cuisine")
    facts.filter(F.col("raw_name").isNull()).write.mode("overwrite").json(f"{path}/without_name")


def snapshot(results: DataFrame, path: str, complete: bool) -> None:
    """Whole ordered snapshot with its completion flag; writing it again gives the same files."""
    results.withColumn("complete", F.lit(complete)).repartitionByRange("menu_position").sortWithinPartitions(
        "menu_position"
    ).write.mode("overwrite").json(path)
