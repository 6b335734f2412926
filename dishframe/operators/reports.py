"""Text renderings. Each is a table of lines with a sort key, so no text passes through one row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from dishframe.functions.text import strip


def escape_cell(value: Column) -> Column:
    return F.replace(F.replace(F.coalesce(value, F.lit("")), F.lit("|"), F.lit("\\|")), F.lit("\n"), F.lit("<br>"))


def table_row(*cells: Column) -> Column:
    return F.concat(F.lit("| "), F.concat_ws(" | ", *[escape_cell(c.cast("string")) for c in cells]), F.lit(" |"))


def markdown_table(rows: DataFrame, order: Sequence[str], columns: dict[str, str]) -> DataFrame:
    """(part, order..., line): heading lines first, then one escaped line per row.

    `columns` maps headings to column names.
    """
    spark = rows.sparkSession
    headings = "| " + " | ".join(columns) + " |"
    rule = "| " + " | ".join("---" for _ in columns) + " |"
    head = spark.range(1).select(
        F.explode(F.array(F.struct(F.lit(0).alias("part"), F.lit(headings).alias("line")), F.struct(F.lit(1).alias("part"), F.lit(rule).alias("line")))).alias("h")
    ).select("h.part", *[F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in order], "h.line")
    body = rows.select(F.lit(2).alias("part"), *order, table_row(*[F.col(c) for c in columns.values()]).alias("line"))
    return head.unionByName(body)


def consensus_line() -> Column:
    """Report cells of a consensus row: number, average with label, confidence, votes, title, url."""
    votes = F.concat_ws("/", "high", "medium", "low", "none")
    average = F.coalesce(F.bround("avg_score", 2).cast("decimal(3,2)").cast("string"), F.lit(""))
    return table_row(
        F.col("index"), F.concat(average, F.lit(" "), "average_usefulness"), F.col("confidence"), votes,
        F.col("title"), F.col("url"),
    )


def result_block(index: Column, title: Column, url: Column, text: Column) -> Column:
    """Labelled block of one result."""
    line = lambda label, value: F.concat(F.lit(label), F.coalesce(value.cast("string"), F.lit("")))
    return F.concat_ws("\n", line("Result ", index), line("Title: ", title), line("URL: ", url), line("Text: ", text))


def source_block(source: Column, url: Column, title: Column, text: Column, rule: str = "=" * 60) -> Column:
    """Text of one page under a header that names its source."""
    return F.concat_ws(
        "\n", F.lit(""), F.lit(rule), F.concat(F.lit("Source: "), source), F.concat(F.lit("URL: "), url),
        F.concat(F.lit("Title: "), title), F.lit(rule), F.lit(""), text,
    )


def section_text(items: Column, title: Column, description: Column) -> Column:
    """Printed text of one menu section from its item array (title, description, price_top, price_bottom).

    The bottom price slot is preferred here; an untitled item contributes only its price line.
    """
    empty = F.array().cast("array<string>")
    some = lambda text: F.when(F.coalesce(text, F.lit("")) != "", F.array(text)).otherwise(empty)

    def lines(item: Column) -> Column:
        price = F.coalesce(F.nullif(item["price_bottom"], F.lit("")), item["price_top"], F.lit(""))
        titled = F.coalesce(item["title"], F.lit("")) != ""
        described = F.coalesce(item["description"], F.lit(""))
        full = F.concat(
            F.when(titled, F.array(F.lit(""), item["title"])).otherwise(empty),
            some(described),
            F.when((price != "") & (price != described), F.array(price)).otherwise(empty),
        )
        return F.when(~titled & (price != ""), F.array(price)).otherwise(full)

    body = F.flatten(F.transform(items, lines))
    return strip(F.array_join(F.concat(some(title), some(description), body), "\n"))


def block_title(titles: Column) -> Column:
    """Section titles of a block joined by ' / ', else 'untitled'."""
    joined = F.array_join(F.filter(titles, lambda t: t != ""), " / ")
    return F.coalesce(F.nullif(joined, F.lit("")), F.lit("untitled"))


def grouped_text(texts: DataFrame, groups: DataFrame, key: str, separator: str = "\n\n\n") -> DataFrame:
    """Texts concatenated by a small (group, pos, key) dimension; a missing member is an error."""
    joined = groups.join(texts, key, "left").withColumn(
        "_text",
        F.when(F.col("text").isNotNull(), strip(F.col("text"))).otherwise(
            F.raise_error(F.concat(F.lit("missing group member: "), F.col(key))).cast("string")
        ),
    )
    ordered = F.array_sort(F.collect_list(F.struct("pos", "_text")))
    return joined.groupBy("group").agg(F.array_join(ordered["_text"], separator).alias("text"))
