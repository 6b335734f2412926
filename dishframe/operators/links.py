"""Link tables of saved pages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from dishframe.functions import html, urls
from dishframe.functions.text import first
from dishframe.operators.folding import keep_first


def page_links(pages: DataFrame, key: Sequence[str], markup: str = "html", url: str = "url") -> DataFrame:
    """(key, pos, link) with links made absolute, in document order."""
    return pages.select(*key, url, F.posexplode(html.links(F.col(markup))).alias("pos", "_l")).select(
        *key, "pos", urls.resolve(F.col(url), F.col("_l")).alias("link")
    )


def distinct_links(links: DataFrame, key: Sequence[str], link: str = "link", position: str = "pos") -> DataFrame:
    """First occurrence of every link of a key."""
    return keep_first(links, [*key, link], [position])


def provider_links(pages: DataFrame, key: Sequence[str], markup: str = "html") -> DataFrame:
    """Decoded links to ordering providers, distinct in order; row-local."""
    found = F.transform(html.links(F.col(markup)), urls.unquote)
    kept = F.array_distinct(F.filter(found, lambda link: urls.is_provider_link(link)))
    return pages.select(*key, F.posexplode(kept).alias("pos", "link"))


def own_site_links(pages: DataFrame, key: Sequence[str], markup: str = "html", url: str = "url", limit: int | None = None) -> DataFrame:
    """The page itself and its useful same-site links, distinct; with a limit the first of them. Row-local."""
    base = F.col(url)
    targets = F.transform(html.links(F.col(markup)), lambda link: urls.resolve(base, link))
    useful = F.filter(targets, lambda t: urls.same_site(t, base) & urls.is_useful_link(t))
    kept = first(F.array_distinct(F.concat(F.array(base), useful)), limit)
    return pages.select(*key, F.posexplode(kept).alias("pos", "link"))


def first_per_group(rows: DataFrame, group: Sequence[str], order: Sequence[Column | str], limit: int) -> DataFrame:
    """At most `limit` rows per group; Spark cuts every partition before the exchange."""
    ranked = rows.withColumn("rank", F.row_number().over(Window.partitionBy(*group).orderBy(*order)))
    return ranked.filter(F.col("rank") <= limit)


def admitted_links(found: DataFrame, seeds: DataFrame, fallback: str = "google_search") -> DataFrame:
    """Seed URLs, then found links whose class equals their source; first per (source, link).

    found and seeds: (source, pos, link).
    """
    kept = found.filter(urls.is_admitted(F.col("link"), F.col("source")) & (F.col("source") != fallback))
    both = seeds.withColumn("stage", F.lit(0)).unionByName(kept.withColumn("stage", F.lit(1)))
    return keep_first(both, ["source", "link"], ["stage", "pos"])


def store_candidates(links: DataFrame, key: Sequence[str], marker: str) -> DataFrame:
    """Unwrapped links that contain a path marker, distinct in order."""
    target = links.withColumn("link", urls.unquote(urls.unwrap(F.col("link")))).filter(
        F.contains(F.col("link"), F.lit(marker))
    )
    return distinct_links(target, key)


def included_pages(pages: DataFrame, own_source: str, linked_source: str, phrase: str, panel_source: str, paths: Sequence[str]) -> DataFrame:
    """Pages that go into a combined text: own pages, linked pages naming the place, menu-like panel pages."""
    at_provider = F.lit(False)
    for path in paths:
        at_provider = at_provider | F.contains(F.lower("url"), F.lit(path))
    return pages.filter(
        (F.col("source") == own_source)
        | ((F.col("source") == linked_source) & F.contains("text", F.lit(phrase)))
        | ((F.col("source") == panel_source) & urls.looks_like_menu(F.col("text")) & at_provider)
    )
