"""URL columns: unwrapping, hosts, source classes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, functions as F

# Ordering providers whose links are kept.
PROVIDER_DOMAINS = (
    "doordash.com",
    "grubhub.com",
    "ubereats.com",
    "toasttab.com",
    "clover.com",
    "square.site",
    "order.online",
    "menufy.com",
    "beyondmenu.com",
    "chownow.com",
    "ezcater.com",
    "slice.life",
    "seamless.com",
)

# Review sources by URL fragment, first match wins.
REVIEW_SOURCES = {
    "google_maps": ("google.com/maps", "maps.google.com"),
    "google_search": ("google.com/search",),
    "doordash": ("doordash.com", "order.online"),
    "grubhub": ("grubhub.com",),
    "postmates_uber_eats": ("postmates.com", "ubereats.com"),
    "yelp": ("yelp.com/biz",),
    "facebook": ("facebook.com",),
    "tripadvisor": ("tripadvisor.com",),
}

# Words that make an own-site link worth keeping.
USEFUL_LINK = r"(?i)(menu|order|online|about|location|contact|hours|catering|gallery|dinner|lunch)"

# Words that make a page look like a menu.
MENU_TEXT = (
    r"(?i)(\$\d|taco|burrito|enchilada|fajita|quesadilla|nacho|chimichanga|"
    r"menu|lunch|dinner|appetizer|dessert|drink|margarita|salsa|guacamole)"
)


def unquote(url: Column) -> Column:
    """Percent-decoding that leaves '+' alone; a broken escape keeps the text as it is."""
    return F.coalesce(F.try_url_decode(F.replace(url, F.lit("+"), F.lit("%2B"))), url)


def unwrap(url: Column, *parameters: str) -> Column:
    """Target of a search engine's '/url?q=' redirect, else the URL itself."""
    targets = [F.try_parse_url(url, F.lit("QUERY"), F.lit(p)) for p in (parameters or ("q",))]
    decoded = [F.nullif(F.try_url_decode(t), F.lit("")) for t in targets]
    return F.when(F.try_parse_url(url, F.lit("PATH")) == "/url", F.coalesce(*decoded, url)).otherwise(url)


def site(url: Column) -> Column:
    """Lower-case network location without a leading 'www.'."""
    location = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))
    return F.regexp_replace(location, r"^www\.", "")


def same_site(url: Column, base: Column) -> Column:
    return site(url) == site(base)


def without_dots(path: Column) -> Column:
    """A path with its '.' and '..' segments resolved."""
    def step(held: Column, part: Column) -> Column:
        return (
            F.when(part == "..", F.slice(held, F.lit(1), F.greatest(F.size(held) - 1, F.lit(1))))
            .when(part == ".", held)
            .otherwise(F.concat(held, F.array(part)))
        )

    parts = F.split(path, "/")
    closed = F.when(F.rlike(path, F.lit(r"/\.\.?$")), F.array(F.lit(""))).otherwise(F.array().cast("array<string>"))
    kept = F.concat(F.aggregate(parts, F.array().cast("array<string>"), step), closed)
    return F.when(F.rlike(path, F.lit(r"(^|/)\.\.?(/|$)")), F.array_join(kept, "/")).otherwise(path)


def resolve(base: Column, link: Column) -> Column:
    """Absolute form of a link found on a page: as a browser reads it, dot segments resolved."""
    root = F.regexp_extract(base, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*", 0)
    folder = F.regexp_extract(base, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/(?:[^?#]*/)?)?", 1)
    path, rest = F.regexp_extract(link, "^[^?#]*", 0), F.regexp_extract(link, "(?s)^[^?#]*(.*)$", 1)
    return (
        F.when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), link)
        .when(link.startswith("//"), F.concat(F.regexp_extract(base, "^[^:]*:", 0), link))
        .when(link.startswith("/"), F.concat(root, without_dots(path), rest))
        .when(link.startswith("?"), F.concat(F.regexp_extract(base, "^[^?#]*", 0), link))
        .when(link.startswith("#"), F.concat(F.regexp_extract(base, "^[^#]*", 0), link))
        .when(link == "", base)
        .otherwise(F.concat(root, without_dots(F.concat(F.when(folder == "", "/").otherwise(folder), path)), rest))
    )


def _any_part(text: Column, parts: Sequence[str]) -> Column:
    hit = F.contains(text, F.lit(parts[0]))
    for part in parts[1:]:
        hit = hit | F.contains(text, F.lit(part))
    return hit


def is_provider_link(url: Column, domains: Sequence[str] = PROVIDER_DOMAINS) -> Column:
    return _any_part(F.lower(url), domains)


def source_of(url: Column, fallback: Column, sources: Mapping[str, Sequence[str]] = REVIEW_SOURCES) -> Column:
    """Name of the first source one of whose fragments occurs in the URL."""
    lowered = F.lower(url)
    rule = None
    for name, parts in sources.items():
        hit = _any_part(lowered, parts)
        rule = F.when(hit, F.lit(name)) if rule is None else rule.when(hit, F.lit(name))
    return fallback if rule is None else rule.otherwise(fallback)


def is_admitted(link: Column, source: Column, sources: Mapping[str, Sequence[str]] = REVIEW_SOURCES) -> Column:
    """A link found by a source's query stays only if it classifies as that source."""
    return source_of(link, source, sources) == source


def is_useful_link(url: Column) -> Column:
    return url.rlike(USEFUL_LINK)


def looks_like_menu(text: Column) -> Column:
    return text.rlike(MENU_TEXT)


def branch(href: Column) -> Column:
    """Struct (branch_id, branch_name) from a link's query."""
    query = lambda key: F.try_url_decode(F.try_parse_url(href, F.lit("QUERY"), F.lit(key)))
    return F.struct(query("branchId").alias("branch_id"), query("branchName").alias("branch_name"))
