"""Map-feature tags: derived tags, restaurant predicates, cuisine classes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, functions as F

from dishframe.functions.text import join_present, let, present, split_tokens, strip

# Tag values that mark a place selling food to walk-in customers.
FOOD_AMENITIES = ("restaurant", "fast_food", "bar", "biergarten", "cafe", "pub", "ice_cream", "canteen")
FOOD_SHOPS = (
    "restaurant", "fast_food", "bakery", "confectionery", "coffee",
    "chocolate", "pastry", "deli", "tea", "seafood",
)

# Words that hint at a restaurant behind a shop=kitchen tag.
KITCHEN_HINTS = (
    "bbq", "bistro", "burger", "burrito", "cafe", "cantina", "chicken", "coffee", "deli", "diner",
    "eatery", "grill", "gyro", "kebab", "mexican", "pizzeria", "pizza", "pub", "restaurant",
    "sandwich", "seafood", "shack", "sushi", "taco", "taqueria", "wings",
)
HINT_FIELDS = ("name", "brand", "official_name", "operator", "description")

# Cuisine and name patterns of the Mexican subset, strong before weak.
CUISINE_PATTERNS = {
    "mexican": r"(?iu)\bmexican\b",
    "tex-mex": r"(?iu)\btex[- ]mex\b",
}
STRONG_PATTERNS = {
    "mexican": r"(?iu)\bmexican\b|\bmexicana\b|\bmexicano\b|\bmexi\b",
    "taqueria": r"(?iu)\btaquer[íi]a\b",
    "taco": r"(?iu)\btacos?\b|\btacobell\b",
    "burrito": r"(?iu)\bburritos?\b",
    "chipotle": r"(?iu)\bchipotle\b",
    "qdoba": r"(?iu)\bqdoba\b",
    "del taco": r"(?iu)\bdel\s+taco\b",
    "quesada": r"(?iu)\bquesada\b",
    "guac": r"(?iu)\bguac\b|\bguacamole\b",
    "jalapeno": r"(?iu)\bjalape[nñ]o\b",
}
WEAK_PATTERNS = {
    "catrina": r"(?iu)\bcatrina'?s\b",
    "el barzon": r"(?iu)\bel\s+barz[oó]n\b",
    "el parian": r"(?iu)\bel\s+pari[aá]n\b",
    "la esquinita": r"(?iu)\bla\s+esquinita\b",
    "la noria": r"(?iu)\bla\s+noria\b",
    "mangonadas": r"(?iu)\bmangonadas\b",
}


def tag(tags: Column, key: str) -> Column:
    return F.try_element_at(tags, F.lit(key))


def tag_map(pairs: Column, key: str = "_k", value: str = "_v") -> Column:
    """Map of tag pairs, last value per key; any 'diet:*' key also sets diet='subtype' at its place."""
    entry = lambda k, v: F.struct(k.alias("k"), v.alias("v"))
    own = lambda p: F.array(entry(p[key], F.coalesce(p[value], F.lit(""))))
    entries = F.flatten(
        F.transform(
            F.filter(pairs, lambda p: p[key].isNotNull()),
            lambda p: F.when(
                p[key].startswith("diet:"), F.concat(F.array(entry(F.lit("diet"), F.lit("subtype"))), own(p))
            ).otherwise(own(p)),
        )
    )
    rest = lambda es, i: F.slice(es, i + 2, F.greatest(F.size(es) - i - 1, F.lit(0)))
    last = let(
        entries, lambda es: F.filter(es, lambda e, i: ~F.exists(rest(es, i), lambda later: later["k"] == e["k"]))
    )
    return F.coalesce(F.map_from_entries(last), F.create_map().cast("map<string,string>"))


def _overlaps(tokens: Column, values: Sequence[str]) -> Column:
    return F.arrays_overlap(tokens, F.array(*[F.lit(v) for v in values]))


def is_restaurant(tags: Column) -> Column:
    """Food amenity or shop token, food=yes, or any cuisine or diet."""
    return (
        _overlaps(split_tokens(tag(tags, "amenity")), FOOD_AMENITIES)
        | _overlaps(split_tokens(tag(tags, "shop")), FOOD_SHOPS)
        | F.coalesce(tag(tags, "food") == "yes", F.lit(False))
        | present(tag(tags, "cuisine")).isNotNull()
        | present(tag(tags, "diet")).isNotNull()
    )


def shop_has(tags: Column, token: str) -> Column:
    return F.array_contains(split_tokens(tag(tags, "shop")), token)


def hint_review(text: Column, hints: Sequence[str] = KITCHEN_HINTS) -> Column:
    """Struct (possible_restaurant, matched_hints, searched_text): hints occurring as substrings."""
    searched = F.lower(text)
    matched = F.array_sort(
        F.filter(F.array(*[F.lit(h) for h in hints]), lambda h: F.contains(searched, h))
    )
    return F.struct(
        (F.size(matched) > 0).alias("possible_restaurant"),
        matched.alias("matched_hints"),
        searched.alias("searched_text"),
    )


def kitchen_review(tags: Column) -> Column:
    return hint_review(F.concat_ws(" ", *[strip(present(tag(tags, f))) for f in HINT_FIELDS]))


def tiered_match(
    text: Column,
    strong: Mapping[str, str],
    weak: Mapping[str, str],
    first: Mapping[str, Column] | None = None,
    strong_reason: str = "name/url keyword: ",
    weak_reason: str = "name/url looks Mexican: ",
) -> Column:
    """Struct (confidence, reasons, searched_text), NULL without a match.

    Weak patterns count only when no strong one and none of the `first` conditions holds.
    `first` maps a reason text to its condition.
    """
    certain = [F.when(hit, F.lit(reason)) for reason, hit in (first or {}).items()]
    certain += [F.when(text.rlike(p), F.lit(strong_reason + label)) for label, p in strong.items()]
    likely = [F.when(text.rlike(p), F.lit(weak_reason + label)) for label, p in weak.items()]
    return _pick_tier(F.array_compact(F.array(*certain)), F.array_compact(F.array(*likely)), text)


def _pick_tier(certain: Column, likely: Column, text: Column) -> Column:
    result = lambda confidence, reasons: F.struct(
        F.lit(confidence).alias("confidence"),
        F.array_sort(F.array_distinct(reasons)).alias("reasons"),
        text.alias("searched_text"),
    )
    tiers = F.struct(certain.alias("certain"), likely.alias("likely"))
    return let(
        tiers,
        lambda t: F.when(F.size(t["certain"]) > 0, result("high", t["certain"])).when(
            F.size(t["likely"]) > 0, result("likely", t["likely"])
        ),
    )


SEARCH_FIELDS = ("name", "brand", "operator", "official_name", "website", "url", "contact:website")


def search_text(tags: Column, fields: Sequence[str] = SEARCH_FIELDS) -> Column:
    return join_present(" ", *[tag(tags, f) for f in fields])


def mexican_match(tags: Column) -> Column:
    """Tiered classification of one feature by cuisine tag and by name or URL."""
    cuisine = F.coalesce(tag(tags, "cuisine"), F.lit(""))
    text = search_text(tags)
    quoted = F.concat(F.lit("cuisine='"), cuisine, F.lit("' contains "))
    certain = [F.when(cuisine.rlike(p), F.concat(quoted, F.lit(label))) for label, p in CUISINE_PATTERNS.items()]
    certain += [F.when(text.rlike(p), F.lit("name/url keyword: " + label)) for label, p in STRONG_PATTERNS.items()]
    likely = [F.when(text.rlike(p), F.lit("name/url looks Mexican: " + label)) for label, p in WEAK_PATTERNS.items()]
    return _pick_tier(F.array_compact(F.array(*certain)), F.array_compact(F.array(*likely)), text)


def cuisines(tags: Column) -> Column:
    """Cuisine tokens; repeats inside a record are kept."""
    return split_tokens(tag(tags, "cuisine"))


def diets(tags: Column) -> Column:
    """Sorted set of the direct diet value and of every diet:* key answered yes or only."""
    direct = F.lower(strip(tag(tags, "diet")))
    named = F.map_filter(
        tags, lambda k, v: k.startswith("diet:") & F.lower(strip(v)).isin("yes", "only")
    )
    keyed = F.transform(F.map_keys(named), lambda k: F.lower(strip(F.substring(k, 6, 1 << 30))))
    plain = F.when((tag(tags, "diet") != "subtype") & (direct != ""), F.array(direct)).otherwise(
        F.array().cast("array<string>")
    )
    return F.array_sort(F.array_distinct(F.filter(F.concat(plain, keyed), lambda d: d != "")))


def display_name(tags: Column, kind: Column, record_id: Column) -> Column:
    """First non-empty name-like tag, else 'Unnamed <type> <id>', else NULL."""
    named = [strip(present(tag(tags, k))) for k in ("name", "brand", "official_name", "operator")]
    unnamed = F.concat(
        F.lit("Unnamed "), F.coalesce(kind, F.lit("record")), F.lit(" "), record_id.cast("string")
    )
    return F.coalesce(*named, unnamed)


def address(tags: Column, default_state: str = "MI") -> Column:
    return join_present(
        " ",
        tag(tags, "addr:housenumber"),
        tag(tags, "addr:street"),
        tag(tags, "addr:city"),
        F.coalesce(tag(tags, "addr:state"), F.lit(default_state)),
    )


def mean_point(points: Column, lat: str = "lat", lon: str = "lon") -> Column:
    """Mean vertex of an array of points, NULL when it is empty."""
    total = lambda field: F.aggregate(points, F.lit(0.0), lambda acc, p: acc + p[field])
    n = F.size(points)
    return F.when(n > 0, F.struct((total(lat) / n).alias("lat"), (total(lon) / n).alias("lon")))
