"""Text columns: whitespace, tokens, labels, slugs and dish-name keys.

Every function maps a Column to a Column and stays inside generated code.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from html.entities import html5

from pyspark.sql import Column, functions as F

# (?U) gives \s the Unicode meaning, which also covers no-break spaces.
_EDGE_SPACE = r"(?U)^\s+|\s+$"
# Runs that differ from one plain space: replacing only these leaves most of a text alone.
_ODD_SPACE = r"(?U) ?[\s&&[^ ]]\s*| \s+"

# Words that carry no identity in a restaurant name.
NAME_STOPWORDS = ("a", "an", "and", "bar", "grill", "mexican", "of", "restaurant", "taqueria", "the")

# Names of HTML entities, the common ones first as a map literal is searched in order.
_FIRST = ("amp;", "quot;", "lt;", "gt;", "nbsp;", "apos;", "copy;", "middot;", "ndash;", "mdash;", "rsquo;", "eacute;")
_NAMED = {name: html5[name] for name in (*_FIRST, *sorted(n for n in html5 if n.endswith(";")))}
_ENTITY = r"^(#[0-9]{1,7};|#[xX][0-9A-Fa-f]{1,6};|[A-Za-z][A-Za-z0-9]*;)"


def let(value: Column, body) -> Column:
    """Evaluate a value once and use it several times, also inside inner lambdas."""
    return F.element_at(F.transform(F.array(value), body), 1)


def first(items: Column, limit: int | None) -> Column:
    """The first elements of an array; all without a limit."""
    return items if limit is None else F.slice(items, 1, limit)


def strip(text: Column) -> Column:
    """Drop leading and trailing whitespace of any kind."""
    return F.regexp_replace(text, _EDGE_SPACE, "")


def collapse(text: Column) -> Column:
    """One space per whitespace run, none at the edges."""
    return F.trim(F.regexp_replace(text, _ODD_SPACE, " "))


def drop_control(text: Column) -> Column:
    """Remove control characters, fold blanks and tabs, keep line breaks."""
    bare = F.regexp_replace(text, r"[\x00-\x08\x0b-\x1f\x7f]", "")
    return strip(F.regexp_replace(bare, r"[ \t]+", " "))


def present(text: Column) -> Column:
    """NULL for an empty string."""
    return F.nullif(text, F.lit(""))


def or_default(text: Column, default: str) -> Column:
    return F.coalesce(present(text), F.lit(default))


def first_present(*candidates: Column) -> Column:
    """First candidate that is neither NULL nor empty; the argument order is the priority."""
    return F.coalesce(*[present(c) for c in candidates])


def first_text(*candidates: Column) -> Column:
    """First candidate with a non-blank text, stripped; an empty string when there is none."""
    return F.coalesce(*[present(strip(c)) for c in candidates], F.lit(""))


def join_present(separator: str, *parts: Column) -> Column:
    """Join the parts that hold text."""
    return F.concat_ws(separator, *[present(p) for p in parts])


def split_tokens(text: Column, separator: str = ";") -> Column:
    """Lower-case, stripped, non-empty tokens of a delimited value; an empty array for NULL."""
    tokens = F.transform(F.split(text, F.lit(separator)), lambda t: F.lower(strip(t)))
    return F.coalesce(F.filter(tokens, lambda t: t != ""), F.array().cast("array<string>"))


def title_case(text: Column) -> Column:
    """Capital after every non-letter, lower case elsewhere."""
    words = F.split(F.lower(text), r"(?<=[^\p{L}])")
    return F.array_join(
        F.transform(words, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substring(w, 2, 1 << 30))), ""
    )


def display_label(text: Column) -> Column:
    return title_case(F.regexp_replace(strip(text), "_", " "))


def name_tokens(text: Column, stopwords: Sequence[str] = NAME_STOPWORDS, min_length: int = 3) -> Column:
    """Distinct alphanumeric tokens long enough to identify a place."""
    words = F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit("[a-z0-9]+"), F.lit(0)))
    stop = F.array(*[F.lit(w) for w in stopwords]) if stopwords else F.array().cast("array<string>")
    return F.filter(words, lambda w: (F.length(w) >= min_length) & ~F.array_contains(stop, w))


def slug(text: Column, max_length: int | None = None, fallback: Column | str = "") -> Column:
    """Lower-case ASCII slug; an empty one is replaced by the fallback."""
    made = F.regexp_replace(F.regexp_replace(F.lower(text), "[^a-z0-9]+", "-"), "^-+|-+$", "")
    if max_length is not None:
        made = F.substring(made, 1, max_length)
    return F.coalesce(present(made), F.lit(fallback) if isinstance(fallback, str) else fallback)


def model_slug(model: Column) -> Column:
    """File-name form of a model id; a slash becomes a double underscore."""
    return F.regexp_replace(
        F.regexp_replace(F.replace(model, F.lit("/"), F.lit("__")), "[^A-Za-z0-9._-]+", "-"), "^-+|-+$", ""
    )


def unescape(text: Column) -> Column:
    """Decode every named and numeric HTML entity once, without leaving the JVM.

    A name needs its semicolon; a name or number that means no character stays as it is.
    """
    named = F.str_to_map(F.lit("\x01".join(f"{k}\x02{v}" for k, v in _NAMED.items())), F.lit("\x01"), F.lit("\x02"))

    def character(code: Column) -> Column:
        valid = ((code > 0) & (code < 0xD800)) | ((code > 0xDFFF) & (code <= 0x10FFFF))
        # The bytes of a UTF-32 code unit; an invalid code takes a valid one's place, unused.
        safe = F.lpad(F.hex(F.when(valid, code).otherwise(F.lit(32))), 8, "0")
        return F.when(valid, F.decode(F.unhex(safe), "UTF-32"))

    def decoded(part: Column) -> Column:
        entity = F.regexp_extract(part, _ENTITY, 1)
        digits = F.regexp_extract(entity, "[0-9A-Fa-f]+", 0)
        number = F.when(F.rlike(entity, F.lit("^#[xX]")), F.conv(digits, 16, 10)).otherwise(digits)
        plain = F.when(entity.startswith("#"), character(number.try_cast("bigint"))).otherwise(named[entity])
        return F.when((entity != "") & plain.isNotNull(), F.concat(plain, F.substr(part, F.length(entity) + 1))).otherwise(
            F.concat(F.lit("&"), part)
        )

    def whole(t: Column) -> Column:
        parts = lambda p: F.concat(F.element_at(p, 1), F.array_join(F.transform(F.slice(p, 2, 1 << 30), decoded), ""))
        return F.when(F.contains(t, F.lit("&")), let(F.split(t, "&"), parts)).otherwise(t)

    return let(text, whole)


def _squash(text: Column, keep: str) -> Column:
    return F.regexp_replace(F.regexp_replace(text, f"[^{keep}]+", ""), " +", " ")


def dish_key(
    name: Column,
    keep: str = "a-z0-9/ ",
    rewrites: Mapping[str, str] | None = None,
    aliases: Mapping[str, str] | None = None,
) -> Column:
    """Comparison key of a dish name: lower case, '&' as 'and', allowed characters only.

    rewrites are substring replacements, aliases replace a whole key.
    """
    key = _squash(F.replace(F.lower(strip(name)), F.lit("&"), F.lit("and")), keep)
    for old, new in (rewrites or {}).items():
        key = F.replace(key, F.lit(old), F.lit(new))
    return alias(key, aliases or {})


def alias(key: Column, aliases: Mapping[str, str]) -> Column:
    """Map whole keys through a small literal table."""
    if not aliases:
        return key
    pairs = [part for pair in aliases.items() for part in map(F.lit, pair)]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), key), key)


def category_key(category: Column, aliases: Mapping[str, str] | None = None) -> Column:
    return alias(_squash(F.lower(strip(category)), "a-z0-9 "), aliases or {})


def text_key(value: Column) -> Column:
    return _squash(F.lower(strip(value)), "a-z0-9, ")


# Spellings that the menu comparisons treat as one dish or category.
NAME_REWRITES = {"enchiladas/enchiladas suizas": "enchiladas"}
SPLIT_NAME_REWRITES = {"enchilada/enchilada suizas": "enchilada", "2 burritos": "burritos"}
SPLIT_NAME_ALIASES = {
    "beans refried or charro": "beans",
    "refried or charro beans": "beans",
    "rice spanish or cilantro lime": "rice",
    "spanish or cilantro lime rice": "rice",
}
CATEGORY_ALIASES = {"family packs": "family pack", "family meals": "family pack"}
SIDE_DISHES = ("refried beans", "papas", "spanish rice", "cilantro lime rice", "charro beans")


def basic_dish_key(name: Column) -> Column:
    return dish_key(name, rewrites=NAME_REWRITES)


def split_dish_key(name: Column) -> Column:
    """Key for outputs that may split one printed row into several dishes."""
    return dish_key(name, keep="a-z0-9/() ", rewrites=SPLIT_NAME_REWRITES, aliases=SPLIT_NAME_ALIASES)


def side_aware_category(name_key: Column, category: Column) -> Column:
    """Known side dishes always belong to the category 'sides'."""
    return F.when(name_key.isin(*SIDE_DISHES), F.lit("sides")).otherwise(category_key(category))


def first_number(value: Column) -> Column:
    """First digit run, else the stripped text."""
    return F.coalesce(present(F.regexp_extract(value, r"\d+", 0)), strip(value))


def side_choice_key(value: Column) -> Column:
    """Sorted distinct choices of a free-text list."""
    parts = F.transform(
        F.split(F.lower(value), r"[,;/]|\band\b"), lambda p: strip(F.regexp_replace(p, "[^a-z0-9 ]+", ""))
    )
    parts = F.transform(parts, lambda p: F.regexp_replace(p, " +", " "))
    return F.array_join(F.array_sort(F.array_distinct(F.filter(parts, lambda p: p != ""))), ", ")


def message_text(content: Column, parts: Column) -> Column:
    """Text of a message whose content is a plain string or a list of text parts."""
    joined = F.array_join(F.filter(F.transform(parts, lambda p: p["text"]), lambda t: t != ""), "\n\n")
    return strip(F.coalesce(joined, content, F.lit("")))


def json_preview(document: Column, limit: int) -> Column:
    """Whitespace-collapsed JSON cut to a display length."""
    return F.substring(F.regexp_replace(F.to_json(document), _ODD_SPACE, " "), 1, limit)


def jsonish(text: Column) -> Column:
    """JSON part of a reply: code fence removed, else cut from the first '{' to the last '}'."""
    bare = strip(text)
    unfenced = F.when(
        bare.startswith("```"),
        F.regexp_replace(F.regexp_replace(bare, r"^```(?:json)?\s*", ""), r"\s*```$", ""),
    ).otherwise(bare)
    cut = present(F.regexp_extract(unfenced, r"(?s)\{.*\}", 0))
    return F.when(unfenced.startswith("{"), unfenced).otherwise(F.coalesce(cut, unfenced))
