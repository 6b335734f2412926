"""Prices and selection rules. Amounts are DECIMAL, so no binary rounding case can arise."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from dishframe.functions.text import collapse, present, strip

MONEY = "decimal(12,2)"
_DOLLARS = r"\$([\d,]+\.\d{2})"
_AMOUNT = r"\$?\s*(\d+(?:\.\d{1,2})?)"


def _to_money(digits: Column) -> Column:
    return _number(F.replace(digits, F.lit(","), F.lit("")), MONEY)


def _number(digits: Column, kind: str) -> Column:
    """Cast of matched digits; no match stays NULL, as a failing cast of '' costs an exception per row."""
    return present(digits).try_cast(kind)


def price_value(text: Column) -> Column:
    """First dollar amount of a price text, NULL when there is none."""
    return _to_money(F.regexp_extract(text, _DOLLARS, 1))


def price_values(text: Column) -> Column:
    return F.transform(F.regexp_extract_all(text, F.lit(_DOLLARS), F.lit(1)), _to_money)


def price_range(text: Column) -> Column:
    """Struct (low, high); high is NULL unless the text names at least two amounts."""
    values = price_values(text)
    return F.struct(
        F.array_min(values).alias("low"),
        F.when(F.size(values) > 1, F.array_max(values)).alias("high"),
    )


def dollars(amount: Column) -> Column:
    """'$x.xx' text of a DECIMAL amount."""
    return F.concat(F.lit("$"), amount.cast(MONEY).cast("string"))


def normalize_price(text: Column) -> Column:
    """First number as '$x.xx', else the stripped text."""
    bare = strip(text)
    amount = _number(F.regexp_extract(bare, _AMOUNT, 1), MONEY)
    return F.coalesce(dollars(amount), bare)


def has_valid_price(text: Column) -> Column:
    return strip(text).rlike(_AMOUNT)


def is_invalid_price(text: Column) -> Column:
    """No number at all, or a zero price."""
    return ~has_valid_price(text) | (normalize_price(text) == "$0.00")


def looks_like_price(text: Column) -> Column:
    bare = collapse(text)
    return (bare != "") & F.contains(bare, F.lit("$")) & (F.length(bare) <= 80)


def tidy_price(text: Column) -> Column:
    return F.replace(collapse(text), F.lit("$ "), F.lit("$"))


def cents(amount: Column) -> Column:
    """Dollars from integer cents; anything else counts as zero."""
    return (F.coalesce(amount.try_cast("bigint"), F.lit(0)) / F.lit(100).cast("decimal(3,0)")).cast(MONEY)


def card_price(text: Column) -> Column:
    """Price span of a card: dollars with cents and an optional plus sign."""
    return present(F.regexp_extract(text, r"\$[\d,]+\.\d{2}\+?", 0))


def price_slot(top: Column, bottom: Column, prefer: str = "top") -> Column:
    """Choose between the two price slots of a printed item."""
    first, second = (top, bottom) if prefer == "top" else (bottom, top)
    return F.coalesce(present(first), present(second), F.lit(""))


def required_count(rule: Column) -> Column:
    """How many options a rule text demands; NULL for an optional or unknown rule."""
    text = F.lower(rule)
    number = _number(F.regexp_extract(text, r"\d+", 0), "int")
    return (
        F.when(F.contains(text, F.lit("optional")), F.lit(None).cast("int"))
        .when(number.isNotNull(), number)
        .when(F.contains(text, F.lit("required")), F.lit(1))
    )


def pick_rule(rule: Column) -> Column:
    """Struct (required, min_pick, max_pick) of 'must pick N', 'must pick A - B', 'pick up to N'."""
    text = F.lower(strip(rule))
    numbers = F.transform(F.regexp_extract_all(text, F.lit(r"\d+"), F.lit(0)), lambda n: n.try_cast("int"))
    must = F.coalesce(text.startswith("must pick"), F.lit(False))
    first = F.get(numbers, F.lit(0))
    capped = F.contains(text, F.lit("up to"))
    return F.struct(
        must.alias("required"),
        F.when(must, F.coalesce(first, F.lit(1))).alias("min_pick"),
        F.when(must, F.coalesce(F.get(numbers, F.lit(1)), first, F.lit(1)))
        .when(capped, first)
        .alias("max_pick"),
    )


def required_pick(rule: Column) -> Column:
    """min_pick of a 'must pick' rule, NULL when the rule does not bind."""
    parsed = pick_rule(rule)
    return F.when(parsed["required"], parsed["min_pick"])


def is_sold_out(card_text: Column) -> Column:
    """Keyword search over everything printed on a card."""
    return F.coalesce(card_text.rlike("(?i)sold out|unavailable|86'd|out of stock"), F.lit(False))


def price_unless_sold_out(price: Column, sold_out: Column) -> Column:
    return F.when(~sold_out, price)


def popularity(card_text: Column) -> Column:
    """Struct (featured_rank, like_percent, like_review_count, is_popular) read from a card's lines."""
    rank = _number(F.regexp_extract(card_text, r"(?m)^#(\d+) most liked$", 1), "int")
    percent = _number(F.regexp_extract(card_text, r"(\d+)%\s*\((\d+)\)", 1), "int")
    votes = _number(F.regexp_extract(card_text, r"(\d+)%\s*\((\d+)\)", 2), "int")
    return F.struct(
        rank.alias("featured_rank"),
        percent.alias("like_percent"),
        votes.alias("like_review_count"),
        F.coalesce(card_text.rlike(r"(?m)^Popular$"), F.lit(False)).alias("is_popular"),
    )
