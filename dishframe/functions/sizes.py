"""Menu codes and size words in dish titles."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

from dishframe.functions.text import present, strip

# Size words in menu order.
SIZE_TOKENS = (
    "Junior", "Jr", "Personal", "Mini", "Kids",
    "Small", "Sm", "Medium", "Med", "Regular",
    "Large", "Lg", "X-Large", "XLarge", "Extra Large", "XL",
    "Jumbo", "Family", "Party Tray",
)
UNKNOWN_SIZE_RANK = 99

# Accepted menu-code shapes; a bare number needs a space after its mark.
MENU_CODE = (
    r"(?i)^(?:(NO\.?\s*\d{1,3}[a-z]?)[.)]\s*"
    r"|([A-Za-z]{1,2}\d{1,3}[a-z]?)[.)]\s*"
    r"|(\d{1,3})[.)]\s+)"
)
INCHES = r'(?i)^(\d{1,2})\s*(?:"|-?inch\b)'
VARIANT_GROUP = r"(?i)^choose an option\s*[-–]\s*"


def split_menu_code(title: Column) -> Column:
    """Struct (menu_code, title, original_title); code and original are NULL when nothing was split."""
    text = strip(title)
    code = F.coalesce(*[present(F.regexp_extract(text, MENU_CODE, group)) for group in (1, 2, 3)])
    rest = strip(F.regexp_replace(text, MENU_CODE, ""))
    found = code.isNotNull() & (rest != "")
    return F.struct(
        F.when(found, code).alias("menu_code"),
        F.when(found, rest).otherwise(text).alias("title"),
        F.when(found, text).alias("original_title"),
    )


_LONGEST_FIRST = sorted(SIZE_TOKENS, key=len, reverse=True)
_ANY_SIZE = "|".join(re.escape(t) for t in _LONGEST_FIRST)
# A size in front must leave a rest; one at the back must follow a name. The lazy head makes
# the longest size word win at the back, the order of alternatives does so in front.
_FRONT = rf"(?i)^({_ANY_SIZE})\b[\s-]*(?=[^\s-])"
_BACK = rf"(?is)^(.*?[^\s(-])[\s(-]*\b({_ANY_SIZE})\)?$"


def split_size(title: Column) -> Column:
    """Struct (size, residual); size is NULL when the title names none.

    Leading inches win, then the longest size word, at the front before the back.
    """
    text = strip(title)
    words = F.create_map(*[F.lit(part) for t in _LONGEST_FIRST for part in (t.lower(), t)])
    ranks = F.create_map(*[part for i, t in enumerate(_LONGEST_FIRST) for part in (F.lit(t.lower()), F.lit(i))])
    inches = F.regexp_extract(text, INCHES, 1)
    front = F.lower(F.regexp_extract(text, _FRONT, 1))
    back = F.lower(F.regexp_extract(text, _BACK, 2))
    rank = lambda word: F.coalesce(F.try_element_at(ranks, word), F.lit(len(_LONGEST_FIRST)))
    pair = lambda size, residual: F.struct(size.alias("size"), residual.alias("residual"))
    return (
        F.when(
            inches != "",
            pair(
                F.concat(inches, F.lit('"')),
                F.regexp_replace(F.regexp_replace(text, INCHES, ""), "^[ –-]+|[ –-]+$", ""),
            ),
        )
        .when(
            (front != "") & (rank(front) <= rank(back)),
            pair(F.try_element_at(words, front), strip(F.regexp_replace(text, _FRONT, ""))),
        )
        .when(back != "", pair(F.try_element_at(words, back), strip(F.regexp_extract(text, _BACK, 1))))
        .otherwise(pair(F.lit(None).cast("string"), text))
    )


def size_order(size: Column) -> Column:
    """Sortable struct: inches ascending, then the vocabulary rank, then the text."""
    inches = present(F.regexp_extract(size, r'^(\d+)"$', 1)).try_cast("int")
    ranks = F.create_map(*[p for i, t in enumerate(SIZE_TOKENS) for p in (F.lit(t.lower()), F.lit(i))])
    rank = F.coalesce(F.try_element_at(ranks, F.lower(size)), F.lit(UNKNOWN_SIZE_RANK))
    return F.struct(
        F.when(inches.isNotNull(), 0).otherwise(1).alias("kind"),
        F.coalesce(inches, rank).alias("rank"),
        size.alias("size"),
    )


def is_variant_group(group: Column) -> Column:
    """A size picker in all but name: 'Choose an option - <dish>'."""
    return F.coalesce(group.rlike(VARIANT_GROUP), F.lit(False))


def rename_variant_group(group: Column) -> Column:
    return F.when(is_variant_group(group), F.lit("Size")).otherwise(group)
