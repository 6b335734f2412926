"""Saved pages: visible lines, headings, links and script blocks as array columns.

A page is one row, so none of these needs a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from dishframe.functions.text import collapse, first, present, unescape

_HIDDEN = r"(?is)<(script|style|noscript|svg)\b[^>]*>.*?</\1\s*>"
_COMMENT = r"(?s)<!--.*?-->"
_TAG = r"(?s)<[^>]*>"
# An attribute's value in double, single or no quotes.
_VALUE = r"""(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
_TARGET = r"(?is)<(?:a\b[^>]*?(?<![\w-])href|form\b[^>]*?(?<![\w-])action)\s*=\s*"


def _value_of(text: Column, start: str) -> Column:
    """The value after the first match of `start`."""
    return F.concat(*[F.regexp_extract(text, start + _VALUE, group) for group in (1, 2, 3)])


def plain(html: Column, gap: str) -> Column:
    """Text of a fragment with every tag replaced by a gap."""
    return unescape(F.regexp_replace(F.regexp_replace(html, _COMMENT, ""), _TAG, gap))


def visible_lines(html: Column) -> Column:
    """Non-empty visible text lines in document order; line i is element i of the array."""
    shown = plain(F.regexp_replace(F.regexp_replace(html, _COMMENT, ""), _HIDDEN, "\n"), "\n")
    lines = F.transform(F.split(shown, r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]"), collapse)
    return F.filter(lines, lambda line: line != "")


def inner_text(html: Column, element: str) -> Column:
    """Text of the first such element, '' when absent."""
    return collapse(plain(F.regexp_extract(html, rf"(?is)<{element}\b[^>]*>(.*?)</{element}\s*>", 1), " "))


def title(html: Column) -> Column:
    return inner_text(html, "title")


def meta_description(html: Column) -> Column:
    tag = F.regexp_extract(html, r'(?is)<meta\b[^>]*\bname\s*=\s*["\']description["\'][^>]*>', 0)
    return unescape(attribute(tag, "content"))


def headings(html: Column, limit: int | None = None) -> Column:
    """Texts of the h1 to h3 elements; with a limit, of the first."""
    raw = F.regexp_extract_all(html, F.lit(r"(?is)<h[1-3]\b[^>]*>(.*?)</h[1-3]\s*>"), F.lit(1))
    texts = F.filter(F.transform(raw, lambda h: collapse(plain(h, " "))), lambda t: t != "")
    return first(texts, limit)


def links(html: Column) -> Column:
    """Targets of anchors and forms in document order."""
    tags = F.regexp_extract_all(html, F.lit(_TARGET + _VALUE), F.lit(0))
    return F.filter(F.transform(tags, lambda t: unescape(_value_of(t, _TARGET))), lambda u: u != "")


def scripts(html: Column) -> Column:
    """Array of (attributes, body) of the non-empty script elements."""
    whole = F.regexp_extract_all(html, F.lit(r"(?is)<script\b[^>]*>.*?</script\s*>"), F.lit(0))
    parts = F.transform(
        whole,
        lambda s: F.struct(
            F.regexp_extract(s, r"(?is)^<script\b([^>]*)>", 1).alias("attributes"),
            F.trim(F.regexp_extract(s, r"(?is)^<script\b[^>]*>(.*)</script\s*>$", 1)).alias("body"),
        ),
    )
    return F.filter(parts, lambda s: s["body"] != "")


def attribute(attributes: Column, name: str) -> Column:
    """Value of an attribute, '' when absent."""
    return _value_of(attributes, rf"(?is)(?<![\w-]){name}\s*=\s*")


def json_or_null(body: Column) -> Column:
    """Body if it is valid JSON, else its entity-decoded form if that is, else NULL."""
    decoded = unescape(body)
    valid = lambda text: F.when(F.try_parse_json(text).isNotNull(), text)
    return F.coalesce(valid(present(body)), valid(present(decoded)))
