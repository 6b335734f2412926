"""Objects inside arbitrary JSON documents, one document per row.

Depth and keys are unknown, so a small walk runs per document inside Arrow batches; Spark
partitions the documents. The caller's test runs inside the walk: an object that is not wanted is
neither serialised nor given a path. (A walk by `variant_explode` was measured too: 9 to 28 s for 60,000
small documents in one task.)
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

# Keys that make an object a menu item, in the order they are tried.
NAME_KEYS = ("name", "title", "displayName")
DESCRIPTION_KEYS = ("description", "itemDescription", "subtitle")
PRICE_KEYS = ("price", "displayPrice", "unitAmount", "basePrice", "finalPrice")

# Names that label a container, not a dish.
CONTAINER_NAMES = ("menu", "doordash", "popular items", "reviews", "featured items", "restaurant info")


ROWS_PER_BATCH = 20_000


def objects(root: object, graph_only: bool = False) -> Iterator[tuple[int, tuple | None, dict]]:
    """(number, trail, object) in document order, with an explicit stack instead of recursion.

    A trail is (trail of the parent, key or place); path_of spells it.
    """
    n, stack = 0, [(None, root)]
    while stack:
        trail, node = stack.pop()
        if isinstance(node, dict):
            yield n, trail, node
            n += 1
            if graph_only:
                children = [((trail, "@graph"), node["@graph"])] if isinstance(node.get("@graph"), list) else []
            else:
                children = [((trail, k), v) for k, v in node.items() if isinstance(v, (dict, list))]
        elif isinstance(node, list):
            children = [((trail, i), v) for i, v in enumerate(node) if isinstance(v, (dict, list))]
        else:
            continue
        if children:
            children.reverse()
            stack += children


def path_of(trail: tuple | None) -> str:
    labels = []
    while trail is not None:
        trail, label = trail
        labels.append(f"[{label}]" if isinstance(label, int) else f".{label}")
    return "".join(reversed(labels)).removeprefix(".")


def _expand(documents: DataFrame, keys: Sequence[str], document: str, fields: str, rows_of: Callable) -> DataFrame:
    """(keys, fields) rows of every parsable document; broken and missing documents give none."""
    types = {"int": pa.int32(), "string": pa.string()}
    names, kinds = zip(*(field.split() for field in fields.split(", ")))

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of, out = [], []
            for i, text in enumerate(batch.column(len(keys)).to_pylist()):
                try:
                    root = json.loads(text)
                except (TypeError, ValueError):
                    continue
                for row in rows_of(root):
                    of.append(i)
                    out.append(row)
                if len(out) >= ROWS_PER_BATCH:
                    yield rows(batch, of, out)
                    of, out = [], []
            if out:
                yield rows(batch, of, out)

    def rows(batch: pa.RecordBatch, of: list[int], out: list[tuple]) -> pa.RecordBatch:
        own = [batch.column(k).take(pa.array(of, pa.int64())) for k in range(len(keys))]
        return pa.RecordBatch.from_arrays([*own, *(pa.array(c, types[kind]) for c, kind in zip(zip(*out), kinds))], [*keys, *names])

    declared = [f"`{k}` {documents.schema[k].dataType.simpleString()}" for k in keys]
    return documents.select(*keys, document).mapInArrow(expand, ", ".join([*declared, fields]))


Keep = Callable[[dict], bool]


# One encoder for all values: json.dumps builds a new one for each.
_encode = json.JSONEncoder(ensure_ascii=False, sort_keys=True).encode


def _json(value: object) -> str:
    return str(value) if type(value) is int else _encode(value)


def json_objects(documents: DataFrame, key: str, document: str, graph_only: bool = False, keep: Keep = lambda node: True) -> DataFrame:
    """(key, n, path, object) for every JSON object that keep admits; n numbers all objects of the document.

    `graph_only` descends through '@graph' lists alone.
    """

    def rows_of(root: object) -> Iterator[tuple]:
        for n, trail, node in objects(root, graph_only):
            if keep(node):
                yield n, path_of(trail), _json(node)

    return _expand(documents, [key], document, "n int, path string, object string", rows_of)


def review_like(documents: DataFrame, keys: Sequence[str], document: str, pattern: str, longest_review: int, longest_ratingish: int) -> DataFrame:
    """(keys, n, kind, context) of the objects with a 'review' member (kind review) and of those whose keys,
    or first 400 characters, match the pattern (kind ratingish), as JSON cut to a display length."""
    space, speaks = re.compile(r"\s+"), re.compile(pattern)

    def rows_of(root: object) -> Iterator[tuple]:
        for n, _, node in objects(root):
            shown = space.sub(" ", _json(node))
            if any(k.lower() == "review" for k in node):
                yield n, "review", shown[:longest_review]
            if speaks.search(" ".join(node)) or speaks.search(shown[:400]):
                yield n, "ratingish", shown[:longest_ratingish]

    return _expand(documents, keys, document, "n int, kind string, context string", rows_of)


def _texts(row: dict, keys: Sequence[str]) -> str:
    for k in keys:
        value = row.get(k)
        if isinstance(value, str) and (text := value.strip()):
            return text
    return ""


_ITEM_KEYS = frozenset((*DESCRIPTION_KEYS, *PRICE_KEYS))


def _item(node: dict) -> tuple | None:
    """(name, description, price as JSON) of an object that looks like a menu item."""
    if _ITEM_KEYS.isdisjoint(node):
        return None
    name = _texts(node, NAME_KEYS)
    if not name or name.lower() in CONTAINER_NAMES:
        return None
    shown = None
    for k in PRICE_KEYS:
        price = node.get(k)
        if price is not None and price != "":
            shown = _json(price)
            break
    return name, _texts(node, DESCRIPTION_KEYS), shown


def json_items(documents: DataFrame, key: str | Sequence[str], document: str) -> DataFrame:
    """Menu items found anywhere in a document: a name with a description or a price.

    price is JSON text; containers such as 'Menu' are left out. The key may be several columns.
    """

    def rows_of(root: object) -> Iterator[tuple]:
        for n, trail, node in objects(root):
            item = _item(node)
            if item is not None:
                yield n, path_of(trail), *item

    fields = "n int, source_path string, name string, description string, price string"
    return _expand(documents, [key] if isinstance(key, str) else key, document, fields, rows_of)


def has_rating(node: dict) -> bool:
    return isinstance(node.get("aggregateRating"), dict)


def structured_ratings(objects: DataFrame, key: Sequence[str]) -> DataFrame:
    """Ratings of every object that carries an aggregateRating object."""
    rating = F.get_json_object("object", "$.aggregateRating")
    field = lambda name: F.get_json_object(rating, f"$.{name}")
    useful = lambda c: F.when(~c.isin("", "0", "0.0", "false"), c)
    return (
        objects.filter(F.coalesce(rating.startswith("{"), F.lit(False)))
        .select(
            *key,
            F.get_json_object("object", "$.name").alias("name"),
            field("ratingValue").alias("rating_value"),
            F.coalesce(useful(field("reviewCount")), field("ratingCount")).alias("review_count"),
            field("bestRating").alias("best_rating"),
        )
    )
