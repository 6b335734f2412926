"""Ranked lexical search by dense blocked matrix products.

Documents are read once per group of items: each task counts the terms of its whole texts and keeps those
of the group's vocabulary, as numbers. Document frequencies are counted from that table. Then blocks
of documents, as dense tiles of term impacts, are multiplied (BLAS, float64) with tiles of the items'
weights. An item tile has a compact vocabulary of its own, cut into stretches so short that no partial
sum reaches 2^53: every product is exact, and the partial sums are added as 64-bit integers. Of each
tile, an item's rows that reach its k-th score so far are kept, ties included, and cut to k by score
and id; a task ends with at most k rows an item, which two window passes (part, then whole) rank.

Items go in groups of bounded size; a further group costs a further pass. What the driver and a task
hold is bounded by the group's distinct terms (or one item's, if it has more). Terms over 64 bytes are
named by their digest, so one term's length does not count.

Defined cases: null and empty texts have no term; repeated rows rank each for themselves, and so do
repeated items; rows without an id come after equal scores with one; items without a known term, and
empty tables, give no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from dishframe.llm.common import text_bytes, written

#: Bytes that belong to no term become a space, A-Z become a-z.
_OUTSIDE = [*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]
_FOLD = bytes(32 if b in _OUTSIDE else b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
LONG_TERM = 64
EXACT = 1 << 53
IMPACT = 1_000_000_000
NO_ID = (1 << 63) - 1


def terms(data: bytes) -> list[bytes]:
    """The terms of a text, with repeats."""
    return data.translate(_FOLD).split()


def named(term: bytes) -> bytes:
    """The term itself, or its digest behind a byte that no term holds."""
    return term if len(term) <= LONG_TERM else b"/" + hashlib.sha256(term).digest()


def item_terms(items: DataFrame) -> DataFrame:
    """item_id, a number of the row, and the distinct terms of every item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted({named(t) for t in terms(data)}) for data in batch.column("data").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("at"), batch.column("item_id"), pa.array(found, pa.list_(pa.binary()))], ["at", "item_id", "terms"]
            )

    kind = items.schema["item_id"].dataType.simpleString()
    rows = items.select(F.monotonically_increasing_id().alias("at"), "item_id", text_bytes(F.col("text")).alias("data"))
    return rows.mapInArrow(run, f"at long, item_id {kind}, terms array<binary>")


def hits(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """doc_id, n (all terms with repeats) and the numbers and counts of the vocabulary's terms, per document with a term."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    has_long = any(t[:1] == b"/" for t in vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        names = known.keys()
        for batch in batches:
            ids, sizes, numbers, counts, ends = [], [], [], [], [0]
            for doc_id, data in zip(batch.column("doc_id").to_pylist(), batch.column("data").to_pylist()):
                found = terms(data)
                if not found:
                    continue
                tf = Counter(found)
                if has_long:
                    tf = {named(t): c for t, c in tf.items()}
                both = tf.keys() & names
                ids.append(doc_id)
                sizes.append(len(found))
                numbers.extend([known[t] for t in both])
                counts.extend([tf[t] for t in both])
                ends.append(len(numbers))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()),
                    pa.array(sizes, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(numbers, pa.int32())),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(counts, pa.int64())),
                ],
                ["doc_id", "n", "numbers", "counts"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes(F.col("text")).alias("data"))
    return rows.mapInArrow(run, "doc_id long, n long, numbers array<int>, counts array<long>")


class Tile:
    """Items of one tile: their weights over a compact vocabulary, in stretches of it."""

    def __init__(self, at: list[int], rows: list[np.ndarray], weights: np.ndarray, stretch: int) -> None:
        self.at = np.array(at, np.int64)
        self.vocabulary = np.unique(np.concatenate(rows))
        heaviest = int(weights[self.vocabulary].max())
        # A partial sum over one stretch is below 2^53: impacts are below a million.
        stretch = max(1, min(stretch, (EXACT - 1) // max(1, heaviest * (IMPACT // 1000))))
        self.starts = range(0, len(self.vocabulary), stretch)
        self.stretch = stretch
        full = np.zeros((len(self.vocabulary), len(rows)))
        for item, row in enumerate(rows):
            full[np.searchsorted(self.vocabulary, row), item] = weights[row]
        self.weights = [full[s : s + stretch] for s in self.starts]

    def scores(self, n_docs: int, doc: np.ndarray, number: np.ndarray, impact: np.ndarray) -> np.ndarray:
        """Documents by items, as 64-bit integers."""
        place = np.searchsorted(self.vocabulary, number)
        place[place == len(self.vocabulary)] = 0
        here = self.vocabulary[place] == number
        doc, place, impact = doc[here], place[here], impact[here]
        total = np.zeros((n_docs, len(self.at)), np.int64)
        for start, weights in zip(self.starts, self.weights):
            within = (place >= start) & (place < start + len(weights)) if len(self.weights) > 1 else slice(None)
            block = np.zeros((n_docs, len(weights)))
            block[doc[within], place[within] - start] = impact[within]
            total += (block @ weights).astype(np.int64)
        return total


class Best:
    """The k best documents of each item so far; of equal scores the smaller ids, rows without an id last."""

    def __init__(self, n_items: int, k: int) -> None:
        self.k, self.least = k, np.ones(n_items, np.int64)
        self.rows = [np.zeros(0, np.int64) for _ in range(4)]  # item, score, no id, doc_id
        self.limit = 4 * n_items * k

    def add(self, scores: np.ndarray, ids: np.ndarray, no_id: np.ndarray) -> None:
        doc, item = np.nonzero(scores >= self.least)
        new = (item, scores[doc, item], no_id[doc], ids[doc])
        self.rows = [np.concatenate(pair) for pair in zip(self.rows, new)]
        if len(self.rows[0]) > self.limit:
            self.cut()

    def cut(self) -> None:
        item, score, none, doc_id = self.rows
        order = np.lexsort((doc_id, none, -score, item))
        item = item[order]
        rank = np.arange(len(item)) - np.searchsorted(item, item)
        chosen = order[rank < self.k]
        self.rows = [c[chosen] for c in self.rows]
        full = rank == self.k - 1
        self.least[item[full]] = score[order[full]]


def best_of_tasks(found: DataFrame, tiles: list[Tile], n: int, total: int, k: int, block: int) -> DataFrame:
    """At most k rows (at, doc_id, score) an item and task; n documents with `total` terms in all."""
    shared = found.sparkSession.sparkContext.broadcast(tiles)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(len(t.at), k) for t in shared.value]
        for batch in (b.slice(at, block) for b in batches for at in range(0, b.num_rows, block)):
            numbers, counts = batch.column("numbers"), batch.column("counts")
            sizes = batch.column("n").to_numpy()
            m = 50 + 50 * sizes * n // total
            doc = np.repeat(np.arange(batch.num_rows), np.diff(numbers.offsets.to_numpy()))
            tf = counts.flatten().to_numpy()
            impact = IMPACT * tf // (1000 * tf + 20 * m[doc])
            ids = batch.column("doc_id")
            no_id, number = ids.is_null().to_numpy(zero_copy_only=False).astype(np.int64), numbers.flatten().to_numpy()
            ids = ids.fill_null(NO_ID).to_numpy()
            for tile, kept in zip(shared.value, best):
                kept.add(tile.scores(batch.num_rows, doc, number, impact), ids, no_id)
        for tile, kept in zip(shared.value, best):
            kept.cut()
            item, score, none, doc_id = kept.rows
            yield pa.RecordBatch.from_arrays(
                [pa.array(tile.at[item]), pa.array(doc_id, mask=none.astype(bool)), pa.array(score)], ["at", "doc_id", "score"]
            )

    return found.select("doc_id", "n", "numbers", "counts").mapInArrow(run, "at long, doc_id long, score long")


def _ranked(rows: DataFrame, k: int) -> DataFrame:
    """The k best per item: first of each slice of an item's rows, then of the slices' best."""
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    piece = F.pmod(F.xxhash64("doc_id"), F.lit(64))
    first = rows.withColumn("piece", piece).withColumn("rank", F.row_number().over(Window.partitionBy("at", "piece").orderBy(*order))).filter(F.col("rank") <= k)
    return first.withColumn("rank", F.row_number().over(Window.partitionBy("at").orderBy(*order))).filter(F.col("rank") <= k).drop("piece")


def _group(docs: DataFrame, members: list, k: int, tile_items: int, stretch: int, block: int) -> DataFrame | None:
    vocabulary = {t: i for i, t in enumerate(sorted({t for r in members for t in r.terms}))}
    found = written(hits(docs, vocabulary))
    n, total = found.agg(F.count(F.lit(1)), F.sum("n")).first()
    if not n or not vocabulary:
        return None
    df = {r.number: r["count"] for r in found.select(F.explode("numbers").alias("number")).groupBy("number").count().collect()}
    # Python's logarithm is the C library's.
    weights = np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * df.get(i, 0) + 1))) for i in range(len(vocabulary))], np.int64)
    tiles = []
    for start in range(0, len(members), tile_items):
        part = members[start : start + tile_items]
        tiles.append(Tile([r["at"] for r in part], [np.array([vocabulary[t] for t in r.terms], np.int64) for r in part], weights, stretch))
    return _ranked(best_of_tasks(found, tiles, n, total, k, block), k)


def search(
    docs: DataFrame, items: DataFrame, k: int = 50, group_terms: int = 1 << 19, tile_items: int = 256, stretch: int = 4096, block: int = 512
) -> DataFrame:
    """item_id, rank, doc_id, score: the k best documents of every item."""
    spark = docs.sparkSession
    listed = written(item_terms(items).filter(F.size("terms") > 0))
    pairs = listed.agg(F.sum(F.size("terms"))).first()[0] or 0
    groups = max(1, -(-pairs // group_terms))
    of_group = F.pmod(F.xxhash64("at"), F.lit(groups))
    out = []
    for g in range(groups):
        members = listed.filter(of_group == g).orderBy("at").collect()
        if members and (ranked := _group(docs, members, k, tile_items, stretch, block)) is not None:
            out.append(ranked)
    schema = f"item_id {items.schema['item_id'].dataType.simpleString()}, rank int, doc_id long, score long"
    if not out:
        return spark.createDataFrame([], schema)
    ranked = reduce(DataFrame.unionByName, out)
    return ranked.join(listed.select("at", "item_id"), "at").select("item_id", "rank", "doc_id", "score")
