"""N-gram Jaccard join by a MinHash LSH forest with exact verification.

Documents are sets of hashed word shingles. Equal sets are one node (its least document id, with the
number of its copies), so copies are never compared. Each tree of the forest sorts the nodes by a
sequence of MinHash values, a prefix trie; nodes that share a prefix are candidates. The prefix starts
at full depth and is shortened value by value until the expected recall at the threshold reaches the
target. Candidates are gathered without pairs: every node is linked to the least node of its trie
node, and the components of these links are compared. A component is cut into blocks, and each pair of
blocks is one unit of work in which all pairs are verified exactly; only sums and spanning links
leave it, so no pair becomes a row and no component has to fit one task.

Result per row of docs: doc_id, class_id (the least id of its group of linked documents) and n_links
(other rows at or above the threshold, copies included).

Defined cases: words are cut at ASCII white space, A-Z lower-cased; a text of fewer words than a
shingle is one shingle; a null or empty text has no links and is a class of its own; rows without an
id have a null class and no links; repeated rows are copies of each other; an empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from dishframe.llm.common import text_bytes, worker_memory, written
from dishframe.llm.components import components

_P = np.uint64(0x9E3779B97F4A7C15)


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > 400_000:
            self.clear()
        self[word] = out = xxhash.xxh64_intdigest(word)
        return out


def shingles(data: bytes, known: WordHashes, size: int) -> np.ndarray:
    """Sorted distinct hashes of the text's word shingles."""
    tokens = data.lower().split()
    if not tokens:
        return np.zeros(0, np.uint64)
    one = np.array([known[w] for w in tokens], np.uint64)
    span = min(size, len(one))
    out = one[: len(one) - span + 1].copy()
    for k in range(1, span):
        out = out * _P + one[k : len(one) - span + 1 + k]
    out ^= out >> np.uint64(31)
    out *= np.uint64(0xD6E8FEB86659FD93)
    out ^= out >> np.uint64(29)
    return np.unique(out)


def prefix_depth(threshold: float, trees: int, full_depth: int, recall: float) -> int:
    """The longest prefix at which a pair just at the threshold is still met with the wanted probability."""
    depth = full_depth
    while depth > 1 and 1 - (1 - threshold**depth) ** trees < recall:
        depth -= 1
    return depth


def signatures(docs: DataFrame, trees: int, depth: int, size: int, seed: int) -> DataFrame:
    """doc_id, set_key (null for no words), prefixes: one hash of the prefix in each tree."""
    draw = np.random.default_rng(seed)
    factors = draw.integers(1, 1 << 63, trees * depth, np.uint64) * np.uint64(2) + np.uint64(1)
    shifts = draw.integers(0, 1 << 63, trees * depth, np.uint64)

    def of_chunk(sets: list[np.ndarray]) -> np.ndarray:
        starts = np.cumsum([0] + [len(s) for s in sets[:-1]])
        values, prefix = np.concatenate(sets), np.zeros((len(sets), trees), np.uint64)
        for k in range(trees * depth):
            mixed = values * factors[k] + shifts[k]
            least = np.minimum.reduceat(mixed, starts)
            tree = k // depth
            prefix[:, tree] = (prefix[:, tree] ^ least) * _P + np.uint64(k)
        return prefix.view(np.int64)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_memory("word hashes")  # what other work kept goes
        known = WordHashes()
        for batch in batches:
            ids, keys, prefixes, held, room = [], [], [], [], 0

            def flush() -> None:
                nonlocal held, room
                if held:
                    prefixes.extend(of_chunk(held))
                held, room = [], 0

            for doc_id, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = shingles(data, known, size)
                ids.append(doc_id)
                if not len(found):
                    flush()
                    keys.append(None)
                    prefixes.append(np.zeros(0, np.int64))
                    continue
                keys.append(xxhash.xxh128_digest(found.tobytes()))
                held.append(found)
                room += len(found)
                if room > 1 << 15:
                    flush()
            flush()
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(keys, pa.binary()), pa.array(prefixes, pa.list_(pa.int64()))], ["doc_id", "set_key", "prefixes"]
            )

    slim = docs.select("doc_id", text_bytes(F.col("text")).alias("data"))
    return slim.mapInArrow(rows, "doc_id long, set_key binary, prefixes array<long>")


def candidate_groups(nodes: DataFrame) -> DataFrame:
    """node, component: nodes linked by shared prefixes; nodes: node, prefixes."""
    placed = nodes.select("node", F.posexplode("prefixes").alias("tree", "prefix"))
    shared = placed.groupBy("tree", "prefix").agg(F.min("node").alias("least"), F.count("*").alias("n")).filter("n > 1").drop("n")
    links = placed.join(shared, ["tree", "prefix"]).filter("node != least").select("node", F.col("least").alias("other")).distinct()
    return components(links)


def linked_in_block(sets: list[np.ndarray], side: np.ndarray, copies: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """For the sets of one or two blocks: copies of the sets linked to each, and each one's least linked place.

    side tells the block (0 or 1); with two blocks only pairs across them count.
    """
    n, sizes = len(sets), np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(n), sizes)
    _, place, seen = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    renumbered = np.cumsum(seen > 1) - 1
    on = seen[place] > 1
    owner, place = owner[on], renumbered[place[on]]
    common, order = np.zeros((n, n), np.float32), np.argsort(place, kind="stable")
    owner, place = owner[order], place[order]
    width = max(256, min(8192, (1 << 22) // max(1, n)))
    for low in range(0, int(place[-1]) + 1 if len(place) else 0, width):
        a, b = np.searchsorted(place, [low, low + width])
        part = np.zeros((n, width), np.float32)
        part[owner[a:b], place[a:b] - low] = 1
        common += part @ part.T
    total = sizes[:, None] + sizes[None, :] - common
    linked = common >= threshold * total - 1e-6
    np.fill_diagonal(linked, False)
    if side.any() and not side.all():
        linked &= side[:, None] != side[None, :]
    root = np.arange(n)
    while True:  # least place among linked ones, until nothing changes
        reach = np.where(linked, root[None, :], n).min(axis=1, initial=n)
        lower = np.minimum(root, reach)
        lower = np.minimum(lower, lower[lower])
        if (lower == root).all():
            return linked @ copies, root
        root = lower


def verify(docs: DataFrame, groups: DataFrame, threshold: float, size: int, block: int) -> DataFrame:
    """node, linked (rows at or above the threshold in other nodes), root: one row per node and unit of work."""
    blocks = groups.groupBy("component").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    dealt = groups.join(blocks, "component").withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    texts = docs.select(F.col("doc_id").alias("node"), text_bytes(F.col("text")).alias("data"))

    def as_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_memory("word hashes")  # what other work kept goes
        known = WordHashes()
        for batch in batches:
            at = batch.schema.get_field_index("data")
            sets = [shingles(d, known, size).tobytes() for d in batch.column(at).to_pylist()]
            yield batch.set_column(at, "data", pa.array(sets, pa.binary()))

    held = dealt.join(texts, "node").dropDuplicates(["node"]).select("node", "copies", "component", "blocks", "own", "data")
    sets = held.mapInArrow(as_sets, "node long, copies long, component long, blocks int, own int, data binary")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    units = (
        sets.withColumn("other", other)
        .select(
            "component",
            F.least("own", "other").alias("first"),
            F.greatest("own", "other").alias("second"),
            (F.col("own") > F.col("other")).cast("int").alias("side"),
            "node",
            "copies",
            "data",
        )
        .repartition("component", "first", "second")
        .sortWithinPartitions("component", "first", "second", "node")
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, unit = None, []

        def done() -> pa.RecordBatch:
            nodes = np.array([u[1] for u in unit])
            linked, root = linked_in_block(
                [np.frombuffer(u[3], np.uint64) for u in unit], np.array([u[0] for u in unit]), np.array([u[2] for u in unit], float), threshold
            )
            return pa.RecordBatch.from_arrays(
                [pa.array(nodes), pa.array(np.rint(linked).astype(np.int64)), pa.array(nodes[root])], ["node", "linked", "root"]
            )

        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            for component, first, second, *row in zip(*columns):
                if (component, first, second) != key:
                    if len(unit) > 1:
                        yield done()
                    key, unit = (component, first, second), []
                unit.append(row)
        if len(unit) > 1:
            yield done()

    return units.mapInArrow(compare, "node long, linked long, root long")


def join(
    docs: DataFrame, threshold: float = 0.8, size: int = 5, trees: int = 24, full_depth: int = 10, recall: float = 0.999, block: int = 256, seed: int = 1
) -> DataFrame:
    """doc_id, class_id, n_links for every row of docs."""
    depth = prefix_depth(threshold, trees, full_depth, recall)
    signed = written(signatures(docs, trees, depth, size, seed))
    keyed = signed.filter("set_key is not null and doc_id is not null")
    nodes = written(keyed.groupBy("set_key").agg(F.min("doc_id").alias("node"), F.count("*").alias("copies")))
    signed_nodes = signed.join(nodes.select("node", "set_key"), (signed.doc_id == F.col("node")) & (signed.set_key == nodes.set_key), "left_semi")
    groups = candidate_groups(signed_nodes.select(F.col("doc_id").alias("node"), "prefixes").dropDuplicates(["node"]))
    found = written(verify(docs, groups.join(nodes.select("node", "copies"), "node"), threshold, size, block))
    linked = found.groupBy("node").agg(F.sum("linked").alias("linked"))
    classes = components(found.filter("node != root").select("node", F.col("root").alias("other")))
    of_node = nodes.join(linked, "node", "left").join(classes, "node", "left").select(
        "set_key",
        F.coalesce("component", "node").alias("class_id"),
        (F.col("copies") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"),
    )
    rows = signed.select("doc_id", F.when(F.col("doc_id").isNotNull(), F.col("set_key")).alias("set_key"))
    own = F.when(F.col("set_key").isNull(), F.col("doc_id")).otherwise(F.col("class_id"))
    return rows.join(of_node, "set_key", "left").select("doc_id", own.alias("class_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"))


def one_of_each(docs: DataFrame, **options) -> DataFrame:
    """The rows of docs, all columns, that are the least id of their group; a repeated row stays once."""
    decided = written(join(docs, **options))
    dropped = written(decided.filter("doc_id != class_id").select("doc_id").distinct())
    left = docs.join(dropped, "doc_id", "left_anti").select(*docs.columns)
    repeated = written(decided.filter("doc_id = class_id").groupBy("doc_id").count().filter("count > 1").select("doc_id"))
    if repeated.isEmpty():
        return left
    once = left.join(repeated, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return left.join(repeated, "doc_id", "left_anti").unionByName(once)
