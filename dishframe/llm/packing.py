"""Packing by cutting-stock column generation.

Documents are tokenized once, where they are read; only their pieces' lengths and checksums go on. A
document longer than a sequence is cut into full sequences and a remainder. The histogram of piece
lengths (at most one entry per size class) goes to the driver, where a linear program over patterns of
size classes is solved (`cutting_stock`). Pieces are ranked within their size class, in slices whose
number grows with the data, and the rank gives sequence and place: no task holds a whole class.

Defined cases: a null or empty text is its end token alone; repeated rows are packed once each; an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import sys
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from dishframe.llm import cutting_stock
from dishframe.llm.common import text_bytes, worker_memory, written
from dishframe.llm.pieces import WordIds

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def pieces(docs: DataFrame, path: str, end_id: int, capacity: int) -> DataFrame:
    """Pieces of at most `capacity` ids; the ids themselves stay in the task."""
    end = end_id.to_bytes(4, "little")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if sys.byteorder != "little":
            raise RuntimeError("ids are laid out in the machine's byte order, which must be little-endian")
        known = worker_memory(f"ids {path}", lambda: WordIds(path))
        step = 4 * capacity
        for batch in batches:
            ids, starts, lengths, sums, totals = [], [], [], [], []
            for doc_id, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                stream = b"".join([known[w] for w in data.split()]) + end
                for at in range(0, len(stream), step):
                    piece = stream[at : at + step]
                    ids.append(doc_id)
                    starts.append(at // 4)
                    lengths.append(len(piece) // 4)
                    sums.append(zlib.crc32(piece))
                    totals.append(len(stream) // 4)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in (ids, starts, lengths, sums, totals)], [f.split()[0] for f in PIECES.split(", ")]
            )

    return docs.select("doc_id", text_bytes(F.col("text")).alias("data")).mapInArrow(rows, PIECES)


def pack(docs: DataFrame, path: str, end_id: int = 1, capacity: int = 2048, granule: int = 8, slice_rows: int = 50_000) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    size = F.ceil(F.col("length") / granule).cast("int")
    cut = written(pieces(docs, path, end_id, capacity).withColumn("size", size))
    histogram = {r["size"]: r["count"] for r in cut.groupBy("size").count().collect()}
    plan = cutting_stock.solve(list(histogram), list(histogram.values()), capacity // granule)

    # For each size, its places in the order of the patterns: first place, first sequence, places a sequence.
    places: dict[int, list[tuple[int, int, int]]] = {}
    taken, sequence = dict.fromkeys(histogram, 0), 0
    for pattern, times in plan:
        for s, each in pattern.items():
            places.setdefault(s, []).append((taken[s], sequence, each))
            taken[s] += each * times
        sequence += times
    tables = {s: np.array(rows, np.int64) for s, rows in places.items()}

    slices = max(1, -(-sum(histogram.values()) // slice_rows))
    sliced = cut.withColumn("slice", F.pmod(F.hash("doc_id", "start"), F.lit(slices)))
    before = Window.partitionBy("size").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sliced.groupBy("size", "slice").agg(F.count("*").alias("n")).select(
        "size", "slice", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")
    )
    within = Window.partitionBy("size", "slice").orderBy("doc_id", "start", "ids_crc32", "length", "doc_tokens")
    ranked = (
        sliced.withColumn("row", F.row_number().over(within) - 1)
        .join(offsets, ["size", "slice"])
        .withColumn("rank", F.col("before") + F.col("row"))
        .select(*cut.columns, "rank")
    )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, ranks = batch.column("size").to_numpy(), batch.column("rank").to_numpy()
            sequence = np.zeros(len(sizes), np.int64)
            for s in np.unique(sizes):
                on, rows = sizes == s, tables[int(s)]
                at = np.searchsorted(rows[:, 0], ranks[on], side="right") - 1
                sequence[on] = rows[at, 1] + (ranks[on] - rows[at, 0]) // rows[at, 2]
            yield batch.append_column("sequence_id", pa.array(sequence))

    placed = ranked.mapInArrow(place, f"{PIECES}, size int, rank long, sequence_id long")
    ahead = Window.partitionBy("sequence_id").orderBy(F.desc("size"), "rank").rowsBetween(Window.unboundedPreceding, -1)
    return placed.withColumn("offset", F.coalesce(F.sum("length").over(ahead), F.lit(0))).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )
