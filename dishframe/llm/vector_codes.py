"""Vector code compression: product codes whose nearest entries are found by slicing and intersecting.

Vectors become integers and are cut into equal parts; each part has a codebook, refined in rounds of
nearest-entry assignment and means. The nearest entry is found exactly: every dimension keeps its
entries' coordinates sorted, and for each prefix of that order a mask of 64-bit words naming the entries
in it. A radius selects a range per dimension; the prefix masks at its two ends, one XORed with the
other, name the entries inside it, and the masks of all dimensions ANDed name the entries of a box. The
initial radius is a typical distance between entries; the best entry of that box, or else the entry next
to the vector in the order of the widest dimension, gives the radius of a second box, which holds the
nearest entry and all that tie with it. Only entries of the boxes are considered.

Rounds run over a table of integers written once. A task sends one sum per codebook component, so a
round's shuffle and what the driver gets are bounded by the codebook, whatever the rows' skew.

Defined cases: null vectors and vectors with a null or non-finite component are dropped, and so are
those whose length is not a multiple of the number of parts or differs from that of the smallest id;
equal ids are taken in the order of their vectors, null ids last; fewer rows than entries make a
smaller codebook; components too large for 64-bit squares are computed as whole numbers of any size,
and errors beyond a long are given as the largest long; an empty table gives no rows; other columns
are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from dishframe.llm.common import written

#: Components below this keep squares and their sums over 1,024 dimensions within 64 bits.
PLAIN = 1 << 25
LONGEST = (1 << 63) - 1
SCALE = 1024


def integers(values: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """floor(scale * x), as 64-bit integers where that is safe and as Python's else."""
    scaled = np.floor(values.astype(np.float64) * scale)
    if scaled.size == 0 or np.abs(scaled).max() < PLAIN:
        return scaled.astype(np.int64)
    return np.array([int(x) for x in scaled.ravel()], dtype=object).reshape(scaled.shape)


class Slices:
    """One part's codebook, ready for exact nearest-entry search."""

    def __init__(self, entries: np.ndarray) -> None:
        self.entries, (n, dims) = entries, entries.shape
        words = -(-n // 64)
        self.order = [np.argsort(entries[:, d], kind="stable") for d in range(dims)]
        self.sorted = [entries[o, d] for d, o in enumerate(self.order)]
        # masks[d][k]: the entries with the k least coordinates in dimension d.
        self.masks = []
        for order in self.order:
            bit = np.zeros((n + 1, words), np.uint64)
            bit[np.arange(1, n + 1), order // 64] = np.uint64(1) << (order % 64).astype(np.uint64)
            self.masks.append(np.bitwise_or.accumulate(bit, axis=0))
        spread = [int(c[-1]) - int(c[0]) for c in self.sorted]
        self.widest = int(np.argmax(np.array(spread, dtype=object)))
        self.initial = self._initial_radius()
        # Squares and their sums are exact in doubles where all stay below 2^53.
        most = max(abs(int(x)) for x in entries.ravel())
        self.exact_below = math.isqrt((1 << 53) // (4 * dims)) - 1
        self.doubles = entries.astype(np.float64) if most < self.exact_below else None

    def _initial_radius(self):
        """The median entry's greatest coordinate difference to the entry where that is least."""
        n = len(self.entries)
        if n == 1:
            return 0
        nearest = []
        for e in range(n):
            apart = np.abs(self.entries - self.entries[e]).max(axis=1)
            nearest.append(min(apart[:e].min(initial=apart.max()), apart[e + 1 :].min(initial=apart.max())))
        return sorted(nearest)[n // 2]

    def guess(self, points: np.ndarray) -> np.ndarray:
        """The entry at or after the point in the order of the widest dimension."""
        at = np.searchsorted(self.sorted[self.widest], points[:, self.widest])
        return self.order[self.widest][np.minimum(at, len(self.entries) - 1)]

    def distance(self, points: np.ndarray, entry: np.ndarray) -> np.ndarray:
        apart = points - self.entries[entry]
        return (apart * apart).sum(axis=1)

    def candidates(self, points: np.ndarray, radius: np.ndarray) -> np.ndarray:
        """Masks of the entries whose every coordinate is within the radius."""
        found = None
        for d, coordinates in enumerate(self.sorted):
            low = np.searchsorted(coordinates, points[:, d] - radius, side="left")
            high = np.searchsorted(coordinates, points[:, d] + radius, side="right")
            inside = self.masks[d][low] ^ self.masks[d][high]
            found = inside if found is None else found & inside
        return found

    def _least(self, points: np.ndarray, masks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest entry among those of the masks, none of which is empty."""
        bits = np.unpackbits(masks.astype("<u8").view(np.uint8), axis=1, count=len(self.entries), bitorder="little")
        if self.doubles is not None and points.dtype != object and 8 * int(bits.sum()) > bits.size and np.abs(points).max() < self.exact_below:
            # Many candidates: one matrix product measures them all.
            p = points.astype(np.float64)
            all_measured = (p * p).sum(axis=1)[:, None] - 2 * (p @ self.doubles.T) + (self.doubles**2).sum(axis=1)
            all_measured[bits == 0] = np.inf
            index = all_measured.argmin(axis=1)
            return index, all_measured[np.arange(len(points)), index].astype(np.int64)
        row, entry = np.nonzero(bits)
        measured = self.distance(points[row], entry)
        rows = np.arange(len(points))
        least = np.minimum.reduceat(measured, np.searchsorted(row, rows))
        best = measured == least[row]
        return entry[best][np.searchsorted(row[best], rows)], least

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry (of equal ones the lowest) and its squared distance, per point."""
        if len(points) == 0:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        bound = self.distance(points, self.guess(points))
        masks = self.candidates(points, self.initial)
        if (some := masks.any(axis=1)).any():
            bound[some] = np.minimum(bound[some], self._least(points[some], masks[some])[1])
        if bound.dtype == object:
            radius = np.array([math.isqrt(b) for b in bound], dtype=object)
        else:
            radius = np.sqrt(bound.astype(np.float64)).astype(np.int64) + 1
        return self._least(points, self.candidates(points, radius))


def _limbs(slots: np.ndarray, totals: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(slot, limb, value) with totals as sums of value << 32 * limb: no sum of a limb overflows a long."""
    for slot, total in zip(slots.tolist(), totals.tolist()):
        limb = 0
        while not -(1 << 31) <= total < 1 << 31:
            yield slot, limb, total & 0xFFFFFFFF
            total, limb = total >> 32, limb + 1
        yield slot, limb, total


def _points(batch: pa.RecordBatch, dims: int, scale: int) -> np.ndarray:
    column = batch.column("vector")
    return integers(column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dims), scale)


def kept_vectors(vectors: DataFrame, column: str, parts: int) -> DataFrame:
    """vec_id, label and vector of the rows with a whole, finite vector."""
    finite = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    whole = (F.size(column) > 0) & (F.size(column) % parts == 0)
    kept = vectors.filter(F.col(column).isNotNull() & whole & finite)
    return kept.select("vec_id", "label", F.col(column).alias("vector"))


def _sums(kept: DataFrame, books: list[np.ndarray], scale: int) -> dict[int, int]:
    """Sum of every codebook component's parts, and after them the entries' counts."""
    parts, (n, width) = len(books), books[0].shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slices = [Slices(b) for b in books]
        totals = np.zeros((parts, n, width), np.int64)
        large: np.ndarray | None = None
        counts = np.zeros((parts, n), np.int64)
        for batch in batches:
            points = _points(batch, parts * width, scale)
            into = totals
            if points.dtype == object:
                large = np.zeros((parts, n, width), dtype=object) if large is None else large
                into = large
            for p, s in enumerate(slices):
                part = points[:, p * width : (p + 1) * width]
                index, _ = s.nearest(part)
                np.add.at(into[p], index, part)
                counts[p] += np.bincount(index, minlength=n)
        if counts.any():
            whole = totals if large is None else totals.astype(object) + large
            used = np.concatenate([np.repeat(counts.ravel() > 0, width), counts.ravel() > 0])
            values = np.concatenate([whole.ravel(), counts.ravel()])
            slot, limb, value = zip(*_limbs(np.nonzero(used)[0], values[used]))
            columns = [pa.array(slot, pa.int64()), pa.array(limb, pa.int32()), pa.array(value, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["slot", "limb", "value"])

    sums = kept.select("vector").mapInArrow(run, "slot long, limb int, value long").groupBy("slot", "limb").agg(F.sum("value").alias("value"))
    out: dict[int, int] = {}
    for r in sums.collect():
        out[r.slot] = out.get(r.slot, 0) + (r.value << 32 * r.limb)
    return out


def train(kept: DataFrame, parts: int, entries: int, rounds: int, scale: int = SCALE) -> list[np.ndarray]:
    """Codebooks per part, started from the vectors of the smallest ids."""
    first = kept.orderBy(F.asc_nulls_last("vec_id"), "vector").limit(entries).collect()
    if not first:
        return []
    dims = len(first[0].vector)
    kept = kept.filter(F.size("vector") == dims)
    start = integers(np.array([r.vector for r in first if len(r.vector) == dims]), scale)
    width = dims // parts
    books = [start[:, p * width : (p + 1) * width] for p in range(parts)]
    for _ in range(rounds):
        sums = _sums(kept, books, scale)
        n = len(start)
        moved = []
        for p, book in enumerate(books):
            new = book.astype(object)
            for e in range(n):
                if count := sums.get(parts * n * width + p * n + e, 0):
                    at = (p * n + e) * width
                    new[e] = [sums[at + d] // count for d in range(width)]
            plain = max(abs(int(x)) for x in new.ravel()) < PLAIN
            moved.append(new.astype(np.int64) if plain else new)
        books = moved
    return books


def books_text(books: list[np.ndarray]) -> str:
    return ",".join(str(int(x)) for book in books for x in book.ravel())


def encode(kept: DataFrame, books: list[np.ndarray], scale: int = SCALE) -> DataFrame:
    """vec_id, label, code and error of every vector of the codebooks' length."""
    parts, width = len(books), books[0].shape[1]
    digits = max(2, len(f"{len(books[0]) - 1:x}"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slices = [Slices(b) for b in books]
        for batch in batches:
            points = _points(batch, parts * width, scale)
            codes, error = [], 0
            for p, s in enumerate(slices):
                index, least = s.nearest(points[:, p * width : (p + 1) * width])
                codes.append([f"{i:0{digits}x}" for i in index.tolist()])
                error = error + least
            errors = [min(int(e), LONGEST) for e in error]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), pa.array(map("".join, zip(*codes)), pa.string()), pa.array(errors, pa.int64())],
                ["vec_id", "label", "code", "error"],
            )

    types = {f.name: f.dataType.simpleString() for f in kept.schema}
    schema = f"vec_id {types['vec_id']}, label {types['label']}, code string, error long"
    return kept.filter(F.size("vector") == parts * width).mapInArrow(run, schema)


def compress(
    vectors: DataFrame, column: str = "embedding", parts: int = 4, entries: int = 256, rounds: int = 4, scale: int = SCALE
) -> DataFrame:
    """vec_id, label, code, error, label_error and codebooks_sha256 of every kept vector."""
    kept = written(kept_vectors(vectors, column, parts))
    books = train(kept, parts, entries, rounds, scale)
    digest = hashlib.sha256(books_text(books).encode()).hexdigest()
    if not books:
        none = kept.limit(0).select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("bigint").alias("error"))
        return none.withColumns({"label_error": F.col("error"), "codebooks_sha256": F.lit(digest)})
    coded = written(encode(kept, books, scale))
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(LONGEST).cast("decimal(38,0)")).cast("bigint")
    of_label = coded.groupBy(F.col("label").alias("of")).agg(total.alias("label_error"))
    return (
        coded.join(of_label, F.col("label").eqNullSafe(F.col("of")))
        .select("vec_id", "label", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
    )
