"""Quality classification by importance resampling.

Texts are bags of hashed 1- and 2-grams. Two generative models, one for target text (labelled good)
and one for raw text (the whole table), are histograms over the hash buckets, smoothed. A document's
importance weight is the log ratio of its likelihoods. Adding Gumbel noise, drawn from a hash of the
id, and keeping the k greatest samples k documents without replacement, in proportion to their
weights. k is the number of documents whose weight reaches the cut that separates the labelled rows
best, so it grows with the table.

The target model and the cut are fitted on a bounded sample of labelled rows; raw counts cover all
documents. The k-th greatest key is found by counting keys in ever finer bins: exact, and only
counts reach the driver.

Defined cases: null and empty texts have weight 0 (and noise); rows of equal key are kept or left
together; without labels of both kinds all documents are kept; an empty table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from dishframe.llm.common import text_bytes, worker_memory, written
from dishframe.llm.labelled import sample, with_label

_PARTS = re.compile(rb"[0-9]+|[A-Za-z\x80-\xff]+|[^0-9A-Za-z\x80-\xff]+")
BUCKETS = 1 << 15


class Grams(dict):
    """White-space delimited chunk to the hashes of its parts: letters, digits, punctuation."""

    def __missing__(self, chunk: bytes) -> tuple[int, ...]:
        if len(self) > 400_000:
            self.clear()
        self[chunk] = out = tuple(map(zlib.crc32, _PARTS.findall(chunk)))
        return out


def buckets(data: bytes, grams: Grams) -> np.ndarray:
    """Hash buckets of a text's 1-grams and 2-grams."""
    one = np.array([h for c in data.split() for h in grams[c]], np.uint64)
    two = (one[:-1] * np.uint64(0x9E3779B97F4A7C15) + one[1:] * np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(33)
    return np.concatenate([one, two]).astype(np.int64) % BUCKETS


def histogram(docs: DataFrame) -> np.ndarray:
    """Grams in each bucket over all rows of docs (column data)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_memory("grams")  # what other work kept goes
        grams, total = Grams(), np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for data in batch.column(0).to_pylist():
                total += np.bincount(buckets(data, grams), minlength=BUCKETS)
        on = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(on), pa.array(total[on])], ["bucket", "n"])

    out = np.zeros(BUCKETS)
    for r in docs.select("data").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r.bucket] = r.n
    return out


def weigh(docs: DataFrame, ratio: np.ndarray) -> DataFrame:
    """The docs' columns but data, and weight: the sum of the log ratios of a text's grams."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_memory("grams")
        grams = Grams()
        for batch in batches:
            at = batch.schema.get_field_index("data")
            weight = [float(ratio[buckets(d, grams)].sum()) for d in batch.column(at).to_pylist()]
            yield batch.remove_column(at).append_column("weight", pa.array(weight, pa.float64()))

    schema = StructType([f for f in docs.schema.fields if f.name != "data"]).add("weight", "double")
    return docs.mapInArrow(rows, schema)


def best_cut(good: np.ndarray, bad: np.ndarray) -> float:
    """The weight that separates best (mean of both classes' shares); the middle of the best gap."""
    values = np.unique(np.concatenate([good, bad]))
    middle = np.concatenate([[values[0] - 1], (values[1:] + values[:-1]) / 2])
    right = 1 - np.searchsorted(np.sort(good), middle) / len(good) + np.searchsorted(np.sort(bad), middle) / len(bad)
    return float(middle[int(right.argmax())])


def kth_greatest(keys: DataFrame, k: int) -> float:
    """The k-th greatest key of a written table, by counting in ever finer bins."""
    if k <= 0:
        return float("inf")
    low, high = keys.agg(F.min("key"), F.max("key")).first()
    while low is not None and high > low:
        width = (high - low) / 1024
        place = F.least(F.floor((F.col("key") - low) / width), F.lit(1023)) if width > 0 else F.lit(0)
        inside = keys.filter((F.col("key") >= low) & (F.col("key") <= high))
        bins = sorted(((r["bin"], r["n"], r["a"], r["b"]) for r in inside.groupBy(place.alias("bin")).agg(F.count("*").alias("n"), F.min("key").alias("a"), F.max("key").alias("b")).collect()), reverse=True)
        for _, n, a, b in bins:
            if k <= n:
                low, high = a, b
                break
            k -= n
        else:
            return low
        if len(bins) == 1 and width == 0:
            break
    return low if low is not None else float("-inf")


@dataclass(frozen=True)
class Resampler:
    """The log ratio of each bucket and the least key that is sampled."""

    ratio: np.ndarray
    least: float
    seed: int

    def keyed(self, docs: DataFrame) -> DataFrame:
        """docs without data, with weight, and key: the weight with Gumbel noise drawn from the id."""
        uniform = (F.pmod(F.xxhash64("doc_id", F.lit(self.seed)), F.lit(1 << 52)) + 0.5) / float(1 << 52)
        return weigh(docs, self.ratio).withColumn("key", F.col("weight") - F.log(-F.log(uniform)))


def _slim(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", text_bytes(F.col("text")).alias("data"))


def fit(docs: DataFrame, labels: DataFrame, max_labelled: int = 20_000, smoothing: float = 1.0, seed: int = 7) -> tuple[Resampler, DataFrame]:
    """The fitted sampler, and doc_id, weight, key of every document as a written table."""
    slim = _slim(docs)
    labelled = with_label(slim, sample(labels.select("doc_id", "quality"), "quality", max_labelled))
    target, raw = histogram(labelled.filter("quality > 0")), histogram(slim)
    ratio = np.log((target + smoothing) / (target + smoothing).sum()) - np.log((raw + smoothing) / (raw + smoothing).sum())
    known = weigh(labelled.select("quality", "data"), ratio).collect()  # bounded by max_labelled
    good = np.array([r.weight for r in known if r.quality > 0])
    bad = np.array([r.weight for r in known if r.quality <= 0])
    if not len(good) or not len(bad):
        everyone = Resampler(np.zeros(BUCKETS), float("-inf"), seed)
        return everyone, written(everyone.keyed(slim))
    cut = best_cut(good, bad)
    keyed = written(Resampler(ratio, cut, seed).keyed(slim))
    k = keyed.filter(F.col("weight") >= cut).count()
    return Resampler(ratio, kth_greatest(keyed, k), seed), keyed


def classify(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """doc_id, weight, key (weight with Gumbel noise) and kept for every document; labels: doc_id, quality."""
    sampler, keyed = fit(docs, labels, **options)
    return keyed.withColumn("kept", F.col("key") >= sampler.least)


def kept_documents(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of docs, all columns, that are sampled; keys are computed again where rows are read, without a join."""
    sampler, _ = fit(docs, labels, **options)
    bare = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "doc_id", text_bytes(F.col("text")).alias("data"))
    return sampler.keyed(bare).filter(F.col("key") >= sampler.least).select("row.*")
