"""Token counts without ids: pieces are counted once per distinct pre-token, joined to each
document's pre-token frequencies, and summed.

Two passes over the texts. The first counts the pre-tokens of the whole table (partial counts per
task, then one exchange); each distinct one goes through the tokenizer's model once. In the second,
the commonest pre-tokens (a bounded list held by every task) are summed where the document is read;
the frequencies of all others are joined to the counted pre-tokens and summed per document. Both
passes split, encode and count runs of texts as Arrow columns.

Defined cases: null and empty texts have 0 bytes and tokens; repeated rows give repeated results; an
empty table gives no rows; special strings in a text count as one token each; other columns are not
read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from dishframe.llm.common import commonest, text_bytes, written
from dishframe.llm.pieces import BytePretokens, byte_letters, runs


def vocabulary(docs: DataFrame, path: str) -> DataFrame:
    """pretoken, freq, pieces: every distinct pre-token of the table, counted once."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = BytePretokens(path)
        for batch in batches:
            for _, texts in runs(batch.column(0).cast(pa.string())):
                _, found, _ = split.split(texts)
                yield pa.RecordBatch.from_arrays(found.value_counts().flatten(), ["pretoken", "n"])

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = BytePretokens(path)
        for batch in batches:
            counted = pa.array([split.count(byte_letters(p)) for p in batch.column(0).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, counted], ["pretoken", "freq", "pieces"])

    counts = docs.select(text_bytes(F.col("text")).alias("data")).mapInArrow(count, "pretoken string, n long")
    return counts.groupBy("pretoken").agg(F.sum("n").alias("freq")).mapInArrow(measure, "pretoken string, freq long, pieces long")


SCHEMA = "doc_id long, mark long, pretoken string, n long, n_bytes long, pieces long, copies long"


def frequencies(docs: DataFrame, path: str, common: dict[str, int]) -> DataFrame:
    """Per document one row for each pre-token outside `common`; the first also carries the sums."""
    shared = docs.sparkSession.sparkContext.broadcast(common)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = BytePretokens(path)
        held = pa.array(shared.value.keys(), pa.string())
        each = np.array([*shared.value.values(), 0], np.int64)
        for batch in batches:
            for start, texts in runs(batch.column(2).cast(pa.string())):
                ids, marks = (c.slice(start, len(texts)) for c in batch.columns[:2])
                place, found, total = split.split(texts)
                coded = found.dictionary_encode()
                pretokens, at = coded.dictionary, coded.indices.to_numpy()
                known = pc.index_in(pretokens, value_set=held).fill_null(len(held)).to_numpy()
                total += np.bincount(place, each[known][at], len(texts)).astype(np.int64)
                rare = (known == len(held))[at]
                pairs, n = np.unique(place[rare] * len(pretokens) + at[rare], return_counts=True)
                doc, pretoken = np.divmod(pairs, max(len(pretokens), 1))
                bare = np.setdiff1d(np.arange(len(texts)), doc)
                own = [f" {i}" for i in ids.take(pa.array(bare)).to_pylist()]  # so that such documents spread
                first = np.concatenate([np.diff(doc, prepend=-1) > 0, np.ones(len(bare), bool)])
                doc = np.concatenate([doc, bare])
                sizes = pc.binary_length(texts).to_numpy().astype(np.int64)
                columns = [
                    ids.take(pa.array(doc)),
                    marks.take(pa.array(doc)),
                    pa.concat_arrays([pretokens.take(pa.array(pretoken)), pa.array(own, pa.string())]),
                    pa.array(np.concatenate([n, np.zeros(len(bare), np.int64)])),
                    *(pa.array(np.where(first, sums[doc], 0)) for sums in (sizes, total)),
                    pa.array(first.astype(np.int64)),
                ]
                yield pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in SCHEMA.split(", ")])

    slim = docs.select("doc_id", F.xxhash64("text").alias("mark"), text_bytes(F.col("text")).alias("data"))
    return slim.mapInArrow(rows, SCHEMA)


def count_tokens(docs: DataFrame, path: str, limit: int = 1024, common_pretokens: int = 50_000) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every document."""
    known = written(vocabulary(docs, path))
    common = {r.pretoken: r.pieces for r in commonest(known, "freq", common_pretokens).collect()}
    pieces = known.select("pretoken", F.col("pieces").alias("each"))
    per_doc = (
        frequencies(docs, path, common)
        .join(pieces, "pretoken", "left")
        .groupBy("doc_id", "mark")
        .agg(
            F.sum("n_bytes").alias("n_bytes"),
            F.sum(F.col("pieces") + F.col("n") * F.coalesce("each", F.lit(0))).alias("n_tokens"),
            F.sum("copies").alias("copies"),
        )
    )
    # Rows that repeat an id and its text were summed together.
    each = per_doc.select(
        "doc_id",
        F.expr("n_bytes div copies").alias("n_bytes"),
        F.expr("n_tokens div copies").alias("n_tokens"),
        F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"),
    )
    return each.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
