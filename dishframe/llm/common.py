"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from dishframe.session import checkpoint_dir

# Words are maximal runs of anything but the six ASCII white-space characters; bytes.split() cuts just there.
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def written(df: DataFrame) -> DataFrame:
    """The table, written once to the shared folder: later steps and retried tasks read it, not its sources."""
    folder = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/table-{uuid.uuid4().hex}"
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo the divisor."""
    return F.crc32(doc_id.cast("string").cast("binary")) % divisor


def text_bytes(text: Column) -> Column:
    """UTF-8 bytes of a text; a null text is empty."""
    return F.coalesce(text, F.lit("")).cast("binary")


def words(text: Column) -> Column:
    """The words of a text as an array."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def per_batch(df: DataFrame, rows: Callable[[dict], dict], schema: str) -> DataFrame:
    """Row-local work in Arrow batches: columns in as lists, columns out as lists or arrays."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_pydict(rows(batch.to_pydict()))

    return df.mapInArrow(run, schema)


_MEMORY: dict = {}


def worker_memory(name: str, make: Callable[[], object] = dict) -> object:
    """What a worker remembers from task to task: one thing at a time, replaced by that of other work."""
    if name not in _MEMORY:
        _MEMORY.clear()
        _MEMORY[name] = make()
    return _MEMORY[name]


def commonest(counts: DataFrame, column: str, bound: int) -> DataFrame:
    """The rows of greatest count, at most `bound` of them: all rows above a level of the count.

    The level is found from the number of rows in bins of the count's logarithm, so neither a task nor
    the driver gets more rows than the bound, however many partitions there are.
    """
    level = F.floor(F.log2(column) * 16)
    room, least = bound, None
    for r in sorted(counts.groupBy(level.alias("level")).count().collect(), reverse=True):
        room -= r["count"]
        if room < 0:
            break
        least = r.level
    return counts.filter(level >= least) if least is not None else counts.limit(0)
