"""One pass over XML files that hold many sibling elements of several kinds.

The built-in XML reader splits at one row tag, so nodes and ways take a scan each. This data source cuts
files into byte ranges and gives the text of every wanted element, whatever its kind; the columns
come from `from_xml` in the JVM. An element belongs to the range in which it opens, and a task reads on
until its last element is closed, so no range needs its neighbours.

Defined cases: elements of wanted kinds do not hold one another; quoted attribute values may hold `>`;
files are UTF-8 and not compressed; an element that is never closed is an error, as is any that is cut
off; an empty file gives no rows; names that begin with `_` or `.` are not read. A path without a
scheme is a folder or file that driver and executors share.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from typing import BinaryIO

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SPLIT_BYTES = 64 << 20
READ_BYTES = 1 << 20
ROWS = 4096


def element_texts(file: BinaryIO, start: int, stop: int, kinds: Sequence[str], step: int = READ_BYTES) -> Iterator[tuple[str, str]]:
    """(kind, text) of the elements that open at bytes start up to stop."""
    kind = "|".join(map(re.escape, kinds)).encode()
    opening = re.compile(rb"<(?:%s)(?=[\s/>])" % kind)
    whole = re.compile(rb"""<(%s)(?=[\s/>])(?:[^>"']|"[^"]*"|'[^']*')*?(?:/>|>.*?</\1\s*>)""" % kind, re.S)
    margin = max(map(len, kinds)) + 2  # an opening may be cut by the end of what is held
    file.seek(start)
    held, base, at, ended = b"", start, 0, False
    while True:
        found = opening.search(held, at)
        if found and base + found.start() >= stop:
            return
        element = whole.match(held, found.start()) if found else None
        if element:
            yield element[1].decode(), element[0].decode()
            at = element.end()
            continue
        if ended:
            if found:
                raise ValueError(f"the element at byte {base + found.start()} is not closed")
            return
        keep = found.start() if found else max(at, len(held) - margin)
        held, base, at = held[keep:], base + keep, 0
        if not found and base >= stop:
            return
        more = file.read(max(step, len(held)))
        held, ended = held + more, not more


class _Range(InputPartition):
    def __init__(self, path: str, start: int, stop: int):
        self.path, self.start, self.stop = path, start, stop


def _located(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def _hidden(path: str, folder: str) -> bool:
    return any(part[:1] in ("_", ".") for part in path[len(folder) :].split("/") if part)


class _Reader(DataSourceReader):
    def __init__(self, path: str, kinds: list[str], split: int):
        self.path, self.kinds, self.split = path, kinds, split

    def partitions(self) -> list[_Range]:
        system, folder = _located(self.path)
        info = system.get_file_info(folder)
        if info.type == fs.FileType.NotFound:
            raise FileNotFoundError(self.path)
        inside = [info] if info.type == fs.FileType.File else system.get_file_info(fs.FileSelector(folder, recursive=True))
        files = [f for f in inside if f.type == fs.FileType.File and (f is info or not _hidden(f.path, folder.rstrip("/")))]
        cuts = [_Range(f.path, a, min(a + self.split, f.size)) for f in files for a in range(0, f.size, self.split)]
        return cuts or [_Range("", 0, 0)]

    def read(self, partition: _Range) -> Iterator[pa.RecordBatch]:
        if not partition.path:
            return
        with _located(self.path)[0].open_input_file(partition.path) as file:
            rows: list[tuple[str, str]] = []
            for row in element_texts(file, partition.start, partition.stop, self.kinds):
                rows.append(row)
                if len(rows) == ROWS:
                    yield _batch(rows)
                    rows = []
            if rows:
                yield _batch(rows)


def _batch(rows: list[tuple[str, str]]) -> pa.RecordBatch:
    kinds, texts = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(kinds, pa.string()), pa.array(texts, pa.string())], ["kind", "element"])


class XmlElements(DataSource):
    """Options: path, kinds (comma-separated element names), splitBytes."""

    @classmethod
    def name(cls) -> str:
        return "xml_elements"

    def schema(self) -> str:
        return "kind string, element string"

    def reader(self, schema) -> DataSourceReader:
        kinds = [k.strip() for k in self.options["kinds"].split(",")]
        return _Reader(self.options["path"], kinds, int(self.options.get("splitBytes", SPLIT_BYTES)))


def elements(spark: SparkSession, path: str, kinds: Sequence[str], split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """(kind, element): the text of every element of these kinds, in one scan of the files."""
    spark.dataSource.register(XmlElements)
    source = spark.read.format("xml_elements").option("kinds", ",".join(kinds)).option("splitBytes", str(split_bytes))
    return source.load(path)
