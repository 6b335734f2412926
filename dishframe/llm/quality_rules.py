"""Quality rules by distribution divergence.

A document's histogram of character classes, and its histogram of the words that are common in its
language, are compared with the language's own histograms by Jensen-Shannon distance (base 2, 0 to 1).
The references are counted over all documents of the language; a language whose reference is too
small, and a document that is too short, are not judged by distance (the guards), only by the base
rules.

Defined cases: a null or empty text has no words and fails the base rules; a null language is a
language of its own; repeated rows give repeated results; an empty table gives no rows; columns other
than those named are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructField, StructType
from pyspark.sql.window import Window

from dishframe.llm.common import text_bytes, worker_memory, written

# Byte to character class; the class of a continuation byte (10) is dropped, so code points are counted.
CLASSES = ("lower", "upper", "letter", "digit", "space", "stop", "symbol", "mark", "control", "other")
SYMBOLS = b"#*$%&|<>"
_CLASS = np.full(256, 9, np.uint8)
_CLASS[ord("a") : ord("z") + 1] = 0
_CLASS[ord("A") : ord("Z") + 1] = 1
_CLASS[0xC0:0x100] = 2
_CLASS[ord("0") : ord("9") + 1] = 3
_CLASS[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = 4
_CLASS[list(b".,;:!?'\"()-")] = 5
_CLASS[list(SYMBOLS)] = 6
_CLASS[list(b"+/=@[\\]^_`{}~")] = 7
_CLASS[[*range(0x00, 0x09), *range(0x0E, 0x20), 0x7F]] = 8
_CLASS[0x80:0xC0] = 10
N_CLASSES = len(CLASSES)

#: Distinct words, over all languages, that a counting task holds before it hands its partial counts on.
FLUSH = 300_000


def class_counts(data: bytes) -> np.ndarray:
    return np.bincount(_CLASS[np.frombuffer(data, np.uint8)], minlength=N_CLASSES + 1)[:N_CLASSES]


def repeated_words(tokens: list[bytes]) -> int:
    """Words covered by a 3-word window that occurs at least twice."""
    n = len(tokens) - 2
    if n < 2:
        return 0
    ids: dict[bytes, int] = {}
    code = np.fromiter((ids.setdefault(w, len(ids)) for w in tokens), np.uint64, n + 2)
    if len(ids) < 1 << 21:  # three ids fit one word
        key = (code[:-2] << np.uint64(42)) | (code[1:-1] << np.uint64(21)) | code[2:]
    else:
        pair = np.unique(np.stack([code[:-1], code[1:]]), axis=1, return_inverse=True)[1].astype(np.uint64).ravel()
        key = (pair[:-1] << np.uint64(32)) | code[2:]
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    twice = np.zeros(n, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(n + 2, bool)
    for shift in range(3):
        covered[shift : shift + n] |= twice
    return int(covered.sum())


def base_counts(data: bytes) -> tuple[list[bytes], int, int, int, int]:
    """Words, code points in words, symbols, repeated lines, words in repeated windows."""
    tokens, classes = data.split(), class_counts(data)
    lines = [line for line in data.split(b"\n") if line.strip(b" \t\n\r\x0b\x0c")]
    return tokens, int(classes.sum() - classes[4]), int(classes[6]), len(lines) - len(set(lines)), repeated_words(tokens)


def distance(counts: np.ndarray, reference: np.ndarray) -> float:
    """Jensen-Shannon distance of two histograms, base 2."""
    p, q = counts / counts.sum(), reference / reference.sum()
    m = (p + q) / 2

    def part(x: np.ndarray) -> float:
        on = x > 0
        return float((x[on] * np.log2(x[on] / m[on])).sum())

    return float(np.sqrt(max(0.0, (part(p) + part(q)) / 2)))


def counted_languages(docs: DataFrame) -> DataFrame:
    """lang, kind, key, n over all documents: its words (kind 0), character classes (1) and all words together (2)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_memory("rules")  # nothing is kept, but what other work kept goes
        held: dict[str, Counter] = {}
        words = 0
        classes: dict[str, np.ndarray] = {}

        def out() -> Iterator[pa.RecordBatch]:
            rows = [(lang, 0, w, n) for lang, c in held.items() for w, n in c.items()]
            rows += [(lang, 2, b"", sum(c.values())) for lang, c in held.items()]
            rows += [(lang, 1, str(i).encode(), int(n)) for lang, c in classes.items() for i, n in enumerate(c)]
            held.clear()
            classes.clear()
            if rows:
                lang, kind, key, n = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(lang), pa.array(kind, pa.int32()), pa.array(key, pa.binary()), pa.array(n, pa.int64())], ["lang", "kind", "key", "n"]
                )

        for batch in batches:
            for lang, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                of_lang = held.setdefault(lang, Counter())
                words -= len(of_lang)
                of_lang.update(data.split())
                words += len(of_lang)
                classes[lang] = classes.get(lang, 0) + class_counts(data)
                if words + len(held) > FLUSH:
                    yield from out()
                    words = 0
        yield from out()

    lang = F.coalesce("lang", F.lit("")).alias("lang")
    counts = docs.select(lang, text_bytes(F.col("text")).alias("data")).mapInArrow(count, "lang string, kind int, key binary, n long")
    return counts.groupBy("lang", "kind", "key").agg(F.sum("n").alias("n"))


def reference(parts: list, common_words: int) -> tuple[np.ndarray, dict[bytes, int], np.ndarray, int]:
    """Class counts, common words with their places, their counts with all others last, and the number of words."""
    classes, common, words = np.zeros(N_CLASSES), [], 0
    for kind, key, n in ((p["kind"], p["key"], p["n"]) for p in parts):
        if kind == 2:
            words = n
        elif kind == 1:
            classes[int(bytes(key))] = n
        else:
            common.append((-n, bytes(key)))
    common = sorted(common)[:common_words]
    counts = [-n for n, _ in common]
    return classes, {w: i for i, (_, w) in enumerate(common)}, np.array([*counts, words - sum(counts)], float), words


@dataclass(frozen=True)
class References:
    """Per language one reference: those of most words in `held`, all others as rows (lang, parts)."""

    held: dict[str, tuple]
    others: DataFrame | None
    common_words: int


def references(docs: DataFrame, common_words: int = 40, held_languages: int = 1000) -> References:
    """Counted over all documents. What tasks hold is bounded: the references of the languages of most
    words, at most held_languages; documents of all others meet theirs by a join on the language."""
    by_count = Window.partitionBy("lang", "kind").orderBy(F.desc("n"), "key")
    top = counted_languages(docs).withColumn("place", F.row_number().over(by_count)).filter(F.col("place") <= max(common_words, N_CLASSES))
    # At most common_words + N_CLASSES + 1 parts a language.
    table = written(top.groupBy("lang").agg(F.collect_list(F.struct("kind", "key", "n")).alias("parts"), F.max(F.when(F.col("kind") == 2, F.col("n"))).alias("words")))
    most = table.orderBy(F.desc_nulls_last("words"), "lang").limit(held_languages).collect()
    refs = References({}, None, common_words)
    refs.held.update({r.lang: reference(r.parts, common_words) for r in most})
    if len(most) < held_languages or table.count() == len(most):
        return refs
    return replace(refs, others=table.filter(~F.col("lang").isin(list(refs.held))).select("lang", "parts"))


SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, char_distance double, word_distance double"
)


@dataclass(frozen=True)
class Rules:
    """The limits and guards of the distance rules."""

    max_char_distance: float = 0.26
    max_word_distance: float = 0.48
    min_chars: int = 200
    min_words: int = 50
    min_reference_words: int = 1000

    def verdict(self, known: tuple | None, data: bytes) -> tuple:
        """The columns of SCHEMA after the id, for one text and its language's reference."""
        tokens, chars, symbols, lines, repeats = base_counts(data)
        n = len(tokens)
        failed = n < 50 or 100 * repeats > 50 * n
        by_char = by_word = None
        if known and known[3] >= self.min_reference_words:
            classes, places, common, _ = known
            if chars >= self.min_chars:
                by_char = distance(class_counts(data).astype(float), classes)
            if n >= self.min_words:
                seen = np.zeros(len(places) + 1)
                for w, k in Counter(tokens).items():
                    seen[places.get(w, -1)] += k
                by_word = distance(seen, common)
        bad = (by_char or 0.0) > self.max_char_distance or (by_word or 0.0) > self.max_word_distance
        return n, chars, symbols, lines, repeats, failed, not failed and not bad, by_char, by_word


def _per_language(docs: DataFrame, refs: References, apply: Callable[[DataFrame, Callable], DataFrame]) -> DataFrame:
    """apply(rows, reference of a batch) to documents of held languages, and of all others joined with theirs.

    docs have a column lang_key; the joined ones also `parts`.
    """
    held, common_words = refs.held, refs.common_words
    if refs.others is None:
        return apply(docs, lambda batch: [held.get(x) for x in batch.column("lang_key").to_pylist()])
    common = F.col("lang_key").isin(list(held))
    rest = docs.filter(~common).join(refs.others.withColumnRenamed("lang", "lang_key"), "lang_key")

    def joined(batch: pa.RecordBatch) -> list[tuple]:
        made: dict[str, tuple] = {}
        for lang, parts in zip(batch.column("lang_key").to_pylist(), batch.column("parts").to_pylist()):
            if lang not in made:
                made[lang] = reference(parts, common_words)
        return [made[x] for x in batch.column("lang_key").to_pylist()]

    ours = apply(docs.filter(common), lambda batch: [held[x] for x in batch.column("lang_key").to_pylist()])
    return ours.unionByName(apply(rest, joined))


def judge(docs: DataFrame, reference_options: dict | None = None, **limits) -> DataFrame:
    """One row per document: base counts, distances (null where a guard holds) and the verdict."""
    rules, refs = Rules(**limits), references(docs, **(reference_options or {}))

    def apply(df: DataFrame, references_of: Callable) -> DataFrame:
        def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    ids, texts = batch.column("doc_id").to_pylist(), batch.column("data").to_pylist()
                    columns = [ids, *zip(*(rules.verdict(known, data) for known, data in zip(references_of(batch), texts)))]
                    kinds = [pa.int64()] * 6 + [pa.bool_()] * 2 + [pa.float64()] * 2
                    names = [field.split()[0] for field in SCHEMA.split(", ")]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

        return df.mapInArrow(rows, SCHEMA)

    slim = docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("lang_key"), text_bytes(F.col("text")).alias("data"))
    return _per_language(slim, refs, apply)


def kept_documents(docs: DataFrame, reference_options: dict | None = None, **limits) -> DataFrame:
    """The rows of docs, all columns, that the rules keep; decided where they are read (other languages: after the join)."""
    rules, refs = Rules(**limits), references(docs, **(reference_options or {}))
    names, kept_columns = docs.columns, StructType([StructField("row", docs.schema)])

    def apply(df: DataFrame, references_of: Callable) -> DataFrame:
        def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                texts = batch.column("row").field("text").to_pylist()
                kept = [rules.verdict(known, (text or "").encode())[6] for known, text in zip(references_of(batch), texts)]
                yield batch.select(["row"]).filter(pa.array(kept, pa.bool_()))

        return df.mapInArrow(rows, kept_columns)

    keyed = docs.select(F.coalesce("lang", F.lit("")).alias("lang_key"), F.struct(*names).alias("row"))
    return _per_language(keyed, refs, apply).select("row.*")
