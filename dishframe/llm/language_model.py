"""Language-model scores by a log-bilinear model, trained in numpy with noise-contrastive estimation.

Words fall into units: the commonest words are units of their own, all others share hashed units. The
model predicts the next unit from the embeddings of the last three units: their weighted sum times
the unit's output vector, plus a bias, normalised over all units in batched matrix products. Within a
shared unit a word has the share of its smoothed training count, with one slot for unknown words, so
word probabilities are normalised too.

Counts cover all training texts: partial counts per task, one exchange, one written table. Every task
trains on all the training texts it reads, from a common start, and the parameters are averaged by
token counts; a first round over one sixteenth of the texts gives the start of the second. In scoring,
a task normalises a context once and remembers the sum in a table of fixed size, whose lost entries are
computed again. Counts of a bounded number of the commonest words are held by every task; all rarer
words' frequencies are joined to the count table and summed per document.

Defined cases: a null or empty text is its end token alone; repeated rows give repeated results; with
no training text every count is 0 and the model is uniform over its units; an empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from dishframe.llm.common import commonest, text_bytes, written

END = b""  # no word is empty
SHARED, CONTEXT, DIM = 128, 3, 16
GROUP, FLUSH = 200_000, 600_000  # words of a run that is counted or scored, counts held by a task


def shared_unit(word: bytes) -> int:
    """Hashed unit of a word outside the head: words that begin alike share one."""
    return zlib.crc32(word[:2]) % SHARED


def split_words(data: pa.Array) -> pa.ListArray:
    """The words of each text (bytes), A-Z lower-cased, then END."""
    text = pc.ascii_trim_whitespace(pc.ascii_lower(data.cast(pa.string(), safe=False)))
    # Splitting leaves an empty string after a last space, and one for an empty text.
    text = pc.binary_join_element_wise(text, pc.if_else(pc.equal(text, ""), "", " "), "")
    return pc.ascii_split_whitespace(text).cast(pa.list_(pa.binary()))


def chunks(data: pa.Array, words: int = 40_000) -> Iterator[tuple[int, pa.Array]]:
    """Runs of texts of about so many words, with the place of their first."""
    first, room = 0, 0
    for i, size in enumerate(pc.binary_length(data).to_pylist()):
        room += size // 6
        if room > words:
            yield first, data[first : i + 1]
            first, room = i + 1, 0
    if first < len(data):
        yield first, data[first:]


def word_counts(training: DataFrame) -> DataFrame:
    """word, c over all rows of training (column data); the end of a text counts as a word."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []

        def out() -> list[pa.RecordBatch]:
            summed = pa.concat_tables(held).group_by("word", use_threads=False).aggregate([("n", "sum")])
            held.clear()
            return summed.select(["word", "n_sum"]).rename_columns(["word", "n"]).to_batches(max_chunksize=100_000)

        for batch in batches:
            for _, data in chunks(batch.column(0), GROUP):
                counted = split_words(data).flatten().value_counts()
                held.append(pa.table({"word": counted.field("values"), "n": counted.field("counts")}))
                if sum(map(len, held)) > FLUSH:
                    yield from out()
        if held:
            yield from out()

    return training.select("data").mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("c"))


@dataclass
class Vocabulary:
    """Common words with their counts, how many of the first are units, and the shared units' masses."""

    places: dict[bytes, int]
    counts: np.ndarray
    head: int
    shared: np.ndarray
    total: int
    distinct: int

    def __post_init__(self) -> None:
        self.words = pa.array(list(self.places), pa.binary())
        self.unigram = np.concatenate([self.counts[: self.head] + 1.0, self.shared + 1.0])
        self.unigram /= self.unigram.sum()


def vocabulary(counts: DataFrame, head: int, common_words: int) -> Vocabulary:
    total, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    found = {bytes(r.word): r.c for r in counts.filter(F.col("word") == END).union(commonest(counts, "c", common_words)).collect()}
    words = sorted(found, key=lambda w: (w != END, -found[w], w)) or [END]
    c = np.array([found.get(w, 0) for w in words], float)
    head = min(head, len(words))
    unit = (F.crc32(F.substring("word", 1, 2)) % SHARED).cast("int")
    rest = counts.filter(~F.col("word").isin(words[:head])).groupBy(unit.alias("unit")).agg(F.sum(F.col("c") + 1).alias("mass"))
    shared = np.zeros(SHARED)
    for r in rest.collect():
        shared[r["unit"]] = r["mass"]
    return Vocabulary({w: i for i, w in enumerate(words)}, c, head, shared, total, distinct)


class Model:
    """Parameters: context embeddings R, position weights C, output vectors V, biases b."""

    def __init__(self, units: int) -> None:
        self.shapes = {"R": (units, DIM), "C": (CONTEXT, DIM), "V": (units, DIM), "b": (units,)}

    def start(self, unigram: np.ndarray) -> dict[str, np.ndarray]:
        draw = np.random.default_rng(3)
        out = {k: draw.normal(0, 0.3, s).astype(np.float32) for k, s in self.shapes.items()}
        out["C"][:] = 1.0 / CONTEXT
        out["V"] *= 0.1
        out["b"] = np.log(unigram).astype(np.float32)
        return out

    def flat(self, p: dict[str, np.ndarray]) -> np.ndarray:
        return np.concatenate([p[k].ravel() for k in self.shapes])

    def shaped(self, flat: np.ndarray) -> dict[str, np.ndarray]:
        out, at = {}, 0
        for k, s in self.shapes.items():
            n = int(np.prod(s))
            out[k], at = np.asarray(flat[at : at + n], np.float32).reshape(s), at + n
        return out


def _gathered(index: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Sum of the rows that share an index."""
    d = rows.shape[1]
    flat = np.arange(n * d).reshape(n, d).take(index, 0).ravel()
    return np.bincount(flat, rows.ravel(), n * d).reshape(n, d).astype(np.float32)


def _falling(x: np.ndarray) -> np.ndarray:
    """Logistic function of -x, in place; an overflow to infinity gives the right 0."""
    with np.errstate(over="ignore"):
        np.exp(x, out=x)
        x += 1
        return np.reciprocal(x, out=x)


def contexts(units: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
    """The units before each position, the nearest first."""
    return [units.take(at - j - 1) for j in range(CONTEXT)]


def hidden(p: dict[str, np.ndarray], context: list[np.ndarray]) -> np.ndarray:
    return sum((p["R"] * p["C"][j]).take(context[j], 0) for j in range(CONTEXT))


def nce_step(p: dict[str, np.ndarray], squares: dict[str, np.ndarray], context: list[np.ndarray], target: np.ndarray, noise: np.ndarray, log_noise: np.ndarray, rate: float) -> None:
    """One Adagrad step on a batch; the same noise units serve every position of the batch."""
    n, units = len(target), len(p["b"])
    h, bias = hidden(p, context), p["b"] - log_noise
    v, w = p["V"].take(target, 0), p["V"][noise]
    up = _falling(np.einsum("ij,ij->i", h, v) + bias.take(target))[:, None]
    down = h @ -w.T
    down -= bias[noise]
    down = _falling(down)  # its gradient is minus this
    dh = (up * v - down @ w).astype(float)
    g = {"R": np.zeros_like(p["R"]), "C": np.zeros_like(p["C"])}
    g["V"] = _gathered(target, up * h, units) - _gathered(noise, down.T @ h, units)
    g["b"] = (_gathered(target, up, units) - _gathered(noise, (np.ones(n, np.float32) @ down)[:, None], units)).ravel()
    for j in range(CONTEXT):
        of_unit = _gathered(context[j], dh, units)
        g["C"][j] = (of_unit * p["R"]).sum(0)
        g["R"] += of_unit * p["C"][j]
    for k in p:
        step = g[k] / n
        squares[k] += step * step
        p[k] += rate * step / np.sqrt(squares[k] + 1e-10)


def streams(split: pa.ListArray, vocab: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of some texts: units with CONTEXT ends before each text, positions of the words, their texts."""
    words, lengths = split.flatten(), pc.list_value_length(split).to_numpy()
    own = pc.index_in(words, value_set=vocab.words[: vocab.head])
    begin = pc.binary_slice(words, 0, 2).dictionary_encode()
    shared = np.array([vocab.head + shared_unit(w) for w in begin.dictionary.to_pylist()], np.int64)
    owner = np.repeat(np.arange(len(lengths)), lengths)
    at = np.arange(len(words)) + CONTEXT * (owner + 1)
    units = np.zeros(len(words) + CONTEXT * len(lengths), np.int64)  # unit 0 is the end
    own = own.fill_null(-1).to_numpy()
    units[at] = np.where(own >= 0, own, shared.take(begin.indices.to_numpy()))
    return units, at, owner


def train(training: DataFrame, vocab: Vocabulary, start: np.ndarray, batch_size: int = 4096, noise_size: int = 64, rate: float = 0.1) -> np.ndarray:
    """Parameters after one pass of every task over its texts, averaged by tokens."""
    model = Model(len(vocab.unigram))
    shared = training.sparkSession.sparkContext.broadcast(vocab)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = shared.value
        p, seen = model.shaped(start.copy()), 0
        squares = {k: np.zeros_like(x) for k, x in p.items()}
        log_noise = (np.log(vocab.unigram) + np.log(noise_size)).astype(np.float32)
        draw = np.random.default_rng(5)
        for batch in batches:
            for _, data in chunks(batch.column(0)):
                units, at, _ = streams(split_words(data), vocab)
                order = draw.permutation(at)
                for low in range(0, len(order), batch_size):
                    target = order[low : low + batch_size]
                    noise = draw.choice(len(vocab.unigram), noise_size, p=vocab.unigram)
                    nce_step(p, squares, contexts(units, target), units[target], noise, log_noise, rate)
                seen += len(at)
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array([seen], pa.int64()), pa.array([model.flat(p).astype(float)], pa.list_(pa.float64()))], ["n", "p"])

    trained = training.select("data").mapInArrow(run, "n long, p array<double>")
    means = trained.select("n", F.posexplode("p").alias("i", "x")).groupBy("i").agg((F.sum(F.col("x") * F.col("n")) / F.sum("n")).alias("x"))
    out = start.copy()
    for r in means.collect():  # one row a parameter
        out[r.i] = r.x
    return out


def log_sums(p: dict[str, np.ndarray], h: np.ndarray) -> np.ndarray:
    """Natural logarithm of the sum over all units of e^score, for rows of hidden values."""
    scores = h @ p["V"].T
    scores += p["b"]
    most = scores.max(1)  # single precision holds e^88
    scores -= most[:, None]
    np.exp(scores, out=scores)
    return np.log(scores @ np.ones(len(p["b"]), np.float32)) + most


class Sums:
    """Log sums by context. Each context has one slot; another context of that slot takes its place."""

    def __init__(self, slots: int = 1 << 20) -> None:
        self.keys, self.values = np.full(slots, -1, np.int64), np.zeros(slots)

    def of(self, p: dict[str, np.ndarray], context: list[np.ndarray], h: np.ndarray) -> np.ndarray:
        key = np.zeros(len(h), np.int64)
        for units in context:
            key = key * len(p["b"]) + units
        slot = (key * 0x9E3779B1 >> 12) % len(self.keys)
        out = self.values.take(slot)
        lost = np.flatnonzero(self.keys.take(slot) != key)
        if len(lost):
            keys, first, back = np.unique(key[lost], return_index=True, return_inverse=True)
            sums = log_sums(p, h.take(lost[first], 0))
            out[lost] = sums[back]
            self.keys[slot[lost[first]]], self.values[slot[lost[first]]] = keys, sums
        return out


def unit_log10(p: dict[str, np.ndarray], units: np.ndarray, at: np.ndarray, known: Sums | None = None, step: int = 4096) -> np.ndarray:
    """log10 probability of the unit at each position, normalised over all units."""
    out, known = np.empty(len(at)), known or Sums(step)
    for low in range(0, len(at), step):
        positions = at[low : low + step]
        target, context = units.take(positions), contexts(units, positions)
        h = hidden(p, context)
        own = np.einsum("ij,ij->i", h, p["V"].take(target, 0)) + p["b"].take(target)
        out[low : low + step] = (own - known.of(p, context, h)) / np.log(10)
    return out


SCHEMA = "doc_id long, mark long, word binary, n long, n_tokens long, n_known long, base double, model double, copies long"


def partial_scores(docs: DataFrame, vocab: Vocabulary, parameters: np.ndarray) -> DataFrame:
    """Per document one row for each rarer word; the first also carries the sums over the common words."""
    model = Model(len(vocab.unigram))
    shared = docs.sparkSession.sparkContext.broadcast(vocab)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = shared.value
        p, known_sums = model.shaped(parameters), Sums()
        logs, mass = np.log10(vocab.counts + 1), np.log10(vocab.shared + 1)
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for begin, data in chunks(batch.column(2), GROUP):
                split = split_words(data)
                units, at, owner = streams(split, vocab)
                words, lengths, n = split.flatten(), pc.list_value_length(split).to_numpy(), len(data)
                place = pc.index_in(words, value_set=vocab.words).fill_null(-1).to_numpy()
                common, of_unit = place >= 0, units[at]
                log_c = np.where(common, logs[np.maximum(place, 0)], 0.0)
                within = np.where(of_unit >= vocab.head, log_c - mass[np.maximum(of_unit - vocab.head, 0)], 0.0)
                known = np.bincount(owner, common & (vocab.counts[np.maximum(place, 0)] > 0), n)
                base = np.bincount(owner, log_c, n)
                scored = np.bincount(owner, unit_log10(p, units, at, known_sums) + within, n)
                rare_at = np.flatnonzero(~common)
                rare_found = words.take(pa.array(rare_at)).to_pylist()
                ends = np.searchsorted(rare_at, np.cumsum(lengths)).tolist()
                rare_words, times, sizes, low = [], [], [], 0
                for i, high in enumerate(ends, begin):
                    rare = Counter(rare_found[low:high])
                    if not rare:  # a row of its own key, so that such documents spread
                        rare[b" %d" % (ids[i] or 0)] = 0
                    rare_words += rare.keys()
                    times += rare.values()
                    sizes.append(len(rare))
                    low = high
                first, row = np.cumsum(sizes) - sizes, pa.array(np.repeat(np.arange(begin, begin + n), sizes))
                columns = [batch.column(0).take(row), batch.column(1).take(row), pa.array(rare_words, pa.binary()), pa.array(times, pa.int64())]
                for x, kind in ((lengths, np.int64), (known, np.int64), (base, float), (scored, float), (1, np.int64)):
                    once = np.zeros(len(times), kind)
                    once[first] = x
                    columns.append(pa.array(once))
                yield pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in SCHEMA.split(", ")])

    slim = docs.select("doc_id", F.xxhash64("text").alias("mark"), text_bytes(F.col("text")).alias("data"))
    return slim.mapInArrow(rows, SCHEMA)


def score(docs: DataFrame, training: Column, head: int = 128, common_words: int = 100_000) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score; `training` says which rows are learned from."""
    taught = docs.filter(training).select("doc_id", text_bytes(F.col("text")).alias("data"))
    counts = written(word_counts(taught))
    vocab = vocabulary(counts, head, common_words)
    parameters = Model(len(vocab.unigram)).flat(Model(len(vocab.unigram)).start(vocab.unigram))
    parameters = train(taught.filter(F.pmod(F.xxhash64("doc_id"), F.lit(16)) == 0), vocab, parameters)
    parameters = train(taught, vocab, parameters)
    of_word = F.coalesce(F.col("n") * F.log10(F.col("c") + 1), F.lit(0.0))
    summed = (
        partial_scores(docs, vocab, parameters)
        .join(counts, "word", "left")
        .groupBy("doc_id", "mark")
        .agg(
            F.sum("copies").alias("copies"),
            F.sum("n_tokens").alias("n_tokens"),
            F.sum(F.col("n_known") + F.when(F.col("c").isNotNull(), F.col("n")).otherwise(0)).alias("n_known"),
            F.sum(F.col("base") + of_word).alias("base"),
            F.sum(F.col("model") + of_word).alias("model"),
        )
    )
    # Rows that repeat an id and its text were summed together.
    each = summed.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    n_tokens = F.expr("n_tokens div copies")
    log_total = float(np.log10(vocab.total + vocab.distinct + 1))
    return each.select(
        "doc_id",
        n_tokens.alias("n_tokens"),
        F.expr("n_known div copies").alias("n_known"),
        F.lit(vocab.total).cast("long").alias("train_tokens"),
        (F.col("base") / F.col("copies") - n_tokens * F.lit(log_total)).alias("base_score"),
        (F.col("model") / F.col("copies")).alias("score"),
    )
