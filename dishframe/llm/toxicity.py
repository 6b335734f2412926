"""Toxicity by a weighted finite-state pattern grammar.

Each clause becomes a tape of one symbol per word: insult, threat verb, intent, target, linking verb,
determiner, mention, negation, reporting verb, quotation mark, exclamation, other. Transducers are
composed over the tape. Each counts the words since its trigger up to a fixed reach, so it has finitely
many states, and rewrites the insults or threat verbs it passes: intent before a threat verb makes a
threat; a target near an insult directs it; a linking verb beside it makes it a predicate, a determiner
before it an epithet, an exclamation after it a vocative, a preposition or conjunction beside it a part
of a phrase; neighbouring insults make a row of them. A mention ("the word ...") takes a match back, a
negation just before discounts it, reported or quoted speech discounts it. The clause scores the weights
of the matched symbols. Over the clauses of a text one more transducer matches insults that follow one
another within 30 words. An insult or a threat verb that no pattern matched scores nothing in the
grammar; beside the grammar a tenth of the weight of unmatched insults goes into the curve below, so that
labels which rest on isolated words can still be learned.

Insult terminals are learned from a bounded sample of labelled training rows: whole words and word
beginnings that occur in toxic texts almost only, weighted by their smoothed log odds. Words of the
other classes are fixed lists. The documents' summed clause scores are turned into probabilities by a
logistic curve, fitted on the histogram of scores of all labelled training rows.

Only the text is an input of the score. Defined cases: null and empty texts score as a text without
any match; repeated rows give repeated results; without labels, or with labels of one class only, the
score is the smoothed share of toxic labels; an empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from dishframe.llm.common import text_bytes
from dishframe.llm.labelled import sample, with_label

TARGETS = "you your u ur he she they him her them these those du dich dir ihr euch sie tu te toi vous il elle ils usted ustedes tú ti él ella ellos".split()
NEGATIONS = "not never no isn't aren't don't nicht kein keine nie ne pas jamais nunca tampoco".split()
REPORTS = "said says say wrote called calls told claimed quoted sagte schrieb nannte dit écrit appelé dijo escribió llamó".split()
INTENTS = "will shall gonna going i'll we'll werde werden vais allons voy vamos".split()
THREATS = "kill hurt destroy beat shoot stab töten schlagen tuer frapper matar golpear".split()
LINKS = "is are was were be been being am isn't aren't wasn't ist sind war waren bist bin seid est sont était es son era eres soy fue".split()
DETERMINERS = "a an the this that these such what ein eine einen einer der die das dieser diese dieses solch un une le la les ce cet cette ces quel quelle una el los las este esta ese esa qué".split()
JOINTS = "and or but of in on at for with from by to as und oder aber von mit für auf aus bei zu als et ou mais de du des dans sur pour avec par que qui y o pero del en con por para como".split()
MENTIONS = "word words term terms wort wörter begriff mot mots terme palabra palabras término".split()
QUOTES = "\"“”„«»"
#: Lists of lower rank give way: "isn't" negates, "es" and "la" keep their first class.
CLASS = {
    w: s
    for s, ws in (("p", JOINTS), ("d", DETERMINERS), ("b", LINKS), ("m", MENTIONS), ("t", TARGETS), ("n", NEGATIONS), ("r", REPORTS), ("w", INTENTS), ("k", THREATS))
    for w in ws
}

MATCHED = "IPEVACK"
# Transducers over the tape, applied in this order: trigger symbols, words reached after and before the
# trigger, letters rewritten there one for one.
RULES = (
    ("w", 4, 0, {"k": "K"}),  # intent, then a threat verb: a threat
    ("t", 5, 5, {"i": "I"}),  # a target near an insult: directed
    ("b", 3, 2, {"i": "P"}),  # a linking verb beside it: predicate or subject
    ("d", 2, 0, {"i": "E"}),  # a determiner before it: epithet
    ("x", 0, 3, {"i": "V"}),  # an exclamation after it: vocative
    ("p", 2, 2, {"i": "A"}),  # a preposition or conjunction beside it: part of a phrase
    ("iIPEVA", 4, 4, {"i": "C"}),  # another insult near it: a row of insults
    ("m", 2, 0, {m: "o" for m in MATCHED}),  # mentioned as a word: no match
    ("n", 3, 0, {m: "j" for m in MATCHED}),  # negated
)
REPORT_REACH = 9
INSULT_SYMBOLS = "iIPEVAC"
TIRADE_REACH, TIRADE_FACTOR, LOOSE_FACTOR = 30, 1.0, 0.1
FACTOR = {"I": 1.25, "P": 1.0, "E": 1.0, "V": 1.0, "A": 1.0, "C": 1.0, "K": 1.0, "j": 0.5}
REPORTED_FACTOR, THREAT_WEIGHT = 0.6, 4.0

PREFIXES = range(4, 9)
_LETTERS = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?")
_ENDS = ".!?;:"
BINS, STEP = 200, 0.05


def terms(word: str) -> list[str]:
    """The word itself (closed by $) and its beginnings."""
    return [word + "$"] + [word[:k] for k in PREFIXES if len(word) >= k]


def learned_terms(
    labelled: DataFrame, min_documents: int = 8, min_odds: float = 4.2, max_terms: int = 20_000
) -> dict[str, float]:
    """Insult terminals with their weights; at most max_terms of them, those of greatest support first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = (Counter(), Counter())

        def out() -> pa.RecordBatch:
            rows = [(t, c[0], c[1]) for t in held[0].keys() | held[1].keys() for c in [(held[0][t], held[1][t])]]
            for c in held:
                c.clear()
            return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows), (pa.string(), pa.int64(), pa.int64()))], ["term", "clean", "toxic"])

        for batch in batches:
            for label, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                held[int(label > 0)].update({t for w in set(_LETTERS.findall(data.decode().lower())) for t in terms(w)})
                held[int(label > 0)][""] += 1
                if len(held[0]) + len(held[1]) > 400_000:
                    yield out()
        if held[0] or held[1]:
            yield out()

    counted = labelled.mapInArrow(count, "term string, clean long, toxic long").groupBy("term").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    of_all = counted.filter("term = ''").first()
    if of_all is None or not of_all.clean or not of_all.toxic:
        return {}
    odds = F.log((F.col("toxic") + 0.5) / (of_all.toxic + 1)) - F.log((F.col("clean") + 0.5) / (of_all.clean + 1))
    chosen = counted.filter((F.col("term") != "") & (F.col("toxic") >= min_documents)).withColumn("odds", odds).filter(F.col("odds") >= min_odds)
    return {r.term: r.odds for r in chosen.orderBy(F.desc("toxic"), "term").limit(max_terms).collect()}


class Symbols(dict):
    """White-space delimited chunk (bytes) to (symbol, weight, quoted, ends the clause)."""

    def __init__(self, insults: dict[str, float]) -> None:
        super().__init__()
        self.insults = insults

    def __missing__(self, chunk: bytes) -> tuple[str, float, bool, bool]:
        if len(self) > 400_000:
            self.clear()
        text = chunk.decode().lower()
        symbol, weight = "o", 0.0
        for word in _LETTERS.findall(text):
            found = max((self.insults.get(t, 0.0) for t in terms(word)), default=0.0)
            if found > weight:
                symbol, weight = "i", found
            elif symbol == "o" and word in CLASS:
                symbol = CLASS[word]
        if symbol == "k":
            weight = THREAT_WEIGHT
        self[chunk] = out = (symbol, weight, any(q in text for q in QUOTES), text[-1] in _ENDS)
        return out


def reached(tape: str, triggers: str, after: int, before: int) -> set[int]:
    """Places at most `after` words behind a trigger or `before` words ahead of one; not the trigger's own."""
    at = [i for i, s in enumerate(tape) if s in triggers]
    return {j for i in at for j in range(max(0, i - before), min(len(tape), i + after + 1)) if j != i}


def rewritten(tape: str) -> str:
    for triggers, after, before, letters in RULES:
        if any(s in tape for s in letters):
            near = reached(tape, triggers, after, before)
            tape = "".join(letters.get(s, s) if i in near else s for i, s in enumerate(tape))
    return tape


def clause_score(tape: str, weights: list[float]) -> tuple[float, list[tuple[int, float]]]:
    """The clause's score, and place and weight of its insults; the weight is 0 where a pattern matched."""
    if "i" not in tape and "k" not in tape:
        return 0.0, []
    last = rewritten(tape)
    reported = reached(last, "rq", REPORT_REACH, 0)
    score = sum(FACTOR[s] * weights[i] * (REPORTED_FACTOR if i in reported else 1.0) for i, s in enumerate(last) if s in FACTOR)
    return score, [(i, weights[i] if s == "i" else 0.0) for i, s in enumerate(last) if s in INSULT_SYMBOLS]


def tirade_score(insults: list[tuple[int, float]]) -> tuple[float, float]:
    """Weights of the insults that no clause matched: of those another insult of the text is near, of the others."""
    total = loose = 0.0
    for k, (at, weight) in enumerate(insults):
        if weight and any(abs(at - insults[n][0]) <= TIRADE_REACH for n in (k - 1, k + 1) if 0 <= n < len(insults)):
            total += TIRADE_FACTOR * weight
        else:
            loose += weight
    return total, loose


def text_score(data: bytes, symbols: Symbols) -> float:
    """The grammar's score of a text."""
    return text_scores(data, symbols)[0]


def text_scores(data: bytes, symbols: Symbols) -> tuple[float, float]:
    """Sum of the scores of all clauses and of rows of insults over several clauses; weight of unmatched insults."""
    if not any(symbols[c][0] in "ik" for c in set(data.split())):
        return 0.0, 0.0
    total, start = 0.0, 0
    tape: list[str] = []
    weights: list[float] = []
    insults: list[tuple[int, float]] = []

    def close() -> None:
        nonlocal total, start
        score, found = clause_score("".join(tape), weights)
        total += score
        insults.extend((start + i, w) for i, w in found)
        start += len(tape)
        tape.clear()
        weights.clear()

    for line in data.split(b"\n"):
        for chunk in line.split():
            symbol, weight, quoted, ends = symbols[chunk]
            if quoted:
                tape.append("q")
                weights.append(0.0)
            tape.append(symbol)
            weights.append(weight)
            if ends:
                if chunk.endswith(b"!"):
                    tape.append("x")
                    weights.append(0.0)
                close()
        close()
    row, loose = tirade_score(insults)
    return total + row, loose


def raw_scores(docs: DataFrame, insults: dict[str, float]) -> DataFrame:
    """The docs' columns but data, and raw: the grammar's score and a tenth of what it did not match."""

    def one(data: bytes, symbols: Symbols) -> float:
        matched, loose = text_scores(data, symbols)
        return matched + LOOSE_FACTOR * loose

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        symbols = Symbols(insults)
        for batch in batches:
            at = batch.schema.get_field_index("data")
            raw = [one(d, symbols) for d in batch.column(at).to_pylist()]
            yield batch.remove_column(at).append_column("raw", pa.array(raw, pa.float64()))

    fields = ", ".join(f"{n} {t}" for n, t in docs.dtypes if n != "data")
    return docs.mapInArrow(rows, f"{fields}, raw double")


def logistic(raw: np.ndarray, clean: np.ndarray, toxic: np.ndarray) -> tuple[float, float]:
    """Slope and intercept of P(toxic) over log(1 + raw), by Newton's method with a weak prior."""
    x, n = np.log1p(raw), clean + toxic
    slope, base = 1.0, math.log((toxic.sum() + 1) / (clean.sum() + 1))
    for _ in range(50):
        p = 1 / (1 + np.exp(-(slope * x + base)))
        w, r = n * p * (1 - p), toxic - n * p
        g = np.array([(r * x).sum() - 1e-2 * slope, r.sum()])
        h = np.array([[(w * x * x).sum() + 1e-2, (w * x).sum()], [(w * x).sum(), w.sum() + 1e-9]])
        move = np.clip(np.linalg.solve(h, g), -1, 1)
        slope, base = slope + move[0], base + move[1]
        if abs(move).max() < 1e-9:
            break
    return float(slope), float(base)


def score(
    docs: DataFrame, labels: DataFrame, training: Column | None = None, max_labelled: int = 20_000, threshold: float = 0.3
) -> DataFrame:
    """doc_id, score, predicted for every document.

    labels: doc_id, toxic; `training` says which label rows may be learned from.
    """
    usable = labels.filter(training) if training is not None else labels
    chosen = sample(usable.select("doc_id", "toxic"), "toxic", max_labelled)
    slim = docs.select("doc_id", text_bytes(F.col("text")).alias("data"))
    labelled = with_label(slim, chosen).select("toxic", "data")
    insults = learned_terms(labelled.dropDuplicates())
    bins = raw_scores(labelled, insults).groupBy(F.least(F.floor(F.log1p("raw") / STEP), F.lit(BINS - 1)).alias("bin")).agg(
        F.count("*").alias("n"), F.sum((F.col("toxic") > 0).cast("int")).alias("toxic")
    )
    found = bins.collect()
    raw = np.expm1(np.array([STEP * (r["bin"] + 0.5 * (r["bin"] > 0)) for r in found], float))
    toxic = np.array([r["toxic"] for r in found], float)
    clean = np.array([r["n"] for r in found], float) - toxic
    slope, base = logistic(raw, clean, toxic) if len(found) else (0.0, 0.0)
    p = 1 / (1 + F.exp(-(F.log1p("raw") * slope + base)))
    scored = raw_scores(slim, insults).select("doc_id", p.alias("score"))
    return scored.select("doc_id", "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
