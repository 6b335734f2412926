"""Quality rules, classifier, toxicity, language model: brute force, limits and odd rows."""

import math
import re
import time
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from dishframe.llm import language_model, quality_classifier, quality_rules, toxicity
from dishframe.llm import plans
from dishframe.llm.labelled import sample
from tests.llm.helpers import FOLDER, documents, frame, odd_rows, prose, texts

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base_of(text):
    words = WORD.findall(text or "")
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    repeated = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    lines = [line for line in (text or "").split("\n") if WORD.search(line)]
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text or ""),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(repeated),
    }


def test_rule_counts_match_brute_force(spark):
    found = plans.op2_quality_rules(spark, FOLDER).collect()
    of = dict(texts(spark))
    assert len(found) == len(of)
    for r in found:
        want = base_of(of[r.doc_id])
        assert {k: r[k] for k in want} == want
        assert r.base_failed == (want["n_words"] < 50 or 100 * want["n_repeat_words"] > 50 * want["n_words"])
        assert not (r.base_failed and r.kept)


def test_rules_bear_odd_rows(spark):
    out = quality_rules.judge(frame(spark, odd_rows())).collect()
    assert len(out) == 8 and {r.doc_id for r in out if not r.base_failed} == {5}
    assert sum(r.doc_id == 6 and r.n_words == 7 for r in out) == 2
    assert quality_rules.judge(frame(spark, [])).count() == 0


def test_wide_vocabulary_takes_the_same_count():
    tokens = [b"%d" % i for i in range(40)] * 2 + [b"a"]
    assert quality_rules.repeated_words(tokens) == base_of(b" ".join(tokens).decode())["n_repeat_words"]


def test_distance_is_zero_for_equal_and_one_for_disjoint():
    assert quality_rules.distance(np.array([1.0, 2]), np.array([2.0, 4])) == 0
    assert math.isclose(quality_rules.distance(np.array([1.0, 0]), np.array([0.0, 3])), 1)


def test_divergent_text_is_rejected_and_short_text_is_not_judged(spark):
    good = [(i, prose(i, 120), "en") for i in range(40)]
    odd = [(100, "### " * 60 + "$$$ %%% " * 40, "en"), (101, "#$% " * 30, "en")]
    out = {r.doc_id: r for r in quality_rules.judge(frame(spark, good + odd)).collect()}
    assert all(out[i].kept for i in range(40)) and not out[100].kept
    assert out[101].char_distance is None  # under the guard


def test_kept_rows_keep_their_columns(spark):
    docs = frame(spark, [(i, prose(i, 120), "en") for i in range(9)] + odd_rows())
    kept = quality_rules.kept_documents(docs)
    assert kept.schema == docs.schema
    verdict = {r.doc_id for r in quality_rules.judge(docs).filter("kept").collect()}
    assert {r.doc_id for r in kept.collect()} == verdict


def test_every_language_is_judged(spark):
    """Languages beyond those that tasks hold get the same verdicts, by a join."""
    rows = [(i, prose(i, 60 + i % 90, 40 + 13 * (i % 7)), f"l{i % 37}") for i in range(400)] + [(1000 + i, f"#### {i}", None) for i in range(3)]
    docs, limits = frame(spark, rows), {"min_reference_words": 200, "max_word_distance": 0.3}
    few = {"held_languages": 2}
    assert quality_rules.references(docs, **few).others.count() == 36
    every = sorted(map(str, quality_rules.judge(docs, **limits).collect()))
    assert sorted(map(str, quality_rules.judge(docs, few, **limits).collect())) == every
    kept = quality_rules.kept_documents(docs, few, **limits)
    assert kept.columns == docs.columns
    verdict = {r.doc_id for r in quality_rules.judge(docs, **limits).filter("kept").collect()}
    assert {r.doc_id for r in kept.collect()} == verdict and 0 < len(verdict) < 400


def test_classifier_separates_labelled_kinds(spark):
    good = [(i, prose(i, 80), "en") for i in range(60)]
    bad = [(100 + i, " ".join(f"zz{j % 7}###" for j in range(80)), "en") for i in range(20)]
    labels = spark.createDataFrame([(i, int(i < 100)) for i, _, _ in (good + bad)[::2]] + [(None, 1), (3, None)], "doc_id long, quality int")
    out = quality_classifier.classify(frame(spark, good + bad), labels).collect()
    assert {r.doc_id for r in out if r.kept} == set(range(60))


def test_classifier_keeps_all_without_labels_and_bears_odd_rows(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    docs = frame(spark, odd_rows())
    assert quality_classifier.classify(docs, labels).filter("kept").count() == 8
    assert quality_classifier.kept_documents(docs, labels).schema == docs.schema
    assert quality_classifier.classify(frame(spark, []), labels).count() == 0


@pytest.mark.parametrize("k", [1, 2, 500, 1999, 2000])
def test_kth_greatest_is_exact(spark, k):
    values = [float(x) for x in np.random.default_rng(0).normal(size=1000)] + [0.25] * 998 + [1e9, -1e9]
    keys = spark.createDataFrame([(v,) for v in values], "key double")
    assert quality_classifier.kth_greatest(keys, k) == sorted(values, reverse=True)[k - 1]


def test_weights_are_sums_of_log_ratios():
    ratio = np.random.default_rng(1).normal(size=quality_classifier.BUCKETS)
    grams = quality_classifier.Grams()
    places = quality_classifier.buckets(b"one two, three", grams)
    assert len(places) == 4 + 3 and math.isclose(ratio[places].sum(), sum(ratio[p] for p in places))
    assert len(quality_classifier.buckets(b"", grams)) == 0


INSULTS = {"fool$": 4.0}


def score_of(text):
    return toxicity.text_score(text.encode(), toxicity.Symbols(INSULTS))


def test_grammar_composes():
    plain = score_of("what a fool.")
    assert plain == 4.0 and score_of("nothing here") == 0 and score_of("") == 0
    assert score_of("you are a fool.") > plain > score_of("that is not a fool.") > 0
    assert score_of("she said fool.") < score_of("she is a fool.")
    assert score_of("i will kill it.") > 0 and score_of("kill the process.") == 0
    assert score_of("you left. a fool.") == plain  # another clause


def test_mere_mentions_score_nothing():
    for text in ("fool", "entry fool, noun", "Fool.", "the word fool is old.", "nothing here. fool. nothing more", "kill", "fool " + "plain " * 40 + "fool"):
        assert score_of(text) == 0, text
    for text in ("fool!", "those fools are fool.", "fool, fool", "Fool. Go now. Fool.", "fool and coward"):
        assert score_of(text) > 0, text
    assert score_of('"she is a fool."') < score_of("she is a fool.")


def test_transducers_match_a_count_of_distances():
    draw = np.random.default_rng(3)
    for _ in range(300):
        tape = "".join(draw.choice(list("ooooitnrwkqbdpxm"), draw.integers(0, 25)))
        want = tape
        for triggers, after, before, letters in toxicity.RULES:
            want = "".join(
                letters[s] if s in letters and any(i != j and -before <= i - j <= after and want[j] in triggers for j in range(len(want))) else s
                for i, s in enumerate(want)
            )
        assert toxicity.rewritten(tape) == want
        assert len(want) == len(tape)


def test_toxicity_of_a_line_of_a_million_words():
    began = time.time()
    assert score_of("plain " * 1_000_000 + "you fool") > 0
    assert score_of("you fool " * 300_000) > 0
    assert time.time() - began < 30


def test_toxicity_learns_and_scores_held_out(spark):
    rows = [(i, f"{prose(i, 20)} {'gobblenik' if i % 3 == 0 else 'fine'} {prose(i + 500, 20)}.", "en") for i in range(240)]
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i, _, _ in rows], "doc_id long, toxic int")
    out = toxicity.score(frame(spark, rows), labels, training=F.col("doc_id") < 160).collect()
    assert len(out) == 240
    assert all(r.predicted == int(r.doc_id % 3 == 0) for r in out if r.doc_id >= 160)


def test_mere_mentions_are_not_predicted(spark):
    """Where labels rest on matched clauses, an unmatched word, repeated far apart, is not enough."""

    def text(i):
        word = ("you gobblenik", "gobblenik", "fine")[0 if i % 3 == 0 else 1 if i % 31 == 1 else 2]
        return f"{prose(i, 20)} {word} {prose(i + 500, 20)}."

    rows = [(i, text(i), "en") for i in range(600)]
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i, _, _ in rows], "doc_id long, toxic int")
    out = toxicity.score(frame(spark, rows), labels, training=F.col("doc_id") < 400).collect()
    mentioned = [r for r in out if r.doc_id % 3 and r.doc_id % 31 == 1]
    assert mentioned and all(r.predicted == 0 for r in mentioned)
    assert all(r.predicted == 1 for r in out if r.doc_id % 3 == 0)


def test_toxicity_bears_odd_rows_and_missing_labels(spark):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    out = toxicity.score(frame(spark, odd_rows()), none).collect()
    assert len(out) == 8 and all(0 <= r.score <= 1 for r in out)
    one = spark.createDataFrame([(5, 0), (5, 0), (6, None), (None, 1)], "doc_id long, toxic int")
    assert toxicity.score(frame(spark, odd_rows()), one).count() == 8
    assert toxicity.score(frame(spark, []), none).count() == 0


def test_sample_is_bounded(spark):
    labels = spark.range(5000).select(F.col("id").alias("doc_id"), F.lit(1).alias("toxic"))
    n = sample(labels, "toxic", 500).count()
    assert 350 < n <= 500


def test_language_model_base_matches_brute_force(spark):
    of = dict(texts(spark))
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in of}

    def tokens(text):
        return (text or "").encode().lower().split() + [b"\n"]

    count = Counter(w for i, t in of.items() if not held[i] for w in tokens(t))
    total, distinct = sum(count.values()), len(count)
    found = plans.op4_language_model(spark, FOLDER).collect()
    assert len(found) == len(of)
    for r in found:
        words = tokens(of[r.doc_id])
        base = sum(math.log10((count[w] + 1) / (total + distinct + 1)) for w in words)
        assert (r.held_out, r.n_tokens, r.train_tokens) == (held[r.doc_id], len(words), total)
        assert r.n_known == sum(count[w] > 0 for w in words)
        assert math.isclose(r.base_score, base, rel_tol=1e-9)
    assert sum(r.score for r in found if r.held_out) > sum(r.base_score for r in found if r.held_out)


def test_language_model_is_normalised():
    counts = np.array([9.0, 5, 4, 1])
    words = [b"\n", b"aa", b"ab", b"ca"]
    shared = np.zeros(language_model.SHARED)
    for w, c in zip(words[2:], counts[2:]):
        shared[language_model.shared_unit(w)] += c + 1
    vocab = language_model.Vocabulary({w: i for i, w in enumerate(words)}, counts, 2, shared, 19, 4)
    p = language_model.Model(len(vocab.unigram)).start(vocab.unigram)
    units = np.arange(len(vocab.unigram))
    whole = 10 ** np.array([language_model.unit_log10(p, np.array([0, 1, 2, u]), np.array([3]))[0] for u in units])
    assert math.isclose(whole.sum(), 1, rel_tol=1e-5)
    inside = sum((c + 1) / (shared[language_model.shared_unit(w)] + 1) for w, c in zip(words[2:], counts[2:]))
    used = {language_model.shared_unit(w) for w in words[2:]}
    assert math.isclose(inside + sum(1 / (shared[u] + 1) for u in used), len(used))


def test_language_model_splits_bytes_as_python_does():
    draw = np.random.default_rng(6)
    signs = [b" ", b"\t", b"\n", b"\v", b"\f", b"\r", b"\x1c", b"\x1f", b"\0", b"\xff", b"A", b"z", "\x85\xa0\u2003\u3000\xc9\u0130".encode()]
    made = [b"".join(signs[i] for i in draw.integers(0, len(signs), draw.integers(0, 9))) for _ in range(5000)]
    of_text = [d.lower().split() + [language_model.END] for d in made]
    data = pa.array([b"left out", *made], pa.binary())[1:]
    assert language_model.split_words(data).to_pylist() == of_text
    runs = list(language_model.chunks(data, 100))
    assert [d for _, run in runs for d in run.to_pylist()] == made and len(runs) > 5
    assert all(data[at].as_py() == run[0].as_py() for at, run in runs)
    words = dict.fromkeys([language_model.END, *(w for ws in of_text for w in ws)])
    shared = np.zeros(language_model.SHARED)
    vocab = language_model.Vocabulary({w: i for i, w in enumerate(list(words)[:50])}, np.ones(50), 20, shared, 9, 9)
    units, at, owner = language_model.streams(language_model.split_words(data), vocab)
    want = [i if (i := vocab.places.get(w, 99)) < 20 else 20 + language_model.shared_unit(w) for ws in of_text for w in ws]
    assert units[at].tolist() == want and owner.tolist() == [i for i, ws in enumerate(of_text) for _ in ws]
    assert units.sum() == sum(want) and (np.diff(at) == np.where(np.diff(owner) > 0, 1 + language_model.CONTEXT, 1)).all()


def made_parameters(units):
    draw = np.random.default_rng(1)
    return {k: draw.normal(0, 1, s).astype(np.float32) for k, s in language_model.Model(units).shapes.items()}


def plain_log10(p, units, at):
    context = [units[at - j - 1] for j in range(language_model.CONTEXT)]
    scores = sum(p["R"][c] * p["C"][j] for j, c in enumerate(context)).astype(float) @ p["V"].T + p["b"]
    return (scores[np.arange(len(at)), units[at]] - np.log(np.exp(scores).sum(1))) / np.log(10)


def test_language_model_normalises_a_context_once(monkeypatch):
    p, summed, plain = made_parameters(20), [], language_model.log_sums
    monkeypatch.setattr(language_model, "log_sums", lambda p, h: summed.append(len(h)) or plain(p, h))
    units, known = np.random.default_rng(2).integers(0, 4, 9000), language_model.Sums()
    at = np.arange(3, len(units))
    for _ in range(2):
        assert np.allclose(language_model.unit_log10(p, units, at, known, step=500), plain_log10(p, units, at), atol=1e-5)
    assert sum(summed) == 4**3  # of 17,994 positions


def test_language_model_recomputes_sums_whose_slot_was_taken():
    p, units = made_parameters(20), np.random.default_rng(2).integers(0, 20, 9000)
    at = np.arange(3, len(units))
    for slots in (1, 7):
        found = language_model.unit_log10(p, units, at, language_model.Sums(slots), step=500)
        assert np.allclose(found, plain_log10(p, units, at), atol=1e-5)
    p["b"] += 200  # beyond e^88
    assert np.allclose(language_model.unit_log10(p, units, at), plain_log10(p, units, at), atol=1e-4)


def test_language_model_step_follows_the_plain_gradient():
    """Against differences of the objective: the sum of log sigmoids of targets and noise."""
    p, draw, log_noise = made_parameters(9), np.random.default_rng(4), np.linspace(-2, 1, 9).astype(np.float32)
    context, target, noise = [draw.integers(0, 9, 50) for _ in range(3)], draw.integers(0, 9, 50), np.array([3, 3, 8, 0])

    def objective(p):
        h = sum(p["R"][c] * p["C"][j] for j, c in enumerate(context))
        scores = h @ p["V"].T + p["b"] - log_noise
        return (-np.log1p(np.exp(-scores[np.arange(50), target])).sum() - np.log1p(np.exp(scores[:, noise])).sum()) / 50

    squares = {k: np.zeros_like(x) for k, x in p.items()}
    wide = {k: x.astype(float) for k, x in p.items()}
    language_model.nce_step({k: x.copy() for k, x in p.items()}, squares, context, target, noise, log_noise, 0.1)
    for k, x in wide.items():
        for i in range(0, x.size, 7):
            moved = []
            for by in (1e-5, -1e-5):
                x.flat[i] += by
                moved.append(objective(wide))
                x.flat[i] -= by
            assert math.isclose(((moved[0] - moved[1]) / 2e-5) ** 2, squares[k].flat[i], rel_tol=2e-3, abs_tol=1e-7)


def test_language_model_bears_odd_rows(spark):
    docs = frame(spark, odd_rows())
    out = language_model.score(docs, training=F.col("doc_id") != 5).collect()
    assert len(out) == 8 and {r.n_tokens for r in out if r.doc_id in (1, 2, 4)} == {1}
    same = [r for r in out if r.doc_id == 6]
    assert same[0] == same[1]
    assert language_model.score(docs, training=F.lit(False)).filter("train_tokens = 0").count() == 8
    assert language_model.score(frame(spark, []), training=F.lit(True)).count() == 0
