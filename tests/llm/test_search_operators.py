"""Lexical search, exact duplicates and vector codes against brute force, and the cases they must bear."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from dishframe.llm import exact_dedup, lexical_search, plans, vector_codes
from tests.llm.helpers import FOLDER, documents, frame, odd_rows, prose

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def term_list(text):
    return TERM.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))


def brute_search(docs, items, k=50):
    read = [(i, Counter(found), len(found)) for i, text in docs if (found := term_list(text))]
    n, total = len(read), sum(size for _, _, size in read)
    df = Counter(t for _, tf, _ in read for t in tf)
    out = []
    for item_id, text in items:
        scored = []
        for doc_id, tf, size in read:
            m = 50 + 50 * size * n // total
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * tf[t] // (1000 * tf[t] + 20 * m))
                for t in set(term_list(text)) & tf.keys()
            )
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        out += [(item_id, r, d, -s) for r, (s, _, _, d) in enumerate(sorted(scored, key=lambda x: x[:3])[:k], 1)]
    return sorted(out, key=str)


def searched(docs, items, **more):
    return sorted((tuple(r) for r in lexical_search.search(docs, items, **more).collect()), key=str)


def benchmark(spark, rows):
    full = [(i, text, "x", 1, 2, 3) for i, text in rows]
    return spark.createDataFrame(full, "item_id long, text string, terms string, at long, rank int, doc_id long")


def test_search_matches_brute_force_in_small_tiles(spark):
    docs = [(i, prose(i, 5 + i % 40, 60)) for i in range(150)] + [(150 + i, prose(3, 12, 60)) for i in range(20)]
    items = [(i, prose(1000 + i, 15, 80)) for i in range(12)]
    of_docs = frame(spark, [(i, t, "en") for i, t in docs]).repartition(4)
    expected = brute_search(docs, items, k=7)
    small = {"k": 7, "tile_items": 3, "stretch": 4, "block": 16}
    assert searched(of_docs, benchmark(spark, items), **small) == expected
    # Several groups of items: each is a pass of its own.
    assert searched(of_docs, benchmark(spark, items), group_terms=40, **small) == expected


def test_search_bears_odd_rows(spark):
    long_term = "x" * 5000
    docs = [(i, t) for i, t, _ in odd_rows()] + [
        (None, "the cat sat on the mat again"), (20, f"The CAT {long_term} café Ünï"), (21, "-- !! \x7f"), (None, None)
    ]
    items = [(1, "cat mat"), (1, "cat mat"), (2, None), (3, ""), (None, "again"), (4, "unseen"), (5, f"{long_term.upper()} CAFÉ café"), (6, "ünï Ünï w1")]
    of_docs = frame(spark, [(i, t, "en") for i, t in docs])
    assert searched(of_docs, benchmark(spark, items)) == brute_search(docs, items)
    assert searched(frame(spark, []), benchmark(spark, items)) == []
    assert searched(frame(spark, [(1, None, None)]), benchmark(spark, items)) == []
    assert searched(of_docs, benchmark(spark, [])) == []


def test_search_keeps_ties_by_id(spark):
    rows = [(i, "same words here", "en") for i in random.Random(5).sample(range(1000), 300)] + [(2000 + i, f"other {i}", "en") for i in range(200)]
    out = lexical_search.search(frame(spark, rows), benchmark(spark, [(1, "words")]), k=10, block=16).orderBy("rank").collect()
    assert [r.doc_id for r in out] == sorted(i for i, _, _ in rows if i < 1000)[:10]


def test_partial_sums_stay_exact():
    weights = np.full(5, 1 << 40, np.int64)
    tile = lexical_search.Tile([0], [np.arange(5)], weights, 4096)
    assert tile.stretch * (1 << 40) * 10**6 < 1 << 53 or tile.stretch == 1
    weights = np.full(9000, 30_000, np.int64)
    tile = lexical_search.Tile([0], [np.arange(9000)], weights, 10**9)
    got = tile.scores(2, np.repeat([0, 1], 9000), np.tile(np.arange(9000), 2), np.tile(np.full(9000, 999_999), 2))
    assert got.tolist() == [[9000 * 30_000 * 999_999]] * 2


def brute_marks(rows, keep=max):
    groups, seen, out = {}, Counter(), []
    for i, t, *_ in rows:
        groups.setdefault(t or "", []).append(i)
    for i, t, *_ in rows:
        ids = [x for x in groups[t or ""] if x is not None]
        kept_id = keep(ids) if ids else None
        seen[i, t or ""] += 1
        kept = i == kept_id and seen[i, t or ""] == 1
        out.append((i, kept_id, len(groups[t or ""]), kept, hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(out, key=str)


DEDUP_ROWS = odd_rows() + [(None, "alone", None), (None, "no id", "x"), (None, "no id", "x"), (9, "Alone", "en"), (8, "alone ", "en")]


def test_exact_dedup_bears_odd_rows(spark):
    rows = DEDUP_ROWS + [(i, "hot", "en") for i in range(100, 160)]
    docs = frame(spark, rows)
    assert sorted((tuple(r) for r in exact_dedup.mark(docs).collect()), key=str) == brute_marks(rows)
    assert sorted((tuple(r) for r in exact_dedup.mark(docs, keep=F.min).collect()), key=str) == brute_marks(rows, min)
    assert exact_dedup.mark(frame(spark, [])).count() == 0


def test_exact_dedup_splits_collisions(spark):
    docs = frame(spark, DEDUP_ROWS)
    weak = exact_dedup.mark(docs, hashed=lambda text: F.length(text) % 2)
    assert sorted((tuple(r) for r in weak.collect()), key=str) == brute_marks(DEDUP_ROWS)


def test_exact_dedup_normalises_and_returns_documents(spark):
    docs = frame(spark, DEDUP_ROWS)
    folded = exact_dedup.mark(docs, normalise=lambda t: F.lower(F.trim(t))).filter("doc_id in (3, 8, 9)").collect()
    assert {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in folded} == {(3, 9, 4, False), (8, 9, 4, False), (9, 9, 4, True)}
    left = exact_dedup.one_of_each(docs)
    assert left.columns == docs.columns
    ids = sorted(r.doc_id for r in left.filter("doc_id is not null").collect())
    assert ids == [2, 3, 4, 5, 7, 8, 9]
    assert left.filter("doc_id is null").count() == 3


def test_exact_dedup_is_native_and_combines_before_the_exchange(spark):
    of_text = exact_dedup.classes(documents(spark).select("doc_id", "text"), F.max, exact_dedup.content_hash)
    for df in (plans.op12_exact_dedup(spark, FOLDER), of_text):
        shown = df._jdf.queryExecution().executedPlan().toString()
        assert not any(x in shown for x in ("Python", "Pandas", "ArrowEval", "MapInArrow", "CartesianProduct", "NestedLoop"))
    assert "partial_max(doc_id" in shown and "partial_count(1)" in shown


def brute_codes(rows, parts=4, entries=256, rounds=4):
    kept = [(i, v, l) for i, v, l in rows if v and len(v) % parts == 0 and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    dims = len(kept[0][1])
    kept = [(i, [math.floor(1024 * x) for x in v], l) for i, v, l in kept if len(v) == dims]
    width = dims // parts
    cut = [[v[p * width : (p + 1) * width] for _, v, _ in kept] for p in range(parts)]
    books = [part[:entries] for part in cut]

    def nearest(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, e)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            of = [nearest(x, books[p])[1] for x in cut[p]]
            for e in range(len(books[p])):
                if mine := [x for x, k in zip(cut[p], of) if k == e]:
                    books[p] = [*books[p][:e], [sum(c) // len(mine) for c in zip(*mine)], *books[p][e + 1 :]]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    coded = []
    for r, (i, _, label) in enumerate(kept):
        found = [nearest(cut[p][r], books[p]) for p in range(parts)]
        coded.append((i, "".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found), label))
    total = Counter()
    for _, _, error, label in coded:
        total[label] += error
    return sorted(((i, c, e, total[l], digest) for i, c, e, l in coded), key=str)


def vectors(spark, rows):
    full = [(i, v, l, "x", 5) for i, v, l in rows]
    return spark.createDataFrame(full, "vec_id long, embedding array<float>, label int, vector string, error int")


def compressed(df, **more):
    out = vector_codes.compress(df, **more).select("vec_id", "code", "error", "label_error", "codebooks_sha256")
    return sorted((tuple(r) for r in out.collect()), key=str)


def draw_vectors(seed, n, dims, scale=1.0):
    draw = np.random.default_rng(seed)
    return [[float(np.float32(x)) for x in row] for row in draw.normal(size=(n, dims)) * scale]


def test_codes_match_brute_force(spark):
    drawn = draw_vectors(1, 400, 8, 0.05)
    rows = [(i * 7 % 401, v, [None, 1, 2][i % 3]) for i, v in enumerate(drawn)]
    # Ties: vectors on a coarse grid, many of them equal.
    rows += [(1000 + i, [round(x * 8) / 8 for x in v], 1) for i, v in enumerate(draw_vectors(2, 100, 8, 0.2))]
    assert compressed(vectors(spark, rows).repartition(5), entries=32) == brute_codes(rows, entries=32)


def test_codes_bear_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, v, i % 2) for i, v in enumerate(draw_vectors(3, 30, 4))]
    rows += [(3, [1.0, 2.0, 3.0, 4.0], None), (None, [0.0, 0.5, -0.5, 1.0], None), (40, None, 1), (41, [1.0, None, 2.0, 3.0], 1)]
    rows += [(42, [nan, 0.0, 0.0, 0.0], 1), (43, [inf, 0.0, 0.0, -inf], 1), (44, [], 1), (45, [1.0] * 8, 1), (46, [1.0] * 5, 1)]
    assert compressed(vectors(spark, rows)) == brute_codes(rows)
    assert compressed(vectors(spark, [])) == []
    assert compressed(vectors(spark, rows[31:33])) == brute_codes(rows[31:33])


def test_codes_of_huge_components_are_exact(spark):
    rows = [(i, v, 1) for i, v in enumerate(draw_vectors(4, 40, 4, 1e5) + draw_vectors(5, 10, 4, 0.1))]
    assert compressed(vectors(spark, rows), entries=8) == brute_codes(rows, entries=8)
    top = vector_codes.compress(vectors(spark, [(1, [3e38, 0.0, 0.0, 1.0], 1), (2, [-3e38, 0.0, 1.0, 1.0], 1)]), entries=1).collect()
    assert {r.error for r in top} == {vector_codes.LONGEST} and {r.label_error for r in top} == {vector_codes.LONGEST}


def test_boxes_hold_the_nearest_entry():
    draw = np.random.default_rng(6)
    for n, dims in ((1, 1), (3, 2), (64, 4), (65, 3), (200, 16)):
        entries, points = draw.integers(-50, 50, (n, dims)), draw.integers(-60, 60, (500, dims))
        index, least = vector_codes.Slices(entries).nearest(points)
        full = ((points[:, None] - entries[None]) ** 2).sum(axis=2)
        assert (full.argmin(axis=1) == index).all() and (full.min(axis=1) == least).all()
