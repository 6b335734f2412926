"""Jaccard join, decontamination, URL filters, licences, packing, token counts and the pipeline."""

import random
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from dishframe.llm import common, cutting_stock, decontamination, licenses, near_duplicates, oracles, packing, plans, token_counts, url_filters
from dishframe.llm.components import components
from dishframe.llm.pieces import BytePretokens, WordIds, byte_letters, runs
from tests.llm.helpers import FOLDER, documents, frame, odd_rows, prose, texts

WORD_FILE, BYTE_FILE = str(public_tokenizers.path("word_bpe_49k.json")), str(public_tokenizers.path("byte_bpe_50k.json"))


def shingle_set(text):
    words = (text or "").encode().lower().split()
    span = min(5, len(words))
    return frozenset(tuple(words[i : i + span]) for i in range(len(words) - span + 1)) if words else frozenset()


def brute_join(rows):
    """Links and class of every row, by comparing all pairs that share a shingle."""
    sets, root, links = [shingle_set(t) for _, t in rows], list(range(len(rows))), Counter()

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in combinations(range(len(rows)), 2):
        both = len(sets[i] & sets[j])
        if both and both >= 0.8 * len(sets[i] | sets[j]) - 1e-9:
            links[i] += 1
            links[j] += 1
            a, b = find(i), find(j)
            low, high = (a, b) if rows[a][0] <= rows[b][0] else (b, a)
            root[high] = low
    return sorted((rows[i][0], rows[find(i)][0], links[i]) for i in range(len(rows)))


def test_join_matches_brute_force(spark):
    rows = texts(spark)
    assert sorted(map(tuple, plans.op1_ngram_jaccard_join(spark, FOLDER).collect())) == brute_join(rows)


def near_copies(n, length=150, changes=4):
    base = prose(11, length, 10_000).split()
    out = []
    for i in range(n):
        draw, words = random.Random(i), list(base)
        for _ in range(draw.randrange(changes)):
            words[draw.randrange(length)] = f"x{i}"
        out.append((i, " ".join(words)))
    return out


def test_large_group_is_verified_in_blocks(spark):
    rows = near_copies(60)
    out = near_duplicates.join(frame(spark, [(i, t, "en") for i, t in rows]), block=8).collect()
    assert sorted(map(tuple, out)) == brute_join(rows)


def test_join_bears_odd_rows(spark):
    docs = frame(spark, odd_rows() + [(None, "the cat sat on the mat again", "en"), (9, "THE cat sat on the mat again", "en")])
    out = sorted((tuple(r) for r in near_duplicates.join(docs).collect()), key=str)
    assert [r for r in out if r[0] in (6, 7, 9)] == [(6, 6, 3), (6, 6, 3), (7, 6, 3), (9, 6, 3)]
    assert [r for r in out if r[0] in (1, 2, 4)] == [(1, 1, 0), (2, 2, 0), (4, 4, 0)]
    assert (None, None, 0) in out and len(out) == 10
    left = near_duplicates.one_of_each(docs)
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.filter("doc_id is not null").collect()) == [1, 2, 3, 4, 5, 6]
    assert near_duplicates.join(frame(spark, [])).count() == 0


def test_prefix_is_shortened_to_the_target_recall():
    depth = near_duplicates.prefix_depth(0.8, 24, 10, 0.999)
    assert 1 - (1 - 0.8**depth) ** 24 >= 0.999 > 1 - (1 - 0.8 ** (depth + 1)) ** 24


def test_components_of_chains_and_stars(spark):
    pairs = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 120)] + [(200, 201), (201, 200)]
    found = dict(map(tuple, components(spark.createDataFrame(pairs, "node long, other long")).collect()))
    assert {found[i] for i in range(41)} == {0} and {found[i] for i in range(100, 120)} == {100}
    assert found[201] == 200 and len(found) == 41 + 20 + 2
    assert components(spark.createDataFrame([], "node long, other long")).count() == 0


def items(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def test_decontamination_matches_brute_force(spark):
    def tokens(text):
        return "".join(c if c.isalnum() else " " for c in text.lower()).split()

    bench = [(r.item_id, tokens(r.text)) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    whole = set()
    for i, text in texts(spark):
        held = f" {' '.join(tokens(text))} "
        whole |= {(i, item) for item, words in bench if f" {' '.join(words)} " in held}
    found = {(r.doc_id, r.item_id) for r in plans.op3_decontamination(spark, FOLDER).collect()}
    assert whole and whole == found


def test_substitutions_are_tolerated_and_short_overlaps_are_not(spark):
    words = prose(3, 40, 10_000).split()
    changed = [w if k % 9 else "other" for k, w in enumerate(words)]
    docs = [
        (1, f"{prose(4, 300)} {' '.join(words)} {prose(5, 300)}", "en"),
        (2, f"{prose(6, 50)}, {' '.join(changed).upper()}. {prose(7, 5)}", "en"),
        (3, f"{prose(8, 200)} {' '.join(words[:8])} {prose(9, 200)}", "en"),
        (4, " ".join(words[:20]), "en"),
    ]
    bench = items(spark, [(7, " ".join(words)), (8, None), (9, ""), (10, "too short"), (None, " ".join(words))])
    found = {(r.doc_id, r.item_id) for r in decontamination.contaminated(frame(spark, docs + odd_rows()), bench).collect()}
    assert found == {(1, 7), (2, 7), (4, 7)}
    clean = decontamination.clean_documents(frame(spark, docs), bench)
    assert [r.doc_id for r in clean.collect()] == [3]


def in_sql(statement, **tables):
    """The statement's rows from DuckDB, inside this process."""
    duckdb = pytest.importorskip("duckdb")
    with duckdb.connect() as db:
        for name, (columns, rows) in tables.items():
            db.execute(f"CREATE TABLE {name} ({columns})")
            db.executemany(f"INSERT INTO {name} VALUES ({', '.join('?' * len(rows[0]))})", rows)
        return db.execute(statement).fetchall()


def test_items_that_share_a_passage_are_all_found_at_any_alignment(spark):
    shared = [f"s{k}" for k in range(12)]
    longer = [*prose(21, 13, 10_000).split(), *shared, *prose(22, 13, 10_000).split()]
    bench = [(1, " ".join(longer)), (2, " ".join([*prose(23, 20, 10_000).split(), *shared])), (3, " ".join(prose(24, 30, 10_000).split()))]
    docs = [(k, " ".join([*prose(30 + k, k + 1, 10_000).split(), *longer, *bench[2][1].split()])) for k in range(8)]
    whole = set(in_sql(oracles.DECONTAMINATION, documents=("doc_id BIGINT, text VARCHAR", docs), benchmark=("item_id BIGINT, text VARCHAR", bench)))
    assert whole == {(k, item) for k in range(8) for item in (1, 2, 3)}
    for options in ({}, {"bits": 7}):  # at 7 bits nearly every position is known to the table
        found = decontamination.contaminated(frame(spark, [(i, t, "en") for i, t in docs]), items(spark, bench), **options)
        assert {(r.doc_id, r.item_id) for r in found.collect()} == whole


def test_the_bit_table_grows_with_the_seeds():
    assert [decontamination.bits_for(n) for n in (0, 17_640, 100_000, 200_000, 10**9)] == [20, 20, 23, 24, 24]


def test_decontamination_of_empty_tables(spark):
    assert decontamination.contaminated(frame(spark, []), items(spark, [(1, prose(1, 30))])).count() == 0
    assert decontamination.contaminated(frame(spark, odd_rows()), items(spark, [])).count() == 0


@pytest.mark.parametrize(
    "url, host, path, rule, verdict",
    [
        ("https://Www.Example.com/en/a?x#y", "www.example.com", "/en/a", "www.example.com/en/", "allow"),
        ("http://blog.example.com/en/", "blog.example.com", "/en/", "example.com/en/", "block"),
        ("http://example.community/en/", "example.community", "/en/", None, "allow"),
        ("http://a.net/es/1", "a.net", "/es/1", "net/es/", "block"),
        ("http://a.net", "a.net", "", None, "allow"),
        ("ftp://com/x", "com", "/x", "com/", "allow"),
        ("no scheme", "", "", None, "allow"),
        (None, "", "", None, "allow"),
        ("", "", "", None, "allow"),
    ],
)
def test_rules(spark, url, host, path, rule, verdict):
    pages = spark.createDataFrame([(1, url, None)], "page_id long, url string, label_key long")
    labels = spark.createDataFrame([], "label_key long, bad int")
    r = url_filters.judge(pages, labels).first()
    assert (r.host, r.path, r.rule, r.verdict) == (host, path, rule, verdict)


def test_bad_templates_are_rejected(spark):
    rows = [(i, f"http://h.org/{'spam' if i % 2 else 'news'}/{i}", i) for i in range(200)]
    pages = spark.createDataFrame(rows + [(0, rows[0][1], 0)], "page_id long, url string, label_key long")
    labels = spark.createDataFrame([(i, i % 2) for i in range(0, 150)] + [(None, 1), (3, None)], "label_key long, bad int")
    out = url_filters.judge(pages, labels).collect()
    assert len(out) == 201 and all(r.verdict == ("block" if "spam" in r.path else "allow") for r in out)
    assert {r.template for r in out} == {"/spam/*", "/news/*"}
    assert url_filters.judge(pages.limit(0), labels).count() == 0


def test_bad_branches_of_wide_and_deep_hosts_are_rejected(spark):
    wide = [(i, f"http://wide.org/s{i % 40}/{i}", i, int(i % 40 == 7)) for i in range(1200)]
    deep = [(i, f"http://deep.org/a/b/c/d/{'spam' if i % 2 else 'news'}/{i}", i, i % 2) for i in range(2000, 2200)]
    pages = spark.createDataFrame([r[:3] for r in wide + deep], "page_id long, url string, label_key long")
    labels = spark.createDataFrame([r[2:] for r in wide + deep], "label_key long, bad int")
    out = {r.page_id: r.verdict for r in url_filters.judge(pages, labels).collect()}
    assert out == {i: "block" if bad else "allow" for i, _, _, bad in wide + deep}


def odd_urls():
    """(page_id, url, bad): wide, deep and very long paths, empty segments, hosts without labels, repeated rows."""
    draw, rows = random.Random(4), []
    for i in range(3000):
        kind = i % 6
        bad = int(draw.random() < 0.3)
        if kind == 0:
            path, bad = f"s{i % 30}/{i}", int(i % 30 == 6)
        elif kind == 1:
            path, bad = f"a/b/c/d/{'spam' if i % 4 == 1 else 'news'}/x/{i}", int(i % 4 == 1)
        elif kind == 2:
            path = "/".join(draw.choice(["", "p", "q"]) for _ in range(draw.randrange(5))) + f"/{i}"
        elif kind == 3:
            path, bad = f"user{i}/{'bad' if i % 12 == 3 else 'good'}/{i}.html?x=/y", int(i % 12 == 3)
        else:
            path, bad = f"{draw.choice('mn')}/{i}", None
        rows.append((i, f"http://H{kind}.org/{path}", bad))
    rows += [rows[1], (9001, None, None), (9002, "no scheme", None), (9003, "http://h1.org", None), (9004, "http://trap.org/" + "/".join(["t"] * 500), 1)]
    return rows + [(9100 + i, "http://h1.org/a/b" + "/c" * (200 * (i + 1)), None) for i in range(3)]


def test_url_filters_match_sql_on_odd_paths(spark):
    import duckdb
    import pandas as pd

    rows = odd_urls()
    key = F.nullif(F.regexp_extract("url", r"://[^/?#]*/[^?#]*?(\d{1,18})(?:\.html)?/?(?:[?#]|$)", 1), F.lit("")).cast("bigint")
    pages = spark.createDataFrame([r[:2] for r in rows], "page_id long, url string").withColumn("label_key", key)
    labelled = [(i, bad) for i, _, bad in rows if bad is not None] + [(5, None), (7, 1), (7, 0)]
    labels = spark.createDataFrame(labelled, "label_key long, bad int")
    got = sorted(map(tuple, url_filters.judge(pages, labels).select("page_id", "host", "path", "rule", "verdict", "template").collect()), key=repr)
    con = duckdb.connect()
    con.register("pages", pd.DataFrame([r[:2] for r in rows], columns=["page_id", "url"]))
    con.register("labels", pd.DataFrame([(i, None if b is None else 1 - b) for i, b in labelled], columns=["doc_id", "quality"]).astype({"quality": "Int64"}))
    want = con.execute(f"SELECT page_id, host, path, rule, verdict, template FROM ({oracles.URL_FILTERS})").fetchall()
    assert got == sorted(want, key=repr)
    assert sum(v == "block" for *_, v, _ in got) > 300 and any(t.count("/") > 500 for *_, t in got)


def test_one_long_path_adds_no_rounds(spark, monkeypatch):
    tables = []

    def counted(df):
        tables.append(df.columns)
        return common.written(df)

    monkeypatch.setattr(url_filters, "written", counted)
    rows = odd_urls()
    pages = spark.createDataFrame([(i, u, i) for i, u, _ in rows], "page_id long, url string, label_key long")
    labels = spark.createDataFrame([(i, b) for i, _, b in rows if b is not None], "label_key long, bad int")
    assert url_filters.judge(pages, labels).count() == len(rows)
    assert sum("parts" in columns for columns in tables) <= 8


def test_licences_and_inheritance(spark):
    apache = "Licensed under the Apache License, Version 2.0."
    rows = [
        (1, "a/LICENSE", "This work is licensed under the GNU General Public License, version 3."),
        (2, "a/b/c/x.txt", prose(1, 50)),
        (3, "a/b/y.txt", f"{prose(2, 80)}\n{apache}\n{prose(3, 10)}"),
        (4, "a/d/COPYING", "Released under the MIT License."),
        (5, "a/d/e/z.txt", None),
        (6, "other/q.txt", ""),
        (7, None, "permission slip for the trip"),
        (7, None, "permission slip for the trip"),
    ]
    out = {r.file_id: r for r in licenses.scan(spark.createDataFrame(rows, "file_id long, path string, text string")).collect()}
    assert [out[i].license for i in range(1, 8)] == ["GPL-3.0", "GPL-3.0", "Apache-2.0", "MIT", "MIT", None, None]
    assert [out[i].inherited_from for i in range(1, 8)] == [None, "a", None, None, "a/d", None, None]
    assert out[1].license_file and not out[3].license_file
    assert licenses.scan(spark.createDataFrame([], "file_id long, path string, text string")).count() == 0


@pytest.mark.parametrize("others", [0, 3000])
def test_notices_among_other_words_are_found_at_any_table_size(spark, others):
    named = {
        "Copyright 2024 Foo. Released under the MIT License.": "MIT",
        "Released under the MIT License Zorblax": "MIT",
        f"{prose(41, 60)} Licensed under the Apache License, Version 2.0.": "Apache-2.0",
        "Zorblax is released under the new MIT License": "MIT",
        f"{prose(42, 9)} licensed under CC BY-SA 4.0 {prose(43, 9)}": "CC-BY-SA-4.0",
        "// SPDX-License-Identifier: GPL-3.0-or-later": "GPL-3.0",
        "# spdx-license-identifier: (MIT OR Apache-2.0)": "MIT",
        "Released under the license of the house": None,
        f"{prose(44, 20)} copyright {prose(45, 20)}": None,
    }
    rows = [(i, f"d{i}/x.txt", text) for i, text in enumerate(named)]
    rows += [(100 + i, f"e{i}/x.txt", "Released under the MIT License." if i % 9 == 0 else f"copyright holder{i} {prose(i, 6)}") for i in range(others)]
    out = licenses.scan(spark.createDataFrame(rows, "file_id long, path string, text string")).filter("file_id < 100")
    assert {r.file_id: r.own_license for r in out.collect()} == dict(enumerate(named.values()))


def test_licence_lines_are_found_in_whole_table(spark):
    named = {i for i, t in texts(spark) if any(x in (t or "") for x in ("Licensed under", "licensed under", "Released under"))}
    assert {r.doc_id for r in plans.op8_licenses(spark, FOLDER).filter("own_license is not null").collect()} == named


@pytest.mark.parametrize("seed", range(4))
def test_cutting_stock_meets_demand_with_few_bins(seed):
    draw = np.random.default_rng(seed)
    sizes = sorted(draw.choice(np.arange(1, 65), 20, replace=False).tolist())
    demand = draw.integers(1, 400, 20).tolist()
    plan = cutting_stock.solve(sizes, demand, 64)
    used = Counter()
    for pattern, times in plan:
        assert times > 0 and sum(s * n for s, n in pattern.items()) <= 64
        used.update({s: n * times for s, n in pattern.items()})
    assert used == Counter(dict(zip(sizes, demand)))
    _, fractional = cutting_stock.relaxed(np.array(sizes), np.array(demand, float), 64)
    assert sum(t for _, t in plan) <= fractional.sum() + len(sizes)
    assert cutting_stock.solve([], [], 64) == []


def check_packing(pieces, ids_of):
    by_sequence = {}
    for r in pieces:
        ids = ids_of[r.doc_id][r.start : r.start + r.length]
        assert zlib.crc32(np.array(ids, "<u4").tobytes()) == r.ids_crc32 and r.doc_tokens == len(ids_of[r.doc_id])
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for held in by_sequence.values():
        held.sort()
        assert [o for o, _ in held] == [sum(n for _, n in held[:k]) for k in range(len(held))]
        assert sum(n for _, n in held) <= 2048
    assert sorted(by_sequence) == list(range(len(by_sequence)))


def library_ids(rows):
    library = Tokenizer.from_file(WORD_FILE)
    return {i: library.encode(t or "", add_special_tokens=False).ids + [1] for i, t in rows}


def test_packing_round_trip(spark):
    ids_of = library_ids(texts(spark))
    pieces = plans.op9_packing(spark, FOLDER).collect()
    check_packing(pieces, ids_of)
    for i, ids in ids_of.items():
        mine = sorted((r.start, r.length) for r in pieces if r.doc_id == i)
        assert [s for s, _ in mine] == [sum(n for _, n in mine[:k]) for k in range(len(mine))] and sum(n for _, n in mine) == len(ids)


def test_packing_bears_odd_rows(spark):
    rows = odd_rows()
    pieces = packing.pack(frame(spark, rows), WORD_FILE, slice_rows=2).collect()
    check_packing(pieces, library_ids([(i, t) for i, t, _ in rows]))
    assert sum(r.doc_id == 6 for r in pieces) == 2 and sum(r.doc_id == 1 for r in pieces) == 1
    assert packing.pack(frame(spark, []), WORD_FILE).count() == 0


def test_token_counts_match_the_library(spark):
    library = Tokenizer.from_file(BYTE_FILE)
    of = dict(texts(spark))
    found = plans.op10_token_counts(spark, FOLDER).collect()
    assert len(found) == len(of)
    for r in found:
        n = len(library.encode(of[r.doc_id] or "", add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len((of[r.doc_id] or "").encode()), n, n > 1024)


def test_token_counts_bear_odd_rows(spark):
    docs = frame(spark, odd_rows() + [(20, "a<|endoftext|>b  \n\n c", "en")])
    out = {}
    for r in token_counts.count_tokens(docs, BYTE_FILE, common_pretokens=3).collect():
        out.setdefault(r.doc_id, []).append((r.n_bytes, r.n_tokens))
    library = Tokenizer.from_file(BYTE_FILE)
    for i, t, _ in odd_rows() + [(20, "a<|endoftext|>b  \n\n c", "en")]:
        assert set(out[i]) == {(len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids))}
    assert len(out[6]) == 2 and token_counts.count_tokens(frame(spark, []), BYTE_FILE).count() == 0


def test_chunks_give_the_library_ids_for_any_characters():
    word, byte = WordIds(WORD_FILE), BytePretokens(BYTE_FILE)
    by_word, by_byte = Tokenizer.from_file(WORD_FILE), Tokenizer.from_file(BYTE_FILE)
    pool = [chr(c) for c in range(0x260)] + list("日本語́ςΣ​　﻿") + ["<|endoftext|>", "'re", "'S", " ", " ", "\n", "  "]
    draw = random.Random(0)
    for _ in range(3000):
        text = "".join(draw.choice(pool) for _ in range(draw.randint(1, 14)))
        ids = b"".join(word[w] for w in text.encode().split())
        assert ids == np.array(by_word.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        first, rest, special = byte.chunks(text)
        pieces = [p for c in first for p in byte.pieces(c)] + [p for c in rest for p in byte[c]]
        assert special + sum(map(byte.count, pieces)) == len(by_byte.encode(text, add_special_tokens=False).ids)


def library_pretokens(library, text):
    return [p for s in text.split("<|endoftext|>") for p, _ in library.pre_tokenizer.pre_tokenize_str(s)]


def test_columns_are_split_as_by_the_library():
    byte, library, draw = BytePretokens(BYTE_FILE), Tokenizer.from_file(BYTE_FILE), random.Random(1)
    plain = [chr(c) for c in range(0x21, 0x250) if not 0x7F <= c <= 0xA0] + list("’—…€Ωяあア語한、，") + ["'re", " 's", "\n"] + [" ", "  ", "\n\n", "\t "] * 20
    odd = plain + ["<|endoftext|>", "\x00", "\x01", "\x1c", "\u0301", "\u3000", "٣"] * 9
    texts = ["", " ", "\n\n ", "<|endoftext|>"] + ["".join(draw.choice(odd if i % 3 == 0 else plain) for _ in range(draw.randint(0, 14))) for i in range(3000)]
    place, found, special = byte.split(pa.array(texts))
    pretokens = [[] for _ in texts]
    for i, p in zip(place.tolist(), found.to_pylist()):
        pretokens[i].append(byte_letters(p))
    for text, own, n in zip(texts, pretokens, special.tolist()):
        assert sorted(own) == sorted(library_pretokens(library, text)) and n == text.count("<|endoftext|>")


def test_plain_texts_are_split_in_columns_only(monkeypatch):
    """Neither text by text nor chunk by chunk, and in runs of bounded size."""
    byte, library = BytePretokens(BYTE_FILE), Tokenizer.from_file(BYTE_FILE)
    for name in ("chunks", "pieces", "__missing__"):
        monkeypatch.setattr(BytePretokens, name, lambda *_: pytest.fail("a plain text was split in Python"))
    texts = [prose(i, 40, 300) + "\n\nÉté — 12 €, “naïve”  語" for i in range(30)]
    place, found, _ = byte.split(pa.array(texts))
    assert np.bincount(place).tolist() == [len(library_pretokens(library, t)) for t in texts] and len(found) == len(place)
    cut = list(runs(pa.array(texts), 1000))
    assert [t for _, run in cut for t in run.to_pylist()] == texts and [start for start, _ in cut][0] == 0
    assert len(cut) > 1 and all(sum(len(t.encode()) for t in run.to_pylist()[1:]) <= 1000 for _, run in cut)


def test_word_ids_hold_chunks_and_pretokens_in_one_bounded_memory(monkeypatch):
    monkeypatch.setattr("dishframe.llm.pieces.LIMIT", 50)
    word, library = WordIds(WORD_FILE), Tokenizer.from_file(WORD_FILE)
    for i in range(200):
        for text in (f"Kept{i},word{i}.", f"kept{i}", "again,"):
            ids = np.array(library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
            assert word[text.encode()] == ids
            assert len(word) + sum(len(held) for held in vars(word).values() if isinstance(held, dict)) <= 50
    word.clear()
    word.special += ("alone",)
    assert word[b"ALONE"] and b"alone" not in word  # the special string is not the pre-token


def test_pipeline_hands_texts_over_in_small_batches(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": pa.array([batch.num_rows]), "size": pa.array([batch.nbytes])})

    setting = corpus_pipeline.BATCH_SETTING
    docs = frame(spark, [(i, prose(i, 60) * 100, "en") for i in range(400)]).coalesce(1)
    try:
        for given, least, most in (("67108864b", 0, 3 << 20), ("16m", 4 << 20, 16 << 20)):
            spark.conf.set(setting, given)
            corpus_pipeline.rules_stage(spark, docs, FOLDER)
            found = docs.select("text").mapInArrow(sizes, "n long, size long").collect()
            assert sum(r.n for r in found) == 400 and least < max(r["size"] for r in found) < most
    finally:
        spark.conf.unset(setting)


def test_pipeline_follows_the_decisions_of_its_stages(spark):
    docs, kept = documents(spark), {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, FOLDER)
        assert out.columns == docs.columns
        rows = out.collect()
        kept[name] = {r.doc_id for r in rows}
        docs = spark.createDataFrame(rows, docs.schema)
    rules, classifier, groups, clean = kept.values()
    assert rules >= classifier >= groups >= clean and clean
    assert rules == {r.doc_id for r in plans.op2_quality_rules(spark, FOLDER).filter("kept").collect()}
    of = dict(texts(spark))
    assert groups == {c for _, c, _ in brute_join([(i, of[i]) for i in sorted(classifier)])}
    final = corpus_pipeline.run(spark, FOLDER).collect()
    assert {r.doc_id for r in final} == clean
    check_packing(final, library_ids([(i, of[i]) for i in clean]))


def test_pipeline_bears_odd_rows(spark):
    docs = frame(spark, odd_rows() + [(None, prose(2, 200), "en"), (30, prose(2, 200), "en")])
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, FOLDER)
    assert {r.doc_id for r in docs.collect()} >= {5}
    empty = frame(spark, [])
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, FOLDER)
    assert empty.count() == 0


def test_native_operators_plan_no_python(spark):
    pages = plans.op6_url_filters(spark, FOLDER)
    for out in (pages, plans.op3_decontamination(spark, FOLDER), plans.op8_licenses(spark, FOLDER)):
        shown = out._jdf.queryExecution().executedPlan().toString()
        assert not any(x in shown for x in ("Python", "Pandas", "ArrowEval", "MapInArrow", "CartesianProduct", "NestedLoop"))
