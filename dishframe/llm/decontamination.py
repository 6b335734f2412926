"""Benchmark decontamination by spaced-seed hashing.

Fixed masks name the token positions that a seed looks at; the positions between are free, so a seed
survives substitutions there. Seeds of all benchmark items are hashed and joined with the seeds at
every position of every document. A hit fixes an alignment, and the tokens around it (a fixed reach on
both sides) are compared position by position: the best stretch counts +1 for an equal token and
-`penalty` for a substituted one and must reach `min_score`.

DataFrame functions only. The benchmark's seeds also fill a bit table, sized by their number and tested
row-locally with two probes, so that of the documents' seeds only hits (and few others) leave the row.
Every position that the table knows leaves it: which item and alignment it hits is known only after the
exact join, so nothing is thinned before. A fuller table costs more rows, never a pair.

Defined cases: null and empty texts and items have no seeds; tokens are runs of letters and digits,
lower-cased; items of fewer tokens than the shortest mask are no evidence and never match; repeated
rows and extra columns do not matter (one row per document id, item); empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from dishframe.functions.text import let
from dishframe.llm.common import written

MASKS = ("11101011", "110110111", "1110110011")
#: Bits of the table for each seed, and the exponents between which its size is held.
BITS_A_SEED, LEAST_BITS, MOST_BITS = 48, 20, 24


def token_hashes(text: Column) -> Column:
    tokens = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))
    return F.transform(tokens, lambda t: F.xxhash64(t))


def seeds(hashes: Column, mask: str) -> Column:
    """The mask's hash at each position of an array of token hashes."""
    on = [i for i, c in enumerate(mask) if c == "1"]
    last = F.size(hashes) - len(mask)
    places = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    return F.transform(places, lambda p: F.xxhash64(F.lit(mask), *[F.get(hashes, p + i) for i in on]))


def window(hashes: Column, at: Column, reach: int) -> Column:
    """Tokens from `reach` before a position to `reach` after it; null beyond the text's ends."""
    return F.transform(F.sequence(at - reach, at + reach), lambda p: F.when(p >= 0, F.get(hashes, p)))


def best_stretch(ours: Column, theirs: Column, penalty: int) -> Column:
    """Best sum over a stretch of two aligned windows; positions outside either text end a stretch."""
    steps = F.zip_with(ours, theirs, lambda a, b: F.when(a.isNull() | b.isNull(), -1000).when(a == b, 1).otherwise(-penalty))
    first = F.struct(F.lit(0).alias("now"), F.lit(0).alias("best"))

    def step(held: Column, x: Column) -> Column:
        now = F.greatest(F.lit(0), held["now"] + x)
        return F.struct(now.alias("now"), F.greatest(held["best"], now).alias("best"))

    return F.aggregate(steps, first, step, lambda held: held["best"])


def benchmark_seeds(benchmark: DataFrame, masks=MASKS, reach: int = 28) -> DataFrame:
    """seed, item_id, item_at, n_tokens, theirs (window around the seed's position)."""
    hashed = benchmark.select("item_id", token_hashes(F.col("text")).alias("hashes")).filter("item_id is not null")
    found = F.concat(*[F.transform(seeds(F.col("hashes"), m), lambda s, i: F.struct(s.alias("seed"), i.alias("item_at"))) for m in masks])
    return hashed.select("item_id", "hashes", F.explode(found).alias("found")).select(
        "found.seed", "item_id", "found.item_at", F.size("hashes").alias("n_tokens"), window(F.col("hashes"), F.col("found.item_at"), reach).alias("theirs")
    )


def bits_for(n_seeds: int) -> int:
    """The exponent of a table in which two probes let few strange seeds pass (0.2 % until MOST_BITS is reached)."""
    return min(max((BITS_A_SEED * n_seeds - 1).bit_length(), LEAST_BITS), MOST_BITS)


def bit_table(known: DataFrame, bits: int) -> Column:
    """A constant array of 2^bits / 64 longs with two bits set for each seed."""
    words = (1 << bits) // 64
    probe = known.select(F.explode(F.array(*[_slot(F.col("seed"), k, bits) for k in (0, 1)])).alias("slot")).distinct()
    filled = probe.groupBy(F.shiftright("slot", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(slot & 63 as int))")).alias("bits"))
    table = [0] * words
    for r in filled.collect():  # at most `words` rows
        table[r.word] = r.bits
    return F.split(F.lit(",".join(map(str, table))), ",").cast("array<bigint>")


def _slot(seed: Column, k: int, bits: int) -> Column:
    return F.shiftrightunsigned(seed, 2 + 31 * k).bitwiseAND((1 << bits) - 1)


def set_in(table: Column, seed: Column, bits: int) -> Column:
    def one(k: int) -> Column:
        slot = _slot(seed, k, bits)
        word = F.get(table, F.shiftright(slot, 6).cast("int"))
        return F.call_function("shiftrightunsigned", word, slot.bitwiseAND(63).cast("int")).bitwiseAND(1) == 1

    return one(0) & one(1)


def hits(docs: DataFrame, table: Column, bits: int, masks=MASKS, reach: int = 28) -> DataFrame:
    """seed, doc_id, doc_at, ours for the positions whose seeds the bit table knows."""

    def known(table: Column, hashes: Column, mask: str) -> Column:
        def leaving(found: Column) -> Column:
            places = F.when(F.size(found) > 0, F.sequence(F.lit(0), F.size(found) - 1)).otherwise(F.array().cast("array<int>"))
            kept = F.filter(places, lambda p: set_in(table, F.get(found, p), bits))
            return F.transform(
                kept, lambda p: F.struct(F.get(found, p).alias("seed"), p.alias("doc_at"), window(hashes, p, reach).alias("ours"))
            )

        return let(seeds(hashes, mask), leaving)

    # The table is bound once, so that plans hold one copy of it.
    found = let(table, lambda t: let(token_hashes(F.col("text")), lambda hashes: F.concat(*[known(t, hashes, m) for m in masks])))
    return docs.filter("doc_id is not null").select("doc_id", F.explode(found).alias("found")).select("doc_id", "found.*")


def contaminated(
    docs: DataFrame, benchmark: DataFrame, min_score: int = 12, penalty: int = 2, bits: int | None = None, masks=MASKS, reach: int = 28
) -> DataFrame:
    """doc_id, item_id, doc_start (token at which the item would begin), score: one row per pair found.

    An item shorter than min_score tokens must match in all its tokens. The bit table has 2^bits bits;
    without bits, as many as the counted seeds ask for.
    """
    known = written(benchmark_seeds(benchmark.select("item_id", "text"), masks, reach))
    bits = bits_for(known.count()) if bits is None else bits
    table = bit_table(known, bits)
    pairs = hits(docs.select("doc_id", "text"), table, bits, masks, reach).join(known, "seed")
    scored = pairs.select(
        "doc_id",
        "item_id",
        (F.col("doc_at") - F.col("item_at")).alias("doc_start"),
        "n_tokens",
        best_stretch(F.col("ours"), F.col("theirs"), penalty).alias("score"),
    )
    enough = F.col("score") >= F.least(F.lit(min_score), F.col("n_tokens"))
    best = F.max(F.struct("score", (-F.col("doc_start")).alias("back")))
    return (
        scored.filter(enough)
        .groupBy("doc_id", "item_id")
        .agg(best.alias("best"))
        .select("doc_id", "item_id", (-F.col("best.back")).alias("doc_start"), F.col("best.score").alias("score"))
    )


def clean_documents(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of docs, all columns, in which no benchmark item was found."""
    found = written(contaminated(docs, benchmark, **options).select("doc_id").distinct())
    return docs.join(found, "doc_id", "left_anti").select(*docs.columns)
