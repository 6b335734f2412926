"""Size siblings: merge items that differ only in a size word; report near misses."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from dishframe.functions.price import MONEY, dollars
from dishframe.functions.text import let
from dishframe.functions.sizes import size_order, split_size
from dishframe.operators.skew import Heavy, salted_lookup

SIMILARITY = 0.80
# Texts of a block and the most blocks of a section, when all its pairs are looked at.
BLOCK, BLOCKS = 4096, 32
# Half letters in a segment of a text, segments, and 64-bit words for the letter pairs of a segment.
SPAN, SEGMENTS, WORDS = 24, 5, 4


def with_size(items: DataFrame, title: str = "title") -> DataFrame:
    """Add size, residual and the case-free residual key.

    inline() of a one-element array evaluates the split once, wherever the columns are used.
    """
    return items.select("*", F.inline(F.array(split_size(F.col(title))))).withColumn("residual_key", F.lower("residual"))


def size_groups(sized: DataFrame, section: Sequence[str], position: str = "pos", signature: Column | None = None) -> DataFrame:
    """Aggregates of every (section, residual) with at least two sized members.

    Map-side aggregates only, so one dish that fills a third of the table is no problem.
    """
    price = F.coalesce("price_min", F.lit(0).cast(MONEY))
    order = F.struct(size_order(F.col("size")).alias("o"), F.col(position).alias("p"))
    described = F.nullif(F.col("ingredients_or_description"), F.lit(""))
    shape = F.lit("") if signature is None else F.coalesce(signature, F.lit(""))
    return (
        sized.filter(F.col("size").isNotNull())
        .groupBy(*section, "residual_key")
        .agg(
            F.count(F.lit(1)).alias("n_members"),
            F.min(price).alias("floor"),
            F.max(F.coalesce("price_max", F.lit(0).cast(MONEY))).alias("price_max"),
            F.min_by("residual", position).alias("title"),
            F.coalesce(F.min_by(described, F.when(described.isNotNull(), order)), F.lit("")).alias("description"),
            F.min(shape).alias("_low"),
            F.max(shape).alias("_high"),
            F.min(position).alias("first_pos"),
        )
        .filter(F.col("n_members") >= 2)
        .withColumn("shared_structure", F.col("_low") == F.col("_high"))
        .drop("_low", "_high")
    )


def size_options(
    sized: DataFrame, groups: DataFrame, section: Sequence[str], spread: Sequence[str], heavy: Heavy = None
) -> DataFrame:
    """Members of merged items: each size with its price above the group's floor."""
    keys = [*section, "residual_key"]
    members = sized.filter(F.col("size").isNotNull())
    floors = groups.select(*keys, "floor", "shared_structure")
    return salted_lookup(members, floors, keys, spread, "inner", heavy).withColumn("delta", (F.coalesce("price_min", F.lit(0).cast(MONEY)) - F.col("floor")).cast(MONEY))


def unmerged(
    sized: DataFrame, groups: DataFrame, section: Sequence[str], spread: Sequence[str], heavy: Heavy = None
) -> DataFrame:
    """Items that stay as they are: without a size, or the only one with their residual."""
    keys = [*section, "residual_key"]
    merged = groups.select(*keys, F.lit(True).alias("_merged"))
    looked_up = salted_lookup(sized, merged, keys, spread, heavy=heavy)
    return looked_up.filter(F.col("size").isNull() | F.col("_merged").isNull()).drop("_merged")


def normalized_items(sized: DataFrame, section: Sequence[str], spread: Sequence[str], position: str = "pos") -> DataFrame:
    """Merged and untouched items of each section; sized buckets come first, by first appearance."""
    groups = size_groups(sized, section, position)
    merged = groups.select(
        *section,
        F.lit(0).alias("class"),
        F.col("first_pos").alias(position),
        "title",
        F.col("description").alias("ingredients_or_description"),
        dollars(F.col("floor")).alias("price"),
        F.col("floor").alias("price_min"),
        "price_max",
        F.lit(True).alias("size_normalized"),
        "n_members",
    )
    kept = unmerged(sized, groups, section, spread).select(
        *section,
        F.when(F.col("size").isNull(), 1).otherwise(0).alias("class"),
        position,
        "title",
        "ingredients_or_description",
        "price",
        "price_min",
        "price_max",
        F.lit(False).alias("size_normalized"),
        F.lit(1).cast("bigint").alias("n_members"),
    )
    return merged.unionByName(kept)


def merged_documents(sized: DataFrame, section: Sequence[str], position: str = "pos") -> DataFrame:
    """Merged items with their Size group nested, for the menu sink; a dish has few sizes."""
    keys = [*section, "residual_key"]
    groups = size_groups(sized, section, position, F.col("signature"))
    members = size_options(sized, groups, section, [position])
    entry = F.struct(
        size_order(F.col("size")).alias("o"),
        F.col(position).alias("p"),
        F.col("size").alias("name"),
        F.col("delta").alias("price"),
        F.col("price_min").alias("absolute_price"),
        F.col("title").alias("merged_title"),
        F.when(~F.col("shared_structure"), F.col("groups")).alias("nested"),
        F.col("groups").alias("groups"),
        F.col("cross_sell").alias("cross_sell"),
    )
    listed = members.groupBy(*keys).agg(F.collect_list(entry).alias("_m")).withColumn(
        "_m",
        F.array_sort(
            "_m",
            lambda a, b: F.when(F.struct(a["o"], a["p"]) < F.struct(b["o"], b["p"]), F.lit(-1)).otherwise(F.lit(1)),
        ),
    )
    first_per_group = lambda cross: let(
        cross,
        lambda cs: F.transform(
            F.array_distinct(cs["group"]), lambda g: F.element_at(F.filter(cs, lambda c: c["group"] == g), 1)
        ),
    )
    return (
        groups.join(listed, keys)
        .withColumn(
            "size_options",
            F.transform(
                "_m",
                lambda m: F.struct(
                    m["name"].alias("name"),
                    m["price"].alias("price"),
                    m["absolute_price"].alias("absolute_price"),
                    m["nested"].alias("nested"),
                ),
            ),
        )
        .withColumn("shared_groups", F.when(F.col("shared_structure"), F.element_at("_m", 1)["groups"]))
        .withColumn("merged_from", F.transform("_m", lambda m: m["merged_title"]))
        .withColumn("cross_sell", first_per_group(F.flatten(F.transform("_m", lambda m: m["cross_sell"]))))
        .withColumn("price", dollars(F.col("floor")))
        .drop("_m")
    )


def _members(sized: DataFrame, section: Sequence[str], position: str) -> DataFrame:
    """Members of merged items with their delta and their place in size order."""
    groups = size_groups(sized, section, position, F.col("signature"))
    members = size_options(sized, groups, section, [position])
    return members.withColumn("place", F.struct(*[size_order(F.col("size"))[f].alias(f) for f in ("kind", "rank", "size")], F.col(position).alias("pos")))


def merged_options(sized: DataFrame, section: Sequence[str], position: str = "pos") -> DataFrame:
    """Options of merged items in long form: one row per option, however many members an item has.

    (section, residual_key, group_no, group, under, option_no, option, price, absolute_price). Group 0 is
    the Size group: one option per member, priced above the least; its option_no is the member's
    position, `place` its order. If all members have one structure, the first member's groups follow
    once with `under` NULL; else every member's groups hang under its place (`under`). Only the first
    member's groups are taken by an aggregate; no list of members is built.

    sized: with_size columns plus signature, groups array<struct<group, options array<struct<name, price>>>>.
    NULL groups give no rows beside the Size group; NULL and equal signatures count as one structure.
    """
    keys = [*section, "residual_key"]
    members = _members(sized, section, position)
    none = F.lit(None).cast(members.schema["place"].dataType)
    size_rows = members.select(
        *keys, F.lit(0).alias("group_no"), F.lit("Size").alias("group"), none.alias("under"), "place", F.col(position).cast("long").alias("option_no"),
        F.col("size").alias("option"), F.col("delta").alias("price"), F.col("price_min").alias("absolute_price"),
    )
    once = members.filter("shared_structure").groupBy(*keys).agg(F.min_by("groups", "place").alias("groups")).withColumn("under", none)
    nested = members.filter(~F.col("shared_structure")).select(*keys, "groups", F.col("place").alias("under"))

    def options_of(holders: DataFrame) -> DataFrame:
        of_group = holders.select(*keys, "under", F.posexplode("groups").alias("_g", "_group"))
        lines = of_group.select(*keys, "under", "_g", F.col("_group.group").alias("group"), F.posexplode("_group.options").alias("_n", "_o"))
        return lines.select(
            *keys, (F.col("_g") + 1).alias("group_no"), "group", "under", none.alias("place"), F.col("_n").cast("long").alias("option_no"),
            F.col("_o.name").alias("option"), F.col("_o.price").cast(MONEY).alias("price"), F.lit(None).cast(MONEY).alias("absolute_price"),
        )

    return size_rows.unionByName(options_of(once)).unionByName(options_of(nested))


def merged_cross_sells(sized: DataFrame, section: Sequence[str], position: str = "pos") -> DataFrame:
    """Cross-sell groups of merged items, each group name once: the first in size order, with its order `at`.

    (section, residual_key, group, at, cross_sell). Aggregated by name before the exchange. Rows in order of
    `at` are the ordered union; a group without a name is one name; NULL lists give no rows.
    """
    keys = [*section, "residual_key"]
    each = _members(sized, section, position).select(*keys, "place", F.posexplode("cross_sell").alias("_n", "_c"))
    at = F.struct("place", F.col("_n").alias("n"))
    return each.groupBy(*keys, F.col("_c.group").alias("group")).agg(F.min(at).alias("at"), F.min_by("_c", at).alias("cross_sell"))


def lone_residuals(sized: DataFrame, section: Sequence[str]) -> DataFrame:
    """Residuals that occur once in their section, with the title they come from."""
    return (
        sized.filter(F.col("size").isNotNull())
        .groupBy(*section, "residual_key")
        .agg(F.count(F.lit(1)).alias("_n"), F.max("title").alias("title"), F.min("pos").alias("pos"))
        .filter("_n = 1")
        .drop("_n")
    )


def near_misses(lone: DataFrame, section: Sequence[str], threshold: float = SIMILARITY, byte_edits: bool = False) -> DataFrame:
    """Pairs of lone residuals of a section whose edit similarity, 1 - edits / longer length, reaches the threshold.

    Lengths are counted in characters, and so are edits; byte_edits counts edits of UTF-8 bytes, as
    some engines do. A byte edit touches at most one character of either text, so they are never fewer.

    All pairs of a section are looked at, in joins of two blocks of its texts each; no pair becomes a row of an
    exchange. A text has at most BLOCKS + 1 copies there, so the disk grows with the texts, not with their pairs.

    Edits are counted only where the letter pairs allow it. Let at most k edits lie between two texts. Each
    takes two of a text's letter pairs away; any other is in the other text too, and as no more than k
    insertions and deletions lie around it, its distances from the middles of the two texts differ by at
    most k / 2. So at most 2k letter pairs of one text's segments are missing near these segments in
    the other text, in either direction. They are compared as bits of a hash; equal bits only make
    fewer of them missing, so no pair is lost.
    """
    if not 0.75 <= threshold <= 1:
        raise ValueError("below 0.75 short texts can be similar without a common letter pair")
    keyed = lone.filter(F.length("residual_key") >= 3).select(*section, "residual_key", "title", "pos")
    # All columns of the texts are named, so that the counts read the same exchange.
    counts = keyed.groupBy(*section).agg(F.count_if(F.col("title").isNotNull() & F.col("pos").isNotNull()).alias("_n"))
    blocks = F.least(F.ceil(F.col("_n") / BLOCK), F.lit(BLOCKS)).cast("int")
    cut = F.broadcast(counts.filter(F.col("_n") > BLOCK).select(*section, blocks.alias("_blocks")))
    # A little more than the least similarity allows, for the tolerance of the last filter.
    apart = 1 - threshold + 1e-9
    size = F.length("residual_key")
    most = F.floor(apart * size + F.lit(1e-9)).cast("int")
    reach = F.floor(apart / (1 - apart) * size + F.lit(1e-6)).cast("int")
    words = range(SEGMENTS * WORDS)
    spark = lone.sparkSession
    partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
    texts = (
        keyed.select("*", size.alias("n"), most.alias("most"), F.inline(F.array(_segment_bits(F.col("residual_key"), size, reach))))
        .join(cut, list(section), "left")
        .select(*section, "residual_key", "title", "pos", "n", "most", "own", "around", F.expr("coalesce(_blocks, 1) AS _blocks"))
        .withColumn("_block", F.expr("int(pmod(xxhash64(pos), _blocks))"))
        # Both sides read this exchange, so the bits are made once.
        .repartition(partitions, *section, "pos")
    )
    unit = [*section, "_low", "_high"]

    def side(tag: str, low: str, high: str, looped: str, kept: str) -> DataFrame:
        """Copies for all units of a text; the bits that every pair needs are columns."""
        copies = texts.selectExpr("*", f"{low} AS _low").selectExpr("*", f"{high} AS _high")
        return copies.select(
            *unit, *[F.expr(f"{c} AS {c}_{tag}") for c in ("residual_key", "title", "pos", kept)],
            *[F.expr(f"coalesce({c}, 0) AS {c}_{tag}") for c in ("n", "most")],
            *[F.expr(f"coalesce(get({looped}, {w}), 0L) AS {looped}{w}") for w in words],
            # By number: the work of a unit is not in proportion to its bytes, so small partitions stay apart.
        ).repartition(partitions, *unit)

    a = side("a", "_block", "explode(sequence(_block, _blocks - 1))", "own", "around")
    b = side("b", "explode(sequence(0, least(_block, _blocks - 1)))", "_block", "around", "own")
    few_missing = lambda one, other: F.expr(
        " + ".join(f"bit_count({one.format(w)} & ~{other.format(w)})" for w in words) + " <= 2 * greatest(most_a, most_b)"
    )
    once = F.expr("(_low < _high AND pos_a <> pos_b) OR pos_a < pos_b")
    met = a.join(b.hint("merge"), unit).filter(once & few_missing("own{}", "around{}"))
    # Behind this generator the optimizer can't move the dearer tests to the front of the join's condition.
    texts_of = [f"{c}_{tag}" for tag in "ab" for c in ("residual_key", "title", "pos", "n")]
    few = few_missing("get(own_b, {})", "get(around_a, {})")
    met = met.select(*section, F.inline(F.array(F.struct(few.alias("_few"), *texts_of)))).filter("_few")
    # Latin-1 makes one character of each byte.
    symbols = lambda c: F.decode(F.encode(F.col(c), "UTF-8"), "ISO-8859-1") if byte_edits else F.col(c)
    ratio = 1 - F.levenshtein(symbols("residual_key_a"), symbols("residual_key_b")) / F.greatest("n_a", "n_b")
    ordered = lambda c, one, other: F.expr(f"if(pos_a < pos_b, {c}_{one}, {c}_{other})")
    return met.select(
        *section,
        ordered("residual_key", "a", "b").alias("residual_a"), ordered("residual_key", "b", "a").alias("residual_b"),
        ordered("title", "a", "b").alias("title_a"), ordered("title", "b", "a").alias("title_b"), ratio.alias("ratio"),
    ).filter(F.col("ratio") >= threshold - 1e-9)


def _segment_bits(text: Column, size: Column, reach: Column) -> Column:
    """Struct (own, around): bits of the letter pairs in each segment of a text, and in it and its surroundings.

    Segments are laid from the middle of the text, SPAN half letters each; the outer ones go on to its ends.
    The second equal letter pair of a segment has a bit of its own, and so on.
    """
    border = lambda at: F.greatest(F.lit(0), F.least(size - 1, F.shiftright(size + at - SPAN * SEGMENTS // 2 + 1, 1)))

    def segments(grams: Column, reach: Column) -> Column:
        parts = []
        for s in range(SEGMENTS):
            start = border(SPAN * s - reach) if s else F.lit(0)
            end = border(SPAN * (s + 1) + reach) if s < SEGMENTS - 1 else size - 1
            parts.append(F.slice(grams, start + 1, F.greatest(F.lit(0), end - start)))
        return F.flatten(F.transform(F.array(*parts), lambda found: let(bits(found), lambda all: F.array(*[word(all, w) for w in range(WORDS)]))))

    # Sorted, so that a letter pair's number is its distance from the first equal one.
    bits = lambda found: let(
        F.sort_array(found), lambda all: F.transform(all, lambda g, i: F.hash(g, i - F.array_position(all, g)).bitwiseAND(64 * WORDS - 1))
    )
    # A shift of 64-bit words goes by the last six bits.
    word = lambda found, w: F.aggregate(
        found, F.lit(0).cast("bigint"),
        lambda all, bit: F.when(F.shiftright(bit, 6) == w, all.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), bit))).otherwise(all),
    )
    pairs = F.transform(F.sequence(F.lit(1), size - 1), lambda i: F.xxhash64(F.substr(text, i, F.lit(2))))
    return let(pairs, lambda grams: F.struct(segments(grams, F.lit(0)).alias("own"), segments(grams, reach).alias("around")))
