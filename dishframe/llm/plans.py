"""The registered queries of this subpackage: each applies its operator to its whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from dishframe.llm import (
    decontamination,
    exact_dedup,
    language_model,
    lexical_search,
    licenses,
    near_duplicates,
    oracles,
    packing,
    quality_classifier,
    quality_rules,
    token_counts,
    toxicity,
    url_filters,
    vector_codes,
)
from dishframe.llm.common import remainder
from dishframe.plans.tables import Catalog, table

catalog = Catalog()


def tokenizer_path(name: str) -> str:
    """Where the installed public tokenizer files are; operators take the path as a parameter."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


@catalog.query(oracles.NEAR_DUPLICATES)
def op1_ngram_jaccard_join(spark, sf):
    return near_duplicates.join(table(spark, sf, "documents"))


@catalog.query(oracles.QUALITY_RULES)
def op2_quality_rules(spark, sf):
    judged = quality_rules.judge(table(spark, sf, "documents"))
    return judged.withColumns({c: F.round(c, 6) for c in ("char_distance", "word_distance")})


@catalog.query(oracles.DECONTAMINATION)
def op3_decontamination(spark, sf):
    return decontamination.contaminated(table(spark, sf, "documents"), table(spark, sf, "benchmark")).select("doc_id", "item_id")


@catalog.query()
def op4_language_model(spark, sf):
    held_out = remainder(F.col("doc_id"), 7) == 2
    scored = language_model.score(table(spark, sf, "documents"), training=~held_out)
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@catalog.query()
def op5_toxicity(spark, sf):
    held_out = remainder(F.col("doc_id"), 4) == 2
    scored = toxicity.score(table(spark, sf, "documents"), table(spark, sf, "labels"), training=~held_out)
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")


@catalog.query(oracles.URL_FILTERS)
def op6_url_filters(spark, sf):
    # The number in a page's path names the document it shows; that document's label is the page's.
    number = F.regexp_extract("url", r"://[^/?#]*/[^?#]*?(\d{1,18})(?:\.html)?/?(?:[?#]|$)", 1)
    pages = table(spark, sf, "pages").select("page_id", "url", F.nullif(number, F.lit("")).cast("bigint").alias("label_key"))
    labels = table(spark, sf, "labels").select(F.col("doc_id").alias("label_key"), (1 - F.col("quality")).alias("bad"))
    return url_filters.judge(pages, labels)


@catalog.query()
def op7_quality_classifier(spark, sf):
    return quality_classifier.classify(table(spark, sf, "documents"), table(spark, sf, "labels"))


@catalog.query(oracles.LICENSES)
def op8_licenses(spark, sf):
    # The documents have no paths of their own: source, language and hundred stand for the directories.
    path = F.concat_ws("/", "source", "lang", (F.col("doc_id") / 100).cast("bigint").cast("string"), F.concat(F.col("doc_id").cast("string"), F.lit(".txt")))
    files = table(spark, sf, "documents").select(F.col("doc_id").alias("file_id"), path.alias("path"), "text")
    return licenses.scan(files).withColumnRenamed("file_id", "doc_id").withColumn("score", F.round("score", 6))


@catalog.query()
def op9_packing(spark, sf):
    return packing.pack(table(spark, sf, "documents"), tokenizer_path("word_bpe_49k.json"))


@catalog.query()
def op10_token_counts(spark, sf):
    return token_counts.count_tokens(table(spark, sf, "documents"), tokenizer_path("byte_bpe_50k.json"))


@catalog.query(oracles.LEXICAL_SEARCH)
def op11_lexical_search(spark, sf):
    return lexical_search.search(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@catalog.query(oracles.EXACT_DEDUP)
def op12_exact_dedup(spark, sf):
    return exact_dedup.mark(table(spark, sf, "documents"))


@catalog.query(oracles.VECTOR_CODES)
def op13_vector_codes(spark, sf):
    return vector_codes.compress(table(spark, sf, "embeddings")).drop("label")
