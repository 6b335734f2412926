"""Several raters judging the same results: clean-up, consensus, run accounting, work lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from dishframe.functions.text import or_default, strip
from dishframe.operators.folding import keep_first
from dishframe.operators.skew import Heavy, salted_lookup

# Usefulness labels and their scores.
SCORES = {"none": 0, "low": 1, "medium": 2, "high": 3}


def score_of(label: Column) -> Column:
    pairs = [F.lit(part) for pair in SCORES.items() for part in pair]
    return F.try_element_at(F.create_map(*pairs), label)


def label_of(score: Column) -> Column:
    pairs = [F.lit(part) for label, s in SCORES.items() for part in (s, label)]
    return F.try_element_at(F.create_map(*pairs), score)


def first_votes(judgments: DataFrame, run: Sequence[str] = (), order: Sequence[Column | str] = ("pos",)) -> DataFrame:
    """First judgment of each (run, model, index); one with a bad label still uses up its index."""
    whole = judgments.withColumn("index", F.col("index").cast("string").try_cast("bigint")).filter(
        F.col("index").isNotNull()
    )
    first = keep_first(whole, [*run, "model", "index"], order)
    label = F.lower(strip(F.coalesce("usefulness", F.lit(""))))
    return first.withColumn("usefulness", label).withColumn("score", score_of(label)).filter(F.col("score").isNotNull())


def clean_judgments(judgments: DataFrame, canonical: DataFrame, run: Sequence[str] = (), heavy: Heavy = None) -> DataFrame:
    """Valid votes on known results; title and url come from the canonical row."""
    votes = first_votes(judgments, run).drop("title", "url")
    known = canonical.select(*run, F.col("index").cast("bigint").alias("index"), "title", "url")
    return salted_lookup(votes, known, [*run, "index"], ["model"], "inner", heavy=heavy)


def vote_counts(votes: DataFrame, run: Sequence[str] = ()) -> DataFrame:
    """Counts per result, combined map-side; everything later derives from them."""
    return votes.groupBy(*run, "index").agg(
        F.count(F.lit(1)).alias("judgment_count"),
        F.sum(F.col("score").cast("bigint")).alias("_sum"),
        F.sum((F.col("score") * F.col("score")).cast("bigint")).alias("_squares"),
        *[F.count_if(F.col("usefulness") == label).alias(label) for label in ("high", "medium", "low", "none")],
    )


def consensus(canonical: DataFrame, votes: DataFrame, run: Sequence[str] = ()) -> DataFrame:
    """Average, variance, label, confidence and vote split of every canonical result."""
    rows = canonical.withColumn("index", F.col("index").cast("bigint")).join(
        vote_counts(votes, run), [*run, "index"], "left"
    )
    n, total, squares = F.col("judgment_count"), F.col("_sum"), F.col("_squares")
    average = total / n
    # Integer numerator: exact, and zero when all votes agree.
    variance = (n * squares - total * total) / (n * n)
    rounded = F.greatest(F.lit(0), F.least(F.lit(3), F.bround(average, 0).cast("int")))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    return rows.select(
        *run,
        "index",
        *[c for c in canonical.columns if c in ("title", "url")],
        F.bround(average, 3).alias("avg_score"),
        F.when(n.isNull(), F.lit("none")).otherwise(label_of(rounded)).alias("average_usefulness"),
        F.bround(variance, 3).alias("variance"),
        confidence(n, variance).alias("confidence"),
        zero("judgment_count"),
        zero("high"),
        zero("medium"),
        zero("low"),
        zero("none"),
    )


def confidence(n: Column, variance: Column) -> Column:
    return (
        F.when(F.coalesce(n, F.lit(0)) < 2, F.lit("low"))
        .when(variance <= 0.25, F.lit("high"))
        .when(variance <= 0.75, F.lit("medium"))
        .otherwise(F.lit("low"))
    )


def run_status(models: DataFrame, parsed: DataFrame, errors: DataFrame, keys: Sequence[str] = ("model",)) -> DataFrame:
    """Every expected model with its parsed output, else its error, else a 'not ok' row."""
    keys = list(keys)
    done = parsed.select(*keys, F.lit(True).alias("_parsed"), F.col("elapsed_seconds").alias("_done_s"), "parsed_count")
    failed = errors.select(*keys, F.col("elapsed_seconds").alias("_failed_s"))
    return (
        models.join(done, keys, "left")
        .join(failed, keys, "left")
        .withColumn("ok", F.coalesce("_parsed", F.lit(False)))
        .withColumn("elapsed_seconds", F.when(F.col("ok"), F.coalesce("_done_s", F.lit(0.0))).otherwise(F.coalesce("_failed_s", F.lit(0.0))))
        .drop("_parsed", "_done_s", "_failed_s")
    )


def run_summary(status: DataFrame, run: Sequence[str] = ()) -> DataFrame:
    return status.groupBy(*run).agg(
        F.count(F.lit(1)).alias("models_attempted"),
        F.count_if("ok").alias("models_succeeded"),
        F.count_if(~F.col("ok")).alias("models_failed"),
    )


def work_list(
    inputs: DataFrame, models: Sequence[str], outputs: DataFrame, key: str, retry_errors: bool = False
) -> DataFrame:
    """(input, model) jobs without an output; an error output counts as done unless retried.

    outputs: (<key>, model, is_error). The model list is a literal, so no join builds the grid.
    """
    jobs = inputs.select(key, F.explode(F.array(*[F.lit(m) for m in models])).alias("model"))
    done = outputs if not retry_errors else outputs.filter(~F.col("is_error"))
    return jobs.join(done.select(key, "model").distinct(), [key, "model"], "left_anti")


def resume(previous: DataFrame, wanted: DataFrame, key: str, payload: str) -> tuple[DataFrame, DataFrame]:
    """(finished rows of an earlier run, rows still to fetch)."""
    finished = previous.filter(F.col(key).isNotNull() & F.col(payload).isNotNull())
    return finished, wanted.join(finished.select(key).distinct(), key, "left_anti")


def eligible_models(catalog: DataFrame, max_input_cost: float, provider: str, modality: str = "text") -> DataFrame:
    return catalog.filter(
        (F.col("pricePerMillionInputTokens") <= max_input_cost)
        & (F.col("provider") == provider)
        & F.array_contains("inputModalities", modality)
    )


def expand_results(documents: DataFrame, key: Sequence[str]) -> DataFrame:
    """Search results of every page in reading order; the top-level list only where pages are empty.

    Row-local: page and result positions become a dense index inside the document.
    """
    from_pages = F.flatten(
        F.transform(
            F.coalesce("pages", F.array().cast(documents.schema["pages"].dataType)),
            lambda p: F.transform(
                p["results"],
                lambda r: F.struct(
                    p["page"].alias("page"), r["index"].alias("page_index"), or_default(r["title"], "").alias("title"),
                    or_default(r["url"], "").alias("url"), or_default(r["text"], "").alias("text"),
                ),
            ),
        )
    )
    top = F.transform(
        "results",
        lambda r: F.struct(
            r["page"].alias("page"), r["index"].alias("page_index"), or_default(r["title"], "").alias("title"),
            or_default(r["url"], "").alias("url"), or_default(r["text"], "").alias("text"),
        ),
    )
    pages = F.filter(from_pages, lambda r: r.isNotNull())
    chosen = F.when(F.size(pages) > 0, pages).otherwise(top)
    return (
        documents.select(*key, F.posexplode(chosen).alias("_i", "_r"))
        .select(*key, (F.col("_i") + 1).alias("index"), "_r.*")
    )
