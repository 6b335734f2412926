"""Rater and comparison queries. Users vote on events, sources print versions of documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from dishframe.functions import price as money
from dishframe.functions import text as tx
from dishframe.operators import comparison, raters, reports
from dishframe.plans.tables import Catalog, table

catalog = Catalog()

VOTES_SQL = """
judgment AS (SELECT event_id % 97 AS index, user_id AS model, event_id AS pos, CASE event_type WHEN 'view' THEN 'none' WHEN 'click' THEN ' Low '
    WHEN 'signup' THEN 'MEDIUM' WHEN 'purchase' THEN 'high' ELSE 'broken' END AS usefulness FROM events),
first_vote AS (SELECT index, model, pos, lower(trim(usefulness)) AS usefulness FROM (SELECT *, row_number() OVER (PARTITION BY model, index ORDER BY pos) AS rn
    FROM judgment) WHERE rn = 1),
vote AS (SELECT *, CASE usefulness WHEN 'none' THEN 0 WHEN 'low' THEN 1 WHEN 'medium' THEN 2 WHEN 'high' THEN 3 END AS score
    FROM first_vote WHERE usefulness IN ('none', 'low', 'medium', 'high')),
canonical AS (SELECT p_size::BIGINT * 2 - 2 AS index, 'title ' || p_size AS title, 'http://x/' || p_size AS url FROM part GROUP BY p_size),
consensus AS (SELECT c.index, c.title, c.url, round_even(sum(score) / count(score), 3) AS avg_score,
    CASE coalesce(round_even(sum(score) / count(score), 0), 0) WHEN 0 THEN 'none' WHEN 1 THEN 'low' WHEN 2 THEN 'medium' ELSE 'high' END AS average_usefulness,
    round_even((count(score) * sum(score * score) - sum(score) * sum(score)) / (count(score) * count(score)), 3) AS variance,
    CASE WHEN count(score) < 2 THEN 'low' WHEN (count(score) * sum(score * score) - sum(score) * sum(score)) / (count(score) * count(score)) <= 0.25 THEN 'high'
      WHEN (count(score) * sum(score * score) - sum(score) * sum(score)) / (count(score) * count(score)) <= 0.75 THEN 'medium' ELSE 'low' END AS confidence,
    count(score) AS judgment_count, count(*) FILTER (usefulness = 'high') AS high, count(*) FILTER (usefulness = 'medium') AS medium,
    count(*) FILTER (usefulness = 'low') AS low, count(*) FILTER (usefulness = 'none') AS none
  FROM canonical c LEFT JOIN vote v ON c.index = v.index GROUP BY ALL)
"""


def judgments(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.col("event_type")
    label = (
        F.when(kind == "view", "none").when(kind == "click", " Low ").when(kind == "signup", "MEDIUM")
        .when(kind == "purchase", "high").otherwise("broken")
    )
    return table(spark, sf, "events").select(
        (F.col("event_id") % 97).alias("index"), F.col("user_id").alias("model"), F.col("event_id").alias("pos"),
        label.alias("usefulness"),
    )


def canonical(spark: SparkSession, sf: str) -> DataFrame:
    """One result per part size: some get votes, some none."""
    size = F.col("p_size")
    return table(spark, sf, "part").select(size).distinct().select(
        (size.cast("bigint") * 2 - 2).alias("index"),
        F.concat(F.lit("title "), size.cast("string")).alias("title"),
        F.concat(F.lit("http://x/"), size.cast("string")).alias("url"),
    )


@catalog.query(f"WITH {VOTES_SQL} SELECT * FROM consensus")
def vote_consensus(spark, sf):
    return raters.consensus(canonical(spark, sf), raters.first_votes(judgments(spark, sf)))


@catalog.query(
    f"""WITH {VOTES_SQL} SELECT v.index, v.model, v.usefulness, v.score, c.title, c.url FROM vote v JOIN canonical c ON v.index = c.index"""
)
def clean_judgments(spark, sf):
    votes = judgments(spark, sf).withColumn("title", F.lit("from the rater")).withColumn("url", F.lit(""))
    return raters.clean_judgments(votes, canonical(spark, sf)).select("index", "model", "usefulness", "score", "title", "url")


@catalog.query(
    f"""WITH {VOTES_SQL} SELECT index, '| ' || index || ' | ' || CASE WHEN avg_score IS NULL THEN '' ELSE printf('%.2f', avg_score) END || ' ' || average_usefulness
      || ' | ' || confidence || ' | ' || high || '/' || medium || '/' || low || '/' || none || ' | ' || title || ' | ' || url || ' |' AS line FROM
      (SELECT * REPLACE (round_even(avg_score, 2) AS avg_score) FROM consensus)"""
)
def consensus_report(spark, sf):
    rows = raters.consensus(canonical(spark, sf), raters.first_votes(judgments(spark, sf)))
    return rows.select("index", reports.consensus_line().alias("line"))


@catalog.query(
    """WITH expected AS (SELECT DISTINCT p_brand AS model FROM part), parsed AS (SELECT 'Brand#' || s_nationkey AS model, count(*)::DOUBLE AS elapsed, count(*) AS n
        FROM supplier WHERE s_acctbal > 5000 GROUP BY ALL), failed AS (SELECT 'Brand#' || s_nationkey AS model, max(s_suppkey)::DOUBLE AS elapsed FROM supplier GROUP BY ALL)
    SELECT model, p.model IS NOT NULL AS ok, CASE WHEN p.model IS NOT NULL THEN p.elapsed ELSE coalesce(f.elapsed, 0) END AS elapsed_seconds, p.n AS parsed_count
    FROM expected LEFT JOIN parsed p USING (model) LEFT JOIN failed f USING (model)"""
)
def run_status(spark, sf):
    return _status(spark, sf)


def _status(spark: SparkSession, sf: str) -> DataFrame:
    model = F.concat(F.lit("Brand#"), F.col("s_nationkey").cast("string")).alias("model")
    suppliers = table(spark, sf, "supplier")
    parsed = suppliers.filter("s_acctbal > 5000").groupBy(model).agg(
        F.count(F.lit(1)).cast("double").alias("elapsed_seconds"), F.count(F.lit(1)).alias("parsed_count")
    )
    errors = suppliers.groupBy(model).agg(F.max("s_suppkey").cast("double").alias("elapsed_seconds"))
    expected = table(spark, sf, "part").select(F.col("p_brand").alias("model")).distinct()
    return raters.run_status(expected, parsed, errors)


@catalog.query(
    """WITH expected AS (SELECT DISTINCT p_brand AS model FROM part), parsed AS (SELECT DISTINCT 'Brand#' || s_nationkey AS model FROM supplier WHERE s_acctbal > 5000)
    SELECT count(*) AS models_attempted, count(p.model) AS models_succeeded, count(*) FILTER (p.model IS NULL) AS models_failed
    FROM expected LEFT JOIN parsed p USING (model)"""
)
def run_summary(spark, sf):
    return raters.run_summary(_status(spark, sf))


JOBS_SQL = """job AS (SELECT doc_id, unnest(['quality', 'toxic']) AS model FROM documents),
done AS (SELECT doc_id, unnest(['quality', 'toxic']) AS model, unnest([false, toxic = 1]) AS is_error FROM labels)"""


def _outputs(spark: SparkSession, sf: str) -> DataFrame:
    pair = lambda m, e: F.struct(F.lit(m).alias("model"), e.alias("is_error"))
    return table(spark, sf, "labels").select(
        "doc_id", F.inline(F.array(pair("quality", F.lit(False)), pair("toxic", F.col("toxic") == 1)))
    )


@catalog.query(f"WITH {JOBS_SQL} SELECT doc_id, model FROM job WHERE (doc_id, model) NOT IN (SELECT doc_id, model FROM done)")
def work_list(spark, sf):
    return raters.work_list(table(spark, sf, "documents"), ["quality", "toxic"], _outputs(spark, sf), "doc_id")


@catalog.query(
    f"WITH {JOBS_SQL} SELECT doc_id, model FROM job WHERE (doc_id, model) NOT IN (SELECT doc_id, model FROM done WHERE NOT is_error)"
)
def work_list_retry(spark, sf):
    return raters.work_list(
        table(spark, sf, "documents"), ["quality", "toxic"], _outputs(spark, sf), "doc_id", retry_errors=True
    )


@catalog.query(
    """SELECT doc_id, lang, CASE WHEN l.quality = 1 THEN 1 END AS item_page FROM documents LEFT JOIN labels l USING (doc_id)"""
)
def resume_union(spark, sf):
    documents = table(spark, sf, "documents").select("doc_id", "lang")
    previous = documents.join(table(spark, sf, "labels"), "doc_id").select(
        "doc_id", "lang", F.when(F.col("quality") == 1, 1).alias("item_page")
    )
    finished, remaining = raters.resume(previous, documents, "doc_id", "item_page")
    return finished.unionByName(remaining, allowMissingColumns=True)


@catalog.query(
    """SELECT p_partkey FROM part WHERE p_size <= 20 AND p_type = 'PROMO' AND contains(p_name, 'ring')"""
)
def eligible_models(spark, sf):
    models = table(spark, sf, "part").select(
        "p_partkey", F.when(F.col("p_size") > 1, F.col("p_size").cast("double")).otherwise(F.col("p_size").cast("double")).alias("pricePerMillionInputTokens"),
        F.col("p_type").alias("provider"), F.split("p_name", " ").alias("inputModalities"),
    )
    return raters.eligible_models(models, 20.0, "PROMO", "ring").select("p_partkey")


@catalog.query(
    """SELECT doc, unnest([1, 2, 3])::INT AS index, unnest([1, 1, 2])::INT AS page, unnest([1, 2, 1])::INT AS page_index,
        unnest([c_name, '', c_mktsegment]) AS title FROM (SELECT c_custkey AS doc, * FROM customer) WHERE c_acctbal >= 0
    UNION ALL SELECT c_custkey, 1, 7, 5, c_name FROM customer WHERE c_acctbal < 0"""
)
def search_results(spark, sf):
    result = lambda i, title: F.struct(
        F.lit(i).alias("index"), title.alias("title"), F.lit("u").alias("url"), F.lit(None).cast("string").alias("text")
    )
    page = lambda n, *results: F.struct(F.lit(n).alias("page"), F.array(*results).alias("results"))
    pages = F.array(
        page(1, result(1, F.col("c_name")), result(2, F.lit(None).cast("string"))), page(2, result(1, F.col("c_mktsegment")))
    )
    top = F.struct(
        F.lit(5).alias("index"), F.lit(7).alias("page"), F.col("c_name").alias("title"), F.lit("u").alias("url"), F.lit("").alias("text")
    )
    documents = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("doc"),
        F.when(F.col("c_acctbal") >= 0, pages).otherwise(F.slice(pages, 1, 0)).alias("pages"), F.array(top).alias("results"),
    )
    return raters.expand_results(documents, ["doc"]).select("doc", "index", "page", "page_index", "title")


@catalog.query(
    """WITH present AS (SELECT p_brand, list_sort(list(DISTINCT p_size)) AS sizes FROM part GROUP BY p_brand),
      everyone AS (SELECT list_sort(list(DISTINCT p_size)) AS sizes FROM part)
    SELECT p_brand, array_to_string(p.sizes, ', ') AS present_in,
      array_to_string(list_filter(e.sizes, lambda s: NOT list_contains(p.sizes, s)), ', ') AS missing_from
    FROM present p, everyone e WHERE len(p.sizes) < len(e.sizes)"""
)
def coverage_gap(spark, sf):
    rows = table(spark, sf, "part").select("p_brand", F.col("p_size").alias("model"))
    gaps = comparison.coverage_gaps(rows, ["p_brand"], rows.select("model").distinct())
    shown = lambda c: F.array_join(F.col(c).cast("array<string>"), ", ")
    return gaps.select("p_brand", shown("present").alias("present_in"), shown("missing").alias("missing_from"))


ALIGNED_SQL = """
item AS (SELECT regexp_replace(regexp_replace(regexp_replace(lower(trim(string_split(text, chr(10))[1])), '&', 'and', 'g'), '[^a-z0-9/ ]+', '', 'g'), ' +', ' ', 'g') AS key,
  source AS model, doc_id, lang, n_chars FROM documents),
aligned AS (SELECT key, model, lang, n_chars FROM (SELECT *, row_number() OVER (PARTITION BY key, model ORDER BY doc_id DESC) AS rn FROM item) WHERE rn = 1)
"""


def aligned_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Last document per (first line, source): the first line is the dish, the source the model."""
    first_line = F.element_at(F.split("text", "\n"), 1)
    items = table(spark, sf, "documents").select(
        tx.dish_key(first_line).alias("key"), F.col("source").alias("model"), "lang", "n_chars", F.col("doc_id").alias("line_no")
    )
    return comparison.latest_per_model(items, ["key"])


@catalog.query(f"WITH {ALIGNED_SQL} SELECT * FROM aligned")
def last_wins_alignment(spark, sf):
    return aligned_documents(spark, sf).drop("line_no")


@catalog.query(
    f"""WITH {ALIGNED_SQL}, by_value AS (SELECT key, CASE WHEN n_chars < 300 THEN '' ELSE 'size ' || (n_chars // 200)::VARCHAR END AS v,
        string_agg(model, ', ' ORDER BY model) AS models FROM aligned GROUP BY ALL)
    SELECT key, count(*) AS n_values, string_agg(CASE WHEN v = '' THEN '[blank]' ELSE v END || ': ' || models, '; ' ORDER BY v) AS values_by_model
    FROM by_value GROUP BY key HAVING count(*) > 1"""
)
def disagreement(spark, sf):
    band = F.when(F.col("n_chars") < 300, " ").otherwise(F.concat(F.lit("SIZE  "), F.floor(F.col("n_chars") / 200).cast("string")))
    aligned = aligned_documents(spark, sf).withColumn("value", band)
    return comparison.disagreements(aligned, ["key"], F.col("value"), tx.text_key)


def _pipe_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as pipe rows: every sentence end becomes a cell border."""
    return table(spark, sf, "documents").select("source", "doc_id", "text").select(
        F.col("source").alias("model"), "doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "raw")
    ).select("model", "doc_id", "line_no", F.replace("raw", F.lit(". "), F.lit(" | ")).alias("line"))


LINES_SQL = r"""
raw AS (SELECT source AS model, doc_id, unnest(string_split(text, chr(10))) AS line FROM documents),
kept AS (SELECT model, doc_id, trim(replace(line, '. ', ' | '), E' \t\n\r\x0b\x0c') AS line FROM raw),
cells AS (SELECT model, doc_id, list_transform(string_split(regexp_replace(regexp_replace(line, '^\|+', ''), '\|+$', ''), '|'), lambda c: trim(c)) AS cells
  FROM kept WHERE line <> '' AND NOT starts_with(line, '<!--') AND NOT regexp_matches(line, '^\|?\s*:?-{3,}:?\s*(\|\s*:?-{3,}:?\s*)+\|?$'))
"""


@catalog.query(
    f"""WITH {LINES_SQL} SELECT model, count(*) FILTER (len(cells) = 4) AS parsed_rows, count(*) AS raw_rows, count(*) FILTER (len(cells) <> 4) AS malformed_rows
    FROM cells GROUP BY model"""
)
def malformed_summary(spark, sf):
    return comparison.line_summary(_pipe_lines(spark, sf), 4)


@catalog.query(
    f"""WITH {LINES_SQL} SELECT model, doc_id, cells[1] AS dish, cells[2] AS category, cells[3] AS price, cells[4] AS description, count(*) AS n
    FROM cells WHERE len(cells) = 4 GROUP BY ALL"""
)
def well_formed_rows(spark, sf):
    rows = comparison.well_formed(comparison.row_lines(_pipe_lines(spark, sf)), comparison.FOUR_FIELDS)
    return rows.groupBy("model", "doc_id", *comparison.FOUR_FIELDS).agg(F.count(F.lit(1)).alias("n"))


@catalog.query(
    """WITH found AS (SELECT p_brand AS model, list(DISTINCT split_part(p_name, ' ', 2)) FILTER (p_type = 'PROMO') AS names FROM part GROUP BY p_brand)
    SELECT model, coalesce(nullif(array_to_string(list_filter(['anvil','gear','ring','spoon'], lambda n: list_contains(names, n)), ', '), ''), '-') AS present,
      coalesce(nullif(array_to_string(list_filter(['anvil','gear','ring','spoon'], lambda n: NOT coalesce(list_contains(names, n), false)), ', '), ''), '-') AS missing FROM found"""
)
def split_check(spark, sf):
    items = table(spark, sf, "part").select(
        F.col("p_brand").alias("model"), F.element_at(F.split("p_name", " "), 2).alias("noun"), "p_type"
    )
    return comparison.split_check(
        items, ["anvil", "gear", "ring", "spoon"], F.col("noun"), tx.category_key(F.col("p_type")) == "promo"
    )


@catalog.query(
    """SELECT p_brand AS model, flag, p_name AS dish, count(*) AS n FROM (
      SELECT p_brand, p_name, unnest(['side', 'invalid price']) AS flag, unnest([split_part(p_name, ' ', 2) = 'plate', p_size <= 2]) AS hit FROM part) WHERE hit GROUP BY ALL"""
)
def flagged_rows(spark, sf):
    size = F.col("p_size")
    price = F.when(size == 1, "ask").when(size == 2, "$0.00").otherwise(F.col("p_retailprice").cast("string"))
    items = table(spark, sf, "part").select(F.col("p_brand").alias("model"), F.col("p_name").alias("dish"), price.alias("price"))
    flags = {
        "side": F.element_at(F.split(tx.basic_dish_key(F.col("dish")), " "), 2) == "plate",
        "invalid price": money.is_invalid_price(F.col("price")),
    }
    return comparison.flagged_rows(items, flags).groupBy("model", "flag", "dish").agg(F.count(F.lit(1)).alias("n"))


@catalog.query(
    """SELECT o_orderkey, printf('$%.2f', t) AS price, t = 0 AS invalid, CASE WHEN o_orderstatus = 'F' THEN 2 WHEN o_orderstatus = 'P' THEN 1 END AS pick_count,
      o_orderstatus <> 'O' AS must, CASE WHEN o_orderstatus = 'F' THEN 2 WHEN o_orderstatus = 'P' THEN 1 END AS min_pick,
      CASE WHEN o_orderstatus = 'F' THEN 4 WHEN o_orderstatus = 'P' THEN 1 ELSE 3 END AS max_pick
    FROM (SELECT *, CASE WHEN o_orderpriority = '1-URGENT' THEN 0 ELSE floor(o_totalprice * 100) / 100 END AS t FROM orders)"""
)
def price_rules(spark, sf):
    status = F.col("o_orderstatus")
    amount = F.when(F.col("o_orderpriority") == "1-URGENT", F.lit(0.0)).otherwise(F.floor(F.col("o_totalprice") * 100) / 100)
    rule = F.when(status == "F", " Must pick 2 - 4").when(status == "P", "must pick").otherwise("Pick up to 3 items")
    text = F.when(status == "F", "Select 2").when(status == "P", "Required").otherwise("Optional: any 3")
    printed = F.concat(F.lit(" $ "), amount.cast("decimal(12,2)").cast("string"), F.lit(" each"))
    rows = table(spark, sf, "orders").select(
        "o_orderkey", money.normalize_price(printed).alias("price"), money.is_invalid_price(printed).alias("invalid"),
        money.required_count(text).alias("pick_count"), money.pick_rule(rule).alias("r"),
    )
    return rows.select("o_orderkey", "price", "invalid", "pick_count", F.col("r.required").alias("must"), "r.min_pick", "r.max_pick")


@catalog.query(
    """SELECT p_partkey, regexp_replace(lower(p_brand), '[^a-z0-9/ ]+', '', 'g') || ' and ' || p_name AS dish, CASE WHEN p_brand = 'Brand#7' THEN 'sides' ELSE lower(p_type) || ' x' END AS category,
      CASE WHEN p_type = 'PROMO' THEN 'family pack' ELSE lower(p_type) END AS original_category,
      array_to_string(list_sort(list_distinct([split_part(p_name, ' ', 1), split_part(p_name, ' ', 2), lower(p_type)])), ', ') AS choices, p_size::VARCHAR AS sides_number FROM part"""
)
def comparison_keys(spark, sf):
    name_key = F.when(F.col("p_brand") == "Brand#7", "papas").otherwise("other")
    words = F.split("p_name", " ")
    listed = F.concat(words[0], F.lit(" and "), words[1], F.lit(" / "), F.col("p_type"), F.lit("!; "), words[0])
    return table(spark, sf, "part").select(
        "p_partkey",
        tx.basic_dish_key(F.concat_ws(" ", F.col("p_brand"), F.lit("& "), F.col("p_name"))).alias("dish"),
        tx.side_aware_category(name_key, F.concat(F.lit(" "), F.col("p_type"), F.lit("-  x."))).alias("category"),
        tx.category_key(
            F.when(F.col("p_type") == "PROMO", "Family  Meals!").otherwise(F.col("p_type")), tx.CATEGORY_ALIASES
        ).alias("original_category"),
        tx.side_choice_key(listed).alias("choices"),
        tx.first_number(F.concat(F.lit("pick "), F.col("p_size").cast("string"), F.lit(" of 60"))).alias("sides_number"),
    )


@catalog.query(
    """SELECT 0 AS part, NULL AS p_type, '| Type | Parts | Note |' AS line UNION ALL SELECT 1, NULL, '| --- | --- | --- |'
    UNION ALL SELECT 2, p_type, '| ' || p_type || ' | ' || count(*) || ' | a\\|b<br>c |' FROM part GROUP BY p_type"""
)
def report_table(spark, sf):
    rows = table(spark, sf, "part").groupBy("p_type").agg(F.count(F.lit(1)).alias("n")).withColumn("note", F.lit("a|b\nc"))
    return reports.markdown_table(rows, ["p_type"], {"Type": "p_type", "Parts": "n", "Note": "note"})
