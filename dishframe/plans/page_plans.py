"""Page, link, dedupe and document-order queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from dishframe.functions import html, price, urls
from dishframe.functions import text as tx
from dishframe.operators import arrays, dedupe, jsonwalk, links, matching, ordering, reports, signals
from dishframe.plans.tables import Catalog, table
from dishframe.sources import files

catalog = Catalog()

UNESCAPE_SQL = "replace(replace(replace(replace({0}, '&quot;', '\"'), '&middot;', '·'), '&copy;', '©'), '&amp;', '&')"


def _unescape(expression: str) -> str:
    return UNESCAPE_SQL.format(expression)


LINES_SQL = rf"""
stripped AS (SELECT page_id, regexp_replace(regexp_replace(regexp_replace(html, '(?s)<!--.*?-->', '', 'g'),
    '(?is)<script\b[^>]*>.*?</script\s*>', chr(10), 'g'), '(?is)<style\b[^>]*>.*?</style\s*>', chr(10), 'g') AS h FROM pages),
pieces AS (SELECT page_id, list_filter(list_transform(string_split({_unescape("regexp_replace(h, '(?s)<[^>]*>', chr(10), 'g')")}, chr(10)),
    lambda l: trim(regexp_replace(l, '\s+', ' ', 'g'))), lambda l: l <> '') AS lines FROM stripped),
page_line AS (SELECT page_id, unnest(lines) AS line, (unnest(generate_series(1, len(lines))) - 1)::INT AS line_no FROM pieces)
"""


def page_lines(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pages").select("page_id", "html").select(
        "page_id", F.posexplode(html.visible_lines(F.col("html"))).alias("line_no", "line")
    )


@catalog.query(f"WITH {LINES_SQL} SELECT * FROM page_line")
def visible_lines(spark, sf):
    return page_lines(spark, sf)


@catalog.query(
    f"""WITH {LINES_SQL} SELECT page_id, line_no, line FROM (SELECT *, row_number() OVER (PARTITION BY page_id, lower(line) ORDER BY line_no) AS rn
      FROM page_line) WHERE rn = 1"""
)
def line_dedupe(spark, sf):
    return dedupe.line_dedupe(page_lines(spark, sf), ["page_id"])


TITLE_SQL = _unescape(r"trim(regexp_replace(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), '\s+', ' ', 'g'))")
HEADING_SQL = _unescape(r"trim(regexp_replace(hs[1], '\s+', ' ', 'g'))")


@catalog.query(
    f"""SELECT page_id, {TITLE_SQL} AS title, '' AS meta_description, len(hs) AS n_headings, {HEADING_SQL} AS heading
    FROM (SELECT *, regexp_extract_all(html, '(?is)<h[1-3][^>]*>(.*?)</h[1-3]>', 1) AS hs FROM pages)"""
)
def page_meta(spark, sf):
    page = F.col("html")
    return table(spark, sf, "pages").select(
        "page_id", html.title(page).alias("title"), html.meta_description(page).alias("meta_description"), html.headings(page).alias("hs")
    ).select("page_id", "title", "meta_description", F.size("hs").cast("bigint").alias("n_headings"), F.get("hs", F.lit(0)).alias("heading"))


LINKS_SQL = rf"""
link AS (SELECT page_id, url, unnest(hrefs) AS href, (unnest(generate_series(1, len(hrefs))) - 1)::INT AS pos FROM (
  SELECT page_id, url, list_filter(regexp_extract_all(html, '(?is)<(?:a|form)\b[^>]*?\b(?:href|action)\s*=\s*"([^"]*)"', 1), lambda x: x <> '') AS hrefs FROM pages)),
absolute AS (SELECT page_id, url, pos, CASE WHEN starts_with(href, '/') THEN regexp_extract(url, '^[a-z]+://[^/?#]*') || {_unescape("href")} ELSE {_unescape("href")} END AS link FROM link)
"""

# Path classes: the pages hold only site-relative links, so the URL fragments to look for are paths.
PATH_SOURCES = {"articles": ("/the", "/and"), "lists": ("/of", "/le"), "other_site": ("example.org/",)}


@catalog.query(
    f"""WITH {LINKS_SQL} SELECT page_id, pos, link, CASE WHEN contains(lower(link), '/the') OR contains(lower(link), '/and') THEN 'articles'
      WHEN contains(lower(link), '/of') OR contains(lower(link), '/le') THEN 'lists' WHEN contains(lower(link), 'example.org/') THEN 'other_site' ELSE 'none' END AS source
    FROM absolute"""
)
def page_links(spark, sf):
    found = links.page_links(table(spark, sf, "pages"), ["page_id"])
    return found.withColumn("source", urls.source_of(F.col("link"), F.lit("none"), PATH_SOURCES))


@catalog.query(
    f"""WITH {LINKS_SQL} SELECT page_id, min(pos) AS pos, link FROM absolute GROUP BY page_id, link"""
)
def distinct_links(spark, sf):
    return links.distinct_links(links.page_links(table(spark, sf, "pages"), ["page_id"]), ["page_id"])


@catalog.query(
    f"""WITH {LINKS_SQL}, useful AS (SELECT page_id, link, min(pos) AS pos FROM absolute
        WHERE regexp_matches(link, '(?i)(menu|order|online|about|location|contact|hours|catering|gallery|dinner|lunch)') GROUP BY ALL),
      both_kinds AS (SELECT page_id, url AS link, -1 AS pos FROM pages UNION ALL SELECT u.page_id, u.link, u.pos FROM useful u JOIN pages p USING (page_id) WHERE u.link <> p.url),
      ranked AS (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY pos) - 1 AS rn FROM both_kinds)
    SELECT page_id, rn::INT AS pos, link FROM ranked WHERE rn < 14"""
)
def own_site_links(spark, sf):
    return links.own_site_links(table(spark, sf, "pages"), ["page_id"])


def _shop_pages(spark: SparkSession, sf: str) -> DataFrame:
    """A page per supplier with ordering links and JSON scripts, built from the supplier's columns."""
    key = F.col("s_suppkey").cast("string")
    rating = F.struct(
        F.round(F.col("s_acctbal") / 2500 + 1, 1).alias("ratingValue"),
        F.when(F.col("s_nationkey") > 12, F.col("s_suppkey")).alias("reviewCount"), F.col("s_nationkey").alias("ratingCount"),
    )
    item = lambda name, price: F.struct(
        F.lit("MenuItem").alias("@type"), name.alias("name"), F.lit("with A &amp; B").alias("description"),
        F.struct(price.cast("string").alias("price")).alias("offers"),
    )
    section = lambda name, *items: F.struct(name.alias("name"), F.array(*items).alias("hasMenuItem"))
    shop = F.struct(
        F.lit("Restaurant").alias("@type"), F.col("s_name").alias("name"),
        F.when(F.col("s_acctbal") > 2000, rating).alias("aggregateRating"),
        F.struct(
            F.array(
                section(F.lit("Featured items"), item(F.lit("Soup"), F.col("s_nationkey"))),
                section(F.lit("Mains"), item(F.concat(F.lit("Dish "), key), F.col("s_suppkey")), item(F.lit("Soup"), F.col("s_nationkey"))),
            ).alias("hasMenuSection")
        ).alias("hasMenu"),
    )
    graph = F.struct(F.array(F.struct(F.lit("Place").alias("@type"), F.col("s_name").alias("name"), rating.alias("aggregateRating"))).alias("@graph"))
    script = lambda body: F.concat(F.lit('<script id="s" type="application/ld+json">'), F.to_json(body), F.lit("</script>"))
    anchor = lambda href: F.concat(F.lit('<a class="x" href="'), href, F.lit('">go</a>'))
    page = F.concat(
        F.lit("<html><head><title>"), F.col("s_name"), F.lit("</title>"), F.lit('<script>var x = {broken;</script>'), script(shop), script(graph),
        F.lit("</head><body>"), anchor(F.concat(F.lit("https://www.GrubHub.com/restaurant/"), key)),
        anchor(F.concat(F.lit("/url?q=https%3A%2F%2Fdoordash.com%2Fstore%2F"), key, F.lit("&amp;sa=U"))),
        anchor(F.lit("https://elsewhere.example/")), anchor(F.concat(F.lit("https://www.GrubHub.com/restaurant/"), key)),
        F.lit('<form action="https://order.online/x"></form></body></html>'),
    )
    return table(spark, sf, "supplier").select("s_suppkey", page.alias("html"))


@catalog.query(
    """SELECT s_suppkey, unnest([0, 1, 2])::INT AS pos, unnest(['https://www.GrubHub.com/restaurant/' || s_suppkey,
      '/url?q=https://doordash.com/store/' || s_suppkey || '&sa=U', 'https://order.online/x']) AS link FROM supplier"""
)
def provider_links(spark, sf):
    return links.provider_links(_shop_pages(spark, sf), ["s_suppkey"])


@catalog.query("SELECT s_suppkey, 1 AS pos, 'https://doordash.com/store/' || s_suppkey AS link FROM supplier")
def store_candidates(spark, sf):
    found = _shop_pages(spark, sf).select("s_suppkey", F.posexplode(html.links(F.col("html"))).alias("pos", "href")).select(
        "s_suppkey", "pos", F.when(F.col("href").startswith("/url"), F.concat(F.lit("https://www.google.com"), "href")).otherwise(F.col("href")).alias("link")
    )
    return links.store_candidates(found, ["s_suppkey"], "doordash.com/store").select("s_suppkey", "pos", "link")


@catalog.query(
    """SELECT source, link, min(stage) AS stage, arg_min(pos, stage * 1000000000 + pos) AS pos FROM (
      SELECT 'yelp' AS source, 'https://yelp.com/biz/' || s_nationkey AS link, 1 AS stage, s_suppkey AS pos FROM supplier WHERE s_acctbal > 5000
      UNION ALL SELECT 'grubhub', 'https://grubhub.com/' || s_nationkey, 1, s_suppkey FROM supplier WHERE s_acctbal > 2000 AND s_acctbal <= 5000
      UNION ALL SELECT 'yelp', 'https://yelp.com/biz/' || n_nationkey, 0, n_nationkey FROM nation WHERE n_regionkey = 1) GROUP BY source, link"""
)
def admitted_links(spark, sf):
    nation = F.col("s_nationkey").cast("string")
    balance = F.col("s_acctbal")
    found = table(spark, sf, "supplier").select(
        F.when(balance > 5000, "yelp").when(balance > 1000, "grubhub").otherwise("google_search").alias("source"),
        F.col("s_suppkey").alias("pos"),
        F.when(balance > 5000, F.concat(F.lit("https://yelp.com/biz/"), nation))
        .when(balance > 2000, F.concat(F.lit("https://grubhub.com/"), nation)).otherwise(F.lit("https://facebook.com/x")).alias("link"),
    )
    seeds = table(spark, sf, "nation").filter("n_regionkey = 1").select(
        F.lit("yelp").alias("source"), F.col("n_nationkey").cast("bigint").alias("pos"),
        F.concat(F.lit("https://yelp.com/biz/"), F.col("n_nationkey").cast("string")).alias("link"),
    )
    return links.admitted_links(found, seeds)


@catalog.query(
    r"""WITH hosted AS (SELECT page_id, url, regexp_replace(lower(regexp_extract(url, '^[a-z]+://([^/?#]*)', 1)), '^www\.', '') AS site FROM pages),
      ranked AS (SELECT *, row_number() OVER (PARTITION BY site ORDER BY page_id) AS rank FROM hosted)
    SELECT page_id, site, rank::INT AS rank FROM ranked WHERE rank <= 6"""
)
def host_filter(spark, sf):
    pages = table(spark, sf, "pages").select("page_id", urls.site(F.col("url")).alias("site"))
    return links.first_per_group(pages, ["site"], ["page_id"], 6).select("page_id", "site", "rank")


@catalog.query(
    """SELECT c_custkey, CASE WHEN c_mktsegment = 'MACHINERY' THEN 'https://x.example/?a=' || c_name ELSE '/plain' END AS target,
      c_nationkey::VARCHAR AS branch_id, 'N ' || c_mktsegment AS branch_name FROM customer"""
)
def url_functions(spark, sf):
    wrapped = F.concat(F.lit("https://www.google.com/url?q=https%3A%2F%2Fx.example%2F%3Fa%3D"), F.url_encode("c_name"), F.lit("&sa=1"))
    link = F.when(F.col("c_mktsegment") == "MACHINERY", wrapped).otherwise("/plain")
    href = F.concat(F.lit("https://order.example/b?branchId="), F.col("c_nationkey").cast("string"), F.lit("&branchName=N+"), F.col("c_mktsegment"))
    rows = table(spark, sf, "customer").select("c_custkey", urls.unwrap(link).alias("target"), href.alias("href"))
    return files.branches(rows).drop("href")


# --- signals ------------------------------------------------------------------------------------

NUMBER = r"(?i)([0-9][0-9,]*)\s+([a-z]+)"


@catalog.query(
    rf"""WITH found AS (SELECT doc_id, text, regexp_extract_all(text, '{NUMBER}')[1:25] AS hits, regexp_extract_all(text, '{NUMBER}', 1)[1:25] AS vals,
        regexp_split_to_array(text, '{NUMBER}')[1:25] AS pieces FROM documents),
      placed AS (SELECT doc_id, text, unnest(vals) AS value, unnest(generate_series(1, len(vals))) AS i, hits, pieces FROM found),
      spots AS (SELECT doc_id, text, value, i, (coalesce(list_sum(list_transform(pieces[1:i], lambda p: length(p))), 0)
        + coalesce(list_sum(list_transform(hits[1:i - 1], lambda p: length(p))), 0))::BIGINT AS start FROM placed)
    SELECT doc_id, (i - 1)::INT AS pos, value, start::INT AS start,
      trim(regexp_replace(substr(text, greatest(start - 180, 0) + 1, start + 260 - greatest(start - 180, 0)), '\s+', ' ', 'g')) AS context FROM spots"""
)
def signal_values(spark, sf):
    hits = signals.pattern_hits(F.col("text"), NUMBER, 180, 260, 25)
    return table(spark, sf, "documents").select("doc_id", "text").select("doc_id", F.posexplode(hits).alias("pos", "h")).select("doc_id", "pos", "h.*")


DOC_LINES_SQL = r"""doc_line AS (SELECT doc_id, lines, unnest(lines) AS line, unnest(generate_series(1, len(lines))) AS i FROM (
  SELECT doc_id, list_filter(list_transform(string_split(text, chr(10)), lambda l: trim(regexp_replace(l, '\s+', ' ', 'g'))), lambda l: l <> '') AS lines FROM documents))"""


def _doc_lines() -> Column:
    return F.filter(F.transform(F.split("text", "\n"), tx.collapse), lambda line: line != "")


@catalog.query(
    rf"""WITH {DOC_LINES_SQL}, hit AS (SELECT doc_id, line, min(i) AS i FROM doc_line
        WHERE regexp_matches(line, '(?i)review|rating|stars?|customer|google|yelp|tripadvisor|facebook|doordash|grubhub|uber')
        GROUP BY doc_id, line, CASE WHEN length(line) > 800 THEN i END),
      ranked AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS rn FROM hit)
    SELECT doc_id, (rn - 1)::INT AS pos, left(line, 800) AS line FROM ranked WHERE rn <= 80"""
)
def review_lines(spark, sf):
    return table(spark, sf, "documents").select("doc_id", "text").select("doc_id", F.posexplode(signals.review_lines(_doc_lines(), 800, 80)).alias("pos", "line"))


@catalog.query(
    rf"""WITH {DOC_LINES_SQL}, spot AS (SELECT doc_id, i, array_to_string(lines[greatest(i - 2, 1):i + 4], ' ') AS w FROM doc_line
        WHERE contains(lower(line), 'stars') OR contains(lower(line), 'rated') OR contains(lower(line), 'review')
          OR regexp_matches(line, '(?i)\b(?:Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Sept|Oct|Nov|Dec)[a-z]*\.?\s+\d{{1,2}},?\s+\d{{4}}\b|\b\d+\s+(?:minute|hour|day|week|month|year)s?\s+ago\b')),
      firsts AS (SELECT doc_id, w, min(i) AS i FROM spot WHERE length(w) >= 45 GROUP BY doc_id, w, CASE WHEN length(w) > 900 THEN i END),
      ranked AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS rn FROM firsts)
    SELECT doc_id, (rn - 1)::INT AS pos, left(w, 900) AS snippet FROM ranked WHERE rn <= 30"""
)
def review_snippets(spark, sf):
    found = ordering.review_snippets(_doc_lines(), longest=900, limit=30)
    return table(spark, sf, "documents").select("doc_id", "text").select("doc_id", F.posexplode(found).alias("pos", "snippet"))


@catalog.query(
    rf"""WITH {LINES_SQL}, texts AS (SELECT page_id, string_agg(line, chr(10) ORDER BY line_no) AS t FROM page_line GROUP BY page_id)
    SELECT page_id, length(html) AS html_chars, length(t) AS text_chars, len(regexp_extract_all(t, '(?i)\b(\d[\d,]*)\s+(reviews?|ratings?)\b'))::INT AS n_counts,
      regexp_matches(t, '(?i)(\$\d|taco|burrito|enchilada|fajita|quesadilla|nacho|chimichanga|menu|lunch|dinner|appetizer|dessert|drink|margarita|salsa|guacamole)') AS looks_menuish
    FROM pages JOIN texts USING (page_id)"""
)
def page_signals(spark, sf):
    return signals.page_signals(table(spark, sf, "pages")).select(
        "page_id", "html_chars", "text_chars", F.size("count_candidates").alias("n_counts"), "looks_menuish"
    )


@catalog.query(
    r"""WITH found AS (SELECT source, len(regexp_extract_all(text, '(?i)([0-9][0-9,]*)\s+([a-z]+)')) AS n FROM documents)
    SELECT source, count(*) AS n_pages, sum(n)::BIGINT AS n_ratings, sum(least(n, 5))::BIGINT AS n_best_ratings FROM found GROUP BY source"""
)
def source_summary(spark, sf):
    hits = signals.pattern_hits(F.col("text"), NUMBER, 180, 260)
    none = F.array().cast("array<string>")
    pages = table(spark, sf, "documents").select(
        "source", hits.alias("rating_candidates"), none.alias("count_candidates"), none.alias("review_snippets")
    )
    return signals.source_summary(pages).select("source", "n_pages", "n_ratings", "n_best_ratings")


COUNT_OF = "(?i)([0-9][0-9,]*) (the|of|and|der|la|de)"


@catalog.query(
    rf"""WITH hit AS (SELECT source, doc_id, lang, regexp_extract_all(text, '{NUMBER}', 1)[1:5] AS ratings, regexp_extract_all(text, '{COUNT_OF}', 1) AS counts FROM documents)
    SELECT source, doc_id, 'page' AS kind, 0 AS pos, lang AS value FROM hit
    UNION ALL SELECT source, doc_id, 'rating_candidates', unnest(range(len(ratings)))::INT, unnest(ratings) FROM hit
    UNION ALL SELECT source, doc_id, 'count_candidates', unnest(range(len(counts)))::INT, unnest(counts) FROM hit"""
)
def source_evidence(spark, sf):
    """Pages, first five ratings and all counts of every source, as rows."""
    text = F.col("text")
    pages = table(spark, sf, "documents").select(
        "source", "doc_id", "lang", signals.pattern_hits(text, NUMBER, 180, 260, 5).alias("rating_candidates"), signals.pattern_hits(text, COUNT_OF, 80, 80).alias("count_candidates")
    )
    return signals.source_evidence(pages, "source", "doc_id", "lang", {"rating_candidates": 5, "count_candidates": None}).drop("context")


@catalog.query(
    """SELECT s_suppkey, s_name AS name, CASE WHEN CASE WHEN s_nationkey > 12 THEN s_suppkey ELSE 0 END <> 0 THEN s_suppkey ELSE s_nationkey END::VARCHAR AS review_count, 2 AS n
      FROM supplier WHERE s_acctbal > 2000
    UNION ALL SELECT s_suppkey, s_name, CASE WHEN CASE WHEN s_nationkey > 12 THEN s_suppkey ELSE 0 END <> 0 THEN s_suppkey ELSE s_nationkey END::VARCHAR, 1 FROM supplier WHERE s_acctbal <= 2000"""
)
def structured_ratings(spark, sf):
    ratings = signals.page_ratings(_shop_pages(spark, sf), "s_suppkey")
    return ratings.groupBy("s_suppkey", "name", "review_count").agg(F.count(F.lit(1)).cast("int").alias("n"))


@catalog.query(
    """WITH rating AS (SELECT s_suppkey, s_name, s_acctbal > 2000 AS rated,
        '{"ratingCount": ' || s_nationkey || ', "ratingValue": ' || printf('%.1f', round(s_acctbal / 2500 + 1, 1)) || CASE WHEN s_nationkey > 12 THEN ', "reviewCount": ' || s_suppkey ELSE '' END || '}' AS r FROM supplier),
      object AS (SELECT s_suppkey, 0 AS rank, '{"@type": "Restaurant", "aggregateRating": ' || r AS context FROM rating WHERE rated
        UNION ALL SELECT s_suppkey, 1, r FROM rating WHERE rated
        UNION ALL SELECT s_suppkey, 2, '{"@graph": [{"@type": "Place", "aggregateRating": ' || r || ', "name": "' || s_name || '"}]}' FROM rating
        UNION ALL SELECT s_suppkey, 3, '{"@type": "Place", "aggregateRating": ' || r || ', "name": "' || s_name || '"}' FROM rating
        UNION ALL SELECT s_suppkey, 4, r FROM rating)
    SELECT s_suppkey, 'ratingish' AS kind, (row_number() OVER (PARTITION BY s_suppkey ORDER BY rank) - 1)::INT AS pos, 's' AS script_id, left(context, 50) AS context FROM object"""
)
def review_like_objects(spark, sf):
    found = signals.review_like_objects(_shop_pages(spark, sf), "s_suppkey")
    return found.select("s_suppkey", "kind", "pos", "script_id", F.substring("context", 1, 50).alias("context"))


@catalog.query("SELECT s_suppkey, 1 AS n FROM supplier")
def graph_ratings(spark, sf):
    """Only the '@graph' script has a rating reachable through '@graph'; the other is its own root."""
    documents = signals.script_documents(_shop_pages(spark, sf), "s_suppkey", ld_only=True)
    graphs = documents.filter(F.get_json_object("document", "$['@graph']").isNotNull())
    objects = jsonwalk.json_objects(graphs, "s_suppkey", "document", True, jsonwalk.has_rating)
    return jsonwalk.structured_ratings(objects, ["s_suppkey"]).groupBy("s_suppkey").agg(F.count(F.lit(1)).cast("int").alias("n"))


@catalog.query("SELECT s_suppkey, unnest([1, 2])::INT AS script_no, 's' AS script_id, 'application/ld+json' AS script_type FROM supplier")
def json_scripts(spark, sf):
    return signals.script_documents(_shop_pages(spark, sf), "s_suppkey").drop("document")


@catalog.query(
    """SELECT s_suppkey, unnest([0, 1, 1])::INT AS section_no, unnest(['Featured items', 'Mains', 'Mains']) AS section, unnest([0, 0, 1])::INT AS item_no,
      unnest(['Soup', 'Dish ' || s_suppkey, 'Soup']) AS name, 'with A & B' AS description, unnest([s_nationkey::VARCHAR, s_suppkey::VARCHAR, s_nationkey::VARCHAR]) AS price FROM supplier"""
)
def ld_menu_items(spark, sf):
    scripts = signals.script_documents(_shop_pages(spark, sf), "s_suppkey").select(
        "s_suppkey", F.col("script_no").alias("pos"), F.col("document").alias("script")
    )
    shops = files.first_of_type(scripts, ["s_suppkey"], "Restaurant")
    menus = shops.select("s_suppkey", F.get_json_object("document", "$.hasMenu").alias("menu"))
    return files.ld_menu_items(menus, ["s_suppkey"]).withColumn("description", tx.unescape(F.col("description")))


@catalog.query(
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, unnest(['data.items[0]', 'data.items[1].nested']) AS source_path,
      unnest(['Dish ' || l_partkey, 'Side ' || l_suppkey]) AS name, unnest(['flag ' || l_returnflag, '']) AS description, unnest([NULL, l_suppkey::VARCHAR]) AS price FROM lineitem"""
)
def json_items(spark, sf):
    dish = F.struct(F.concat(F.lit("Dish "), F.col("l_partkey").cast("string")).alias("title"), F.concat(F.lit("flag "), "l_returnflag").alias("subtitle"))
    side = F.struct(
        F.struct(
            F.concat(F.lit(" Side "), F.col("l_suppkey").cast("string")).alias("displayName"), F.col("l_suppkey").alias("unitAmount"), F.lit("").alias("price")
        ).alias("nested")
    )
    # The two items differ in shape, so they are put in as JSON text and unquoted.
    whole = F.concat(
        F.lit('{"data":{"name":"Menu","description":"c","items":['), F.to_json(dish), F.lit(","), F.to_json(side), F.lit("]}}")
    )
    key = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    documents = table(spark, sf, "lineitem").select(*key, whole.alias("document"))
    return jsonwalk.json_items(documents, key, "document").select(*key, "source_path", "name", "description", "price")


@catalog.query("""SELECT event_id, 0 AS n, '' AS path, json_extract_string(props, '$.k')::BIGINT AS k FROM events""")
def json_props(spark, sf):
    fenced = F.concat(F.lit("```json\n"), "props", F.lit("\n```"))
    chatty = F.concat(F.lit("Sure: "), "props", F.lit(" done"))
    reply = F.when(F.col("event_type") == "view", fenced).when(F.col("event_type") == "click", chatty).otherwise(F.col("props"))
    documents = table(spark, sf, "events").select("event_id", tx.jsonish(reply).alias("document"))
    return jsonwalk.json_objects(documents, "event_id", "document").select(
        "event_id", "n", "path", F.get_json_object("object", "$.k").cast("bigint").alias("k")
    )


# --- dedupe -------------------------------------------------------------------------------------

KEYED_SQL = r"keyed AS (SELECT doc_id, source, lang, sha256(lower(trim(regexp_replace(text, '\s+', ' ', 'g')))) AS content_key FROM documents)"


@catalog.query(
    f"""WITH {KEYED_SQL} SELECT content_key, min(doc_id) AS doc_id, arg_min(source, doc_id) AS source, arg_min(lang, doc_id) AS lang, count(*) AS n_copies
    FROM keyed GROUP BY content_key"""
)
def content_dedupe(spark, sf):
    documents = table(spark, sf, "documents").select("doc_id", "source", "lang", "text")
    keyed = documents.withColumn("key", dedupe.content_hash(F.col("text"))).drop("text")
    return dedupe.content_groups(keyed, F.col("key"), "doc_id").drop("key")


@catalog.query(f"WITH {KEYED_SQL} SELECT min(doc_id) OVER (PARTITION BY content_key) AS kept, doc_id, source FROM keyed")
def content_sources(spark, sf):
    documents = table(spark, sf, "documents").select("doc_id", "source", "text")
    return dedupe.content_sources(documents, dedupe.content_hash(F.col("text")), "doc_id", "source")


@catalog.query(
    """SELECT left(sha256(regexp_extract(html, '(?s)<nav>.*</nav>')), 16) AS content_key, min(page_id) AS page_id, count(*) AS n_copies FROM pages GROUP BY 1"""
)
def block_dedupe(spark, sf):
    blocks = table(spark, sf, "pages").select("page_id", dedupe.markup_hash(F.regexp_extract("html", "(?s)<nav>.*</nav>", 0)).alias("key"))
    return dedupe.content_groups(blocks, F.col("key"), "page_id").drop("key")


@catalog.query(
    """SELECT user_id, event_type, max(ts) AS ts, arg_max(value, ts) AS value, arg_max(event_id, ts) AS event_id FROM events GROUP BY ALL"""
)
def latest_wins(spark, sf):
    return dedupe.latest_wins(table(spark, sf, "events").drop("props"), ["user_id", "event_type"], ["ts"])


@catalog.query(
    """SELECT p_brand, p_partkey, p_name AS name, p_type AS description, p_size FROM (SELECT *, row_number() OVER (PARTITION BY p_brand, p_name, p_type, p_size > 25
      ORDER BY p_partkey) AS rn FROM part) WHERE rn = 1"""
)
def item_dedupe(spark, sf):
    price = F.when(F.col("p_size") > 25, F.struct(F.lit(1).alias("amount")))
    items = table(spark, sf, "part").select(
        "p_brand", "p_partkey", F.col("p_name").alias("name"), F.col("p_type").alias("description"), price.alias("price"), "p_size"
    )
    return dedupe.item_dedupe(items, ["p_brand"], ["p_partkey"]).drop("price")


@catalog.query(
    r"""WITH hosted AS (SELECT regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) AS host, min(page_id) AS page_id FROM pages GROUP BY 1)
    SELECT host, page_id, row_number() OVER (ORDER BY page_id) AS index FROM hosted"""
)
def running_index(spark, sf):
    pages = table(spark, sf, "pages").select(
        F.regexp_extract("url", "^[a-z]+://([^/?#]*)", 1).alias("host"), "page_id"
    )
    return dedupe.result_dedupe(pages, [], ["host"], "page_id")


@catalog.query(
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey) AS index FROM lineitem"""
)
def table_index(spark, sf):
    """Running index over a whole table."""
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return ordering.running_index(lines, [], lines.columns)


# --- document order -----------------------------------------------------------------------------


@catalog.query(
    """SELECT conv_id, turn, string_agg(text, ' ') OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN 2 PRECEDING AND 4 FOLLOWING) AS context FROM conversations"""
)
def context_window(spark, sf):
    lines = table(spark, sf, "conversations").select("conv_id", "turn", "text")
    return ordering.context_rows(lines, ["conv_id"], "turn", "text").drop("text")


@catalog.query(
    """SELECT conv_id, turn, last_value(CASE WHEN role = 'user' THEN text END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn) AS section
    FROM conversations"""
)
def heading_fill(spark, sf):
    rows = table(spark, sf, "conversations")
    filled = ordering.nearest_heading(rows, ["conv_id"], "turn", F.when(F.col("role") == "user", F.col("text")))
    return filled.select("conv_id", "turn", "section")


@catalog.query(
    """WITH owned AS (SELECT *, max(CASE WHEN event_type = 'signup' THEN event_id END) OVER (PARTITION BY user_id ORDER BY event_id) AS owner FROM events),
      orphan AS (SELECT user_id, owner, arg_min(value, event_id) AS value FROM owned WHERE event_type = 'purchase' AND value < 80 AND owner IS NOT NULL GROUP BY ALL)
    SELECT e.user_id, e.event_id, CASE WHEN e.value > 40 THEN e.value END AS own_price, coalesce(CASE WHEN e.value > 40 THEN e.value END, o.value) AS resolved_price
    FROM events e LEFT JOIN orphan o ON e.user_id = o.user_id AND e.event_id = o.owner WHERE e.event_type = 'signup'"""
)
def orphan_attach(spark, sf):
    titled = F.col("event_type") == "signup"
    rows = table(spark, sf, "events").select(
        "user_id", "event_id", "event_type", "value", F.when(F.col("value") > 40, F.col("value")).alias("own_price")
    )
    orphan = F.when((F.col("event_type") == "purchase") & (F.col("value") < 80), F.col("value"))
    priced = ordering.attach_orphan_prices(rows, ["user_id"], "event_id", titled, F.col("own_price"), orphan)
    return priced.select("user_id", "event_id", "own_price", "resolved_price")


@catalog.query(
    """WITH mid AS (SELECT *, l_suppkey >= 50 AS is_right FROM lineitem), sides AS (SELECT l_orderkey, count(*) FILTER (NOT is_right) AS nl, count(*) FILTER (is_right) AS nr FROM mid GROUP BY ALL),
      placed AS (SELECT m.*, CASE WHEN nl >= 3 AND nr >= 3 AND is_right THEN 1 ELSE 0 END AS column_no FROM mid m JOIN sides USING (l_orderkey))
    SELECT l_orderkey, l_suppkey, l_partkey, l_linenumber, column_no,
      row_number() OVER (PARTITION BY l_orderkey ORDER BY column_no, l_quantity, l_suppkey, l_partkey, l_linenumber) AS block_no FROM placed"""
)
def reading_order(spark, sf):
    blocks = table(spark, sf, "lineitem").select("l_orderkey", "l_suppkey", "l_partkey", "l_linenumber", "l_quantity")
    return ordering.reading_order(
        blocks, ["l_orderkey"], "l_suppkey", "l_quantity", F.lit(50), ["l_suppkey", "l_partkey", "l_linenumber"]
    ).drop("l_quantity")


@catalog.query(
    """WITH block AS (SELECT *, CASE WHEN l_orderkey % 3 = 0 THEN 0 ELSE l_orderkey END AS page FROM lineitem),
      mid AS (SELECT *, l_suppkey >= 50 AS is_right, count(*) FILTER (l_suppkey < 50) OVER p AS nl, count(*) FILTER (l_suppkey >= 50) OVER p AS nr FROM block WINDOW p AS (PARTITION BY page)),
      placed AS (SELECT *, CASE WHEN nl >= 3 AND nr >= 3 AND is_right THEN 1 ELSE 0 END AS column_no FROM mid)
    SELECT page, l_orderkey, l_suppkey, l_partkey, l_linenumber, column_no,
      row_number() OVER (PARTITION BY page ORDER BY column_no, l_quantity, l_suppkey, l_partkey, l_linenumber, l_orderkey) AS block_no FROM placed"""
)
def oversized_page_order(spark, sf):
    """Reading order where one page holds a third of all blocks."""
    page = F.when(F.col("l_orderkey") % 3 == 0, 0).otherwise(F.col("l_orderkey")).cast("bigint").alias("page")
    blocks = table(spark, sf, "lineitem").select(page, "l_orderkey", "l_suppkey", "l_partkey", "l_linenumber", "l_quantity")
    ties = ["l_suppkey", "l_partkey", "l_linenumber", "l_orderkey"]
    return ordering.reading_order(blocks, ["page"], "l_suppkey", "l_quantity", F.lit(50), ties).drop("l_quantity")


@catalog.query(
    """WITH s AS (SELECT p_partkey, coalesce(nullif(trim(regexp_replace(CASE WHEN p_size = 7 THEN '!!' ELSE lower(p_name) END, '[^a-z0-9]+', '-', 'g'), '-'), ''),
        'section-' || left(sha256(p_brand), 8)) AS slug, left(sha256(p_brand), 8) AS digest FROM part)
    SELECT p_partkey, CASE WHEN row_number() OVER (PARTITION BY slug ORDER BY p_partkey) = 1 THEN slug ELSE slug || '-' || digest END AS slug FROM s"""
)
def slug_unique(spark, sf):
    digest = F.substring(F.sha2("p_brand", 256), 1, 8)
    rows = table(spark, sf, "part").select(
        "p_partkey", F.when(F.col("p_size") == 7, "!!").otherwise(F.upper("p_name")).alias("title"), "p_brand"
    )
    return ordering.unique_slugs(rows, "title", "p_partkey", digest, F.concat(F.lit("section-"), digest)).select("p_partkey", "slug")


@catalog.query(
    """SELECT p_partkey, p_name || E'\\n' || 'about ' || p_type || E'\\n\\n' || p_brand || E'\\n' || 'bottom' || E'\\n' || 'only price' || E'\\n\\nlast\\nsame' AS body FROM part"""
)
def section_text(spark, sf):
    item = lambda title, description, top, bottom: F.struct(
        title.alias("title"), description.alias("description"), F.lit(top).alias("price_top"), F.lit(bottom).alias("price_bottom")
    )
    items = F.array(
        item(F.col("p_brand"), F.lit(""), "top", "bottom"), item(F.lit(""), F.lit(""), "only price", ""), item(F.lit("last"), F.lit("same"), "same", ""),
    )
    body = reports.section_text(items, F.col("p_name"), F.concat(F.lit("about "), "p_type"))
    return table(spark, sf, "part").select("p_partkey", body.alias("body"))


@catalog.query(
    """SELECT o_orderkey, 'Result ' || o_orderkey || E'\\nTitle: ' || o_orderpriority || E'\\nURL: ' || o_orderstatus || E'\\nText: ' AS block,
      o_orderpriority || ' / ' || o_orderstatus AS block_title FROM orders"""
)
def result_blocks(spark, sf):
    block = reports.result_block(F.col("o_orderkey"), F.col("o_orderpriority"), F.col("o_orderstatus"), F.lit(None).cast("string"))
    title = reports.block_title(F.array(F.col("o_orderpriority"), F.lit(""), F.col("o_orderstatus")))
    return table(spark, sf, "orders").select("o_orderkey", block.alias("block"), title.alias("block_title"))


PRINTED_SQL = """printed AS (SELECT user_id, event_id, CASE WHEN event_type IN ('signup', 'view') THEN event_type || ' ' || event_id ELSE '' END AS title,
  CASE event_type WHEN 'signup' THEN '' WHEN 'view' THEN 'served hot' WHEN 'purchase' THEN '$' || printf('%.2f', value) WHEN 'click' THEN 'call us' ELSE '' END AS shown,
  CASE WHEN event_type = 'view' AND value > 20 THEN 'nice' ELSE '' END AS description FROM events)"""


@catalog.query(
    f"""WITH {PRINTED_SQL}, owned AS (SELECT *, max(CASE WHEN title <> '' THEN event_id END) OVER (PARTITION BY user_id ORDER BY event_id) AS owner FROM printed),
      orphan AS (SELECT user_id, owner, arg_min(shown, event_id) AS shown FROM owned WHERE title = '' AND contains(shown, '$') AND owner IS NOT NULL GROUP BY ALL)
    SELECT p.user_id, p.event_id, p.title, trim(p.description || ' ' || p.shown) AS description, coalesce(o.shown, '') AS price
    FROM printed p LEFT JOIN orphan o ON p.user_id = o.user_id AND p.event_id = o.owner WHERE p.title <> ''"""
)
def menu_page_items(spark, sf):
    kind = F.col("event_type")
    amount = F.concat(F.lit("$ "), F.col("value").cast("decimal(12,2)").cast("string"))
    rows = table(spark, sf, "events").select(
        "user_id", "event_id",
        F.when(kind.isin("signup", "view"), F.concat_ws("  ", kind, F.col("event_id").cast("string"))).otherwise("").alias("title"),
        F.when((kind == "view") & (F.col("value") > 20), "nice").otherwise("").alias("description"),
        F.when(kind == "view", "served  hot").when(kind == "click", "call us").otherwise("").alias("price_top"),
        F.when(kind == "purchase", amount).otherwise("").alias("price_bottom"),
    )
    return ordering.menu_page_items(rows, ["user_id"], "event_id")


@catalog.query(
    """SELECT source, arg_min(doc_id, doc_id) AS doc_id, arg_min(n_chars, doc_id) AS n_chars FROM documents WHERE lang = 'de' GROUP BY source"""
)
def first_section(spark, sf):
    sections = table(spark, sf, "documents").select("source", F.col("lang").alias("title"), "doc_id", "n_chars")
    return ordering.first_section(sections, ["source"], "title", "de", "doc_id").drop("title")


@catalog.query(
    """SELECT s.l_orderkey, arg_min(l.l_suppkey, l.l_linenumber * 1000000 + l.l_partkey) AS l_suppkey FROM (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_returnflag = 'R') s
      JOIN lineitem l ON l.l_orderkey = s.l_orderkey WHERE l.l_returnflag = 'R' GROUP BY ALL"""
)
def required_section(spark, sf):
    """The first wanted section of every document; a document without one would be an error."""
    # As in the SQL: part keys from a million on reach into the next line number, lines without a key or a
    # supplier come last and have none. Of equal keys the first line of the table counts: the SQL reads it first.
    key = F.col("l_linenumber").cast("bigint") * 1000000 + F.col("l_partkey")
    supplier = F.when(key.isNotNull(), F.col("l_suppkey"))
    at = F.struct(supplier.isNull().alias("none"), key.alias("key"), "_metadata.file_path", "_metadata.row_index")
    lines = table(spark, sf, "lineitem").select("l_orderkey", F.col("l_returnflag").alias("title"), at.alias("at"), supplier.alias("l_suppkey"))
    with_one = lines.filter("title = 'R'").select("l_orderkey").distinct()
    return ordering.section_or_error(lines.join(with_one, "l_orderkey", "left_semi"), ["l_orderkey"], "title", "R", "at").select("l_orderkey", "l_suppkey")


@catalog.query(
    r"""SELECT doc_id FROM documents WHERE source = 'src1' OR (source = 'src3' AND contains(text, 'the of'))
      OR (source = 'src4' AND regexp_matches(text, '(?i)(\$\d|taco|burrito|enchilada|fajita|quesadilla|nacho|chimichanga|menu|lunch|dinner|appetizer|dessert|drink|margarita|salsa|guacamole)'))"""
)
def included_pages(spark, sf):
    pages = table(spark, sf, "documents").select(
        "doc_id", "source", "text", F.concat(F.lit("https://GrubHub.com/restaurant/"), F.col("doc_id").cast("string")).alias("url")
    )
    return links.included_pages(pages, "src1", "src3", "the of", "src4", ["grubhub.com/restaurant"]).select("doc_id")


@catalog.query(
    """SELECT doc_id, chr(10) || repeat('=', 60) || chr(10) || 'Source: ' || source || chr(10) || 'URL: ' || lang || chr(10) || 'Title: ' || n_chars || chr(10)
      || repeat('=', 60) || chr(10) || chr(10) || text AS block FROM documents"""
)
def source_blocks(spark, sf):
    block = reports.source_block(F.col("source"), F.col("lang"), F.col("n_chars").cast("string"), F.col("text"))
    return table(spark, sf, "documents").select("doc_id", block.alias("block"))


@catalog.query(
    """SELECT n_regionkey AS "group", string_agg(n_name, chr(10) || chr(10) || chr(10) ORDER BY n_nationkey DESC) AS text FROM nation GROUP BY n_regionkey"""
)
def grouped_text(spark, sf):
    """Nations as texts of a fixed region dimension: the dimension bounds the length."""
    nations = table(spark, sf, "nation")
    groups = nations.select(F.col("n_regionkey").alias("group"), (-F.col("n_nationkey")).alias("pos"), F.col("n_name").alias("key"))
    texts = nations.select(F.col("n_name").alias("key"), F.concat(F.lit("  "), "n_name", F.lit(" ")).alias("text"))
    return reports.grouped_text(texts, groups, "key")


@catalog.query(
    """SELECT p_partkey, CASE WHEN p_size > 25 THEN p_name ELSE p_brand || chr(10) || chr(10) || p_type END AS message,
      left('{"a":"' || p_name || '","b":' || p_size || '}', 20) AS preview, CASE WHEN p_size > 10 THEN p_type ELSE p_brand END AS top_price,
      CASE WHEN p_size > 40 THEN p_type ELSE p_brand END AS bottom_price, CASE WHEN p_size < 5 THEN p_brand ELSE p_name END AS first_text FROM part"""
)
def text_choices(spark, sf):
    size = F.col("p_size")
    part = lambda c: F.struct(F.col(c).alias("text"))
    parts = F.when(size <= 25, F.array(part("p_brand"), F.struct(F.lit("").alias("text")), part("p_type")))
    top, bottom = F.when(size > 10, F.col("p_type")).otherwise(""), F.when(size <= 40, F.col("p_brand"))
    return table(spark, sf, "part").select(
        "p_partkey",
        tx.message_text(F.concat(F.lit(" "), F.col("p_name")), parts).alias("message"),
        tx.json_preview(F.struct(F.col("p_name").alias("a"), size.alias("b")), 20).alias("preview"),
        price.price_slot(top, bottom).alias("top_price"),
        price.price_slot(F.col("p_type"), bottom, prefer="bottom").alias("bottom_price"),
        tx.first_text(F.when(size < 5, F.lit("  ")).otherwise(F.col("p_name")), F.col("p_brand")).alias("first_text"),
    )


# --- matching and arrays ------------------------------------------------------------------------


@catalog.query(
    """WITH place AS (SELECT s_suppkey, lower(n_name) AS city, list_filter(list_distinct(regexp_extract_all(lower(s_name || ' lot' || (s_suppkey * 3)), '[a-z0-9]+')), lambda t: length(t) > 2 AND t <> 'supplier') AS tokens
        FROM supplier JOIN nation ON s_nationkey = n_nationkey),
      page AS (SELECT c_custkey, lower(c_name || ' ' || n_name || ' lot' || (c_custkey * CASE WHEN c_acctbal < 500 THEN 3 ELSE 5 END)) AS hay FROM customer JOIN nation ON c_nationkey = n_nationkey),
      pt AS (SELECT s_suppkey, city, len(tokens) AS n, unnest(tokens) AS t FROM place),
      ct AS (SELECT c_custkey, hay, unnest(list_filter(list_distinct(regexp_extract_all(hay, '[a-z0-9]+')), lambda t: length(t) > 2 AND t <> 'supplier')) AS t FROM page),
      met AS (SELECT s_suppkey, c_custkey, bool_or(contains(hay, city)) AS city_match, max(n) AS n, count(*) AS overlap, string_agg(t, ', ' ORDER BY t) AS shared_tokens
        FROM pt JOIN ct USING (t) GROUP BY ALL)
    SELECT s_suppkey, c_custkey, city_match, overlap, shared_tokens, CASE WHEN city_match THEN 'city match plus token overlap: ' ELSE 'name token overlap: ' END || shared_tokens AS reason
    FROM met WHERE city_match OR (n >= 2 AND overlap >= 2)"""
)
def token_match(spark, sf):
    """Suppliers and customers meet on numbers and lots; the word that is in every name is a stopword."""
    nations = table(spark, sf, "nation")
    lot = lambda key, times: F.concat(F.lit("lot"), (F.col(key) * times).cast("string"))
    places = table(spark, sf, "supplier").join(nations, F.col("s_nationkey") == F.col("n_nationkey")).select(
        "s_suppkey", F.concat_ws(" ", "s_name", lot("s_suppkey", 3)).alias("s_name"), "n_name"
    )
    pages = table(spark, sf, "customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey", F.concat_ws(" ", "c_name", "n_name", F.when(F.col("c_acctbal") < 500, lot("c_custkey", 3)).otherwise(lot("c_custkey", 5))).alias("hay")
    )
    return matching.token_matches(
        places, pages, "s_suppkey", "c_custkey", F.col("s_name"), F.col("n_name"), F.col("hay"), [*tx.NAME_STOPWORDS, "supplier"]
    )


def _vector_pairs(spark: SparkSession, sf: str) -> DataFrame:
    vectors = table(spark, sf, "embeddings")
    following = vectors.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("other"))
    return vectors.join(following, "vec_id")


DIFFS_SQL = """diff AS (SELECT a.label, unnest(generate_series(1, len(a.embedding))) AS i,
  abs(unnest(a.embedding)::DOUBLE - unnest(b.embedding)::DOUBLE) AS d, abs(unnest(b.embedding)::DOUBLE) AS w
  FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1)"""


@catalog.query(
    f"""WITH {DIFFS_SQL}, regions AS (SELECT label, 'whole' AS region, true AS inside, d FROM diff UNION ALL SELECT label, 'seed', i <= 16, d FROM diff
      UNION ALL SELECT label, 'generated', i > 16, d FROM diff)
    SELECT label, region, round(100.0 * count(*) FILTER (inside) / count(*), 6) AS coverage_pct, round(avg(d) FILTER (inside), 6) AS mae,
      round(100.0 * count(*) FILTER (inside AND d = 0) / count(*) FILTER (inside), 6) AS exact_pct,
      round(100.0 * count(*) FILTER (inside AND d <= 0.1) / count(*) FILTER (inside), 6) AS within_10_pct,
      round(100.0 * count(*) FILTER (inside AND d <= 0.25) / count(*) FILTER (inside), 6) AS within_25_pct
    FROM regions GROUP BY label, region"""
)
def array_error(spark, sf):
    regions = {"whole": lambda i: F.lit(True), "seed": lambda i: i < 16, "generated": lambda i: i >= 16}
    metrics = arrays.region_metrics(
        _vector_pairs(spark, sf), ["label"], "embedding", "other", regions, {"within_10": 0.1, "within_25": 0.25}
    )
    rounded = [F.round(c, 6).alias(c) for c in ("coverage_pct", "mae", "exact_pct", "within_10_pct", "within_25_pct")]
    return metrics.select("label", "region", *rounded)


@catalog.query(f"WITH {DIFFS_SQL} SELECT label, round(sum(d * w) / sum(w), 6) AS weighted_mae FROM diff GROUP BY label")
def weighted_error(spark, sf):
    pairs = _vector_pairs(spark, sf).withColumn("w", F.transform("other", lambda x: F.abs(x.cast("double"))))
    return arrays.weighted_mae(pairs, ["label"], "embedding", "other", "w").withColumn("weighted_mae", F.round("weighted_mae", 6))
