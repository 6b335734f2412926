"""Item step of required-group pricing, modifier lookup, nested menus and the line reader."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from dishframe.functions import price as money
from dishframe.operators import required
from dishframe.plans.menu_plans import MODIFIER_SQL, modifier_rows
from dishframe.plans.tables import Catalog, table
from dishframe.session import checkpoint_dir
from dishframe.sources import files, sinks, snapshots

catalog = Catalog()

DOLLARS = "'$' || printf('%.2f', {0})"

NOTES_SQL = f"""{MODIFIER_SQL},
line AS (SELECT l_orderkey, l_returnflag AS grp, l_linenumber, l_partkey, l_suppkey, floor(l_quantity / 20) AS price FROM lineitem WHERE l_linenumber <> 6),
named AS (SELECT o.*, g.pick, g.lo = g.hi AS same, CASE WHEN g.lo = g.hi THEN l_partkey::VARCHAR ELSE l_partkey || ' (' || {DOLLARS.format('price::DOUBLE')} || ')' END AS t
  FROM line o JOIN grp g ON o.l_orderkey = g.l_orderkey AND o.grp = g.grp WHERE g.lo = g.hi OR o.price > g.lo),
part AS (SELECT l_orderkey, grp, pick, same, string_agg(t, ', ' ORDER BY l_linenumber, l_partkey, l_suppkey, t) AS names FROM named GROUP BY ALL),
note AS (SELECT l_orderkey, string_agg('Group ' || grp || ': ' || CASE WHEN same THEN {{choose}} || ' - ' || names ELSE names || ' available for an extra charge' END, '; ' ORDER BY grp) AS notes FROM part GROUP BY l_orderkey),
addition AS (SELECT l_orderkey, sum(CASE WHEN lo = hi THEN {{equal}} ELSE cheapest END)::DOUBLE AS addition FROM grp GROUP BY l_orderkey)"""

FLAGS_SQL = """kinds AS (SELECT l_orderkey, l_returnflag AS g, bool_or(l_linenumber <> 6) AS priced,
    list_sort(list(DISTINCT CASE WHEN l_returnflag = 'A' AND l_linenumber > 2 THEN 'radio' ELSE 'checkbox' END)) AS kinds,
    CASE l_returnflag WHEN 'R' THEN 'checkbox' ELSE 'radio' END AS expected FROM lineitem WHERE l_returnflag IN ('R', 'A') GROUP BY ALL),
flag AS (SELECT l_orderkey, string_agg('group ''Group ' || g || ''' rule says ''' || CASE g WHEN 'R' THEN 'Required - select 2' ELSE 'Required' END
    || ''' (implies ' || expected || ') but option inputs are [' || array_to_string(list_transform(kinds, lambda k: '''' || k || ''''), ', ') || ']', '|' ORDER BY g) AS flags
  FROM kinds WHERE priced AND kinds <> [expected] GROUP BY l_orderkey)"""


def _notes(rows: DataFrame, groups: DataFrame, mode: str) -> DataFrame:
    options = rows.select("l_orderkey", "group_pos", "group_name", "option_pos", "name", "price")
    return required.render_notes(required.note_parts(options, groups, ["l_orderkey"]), ["l_orderkey"], mode)


@catalog.query(
    f"""WITH {NOTES_SQL.format(choose="CASE WHEN pick = 1 THEN 'choose one' ELSE 'choose ' || pick END", equal='lo')}, {FLAGS_SQL},
    item AS (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN '$0.00' ELSE '$5.00' END AS price, o_orderkey % 4 <> 0 AS has_modifiers, o_orderstatus AS description FROM orders),
    met AS (SELECT item.*, coalesce(addition, 0) AS total, notes, flags, price = '$0.00' AND has_modifiers AS zero FROM item
      LEFT JOIN addition a ON a.l_orderkey = o_orderkey LEFT JOIN note n ON n.l_orderkey = o_orderkey LEFT JOIN flag f ON f.l_orderkey = o_orderkey)
    SELECT o_orderkey AS l_orderkey, CASE WHEN zero THEN {DOLLARS.format('total')} ELSE price END AS price, CASE WHEN zero AND notes IS NOT NULL THEN notes ELSE description END AS description,
      CASE WHEN zero THEN nullif(concat_ws('|', flags, CASE WHEN total = 0 THEN '{required.STILL_ZERO_REPLACED}' END), '') END AS flags FROM met"""
)
def item_step_replacing(spark, sf):
    """Zero-priced items take the required groups' sum; notes replace the description; disagreements are flagged."""
    rows, pick = modifier_rows(spark, sf), money.required_count(F.col("rule_text"))
    groups = required.priced_groups(rows, ["l_orderkey"], pick, "once")
    key = F.col("o_orderkey")
    items = table(spark, sf, "orders").select(
        key.alias("l_orderkey"), F.when(key % 3 == 0, "$0.00").otherwise("$5.00").alias("price"), (key % 4 != 0).alias("has_modifiers"), F.col("o_orderstatus").alias("description")
    )
    done = required.apply_replacing(
        items, required.item_additions(groups, ["l_orderkey"]), _notes(rows, groups, "once"), required.input_type_flags(rows, ["l_orderkey"], pick), ["l_orderkey"]
    )
    return done.select("l_orderkey", "price", "description", F.array_join("review_flags", "|").alias("flags"))


@catalog.query(
    f"""WITH {NOTES_SQL.format(choose="'choose ' || pick", equal='lo * pick')},
    item AS (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 0.0 ELSE 5.0 END AS low, CASE WHEN o_orderkey % 5 = 0 THEN 7.5 END AS high, o_orderkey % 4 <> 0 AS has_modal,
      CASE WHEN o_orderkey % 8 = 0 THEN 'preview' ELSE 'live' END AS mode, o_orderstatus AS description FROM orders),
    met AS (SELECT item.*, addition, notes, has_modal AND low = 0 AS zero, has_modal AND low = 0 AND addition IS NOT NULL AS resolved FROM item
      LEFT JOIN addition a ON a.l_orderkey = o_orderkey LEFT JOIN note n ON n.l_orderkey = o_orderkey)
    SELECT o_orderkey AS l_orderkey, CASE WHEN resolved THEN {DOLLARS.format('addition')} ELSE {DOLLARS.format('low::DOUBLE')} END AS price,
      CASE WHEN resolved AND notes IS NOT NULL THEN concat_ws('; ', description, notes) WHEN high IS NOT NULL THEN concat_ws('; ', description, 'Options up to ' || {DOLLARS.format('high::DOUBLE')}) ELSE description END AS description,
      CASE WHEN NOT has_modal THEN CASE mode WHEN 'preview' THEN '{required.CLOSED_PREVIEW}' ELSE '{required.NOT_REACHED}' END
        WHEN resolved AND addition = 0 THEN '{required.STILL_ZERO_APPENDED}' WHEN zero AND NOT resolved THEN '{required.NO_REQUIRED_GROUP}' END AS flags FROM met"""
)
def item_step_appending(spark, sf):
    """As above on the platform that multiplies equal prices: notes and ranges follow the description."""
    rows = modifier_rows(spark, sf)
    groups = required.priced_groups(rows, ["l_orderkey"], money.required_pick(F.col("pick_text")), "times")
    key, cents = F.col("o_orderkey"), money.MONEY
    items = table(spark, sf, "orders").select(
        key.alias("l_orderkey"), F.lit(None).cast("string").alias("card_price"), F.when(key % 3 == 0, 0).otherwise(5).cast(cents).alias("low"),
        F.when(key % 5 == 0, 7.5).cast(cents).alias("high"), (key % 4 != 0).alias("has_modal"), F.when(key % 8 == 0, "preview").otherwise("live").alias("order_mode"), F.col("o_orderstatus").alias("description"),
    )
    done = required.apply_appending(items, required.item_additions(groups, ["l_orderkey"]), _notes(rows, groups, "times"), ["l_orderkey"])
    return done.select("l_orderkey", "price", "description", F.array_join("review_flags", "|").alias("flags"))


def _lookup(spark: SparkSession, sf: str, by: str) -> DataFrame:
    """Lines as zero-priced or priced items of their order; the lines of flag R are the captured modifiers."""
    lines = table(spark, sf, "lineitem")
    items = lines.select(
        "l_orderkey", F.col("l_linenumber").alias("pos"), F.concat(F.lit("/item/"), F.col("l_partkey").cast("string")).alias("href"),
        F.when(F.col("l_linenumber") % 2 == 0, "$0.00").otherwise("$1.00").alias("price"),
    )
    key = F.concat(F.lit("/item/"), F.col("l_partkey").cast("string")) if by == "href" else F.col("l_linenumber").cast("string")
    modifiers = lines.filter(F.col("l_returnflag") == "R").groupBy("l_orderkey", key.alias("key")).agg(F.max("l_suppkey").alias("group_name"))
    key_of = F.col("href") if by == "href" else F.col("pos").cast("string")
    return required.modifiers_of_zero_priced(items, modifiers, ["l_orderkey"], key_of).select("l_orderkey", "pos", "group_name")


def _lookup_sql(item_key: str, modifier_key: str) -> str:
    return f"""SELECT l.l_orderkey, l.l_linenumber AS pos, m.group_name FROM lineitem l LEFT JOIN (SELECT l_orderkey, {modifier_key} AS key, max(l_suppkey) AS group_name
      FROM lineitem WHERE l_returnflag = 'R' GROUP BY ALL) m ON m.l_orderkey = l.l_orderkey AND m.key = {item_key} WHERE l.l_linenumber % 2 = 0"""


@catalog.query(_lookup_sql("'/item/' || l.l_partkey", "'/item/' || l_partkey"))
def modifiers_by_href(spark, sf):
    return _lookup(spark, sf, "href")


@catalog.query(_lookup_sql("l.l_linenumber::VARCHAR", "l_linenumber::VARCHAR"))
def modifiers_by_position(spark, sf):
    return _lookup(spark, sf, "position")


@catalog.query(
    """WITH sections AS (SELECT p_brand, p_type, min(p_partkey) AS first, string_agg(p_name || '=' || p_size, ',' ORDER BY p_partkey) AS items FROM part GROUP BY ALL)
    SELECT p_brand, count(*)::INT AS n_sections, string_agg(p_type || ':' || items, '|' ORDER BY first) AS menu FROM sections GROUP BY p_brand"""
)
def menu_document(spark, sf):
    """Nested menus, one document a brand, rendered for comparison."""
    items = table(spark, sf, "part").select("p_brand", F.col("p_type").alias("section"), F.col("p_partkey").alias("pos"), F.col("p_name").alias("title"), F.col("p_size").alias("size"))
    shown = lambda s: F.concat(s["section"], F.lit(":"), F.array_join(F.transform(s["items"], lambda i: F.concat(i["title"], F.lit("="), i["size"].cast("string"))), ","))
    menus = sinks.menu_documents(items, ["p_brand"], ["title", "size"])
    return menus.select("p_brand", F.size("menu_sections").alias("n_sections"), F.array_join(F.transform("menu_sections", shown), "|").alias("menu"))


@catalog.query(
    """WITH s AS (SELECT *, min(p_partkey) OVER (PARTITION BY p_brand, p_type) AS section_at, max(p_partkey) OVER (PARTITION BY p_brand, p_type) AS last,
      min(p_partkey) OVER (PARTITION BY p_brand) AS head FROM part), t AS (SELECT *, max(section_at) OVER (PARTITION BY p_brand) AS tail FROM s)
    SELECT p_brand, p_type AS section, p_partkey AS pos, section_at,
      CASE WHEN p_partkey = head THEN '{"p_brand":"' || p_brand || '","menu_sections":[' ELSE ',' END
      || CASE WHEN p_partkey = section_at THEN '{"section":"' || p_type || '","items":[' ELSE '' END
      || '{"title":"' || p_name || '","size":' || p_size || '}'
      || CASE WHEN p_partkey = last THEN ']}' ELSE '' END || CASE WHEN p_partkey = last AND section_at = tail THEN ']}' ELSE '' END AS line FROM t"""
)
def menu_long_form(spark, sf):
    """Nested menus as ordered lines that open and close their documents, for brands larger than a task."""
    items = table(spark, sf, "part").select("p_brand", F.col("p_type").alias("section"), F.col("p_partkey").alias("pos"), F.col("p_name").alias("title"), F.col("p_size").alias("size"))
    return sinks.menu_lines(items, ["p_brand"], ["title", "size"]).drop("menu_key")


@catalog.query(
    """SELECT p_partkey::VARCHAR AS id, CASE WHEN p_size % 2 = 0 THEN 'node' ELSE 'way' END AS type, p_name AS name, CASE WHEN p_size % 3 = 0 THEN p_type END AS cuisine FROM part"""
)
def poi_lines(spark, sf):
    """Features written as JSON lines to the shared folder and read back with the declared schema."""
    tags = F.map_filter(F.create_map(F.lit("name"), F.col("p_name"), F.lit("cuisine"), F.when(F.col("p_size") % 3 == 0, F.col("p_type"))), lambda _, v: v.isNotNull())
    records = table(spark, sf, "part").select(F.when(F.col("p_size") % 2 == 0, "node").otherwise("way").alias("type"), F.col("p_partkey").cast("string").alias("id"), tags.alias("tags"))
    path = f"{checkpoint_dir(spark).rstrip('/')}/poi-lines-{uuid.uuid4().hex}"
    records.write.json(path)
    read = files.poi_records(spark, path)
    return read.select("id", "type", F.col("tags")["name"].alias("name"), F.try_element_at("tags", F.lit("cuisine")).alias("cuisine"))


def _folder(spark: SparkSession, kind: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/{kind}-{uuid.uuid4().hex}"


@catalog.query(
    """SELECT c_custkey::VARCHAR AS id, 'node' AS type, round(c_acctbal, 2) AS lat, NULL AS refs, c_nationkey::VARCHAR AS version, 'Shop <' || c_mktsegment || '> & "Co"' AS name,
      CASE WHEN c_mktsegment = 'MACHINERY' THEN 'subtype' END AS diet FROM customer
    UNION ALL SELECT o_orderkey::VARCHAR, 'way', NULL, o_custkey || ',' || o_custkey + 1 || ',' || o_custkey, NULL, o_orderpriority, NULL FROM orders"""
)
def map_elements(spark, sf):
    """Nodes and ways written as one map extract and read in one scan of mixed siblings."""
    quoted = lambda text: F.replace(F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit('"'), F.lit("&quot;"))
    tag = lambda k, v: F.concat(F.lit(f'<tag k="{k}" v="'), quoted(v), F.lit('"/>'))
    text = lambda c: F.col(c).cast("string")
    customers = table(spark, sf, "customer")
    nodes = customers.select(
        F.concat(
            F.lit('<node id="'), text("c_custkey"), F.lit('" lat="'), F.round("c_acctbal", 2).cast("string"), F.lit('" lon="1" version="'), text("c_nationkey"), F.lit('">'),
            tag("name", F.concat(F.lit("Shop <"), F.col("c_mktsegment"), F.lit('> & "Co"'))),
            F.when(F.col("c_mktsegment") == "MACHINERY", F.lit('\n  <tag k="diet:halal" v="yes"/>')).otherwise(""), F.lit("</node><relation id='1'/>"),
        ).alias("line")
    )
    ref = lambda c: F.concat(F.lit('<nd ref="'), c.cast("string"), F.lit('"/>'))
    ways = table(spark, sf, "orders").select(
        F.concat(
            F.lit("<way id='"), text("o_orderkey"), F.lit("'>"), ref(F.col("o_custkey")), ref(F.col("o_custkey") + 1), ref(F.col("o_custkey")), tag("name", F.col("o_orderpriority")), F.lit("</way>")
        ).alias("line")
    )
    path = _folder(spark, "map")
    nodes.unionByName(ways).write.text(path)
    read = files.features(spark, path)
    return read.select(
        "id", "type", "lat", F.array_join("node_refs", ",").alias("refs"), F.col("osm.version").alias("version"),
        F.try_element_at("tags", F.lit("name")).alias("name"), F.try_element_at("tags", F.lit("diet")).alias("diet"),
    )


@catalog.query(
    """SELECT '{' || CASE WHEN c_acctbal > 0 THEN '"balance":"' || c_mktsegment || '",' ELSE '' END || '"id":' || c_custkey || ',"name":"Customer ' || c_custkey || '"}' AS line FROM customer"""
)
def sorted_json_lines(spark, sf):
    """Records written as JSON lines with fields in name order, NULL fields left out."""
    path = _folder(spark, "sorted-json")
    records = table(spark, sf, "customer").select(
        F.concat(F.lit("Customer "), F.col("c_custkey").cast("string")).alias("name"), F.col("c_custkey").alias("id"), F.when(F.col("c_acctbal") > 0, F.col("c_mktsegment")).alias("balance")
    )
    sinks.sorted_json(records, path)
    return spark.read.text(path).withColumnRenamed("value", "line")


@catalog.query(
    """WITH named AS (SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN p_brand ELSE p_name END AS name, CASE WHEN p_size % 2 = 0 THEN p_type ELSE '' END AS city FROM part WHERE p_size % 3 < 2)
    SELECT p_partkey::VARCHAR AS id, name, city, concat_ws(' ', p_partkey, nullif(city, ''), 'MI') AS address FROM named ORDER BY id LIMIT 100"""
)
def restaurant_list(spark, sf):
    """First named restaurants of a file of features; the official name stands in, unnamed ones are skipped."""
    size, key = F.col("p_size"), F.col("p_partkey").cast("string")
    pairs = F.create_map(
        F.lit("name"), F.when(size % 3 == 1, F.col("p_name")), F.lit("official_name"), F.when(size % 3 == 0, F.col("p_brand")),
        F.lit("addr:city"), F.when(size % 2 == 0, F.col("p_type")), F.lit("addr:housenumber"), key,
    )
    records = table(spark, sf, "part").select(F.lit("node").alias("type"), key.alias("id"), F.map_filter(pairs, lambda _, v: v.isNotNull()).alias("tags"))
    path = _folder(spark, "restaurants")
    records.write.json(path)
    return files.restaurants(files.poi_records(spark, path), "id", 100).select("id", "name", "city", "address")


class _Stopped(Exception):
    pass


@catalog.query(
    """SELECT o_orderkey::VARCHAR AS item_id, o_orderkey AS menu_position,
      CASE WHEN o_orderkey % 4 < 2 AND o_custkey % 5 <> 0 THEN 'first ' ELSE 'second ' END || o_orderpriority AS item_page,
      CASE WHEN o_orderkey % 4 < 2 AND o_custkey % 5 <> 0 THEN o_orderkey % 4 ELSE 2 END::INT AS version FROM orders"""
)
def harvest_resume(spark, sf):
    """A harvest in four portions stops in the third, whose rows are written but not committed; the next run fetches the rest."""
    schema = "item_id string, menu_position long, item_page string"
    items = table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("item_id"), F.col("o_orderkey").alias("menu_position"), "o_orderpriority", "o_custkey"
    )
    path, calls = _folder(spark, "harvest"), []

    def fetched(run: str, failed):
        page = F.when(failed, F.lit(None)).otherwise(F.concat(F.lit(run), F.lit(" "), F.col("o_orderpriority")))
        return lambda todo: todo.select("item_id", "menu_position", page.alias("item_page"))

    def stops(todo: DataFrame) -> DataFrame:
        calls.append(todo)
        rows = fetched("first", F.col("o_custkey") % 5 == 0)(todo)
        if len(calls) == 3:
            snapshots.write_increment(rows, path, 2)
            raise _Stopped
        return rows

    try:
        snapshots.harvest(spark, path, items, stops, schema, steps=4, portion=F.col("menu_position"))
    except _Stopped:
        pass
    return snapshots.harvest(spark, path, items, fetched("second", F.lit(False)), schema)
