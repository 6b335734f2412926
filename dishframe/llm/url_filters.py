"""URL filters by a path-template tree.

Per host, the path segments are walked from the root. At a node, a segment that holds enough
urls stays a literal branch, however many siblings it has; the others are variable and become the wildcard `*`. Sibling
literals whose labelled rates do not differ from their parent's by more than chance are then merged
into the wildcard as well. A template is rejected where its share of bad labels, smoothed towards its
host's (itself smoothed towards the whole table's), is too high. Given rules come first: the longest
rule that fits host and path decides.

DataFrame functions only. Counts combine before every exchange and the tree tables are joined by
(node, segment), so a host that holds a third of all urls is spread by its segments. A url leaves the
walk at the first node that can't branch further, so one very long path adds no rounds.

Defined cases: a null url or one without `://` has an empty host and path and is allowed; an empty
table gives no rows; repeated rows are judged alike; only the named columns are read; labels may be
null or repeated (each label row counts).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from dishframe.llm.common import ascii_lower, written

# (host and path, verdict)
RULES = (
    ("com/", "allow"),
    ("example.com/en/", "block"),
    ("www.example.com/en/", "allow"),
    ("net/es/", "block"),
    ("net/fr/", "block"),
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), "^[^?#]*", 0)
    return F.coalesce(ascii_lower(host), F.lit("")), F.coalesce(path, F.lit(""))


def fitting_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; both null where none does."""
    rule = verdict = F.lit(None).cast("string")
    for text, decision in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        suffix, _, prefix = text.partition("/")
        fits = ((host == suffix) | host.endswith("." + suffix)) & path.startswith("/" + prefix)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, decision).otherwise(verdict)
    return rule, verdict


def templates(
    pages: DataFrame, labels: DataFrame, min_count: int = 10, z: float = 1.96
) -> DataFrame:
    """page_id, host, path, template, n_bad, n_labels of the label rows of each page.

    pages: page_id, host, path, label_key; labels: label_key, bad (0/1). A node whose further segments
    belong to fewer than min_count urls, or to no labelled one, can have no literal branch: its urls end in
    wildcards at once, and only urls of other nodes are carried to the next level. So the walk is as
    long as the deepest node that can still branch, however long single paths are.
    """
    counted = labels.filter("bad is not null").groupBy("label_key").agg(F.count("*").alias("n_labels"), F.sum("bad").alias("n_bad"))
    parts = F.split(F.substr("path", F.lit(2)), "/")
    row = ["page_id", "host", "path", "n_labels", "n_bad"]
    live = (
        pages.join(counted, "label_key", "left")
        .select("page_id", "host", "path", F.coalesce("n_labels", F.lit(0)).alias("n_labels"), F.coalesce("n_bad", F.lit(0)).alias("n_bad"), parts.alias("parts"))
        .withColumn("template", F.lit(""))
    )
    ended, level = [], 0
    while True:
        rows = written(live.withColumn("segment", F.get("parts", F.lit(level))))
        further = F.size("parts") > level + 1
        of_further = lambda count: F.sum(F.when(further, F.col(count)).otherwise(0))
        child = written(
            rows.groupBy("host", "template", "segment").agg(
                F.count("*").alias("n"), F.sum("n_labels").alias("n_labels"), F.sum("n_bad").alias("n_bad"),
                F.count_if(further).alias("n_further"), of_further("n_labels").alias("further_labels"),
            )
        )
        node = child.groupBy("host", "template").agg(F.sum("n_labels").alias("all_labels"), F.sum("n_bad").alias("all_bad"))
        rate = (F.col("all_bad") + 1) / (F.col("all_labels") + 2)
        error = F.sqrt(rate * (1 - rate) / F.col("n_labels"))
        enough = F.col("n") >= min_count
        distinct = (F.col("n_labels") > 0) & (F.abs(F.col("n_bad") / F.col("n_labels") - rate) > z * error)
        kept = written(child.join(node, ["host", "template"]).filter(enough & distinct).select("host", "template", "segment", F.lit(True).alias("literal")))
        step = F.concat("template", F.when(F.col("literal"), F.concat(F.lit("/"), "segment")).otherwise("/*")).alias("template")
        stepped = lambda table, *columns: table.join(kept, ["host", "template", "segment"], "left").select(*columns, step)
        open_nodes = written(
            stepped(child, "host", "n_further", "further_labels")
            .groupBy("host", "template")
            .agg(F.sum("n_further").alias("n"), F.sum("further_labels").alias("labelled"))
            .filter((F.col("n") >= min_count) & (F.col("labelled") > 0))
            .select("host", "template", F.lit(True).alias("open"))
        )
        level += 1
        walked = stepped(rows, *row, "parts").join(open_nodes, ["host", "template"], "left")
        goes_on = F.coalesce("open", F.lit(False)) & (F.size("parts") > level)
        rest = F.repeat(F.lit("/*"), F.greatest(F.size("parts") - level, F.lit(0)))
        ended.append(walked.filter(~goes_on).select(*row, F.concat("template", rest).alias("template")))
        if open_nodes.isEmpty():
            break
        live = walked.filter(goes_on).select(*row, "parts", "template")
    return written(reduce(DataFrame.unionByName, ended))


def judge(
    pages: DataFrame, labels: DataFrame, rules=RULES, strength: float = 10.0, max_bad: float = 0.5, **tree_options
) -> DataFrame:
    """One row per url: host, path, rule, verdict, template and the template's smoothed share of bad labels."""
    host, path = host_and_path(F.col("url"))
    slim = pages.select("page_id", host.alias("host"), path.alias("path"), F.col("label_key"))
    rows = templates(slim, labels, **tree_options)
    leaf = rows.groupBy("host", "template").agg(F.sum("n_labels").alias("n"), F.sum("n_bad").alias("bad"))
    by_host = leaf.groupBy("host").agg(F.sum("n").alias("host_n"), F.sum("bad").alias("host_bad"))
    whole = leaf.agg(((F.sum("bad") + 1) / (F.sum("n") + 2)).alias("rate")).first()["rate"]
    whole = 0.5 if whole is None else float(whole)
    prior = (F.col("host_bad") + strength * whole) / (F.col("host_n") + strength)
    purity = (F.col("bad") + strength * prior) / (F.col("n") + strength)
    scored = leaf.join(by_host, "host").select("host", "template", purity.alias("bad_share"))
    rejected = scored.filter(F.col("bad_share") > max_bad)
    rule, decision = fitting_rule(F.col("host"), F.col("path"), rules)
    return rows.join(rejected, ["host", "template"], "left").select(
        "page_id",
        "host",
        "path",
        rule.alias("rule"),
        F.coalesce(decision, F.when(F.col("bad_share").isNotNull() & (F.col("host") != ""), "block").otherwise("allow")).alias("verdict"),
        "template",
    )
