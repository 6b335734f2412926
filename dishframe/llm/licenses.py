"""License scans: TF-IDF cosine of licence lines to templates, then inheritance along paths.

Every line (and every paragraph of several lines) that holds a licence cue word is compared with the
templates: token frequencies times inverse document frequency, as sparse vectors, by cosine. The
frequencies are counted over all such units of the table; tokens outside the templates weigh as the
rarest. The best template over all units of a file, if it reaches the threshold, is the file's own
licence. Files that this leaves without one are searched by windows: where two neighbouring words of a
template meet, one of them rare, a window of the template's length (and one a third longer) is laid along
the paragraph and compared with weights counted over the templates alone, so that neither the words
around a notice nor the size of the table decide. An SPDX header names the licence itself. A file most of whose tokens lie in such units is a licence file: its directory takes its
licence (the commonest, if several). Files without a licence of their own take that of the nearest
ancestor directory that has one, by joins on directories, not on files.

DataFrame functions only; what is broadcast is the template vocabulary, bounded by the templates.

Defined cases: null and empty texts have no licence of their own, but may inherit; a null path lies in
the root directory; repeated rows count as one file; an empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from dishframe.functions.text import let
from dishframe.llm.common import written

# (licence, wording of its notice or first sentence); fixed public wordings.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met. Licensed under the BSD License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License, version 2."),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0. Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "CC0 1.0 Universal public domain dedication. To the extent possible under law, all copyright is waived."),
)
CUES = "licen[sc]|copyright|public domain|redistribut|permission|spdx"
#: Paragraphs searched by windows hold one of these, in lower case.
HINTS = ("licen", "copyright", "public domain", "redistribut", "permission", "spdx", "apache", "mozilla", "gnu", "bsd", "creative commons", "cc0", "cc by", "the mit")
SPDX = r"(?i)spdx-license-identifier:[\s(]*([a-z0-9.+-]*[a-z0-9])"
TOKEN = r"[\p{L}\p{N}]+"


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(TOKEN), F.lit(0))


def units(files: DataFrame) -> DataFrame:
    """file_id, unit, body: lines and paragraphs of several lines that hold a cue word."""
    text = F.coalesce("text", F.lit(""))
    lines = F.split(text, "\n")
    blocks = F.filter(F.split(text, r"\n[ \t\r]*\n"), lambda b: F.contains(b, F.lit("\n")))
    cue = F.rlike(F.lower(text), F.lit(CUES))
    both = F.concat(F.transform(lines, lambda b: F.struct(F.lit(True).alias("line"), b.alias("body"))), F.transform(blocks, lambda b: F.struct(F.lit(False).alias("line"), b.alias("body"))))
    held = F.filter(both, lambda u: F.rlike(F.lower(u["body"]), F.lit(CUES)))
    return files.filter(cue).select("file_id", F.posexplode(held).alias("unit", "u")).select("file_id", "unit", "u.line", "u.body")


def _hinted(text: Column) -> Column:
    low = F.lower(text)
    return reduce(lambda x, y: x | y, [F.contains(low, F.lit(h)) for h in HINTS])


def anchors(held: list[list[str]], most_shared: int = 3) -> list[tuple[str, int, int, int]]:
    """(pair, template, place, window length): neighbouring words of a template, one of which few templates hold."""
    shared = Counter(t for h in held for t in set(h))
    out = []
    for k, h in enumerate(held):
        for at in range(len(h) - 1):
            if min(shared[h[at]], shared[h[at + 1]]) <= most_shared:
                out += [(f"{h[at]} {h[at + 1]}", k, at, n) for n in (len(h), len(h) + len(h) // 3 + 1)]
    return out


def window_licenses(files: DataFrame, known: DataFrame, templates=TEMPLATES, min_cosine: float = 0.6) -> DataFrame:
    """file_id, line, n, best (score, license): paragraphs in which a window or an SPDX header names a licence.

    Windows are laid where two neighbouring words of a template meet, one of them rare among the
    templates; a window must hold those words of the licence's name that its template holds. Of an
    SPDX expression the first licence counts, without -only or -or-later. Files of `known` are left out.
    """
    spark = files.sparkSession
    held = [re.findall(r"[^\W_]+", body.lower()) for _, body in templates]
    laid = anchors(held)
    shared = Counter(t for h in held for t in set(h))
    weight = {t: math.log((1 + len(held)) / (1 + n)) + 1 for t, n in shared.items()}
    parts = []
    for k, h in enumerate(held):
        norm = sum((n * weight[t]) ** 2 for t, n in Counter(h).items()) ** 0.5
        parts += [(k, t, n * weight[t] / norm) for t, n in Counter(h).items()]
    named = [sorted(set(re.findall(r"[^\W_]+", name.lower())) & set(h)) for (name, _), h in zip(templates, held)]
    before, reach = max(map(len, held)), max(n for *_, n in laid)
    firsts, pairs = sorted({p.split()[0] for p, *_ in laid}), sorted({p for p, *_ in laid})

    def found(t: Column) -> Column:
        def pair(i: Column) -> Column:
            return F.concat_ws(" ", F.get(t, i), F.get(t, i + 1))

        every = F.when(F.size(t) > 1, F.sequence(F.lit(0), F.size(t) - 2))
        places = F.filter(every, lambda i: F.get(t, i).isin(firsts) & pair(i).isin(pairs))
        return F.transform(
            places,
            lambda i: F.struct(
                i.alias("i"), pair(i).alias("pair"), F.greatest(i - before, F.lit(0)).alias("base"), F.slice(t, F.greatest(i - before, F.lit(0)) + 1, before + reach).alias("near")
            ),
        )

    # Row-local: of a text, only the few words around its hits go on.
    body = F.posexplode(F.split("text", r"\n[ \t\r]*\n")).alias("unit", "body")
    paragraphs = files.filter(_hinted(F.col("text"))).select("file_id", body).filter(_hinted(F.col("body")))
    hits = paragraphs.select("file_id", "unit", F.explode(let(tokens(F.col("body")), found)).alias("h")).select("file_id", "unit", "h.*")
    fresh = hits.join(known.select("file_id").distinct(), "file_id", "left_anti")
    table = spark.createDataFrame([(*row, named[row[1]]) for row in laid], "pair string, k int, at int, n int, named array<string>")
    start = F.greatest(F.col("i") - F.col("at"), F.lit(0))
    windows = (
        fresh.join(F.broadcast(table), "pair")
        .select("file_id", "unit", "k", start.alias("start"), "n", "named", F.slice("near", start - F.col("base") + 1, F.col("n")).alias("words"))
        .filter(F.forall("named", lambda w: F.array_contains("words", w)))
        .dropDuplicates(["file_id", "unit", "k", "start", "n"])
    )
    key = ["file_id", "unit", "k", "start", "n"]
    counted = windows.select(*key, F.size("words").alias("size"), F.explode("words").alias("token")).groupBy(*key, "size", "token").agg(F.count(F.lit(1)).alias("tf"))
    weights = spark.createDataFrame(list(weight.items()), "token string, weight double")
    of_template = spark.createDataFrame(parts, "k int, token string, part double")
    w = F.col("tf") * F.coalesce("weight", F.lit(math.log(1 + len(held)) + 1))
    names = F.array(*[F.lit(name) for name, _ in templates])
    scored = (
        counted.join(F.broadcast(weights), "token", "left")
        .join(F.broadcast(of_template), ["k", "token"], "left")
        .groupBy(*key, "size")
        .agg((F.sum(w * F.coalesce("part", F.lit(0.0))) / F.sqrt(F.sum(w * w))).alias("score"))
        .filter(F.col("score") >= min_cosine)
        .select("file_id", "unit", F.col("size").alias("n"), "score", F.get(names, F.col("k")).alias("license"))
    )
    spelled = F.create_map(*[F.lit(x) for name in sorted({name for name, _ in templates}) for x in (name.lower(), name)])
    spdx = files.filter(F.contains(F.lower("text"), F.lit("spdx"))).select("file_id", body)
    identifier = F.regexp_replace("identifier", r"(?i)(-only|-or-later|\+)$", "")
    headers = (
        spdx.select("file_id", "unit", F.explode(F.regexp_extract_all("body", F.lit(SPDX), F.lit(1))).alias("identifier"))
        .join(known.select("file_id").distinct(), "file_id", "left_anti")
        .select("file_id", "unit", (3 + F.size(tokens(F.col("identifier")))).alias("n"), F.lit(1.0).alias("score"), F.coalesce(F.try_element_at(spelled, F.lower(identifier)), identifier).alias("license"))
    )
    best = F.max(F.struct(F.struct("score", "license").alias("best"), "n")).alias("b")
    return scored.union(headers).groupBy("file_id", "unit").agg(best).select("file_id", F.lit(True).alias("line"), F.col("b.n").cast("bigint").alias("n"), "b.best")


def own_licenses(files: DataFrame, templates=TEMPLATES, min_cosine: float = 0.6) -> DataFrame:
    """file_id, license, score, license_tokens for the files that name a licence; files: file_id, text."""
    spark = files.sparkSession
    worded = spark.createDataFrame([(i, body) for i, (_, body) in enumerate(templates)], "template int, body string")
    held = [Counter(r.t) for r in sorted(worded.select("template", tokens(F.col("body")).alias("t")).collect())]
    vocabulary = sorted(set().union(*held))
    counted = written(
        units(files)
        .select("file_id", "unit", "line", F.explode(tokens(F.col("body"))).alias("token"))
        .groupBy("file_id", "unit", "line", "token")
        .agg(F.count("*").alias("tf"))
    )
    n_units = counted.select("file_id", "unit").distinct().count() + len(templates)
    seen = {r.token: r["count"] for r in counted.filter(F.col("token").isin(vocabulary)).groupBy("token").count().collect()}

    def idf(frequency: int) -> float:
        return math.log((1 + n_units) / (1 + frequency)) + 1

    weight = {t: idf(seen.get(t, 0) + sum(t in h for h in held)) for t in vocabulary}
    rows = []
    for t in vocabulary:
        row = []
        for h in held:
            norm = sum((n * weight[w]) ** 2 for w, n in h.items()) ** 0.5
            row.append(h[t] * weight[t] / norm)
        rows.append((t, weight[t], row))
    table = spark.createDataFrame(rows, "token string, idf double, each array<double>")
    weighted = counted.join(F.broadcast(table), "token", "left").withColumn("w", F.col("tf") * F.coalesce("idf", F.lit(idf(0))))
    dots = [F.sum(F.coalesce(F.col("w") * F.get("each", F.lit(i)), F.lit(0.0))).alias(f"d{i}") for i in range(len(templates))]
    scored = weighted.groupBy("file_id", "unit", "line").agg(F.sum(F.col("w") * F.col("w")).alias("square"), F.sum("tf").alias("n"), *dots)
    names = F.array(*[F.struct((F.col(f"d{i}") / F.sqrt("square")).alias("score"), F.lit(name).alias("license")) for i, (name, _) in enumerate(templates)])
    whole = written(scored.select("file_id", "line", "n", F.array_max(names).alias("best")).filter(F.col("best.score") >= min_cosine))
    inside = window_licenses(files, whole, templates, min_cosine)
    best = whole.unionByName(inside)
    return best.groupBy("file_id").agg(F.max("best").alias("best"), F.sum(F.when(F.col("line"), F.col("n")).otherwise(0)).alias("in_lines"), F.max(F.when(~F.col("line"), F.col("n")).otherwise(0)).alias("in_block")).select(
        "file_id", "best.license", "best.score", F.greatest("in_lines", "in_block").alias("license_tokens")
    )


def parent(path: Column) -> Column:
    """The directory of a path, without a closing slash; the root is empty."""
    return F.regexp_extract(F.coalesce(path, F.lit("")), r"^(.*)/[^/]*$", 1)


def ancestors(folder: Column) -> Column:
    """The directory itself and all above it, the root last, with their depths."""
    parts = F.split(folder, "/")
    depth = F.when(folder == "", 0).otherwise(F.size(parts))
    return F.transform(F.sequence(depth, F.lit(0)), lambda d: F.struct(d.alias("depth"), F.concat_ws("/", F.slice(parts, F.lit(1), d)).alias("above")))


def scan(files: DataFrame, file_share: float = 0.5, **options) -> DataFrame:
    """file_id, path, own_license, score, license_file, license, inherited_from; files: file_id, path, text."""
    # Repeated rows double a file's counts on both sides, which changes neither cosines nor shares.
    sizes = files.select("file_id", "path", F.size(tokens(F.col("text"))).alias("n_tokens")).groupBy("file_id").agg(
        F.min("path").alias("path"), F.sum("n_tokens").alias("n_tokens")
    ).withColumn("folder", parent(F.col("path")))
    own = own_licenses(files.select("file_id", "text"), **options)
    known = written(
        sizes.join(own, "file_id", "left").withColumn(
            "license_file", F.coalesce(F.col("license_tokens") >= file_share * F.greatest("n_tokens", F.lit(1)), F.lit(False))
        )
    )
    votes = known.filter("license_file").groupBy("folder", "license").agg(F.count("*").alias("n"))
    of_folder = votes.groupBy("folder").agg(F.max_by("license", F.struct("n", "license")).alias("inherited"))
    nearest = (
        known.select("folder").distinct()
        .select("folder", F.explode(ancestors(F.col("folder"))).alias("a"))
        .join(of_folder.withColumnRenamed("folder", "above"), F.col("a.above") == F.col("above"))
        .groupBy("folder")
        .agg(F.max_by(F.struct("inherited", "above"), "a.depth").alias("from_above"))
    )
    return known.join(nearest, "folder", "left").select(
        "file_id",
        "path",
        F.col("license").alias("own_license"),
        "score",
        "license_file",
        F.coalesce("license", "from_above.inherited").alias("license"),
        F.when(F.col("license").isNull(), F.col("from_above.above")).alias("inherited_from"),
    )
