"""SQL (for DuckDB) that must give the same rows as the queries of this subpackage, where SQL can say it."""

from __future__ import annotations

from dishframe.llm import decontamination, licenses, quality_rules, url_filters

# --- near duplicates ----------------------------------------------------------------------------

NEAR_DUPLICATES = r"""
WITH RECURSIVE doc AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
shingle AS MATERIALIZED (SELECT DISTINCT r, array_to_string(w[i:i + least(5, len(w)) - 1], ' ') AS s FROM (SELECT r, w, unnest(generate_series(1, len(w) - least(5, len(w)) + 1)) AS i FROM doc WHERE len(w) > 0)),
size AS (SELECT r, count(*) AS n FROM shingle GROUP BY r),
link AS MATERIALIZED (SELECT a.r AS a, b.r AS b FROM shingle a JOIN shingle b ON a.s = b.s AND a.r <> b.r JOIN size x ON x.r = a.r JOIN size y ON y.r = b.r
  GROUP BY a.r, b.r HAVING count(*) >= 0.8 * (any_value(x.n) + any_value(y.n) - count(*)) - 1e-9),
reach AS (SELECT r, r AS o FROM doc UNION SELECT reach.r, link.b FROM reach JOIN link ON reach.o = link.a),
class AS (SELECT reach.r, min(d.doc_id) AS class_id FROM reach JOIN doc d ON d.r = reach.o GROUP BY reach.r),
links AS (SELECT a AS r, count(*) AS n FROM link GROUP BY a)
SELECT doc.doc_id, class_id, coalesce(n, 0) AS n_links FROM doc JOIN class USING (r) LEFT JOIN links USING (r)
"""

# --- quality rules ------------------------------------------------------------------------------

_CLASS_COUNTS = {
    "lower": "[a-z]", "upper": "[A-Z]", "letter": r"[^\x00-\x7F]", "digit": "[0-9]", "space": r"[\x20\x09-\x0D]", "stop": r"""[.,;:!?''"()\-]""",
    "symbol": "[#*$%&|<>]", "mark": r"[+/=@\[\\\]^_`{}~]", "control": r"[\x00-\x08\x0E-\x1F\x7F]",
}
_COUNTED = ", ".join(f"length(t) - length(regexp_replace(t, '{p}', '', 'g')) AS k_{name}" for name, p in _CLASS_COUNTS.items())
_NAMES = [f"k_{name}" for name in _CLASS_COUNTS]


def _divergence(pairs: str, key: str) -> str:
    """Jensen-Shannon distance per key of a relation (key, p, q) of shares."""
    part = "CASE WHEN {0} > 0 THEN {0} * log2({0} / ((p + q) / 2)) ELSE 0 END"
    return f"SELECT {key}, sqrt(greatest(0, (sum({part.format('p')}) + sum({part.format('q')})) / 2)) AS d FROM {pairs} GROUP BY {key}"


QUALITY_RULES = rf"""
WITH doc AS MATERIALIZED (SELECT doc_id, coalesce(lang, '') AS lang, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
class AS MATERIALIZED (SELECT doc_id, lang, {_COUNTED} FROM doc),
token AS MATERIALIZED (SELECT doc_id, lang, unnest(w) AS word, unnest(generate_series(1, len(w))) AS i FROM doc),
gram AS (SELECT doc_id, i - 2 AS i, word || ' ' || lag(word) OVER o || ' ' || lag(word, 2) OVER o AS g FROM token WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM gram WHERE g IS NOT NULL) WHERE n > 1),
repeated AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, (SELECT unnest([0, 1, 2]) AS k) GROUP BY doc_id),
line AS (SELECT doc_id, count(*) - count(DISTINCT l) AS n FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS l FROM doc) WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY doc_id),
freq AS MATERIALIZED (SELECT lang, word, count(*) AS n FROM token GROUP BY ALL),
total AS (SELECT lang, sum(n) AS n FROM freq GROUP BY lang HAVING sum(n) >= 1000),
common AS MATERIALIZED (SELECT * FROM freq QUALIFY row_number() OVER (PARTITION BY lang ORDER BY n DESC, word) <= 40),
word_reference AS (SELECT lang, word, common.n / total.n AS q FROM common JOIN total USING (lang)
  UNION ALL SELECT lang, NULL, 1 - sum(common.n) / any_value(total.n) FROM common JOIN total USING (lang) GROUP BY lang),
seen AS (SELECT token.doc_id, common.word, count(*) AS n FROM token LEFT JOIN common USING (lang, word) GROUP BY ALL),
word_pair AS (SELECT d.doc_id, coalesce(s.n, 0) / len(d.w) AS p, r.q FROM doc d JOIN word_reference r USING (lang) LEFT JOIN seen s ON s.doc_id = d.doc_id AND s.word IS NOT DISTINCT FROM r.word WHERE len(d.w) >= 50),
by_word AS ({_divergence('word_pair', 'doc_id')}),
long_class AS (SELECT doc_id, lang, unnest([{', '.join(f"'{n}'" for n in _NAMES)}]) AS c, unnest([{', '.join(_NAMES)}]) AS n FROM class),
class_reference AS (SELECT lang, c, sum(n) / sum(sum(n)) OVER (PARTITION BY lang) AS q FROM long_class GROUP BY lang, c),
class_pair AS (SELECT l.doc_id, l.n / sum(l.n) OVER (PARTITION BY l.doc_id) AS p, r.q FROM long_class l JOIN class_reference r USING (lang, c) JOIN total USING (lang) JOIN class c ON c.doc_id = l.doc_id
  WHERE {' + '.join(f'c.{n}' for n in _NAMES if n != 'k_space')} >= 200),
by_char AS ({_divergence('class_pair', 'doc_id')}),
counts AS (SELECT doc_id, len(w)::BIGINT AS n_words, length(t) - k_space AS word_chars, k_symbol AS n_symbols, coalesce(line.n, 0) AS n_dup_lines, coalesce(repeated.n, 0) AS n_repeat_words
  FROM doc JOIN class USING (doc_id) LEFT JOIN line USING (doc_id) LEFT JOIN repeated USING (doc_id))
SELECT *, NOT base_failed AND coalesce(char_distance, 0) <= {quality_rules.Rules.max_char_distance} AND coalesce(word_distance, 0) <= {quality_rules.Rules.max_word_distance} AS kept FROM (
  SELECT counts.*, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, round(by_char.d, 6) AS char_distance, round(by_word.d, 6) AS word_distance
  FROM counts LEFT JOIN by_char USING (doc_id) LEFT JOIN by_word USING (doc_id))
"""

# --- decontamination ----------------------------------------------------------------------------


def _seeds(table: str, key: str) -> str:
    def one(mask: str) -> str:
        on = " || ' ' || ".join(f"t[i + {k}]" for k, c in enumerate(mask) if c == "1")
        return f"SELECT {key}, i, '{mask} ' || {on} AS seed FROM (SELECT {key}, t, unnest(generate_series(1, len(t) - {len(mask) - 1})) AS i FROM {table})"

    return " UNION ALL ".join(map(one, decontamination.MASKS))


def _tokens(table: str, key: str) -> str:
    return rf"SELECT {key}, regexp_extract_all(lower(coalesce(text, '')), '[\p{{L}}\p{{N}}]+') AS t FROM {table} WHERE {key} IS NOT NULL"


DECONTAMINATION = f"""
WITH doc AS MATERIALIZED ({_tokens('documents', 'doc_id')}), item AS MATERIALIZED ({_tokens('benchmark', 'item_id')}),
item_seed AS MATERIALIZED ({_seeds('item', 'item_id')}),
hit AS MATERIALIZED (SELECT DISTINCT doc_id, item_id, d.i AS dp, s.i AS item_at FROM ({_seeds('doc', 'doc_id')}) d JOIN item_seed s USING (seed)),
pair AS (SELECT hit.*, k, coalesce(CASE WHEN doc.t[nullif(greatest(dp + k, 0), 0)] = item.t[nullif(greatest(item_at + k, 0), 0)] THEN 1 ELSE
    CASE WHEN doc.t[nullif(greatest(dp + k, 0), 0)] IS NULL OR item.t[nullif(greatest(item_at + k, 0), 0)] IS NULL THEN -1000 ELSE -2 END END, -1000) AS v, len(item.t) AS n
  FROM hit JOIN doc USING (doc_id) JOIN item USING (item_id), (SELECT unnest(generate_series(-28, 28)) AS k)),
summed AS (SELECT *, sum(v) OVER (PARTITION BY doc_id, item_id, dp, item_at ORDER BY k) AS s FROM pair),
best AS (SELECT doc_id, item_id, dp, item_at, any_value(n) AS n, max(s - low) AS score FROM (SELECT *, least(0, coalesce(min(s) OVER (PARTITION BY doc_id, item_id, dp, item_at ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS low FROM summed) GROUP BY ALL)
SELECT DISTINCT doc_id, item_id FROM best WHERE score >= least(12, n)
"""

# --- URL filters --------------------------------------------------------------------------------


def _rules() -> tuple[str, str]:
    cases = []
    for text, verdict in sorted(url_filters.RULES, key=lambda r: (-len(r[0]), r[0])):
        suffix, _, prefix = text.partition("/")
        cases.append((f"WHEN (host = '{suffix}' OR ends_with(host, '.{suffix}')) AND starts_with(path, '/{prefix}')", text, verdict))
    return " ".join(f"{c} THEN '{t}'" for c, t, _ in cases), " ".join(f"{c} THEN '{v}'" for c, _, v in cases)


URL_FILTERS = rf"""
WITH RECURSIVE rest AS (SELECT page_id, url, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
split AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path,
  TRY_CAST(regexp_extract(url, '://[^/?#]*/[^?#]*?(\d{{1,18}})(?:\.html)?/?(?:[?#]|$)', 1) AS BIGINT) AS label_key FROM rest),
label AS (SELECT doc_id AS label_key, count(*) AS n_labels, sum(1 - quality) AS n_bad FROM labels WHERE quality IS NOT NULL GROUP BY doc_id),
r AS (SELECT 0 AS level, page_id, host, path, coalesce(n_labels, 0) AS n_labels, coalesce(n_bad, 0) AS n_bad, '' AS template, string_split(substr(path, 2), '/') AS parts FROM split LEFT JOIN label USING (label_key)
  UNION ALL SELECT level + 1, page_id, host, path, n_labels, n_bad,
    template || CASE WHEN n >= 10 AND child_labels > 0 AND abs(child_bad / child_labels - rate) > 1.96 * sqrt(rate * (1 - rate) / child_labels) THEN '/' || parts[level + 1] ELSE '/*' END, parts
  FROM (SELECT *, count(*) OVER child AS n, sum(n_labels) OVER child AS child_labels, sum(n_bad) OVER child AS child_bad, (sum(n_bad) OVER node + 1) / (sum(n_labels) OVER node + 2) AS rate
    FROM r WHERE level < len(parts) WINDOW child AS (PARTITION BY host, template, parts[level + 1]), node AS (PARTITION BY host, template))),
page AS MATERIALIZED (SELECT * FROM r WHERE level = len(parts)),
leaf AS (SELECT host, template, sum(n_labels) AS n, sum(n_bad) AS bad FROM page GROUP BY ALL),
of_host AS (SELECT host, sum(n) AS n, sum(bad) AS bad FROM leaf GROUP BY host),
whole AS (SELECT (sum(bad) + 1) / (sum(n) + 2) AS rate FROM leaf),
rejected AS (SELECT leaf.host, template FROM leaf JOIN of_host h ON h.host = leaf.host, whole WHERE (leaf.bad + 10 * ((h.bad + 10 * rate) / (h.n + 10))) / (leaf.n + 10) > 0.5)
SELECT page_id, page.host, path, CASE {_rules()[0]} END AS rule,
  coalesce(CASE {_rules()[1]} END, CASE WHEN rejected.host <> '' THEN 'block' ELSE 'allow' END) AS verdict, page.template
FROM page LEFT JOIN rejected ON page.host = rejected.host AND page.template = rejected.template
""".replace("CASE WHEN (host", "CASE WHEN (page.host").replace("OR ends_with(host", "OR ends_with(page.host").replace("WHEN (host =", "WHEN (page.host =")

# --- licences -----------------------------------------------------------------------------------

_TEMPLATES = ", ".join("({}, '{}', '{}')".format(i, name, body.replace("'", "''")) for i, (name, body) in enumerate(licenses.TEMPLATES))

_HINTED = " OR ".join(f"contains(lower(b), '{h}')" for h in licenses.HINTS)

LICENSES = rf"""
WITH file AS MATERIALIZED (SELECT doc_id, coalesce(text, '') AS t, concat_ws('/', source, lang, (doc_id // 100)::VARCHAR, doc_id || '.txt') AS path FROM documents),
unit AS (SELECT doc_id, true AS line, unnest(list_transform(string_split(t, chr(10)), lambda b, i: {{'u': i, 'b': b}})) AS s FROM file
  UNION ALL SELECT doc_id, false, unnest(list_transform(list_filter(regexp_split_to_array(t, '\n[ \t\r]*\n'), lambda b: contains(b, chr(10))), lambda b, i: {{'u': i, 'b': b}})) FROM file),
cued AS (SELECT doc_id, line, s.u AS u, regexp_extract_all(lower(s.b), '[\p{{L}}\p{{N}}]+') AS w FROM unit WHERE regexp_matches(lower(s.b), '{licenses.CUES}')),
tf AS MATERIALIZED (SELECT doc_id, line, u, word, count(*) AS tf FROM (SELECT doc_id, line, u, unnest(w) AS word FROM cued) GROUP BY ALL),
template AS (SELECT * FROM (VALUES {_TEMPLATES}) v(k, license, body)),
template_tf AS MATERIALIZED (SELECT k, word, count(*) AS tf FROM (SELECT k, unnest(regexp_extract_all(lower(body), '[\p{{L}}\p{{N}}]+')) AS word FROM template) GROUP BY ALL),
units AS (SELECT (SELECT count(*) FROM (SELECT DISTINCT doc_id, line, u FROM tf)) + (SELECT count(*) FROM template) AS n),
idf AS MATERIALIZED (SELECT word, ln((1 + any_value(units.n)) / (1 + count(*))) + 1 AS idf FROM (SELECT word FROM template_tf UNION ALL SELECT word FROM tf WHERE word IN (SELECT word FROM template_tf)), units GROUP BY word),
norm AS (SELECT k, sqrt(sum((tf * idf) ^ 2)) AS norm FROM template_tf JOIN idf USING (word) GROUP BY k),
square AS (SELECT doc_id, line, u, sum((tf * coalesce(idf, ln(1 + units.n) + 1)) ^ 2) AS square, sum(tf) AS n FROM tf LEFT JOIN idf USING (word), units GROUP BY ALL),
cosine AS (SELECT f.doc_id, f.line, f.u, e.k, sum(f.tf * e.tf * idf * idf) / any_value(norm) AS dot FROM tf f JOIN template_tf e USING (word) JOIN idf USING (word) JOIN norm USING (k) GROUP BY ALL),
best AS (SELECT doc_id, line, u, any_value(n) AS n, max({{'score': round(dot / sqrt(square), 9), 'license': license}}) AS best FROM cosine JOIN square USING (doc_id, line, u) JOIN template USING (k) GROUP BY doc_id, line, u),
shared AS (SELECT word, count(*) AS n FROM template_tf GROUP BY word),
place AS MATERIALIZED (SELECT k, license, len(w) AS size, w, unnest(generate_series(1, len(w))) AS pos FROM (SELECT k, license, regexp_extract_all(lower(body), '[\p{{L}}\p{{N}}]+') AS w FROM template)),
anchor AS (SELECT k, license, pos - 1 AS pos, w[pos] || ' ' || w[pos + 1] AS pair, unnest([size, size + size // 3 + 1]) AS n, list_filter(regexp_extract_all(lower(license), '[\p{{L}}\p{{N}}]+'), lambda x: list_contains(w, x)) AS named
  FROM place JOIN shared a ON a.word = w[pos] JOIN shared b ON b.word = w[pos + 1] WHERE least(a.n, b.n) <= 3),
paragraph AS MATERIALIZED (SELECT doc_id, s.u AS u, s.b AS b FROM (SELECT doc_id, unnest(list_transform(regexp_split_to_array(t, '\n[ \t\r]*\n'), lambda b, i: {{'u': i, 'b': b}})) AS s FROM file
  WHERE doc_id NOT IN (SELECT doc_id FROM best WHERE best.score >= 0.6))),
words AS MATERIALIZED (SELECT doc_id, u, regexp_extract_all(lower(b), '[\p{{L}}\p{{N}}]+') AS w FROM paragraph WHERE {_HINTED}),
hit AS (SELECT doc_id, u, w, i, w[i] || ' ' || w[i + 1] AS pair FROM (SELECT doc_id, u, w, unnest(generate_series(1, len(w) - 1)) AS i FROM words)),
laid AS (SELECT DISTINCT doc_id, u, k, license, greatest(i - 1 - pos, 0) AS start, n, w[greatest(i - 1 - pos, 0) + 1 : greatest(i - 1 - pos, 0) + n] AS x, named FROM hit JOIN anchor USING (pair)),
inside AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, u, k, license, x FROM laid WHERE list_has_all(x, named)),
weight AS (SELECT word, ln((1 + (SELECT count(*) FROM template)) / (1 + n)) + 1 AS w FROM shared),
part AS (SELECT k, word, tf * w / sqrt(sum((tf * w) ^ 2) OVER (PARTITION BY k)) AS part FROM template_tf JOIN weight USING (word)),
window_tf AS (SELECT r, any_value(doc_id) AS doc_id, any_value(u) AS u, any_value(k) AS k, any_value(license) AS license, any_value(len(x)) AS n, word, count(*) AS tf FROM (SELECT *, unnest(x) AS word FROM inside) GROUP BY r, word),
window_score AS (SELECT r, any_value(doc_id) AS doc_id, any_value(u) AS u, any_value(f.license) AS license, any_value(n) AS n,
  sum(tf * coalesce(w, ln(1 + (SELECT count(*) FROM template)) + 1) * coalesce(part, 0)) / sqrt(sum((tf * coalesce(w, ln(1 + (SELECT count(*) FROM template)) + 1)) ^ 2)) AS score
  FROM window_tf f LEFT JOIN weight USING (word) LEFT JOIN part ON part.k = f.k AND part.word = f.word GROUP BY r),
header AS (SELECT doc_id, u, regexp_replace(x, '(?i)(-only|-or-later|\+)$', '') AS x, 3 + len(regexp_extract_all(lower(x), '[\p{{L}}\p{{N}}]+')) AS n FROM (SELECT doc_id, u, unnest(regexp_extract_all(b, '{licenses.SPDX}', 1)) AS x FROM paragraph)),
searched AS (SELECT doc_id, u, max({{'b': {{'score': round(score, 9), 'license': license}}, 'n': n}}) AS s FROM (SELECT doc_id, u, score, license, n FROM window_score WHERE score >= 0.6
  UNION ALL SELECT doc_id, u, 1.0, coalesce(any_value(license), any_value(x)), any_value(n) FROM (SELECT row_number() OVER () AS r, * FROM header) LEFT JOIN template ON lower(license) = lower(x) GROUP BY r, doc_id, u) GROUP BY doc_id, u),
found AS (SELECT doc_id, line, n, best FROM best UNION ALL SELECT doc_id, true, s.n, s.b FROM searched),
own AS (SELECT doc_id, max(best) AS best, greatest(coalesce(sum(n) FILTER (line), 0), coalesce(max(n) FILTER (NOT line), 0)) AS license_tokens FROM found WHERE best.score >= 0.6 GROUP BY doc_id),
known AS MATERIALIZED (SELECT doc_id, path, regexp_extract(path, '^(.*)/[^/]*$', 1) AS folder, best.license AS own_license, round(best.score, 6) AS score,
  coalesce(license_tokens >= 0.5 * greatest(len(regexp_extract_all(lower(t), '[\p{{L}}\p{{N}}]+')), 1), false) AS license_file FROM file LEFT JOIN own USING (doc_id)),
of_folder AS (SELECT folder, max({{'n': n, 'l': own_license}}).l AS license FROM (SELECT folder, own_license, count(*) AS n FROM known WHERE license_file GROUP BY ALL) GROUP BY folder),
nearest AS (SELECT k.folder, max({{'d': length(o.folder), 'above': o.folder, 'l': o.license}}) AS a FROM (SELECT DISTINCT folder FROM known) k JOIN of_folder o
  ON k.folder = o.folder OR o.folder = '' OR starts_with(k.folder, o.folder || '/') GROUP BY k.folder)
SELECT doc_id, path, own_license, score, license_file, coalesce(own_license, a.l) AS license, CASE WHEN own_license IS NULL THEN a.above END AS inherited_from FROM known LEFT JOIN nearest USING (folder)
"""

# --- ranked lexical search ----------------------------------------------------------------------

_TERMS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""

LEXICAL_SEARCH = f"""
WITH doc AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS w FROM documents),
item AS MATERIALIZED (SELECT row_number() OVER () AS i, item_id, {_TERMS} AS w FROM benchmark),
total AS (SELECT count(*)::BIGINT AS n_docs, sum(len(w))::BIGINT AS n_terms FROM doc WHERE len(w) > 0),
wanted AS MATERIALIZED (SELECT DISTINCT i, item_id, unnest(w) AS term FROM item),
counted AS (SELECT r, unnest(w) AS term FROM doc),
posting AS MATERIALIZED (SELECT r, term, count(*)::BIGINT AS tf FROM counted WHERE term IN (SELECT term FROM wanted) GROUP BY r, term),
weight AS MATERIALIZED (SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM posting, total GROUP BY term),
impact AS (SELECT r, doc_id, term, (1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + ((50 * len(w) * n_docs) // n_terms))) AS v FROM posting JOIN doc USING (r), total),
scored AS (SELECT i, item_id, r, doc_id, sum(weight.w * v)::BIGINT AS score FROM wanted JOIN impact USING (term) JOIN weight USING (term) GROUP BY ALL)
SELECT item_id, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 50
"""

# --- exact duplicates ---------------------------------------------------------------------------

EXACT_DEDUP = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  doc_id IS NOT DISTINCT FROM max(doc_id) OVER same AND row_number() OVER (PARTITION BY coalesce(text, ''), doc_id) = 1 AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""

# --- vector codes -------------------------------------------------------------------------------


def _vector_codes(rounds: int = 4) -> str:
    steps = [
        """WITH kept AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, label, [floor(1024 * x::DOUBLE)::BIGINT FOR x IN embedding] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(embedding) % 4 = 0 AND len([x FOR x IN embedding IF x IS NOT NULL AND isfinite(x)]) = len(embedding)),
part AS MATERIALIZED (SELECT r, vec_id, p, v[p * len(v) // 4 + 1 : (p + 1) * len(v) // 4] AS v FROM kept, (SELECT unnest(range(4)) AS p)),
first AS (SELECT r, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM kept QUALIFY e < 256),
book0 AS MATERIALIZED (SELECT p, e, v AS c FROM part JOIN first USING (r))"""
    ]
    for k in range(rounds + 1):
        steps.append(
            f"""near{k} AS MATERIALIZED (SELECT r, p, v, d // 1024 AS d, d % 1024 AS e FROM (SELECT r, p, any_value(v) AS v,
  min(list_sum([(z[1] - z[2]) * (z[1] - z[2]) FOR z IN list_zip(v, c)])::BIGINT * 1024 + e) AS d FROM part JOIN book{k} USING (p) GROUP BY r, p))"""
        )
        if k < rounds:
            steps.append(
                f"""mean{k} AS (SELECT p, e, list(m ORDER BY i) AS c FROM (SELECT p, e, i, floor(sum(x) / count(*))::BIGINT AS m FROM (SELECT p, e, unnest(v) AS x, unnest(range(len(v))) AS i FROM near{k}) GROUP BY p, e, i) GROUP BY p, e),
book{k + 1} AS MATERIALIZED (SELECT b.p, b.e, coalesce(m.c, b.c) AS c FROM book{k} b LEFT JOIN mean{k} m ON m.p = b.p AND m.e = b.e)"""
            )
    return ",\n".join(steps) + f""",
coded AS MATERIALIZED (SELECT vec_id, label, string_agg(format('{{:02x}}', e), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM near{rounds} JOIN kept USING (r) GROUP BY r, vec_id, label)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
  (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) FROM book{rounds}) AS codebooks_sha256 FROM coded
"""


VECTOR_CODES = _vector_codes()
