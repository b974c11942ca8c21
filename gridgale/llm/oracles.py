"""The SQL that checks the text queries, where SQL can express them."""

from gridgale.llm import host_quality, licenses, mixing, secrets

# The white space that parts words, as a DuckDB string.
SPACES = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
WORDS = "regexp_extract_all(coalesce({}, ''), '[^\\x20\\x09-\\x0D]+')"
LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLES: dict[str, str] = {}

ORACLES["op1_line_dedup"] = f"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i
  FROM documents),
keyed AS (SELECT *, {LOWER.format(f"trim(line, {SPACES})")} AS key FROM lines),
shared AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
marked AS (
  SELECT k.*, s.key IS NOT NULL AND k.doc_id <> s.keeper AS dropped FROM keyed k LEFT JOIN shared s USING (key))
SELECT doc_id, count(*) AS n_lines, CAST(sum(CAST(dropped AS INTEGER)) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

ORACLES["op2_near_dedup"] = f"""
WITH RECURSIVE split AS (
  SELECT doc_id, regexp_extract_all({LOWER.format("coalesce(text, '')")}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END) AS s
  FROM split),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id < b.doc_id
  GROUP BY ALL),
links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * k >= 75 * (x.n + y.n - k)),
walk AS (
  SELECT doc_id AS node, doc_id AS root FROM documents
  UNION
  SELECT l.other, w.root FROM walk w
  JOIN (SELECT a AS node, b AS other FROM links UNION ALL SELECT b, a FROM links) l ON l.node = w.node),
roots AS (SELECT node, min(root) AS component_id FROM walk GROUP BY node)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d JOIN roots ON node = d.doc_id LEFT JOIN sizes s ON s.doc_id = d.doc_id
"""

_TEMPLATES = ", ".join(
    "({}, '{}', '{}')".format(i, name, " ".join(licenses.normalised(text))) for i, (name, text) in enumerate(licenses.templates())
)
_BIGRAMS = "list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))"
ORACLES["op5_license_scan"] = f"""
WITH known AS (
  SELECT i, license, {_BIGRAMS} AS g
  FROM (SELECT i, license, string_split(words, ' ') AS w FROM (VALUES {_TEMPLATES}) t(i, license, words))),
paragraphs AS (
  SELECT doc_id, unnest(regexp_split_to_array(coalesce(text, ''), '\\n[ \\t\\r]*\\n')) AS p FROM documents),
units AS (
  SELECT doc_id, unnest(string_split(p, chr(10))) AS u FROM paragraphs
  UNION ALL SELECT doc_id, p FROM paragraphs WHERE contains(p, chr(10))),
sets AS (
  SELECT doc_id, {_BIGRAMS} AS g, row_number() OVER () AS unit
  FROM (SELECT doc_id, regexp_extract_all(lower(u), '[a-z0-9]+') AS w FROM units) WHERE len(w) > 1),
scores AS (
  SELECT doc_id, unit, license, 2.0 * len(list_intersect(s.g, k.g)) / (len(s.g) + len(k.g)) AS score,
         row_number() OVER (PARTITION BY unit ORDER BY 2.0 * len(list_intersect(s.g, k.g)) / (len(s.g) + len(k.g)) DESC, i) AS place
  FROM sets s JOIN known k ON list_has_any(s.g, k.g)),
hits AS (SELECT * FROM scores WHERE place = 1 AND score >= 0.75)
SELECT d.doc_id, count(h.unit) AS n_matches,
       coalesce(string_agg(DISTINCT license, ',' ORDER BY license), '') AS licenses,
       round(coalesce(max(CAST(score AS DOUBLE)), 0.0), 6) AS best_score
FROM documents d LEFT JOIN hits h USING (doc_id) GROUP BY d.doc_id
"""

_DRAW = f"""md5(concat_ws('|', '{mixing.SEED}', CAST(doc_id AS VARCHAR), source, md5(coalesce(text, ''))))"""
_HEX = "CAST('0x' || substr({}, 1, 12) AS BIGINT)"
_ROUNDED = "CASE WHEN total > 0 THEN CAST(floor(wanted * greatest(seats + ({}), 0.0) / total + 0.5) AS BIGINT) ELSE 0 END"
_PICKED = "((({0}) * quota + start) // blocks)"
_TAKEN = (
    f"({mixing.BLOCK} * {_PICKED.format('{0} // {1}')} + ({_PICKED.format('{0} // {1} + 1')} - {_PICKED.format('{0} // {1}')})"
    " * ({0} - {1} * ({0} // {1})))"
)
ORACLES["op3_source_mix"] = f"""
WITH sized AS (
  SELECT doc_id, source, CAST(len({WORDS.format("text")}) AS BIGINT) AS size, {_DRAW} AS draw FROM documents),
sizes AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT *, 2.0e0 * source_size AS stop,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0e0 WHEN 1 THEN 2.0e0 ELSE 1.0e0 END AS w,
         row_number() OVER (ORDER BY source NULLS LAST) AS i
  FROM sizes),
levels AS (
  SELECT *, (1.5e0 * sum(source_size) OVER ()
     - coalesce(sum(stop) OVER (ORDER BY stop / w, i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0e0))
     / sum(w) OVER (ORDER BY stop / w, i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighed),
level AS (SELECT level AS lv FROM levels WHERE level <= stop / w ORDER BY stop / w, i LIMIT 1),
targets AS (
  SELECT source, source_size, CASE WHEN lv IS NULL THEN stop ELSE least(stop, w * lv) END AS target
  FROM levels LEFT JOIN level ON true),
shards AS (
  SELECT greatest(1, CAST(ceil(sum(source_size) / {mixing.SHARD}.0e0) AS BIGINT)) AS shards FROM sizes),
dealt AS (SELECT s.*, {_HEX.format("draw")} % shards AS shard FROM sized s, shards),
cells AS (
  SELECT shard, d.source, sum(size) AS words, any_value(source_size) AS source_size, any_value(target) AS target
  FROM dealt d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source GROUP BY ALL),
wanted AS (
  SELECT shard, source, CAST(ceil(words / {mixing.BLOCK}.0e0) AS BIGINT) AS real_blocks,
         CASE WHEN source_size > 0 THEN target / source_size * CAST(ceil(words / {mixing.BLOCK}.0e0) AS BIGINT) ELSE 0.0e0 END AS wanted
  FROM cells),
totals AS (SELECT *, count(*) OVER s AS n, sum(wanted) OVER s AS total FROM wanted WINDOW s AS (PARTITION BY shard)),
seats AS (SELECT *, CAST(floor(total + 0.5) AS BIGINT) AS seats, 2 * real_blocks AS stop FROM totals),
bounded AS (
  SELECT *, least(greatest({_ROUNDED.format("-n / 2.0e0")} - 1, 0), stop) AS low,
         least({_ROUNDED.format("n / 2.0e0")} + 1, stop) AS high FROM seats),
opened AS (SELECT *, seats - sum(low) OVER (PARTITION BY shard) AS open FROM bounded),
tried AS (SELECT *, unnest(CASE WHEN high > low THEN range(low, high) ELSE [NULL] END) AS a FROM opened),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY shard ORDER BY wanted / (2 * a + 1) DESC NULLS LAST, source NULLS LAST, a) AS place
  FROM tried),
quotas AS (
  SELECT shard, source, greatest(any_value(real_blocks), 1) AS blocks,
         CAST(any_value(low) + sum(CASE WHEN a IS NOT NULL AND place <= open THEN 1 ELSE 0 END) AS BIGINT) AS quota
  FROM placed GROUP BY shard, source),
begun AS (
  SELECT *, {_HEX.format(f"md5(concat_ws('|', '{mixing.SEED}', CAST(shard AS VARCHAR), source))")} % blocks AS start FROM quotas),
laid AS (
  SELECT d.*, CAST(sum(size) OVER (PARTITION BY shard, source ORDER BY draw, size ROWS UNBOUNDED PRECEDING) - size AS BIGINT) AS first
  FROM dealt d)
SELECT doc_id, size, source_size, target,
       CAST({_TAKEN.format("(first + size)", mixing.BLOCK)} - {_TAKEN.format("first", mixing.BLOCK)} AS BIGINT) AS taken
FROM laid l JOIN begun b ON l.shard = b.shard AND l.source IS NOT DISTINCT FROM b.source
JOIN targets t ON l.source IS NOT DISTINCT FROM t.source
"""

_RULES = {
    "short": f"n_words < {host_quality.MIN_WORDS}",
    "repeats": "100 * n_repeat_words > 30 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "repeated_lines": "10 * n_dup_lines > 3 * n_lines",
}


def _rate(rule: str) -> str:
    """A host's shrunken rate of failing one rule."""
    between = f"((s_{rule} - (k - 1) * m_{rule} * (1 - m_{rule})) / (docs - q))"
    strength = (
        f"CASE WHEN docs <= q OR {between} <= 0 THEN docs"
        f" ELSE least(docs, greatest(1.0, m_{rule} * (1 - m_{rule}) / {between} - 1)) END"
    )
    strength = f"CASE WHEN m_{rule} IN (0, 1) THEN docs ELSE {strength} END"
    return f"(f_{rule} + m_{rule} * ({strength})) / (n + ({strength}))"


ORACLES["op6_host_quality"] = f"""
WITH split AS (
  SELECT doc_id, source, coalesce(text, '') AS t, {WORDS.format("text")} AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: length(translate(x, {SPACES}, '')) > 0) AS lines
  FROM documents),
runs AS (
  SELECT doc_id, unnest(range(1, len(w) - {host_quality.WINDOW} + 2)) AS i, w FROM split WHERE len(w) >= {host_quality.WINDOW}),
keyed AS (SELECT doc_id, i, array_to_string(w[i:i + {host_quality.WINDOW - 1}], ' ') AS run FROM runs),
again AS (SELECT doc_id, i FROM keyed QUALIFY count(*) OVER (PARTITION BY doc_id, run) > 1),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + {host_quality.WINDOW})) AS p FROM again) GROUP BY doc_id),
counted AS (
  SELECT s.doc_id, source, CAST(len(w) AS BIGINT) AS n_words, CAST(length(translate(t, {SPACES}, '')) AS BIGINT) AS word_chars,
         CAST(length(t) - length(translate(t, '{host_quality.SYMBOLS}', '')) AS BIGINT) AS n_symbols,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words, len(lines) AS n_lines
  FROM split s LEFT JOIN covered c USING (doc_id)),
hosts AS (
  SELECT source, CAST(count(*) AS DOUBLE) AS n, {", ".join(f"CAST(sum(CASE WHEN {c} THEN 1 ELSE 0 END) AS DOUBLE) AS f_{r}" for r, c in _RULES.items())}
  FROM counted GROUP BY source),
means AS (
  SELECT sum(n) AS docs, count(*) AS k, sum(n * n) / sum(n) AS q, {", ".join(f"sum(f_{r}) / sum(n) AS m_{r}" for r in _RULES)} FROM hosts),
spreads AS (
  SELECT any_value(docs) AS docs, any_value(k) AS k, any_value(q) AS q, {", ".join(f"any_value(m_{r}) AS m_{r}, sum(n * (f_{r} / n - m_{r}) ** 2) AS s_{r}" for r in _RULES)}
  FROM hosts, means),
rates AS (SELECT source, greatest({", ".join(map(_rate, _RULES))}) AS rate FROM hosts, spreads)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       ({_RULES["short"]}) OR ({_RULES["repeats"]}) AS base_failed,
       NOT (({_RULES["short"]}) OR ({_RULES["repeats"]})) AND rate <= {host_quality.HOST_RATE} AS kept
FROM counted c JOIN rates r ON c.source IS NOT DISTINCT FROM r.source
"""


def _matches(kind: str) -> str:
    """All matches of one kind, walked through as the Spark side does."""
    pattern, least = {**secrets.BASE, **secrets.WIDER}[kind]
    inner = 3 if kind in ("assign", "bearer") else 2
    walk = "(?s:(.*?))" + pattern
    parts = ", ".join(
        f"unnest(regexp_extract_all(t, $q${walk}$q$, {g})) AS {name}" for g, name in ((1, "gap"), (2, "whole"), (inner, "val"))
    )
    return f"""
      SELECT doc_id, source, '{kind}' AS kind, {secrets.KINDS.index(kind)} AS ord, val,
             sum(length(gap) + length(whole)) OVER (PARTITION BY doc_id ORDER BY i) - length(whole) AS a,
             sum(length(gap) + length(whole)) OVER (PARTITION BY doc_id ORDER BY i) AS b
      FROM (SELECT doc_id, source, {parts}, generate_subscripts(regexp_extract_all(t, $q${walk}$q$, 1), 1) AS i FROM texts)
      QUALIFY length(val) >= {least}"""


_LISTED = "string_agg(kind || ':' || a || ':' || b, ',' ORDER BY a, ord, b)"
ORACLES["op10_secret_owners"] = f"""
WITH texts AS (SELECT doc_id, source, coalesce(text, '') AS t FROM documents),
found AS ({" UNION ALL ".join(map(_matches, secrets.KINDS))}),
base AS (SELECT * FROM found WHERE ord < {len(secrets.BASE)}),
outside AS (
  SELECT * FROM found f WHERE ord >= {len(secrets.BASE)}
  AND NOT EXISTS (SELECT 1 FROM base b WHERE b.doc_id = f.doc_id AND b.a <= f.a AND f.b <= b.b)),
every AS (SELECT * FROM base UNION ALL SELECT * FROM outside),
owners AS (SELECT val, count(DISTINCT coalesce(source, chr(0))) AS owners FROM every GROUP BY val),
live AS (
  SELECT e.* FROM every e JOIN owners USING (val)
  WHERE owners <= {secrets.OWNERS} AND len(list_distinct(string_split(val, ''))) >= {secrets.VARIETY}
  AND NOT regexp_matches(val, '{secrets.PLACEHOLDER}')),
told AS (SELECT * FROM base UNION ALL SELECT * FROM live WHERE ord >= {len(secrets.BASE)}),
based AS (SELECT doc_id, {", ".join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in secrets.BASE)}, {_LISTED} AS listed FROM base GROUP BY doc_id),
spanned AS (SELECT doc_id, {_LISTED} AS spans FROM told GROUP BY doc_id),
lives AS (SELECT doc_id, count(*) AS n FROM live GROUP BY doc_id)
SELECT d.doc_id, {", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k in secrets.BASE)}, sha256(coalesce(listed, '')) AS base_sha256,
       coalesce(spans, '') AS spans, CAST(coalesce(l.n, 0) AS INTEGER) AS n_credentials
FROM documents d LEFT JOIN based b ON b.doc_id = d.doc_id LEFT JOIN spanned s ON s.doc_id = d.doc_id
LEFT JOIN lives l ON l.doc_id = d.doc_id
"""

ORACLES["op12_collocations"] = f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array({LOWER.format("coalesce(text, '')")}, '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents),
spelled AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
grams AS (
  SELECT lang, k AS words, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
  FROM spelled, range(1, 6) t(k) WHERE len(w) >= k),
counts AS (SELECT lang, words, phrase, count(*) AS f FROM grams GROUP BY ALL),
totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM counts WHERE words = 1 GROUP BY lang),
candidates AS (SELECT lang, words, phrase, f AS a, string_split(phrase, ' ') AS w FROM counts WHERE words >= 2 AND f >= 100),
cuts AS (
  SELECT lang, words, phrase, a, k, array_to_string(w[1:k], ' ') AS first, array_to_string(w[k + 1:], ' ') AS rest
  FROM candidates, range(1, 5) t(k) WHERE k < words),
scored AS (
  SELECT c.lang, c.words, c.phrase, c.a, c.k, x.f AS l, y.f AS r, n,
         CAST((CAST(1000 AS HUGEINT) * c.a * n) // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
  FROM cuts c JOIN counts x ON x.lang = c.lang AND x.phrase = c.first JOIN counts y ON y.lang = c.lang AND y.phrase = c.rest
  JOIN totals t ON t.lang = c.lang),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner_parts AS (
  SELECT lang, array_to_string(w[i:i + s - 1], ' ') AS phrase, max(a) AS f
  FROM candidates, range(2, 5) t(s), range(1, 5) u(i) WHERE s < words AND i + s - 1 <= words GROUP BY ALL)
SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) AS rank, b.phrase, a, l, r, n, score
FROM best b LEFT JOIN inner_parts i ON i.lang = b.lang AND i.phrase = b.phrase
WHERE i.f IS NULL OR 100 * i.f < 100 * a
QUALIFY rank <= 2000
"""

ORACLES["op11_cover_tree"] = """
WITH RECURSIVE sound AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM sound a JOIN sound b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.93),
walk AS (
  SELECT vec_id AS node, vec_id AS root FROM embeddings
  UNION
  SELECT b, root FROM walk JOIN links ON a = node),
roots AS (SELECT node, min(root) AS component_id FROM walk GROUP BY node),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN roots ON node = vec_id LEFT JOIN counts ON a = vec_id
"""
