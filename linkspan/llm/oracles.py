"""DuckDB SQL of the corpus queries that SQL can express."""

from __future__ import annotations

from .linededup import MIN_WORDS as RUN_WORDS
from .ngramjoin import N, THRESHOLD
from .quality import ALPHA, DELTA, GRID, MIN_WORDS, TUNING

_WS = r"[\x20\x09-\x0D]+"
_WORDS = f"list_filter(regexp_split_to_array(coalesce({{}}, ''), '{_WS}'), lambda x: x <> '')"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

OP2 = f"""
WITH RECURSIVE w AS (SELECT doc_id, {_WORDS.format(f"translate(text, '{_UPPER}', '{_LOWER}')")} AS w FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {N} THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - {N - 2}), lambda i: array_to_string(w[i:i + {N - 1}], ' ')) END) AS s FROM w),
g AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM s),
e AS (SELECT a.doc_id AS x, b.doc_id AS y FROM g a JOIN g b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING {THRESHOLD[1]} * count(*) >= {THRESHOLD[0]} * (a.n + b.n - count(*))),
r AS (SELECT x, y FROM e UNION SELECT r.x, e.y FROM r JOIN e ON r.y = e.x)
SELECT doc_id, len(s)::BIGINT AS n_shingles, least(doc_id, coalesce(m, doc_id)) AS component_id FROM s LEFT JOIN (SELECT x, min(y) AS m FROM r GROUP BY x) ON x = doc_id
"""

_RULES = {"symbol_rate": ("n_symbols", "n_words"), "dup_line_rate": ("n_dup_lines", "n_lines"), "repeat_rate": ("n_repeat_words", "n_words"), "upper_rate": ("n_upper", "n_chars_all")}
_FAILED = f"(n_words < {MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words)"
_POINTS = ", ".join(f"('{rule}', {step}, {cut})" for rule, cuts in GRID.items() for step, cut in enumerate(cuts))
_RATES = {r: f"({a}::DOUBLE / greatest({b}, 1))" for r, (a, b) in _RULES.items()}
_RATE = "CASE rule " + " ".join(f"WHEN '{r}' THEN r_{r}" for r in _RULES) + " END"
_CUT = {r: f"([{', '.join(f'{x}::DOUBLE' for x in GRID[r])}])[least(step, s_{r}) + 1]" for r in GRID}

OP8 = f"""
WITH t AS (SELECT doc_id, lang, coalesce(text, '') AS t, {_WORDS.format('text')} AS w FROM documents),
u AS (SELECT *, list_transform(range(1, greatest(len(w) - 1, 1)), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) AS h, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l FROM t),
h AS (SELECT doc_id, unnest(h) AS h, generate_subscripts(h, 1) AS i FROM u),
d AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, h) AS n FROM h) WHERE n > 1),
c AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM d) GROUP BY doc_id),
m AS (SELECT u.doc_id, lang, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars, len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words, len(l) AS n_lines, len(regexp_extract_all(t, '[A-Z]')) AS n_upper, length(t) AS n_chars_all FROM u LEFT JOIN c USING (doc_id)),
k AS (SELECT doc_id, max((quality = 1)::INT) AS good FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id),
x AS (SELECT doc_id, good, substr(md5(doc_id::VARCHAR), 1, 1) < '{"0123456789abcdef"[TUNING]}' AS tuning, min(lang) AS lang, {", ".join(f"max({x}) AS r_{r}" for r, x in _RATES.items())} FROM m JOIN k USING (doc_id) WHERE NOT {_FAILED} GROUP BY doc_id, good),
g AS (SELECT lang, rule, step, sum(({_RATE} >= cutoff::DOUBLE)::INT * (1 - 2 * good)) AS gain FROM x, (VALUES {_POINTS}) p(rule, step, cutoff) WHERE tuning GROUP BY ALL),
b AS (SELECT lang, rule, step FROM g WHERE gain > 0 QUALIFY row_number() OVER (PARTITION BY lang, rule ORDER BY gain DESC, step) = 1),
s AS (SELECT lang, {", ".join(f"max(step) FILTER (WHERE rule = '{r}') AS s_{r}" for r in GRID)} FROM b GROUP BY lang),
u2 AS (SELECT s.*, step, good, ({" OR ".join(f"coalesce(r_{r} >= {_CUT[r]}, false)" for r in GRID)})::INT AS hit FROM x JOIN s ON x.lang IS NOT DISTINCT FROM s.lang, range({max(map(len, GRID.values()))}) t(step) WHERE NOT tuning),
c2 AS (SELECT lang, step, {", ".join(f"s_{r}" for r in GRID)}, sum(good)::BIGINT AS n, sum(good * hit)::BIGINT AS r FROM u2 GROUP BY ALL),
p AS (SELECT *, {DELTA} / count(*) OVER (PARTITION BY step) AS level,
  CASE WHEN r >= n * {ALPHA}::DOUBLE THEN 1.0 ELSE list_sum(list_transform(range(0, r + 1), lambda j: exp(lgamma(n + 1.0) - lgamma(j + 1.0) - lgamma(n - j + 1.0) + j * ln({ALPHA}) + (n - j) * ln({1 - ALPHA})))) END AS p FROM c2),
q AS (SELECT *, max((p > level)::INT) OVER (PARTITION BY lang ORDER BY step) AS broken FROM p),
e AS (SELECT lang, {", ".join(f"{_CUT[r]} AS c_{r}" for r in GRID)} FROM q WHERE broken = 0 QUALIFY row_number() OVER (PARTITION BY lang ORDER BY step DESC) = 1),
v AS (SELECT m.*, {" OR ".join(f"coalesce({_RATES[r]} >= c_{r}, false)" for r in GRID)} AS out FROM m LEFT JOIN e ON m.lang IS NOT DISTINCT FROM e.lang)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, {_FAILED} AS base_failed, NOT {_FAILED} AND NOT out AS kept FROM v
"""

OP10 = f"""
WITH l AS (SELECT doc_id, generate_subscripts(x, 1) - 1 AS pos, unnest(x) AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS x FROM documents WHERE text IS NOT NULL)),
w AS (SELECT *, len({_WORDS.format('line')}) AS w FROM l),
c AS (SELECT *, sum(w) OVER (PARTITION BY doc_id ORDER BY pos) AS c FROM w WHERE w > 0),
s AS (SELECT *, c::BIGINT AS e, (c - w)::BIGINT AS s FROM c),
r AS (SELECT doc_id, pos AS a, max(pos) OVER f AS b, list(line) OVER f AS k, max(e) OVER f - s AS n FROM s WINDOW f AS (PARTITION BY doc_id ORDER BY s RANGE BETWEEN CURRENT ROW AND {RUN_WORDS - 1} FOLLOWING)
  UNION SELECT doc_id, min(pos) OVER g, pos, list(line) OVER g, e - min(s) OVER g FROM s WINDOW g AS (PARTITION BY doc_id ORDER BY e RANGE BETWEEN {RUN_WORDS - 1} PRECEDING AND CURRENT ROW)),
o AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY doc_id, a) AS i FROM r WHERE n >= {RUN_WORDS}),
g AS (SELECT DISTINCT doc_id, unnest(range(a, b + 1)) AS pos FROM o WHERE i > 1),
t AS (SELECT l.doc_id, count(g.pos) AS n, coalesce(string_agg(l.pos::VARCHAR, ',' ORDER BY l.pos) FILTER (WHERE g.pos IS NOT NULL), '') AS gone, coalesce(string_agg(line, chr(10) ORDER BY l.pos) FILTER (WHERE g.pos IS NULL), '') AS text FROM l LEFT JOIN g ON g.doc_id = l.doc_id AND g.pos = l.pos GROUP BY l.doc_id)
SELECT d.doc_id, coalesce(n, 0) AS n_deleted_lines, coalesce(gone, '') AS deleted_lines, length(t.text) AS n_chars_left, sha256(t.text) AS text_sha256 FROM documents d LEFT JOIN t USING (doc_id)
"""
