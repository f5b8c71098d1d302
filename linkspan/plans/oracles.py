"""DuckDB SQL of the registered queries, composed of common table expressions."""

from __future__ import annotations

from dataclasses import asdict

from ..functions import text as t
from ..sources.records import NAME_PART
from .queries import CAP, CONFIG, DEEP_K, DEEP_THRESHOLD, GRID, HALF, LIMITS, THRESHOLD, Limits


def _list(words: list[str]) -> str:
    return "(" + ", ".join(f"'{w}'" for w in words) + ")"


_FOLD = "list_filter(string_split(regexp_replace(strip_accents(lower({})), '[^\\p{{L}}\\p{{N}}\\p{{M}}]+', ' ', 'g'), ' '), lambda x: x <> '')"
_PLAIN = "list_transform({}, lambda x: CASE WHEN regexp_full_match(x, '[0-9]+') THEN CASE WHEN ltrim(x, '0') = '' THEN '0' ELSE ltrim(x, '0') END ELSE x END)"
_HASH = "('0x' || substr(md5('{salt}:' || entity_id), 1, 16))::UBIGINT::DOUBLE / 18446744073709551616.0"
_F05 = "CASE WHEN n_true = 0 THEN CASE WHEN n_pred = 0 THEN 1.0 ELSE 0.0 END ELSE 1.25 * tp / (n_pred + 0.25 * n_true) END"
_NAMES, _SPARSE = round(CONFIG.top_k * CONFIG.name_quota), round(CONFIG.top_k * CONFIG.sparse_quota)

#: Common table expressions by name; each may use those above it.
CTES = {
    "rec": f"SELECT 'S' || (1 + doc_id % 3)::INT || '-' || lpad(doc_id::VARCHAR, 7, '0') AS entity_id, regexp_extract(text, '{NAME_PART}', 1) AS business_name, regexp_replace(text, '{NAME_PART}', '') AS business_address, lang AS country, (1 + doc_id % 3)::INT AS source, doc_id AS source_row, md5(text) AS twin FROM documents",
    "s1": "SELECT entity_id AS s1_id, country, source_row AS s1_row FROM rec WHERE source = 1",
    "truth": "SELECT o.s1_id, r.entity_id AS cand_id FROM rec r JOIN (SELECT twin, min(entity_id) AS s1_id FROM rec WHERE source = 1 GROUP BY twin) o USING (twin) WHERE r.source <> 1",
    "names": f"SELECT *, list_filter({_FOLD.format('business_name')}, lambda x: x NOT IN {_list(t.NAME_STOPWORDS)}) AS nt, {_PLAIN.format(f'list_filter({_FOLD.format("business_address")}, lambda x: x NOT IN {_list(t.ADDRESS_STOPWORDS)})')} AS adt FROM rec",
    "tok": "SELECT entity_id, source, country, 'n' AS field, unnest(list_distinct(nt)) AS token FROM names UNION ALL SELECT entity_id, source, country, 'a', unnest(list_distinct(adt)) FROM names",
    "df": "SELECT country, field, token, count(*) AS df FROM tok GROUP BY ALL",
    "idf": "SELECT d.*, round(ln((n + 1) / df) * 1000000)::BIGINT AS idf_micro FROM df d JOIN (SELECT country, count(*)::DOUBLE AS n FROM rec GROUP BY country) USING (country)",
    "w": "SELECT *, CASE field WHEN 'n' THEN idf_micro ELSE round(idf_micro * 1.5::DOUBLE)::BIGINT END AS weight FROM idf",
    "pool": f"SELECT l.entity_id AS s1_id, r.entity_id AS cand_id, sum(weight)::BIGINT AS combined, sum(CASE WHEN l.field = 'n' THEN weight ELSE 0 END)::BIGINT AS name_score FROM w JOIN tok l USING (country, field, token) JOIN tok r USING (country, field, token) WHERE df <= @max_df@ AND l.source = 1 AND r.source <> 1 GROUP BY ALL",
    "flags": "SELECT entity_id, (CASE WHEN regexp_matches(business_name, '[\\x{0250}-\\x{10FFFF}]') AND regexp_matches(regexp_replace(business_name, '[\\x{0000}-\\x{024F}]', '', 'g'), '\\p{L}') THEN 1 ELSE 0 END + CASE WHEN len(adt) = 0 THEN 2 ELSE 0 END)::INT AS flags FROM names",
    "marked": "SELECT p.*, f.flags <> 0 AS sparse FROM pool p JOIN flags f ON f.entity_id = p.cand_id",
    "ranked": "SELECT *, row_number() OVER (PARTITION BY s1_id ORDER BY combined DESC, cand_id) AS rank FROM pool",
    "run": f"SELECT *, floor(100 * combined / (combined + {HALF})) / 100.0 AS prob FROM ranked WHERE rank <= {CONFIG.top_k}",
    "deep": f"SELECT *, floor(100 * combined / (combined + {HALF})) / 100.0 AS prob FROM ranked WHERE rank <= {DEEP_K}",
    "won": "SELECT s1_id, cand_id, prob FROM run QUALIFY row_number() OVER (PARTITION BY cand_id ORDER BY prob DESC, s1_id) = 1",
    "acc": f"SELECT s1_id, cand_id FROM won WHERE prob::FLOAT >= {THRESHOLD}::FLOAT",
    "lab": "SELECT r.*, (t.s1_id IS NOT NULL)::INT AS label FROM run r LEFT JOIN truth t USING (s1_id, cand_id)",
    "hybrid": f"""SELECT s1_id, cand_id, base_rank, deep_rank, origin, row_number() OVER (PARTITION BY s1_id ORDER BY origin, base_rank NULLS LAST, deep_rank NULLS LAST, cand_id)::INT AS hybrid_rank FROM (
        SELECT r.s1_id, r.cand_id, r.rank::INT AS base_rank, d.rank::INT AS deep_rank, 0 AS origin FROM run r LEFT JOIN deep d USING (s1_id, cand_id)
        UNION ALL SELECT s1_id, cand_id, NULL, rank::INT, 1 FROM (SELECT d.*, row_number() OVER (PARTITION BY d.s1_id ORDER BY d.rank) AS pos, coalesce(n, 0) AS n FROM deep d ANTI JOIN run USING (s1_id, cand_id) LEFT JOIN (SELECT s1_id, count(*) AS n FROM run GROUP BY s1_id) USING (s1_id)) WHERE pos <= greatest({CAP} - n, 0))""",
    "hyb": "SELECT h.*, d.prob FROM hybrid h JOIN deep d USING (s1_id, cand_id)",
    "per": f"SELECT *, {_F05} AS f05 FROM (SELECT s.s1_id, s.country, count(a.cand_id) FILTER (WHERE t.cand_id IS NOT NULL) AS tp, count(a.cand_id) AS n_pred, count(t.cand_id) AS n_true FROM s1 s LEFT JOIN (SELECT coalesce(a.s1_id, t.s1_id) AS s1_id, a.cand_id AS ac, t.cand_id AS tc FROM acc a FULL JOIN truth t USING (s1_id, cand_id)) b ON b.s1_id = s.s1_id LEFT JOIN acc a ON a.s1_id = s.s1_id AND a.cand_id = b.ac LEFT JOIN truth t ON t.s1_id = s.s1_id AND t.cand_id = b.tc GROUP BY ALL)",
    "texts": "SELECT r.s1_id, r.cand_id, a.business_name AS an, b.business_name AS bn, a.business_address AS aa, b.business_address AS ba, a.country FROM run r JOIN rec a ON a.entity_id = r.s1_id JOIN rec b ON b.entity_id = r.cand_id",
}
_WORDS = "list_filter(string_split(trim(regexp_replace(lower({}), '[^\\p{{L}}\\p{{N}}\\p{{M}}]+', ' ', 'g')), ' '), lambda x: x <> '')"
_JACC = "CASE WHEN len(list_distinct(list_concat({0}, {1}))) > 0 THEN len(list_intersect({0}, {1}))::DOUBLE / len(list_distinct(list_concat({0}, {1}))) ELSE 0.0 END"
_LEVELS = "count(*) FILTER (WHERE prob >= {x}) {over} AS above_{n}"


def _levels(over: str) -> str:
    return ", ".join(_LEVELS.format(x=x, n=int(100 * x), over=over) for x in (0.3, 0.5, 0.7, 0.9))


_CORE = "list_sort(list_distinct(list_filter(" + _PLAIN.format("list_filter(string_split(regexp_replace(strip_accents(lower({})), '[^\\p{{L}}\\p{{N}}_]+', ' ', 'g'), ' '), lambda x: x <> '')") + ", lambda x: x NOT IN " + _list(t.CORE_STOPWORDS) + ")))"
_DIGITS, _NODIGITS = "list_filter({}, lambda x: regexp_full_match(x, '[0-9]+'))", "list_filter({}, lambda x: NOT regexp_full_match(x, '[0-9]+'))"
_ADDRESS = _PLAIN.format(_FOLD)
_MET = "tp, n_pred, n_true"

BODY = {
    "scan_records": "SELECT entity_id, business_name, business_address, country, source, source_row FROM rec",
    "country_counts": "SELECT country, count(*) AS n_records FROM rec GROUP BY country",
    "source_profile": "SELECT source, count(*) AS n_records, count(DISTINCT entity_id) AS n_ids, count(DISTINCT country) AS n_countries, "
    "count_if(business_name = '')::BIGINT AS empty_name, count_if(business_address = '')::BIGINT AS empty_address, count_if(coalesce(country, '') = '')::BIGINT AS empty_country, "
    "count_if(regexp_matches(regexp_replace(business_name, '[\\x{0000}-\\x{024F}]', '', 'g'), '\\p{L}'))::BIGINT AS nonlatin_name, count_if(regexp_matches(regexp_replace(business_address, '[\\x{0000}-\\x{024F}]', '', 'g'), '\\p{L}'))::BIGINT AS nonlatin_address, "
    "count_if(regexp_matches(business_name, '[^\\x00-\\x7F]'))::BIGINT AS nonascii_name, count_if(regexp_matches(business_name, '[0-9]'))::BIGINT AS name_with_digit, count_if(regexp_matches(business_address, '[0-9]'))::BIGINT AS address_with_digit, "
    "count_if(regexp_matches(business_name, '(?i)\\.(com|in|net|org|co|fr)\\b'))::BIGINT AS domain_name, count_if(regexp_matches(business_name, '(?i)\\b(dba|d\\.b\\.a\\.?|fka|formerly known as|aka)\\b'))::BIGINT AS alias_name, "
    "count_if(regexp_matches(business_name, '\\p{L}') AND upper(business_name) = business_name)::BIGINT AS upper_name, count_if(regexp_matches(business_name, '\\p{L}') AND lower(business_name) = business_name)::BIGINT AS lower_name, "
    f"count_if(trim(business_name) <> business_name)::BIGINT AS padded_name, count_if(business_name IN {_list(t.NULL_LITERALS)})::BIGINT AS null_literal_name, count_if(business_address IN {_list(t.NULL_LITERALS)})::BIGINT AS null_literal_address, "
    "count_if(regexp_extract(translate(business_address, '#,', '  '), '(?:^|\\s)0*(\\d+)', 1) <> '')::BIGINT AS house_number, "
    + ", ".join(f"count_if(contains(business_name, '{v.replace(chr(39), chr(39) * 2)}'))::BIGINT AS name_{k}" for k, v in t.PUNCTUATION.items())
    + ", max(length(business_name))::INT AS max_name, max(length(business_address))::INT AS max_address FROM rec GROUP BY source",
    "tokens_name": "SELECT entity_id, token FROM tok WHERE field = 'n'",
    "tokens_address": "SELECT entity_id, token FROM tok WHERE field = 'a'",
    "bigrams": "SELECT DISTINCT entity_id, least(x, y) || ' ' || greatest(x, y) AS pair FROM (SELECT entity_id, unnest(nt[:-2]) AS x, unnest(nt[2:]) AS y FROM names WHERE len(nt) > 1)",
    "trigrams": "SELECT DISTINCT entity_id, gram FROM (SELECT entity_id, unnest(CASE WHEN length(s) < 3 THEN [s] ELSE list_transform(range(1, length(s) - 1), lambda i: substr(s, i, 3)) END) AS gram FROM (SELECT entity_id, regexp_replace(business_name, '\\s+', '', 'g') AS s FROM rec)) WHERE gram <> ''",
    "house_number": "SELECT entity_id, regexp_extract(translate(business_address, '#,', '  '), '(?:^|\\s)0*(\\d+)', 1) AS house_number FROM rec",
    "record_flags": "SELECT entity_id, flags FROM flags",
    "nonascii_share": "SELECT entity_id, round(length(regexp_replace(business_name, '[\\x00-\\x7F]', '', 'g'))::DOUBLE / greatest(length(business_name), 1), 9) AS nonascii_share FROM rec",
    "sample_hash": f"SELECT entity_id, {_HASH.format(salt='sample-v1')} AS fraction FROM rec",
    "holdout_select": f"SELECT entity_id FROM rec WHERE source = 1 AND {_HASH.format(salt='holdout-v1')} < 0.5 AND NOT {_HASH.format(salt='dev-v1')} < 0.3",
    "doc_freq": "SELECT country, field, token, df FROM df",
    "idf": "SELECT country, field, token, df, idf_micro FROM idf",
    "rarest_tokens": "SELECT entity_id, field, token, df, pos FROM (SELECT k.entity_id, k.field, k.token, CASE WHEN d.df >= 2 THEN d.df ELSE 1 END AS df, row_number() OVER (PARTITION BY k.entity_id, k.field ORDER BY CASE WHEN d.df >= 2 THEN d.df ELSE 1 END, k.token)::INT AS pos FROM tok k JOIN df d USING (country, field, token)) WHERE pos <= 2",
    "block_pool": "SELECT s1_id, count(*) AS pool FROM pool GROUP BY s1_id",
    "block_score": "SELECT * FROM pool",
    "block_top_k": f"SELECT s1_id, cand_id, combined, name_score, rank::INT AS rank FROM ranked WHERE rank <= {CONFIG.top_k}",
    "block_quota_top_k": f"""SELECT s1_id, cand_id, combined, name_score, sparse, row_number() OVER (PARTITION BY s1_id ORDER BY combined DESC, cand_id)::INT AS rank FROM (
        SELECT *, row_number() OVER (PARTITION BY s1_id ORDER BY (by_name OR by_flag) DESC, combined DESC, cand_id) AS pos FROM (
        SELECT *, sparse AND NOT by_name AND row_number() OVER (PARTITION BY s1_id ORDER BY (sparse AND NOT by_name) DESC, combined DESC, cand_id) <= {_SPARSE} AS by_flag FROM (
        SELECT *, name_score > 0 AND row_number() OVER (PARTITION BY s1_id ORDER BY (name_score > 0) DESC, name_score DESC, cand_id) <= {_NAMES} AS by_name FROM marked))) WHERE pos <= {CONFIG.top_k}""",
    "rerank_exact": f"""WITH short AS (SELECT s1_id, cand_id, combined, name_score, sparse FROM (SELECT *, row_number() OVER (PARTITION BY s1_id ORDER BY combined DESC, cand_id) AS r1, row_number() OVER (PARTITION BY s1_id ORDER BY (name_score > 0) DESC, name_score DESC, cand_id) AS r2, row_number() OVER (PARTITION BY s1_id ORDER BY sparse DESC, combined DESC, cand_id) AS r3 FROM marked)
        WHERE r1 <= @rerank_depth@ OR (name_score > 0 AND r2 <= @rerank_depth@) OR (sparse AND r3 <= {5 * max(1, _SPARSE)})),
        more AS (SELECT l.entity_id AS s1_id, r.entity_id AS cand_id, sum(weight)::BIGINT AS m1, sum(CASE WHEN l.field = 'n' THEN weight ELSE 0 END)::BIGINT AS m2 FROM w JOIN tok l USING (country, field, token) JOIN tok r USING (country, field, token) WHERE df > @max_df@ AND l.source = 1 AND r.source <> 1 GROUP BY ALL)
        SELECT s1_id, cand_id, combined + coalesce(m1, 0) AS combined, name_score + coalesce(m2, 0) AS name_score, sparse FROM short LEFT JOIN more USING (s1_id, cand_id)""",
    "trigram_fallback": """WITH g AS (SELECT entity_id, source, country, unnest(list_distinct(CASE WHEN length(j) < 3 THEN [j] ELSE list_transform(range(1, length(j) - 1), lambda i: substr(j, i, 3)) END)) AS token FROM (SELECT *, array_to_string(nt, '') AS j FROM names) WHERE j <> ''),
        few AS (SELECT s1_id FROM s1 LEFT JOIN pool USING (s1_id) GROUP BY s1_id HAVING count(pool.cand_id) < 3),
        wt AS (SELECT country, token, round(round(ln((n + 1) / df) * 1000000) * 0.5::DOUBLE)::BIGINT AS w FROM (SELECT country, token, count(*) AS df FROM g GROUP BY ALL) JOIN (SELECT country, count(*)::DOUBLE AS n FROM rec GROUP BY country) USING (country) WHERE df <= @grams@),
        more AS (SELECT l.entity_id AS s1_id, r.entity_id AS cand_id, sum(w) AS c FROM wt JOIN g l USING (country, token) JOIN g r USING (country, token) WHERE l.source = 1 AND r.source <> 1 AND l.entity_id IN (SELECT s1_id FROM few) GROUP BY ALL)
        SELECT s1_id, cand_id, sum(combined)::BIGINT AS combined, sum(name_score)::BIGINT AS name_score FROM (SELECT * FROM pool UNION ALL SELECT s1_id, cand_id, c, c FROM more) GROUP BY ALL""",
    "rarest_key_block": """WITH ch AS (SELECT k.*, d.df, row_number() OVER (PARTITION BY k.entity_id, k.field ORDER BY d.df, k.token) AS pos FROM tok k JOIN df d USING (country, field, token) WHERE k.source = 1),
        nor AS (SELECT * FROM ch WHERE pos <= 2 AND df <= @keys@), alt AS (SELECT * FROM ch ANTI JOIN nor USING (entity_id) WHERE pos <= 2 AND df <= @last_key@ QUALIFY row_number() OVER (PARTITION BY entity_id ORDER BY df, field, token) = 1),
        keyed AS (SELECT entity_id, country, field, token FROM nor UNION ALL SELECT entity_id, country, field, token FROM alt),
        pr AS (SELECT DISTINCT k.entity_id AS s1_id, r.entity_id AS cand_id FROM keyed k JOIN tok r USING (country, field, token) WHERE r.source <> 1)
        SELECT s1_id, cand_id, sum(idf_micro)::BIGINT AS combined, sum(CASE WHEN l.field = 'n' THEN idf_micro ELSE 0 END)::BIGINT AS name_score FROM pr JOIN tok l ON l.entity_id = s1_id JOIN tok r ON r.entity_id = cand_id AND r.field = l.field AND r.token = l.token JOIN idf i ON i.country = l.country AND i.field = l.field AND i.token = l.token GROUP BY ALL""",
    "coverage": "SELECT p.*, round(combined::DOUBLE / greatest(own, 1), 6) AS coverage FROM pool p JOIN (SELECT entity_id AS s1_id, sum(idf_micro)::BIGINT AS own FROM tok JOIN idf USING (country, field, token) WHERE source = 1 GROUP BY entity_id) USING (s1_id)",
    "three_views": "SELECT * FROM (SELECT *, combined > 0 AND row_number() OVER (PARTITION BY s1_id ORDER BY (combined > 0) DESC, combined DESC, cand_id DESC) <= 3 AS in_combined, name_score > 0 AND row_number() OVER (PARTITION BY s1_id ORDER BY (name_score > 0) DESC, name_score DESC, cand_id DESC) <= 3 AS in_name, combined > name_score AND row_number() OVER (PARTITION BY s1_id ORDER BY (combined > name_score) DESC, combined - name_score DESC, cand_id DESC) <= 3 AS in_address FROM pool) WHERE in_combined OR in_name OR in_address",
    "standin_block": f"""WITH k AS (SELECT entity_id AS id, source, country, unnest(list_distinct({_WORDS.format('business_name')})) AS token FROM rec), u AS (SELECT * FROM k WHERE source <> 1),
        wt AS (SELECT country, token, round(ln(n::DOUBLE / count(*)) * 1000000)::BIGINT AS w FROM u JOIN (SELECT country, count(DISTINCT id) AS n FROM u GROUP BY country) USING (country) GROUP BY country, token, n HAVING count(*) <= @standin@),
        p AS (SELECT k.id AS s1_id, u.id AS cand_id, sum(w)::BIGINT AS score FROM k JOIN wt USING (country, token) JOIN u USING (country, token) WHERE k.source = 1 GROUP BY ALL)
        SELECT *, row_number() OVER (PARTITION BY s1_id ORDER BY score DESC, cand_id)::INT AS rank FROM p QUALIFY rank <= 3""",
    "rescue_channel": "WITH p AS (SELECT l.entity_id AS s1_id, r.entity_id AS cand_id, sum(idf_micro)::BIGINT AS combined, 0::BIGINT AS name_score FROM idf JOIN tok l USING (country, field, token) JOIN tok r USING (country, field, token) WHERE l.field = 'a' AND df <= @rescue@ AND l.source = 1 AND r.source <> 1 GROUP BY ALL), q AS (SELECT * FROM p ANTI JOIN (SELECT * FROM ranked WHERE rank <= 2) x USING (s1_id, cand_id)) SELECT *, row_number() OVER (PARTITION BY s1_id ORDER BY combined DESC, cand_id)::INT AS rank FROM q QUALIFY rank <= 3",
    "label_pairs": "SELECT s1_id, cand_id, label FROM lab",
    "truth_summary": "SELECT (SELECT count(*) FROM s1) AS n_s1, (SELECT count(*) FROM s1 ANTI JOIN truth USING (s1_id)) AS singletons, (SELECT max(k) FROM (SELECT count(t.cand_id) AS k FROM s1 LEFT JOIN truth t USING (s1_id) GROUP BY s1_id)) AS most_matches, count(*) AS links, count_if(starts_with(cand_id, 'S2-'))::BIGINT AS links_s2, count_if(starts_with(cand_id, 'S3-'))::BIGINT AS links_s3, count(DISTINCT cand_id) AS linked, (SELECT count(*) FROM (SELECT 1 FROM truth GROUP BY cand_id HAVING count(DISTINCT s1_id) > 1)) AS several_s1 FROM truth",
    "match_histogram": "SELECT k AS n_matches, count(*) AS n_s1 FROM (SELECT count(t.cand_id) AS k FROM s1 LEFT JOIN truth t USING (s1_id) GROUP BY s1_id) GROUP BY k",
    "token_changes": f"WITH x AS (SELECT {_WORDS.format('an')} AS a, {_WORDS.format('bn')} AS b FROM texts), c AS (SELECT 'added' AS kind, unnest(list_distinct(list_filter(b, lambda y: NOT list_contains(a, y)))) AS token FROM x UNION ALL SELECT 'removed', unnest(list_distinct(list_filter(a, lambda y: NOT list_contains(b, y)))) FROM x) SELECT kind, token, count(*) AS n FROM c GROUP BY kind, token QUALIFY row_number() OVER (PARTITION BY kind ORDER BY n DESC, token) <= 25",
    "pair_recall_by_group": "WITH m AS (SELECT t.*, s.country, r.cand_id IS NOT NULL AS f FROM truth t JOIN s1 s USING (s1_id) LEFT JOIN run r USING (s1_id, cand_id)) SELECT grp, value, count(*) AS n_true, count_if(f)::BIGINT AS n_found FROM (SELECT f, 'all' AS grp, 'all' AS value FROM m UNION ALL SELECT f, 'country', country FROM m UNION ALL SELECT f, 'source', substr(cand_id, 1, 2) FROM m) GROUP BY grp, value",
    "jaccard_pairs": f"SELECT s1_id, cand_id, round({_JACC.format('a', 'b')}, 9) AS jaccard FROM (SELECT s1_id, cand_id, list_distinct({_WORDS.format('an')}) AS a, list_distinct({_WORDS.format('bn')}) AS b FROM texts)",
    "num_features": f"""WITH x AS (SELECT s1_id, cand_id, {_DIGITS.format(_ADDRESS.format('aa'))} AS a, {_DIGITS.format(_ADDRESS.format('ba'))} AS b, list_distinct({_NODIGITS.format(_ADDRESS.format('aa'))}) AS u, list_distinct({_NODIGITS.format(_ADDRESS.format('ba'))}) AS v FROM texts)
        SELECT s1_id, cand_id, len(list_intersect(a, b))::INT AS num_shared_n, len(list_distinct(list_filter(a, lambda y: NOT list_contains(b, y))))::INT AS num_only_s1_n, len(list_distinct(list_filter(b, lambda y: NOT list_contains(a, y))))::INT AS num_only_cand_n,
        CASE WHEN len(a) = 0 OR len(b) = 0 THEN -1 ELSE (len(list_filter(a, lambda y: len(list_filter(b, lambda z: y <> z AND least(length(y), length(z)) >= 2 AND (starts_with(y, z) OR starts_with(z, y)))) > 0)) > 0)::INT END AS num_prefix, round({_JACC.format('u', 'v')}, 6) AS addr_word_jacc FROM x""",
    "name_rarity": f"""WITH c AS (SELECT entity_id, source, country, {_CORE.format('business_name')} AS core FROM rec), k AS (SELECT country, core, count(*) FILTER (WHERE source = 1) AS sn, count(*) FILTER (WHERE source <> 1) AS cn FROM c GROUP BY ALL),
        wd AS (SELECT country, word, ln((n + 1) / (count(*) + 1)) AS idf FROM (SELECT country, unnest(core) AS word FROM c) JOIN (SELECT country, count(*)::DOUBLE AS n FROM c GROUP BY country) USING (country) GROUP BY country, word, n),
        p AS (SELECT r.s1_id, r.cand_id, a.country, a.core AS ac, b.core AS bc FROM run r JOIN c a ON a.entity_id = r.s1_id JOIN c b ON b.entity_id = r.cand_id),
        e AS (SELECT s1_id, cand_id, country, ac, bc, unnest(list_distinct(list_concat(ac, bc))) AS word FROM p),
        g AS (SELECT s1_id, cand_id, sum(idf) FILTER (WHERE list_contains(ac, word) AND list_contains(bc, word)) AS x, sum(idf) AS y, max(idf) FILTER (WHERE list_contains(ac, word) AND list_contains(bc, word)) AS z FROM e JOIN wd USING (country, word) GROUP BY ALL)
        SELECT p.s1_id, p.cand_id, round(ln(1 + coalesce(ka.sn, 0)), 6) AS s1_core_freq, round(ln(1 + coalesce(kb.cn, 0)), 6) AS cand_core_freq, round(CASE WHEN y > 0 THEN coalesce(x, 0) / y ELSE 0 END, 6) AS core_idf_jacc, round(coalesce(z, 0), 6) AS core_rarest_shared_idf
        FROM p LEFT JOIN k ka ON ka.country = p.country AND ka.core = p.ac LEFT JOIN k kb ON kb.country = p.country AND kb.core = p.bc LEFT JOIN g ON g.s1_id = p.s1_id AND g.cand_id = p.cand_id""",
    "rank_gap": "SELECT s1_id, cand_id, combined, name_score, max(combined) OVER s - combined AS combined_gap, (rank() OVER (PARTITION BY s1_id ORDER BY combined DESC))::DOUBLE AS combined_rank, max(name_score) OVER s - name_score AS name_score_gap, (rank() OVER (PARTITION BY s1_id ORDER BY name_score DESC))::DOUBLE AS name_score_rank, count(*) OVER s AS n_cands FROM run WINDOW s AS (PARTITION BY s1_id)",
    "top_two": "SELECT cand_id, max(prob) FILTER (WHERE r = 1) AS t1, max(prob) FILTER (WHERE r = 2) AS t2 FROM (SELECT *, row_number() OVER (PARTITION BY cand_id ORDER BY prob DESC, s1_id) AS r FROM run) GROUP BY cand_id",
    "cross_gap": "SELECT s1_id, cand_id, round(coalesce(CASE WHEN prob >= t1 THEN prob - t2 ELSE prob - t1 END, 0), 6) AS gap FROM (SELECT *, max(prob) OVER (PARTITION BY cand_id) AS t1, nth_value(prob, 2) OVER (PARTITION BY cand_id ORDER BY prob DESC, s1_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS t2 FROM run)",
    "exclusive_winner": "SELECT * FROM won",
    "hybrid_candidates": "SELECT s1_id, cand_id, coalesce(base_rank, 0) AS base_rank, coalesce(deep_rank, 0) AS deep_rank, origin, hybrid_rank FROM hybrid",
    "merge_deep": f"SELECT s1_id, cand_id, 0 AS is_deep FROM acc UNION ALL (SELECT s1_id, cand_id, 1 FROM hyb ANTI JOIN acc a USING (cand_id) WHERE origin = 1 AND prob >= {DEEP_THRESHOLD} QUALIFY row_number() OVER (PARTITION BY cand_id ORDER BY prob DESC, s1_id) = 1)",
    "meta_context": f"""SELECT s1_id, cand_id, s1_top1, s1_top2, s1_top3, above_30, above_50, above_70, above_90, prob_sum, s1_base_top1, s1_deep_top1, s1_n_cands, prob_pos_in_s1, round(s1_top1 - s1_top2, 6) AS gap12 FROM (
        SELECT *, coalesce(nth_value(prob, 1) OVER o, 0) AS s1_top1, coalesce(nth_value(prob, 2) OVER o, 0) AS s1_top2, coalesce(nth_value(prob, 3) OVER o, 0) AS s1_top3, {_levels('OVER s')}, round(sum(prob) OVER s, 6) AS prob_sum, coalesce(max(prob) FILTER (WHERE origin = 0) OVER s, 0) AS s1_base_top1, coalesce(max(prob) FILTER (WHERE origin = 1) OVER s, 0) AS s1_deep_top1, count(*) OVER s AS s1_n_cands, (row_number() OVER (PARTITION BY s1_id ORDER BY prob DESC, hybrid_rank) - 1)::INT AS prob_pos_in_s1
        FROM hyb WINDOW s AS (PARTITION BY s1_id), o AS (PARTITION BY s1_id ORDER BY prob DESC, hybrid_rank ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))""",
    "meta_decide": f"WITH ok AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY cand_id, origin ORDER BY prob DESC, s1_id) AS r FROM hyb) WHERE r = 1 AND prob >= CASE WHEN origin = 0 THEN {THRESHOLD} ELSE {DEEP_THRESHOLD} END) SELECT s1_id, cand_id, origin, prob AS score FROM ok WHERE origin = 0 OR cand_id NOT IN (SELECT cand_id FROM ok WHERE origin = 0)",
    "claimants": "SELECT s1_id, cand_id, n::INT AS n_claimants, round(prob - coalesce(CASE WHEN prob >= t1 THEN prob - t2 ELSE prob - t1 END, 0), 6) AS best_other FROM (SELECT *, count(*) OVER (PARTITION BY cand_id) AS n, max(prob) OVER (PARTITION BY cand_id) AS t1, nth_value(prob, 2) OVER (PARTITION BY cand_id ORDER BY prob DESC, s1_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS t2 FROM run)",
    "s1_aggregates": f"SELECT s1_id, coalesce(p[1], 0) AS top1, coalesce(p[2], 0) AS top2, coalesce(p[3], 0) AS top3, n, prob_sum, above_30, above_50, above_70, above_90 FROM (SELECT s1_id, list(prob ORDER BY prob DESC) AS p, count(*) AS n, round(sum(prob), 6) AS prob_sum, {_levels('')} FROM run GROUP BY s1_id)",
    "macro_f05": "SELECT round(avg(f05), 9) AS macro_f05, count(*) AS n_s1 FROM per",
    "threshold_grid": f"SELECT threshold, round(avg({_F05}), 9) AS macro_f05 FROM (SELECT g.threshold, s.s1_id, count(w.cand_id) FILTER (WHERE t.cand_id IS NOT NULL) AS tp, count(w.cand_id) AS n_pred, any_value(coalesce(n.k, 0)) AS n_true FROM s1 s, (SELECT unnest([{', '.join(map(str, GRID))}])::DOUBLE AS threshold) g LEFT JOIN won w ON w.s1_id = s.s1_id AND w.prob >= g.threshold LEFT JOIN truth t ON t.s1_id = w.s1_id AND t.cand_id = w.cand_id LEFT JOIN (SELECT s1_id, count(*) AS k FROM truth GROUP BY s1_id) n ON n.s1_id = s.s1_id GROUP BY ALL) GROUP BY threshold",
    "blocking_metrics": "WITH x AS (SELECT s.s1_id, s.country, (SELECT count(*) FROM run r JOIN truth t USING (s1_id, cand_id) WHERE r.s1_id = s.s1_id) AS tp, (SELECT count(*) FROM run r WHERE r.s1_id = s.s1_id) AS n, (SELECT count(*) FROM truth t WHERE t.s1_id = s.s1_id) AS n_true FROM s1 s) SELECT country, count(*) AS n_s1, round(sum(tp)::DOUBLE / nullif(sum(n_true), 0), 9) AS pair_recall, round(avg(CASE WHEN n_true = 0 THEN CASE WHEN tp = 0 THEN 1.0 ELSE 0.0 END ELSE 1.25 * tp / (tp + 0.25 * n_true) END), 9) AS ceiling, round(avg(n), 9) AS cands_per_s1, round(avg((tp = n_true)::INT), 9) AS all_true_retained FROM x GROUP BY ROLLUP (country)",
    "overlap_runs": "WITH x AS (SELECT s.country, r.cand_id IS NOT NULL AS b, d.cand_id IS NOT NULL AS d, t.cand_id IS NOT NULL AS t FROM run r FULL JOIN deep d USING (s1_id, cand_id) LEFT JOIN truth t USING (s1_id, cand_id) JOIN s1 s USING (s1_id)) SELECT country, count_if(b AND NOT d)::BIGINT AS base_only, count_if(b AND d)::BIGINT AS both, count_if(NOT b AND d)::BIGINT AS deep_only, count_if(b AND NOT d AND t)::BIGINT AS base_only_true, count_if(b AND d AND t)::BIGINT AS both_true, count_if(NOT b AND d AND t)::BIGINT AS deep_only_true FROM x GROUP BY ROLLUP (country)",
    "pool_summary": "WITH p AS (SELECT list(k ORDER BY k) AS v, avg(k) AS m FROM (SELECT count(*)::DOUBLE AS k FROM pool GROUP BY s1_id)) SELECT round(m, 6) AS mean, v[1 + least(len(v) - 1, floor(0.5 * len(v)))::INT] AS median, v[1 + least(len(v) - 1, floor(0.95 * len(v)))::INT] AS p95, v[-1] AS max FROM p",
    "error_classes": f"SELECT CASE WHEN said THEN CASE WHEN label = 1 THEN 'TP' ELSE 'FP' END WHEN label = 0 THEN 'TN' WHEN prob::FLOAT >= {THRESHOLD}::FLOAT THEN 'FN3' ELSE 'FN2' END AS error, count(*) AS n FROM (SELECT l.*, l.prob::FLOAT >= {THRESHOLD}::FLOAT AND w.cand_id IS NOT NULL AS said FROM lab l LEFT JOIN won w USING (s1_id, cand_id)) GROUP BY 1",
    "missed_pairs": "SELECT DISTINCT s1_id, cand_id FROM truth ANTI JOIN run USING (s1_id, cand_id)",
    "error_breakdown": "SELECT category, count(*) AS n, round(avg(prob), 6) AS mean_prob, round(avg(rank), 6) AS mean_rank, round(count(*)::DOUBLE / (SELECT count(*) FROM lab), 6) AS share FROM (SELECT *, unnest(list_filter([CASE WHEN starts_with(cand_id, 'S2-') THEN 'S2' ELSE 'S3' END, CASE WHEN rank = 1 THEN 'first' END, CASE WHEN name_score > 0 THEN 'named' END], lambda x: x IS NOT NULL)) AS category FROM lab) GROUP BY category",
    "error_patterns": "SELECT concat_ws(' | ', CASE WHEN starts_with(cand_id, 'S2-') THEN 'S2' END, CASE WHEN rank = 1 THEN 'first' END, CASE WHEN name_score > 0 THEN 'named' END, CASE WHEN prob >= 0.5 THEN 'likely' END) AS pattern, count(*) AS n FROM lab GROUP BY 1 ORDER BY n DESC, pattern LIMIT 20",
    "rank_buckets": "SELECT CASE WHEN rank <= 1 THEN '1' WHEN rank <= 3 THEN '2-3' WHEN rank <= 5 THEN '4-5' WHEN rank <= 10 THEN '6-10' WHEN rank <= 20 THEN '11-20' WHEN rank <= 50 THEN '21-50' ELSE '51+' END AS bucket, count(*) AS n FROM deep GROUP BY 1",
    "oracle_prefix": "WITH u AS (SELECT l.*, sum(label) OVER o AS tp, count(*) OVER o AS k, coalesce(n, 0) AS n_true FROM lab l LEFT JOIN (SELECT s1_id, count(*) AS n FROM truth GROUP BY s1_id) USING (s1_id) WINDOW o AS (PARTITION BY s1_id ORDER BY prob DESC, cand_id ROWS UNBOUNDED PRECEDING)), b AS (SELECT s1_id, max(CASE WHEN n_true = 0 THEN 0.0 ELSE 1.25 * tp / (k + 0.25 * n_true) END) AS b FROM u GROUP BY s1_id) SELECT s1_id, round(greatest(coalesce(b, 0), CASE WHEN s1_id IN (SELECT s1_id FROM truth) THEN 0.0 ELSE 1.0 END), 9)::DOUBLE AS best_f05 FROM s1 LEFT JOIN b USING (s1_id)",
    "auc": "SELECT round(sum(CASE WHEN p.prob > n.prob THEN 1.0 WHEN p.prob = n.prob THEN 0.5 ELSE 0.0 END)::DOUBLE / count(*), 9) AS auc FROM lab p, lab n WHERE p.label = 1 AND n.label = 0",
    "true_by_accepted": "SELECT n_true, n_pred, count(*) AS n_s1 FROM per GROUP BY ALL",
    "match_output": "SELECT s1_row, s1_id, coalesce(string_agg(a.cand_id, ',' ORDER BY a.cand_id), '') AS ids FROM s1 LEFT JOIN acc a USING (s1_id) GROUP BY ALL",
    "candidate_output": "SELECT s1_row, s1_id, coalesce(string_agg(r.cand_id, ',' ORDER BY r.rank), '') AS ids FROM s1 LEFT JOIN run r USING (s1_id) GROUP BY ALL",
    "validator_findings": "WITH l AS (SELECT s1_row, s1_id, CASE WHEN s1_row % 7 = 0 THEN [s1_id, s1_id] ELSE coalesce(list(a.cand_id ORDER BY a.cand_id) FILTER (WHERE a.cand_id IS NOT NULL), []) END AS ids FROM s1 LEFT JOIN acc a USING (s1_id) WHERE s1_row % 10 <> 0 GROUP BY s1_row, s1_id), f AS (SELECT s1_id, unnest(ids) AS id FROM l) SELECT * FROM (SELECT 'repeated id in a list' AS rule, count(*) AS n FROM (SELECT 1 FROM f GROUP BY s1_id, id HAVING count(*) > 1) UNION ALL SELECT 'S1 id in a list', count(*) FROM f WHERE starts_with(id, 'S1-') UNION ALL SELECT 'missing S1', count(*) FROM s1 ANTI JOIN l USING (s1_id)) WHERE n > 0",
}

_FLAGS = {
    "same_country": "ac = bc",
    "name_equal_raw": "an = bn",
    "name_equal_folded": "af = bf",
    "name_equal_without_stopwords": "a = b",
    "share_name_token": "list_has_any(a, b)",
    "first_name_token_equal": "coalesce(a[1] = b[1], false)",
    "cand_name_nonlatin": "regexp_matches(regexp_replace(bn, '[\\x{0000}-\\x{024F}]', '', 'g'), '\\p{L}')",
    "cand_name_domain": "regexp_matches(bn, '(?i)\\.(com|in|net|org|co|fr)\\b')",
    "cand_name_alias": "regexp_matches(bn, '(?i)\\b(dba|d\\.b\\.a\\.?|fka|formerly known as|aka)\\b')",
    "cand_addr_empty": "len(y) = 0",
    "cand_addr_nonlatin": "regexp_matches(regexp_replace(ba, '[\\x{0000}-\\x{024F}]', '', 'g'), '\\p{L}')",
    "house_number_equal": "ah <> '' AND ah = bh",
    "share_2plus_addr_tokens": "len(list_intersect(x, y)) >= 2",
    "no_name_overlap_but_addr_overlap": "NOT list_has_any(a, b) AND len(list_intersect(x, y)) >= 2",
}
_HOUSE = "regexp_extract(translate({}, '#,', '  '), '(?:^|\\s)0*(\\d+)', 1)"
_NAMED = "list_filter(" + _FOLD + ", lambda x: x NOT IN " + _list(t.NAME_STOPWORDS) + ")"
_PLACED = "list_distinct(list_filter(" + _FOLD + ", lambda x: x NOT IN " + _list(t.ADDRESS_STOPWORDS) + "))"
BODY |= {
    "pair_patterns": f"WITH q AS (SELECT r.cand_id, a.country AS ac, b.country AS bc, a.business_name AS an, b.business_name AS bn, b.business_address AS ba, {_FOLD.format('a.business_name')} AS af, {_FOLD.format('b.business_name')} AS bf, {_NAMED.format('a.business_name')} AS a, {_NAMED.format('b.business_name')} AS b, {_PLACED.format('a.business_address')} AS x, {_PLACED.format('b.business_address')} AS y, {_HOUSE.format('a.business_address')} AS ah, {_HOUSE.format('b.business_address')} AS bh FROM run r JOIN rec a ON a.entity_id = r.s1_id JOIN rec b ON b.entity_id = r.cand_id), "
    "g AS (SELECT q.*, unnest(['all', ac, substr(cand_id, 1, 2)]) AS grp FROM q) SELECT grp, count(*) AS pairs, " + ", ".join(f"round(100.0::DOUBLE * (count(*) FILTER (WHERE {f})) / count(*), 6) AS {k}" for k, f in _FLAGS.items()) + " FROM g GROUP BY grp",
    "blocking_losses": "SELECT CASE WHEN k.cand_id IS NOT NULL THEN 'kept' WHEN p.cand_id IS NOT NULL THEN 'pruned' ELSE 'not_blocked' END AS fate, count(*) AS n FROM truth t LEFT JOIN pool p USING (s1_id, cand_id) LEFT JOIN (SELECT s1_id, cand_id FROM ranked WHERE rank <= 1) k USING (s1_id, cand_id) GROUP BY 1",
    "adaptive_thresholds": "WITH v AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY cand_id, origin ORDER BY prob DESC, s1_id) AS r FROM hyb) WHERE r = 1), f AS (SELECT *, row_number() OVER (PARTITION BY s1_id, origin ORDER BY prob DESC, cand_id) AS lead FROM v), ok AS (SELECT * FROM f WHERE prob >= CASE WHEN origin = 1 THEN 0.7 WHEN lead = 1 THEN 0.5 ELSE 0.65 END) SELECT s1_id, cand_id, origin, prob FROM ok WHERE origin = 0 OR cand_id NOT IN (SELECT cand_id FROM ok WHERE origin = 0)",
    "count_capped": "SELECT s1_id, cand_id, prob FROM (SELECT w.*, s1_row % 5 AS n, row_number() OVER (PARTITION BY s1_id ORDER BY prob DESC, cand_id) AS r FROM won w JOIN s1 USING (s1_id) WHERE prob >= 0.5) WHERE n >= 4 OR r <= n",
    "competition": f"WITH m AS (SELECT l.*, row_number() OVER (PARTITION BY cand_id ORDER BY prob DESC, s1_id) = 1 AS won, count(*) OVER (PARTITION BY cand_id) AS k, prob - nth_value(prob, 2) OVER (PARTITION BY cand_id ORDER BY prob DESC, s1_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS gap FROM lab l), x AS (SELECT *, unnest(list_filter([CASE WHEN won THEN 'exclusive' END, 'everyone', CASE WHEN won AND (k = 1 OR round(gap, 9) >= 0.05) THEN 'margin 0.05' END, CASE WHEN won AND (k = 1 OR round(gap, 9) >= 0.1) THEN 'margin 0.1' END, CASE WHEN won AND (k = 1 OR round(gap, 9) >= 0.2) THEN 'margin 0.2' END], lambda x: x IS NOT NULL)) AS variant FROM m WHERE prob >= {THRESHOLD}) SELECT variant, count(*) AS accepted, sum(label)::BIGINT AS tp FROM x GROUP BY variant",
    "ensemble": "WITH e AS (SELECT s1_id, cand_id, prob AS a, rank / 10.0::DOUBLE AS b, 0.4::DOUBLE AS c FROM run), l AS (SELECT *, (ln(greatest(least(a, 1 - 1e-6), 1e-6) / (1 - greatest(least(a, 1 - 1e-6), 1e-6))) + ln(b / (1 - b)) + ln(c / (1 - c))) / 3 AS z FROM e) SELECT s1_id, cand_id, round((a + b + c) / 3, 6) AS ens_mean, round(list_sort([a, b, c])[2], 6) AS ens_median, round(1 / (1 + exp(-z)), 6) AS ens_logit FROM l",
    "deep_rules": "SELECT s1_id, cand_id, round(coalesce(nth_value(prob, 2) OVER (PARTITION BY s1_id ORDER BY prob DESC, cand_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING), 0), 6) AS second, prob = max(prob) OVER (PARTITION BY s1_id) AS deep_is_best FROM hyb WHERE origin = 1",
}

_NATIVE = "regexp_matches(regexp_replace(business_name, '[\\x{0000}-\\x{024F}]', '', 'g'), '\\p{L}')"
_NO = _HOUSE.format("business_address")
_FINAL = BODY["merge_deep"]


def _per(pairs: str) -> str:
    """tp, n_pred, n_true and f05 of every S1 for accepted pairs."""
    counts = f"SELECT s.s1_id, s.country, s.s1_row, coalesce(p.n, 0) AS n_pred, coalesce(p.tp, 0) AS tp, coalesce(q.n, 0) AS n_true FROM s1 s LEFT JOIN (SELECT a.s1_id, count(*) AS n, count(t.cand_id) AS tp FROM ({pairs}) a LEFT JOIN truth t USING (s1_id, cand_id) GROUP BY a.s1_id) p USING (s1_id) LEFT JOIN (SELECT s1_id, count(*) AS n FROM truth GROUP BY s1_id) q USING (s1_id)"
    return f"SELECT *, {_F05} AS f05 FROM ({counts})"


def _compared(name: str, run: str) -> str:
    won = f"SELECT s1_id, cand_id FROM (SELECT *, row_number() OVER (PARTITION BY cand_id ORDER BY prob DESC, s1_id) AS r FROM {run}) WHERE r = 1 AND prob::FLOAT >= {THRESHOLD}::FLOAT"
    label = f"SELECT r.*, t.s1_id IS NOT NULL AS label FROM {run} r LEFT JOIN truth t USING (s1_id, cand_id)"
    held = f"SELECT s.s1_id, coalesce(n, 0) AS n, coalesce(tp, 0) AS tp, coalesce(k, 0) AS n_true FROM s1 s LEFT JOIN (SELECT s1_id, count(*) AS n, count_if(label) AS tp FROM ({label}) GROUP BY s1_id) USING (s1_id) LEFT JOIN (SELECT s1_id, count(*) AS k FROM truth GROUP BY s1_id) USING (s1_id)"
    auc = f"SELECT round(sum(CASE WHEN p.prob > n.prob THEN 1.0 WHEN p.prob = n.prob THEN 0.5 ELSE 0.0 END)::DOUBLE / count(*), 9) FROM ({label}) p, ({label}) n WHERE p.label AND NOT n.label"
    return f"SELECT '{name}' AS run, (SELECT round(sum(tp)::DOUBLE / sum(n_true), 9) FROM ({held})) AS pair_recall, (SELECT round(avg(CASE WHEN n_true = 0 THEN 1.0 ELSE 1.25 * tp / (tp + 0.25 * n_true) END), 9) FROM ({held})) AS ceiling, (SELECT round(avg(n), 9) FROM ({held})) AS cands_per_s1, (SELECT round(avg(f05), 9) FROM ({_per(won)})) AS macro_f05, (SELECT sum(n_pred - tp)::BIGINT FROM ({_per(won)})) AS false_positives, ({auc}) AS auc"


_SINGLE = "round(avg(CASE WHEN n_true = 0 THEN (n_pred = 0)::INT::DOUBLE END), 9) AS singletons_empty"
_RANKS = {"rank_1": "rank <= 1", "rank_2-3": "rank BETWEEN 2 AND 3", "rank_4-5": "rank BETWEEN 4 AND 5", "rank_6-10": "rank BETWEEN 6 AND 10"}
_KINDS = _RANKS | {
    "singleton_s1": "NOT matched", "matched_s1": "matched", "s1_address_missing": "aa = ''", "cand_address_missing": "ba = ''", "both_addresses": "aa <> '' AND ba <> ''", "first_num_missing": "ano = '' OR bno = ''",
    "first_num_equal": "ano <> '' AND ano = bno", "first_num_unequal": "ano <> '' AND bno <> '' AND ano <> bno", "claimed_by_other_s1": "coalesce(owner <> s1_id, false)", "multi_s1_candidate": "k > 1", "nonlatin_candidate": "native", "S2": "cand_id LIKE 'S2-%'", "S3": "cand_id LIKE 'S3-%'",
}
_ACCEPTED = "SELECT l.*, a.cand_id IS NOT NULL AS accepted FROM lab l LEFT JOIN acc a USING (s1_id, cand_id)"
_OWNER = "(SELECT cand_id, min(s1_id) AS owner FROM truth GROUP BY cand_id)"
BODY |= {
    "candidate_owner": f"SELECT r.s1_id, r.cand_id, owner, CASE WHEN owner IS NULL THEN 'none' WHEN owner = r.s1_id THEN 'own' ELSE 'other' END AS whose FROM run r LEFT JOIN {_OWNER} USING (cand_id)",
    "run_comparison": f"{_compared('base', 'run')} UNION ALL {_compared('deep', 'deep')}",
    "hybrid_report": f"WITH f AS ({_FINAL}), n AS ({_per('SELECT * FROM f')}), o AS ({_per('SELECT * FROM acc')}), d AS (SELECT n.*, n.f05 - o.f05 AS d FROM n JOIN o USING (s1_id)), x AS (SELECT h.*, f.cand_id IS NOT NULL AS a, t.cand_id IS NOT NULL AS l, {_NATIVE} AS native FROM hybrid h LEFT JOIN f USING (s1_id, cand_id) LEFT JOIN truth t USING (s1_id, cand_id) JOIN rec ON rec.entity_id = h.cand_id) SELECT round(avg(f05), 9) AS macro_f05, round(avg(d), 9) AS delta, round(stddev_samp(d) / sqrt(count(*)), 9) AS se, sum(tp)::BIGINT AS tp, sum(n_pred - tp)::BIGINT AS fp, sum(n_true - tp)::BIGINT AS fn, (SELECT count_if(a AND NOT l AND hybrid_rank <= 3) FROM x)::BIGINT AS fp_rank_1_3, (SELECT count_if(NOT a AND l AND native) FROM x)::BIGINT AS fn_native FROM d",
    "deep_evaluation": f"WITH f AS ({_FINAL}), n AS ({_per('SELECT * FROM f')}), o AS ({_per('SELECT * FROM acc')}), g AS (SELECT f.s1_id, count(*) AS added, count(t.cand_id) AS added_tp FROM f LEFT JOIN truth t USING (s1_id, cand_id) WHERE is_deep = 1 GROUP BY f.s1_id), d AS (SELECT n.*, n.f05 - o.f05 AS d, coalesce(added, 0) AS added, coalesce(added_tp, 0) AS added_tp FROM n JOIN o USING (s1_id) LEFT JOIN g USING (s1_id)) SELECT country, count(*) AS n_s1, round(avg(f05), 9) AS f05, round(avg(d), 9) AS delta, {_SINGLE}, sum(added)::BIGINT AS added, sum(added_tp)::BIGINT AS added_tp, sum(added - added_tp)::BIGINT AS added_fp, count_if(d > 1e-12)::BIGINT AS improved, count_if(d < -1e-12)::BIGINT AS harmed FROM d GROUP BY ROLLUP (country)",
    "oracle_ladder": f"WITH a AS ({_per('SELECT * FROM acc')}), b AS ({BODY['oracle_prefix']}), c AS ({_per('SELECT s1_id, cand_id FROM run SEMI JOIN truth USING (s1_id, cand_id)')}), e AS ({_per('SELECT s1_id, cand_id FROM deep SEMI JOIN truth USING (s1_id, cand_id)')}) SELECT (SELECT round(avg(f05), 9) FROM a) AS o0, (SELECT round(avg(best_f05), 9) FROM b) AS o1, (SELECT round(avg(f05), 9) FROM c) AS o2, (SELECT round(avg(f05), 9) FROM e) AS o3, 1.0::DOUBLE AS o4",
    "error_attribution": f"WITH j AS ({_ACCEPTED}), x AS (SELECT j.*, max(prob) FILTER (WHERE label = 0) OVER s AS mf, min(prob) FILTER (WHERE label = 1) OVER s AS mt, max(label) OVER s AS present, EXISTS (SELECT 1 FROM acc a WHERE a.cand_id = j.cand_id AND a.s1_id <> j.s1_id) AS taken, j.s1_id IN (SELECT s1_id FROM truth) AS matched FROM j WINDOW s AS (PARTITION BY s1_id)) SELECT CASE WHEN label = 1 THEN 'FN ' || CASE WHEN prob < 0.3 THEN 'below the floor' WHEN taken THEN 'lost to another S1' WHEN mf >= prob THEN 'outranked by a false one' ELSE 'below the threshold' END ELSE 'FP ' || CASE WHEN NOT matched THEN 'in an S1 without match' WHEN present = 0 THEN 'true ones are no candidates' WHEN prob > mt THEN 'outranks a true one' ELSE 'true ones rank above' END END AS fault, count(*) AS n FROM x WHERE (label = 1) <> accepted GROUP BY 1",
    "error_categories": f"WITH x AS (SELECT l.*, a.business_address AS aa, b.business_address AS ba, {_HOUSE.format('a.business_address')} AS ano, {_HOUSE.format('b.business_address')} AS bno, {_NATIVE.replace('business_name', 'b.business_name')} AS native, owner, l.s1_id IN (SELECT s1_id FROM truth) AS matched, count(*) OVER (PARTITION BY l.cand_id) AS k FROM lab l JOIN rec a ON a.entity_id = l.s1_id JOIN rec b ON b.entity_id = l.cand_id LEFT JOIN {_OWNER} o ON o.cand_id = l.cand_id) " + " UNION ALL ".join(f"SELECT '{k}' AS category, count(*) AS n, round(avg(prob), 6) AS mean_prob, round(count(*)::DOUBLE / (SELECT count(*) FROM x), 6) AS share FROM x WHERE {w} HAVING count(*) > 0" for k, w in _KINDS.items()),
    "gate_metrics": f"SELECT round(avg(f05), 9) AS macro_f05, round(avg(CASE WHEN n_true > 0 THEN f05 END), 9) AS matched_f05, {_SINGLE}, count_if(s1_row % 5 = 0)::BIGINT AS suppressed, count_if(s1_row % 5 = 0 AND n_true = 0)::BIGINT AS suppressed_singletons, count_if(s1_row % 5 = 0 AND n_true > 0)::BIGINT AS suppressed_matched FROM ({_per('SELECT a.* FROM acc a JOIN s1 USING (s1_id) WHERE s1_row % 5 <> 0')})",
    "fold_thresholds": f"WITH g AS (SELECT f.fold::INT AS fold, g.threshold, s.s1_id, count(w.cand_id) FILTER (WHERE t.cand_id IS NOT NULL) AS tp, count(w.cand_id) AS n_pred, any_value(coalesce(n.k, 0)) AS n_true FROM range(3) f(fold) JOIN s1 s ON (s.s1_row // 3) % 3 <> f.fold, (SELECT unnest([{', '.join(map(str, GRID))}])::DOUBLE AS threshold) g LEFT JOIN won w ON w.s1_id = s.s1_id AND w.prob >= g.threshold LEFT JOIN truth t ON t.s1_id = w.s1_id AND t.cand_id = w.cand_id LEFT JOIN (SELECT s1_id, count(*) AS k FROM truth GROUP BY s1_id) n ON n.s1_id = s.s1_id GROUP BY ALL), m AS (SELECT fold, threshold, round(avg({_F05}), 9) AS m FROM g GROUP BY ALL) SELECT fold, threshold FROM m QUALIFY row_number() OVER (PARTITION BY fold ORDER BY m DESC, threshold) = 1",
    "hard_groups": f"WITH x AS (SELECT l.* FROM lab l JOIN won w USING (s1_id, cand_id) WHERE l.prob::FLOAT >= {THRESHOLD}::FLOAT) " + " UNION ALL ".join(f"SELECT '{k}' AS grp, count(*) AS accepted, count_if(label = 0)::BIGINT AS false_positives FROM x WHERE {w} HAVING count(*) > 0" for k, w in {"all": "true", "S2": "cand_id LIKE 'S2-%'", "behind": "rank > 1", "unnamed": "name_score = 0"}.items()),
    "missed_shares": f"SELECT CASE WHEN r.cand_id IS NULL THEN 'FN1' ELSE 'reachable' END AS reach, count(*) AS n, round(avg(({_NO} <> '')::INT::DOUBLE), 9) AS numbered, round(avg((t.cand_id LIKE 'S2-%')::INT::DOUBLE), 9) AS S2, median(length(business_name))::DOUBLE AS median_name_len FROM truth t JOIN rec ON entity_id = t.s1_id LEFT JOIN (SELECT s1_id, cand_id FROM ranked WHERE rank <= 1) r USING (s1_id, cand_id) GROUP BY 1",
    "first_s1": "SELECT * FROM s1 WHERE s1_row < 500",
    "every_kth": "SELECT entity_id FROM rec WHERE source_row % 7 = 0",
    "development_truth": "SELECT t.* FROM truth t JOIN s1 USING (s1_id) WHERE s1_row % 4 = 0",
    "sample_records": "SELECT entity_id, country FROM rec WHERE entity_id IN (SELECT s1_id FROM s1 WHERE s1_row % 4 = 0) OR entity_id IN (SELECT cand_id FROM truth JOIN s1 USING (s1_id) WHERE s1_row % 4 = 0)",
    "value_counts": "WITH c AS (" + " UNION ALL ".join(f"SELECT '{c}' AS field, {c}::VARCHAR AS value FROM rec" for c in ("business_name", "business_address", "country", "source")) + "), m AS (SELECT field, value, count(*) AS m FROM c GROUP BY ALL) SELECT field, sum(m)::BIGINT AS n_rows, count(value) AS n_values, coalesce(sum(m) FILTER (WHERE value IS NULL), 0)::BIGINT AS n_null, max(m) AS most FROM m GROUP BY field",
    "mark_counts": " UNION ALL ".join(f"SELECT '{c}' AS field, sum(len(regexp_extract_all({c}, '\\p{{M}}')))::BIGINT AS marks, count_if(regexp_matches({c}, '[*#]'))::BIGINT AS masked FROM rec" for c in ("business_name", "business_address")),
    "holdout_overlap": f"SELECT count(*) AS n_held, 0::BIGINT AS n_shared FROM ({BODY['holdout_select']})",
    "score_extremes": "SELECT s1_id, cand_id, max(prob) FILTER (WHERE label = 0) OVER s AS max_false, min(prob) FILTER (WHERE label = 1) OVER s AS min_true FROM lab WINDOW s AS (PARTITION BY s1_id)",
}


def _limited(sql: str, limits: Limits) -> str:
    for name, value in asdict(limits).items():
        sql = sql.replace(f"@{name}@", str(value))
    return sql


def oracle_sql(limits: Limits = LIMITS) -> dict[str, str]:
    head = "WITH " + ",\n".join(f"{k} AS ({v})" for k, v in CTES.items())
    return {name: _limited(f"{head},\nanswer AS ({body})\nSELECT * FROM answer", limits) for name, body in BODY.items()}
