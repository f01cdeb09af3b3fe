"""DuckDB SQL of the operators that SQL can express, from the same parameters."""
from paneltide.llm import bag_search, byte_terms, decontaminate, license_scan, line_dedup, line_quality

_R = line_quality.LineRules()
_WORD, _SPACE = r"[^\x20\x09-\x0D]", r"[\x20\x09-\x0D]"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


LINE_QUALITY = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, regexp_extract_all(t, {_quoted(_WORD + '+')}) AS ws FROM d),
tri AS (SELECT r, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g
        FROM (SELECT r, ws, unnest(range(1, len(ws) - 1)) AS i FROM w WHERE len(ws) >= 3)),
dup AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM tri) WHERE n > 1),
cov AS (SELECT r, count(DISTINCT i + k) AS n FROM dup, (VALUES (0), (1), (2)) v(k) GROUP BY r),
l AS (SELECT r, unnest(string_split(t, chr(10))) AS line FROM d),
f AS (SELECT r, line, trim(line) AS s, regexp_matches(line, {_quoted(_WORD)}) AS full_line,
             length(regexp_replace(line, {_quoted(_SPACE + '+')}, '', 'g')) AS c FROM l),
j AS (SELECT *, NOT full_line OR (regexp_matches(s, {_quoted(_R.line_end)})
             AND length(s) - length(regexp_replace(s, {_quoted(line_quality.SYMBOLS)}, '', 'g'))
                 <= length(s) * {_R.max_symbol_share}::DOUBLE
             AND length(s) - length(regexp_replace(s, {_quoted(_R.separators)}, '', 'g')) <= {_R.max_separators}
             AND length(s) - length(replace(s, '!!', '')) <= {2 * _R.max_shouts}
             AND NOT regexp_matches(lower(s), {_quoted(_R.boilerplate)})) AS passes FROM f),
m AS (SELECT r, count(*) FILTER (NOT passes) AS lines_removed, coalesce(sum(c) FILTER (NOT passes), 0) AS chars_removed,
             sum(c) AS word_chars, count(*) FILTER (full_line) - count(DISTINCT line) FILTER (full_line) AS n_dup_lines
      FROM j GROUP BY r),
a AS (SELECT d.doc_id, len(ws)::BIGINT AS n_words, word_chars::BIGINT AS word_chars,
             (length(t) - length(regexp_replace(t, {_quoted(line_quality.SYMBOLS)}, '', 'g')))::BIGINT AS n_symbols,
             n_dup_lines::BIGINT AS n_dup_lines, coalesce(cov.n, 0)::BIGINT AS n_repeat_words,
             lines_removed::BIGINT AS lines_removed, chars_removed::BIGINT AS chars_removed
      FROM d JOIN w USING (r) JOIN m USING (r) LEFT JOIN cov USING (r))
SELECT *, n_words < {_R.min_words} OR n_repeat_words * 100 > n_words * {_R.max_repeat_percent} AS base_failed,
       NOT (n_words < {_R.min_words} OR n_repeat_words * 100 > n_words * {_R.max_repeat_percent})
       AND chars_removed <= word_chars * {_R.max_lost_share}::DOUBLE AS kept
FROM a
"""

_T = ", ".join(f"({i}, {_quoted(n)}, {_quoted(t)})" for i, (n, t) in enumerate(license_scan.TEMPLATES))
_t = license_scan.THRESHOLD
LICENSE_SCAN = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
u AS (SELECT r, unnest(range(0, len(ls) + CASE WHEN len(ls) > 1 THEN 1 ELSE 0 END)) AS k, ls FROM d),
un AS (SELECT r, k, len(ls) AS n, CASE WHEN k < len(ls) THEN ls[k + 1] ELSE array_to_string(ls, chr(10)) END AS t FROM u),
uw AS (SELECT r, k, n, list_filter(regexp_split_to_array(lower(t), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '') AS w FROM un),
ub AS (SELECT r, k, n, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS b FROM uw),
tw AS (SELECT i, name, list_filter(regexp_split_to_array(lower(t), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '') AS w
       FROM (VALUES {_T}) v(i, name, t)),
tb AS (SELECT i, name, list_distinct(list_transform(range(1, len(w)), lambda j: w[j] || ' ' || w[j + 1])) AS g FROM tw),
h AS (SELECT r, k, n, i, name, 2.0::DOUBLE * len(list_intersect(b, g)) / (len(b) + len(g)) AS dice
      FROM ub JOIN tb ON len(b) BETWEEN len(g) * {_t} / (2 - {_t}) - 1e-9 AND len(g) * (2 - {_t}) / {_t} + 1e-9),
x AS (SELECT * FROM h WHERE dice >= {_t}::DOUBLE),
best AS (SELECT r, name, dice, CASE WHEN k < n THEN k + 1 ELSE 0 END AS line FROM x
         QUALIFY row_number() OVER (PARTITION BY r ORDER BY dice DESC, i, k) = 1),
c AS (SELECT r, count(DISTINCT k) AS n_lines FROM x WHERE k < n GROUP BY r)
SELECT d.doc_id, best.name AS license, best.dice, best.line::BIGINT AS line, coalesce(c.n_lines, 0)::BIGINT AS n_lines
FROM d LEFT JOIN best USING (r) LEFT JOIN c USING (r)
"""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_TERM = byte_terms.PATTERN[2:-2]                           # what a term does not hold
LINE_DEDUP = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, text, regexp_extract(text, '^[{_TERM}]*') AS lead,
                  regexp_extract_all(text, '[^{_TERM}]+[{_TERM}]*') AS parts FROM documents),
p AS (SELECT r, doc_id, unnest(parts) AS part, unnest(range(1, len(parts) + 1)) AS i, len(parts) AS n FROM d),
w AS (SELECT *, translate(regexp_extract(part, '^[^{_TERM}]+'), '{_UPPER}', '{_LOWER}') AS word FROM p),
e AS (SELECT *, 1 + strlen(word) // {line_dedup.WIDE} AS weight,
             i = n OR strlen(word) >= {line_dedup.LONG} OR regexp_matches(part, '[\n.!?,;:]') AS ends FROM w),
k AS (SELECT *, 1 + coalesce(sum(ends::INT) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS u FROM e),
u AS (SELECT r, doc_id, u, sum(weight) AS weight, string_agg(word, ' ' ORDER BY i) AS words, string_agg(part, '' ORDER BY i) AS chars
      FROM k GROUP BY r, doc_id, u),
c AS (SELECT *, sum(weight) OVER (PARTITION BY r ORDER BY u) AS upto FROM u),
s AS (SELECT a.r, a.u AS first, min(b.u) AS last FROM c a JOIN c b ON a.r = b.r AND b.u BETWEEN a.u AND a.u + {line_dedup.MIN_WORDS}
          AND b.upto - a.upto + a.weight >= {line_dedup.MIN_WORDS} GROUP BY a.r, a.u),
x AS (SELECT s.r, s.first, s.last, any_value(c.doc_id) AS doc_id, string_agg(c.words, ' ' ORDER BY c.u) AS words
      FROM s JOIN c ON c.r = s.r AND c.u BETWEEN s.first AND s.last GROUP BY s.r, s.first, s.last),
y AS (SELECT * FROM x QUALIFY row_number() OVER (PARTITION BY words ORDER BY doc_id NULLS LAST, r, first) > 1),
g AS (SELECT DISTINCT r, unnest(range(first::BIGINT, last::BIGINT + 1)) AS u FROM y),
t AS (SELECT c.r, c.u, c.chars, g.u IS NOT NULL AS cut, length(c.chars) AS len,
             coalesce(sum(length(c.chars)) OVER (PARTITION BY c.r ORDER BY c.u ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
      FROM c LEFT JOIN g ON g.r = c.r AND g.u = c.u),
runs AS (SELECT r, min(start) AS start, sum(len) AS len
         FROM (SELECT *, u - row_number() OVER (PARTITION BY r ORDER BY u) AS island FROM t WHERE cut) GROUP BY r, island),
spans AS (SELECT r, count(*) AS n_cut, sum(len) AS chars_cut, string_agg((start + length(lead))::BIGINT || ':' || len::BIGINT, ',' ORDER BY start) AS cut_spans
          FROM runs JOIN d USING (r) GROUP BY r),
left_over AS (SELECT r, coalesce(string_agg(chars, '' ORDER BY u) FILTER (NOT cut), '') AS rest FROM t GROUP BY r)
SELECT doc_id, CASE WHEN n_cut IS NULL THEN text ELSE lead || rest END AS text, coalesce(n_cut, 0)::BIGINT AS n_cut,
       coalesce(chars_cut, 0)::BIGINT AS chars_cut, coalesce(cut_spans, '') AS cut_spans
FROM d LEFT JOIN spans USING (r) LEFT JOIN left_over USING (r)
"""

WINNOWING = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id,
                  regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{byte_terms.PATTERN_LOWER}') AS w FROM documents),
b AS (SELECT coalesce(item_id::VARCHAR, '') AS item,
             regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{byte_terms.PATTERN_LOWER}') AS w FROM benchmark),
bi AS (SELECT item, w, least(len(w), {decontaminate.SPAN}) AS k, unnest(range(1, len(w) - least(len(w), {decontaminate.SPAN}) + 2)) AS i
       FROM b WHERE len(w) > 0),
bw AS (SELECT DISTINCT item, k, array_to_string(w[i:i + k - 1], ' ') AS x FROM bi),
di AS (SELECT r, k, w, unnest(range(1, len(w) - k + 2)) AS i FROM d, (SELECT DISTINCT k FROM bw) WHERE len(w) >= k),
dw AS (SELECT r, k, i, array_to_string(w[i:i + k - 1], ' ') AS x FROM di),
h AS (SELECT r, k, i, x FROM dw SEMI JOIN bw USING (k, x)),
n AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + k)) AS p FROM h) GROUP BY r),
t AS (SELECT r, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256
      FROM (SELECT DISTINCT r, item FROM h JOIN bw USING (k, x)) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       coalesce(items_sha256, sha256('')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN n USING (r) LEFT JOIN t USING (r)
"""

BAG_SEARCH = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '{byte_terms.PATTERN}') AS w FROM documents),
dt AS (SELECT r, doc_id, len(w)::BIGINT AS n, translate(unnest(w), '{_UPPER}', '{_LOWER}') AS t FROM d WHERE len(w) > 0),
tf AS (SELECT r, doc_id, n, t, count(*) AS tf FROM dt GROUP BY ALL),
z AS (SELECT count(*) AS n_docs, sum(len(w))::HUGEINT AS n_terms FROM d WHERE len(w) > 0),
dfs AS (SELECT t, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w
        FROM (SELECT t, count(*) AS df FROM tf GROUP BY t), z),
b AS (SELECT row_number() OVER () AS q, item_id, regexp_extract_all(coalesce(text, ''), '{byte_terms.PATTERN}') AS w FROM benchmark),
bt AS (SELECT q, item_id, t, count(*) AS c FROM (SELECT q, item_id, translate(unnest(w), '{_UPPER}', '{_LOWER}') AS t FROM b) GROUP BY ALL),
s AS (SELECT q, item_id, r, doc_id, sum(c * dfs.w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_docs) // n_terms))))::BIGINT AS score
      FROM tf JOIN bt USING (t) JOIN dfs USING (t), z GROUP BY ALL),
k AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST, r) AS rank FROM s WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM k WHERE rank <= {bag_search.TOP}
"""

ORACLE: dict[str, str] = {"op5_line_quality": LINE_QUALITY, "op7_license_scan": LICENSE_SCAN, "op8_line_dedup": LINE_DEDUP,
                          "op11_winnowing": WINNOWING, "op13_bag_search": BAG_SEARCH}
