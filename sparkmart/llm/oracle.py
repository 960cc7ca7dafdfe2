"""Expected results as DuckDB SQL, where SQL can express them."""

from __future__ import annotations

_LINE_FREQUENCY = r"""
WITH docs AS (SELECT doc_id, source, coalesce(text, '') AS text, text AS raw FROM documents),
base AS (
  SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws,
    list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS dl
  FROM docs),
windows AS (
  SELECT row, i, count(*) OVER (PARTITION BY row, w) AS times
  FROM (SELECT row, i, list_aggregate(ws[i:i + 7], 'string_agg', ' ') AS w
        FROM (SELECT rowid AS row, ws, unnest(generate_series(1, len(ws) - 7)) AS i FROM (SELECT row_number() OVER () AS rowid, * FROM base)))),
repeats AS (
  SELECT row, count(DISTINCT i + k) AS n FROM windows, generate_series(0, 7) g(k) WHERE times > 1 GROUP BY row),
numbered AS (SELECT row_number() OVER () AS row, * FROM base),
counts AS (
  SELECT numbered.*, len(ws) AS n_words,
    coalesce(list_sum(list_transform(ws, lambda w: length(w))), 0) AS word_chars,
    length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    len(dl) - len(list_distinct(dl)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words
  FROM numbered LEFT JOIN repeats USING (row)),
lines AS (
  SELECT row, source, raw, translate(lower(trim(l, BLANKS)), '123456789', '000000000') AS line, len(regexp_extract_all(l, '[^\x20\x09-\x0D]+')) AS n
  FROM (SELECT row, source, raw, unnest(string_split(text, chr(10))) AS l FROM numbered) WHERE trim(l, BLANKS) <> ''),
longest AS (SELECT row, list_sort(list_distinct(list({'n': -length(line), 'l': line})))[1:3] AS three FROM lines GROUP BY row),
beside AS (
  SELECT DISTINCT source, line, coalesce('t' || raw, 'n') AS doc,
    coalesce(list_filter(three, lambda x: x.l <> line)[1].l, '') || chr(10) || coalesce(list_filter(three, lambda x: x.l <> line)[2].l, '') AS others
  FROM lines JOIN longest USING (row)),
often AS (
  SELECT source, line FROM beside GROUP BY ALL HAVING count(DISTINCT others) > 10 AND 4 * count(DISTINCT others) > 3 * count(DISTINCT doc)),
shares AS (
  SELECT row, sum(CASE WHEN o.line IS NULL THEN n ELSE 0 END) / sum(n) AS share
  FROM lines l LEFT JOIN often o ON l.source IS NOT DISTINCT FROM o.source AND l.line = o.line GROUP BY row),
judged AS (
  SELECT *, (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AS base_failed FROM counts LEFT JOIN shares USING (row))
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
  CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
  CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
  (NOT base_failed AND coalesce(share, 1) >= 0.3) AS kept
FROM judged
""".replace("BLANKS", "' ' || chr(9) || chr(11) || chr(12) || chr(13)")

_LINE_DEDUP = r"""
WITH docs AS (SELECT row_number() OVER () AS row, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
every AS (
  SELECT row, doc_id, pos - 1 AS pos, regexp_replace(ls[pos], '^[\x20\x09\x0B-\x0D]+|[\x20\x09\x0B-\x0D]+$', '', 'g') AS line
  FROM (SELECT row, doc_id, ls, unnest(generate_series(1, len(ls))) AS pos FROM docs)
  WHERE regexp_matches(ls[pos], '[^ 	-
]')),
different AS (
  SELECT line, min(struct_pack(doc_id := doc_id, pos := pos)) AS first, length(line) AS n,
    length(replace(line, 'e', '')) AS e, length(replace(line, 't', '')) AS t, length(replace(line, 'n', '')) AS m,
    length(replace(line, 'r', '')) AS r, length(replace(line, 'h', '')) AS h, length(replace(line, ' ', '')) AS s
  FROM every GROUP BY line),
near AS (
  SELECT x.line AS line, y.line AS other, x.first > y.first AS later
  FROM different x JOIN (SELECT *, unnest(generate_series(-2, 2)) AS d FROM different) y ON x.n = y.n + y.d AND x.line <> y.line
  WHERE x.n >= 24 AND y.n >= 24 AND abs(x.e - y.e) <= 2 AND abs(x.t - y.t) <= 2 AND abs(x.m - y.m) <= 2
    AND abs(x.r - y.r) <= 2 AND abs(x.h - y.h) <= 2 AND abs(x.s - y.s) <= 2 AND levenshtein(x.line, y.line) <= 2),
linked AS (SELECT line, count(*) AS links, bool_or(later) AS near FROM near GROUP BY line),
told AS (
  SELECT row, pos, coalesce(links, 0) AS links, struct_pack(doc_id := doc_id, pos := pos) <> first AS exact, coalesce(near, false) AS near
  FROM every JOIN different USING (line) LEFT JOIN linked USING (line))
SELECT doc_id, len(any_value(ls)) AS n_lines, CAST(coalesce(sum(CAST(exact AS INT)), 0) AS BIGINT) AS n_exact,
  CAST(coalesce(sum(CAST(near AND NOT exact AS INT)), 0) AS BIGINT) AS n_near, CAST(coalesce(sum(links), 0) AS BIGINT) AS n_links,
  coalesce(string_agg(CAST(pos AS VARCHAR), ',' ORDER BY pos) FILTER (WHERE exact OR near), '') AS removed
FROM docs LEFT JOIN told USING (row) GROUP BY row, doc_id
"""

_ONLY_A_TO_Z = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_DIVERGENCE = r"""
WITH docs AS (SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
terms AS (SELECT row, lang, source, unnest(regexp_extract_all(LOWERED, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
counts AS (SELECT lang, source, term, count(*) AS g, count(DISTINCT row) AS within FROM terms GROUP BY ALL),
kept AS (SELECT lang, term, CAST(sum(g) AS HUGEINT) AS l FROM counts GROUP BY ALL HAVING sum(within) >= 30),
langs AS (SELECT lang, count(*) AS v, sum(l) AS n FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM docs),
totals AS (
  SELECT groups.lang, groups.source, coalesce(any_value(langs.v), 0) AS v, coalesce(any_value(langs.n), 0) AS all_n, coalesce(sum(g), 0) AS n
  FROM groups LEFT JOIN langs USING (lang) LEFT JOIN (SELECT * FROM counts SEMI JOIN kept USING (lang, term)) c ON c.lang = groups.lang AND c.source = groups.source
  GROUP BY ALL),
shares AS (
  SELECT t.lang, t.source, k.term, coalesce(c.g, 0) AS g,
    1 + (1000000000 * CAST(coalesce(c.g, 0) + 5 AS HUGEINT)) // CAST(t.n + 5 * t.v AS HUGEINT) AS p,
    1 + (1000000000 * CAST(k.l + 5 AS HUGEINT)) // CAST(t.all_n + 5 * t.v AS HUGEINT) AS q
  FROM totals t JOIN kept k USING (lang) LEFT JOIN counts c ON c.lang = t.lang AND c.source = t.source AND c.term = k.term),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(any_value(d.value), 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (SELECT x.lang, x.source, y.source AS item, sum(abs(x.p - y.p)) AS value FROM shares x JOIN shares y ON x.lang = y.lang AND x.term = y.term GROUP BY ALL) d
    ON d.lang = a.lang AND d.source = a.source AND d.item = b.source
  GROUP BY ALL),
parts AS (
  SELECT lang, source, 'pair' AS part, item, value FROM pairs
  UNION ALL SELECT lang, source, 'term', term, p - q FROM shares WHERE g > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM parts)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM ranked WHERE part = 'pair' OR rank <= 50
""".replace("LOWERED", _ONLY_A_TO_Z.format("text"))

_RESAMPLING = r"""
WITH bits AS (
  SELECT list_transform(generate_series(0, 255), lambda b:
    list_reduce(generate_series(1, 8), lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END, CAST(b AS BIGINT))) AS crc),
docs AS (SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(LOWERED, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
target AS (SELECT regexp_extract_all(LOWERED, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
found AS (SELECT row, unnest(ws) AS w FROM docs),
sought AS (SELECT unnest(ws) AS w FROM target),
hexed AS (SELECT w, hex(encode(w)) AS x FROM (SELECT w FROM found UNION SELECT w FROM sought)),
hashed AS (
  SELECT w, xor(list_reduce(list_transform(generate_series(1, len(x) // 2), lambda i: CAST(strpos('0123456789ABCDEF', x[2 * i - 1]) * 16 + strpos('0123456789ABCDEF', x[2 * i]) - 17 AS BIGINT)),
    lambda c, b: xor(c >> 8, crc[xor(c, b) % 256 + 1]), CAST(4294967295 AS BIGINT)), 4294967295) % 10000 AS bucket
  FROM hexed, bits),
s AS (SELECT bucket, count(*) AS n FROM found JOIN hashed USING (w) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS n FROM sought JOIN hashed USING (w) GROUP BY bucket),
gains AS (
  SELECT bucket, CAST(floor(1000 * ln((coalesce(t.n, 0) + 1.0::DOUBLE) * ((SELECT count(*) FROM found) + 10000.0::DOUBLE)
    / ((s.n + 1.0::DOUBLE) * ((SELECT count(*) FROM sought) + 10000.0::DOUBLE)))) AS BIGINT) AS gain
  FROM s LEFT JOIN t USING (bucket)),
weighed AS (
  SELECT docs.row, doc_id, len(any_value(ws)) AS n_features, CAST(coalesce(floor(sum(gain) / count(gain)), 0) AS BIGINT) AS weight
  FROM docs LEFT JOIN found USING (row) LEFT JOIN hashed USING (w) LEFT JOIN gains USING (bucket) GROUP BY docs.row, doc_id),
noisy AS (SELECT *, sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS x FROM weighed),
numbered AS (
  SELECT *, list_reduce(list_transform(generate_series(1, 8), lambda i: CAST(strpos('0123456789abcdef', x[i]) - 1 AS BIGINT)), lambda a, b: a * 16 + b) AS h FROM noisy),
scored AS (SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score FROM numbered),
ranked AS (
  SELECT *, row_number() OVER (ORDER BY n_features >= 20 DESC, score DESC, doc_id NULLS LAST, n_features) AS rank, count(*) FILTER (WHERE n_features >= 20) OVER () AS n FROM scored)
SELECT doc_id, CAST(n_features AS BIGINT) AS n_features, weight, score, CASE WHEN rank <= 10 * n // 100 THEN rank END AS rank FROM ranked
""".replace("LOWERED", _ONLY_A_TO_Z.format("coalesce(text, '')"))

ORACLES = {
    "op3_line_dedup": _LINE_DEDUP,
    "op4_line_frequency": _LINE_FREQUENCY,
    "op11_divergence_audit": _DIVERGENCE,
    "op12_importance_resampling": _RESAMPLING,
}
