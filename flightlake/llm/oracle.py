"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

from . import quality_rules as q

WORDS = r"'[^\x20\x09-\x0D]+'"

# Metrics of the quality rules over a table named docs (doc_id may repeat, so rows get a number).
QUALITY_CTES = rf"""
numbered AS (SELECT *, row_number() OVER () AS rid FROM docs),
worded AS (
  SELECT rid, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), {WORDS}) AS ws,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM numbered),
windows AS (
  SELECT rid, i, array_to_string(ws[i : i + {q.WINDOW_WORDS - 1}], ' ') AS g
  FROM (SELECT rid, ws, unnest(range(1, len(ws) - {q.WINDOW_WORDS - 2})) AS i FROM worded WHERE len(ws) >= {q.WINDOW_WORDS})),
found AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS n FROM windows) WHERE n > 1),
covered AS (
  SELECT rid, sum(least({q.WINDOW_WORDS}, coalesce(nxt - i, {q.WINDOW_WORDS})))::BIGINT AS n_repeat_words
  FROM (SELECT rid, i, lead(i) OVER (PARTITION BY rid ORDER BY i) AS nxt FROM found) GROUP BY rid),
counted AS (
  SELECT w.rid, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
         (length(t) - length(regexp_replace(t, '{q.SYMBOLS}', '', 'g')))::BIGINT AS n_symbols,
         (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, len(ls)::BIGINT AS n_lines,
         coalesce(c.n_repeat_words, 0)::BIGINT AS n_repeat_words,
         len(list_filter(range(2, len(ws) + 1), lambda i: ws[i] = ws[i - 1]))::BIGINT AS n_stutter,
         (length(t) - length(regexp_replace(t, '\p{{Lu}}', '', 'g')))::BIGINT AS n_capitals
  FROM worded w LEFT JOIN covered c USING (rid)),
rated AS (
  SELECT rid, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
         n_words < {q.MIN_WORDS} OR 100 * n_repeat_words > {q.MAX_REPEAT_PERCENT} * n_words AS base_failed,
         CASE WHEN n_words > 0 THEN n_symbols * 1000 // n_words ELSE 0 END AS symbols,
         CASE WHEN n_lines > 0 THEN n_dup_lines * 1000 // n_lines ELSE 0 END AS dup_lines,
         CASE WHEN n_words > 0 THEN n_repeat_words * 1000 // n_words ELSE 0 END AS repeats,
         CASE WHEN n_words > 0 THEN n_stutter * 1000 // n_words ELSE 0 END AS stutter,
         CASE WHEN word_chars > 0 THEN n_capitals * 1000 // word_chars ELSE 0 END AS capitals
  FROM counted),
long_form AS (
  SELECT rid, lang, source, rule, v
  FROM (SELECT n.rid, n.lang, n.source, base_failed, unnest({list(q.RULES)}) AS rule,
               unnest([symbols, dup_lines, repeats, stutter, capitals]) AS v
        FROM rated JOIN numbered n USING (rid))
  WHERE NOT base_failed),
sketch AS (
  SELECT lang, source, rule, v - v % (1::BIGINT << greatest(0, length(bin(v)) - {q.SKETCH_BITS})::INTEGER) AS value, count(*) AS n
  FROM long_form GROUP BY ALL),
own AS (
  SELECT lang, source, rule, min(value) FILTER (2 * cum >= tot) AS q50, min(value) FILTER (4 * cum >= 3 * tot) AS q75
  FROM (SELECT *, sum(n) OVER (PARTITION BY lang, source, rule ORDER BY value) AS cum, sum(n) OVER (PARTITION BY lang, source, rule) AS tot FROM sketch)
  GROUP BY lang, source, rule),
pool_sketch AS (SELECT lang, rule, value, sum(n) AS n FROM sketch GROUP BY ALL),
pool AS (
  SELECT lang, rule, min(value) FILTER (2 * cum >= tot) AS q50, min(value) FILTER (4 * cum >= 3 * tot) AS q75
  FROM (SELECT *, sum(n) OVER (PARTITION BY lang, rule ORDER BY value) AS cum, sum(n) OVER (PARTITION BY lang, rule) AS tot FROM pool_sketch)
  GROUP BY lang, rule),
slack AS (SELECT unnest({list(q.RULES)}) AS rule, unnest({list(q.SLACK.values())}) AS s),
limits AS (
  SELECT o.lang, o.source, o.rule,
         greatest((p.q75 + 3 * (p.q75 - p.q50) + s) // 2, least(o.q75 + 3 * (o.q75 - o.q50) + s, 2 * (p.q75 + 3 * (p.q75 - p.q50) + s))) AS lim
  FROM own o JOIN pool p ON p.lang IS NOT DISTINCT FROM o.lang AND p.rule = o.rule JOIN slack k ON k.rule = o.rule),
broken AS (
  SELECT DISTINCT l.rid FROM long_form l JOIN limits m
  ON m.lang IS NOT DISTINCT FROM l.lang AND m.source IS NOT DISTINCT FROM l.source AND m.rule = l.rule WHERE l.v > m.lim),
judged AS (
  SELECT n.*, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
         NOT base_failed AND n.rid NOT IN (SELECT rid FROM broken) AS kept
  FROM numbered n JOIN rated USING (rid))
"""

ORACLE = {
    "op3_quality_rules": f"""
WITH docs AS (SELECT * FROM documents), {QUALITY_CTES}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept FROM judged""",
    "op8_block_naming": """
WITH n AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       row_number() OVER (PARTITION BY t ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(t) AS text_sha256
FROM n""",
    "op10_chat_format": r"""
WITH rows AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
g AS (
  SELECT conv_id, count(*)::BIGINT AS n_turns,
         string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS flat,
         coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS loss,
         sum(length(role) + length(text) + length(regexp_replace(text, '[<\[]_*(?:\||/?s>|/?INST\])', '~', 'g')) * 0
             + len(regexp_extract_all(text, '[<\[]_*(?:\||/?s>|/?INST\])')) + 13)::BIGINT AS formatted_chars
  FROM rows GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(flat) AS turns_sha256, length(loss)::BIGINT AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars
FROM g""",
    "op11_impact_search": r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS rid,
                  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ws FROM documents),
s AS (SELECT count(*) AS n_docs, sum(len(ws))::BIGINT AS n_terms FROM d WHERE len(ws) > 0),
i AS (SELECT item_id, row_number() OVER () AS item,
             unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
      FROM benchmark),
q AS (SELECT item, item_id, term, count(*) AS qtf FROM i GROUP BY ALL),
t AS (SELECT rid, term, count(*) AS tf FROM (SELECT rid, unnest(ws) AS term FROM d) SEMI JOIN q USING (term) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM t, s GROUP BY term, n_docs),
m AS (SELECT rid, doc_id, 100 - 75 + (75::HUGEINT * len(ws) * n_docs) // n_terms AS m FROM d, s WHERE len(ws) > 0),
p AS (SELECT item, item_id, doc_id, rid, sum(qtf * w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
      FROM q JOIN w USING (term) JOIN t USING (term) JOIN m USING (rid) GROUP BY ALL),
r AS (SELECT item_id, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id, rid)::INTEGER AS rank, doc_id, score FROM p WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 10""",
    "op12_source_divergence": r"""
WITH d AS (SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ws
           FROM documents),
occ AS (SELECT rid, lang, source, unnest(ws) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS n FROM occ GROUP BY lang, term HAVING count(DISTINCT rid) >= 30),
langs AS (SELECT lang, count(*) AS v, sum(n)::BIGINT AS total FROM kept GROUP BY lang),
q AS (SELECT lang, term, (1 + 1000000000::HUGEINT * (n + 5) // (total + 5 * v))::BIGINT AS q FROM kept JOIN langs USING (lang)),
grp AS (SELECT DISTINCT lang, source FROM d),
cnt AS (SELECT lang, source, term, count(*) AS n FROM occ SEMI JOIN kept USING (lang, term) GROUP BY ALL),
tot AS (SELECT g.lang, g.source, coalesce(sum(n), 0)::BIGINT AS total FROM grp g LEFT JOIN cnt USING (lang, source) GROUP BY ALL),
p AS (
  SELECT t.lang, t.source, k.term, coalesce(c.n, 0) AS n, (1 + 1000000000::HUGEINT * (coalesce(c.n, 0) + 5) // (t.total + 5 * l.v))::BIGINT AS p
  FROM tot t JOIN langs l USING (lang) JOIN kept k USING (lang) LEFT JOIN cnt c ON c.lang = t.lang AND c.source = t.source AND c.term = k.term),
sums AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p))::BIGINT AS f FROM p a JOIN p b USING (lang, term) WHERE a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, b.source AS item, coalesce(f, 0)::BIGINT AS value
          FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
terms AS (SELECT lang, source, term AS item, p - q AS value FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q),
ranked AS (
  SELECT lang, source, 'pair' AS part, item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM pairs
  UNION ALL
  SELECT lang, source, 'term', item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) FROM terms)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM ranked WHERE part = 'pair' OR rank <= 50""",
    "op13_anchor_dedup": r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
win AS (
  SELECT rid, doc_id, i, sha256(array_to_string(ws[i : i + 49], ' ')) AS g
  FROM (SELECT rid, doc_id, ws, unnest(range(1, len(ws) - 48)) AS i FROM d WHERE len(ws) >= 50)),
first AS (SELECT g, min(doc_id) AS m FROM win GROUP BY g),
hit AS (SELECT rid, i FROM win JOIN first USING (g) WHERE m < doc_id),
word AS (SELECT rid, unnest(ws) AS w, unnest(range(1, len(ws) + 1)) AS i FROM d),
mark AS (SELECT rid, i, w, max(CASE WHEN h.i IS NOT NULL THEN 1 ELSE 0 END) OVER (PARTITION BY rid ORDER BY i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS gone
         FROM word LEFT JOIN hit h USING (rid, i)),
per AS (SELECT rid, sum(gone)::BIGINT AS n_removed, string_agg(w, ' ' ORDER BY i) FILTER (gone = 0) AS kept FROM mark GROUP BY rid)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN per USING (rid)""",
}
