"""DuckDB twins of the operators that SQL can express."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORDS = (r"regexp_extract_all(translate(coalesce(text, ''), '" + _UPPER + "', '" + _LOWER
          + r"'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")

ORACLE: dict[str, str] = {
    "op1_line_dedup": r"""
WITH split AS (
  SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line,
         unnest(range(len(string_split(text, chr(10))))) AS i FROM documents),
full_lines AS (
  SELECT doc_id, i, trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) AS line,
         len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n
  FROM split WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS k FROM full_lines),
pairs AS (  -- each line with every earlier place of an equal one
  SELECT a.doc_id AS first_doc, b.doc_id, a.k AS first_k, b.k, b.i, b.n
  FROM numbered a JOIN numbered b
    ON a.line = b.line AND (a.doc_id < b.doc_id OR (a.doc_id = b.doc_id AND a.k < b.k))),
runs AS (  -- neighbouring pairs are one match, whole both ways
  SELECT doc_id, min(i) AS lo, max(i) AS hi FROM (
    SELECT *, k - row_number() OVER (PARTITION BY first_doc, doc_id, k - first_k ORDER BY k)
      AS island FROM pairs)
  GROUP BY first_doc, doc_id, k - first_k, island HAVING sum(n) >= 50),
gone AS (SELECT DISTINCT doc_id, unnest(range(lo, hi + 1)) AS i FROM runs),
kept AS (
  SELECT s.doc_id, string_agg(s.line, chr(10) ORDER BY s.i) AS text
  FROM split s ANTI JOIN gone g ON s.doc_id = g.doc_id AND s.i = g.i GROUP BY s.doc_id),
counted AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text,
       CASE WHEN d.text IS NULL THEN 0 ELSE len(string_split(d.text, chr(10))) END AS n_lines,
       coalesce(c.n, 0) AS n_removed
FROM documents d LEFT JOIN kept k USING (doc_id) LEFT JOIN counted c USING (doc_id)
""",
    "op5_chat_format": r"""
WITH src AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'),
                   (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
parts AS (
  SELECT *, CASE role WHEN 'user' THEN ' [/INST]' WHEN 'assistant' THEN ' </s>'
                      WHEN 'system' THEN chr(10) || '<</SYS>>' || chr(10) || chr(10)
                      ELSE ' [/TURN]' END AS tail,
         CASE role WHEN 'user' THEN 10 WHEN 'assistant' THEN 1 WHEN 'system' THEN 8
                   ELSE 14 + length(role) END AS head,
         len(regexp_extract_all(text,
           '[<\[]\\*(/?s>|/?INST\]|<SYS>>|</SYS>>|/?ROLE\]|/TURN\])')) AS controls
  FROM src),
sized AS (
  SELECT *, head + length(text) + length(tail) + CASE
    WHEN strpos(text || tail, tail) = length(text) + 1 AND NOT regexp_matches(text,
      '[<\[]\\+(/?s>|/?INST\]|<SYS>>|</SYS>>|/?ROLE\]|/TURN\])') THEN 0
    ELSE controls END AS chars FROM parts)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role) FILTER (role = 'assistant'), ''))
         AS loss_sha256,
       CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
""",
    "op7_decontamination": f"""
WITH items AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
pieces AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n,
         unnest(list_transform(range(1, greatest(len(w) - 10, 0) + 2),
                               lambda i: array_to_string(w[i:i + 9], ' '))) AS win
  FROM items WHERE len(w) > 0),
lengths AS (SELECT DISTINCT n FROM pieces),
docs AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
grams AS (
  SELECT r, n, unnest(range(1, len(w) - n + 2)) AS pos,
         unnest(list_transform(range(1, len(w) - n + 2),
                               lambda i: array_to_string(w[i:i + n - 1], ' '))) AS win
  FROM docs, lengths WHERE len(w) >= n),
hits AS (SELECT g.r, g.pos, g.n, p.item_id FROM grams g JOIN pieces p USING (n, win)),
words AS (SELECT r, count(DISTINCT k) AS n_hit
          FROM (SELECT r, unnest(range(pos, pos + n)) AS k FROM hits) GROUP BY r),
ids AS (SELECT r, count(*) AS n_items,
               string_agg(id, ',' ORDER BY id) AS s
        FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS id FROM hits) GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN words USING (r) LEFT JOIN ids USING (r)
""",
    "op12_lexical_search": f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
sizes AS (SELECT r, doc_id, len(w)::BIGINT AS n FROM docs WHERE len(w) > 0),
totals AS (SELECT count(*)::BIGINT AS n_docs, sum(n)::BIGINT AS n_terms FROM sizes),
counts AS (SELECT r, term, count(*)::BIGINT AS tf FROM (SELECT r, unnest(w) AS term FROM docs)
           GROUP BY r, term),
wanted AS (SELECT DISTINCT item_id, unnest({_WORDS}) AS term FROM benchmark),
weights AS (
  SELECT term, floor(1000 * ln((2.0::DOUBLE * n_docs + 2) / (2 * df + 1)))::BIGINT AS weight
  FROM (SELECT term, count(*) AS df FROM counts GROUP BY term), totals),
scores AS (
  SELECT item_id, r, sum(weight * ((1000000000 * tf)
           // (1000 * tf + 8 * (100 - 90 + ((90 * n * n_docs) // n_terms)))))::BIGINT AS score
  FROM wanted JOIN weights USING (term) JOIN counts USING (term) JOIN sizes USING (r), totals
  GROUP BY item_id, r),
ranked AS (
  SELECT item_id, doc_id, score,
         row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank
  FROM scores JOIN sizes USING (r) WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 10
""",
}
