"""DuckDB SQL of the queries that SQL can express."""

OP1 = r"""
WITH words AS (
  SELECT doc_id, source, text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
), grams AS (
  SELECT doc_id, i, ws[i] || ' ' || ws[i+1] || ' ' || ws[i+2] AS g
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM words)
), twice AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM grams) WHERE n > 1
), repeated AS (
  SELECT doc_id, count(DISTINCT p) AS n
  FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY doc_id
), lines AS (
  SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM words)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id
), counted AS (
  SELECT w.doc_id, w.source, len(ws)::BIGINT AS n_words,
         coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::BIGINT AS word_chars,
         len(regexp_extract_all(coalesce(text, ''), '[#*$%&|<>]'))::BIGINT AS n_symbols,
         coalesce(l.n_lines, 0)::BIGINT AS n_lines, coalesce(l.n_dup, 0)::BIGINT AS n_dup_lines,
         coalesce(r.n, 0)::BIGINT AS n_repeat_words
  FROM words w LEFT JOIN repeated r USING (doc_id) LEFT JOIN lines l USING (doc_id)
), flags AS (
  SELECT *, n_words < 50 AS f1, 100 * n_repeat_words > 50 * n_words AS f2, 10 * n_symbols > n_words AS f3,
         10 * n_dup_lines > 3 * n_lines AS f4, word_chars < 3 * n_words OR word_chars > 12 * n_words AS f5
  FROM counted
), hosts AS (
  SELECT source, count(*) AS n, unnest([1, 2, 3, 4, 5]) AS rule,
         unnest([sum(f1::INT), sum(f2::INT), sum(f3::INT), sum(f4::INT), sum(f5::INT)]) AS failed
  FROM flags WHERE source IS NOT NULL GROUP BY source
), prior AS (
  SELECT rule, avg(failed / n) AS m, var_pop(failed / n) AS v FROM hosts GROUP BY rule
), bad AS (
  SELECT DISTINCT source FROM (
    SELECT source, failed, n, m,
           CASE WHEN v > 0 THEN least(1000, greatest(1, m * (1 - m) / v - 1)) ELSE 1000 END AS s
    FROM hosts JOIN prior USING (rule))
  WHERE (failed + m * s) / (n + s) > 0.5
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (f1 OR f2) AS base_failed,
       NOT (f1 OR f2) AND coalesce(source NOT IN (SELECT source FROM bad), true) AS kept
FROM flags
"""

OP3 = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
), starts AS (
  SELECT doc_id, i, array_to_string(ws[i:i + 49], ' ') AS w
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS i FROM words)
), firsts AS (
  SELECT w, min(doc_id) AS first_id FROM starts GROUP BY w
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p FROM starts JOIN firsts USING (w) WHERE first_id < doc_id
), flat AS (
  SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS p FROM words
), kept AS (
  SELECT f.doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS kept
  FROM flat f ANTI JOIN gone USING (doc_id, p) GROUP BY f.doc_id
)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM words w LEFT JOIN kept USING (doc_id)
"""

OP6 = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
), flat AS (
  SELECT doc_id, unnest(ws) AS w, unnest(range(1, len(ws) + 1)) AS i FROM words
), runs AS (
  SELECT doc_id, i, w, lag(w) OVER p AS v, lag(w, 2) OVER p AS u FROM flat WINDOW p AS (PARTITION BY doc_id ORDER BY i)
), c1 AS (
  SELECT w, count(*) AS n FROM flat GROUP BY w
), c2 AS (
  SELECT v, w, count(*) AS n FROM runs WHERE v IS NOT NULL GROUP BY v, w HAVING count(*) >= 2
), c3 AS (
  SELECT u, v, w, count(*) AS n FROM runs WHERE u IS NOT NULL GROUP BY u, v, w HAVING count(*) >= 2
), scored AS (
  SELECT doc_id, c3.n IS NULL AND c2.n IS NULL AS backed,
         round_even(ln(CASE WHEN c3.n IS NOT NULL THEN c3.n / h2.n
                            WHEN c2.n IS NOT NULL THEN if(r.u IS NULL, 1, 0.4::DOUBLE) * c2.n / h1.n
                            WHEN r.v IS NULL THEN c1.n
                            WHEN r.u IS NULL THEN 0.4::DOUBLE * c1.n
                            ELSE 0.4::DOUBLE * 0.4::DOUBLE * c1.n END) * 1e6, 0)::BIGINT AS v
  FROM runs r JOIN c1 ON c1.w = r.w
  LEFT JOIN c1 h1 ON h1.w = r.v LEFT JOIN c2 ON c2.v = r.v AND c2.w = r.w
  LEFT JOIN c2 h2 ON h2.v = r.u AND h2.w = r.v LEFT JOIN c3 ON c3.u = r.u AND c3.v = r.v AND c3.w = r.w
), sums AS (
  SELECT doc_id, count(*) AS n, sum(backed::INT) AS b, sum(v) AS s FROM scored GROUP BY doc_id
)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, coalesce(b, 0)::BIGINT AS n_backed_off,
       (coalesce(s, 0) - coalesce(b, 0) * round(ln((SELECT count(*) FROM flat)) * 1e6)::BIGINT)::BIGINT AS score_micro
FROM words w LEFT JOIN sums USING (doc_id)
"""

OP4 = r"""
WITH RECURSIVE c AS (
  SELECT conv_id, turn, role, text, CASE role WHEN 'user' THEN 'call' WHEN 'assistant' THEN 'result' ELSE 'message' END AS kind,
         CASE WHEN role = 'user' THEN 'call-' || CASE WHEN (conv_id + turn) % 7 = 0 THEN turn - 2 ELSE turn END
              WHEN role = 'assistant' THEN 'call-' || CASE (conv_id + turn) % 5 WHEN 0 THEN turn + 1 WHEN 1 THEN turn - 3 ELSE turn - 1 END
         END AS id,
         CASE WHEN conv_id % 4 = 1 THEN CASE WHEN turn % 8 < 6 THEN ['call-' || (turn + 2)] ELSE [] END
              WHEN conv_id % 4 = 2 AND turn % 8 < 2 THEN ['call-' || (turn + 2)]
              WHEN conv_id % 4 = 3 THEN CASE WHEN turn % 8 < 2 THEN ['call-' || (turn + 2), 'call-' || (turn + 4)] ELSE [] END
              ELSE ['call-' || (turn - 2)] END AS after,
         (3 * conv_id + turn) % 5 AS fault, len(regexp_split_to_array(trim(text), '[ \n]+')) AS words
  FROM conversations
), first AS (
  SELECT conv_id, id, min(turn) AS turn, arg_min(after, turn) AS after FROM c WHERE kind = 'call' GROUP BY conv_id, id
), edges AS (
  SELECT f.conv_id, f.id, f.turn, d.id AS dep, d.turn AS dep_turn
  FROM (SELECT conv_id, id, turn, unnest(after) AS dep FROM first) f JOIN first d ON d.conv_id = f.conv_id AND d.id = f.dep
), odd AS (
  SELECT conv_id, count(*) AS n FROM first WHERE conv_id IN (SELECT conv_id FROM edges WHERE dep_turn >= turn) GROUP BY conv_id
), walk AS (
  SELECT f.conv_id, f.id, 0 AS far, n FROM first f JOIN odd USING (conv_id)
  UNION
  SELECT w.conv_id, e.id, far + 1, n FROM walk w JOIN edges e ON e.conv_id = w.conv_id AND e.dep = w.id WHERE far < n
), far AS (
  SELECT conv_id, id, max(far) AS far, max(far) >= any_value(n) AS cyclic FROM walk GROUP BY conv_id, id
), steps AS (
  SELECT conv_id, id, cyclic,
         CASE WHEN cyclic THEN coalesce(max(far) FILTER (NOT cyclic) OVER (PARTITION BY conv_id), -1) + 1 ELSE far END AS step
  FROM far
), answers AS (
  SELECT c.conv_id, c.id, min(c.turn) AS turn FROM c JOIN first f ON f.conv_id = c.conv_id AND f.id = c.id
  WHERE kind = 'result' AND c.turn >= f.turn GROUP BY c.conv_id, c.id
), k AS (
  SELECT c.*, CASE WHEN c.kind = 'call' THEN fault > 1 END AS valid,
         CASE WHEN c.kind = 'call' THEN CASE WHEN s.cyclic THEN 'cycle' WHEN c.turn <> f.turn THEN 'duplicate'
                                             WHEN a.turn IS NULL THEN 'pending' ELSE 'linked' END
              WHEN c.kind = 'result' THEN CASE WHEN f.turn IS NULL THEN 'orphan' WHEN c.turn < f.turn THEN 'early'
                                               WHEN c.turn = a.turn THEN 'linked' ELSE 'duplicate' END
              ELSE 'message' END AS status,
         CASE WHEN f.turn IS NOT NULL THEN coalesce(s.step, 0)
              ELSE coalesce(max(CASE WHEN c.kind = 'call' AND c.turn = f.turn THEN s.step END)
                            OVER (PARTITION BY c.conv_id ORDER BY c.turn), 0) END::INT AS step
  FROM c LEFT JOIN first f ON f.conv_id = c.conv_id AND f.id = c.id
         LEFT JOIN steps s ON s.conv_id = c.conv_id AND s.id = c.id LEFT JOIN answers a ON a.conv_id = c.conv_id AND a.id = c.id
)
SELECT conv_id, turn, 0::INT AS place, step, kind, id AS call_id, status, valid,
       CASE kind
         WHEN 'call' THEN '{' || CASE WHEN len(after) > 0 THEN '"after":' || to_json(list_sort(after)) || ',' ELSE '' END
           || '"arguments":' || CASE fault WHEN 0 THEN to_json({'question': text, 'words': words::VARCHAR})
                                           WHEN 1 THEN to_json({'question': text}) ELSE to_json({'question': text, 'words': words}) END
           || ',' || substr(to_json({'conv_id': conv_id, 'id': id, 'name': 'answer', 'role': 'assistant', 'status': status,
                                     'turn': turn, 'type': 'call', 'valid': valid})::VARCHAR, 2)
         WHEN 'result' THEN to_json({'content': text, 'conv_id': conv_id, 'id': id, 'role': 'tool',
           'status': status, 'turn': turn, 'type': 'result'})::VARCHAR
         ELSE to_json({'content': text, 'conv_id': conv_id, 'role': role, 'status': status, 'turn': turn, 'type': 'message'})::VARCHAR
       END AS json
FROM k
"""

OP13 = r"""
WITH words AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
), firsts AS (
  SELECT t, min(doc_id) AS first_id FROM words GROUP BY t
), label AS (
  SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS bad FROM labels GROUP BY doc_id
), rows AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(bad, 0) AS bad,
         map {'A': len(ws) < 50, 'B': 100 * len(list_distinct(ws)) < 65 * len(ws),
              'C': 100 * len(regexp_extract_all(t, '[A-Z]')) > 5 * length(t),
              'D': regexp_matches(t, '[#$%&*|]'), 'E': coalesce(doc_id > first_id, false)} AS fails
  FROM words JOIN firsts USING (t) LEFT JOIN label USING (doc_id)
), cells AS (
  SELECT part, fails, count(*) AS n, sum(good) AS good, sum(bad) AS bad FROM rows GROUP BY part, fails
), letters AS (
  SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l
), orders AS (
  SELECT a.l || b.l || c.l || d.l || e.l AS o
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.l, b.l, c.l, d.l, e.l])) = 5
), steps AS (
  SELECT o, k, o[k] AS l, string_split(o[1:k - 1], '') AS prior FROM (SELECT o, unnest([1, 2, 3, 4, 5]) AS k FROM orders)
), seen AS (
  SELECT part, o, k, l, n, good, bad, fails[l] AS f,
         len(list_filter(prior, lambda x: x <> '' AND fails[x])) > 0 AS gone,
         len(list_filter(['A', 'B', 'C', 'D', 'E'], lambda x: fails[x])) AS n_fails
  FROM cells, steps
), counted AS (
  SELECT part, o, k, l, coalesce(sum(n) FILTER (NOT gone AND NOT f), 0) AS kept,
         coalesce(sum(n) FILTER (f AND NOT gone), 0) AS removed, coalesce(sum(n) FILTER (f AND gone), 0) AS redundant,
         coalesce(sum(n) FILTER (f AND n_fails = 1), 0) AS unique_fails,
         coalesce(sum(good) FILTER (f AND NOT gone), 0) AS good_lost, coalesce(sum(bad) FILTER (f AND NOT gone), 0) AS toxic_lost
  FROM seen GROUP BY part, o, k, l
)
SELECT part, o AS filter_order, k::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
       unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
       (sum(removed) OVER (PARTITION BY part, l))::BIGINT AS shapley
FROM counted
"""

ORACLE_SQL = {"op1_quality_rules": OP1, "op3_substring_dedup": OP3, "op4_chat_tools": OP4, "op6_lm_score": OP6, "op13_filter_audit": OP13}
