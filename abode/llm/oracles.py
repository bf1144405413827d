"""DuckDB SQL for the corpus queries that SQL can express on whole tables.

The others are held against brute force in tests: trees (op1), seeded Spark
hashes (op2, op8), joins and repeats that SQL finds too slowly (op4, op5), places of
matches (op7, op10), XXH64 (op13).
"""

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_BENCH_WORDS = r"regexp_extract_all(" + _LOWER.format("coalesce(text, '')") + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP3 = f"""
WITH item AS (SELECT CAST(item_id AS VARCHAR) AS item, {_BENCH_WORDS} AS w FROM benchmark),
strings AS (SELECT item, least(10, len(w)) AS n, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS s
  FROM (SELECT item, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM item WHERE len(w) > 0)),
doc AS (SELECT doc_id, {_BENCH_WORDS} AS w FROM documents),
windows AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS s
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM doc, (SELECT DISTINCT n FROM strings) WHERE len(w) >= n)),
hits AS (SELECT DISTINCT doc_id, n, i, item FROM windows JOIN strings USING (n, s)),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(item) AS n_items, string_agg(item, ',' ORDER BY item) AS listed FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)"""

_OWN = "<|im_end|><|im_start|>assistant ok"

OP6 = rf"""
WITH turns AS (SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{_OWN}' UNION ALL SELECT -1, 1, 'assistant', '{_OWN}'),
sized AS (SELECT *, length('<|im_start|>') + length(role) + 1 + length(text) + len(regexp_extract_all(text, '<\\*\|'))
  + length('<|im_end|>') + 1 AS chars FROM turns)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id"""

OP9 = f"""
WITH rules(verdict, h, p) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
  ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
parts AS (SELECT page_id, row_number() OVER () AS nth, {_LOWER.format("coalesce(regexp_extract(url, '(?s)://([^/?#]*)', 1), '')")} AS host,
  coalesce(regexp_extract(url, '(?s)://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
judged AS (SELECT nth, arg_max(h || p, length(h || p)) AS rule, arg_max(verdict, length(h || p)) AS verdict
  FROM parts JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY nth)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM parts LEFT JOIN judged USING (nth)"""

OP11 = r"""
WITH texts AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents),
words AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w, min(doc_id) OVER (PARTITION BY text) AS least FROM texts),
fails AS (SELECT doc_id, part, len(w) < 100 AS a, 100 * len(list_distinct(w)) < 80 * len(w) AS b,
  100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text) AS c, regexp_matches(text, '[#$%&*|]') AS d, coalesce(doc_id > least, false) AS e FROM words),
marks AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
docs AS (SELECT part, concat(CASE WHEN a THEN 'A' END, CASE WHEN b THEN 'B' END, CASE WHEN c THEN 'C' END, CASE WHEN d THEN 'D' END, CASE WHEN e THEN 'E' END) AS failed,
  coalesce(good, false) AS good, coalesce(toxic, false) AS toxic FROM fails LEFT JOIN marks USING (doc_id)),
sets AS (SELECT part, failed, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM docs GROUP BY part, failed),
letter(x) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
orders AS (SELECT p.x || q.x || r.x || s.x || t.x AS filter_order FROM letter p, letter q, letter r, letter s, letter t
  WHERE len(list_distinct([p.x, q.x, r.x, s.x, t.x])) = 5),
steps AS (SELECT filter_order, CAST(i AS INTEGER) AS step, filter_order[i] AS f, filter_order[1:i - 1] AS before FROM orders, range(1, 6) AS k(i)),
told AS (SELECT part, filter_order, step, f, n, good, toxic, contains(failed, f) AS here, length(translate(failed, before, '')) < length(failed) AS fell, failed = f AS alone
  FROM sets, steps),
counted AS (SELECT part, filter_order, step, f, sum(n) FILTER (NOT here AND NOT fell) AS kept, sum(n) FILTER (here AND NOT fell) AS removed, sum(n) FILTER (here AND fell) AS redundant,
  sum(n) FILTER (alone) AS unique_fails, sum(good) FILTER (here AND NOT fell) AS good_lost, sum(toxic) FILTER (here AND NOT fell) AS toxic_lost
  FROM told GROUP BY part, filter_order, step, f)
SELECT part, filter_order, step, CAST(coalesce(kept, 0) AS BIGINT) AS kept, CAST(coalesce(removed, 0) AS BIGINT) AS removed,
  CAST(coalesce(redundant, 0) AS BIGINT) AS redundant, CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails, CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost,
  CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost, CAST(sum(coalesce(removed, 0)) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM counted"""

_TERMS = r"regexp_extract_all(" + _LOWER.format("coalesce(text, '')") + r", '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

OP12 = f"""
WITH doc AS (SELECT doc_id, row_number() OVER () AS nth, {_TERMS} AS w FROM documents),
corpus AS (SELECT count(*) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS n_terms FROM doc WHERE len(w) > 0),
sized AS (SELECT nth, doc_id, 50 + (50 * CAST(len(w) AS BIGINT) * n_docs) // n_terms AS m FROM doc, corpus WHERE len(w) > 0),
item AS (SELECT item_id, row_number() OVER () AS item, list_distinct({_TERMS}) AS w FROM benchmark),
asked AS (SELECT item, unnest(w) AS term FROM item),
tf AS (SELECT nth, term, count(*) AS tf FROM (SELECT nth, unnest(w) AS term FROM doc) SEMI JOIN asked USING (term) GROUP BY nth, term),
weight AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS weight
  FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), corpus),
scored AS (SELECT item, doc_id, nth, CAST(sum(weight * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
  FROM asked JOIN weight USING (term) JOIN tf USING (term) JOIN sized USING (nth) GROUP BY item, doc_id, nth),
ranked AS (SELECT item, doc_id, score, CAST(row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked JOIN item USING (item) WHERE rank <= 50"""

ORACLE = {"op3_decontamination": OP3, "op6_chat_format": OP6, "op9_url_filter": OP9,
          "op11_filter_audit": OP11, "op12_lexical_search": OP12}
