"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from aerolag.llm import rules

SQL: dict[str, str] = {}

# Quality rules: (doc_id, source, text) come from the table that {documents} names.
RULES = rf"""
d AS (SELECT doc_id, source, coalesce(text, '') AS t FROM {{documents}}),
w AS (
  SELECT doc_id, source, t,
    list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM d
),
windows AS (
  SELECT doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS window3
  FROM (SELECT doc_id, words, unnest(generate_series(1, len(words) - 2)) AS i FROM w)
),
twice AS (
  SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, window3) > 1
),
repeated AS (
  SELECT doc_id, count(DISTINCT place) AS n_repeat_words
  FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS place FROM twice) GROUP BY doc_id
),
said AS (
  SELECT doc_id, source, t, len(words) AS n_words,
    length(array_to_string(words, '')) AS word_chars,
    length(t) - length(translate(t, '{rules.SYMBOLS}', '')) AS n_symbols,
    len(lines) - len(list_distinct(lines)) AS n_dup_lines,
    coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM w LEFT JOIN repeated USING (doc_id)
),
norm AS (
  SELECT doc_id, source, t, line,
    regexp_replace(trim(regexp_replace(lower(line), '[\x20\x09-\x0D]+', ' ', 'g')), '[0-9]+', '0', 'g') AS norm,
    len(list_filter(string_split_regex(line, '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS words
  FROM (SELECT doc_id, source, t, unnest(lines) AS line FROM w)
),
hosts AS (SELECT source, count(DISTINCT t) AS host_docs FROM d GROUP BY source),
frequent AS (
  SELECT n.source, norm
  FROM norm n JOIN hosts h ON n.source IS NOT DISTINCT FROM h.source
  GROUP BY n.source, norm
  HAVING count(DISTINCT t) > {rules.LINE_DOCS}
    AND count(DISTINCT t) * 100 > any_value(host_docs) * {rules.LINE_PERCENT}
),
gone AS (
  SELECT doc_id, sum(words)::BIGINT AS words_gone
  FROM norm n JOIN frequent f ON n.norm = f.norm AND n.source IS NOT DISTINCT FROM f.source
  GROUP BY doc_id
),
counts AS (
  SELECT *, n_words - coalesce(words_gone, 0) AS n_words_left,
    n_words < {rules.MIN_WORDS} OR 100 * n_repeat_words > {rules.MAX_REPEAT_PERCENT} * n_words AS base_failed
  FROM said LEFT JOIN gone USING (doc_id)
),
judged AS (
  SELECT *, NOT base_failed AND n_words_left >= {rules.MIN_WORDS}
      AND 100 * n_words_left >= {rules.MIN_LEFT_PERCENT} * n_words AS kept
  FROM counts
)
"""

SQL["op7_line_frequency_rules"] = f"""
WITH {RULES.format(documents='documents')}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, n_words_left
FROM judged
"""

# Near-duplicates compare all pairs that share a shingle; components are found by recursion.
SQL["op9_odd_sketch_near_dedup"] = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
  FROM documents
),
sets AS (
  SELECT doc_id, list_distinct(CASE len(words) WHEN 0 THEN [] WHEN 1 THEN words
    ELSE list_transform(generate_series(1, len(words) - 1), lambda i: words[i] || ' ' || words[i + 1]) END) AS held
  FROM w
),
classes AS (
  SELECT min(doc_id) AS id, any_value(len(held)) AS n, list_sort(held) AS held FROM sets
  WHERE len(held) > 0 GROUP BY list_sort(held)
),
members AS (SELECT doc_id, id FROM sets JOIN classes ON list_sort(sets.held) = classes.held),
shingles AS MATERIALIZED (SELECT id, n, hash(unnest(held)) AS shingle FROM classes),
rare AS MATERIALIZED (
  SELECT id, n, shingle, row_number() OVER (PARTITION BY id ORDER BY held_by, shingle) AS place
  FROM shingles JOIN (SELECT shingle, count(*) AS held_by FROM shingles GROUP BY shingle) USING (shingle)
),
-- Sets as similar as 0.8 share one of the first n - ceil(0.8 n) + 1 shingles, the rarest first.
candidates AS MATERIALIZED (
  SELECT DISTINCT x.id AS a, y.id AS b FROM rare x JOIN rare y USING (shingle)
  WHERE x.id < y.id AND x.place <= x.n - (8 * x.n + 9) // 10 + 1 AND y.place <= y.n - (8 * y.n + 9) // 10 + 1
    AND 10 * x.n >= 8 * y.n AND 10 * y.n >= 8 * x.n
),
links AS MATERIALIZED (
  SELECT a, b FROM candidates c JOIN classes x ON c.a = x.id JOIN classes y ON c.b = y.id
  WHERE 100 * len(list_intersect(x.held, y.held)) >= 80 * (x.n + y.n - len(list_intersect(x.held, y.held)))
),
both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach(id, seen) AS (
  SELECT id, id FROM classes
  UNION
  SELECT r.id, e.b FROM reach r JOIN both_ways e ON r.seen = e.a
),
component AS (SELECT id, min(seen) AS component_id FROM reach GROUP BY id)
SELECT s.doc_id, len(held)::BIGINT AS n_shingles,
  coalesce(component_id, s.doc_id) AS component_id, coalesce(component_id, s.doc_id) = s.doc_id AS kept
FROM sets s LEFT JOIN members m ON s.doc_id = m.doc_id LEFT JOIN component c ON m.id = c.id
"""

SQL["op10_winnowing_decontamination"] = r"""
WITH said AS (
  SELECT doc_id AS id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents
),
asked AS (
  SELECT item_id, words, least(10, len(words)) AS width FROM (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark)
  WHERE len(words) > 0
),
windows AS MATERIALIZED (
  SELECT DISTINCT item_id, width, array_to_string(words[i : i + width - 1], ' ') AS span
  FROM (SELECT *, unnest(generate_series(1, len(words) - width + 1)) AS i FROM asked)
),
spans AS (
  SELECT id, i, width, array_to_string(words[i : i + width - 1], ' ') AS span
  FROM (SELECT id, words, width, unnest(generate_series(1, len(words) - width + 1)) AS i
        FROM said, (SELECT DISTINCT width FROM windows))
),
hits AS MATERIALIZED (SELECT id, i, width, item_id FROM spans JOIN windows USING (width, span)),
hit_words AS (
  SELECT id, count(DISTINCT place) AS n_hit
  FROM (SELECT id, unnest(generate_series(i, i + width - 1)) AS place FROM hits) GROUP BY id
),
items AS (
  SELECT id, count(DISTINCT item_id) AS n_items,
    sha256(string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR)) AS items_sha256
  FROM hits GROUP BY id
)
SELECT id AS doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM said LEFT JOIN hit_words USING (id) LEFT JOIN items USING (id)
"""

SQL["op5_warc_index"] = r"""
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
  FROM pages
),
f AS (SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN first <> page_id THEN first END AS refers_to
FROM p LEFT JOIN f USING (payload_digest)
"""


# The checksum byte by byte: a table of 256 steps of eight bits, made by its rule.
CRC_TABLE = """crc_table AS MATERIALIZED (
  SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x:
    CASE WHEN c % 2 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) ORDER BY i) AS steps
  FROM (SELECT unnest(range(256)) AS i))"""


def crc32(text: str) -> str:
    """The checksum of a text's UTF-8 bytes, over rows that have the column ``steps``."""
    digits = f"hex(encode({text}))"
    byte = f"CAST('0x' || substr({digits}, 2 * i + 1, 2) AS BIGINT)"
    bytes_ = f"list_transform(range(0, length({digits}) // 2), lambda i: {byte})"
    step = "xor(c >> 8, steps[CAST((xor(c, b) & 255) + 1 AS INTEGER)])"
    return f"xor(list_reduce([4294967295] || {bytes_}, lambda c, b: {step}), 4294967295)"


SQL["op11_parentheses_trie"] = f"""
WITH {CRC_TABLE},
turns AS MATERIALIZED (
  SELECT conv_id AS c, said, strlen(t) AS size,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, said) AS p
  FROM (SELECT conv_id, turn, coalesce(text, '') AS t,
          substr(sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')), 1, 32) AS said
        FROM conversations WHERE conv_id IS NOT NULL)),
convs AS MATERIALIZED (
  SELECT c, {crc32('CAST(c AS VARCHAR)')} % 9 AS h FROM (SELECT DISTINCT c FROM turns), crc_table),
taken AS (
  SELECT v.c, 0 AS side, p, said, size FROM convs v JOIN turns t ON t.c = v.c - v.c % 5 AND p <= h
  UNION ALL
  SELECT v.c, 1, p, said, size FROM convs v JOIN turns t ON t.c = v.c AND p > h),
sequences AS (
  SELECT c, coalesce(list(said ORDER BY side, p) FILTER (said IS NOT NULL), []) AS path,
    coalesce(list(size ORDER BY side, p) FILTER (said IS NOT NULL), []) AS sizes
  FROM convs LEFT JOIN taken USING (c) GROUP BY c),
beginnings AS (
  SELECT c, d, array_to_string(path[:d], '') AS node, d = len(path) AS ends_here,
    CASE WHEN d > 0 THEN sizes[d] ELSE 0 END AS size
  FROM (SELECT *, unnest(range(len(path) + 1)) AS d FROM sequences)),
nodes AS MATERIALIZED (
  SELECT node, d, min(c) AS low, count(*) AS n, any_value(size) AS size,
    sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (ends_here), '')) AS ends
  FROM beginnings GROUP BY node, d),
children AS MATERIALIZED (
  SELECT substr(node, 1, 32 * (d - 1)) AS node, count(*) AS n FROM nodes WHERE d > 0 GROUP BY 1),
under AS (
  SELECT substr(s.node, 1, 32 * k) AS node, count(*) FILTER (k_n IS NULL) AS leaves, sum((n - 1) * size) AS saved
  FROM (SELECT x.*, y.n AS k_n, unnest(range(d + 1)) AS k FROM nodes x LEFT JOIN children y USING (node)) s
  GROUP BY 1)
SELECT x.low AS conv_id, x.d AS depth, above.low AS parent_conv_id, x.n AS n_convs,
  coalesce(y.n, 0) AS n_children, leaves AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, x.ends AS ends_sha256
FROM nodes x LEFT JOIN children y USING (node) JOIN under USING (node)
LEFT JOIN nodes above ON x.d > 0 AND above.node = substr(x.node, 1, 32 * (x.d - 1))"""

SQL["op12_trie_node_pairs"] = f"""
WITH RECURSIVE {CRC_TABLE},
runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id,
    unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[a-z\\x{{C0}}-\\x{{FF}}]+')) AS run FROM documents),
drawn AS (
  SELECT run, n, {crc32("id || ':' || run")} AS h
  FROM (SELECT id, run, count(*) AS n FROM runs WHERE length(run) >= 6 GROUP BY ALL), crc_table),
words AS MATERIALIZED (
  SELECT word, CAST(sum(n) AS BIGINT) AS n
  FROM (SELECT n, CASE WHEN h % 199 = 0
          THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM drawn)
  GROUP BY word HAVING sum(n) >= 5 AND length(word) >= 6),
skips AS MATERIALIZED (
  SELECT word, substr(word, 1, i) AS front, substr(word, i + 2) AS back
  FROM (SELECT word, unnest(range(length(word))) AS i FROM words)),
near AS MATERIALIZED (
  SELECT a.word, b.word AS other FROM skips a JOIN skips b USING (front, back) WHERE a.word <> b.word
  UNION SELECT word, front || back FROM skips WHERE front || back IN (SELECT word FROM words)
  UNION SELECT front || back, word FROM skips WHERE front || back IN (SELECT word FROM words)),
judged AS MATERIALIZED (
  SELECT w.word, any_value(w.n) AS n, count(o.word) AS n_near, max(o.n) AS best_n,
    min_by(o.word, (-o.n, encode(o.word))) FILTER (o.word IS NOT NULL) AS best
  FROM words w LEFT JOIN near USING (word) LEFT JOIN words o ON o.word = near.other GROUP BY w.word),
formed AS MATERIALIZED (
  SELECT word, n, n_near, CASE WHEN best_n >= 5 * n THEN best END AS form,
    CASE WHEN best_n >= 5 * n THEN best_n END AS form_n FROM judged),
chains AS (
  SELECT word, word AS root, form AS next FROM formed
  UNION ALL SELECT c.word, c.next, f.form FROM chains c JOIN formed f ON f.word = c.next)
SELECT word, form, root, n, n_near, form_n FROM formed
JOIN (SELECT word, root FROM chains WHERE next IS NULL) USING (word)"""

# Conversations that begin a longer one go, by comparing lists of turns themselves.
SQL["op2_chat_snapshots"] = """
WITH turns AS (
  SELECT DISTINCT conv_id, turn, coalesce(role, 'user') AS role, coalesce(text, '') AS text FROM conversations),
whole AS MATERIALIZED (
  SELECT conv_id, list({'role': role, 'text': text} ORDER BY turn NULLS FIRST, role, text) AS said
  FROM turns GROUP BY conv_id),
beginnings AS (
  SELECT DISTINCT said[:i] AS said FROM (SELECT said, unnest(range(1, len(said))) AS i FROM whole)),
kept AS (SELECT min(conv_id) AS conv_id, said FROM whole ANTI JOIN beginnings USING (said) GROUP BY said)
SELECT conv_id, len(said) AS n_turns,
  array_to_string(list_transform(said, lambda s:
    '<|im_start|>' || s.role || chr(10) || s.text || '<|im_end|>' || chr(10)), '') AS text
FROM kept"""
