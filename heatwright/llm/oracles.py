"""Plain SQL (DuckDB) for the queries that SQL can express: every rule on every row, every pair by its words."""

from __future__ import annotations

OP1 = r"""
WITH cut AS (
  SELECT page_id, url,
         CASE WHEN url IS NULL OR strpos(url, '://') = 0 THEN '' ELSE substr(url, strpos(url, '://') + 3) END AS rest
  FROM pages
), parts AS (
  SELECT page_id, coalesce(url, '') AS url,
         translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path
  FROM cut
), rules(verdict, h, p) AS (
  VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')
), sites AS (
  SELECT page_id, url, host, path,
         (SELECT max_by({'rule': h || p, 'verdict': rules.verdict}, length(h || p)) FROM rules
          WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)) AS site
  FROM parts
), patterns AS (
  SELECT *,
         list_min(list_filter([
           CASE WHEN regexp_matches(url, '[?&]utm_source=feed(?:[&#]|$)') THEN 'feed copies' END,
           CASE WHEN regexp_matches(url, '[?&]page=[0-9]+&ref=') THEN 'listing pages' END,
           CASE WHEN regexp_matches(url, '/login(?:[/?#]|$)') THEN 'log-in pages' END,
           CASE WHEN regexp_matches(url, '/cart(?:[/?#]|$)') THEN 'shop carts' END,
           CASE WHEN regexp_matches(url, '[?&]print=1(?:[&#]|$)') THEN 'print versions' END
         ], lambda x: x IS NOT NULL)) AS hit
  FROM sites
)
SELECT page_id, host, path, site.rule AS rule,
       coalesce(site.verdict, CASE WHEN hit IS NULL THEN 'allow' ELSE 'block' END) AS verdict,
       CASE WHEN site IS NULL THEN hit END AS pattern_rule
FROM patterns
"""


def _coverage(size: int) -> str:
    """Words inside windows of ``size`` words found twice: all of them, and without first occurrences."""
    return rf"""
windows{size} AS (
  SELECT doc_id, pos, row_number() OVER (PARTITION BY doc_id, gram ORDER BY pos) AS nth,
         count(*) OVER (PARTITION BY doc_id, gram) AS n
  FROM (
    SELECT doc_id, pos, string_agg(word, ' ') OVER w AS gram, count(*) OVER w AS size
    FROM words WINDOW w AS (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND {size - 1} FOLLOWING)
  ) WHERE size = {size}
), covered{size} AS (
  SELECT words.doc_id, words.pos, any_value(chars) AS chars, bool_or(nth > 1) AS again
  FROM words JOIN windows{size} AS w
    ON w.doc_id = words.doc_id AND w.n > 1 AND words.pos BETWEEN w.pos AND w.pos + {size - 1}
  GROUP BY ALL
), dup{size} AS (
  SELECT doc_id, count(*) AS n, sum(CASE WHEN again THEN chars ELSE 0 END) AS chars FROM covered{size} GROUP BY doc_id
)"""


OP2 = (
    r"""
WITH words AS (
  SELECT doc_id, unnest(found) AS word, unnest(range(len(found))) AS pos, length(unnest(found)) AS chars
  FROM (SELECT doc_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS found FROM documents)
), sums AS (
  SELECT doc_id, count(*) AS n_words, sum(chars) AS word_chars FROM words GROUP BY doc_id
), lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS pos
  FROM documents
), repeats AS (
  SELECT doc_id, length(regexp_replace(line, '[\x20\x09-\x0D]+', '', 'g')) AS chars,
         row_number() OVER (PARTITION BY doc_id, line ORDER BY pos) AS nth
  FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
), dup_lines AS (
  SELECT doc_id, count(*) AS n, sum(chars) AS chars FROM repeats WHERE nth > 1 GROUP BY doc_id
),"""
    + ",".join(_coverage(n) for n in (4, 6, 8, 10))
    + r""", measured AS (
  SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars,
         coalesce(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')), 0) AS n_symbols,
         coalesce(l.n, 0) AS n_dup_lines, coalesce(dup8.n, 0) AS n_repeat_words,
         coalesce(l.chars, 0) AS dup_line_chars, coalesce(dup4.chars, 0) AS dup_4gram_chars,
         coalesce(dup6.chars, 0) AS dup_6gram_chars, coalesce(dup10.chars, 0) AS dup_10gram_chars
  FROM documents d LEFT JOIN sums USING (doc_id) LEFT JOIN dup_lines l USING (doc_id)
       LEFT JOIN dup4 USING (doc_id) LEFT JOIN dup6 USING (doc_id)
       LEFT JOIN dup8 USING (doc_id) LEFT JOIN dup10 USING (doc_id)
)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words,
       n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words)
         AND 100 * dup_4gram_chars <= 25 * word_chars AND 100 * dup_6gram_chars <= 20 * word_chars
         AND 100 * dup_10gram_chars <= 15 * word_chars AND 100 * dup_line_chars <= 30 * word_chars
         AND 100 * n_symbols <= 20 * n_words AS kept,
       dup_line_chars::BIGINT AS dup_line_chars, dup_4gram_chars::BIGINT AS dup_4gram_chars,
       dup_6gram_chars::BIGINT AS dup_6gram_chars, dup_10gram_chars::BIGINT AS dup_10gram_chars
FROM measured
"""
)

_ESCAPED = r"replace(replace(replace(coalesce({0}, ''), '\', '\b'), '#', '\h'), '<', '\l')"

OP9 = rf"""
WITH every AS (
  SELECT conv_id, turn, role, text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text,
         length({_ESCAPED.format("text")}) + length(replace({_ESCAPED.format("role")}, ':', '\c'))
           + length('### ') + length(': ') + length('</turn>') + 1 AS size
  FROM every
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
       sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn, role, text)) AS loss_sha256,
       sum(size)::BIGINT AS formatted_chars
FROM turns GROUP BY conv_id
"""

OP10 = r"""
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM worded WHERE len(w) > 0)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n
  FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM shared JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
  WHERE 100 * shared.n >= 85 * (p.n + q.n - shared.n)
), ends AS (
  SELECT a, b FROM links UNION SELECT b, a FROM links
), reached(a, b) AS (
  SELECT a, b FROM ends UNION SELECT r.a, l.b FROM reached r JOIN ends l ON r.b = l.a
)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles,
       least(doc_id, coalesce(low, doc_id)) AS component_id, least(doc_id, coalesce(low, doc_id)) = doc_id AS kept
FROM documents LEFT JOIN sizes USING (doc_id)
     LEFT JOIN (SELECT a AS doc_id, min(b) AS low FROM reached GROUP BY a) USING (doc_id)
"""

OP11 = r"""
WITH RECURSIVE worded AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), known AS (
  SELECT doc_id, coalesce(max((quality = 1)::INT), 0) AS good, coalesce(max((toxic = 1)::INT), 0) AS toxic
  FROM labels GROUP BY doc_id
), judged AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
         list_filter([
           CASE WHEN len(w) < 200 THEN 'A' END,
           CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' END,
           CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text) THEN 'C' END,
           CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' END,
           CASE WHEN d.doc_id > min(d.doc_id) OVER (PARTITION BY text) THEN 'E' END
         ], lambda x: x IS NOT NULL) AS fails
  FROM worded d LEFT JOIN known k ON k.doc_id = d.doc_id
), letters AS (
  SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l
), orders(o) AS (
  SELECT '' UNION ALL SELECT o || l FROM orders JOIN letters ON strpos(o, l) = 0 WHERE length(o) < 5
), steps AS (
  SELECT o, s::INT AS s, substr(o, s, 1) AS f, string_split(substr(o, 1, s - 1), '') AS before
  FROM (SELECT o FROM orders WHERE length(o) = 5), range(1, 6) AS t(s)
), counted AS (
  SELECT part, good, toxic, fails, count(*) AS n FROM judged GROUP BY ALL
), audited AS (
  SELECT part, o, s, f,
         sum(n) FILTER (NOT list_has_any(fails, before) AND NOT list_contains(fails, f)) AS kept,
         sum(n) FILTER (NOT list_has_any(fails, before) AND list_contains(fails, f)) AS removed,
         sum(n) FILTER (list_has_any(fails, before) AND list_contains(fails, f)) AS redundant,
         sum(n) FILTER (fails = [f]) AS unique_fails,
         sum(n * good) FILTER (NOT list_has_any(fails, before) AND list_contains(fails, f)) AS good_lost,
         sum(n * toxic) FILTER (NOT list_has_any(fails, before) AND list_contains(fails, f)) AS toxic_lost
  FROM counted, steps GROUP BY ALL
)
SELECT part, o AS filter_order, s AS step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed,
       coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails,
       coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
       (sum(coalesce(removed, 0)) OVER (PARTITION BY part, f))::BIGINT AS shapley
FROM audited
"""

OP12 = r"""
WITH RECURSIVE own AS (
  SELECT conv_id, {'role': coalesce(role, ''), 'text': coalesce(text, '')} AS t,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL
), listed AS (
  SELECT conv_id, list(t ORDER BY pos) AS turns FROM own GROUP BY conv_id
), bits(conv_id, k, crc) AS (
  SELECT conv_id, 0, 4294967295 FROM listed
  UNION ALL
  SELECT conv_id, k + 1, CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END
  FROM (SELECT conv_id, k,
               CASE WHEN k % 8 = 0 THEN xor(crc, ord(substr(conv_id::VARCHAR, k // 8 + 1, 1))::BIGINT) ELSE crc END AS x
        FROM bits WHERE k < 8 * length(conv_id::VARCHAR))
), heads AS (
  SELECT conv_id, xor(crc, 4294967295) % 6 AS h FROM bits WHERE k = 8 * length(conv_id::VARCHAR)
), rebuilt AS (
  SELECT l.conv_id AS c, list_concat(coalesce(b.turns, [])[1:h], l.turns[h + 1:]) AS turns
  FROM listed l JOIN heads USING (conv_id) LEFT JOIN listed b ON b.conv_id = l.conv_id - l.conv_id % 100
), prefixes AS (
  SELECT c, turns, d, turns[1:d] AS p FROM rebuilt, unnest(range(0, len(turns) + 1)) AS u(d)
), nodes AS (
  SELECT p, d, min(c) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (len(turns) = d), '')) AS ends_sha256,
         (count(*) - 1) * CASE WHEN d = 0 THEN 0 ELSE length(p[d].text) END AS saved
  FROM prefixes GROUP BY p, d
), family AS (
  SELECT a.p, a.d, count(*) FILTER (b.d = a.d + 1) AS n_children, sum(b.saved) AS saved_tokens,
         count(*) FILTER (NOT EXISTS (SELECT 1 FROM nodes x WHERE x.d = b.d + 1 AND x.p[1:b.d] = b.p)) AS n_leaves
  FROM nodes a JOIN nodes b ON b.p[1:a.d] = a.p AND b.d >= a.d GROUP BY a.p, a.d
)
SELECT n.conv_id, n.d AS depth, u.conv_id AS parent_conv_id, n.n_convs, f.n_children, f.n_leaves,
       f.saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM nodes n JOIN family f ON f.p = n.p AND f.d = n.d LEFT JOIN nodes u ON u.d = n.d - 1 AND u.p = n.p[1:n.d - 1]
"""

ORACLES = {
    "op1_url_filter": OP1,
    "op2_quality_rules": OP2,
    "op9_chat_format": OP9,
    "op10_near_duplicates": OP10,
    "op11_filter_audit": OP11,
    "op12_conversation_trie": OP12,
}
