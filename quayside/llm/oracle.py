"""DuckDB SQL with the rows of the registered queries that SQL can express."""

from __future__ import annotations

from quayside.llm import quality_rules as q

_STOP = ", ".join("'" + f.replace("'", "''") + "'" for f in sorted({f for w in q.STOP_WORDS for f in (w, w[0].upper() + w[1:])}))

OP3 = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS body FROM documents),
t AS (SELECT doc_id, body, regexp_extract_all(body, '[^\x20\x09-\x0D]+') AS w,
        [x FOR x IN string_split(body, chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS lines FROM d),
g AS (SELECT doc_id, unnest(range(1, len(w) - 3)) AS i, w FROM t WHERE len(w) >= 5),
h AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i:i + 4]) AS c FROM g),
r AS (SELECT doc_id, count(DISTINCT i + j) AS n_repeat_words FROM h, range(5) AS s(j) WHERE c >= 2 GROUP BY doc_id),
s AS (SELECT t.doc_id, len(w) AS n_words, length(regexp_replace(body, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
        length(body) - length(regexp_replace(body, '[#*$%&|<>]', '', 'g')) AS n_symbols, len(lines) AS n_lines,
        len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
        len([x FOR x IN w IF x IN ({_STOP})]) AS n_stop_words,
        length(regexp_replace(body, '[^\p{{Lu}}]', '', 'g')) AS n_upper
      FROM t LEFT JOIN r ON r.doc_id = t.doc_id),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM s)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND word_chars / n_words BETWEEN 2 AND 15 AND n_symbols / n_words <= 0.1
    AND n_stop_words / n_words >= 0.02 AND n_dup_lines / n_lines <= 0.3 AND n_upper / word_chars <= 0.5 AS kept
FROM b
"""

OP7 = """
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (SELECT *, replace(replace(replace(text, '&', '&amp;'), '<', '&#60;'), '[', '&#91;') AS x,
        replace(replace(replace(replace(role, '&', '&amp;'), '<', '&#60;'), '[', '&#91;'), chr(10), '&#10;') AS r FROM c),
g AS (SELECT conv_id, count(*) AS n_turns,
        string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS every,
        coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '') AS loss,
        sum(length('<|im_start|>') + length(r) + 1 + length(x) + length('<|im_end|>') + 1) AS formatted_chars
      FROM e GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(every) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256,
  CAST(formatted_chars AS BIGINT) AS formatted_chars FROM g
"""

OP8 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
d AS (SELECT page_id, strlen(body) AS payload_bytes, sha1(body) AS payload_digest,
        CASE WHEN strlen(body) >= 1000 THEN max(page_id) OVER (PARTITION BY body) END AS first FROM p)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN first <> page_id THEN first END AS refers_to FROM d
"""


def _crc32(text: str) -> str:
    """The crc32 of an ASCII string, bit by bit."""
    zeros = ", ".join(["0"] * 8)
    bits = f"list_reduce([xor(a, b), {zeros}], lambda u, z: CASE WHEN u % 2 = 1 THEN xor(u >> 1, 3988292384) ELSE u >> 1 END)"
    codes = f"list_transform(string_split({text}, ''), lambda ch: CAST(ord(ch) AS BIGINT))"
    return f"xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], {codes}), lambda a, b: {bits}), 4294967295)"


# Cheapest repairs row by row: w holds the best (cost, audit) with which each state can be reached, st, sy, us and so on
# being 0 to 3; the audit names one path, so the least of equal cost is the least prefix.
OP11 = rf"""
WITH RECURSIVE o AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {_crc32("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS f FROM conversations),
d AS (SELECT conv_id, turn, CASE WHEN f = 4 THEN 'user' ELSE role END AS role, CASE WHEN f = 1 THEN ''
    WHEN f = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM o, range(2) AS s(k) WHERE f <> 0 AND (k = 0 OR f = 3)),
m AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM d),
n AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS seen FROM m),
r AS (SELECT *, lag(role[1] || '') OVER (PARTITION BY conv_id ORDER BY i) || role[1] AS pair,
    CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'b' WHEN seen > 1 THEN 'd'
         WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 't' ELSE '' END AS fault FROM n),
c AS (SELECT conv_id, count(*) FILTER (WHERE fault = 'b') AS blank, count(*) FILTER (WHERE fault = 'd') AS duplicate,
    count(*) FILTER (WHERE fault = 't') AS truncated, count(*) FILTER (WHERE pair NOT IN ('su', 'ua', 'au')) AS illegal,
    coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) AS rows FROM r GROUP BY conv_id),
w(conv_id, i, q, cost, audit, said) AS (
  SELECT DISTINCT conv_id, CAST(0 AS BIGINT), 0, CAST(0 AS BIGINT), '', CAST([] AS VARCHAR[]) FROM o
  UNION ALL
  (WITH one AS (SELECT * FROM w UNION ALL
      SELECT conv_id, i, CASE q WHEN 2 THEN 3 ELSE 2 END, cost + 2, audit || 'I',
        list_append(said, CASE q WHEN 2 THEN 'assistant:' ELSE 'user:' END) FROM w),
    two AS (SELECT * FROM one UNION ALL
      SELECT conv_id, i, CASE q WHEN 2 THEN 3 ELSE 2 END, cost + 2, audit || 'I',
        list_append(said, CASE q WHEN 2 THEN 'assistant:' ELSE 'user:' END) FROM one),
    moved AS (
      SELECT t.conv_id, r.i, q, cost + 3 AS cost, audit || 'D' AS audit, said
        FROM two t JOIN r ON r.conv_id IS NOT DISTINCT FROM t.conv_id AND r.i = t.i + 1
      UNION ALL
      SELECT t.conv_id, r.i, CASE role[1] WHEN 's' THEN 1 WHEN 'u' THEN 2 ELSE 3 END, cost + CAST(fault = 't' AS BIGINT),
        audit || 'K', list_append(said, role || ':' || text)
        FROM two t JOIN r ON r.conv_id IS NOT DISTINCT FROM t.conv_id AND r.i = t.i + 1 AND fault NOT IN ('b', 'd')
          AND (role[1] = 's' AND q = 0 OR role[1] = 'u' AND q <> 2 OR role[1] = 'a' AND q = 2)
      UNION ALL
      SELECT t.conv_id, r.i, CASE q WHEN 2 THEN 3 ELSE 2 END, cost + 2 + CAST(fault = 't' AS BIGINT), audit || 'R',
        list_append(said, CASE q WHEN 2 THEN 'assistant:' ELSE 'user:' END || text)
        FROM two t JOIN r ON r.conv_id IS NOT DISTINCT FROM t.conv_id AND r.i = t.i + 1 AND fault NOT IN ('b', 'd')),
    best AS (SELECT *, row_number() OVER (PARTITION BY conv_id, q ORDER BY cost, audit) AS place FROM moved)
  SELECT conv_id, i, q, cost, audit, said FROM best WHERE place = 1)),
e AS (SELECT w.* FROM w LEFT JOIN c ON c.conv_id IS NOT DISTINCT FROM w.conv_id WHERE i = coalesce(rows, 0)),
f AS (SELECT conv_id, cost, audit, said FROM e WHERE q IN (0, 3) UNION ALL
  SELECT conv_id, cost + 2, audit || 'I', list_append(said, 'assistant:') FROM e WHERE q = 2 UNION ALL
  SELECT conv_id, cost + 4, audit || 'II', list_concat(said, ['user:', 'assistant:']) FROM e WHERE q = 1),
g AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY cost, audit) AS place FROM f)
SELECT g.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, cost, audit,
  sha256(array_to_string(said, chr(10))) AS repaired_sha256
FROM g LEFT JOIN c ON c.conv_id IS NOT DISTINCT FROM g.conv_id WHERE place = 1
"""

OP12 = f"""
WITH t AS (SELECT conv_id AS c, {{'r': coalesce(role, ''), 'x': coalesce(text, '')}} AS e,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS i
  FROM conversations WHERE conv_id IS NOT NULL),
s AS (SELECT c, list(e ORDER BY i) AS l FROM t GROUP BY c),
h AS (SELECT c, l, {_crc32("CAST(c AS VARCHAR)")} % 9 AS h FROM s),
b AS (SELECT h.c, list_concat(coalesce(s.l[1:h.h], []), h.l[h.h + 1:]) AS l FROM h LEFT JOIN s ON s.c = h.c - h.c % 5),
p AS (SELECT c, unnest(range(0, len(l) + 1)) AS d, l FROM b),
n AS (SELECT l[1:d] AS k, d, min(c) AS conv_id, count(*) AS n_convs,
    coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE d = len(l)), '') AS ends FROM p GROUP BY 1, 2),
v AS (SELECT k, d, (n_convs - 1) * CASE WHEN d = 0 THEN 0 ELSE strlen(k[d].x) END AS saved FROM n),
m AS (SELECT k[1:d - 1] AS k, count(*) AS n_children FROM n WHERE d > 0 GROUP BY 1),
u AS (SELECT v.*, coalesce(n_children, 0) = 0 AS leaf, unnest(range(0, v.d + 1)) AS j FROM v LEFT JOIN m ON m.k = v.k),
z AS (SELECT k[1:j] AS k, sum(saved) AS saved_tokens, count(*) FILTER (WHERE leaf) AS n_leaves FROM u GROUP BY 1)
SELECT n.conv_id, n.d AS depth, q.conv_id AS parent_conv_id, n.n_convs, coalesce(m.n_children, 0) AS n_children, z.n_leaves,
  CAST(z.saved_tokens AS BIGINT) AS saved_tokens, sha256(n.ends) AS ends_sha256
FROM n JOIN z ON z.k = n.k LEFT JOIN m ON m.k = n.k LEFT JOIN n AS q ON n.d > 0 AND q.k = n.k[1:n.d - 1]
"""

ORACLE = {"op3_quality_rules": OP3, "op7_chat_format": OP7, "op8_warc": OP8, "op11_conversation_repair": OP11,
          "op12_prefix_trie": OP12}
