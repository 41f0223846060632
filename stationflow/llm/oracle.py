"""DuckDB SQL for the queries that SQL can express on whole tables."""

from __future__ import annotations

OP2 = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
h AS (SELECT page_id, octet_length(encode(html)) AS payload_bytes, sha1(html) AS hash FROM p),
w AS (SELECT *, max(page_id) OVER (PARTITION BY hash) AS first FROM h),
bits AS (
  SELECT *, array_to_string(list_transform(string_split(hash, ''), lambda c: substr('0000000100100011010001010110011110001001101010111100110111101111',
    4 * (instr('0123456789abcdef', c) - 1) + 1, 4)), '') AS b
  FROM w)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes,
  array_to_string(list_transform(range(32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + 16 * substr(b, 5 * k + 1, 1)::INT + 8 * substr(b, 5 * k + 2, 1)::INT + 4 * substr(b, 5 * k + 3, 1)::INT
      + 2 * substr(b, 5 * k + 4, 1)::INT + substr(b, 5 * k + 5, 1)::INT, 1)), '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM bits
"""

OP7 = r"""
WITH s AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
    ('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT / 4503599627370496.0 AS u
  FROM documents),
per AS (SELECT source, sum(size)::BIGINT AS source_size FROM s GROUP BY source),
weighed AS (
  SELECT *, [3.0, 1.0, 2.0][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3]::DOUBLE AS weight,
    source_size * 2.0::DOUBLE AS cap FROM per),
filled AS (SELECT *, cap / weight AS fill, sum(source_size) OVER () * 1.5::DOUBLE AS total FROM weighed),
cumulated AS (
  SELECT *, sum(cap) OVER o AS capped, sum(weight) OVER () - sum(weight) OVER o AS rest FROM filled
  WINDOW o AS (ORDER BY fill RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
marked AS (SELECT *, capped + fill * rest <= total AS is_full FROM cumulated),
goals AS (
  SELECT source, source_size, CASE WHEN is_full THEN cap ELSE weight * (total - sum(CASE WHEN is_full THEN cap ELSE 0 END) OVER ())
    / sum(CASE WHEN is_full THEN 0 ELSE weight END) OVER () END AS target FROM marked),
shares AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS multiple FROM goals),
parts AS (SELECT *, floor(multiple)::BIGINT AS whole, multiple - floor(multiple) AS p FROM shares),
ranked AS (
  SELECT s.doc_id, s.size, g.source_size, g.target, g.whole, g.p, g.target - g.whole * g.source_size AS open,
    coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.u, s.doc_id, s.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead
  FROM s JOIN parts g ON s.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, target,
  ((whole + CASE WHEN p > 0 AND size > 0 AND ahead + size / 2.0 <= open THEN 1 ELSE 0 END) * size)::BIGINT AS taken
FROM ranked
"""

OP10 = r"""
WITH RECURSIVE v AS (
  SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (
  SELECT a.vec_id AS u, b.vec_id AS w FROM v a JOIN v b ON a.vec_id <> b.vec_id
  WHERE list_dot_product(a.e, b.e) / sqrt(list_dot_product(a.e, a.e)) / sqrt(list_dot_product(b.e, b.e)) >= 0.9),
reach(u, w) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.u, l.w FROM reach r JOIN l ON r.w = l.u),
c AS (SELECT u, min(w) AS component_id FROM reach GROUP BY u),
n AS (SELECT u, count(*) AS n_links FROM l GROUP BY u)
SELECT e.vec_id, coalesce(n.n_links, 0) AS n_links, c.component_id, e.vec_id = c.component_id AS kept
FROM embeddings e JOIN c ON e.vec_id = c.u LEFT JOIN n ON e.vec_id = n.u
"""

# CRC-32 of ASCII and Latin-1 letters, byte by byte; tab holds its 256 remainders.
CRC = r"""
bits AS (SELECT range AS k, range AS r, 0 AS step FROM range(256)),
tab AS (
  SELECT list(r ORDER BY k) AS t FROM (
    SELECT k, list_reduce(list_prepend(k, range(8)), lambda a, b: CASE WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END) AS r FROM bits))
"""


def crc32(text: str) -> str:
    """The CRC-32 of a text as DuckDB SQL; tab must be in the query."""
    codes = f"""flatten(list_transform(string_split({text}, ''), lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT]
      ELSE [192 + unicode(c)::BIGINT // 64, 128 + unicode(c)::BIGINT % 64] END))"""
    return f"""xor(list_reduce(list_prepend(4294967295, {codes}), lambda a, b: xor(a // 256, t[xor(a % 256, b) + 1])), 4294967295)"""


OP11 = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
w AS (
  SELECT *, CASE role WHEN 'assistant' THEN 10 WHEN 'user' THEN 16 WHEN 'system' THEN 18
      ELSE 24 + length(regexp_replace(role, '(<<SYS>>|<</SYS>>|<s>|</s>|\[/?(INST|ROLE|SAYS)\])', '_\1', 'g')) END
    + length(regexp_replace(text, '(<<SYS>>|<</SYS>>|<s>|</s>|\[/?(INST|ROLE|SAYS)\])', '_\1', 'g')) AS chars
  FROM c)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(chars)::BIGINT AS formatted_chars
FROM w GROUP BY conv_id
"""

OP12 = rf"""
WITH RECURSIVE {CRC},
runs AS (
  SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n FROM (
    SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS run FROM documents) GROUP BY ALL),
hashed AS (SELECT run, n, {crc32("coalesce(doc_id::VARCHAR, '') || ':' || run")} AS h FROM runs, tab WHERE length(run) >= 7),
typed AS (SELECT CASE WHEN h % 31 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM hashed),
words AS (SELECT word, sum(n)::BIGINT AS n FROM typed WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
cut AS (SELECT word, n, k, left(word, k) || substr(word, k + 2) AS rest FROM words, unnest(range(length(word))) u(k)),
links AS (
  SELECT DISTINCT a.word, b.word AS near, b.n AS near_n FROM cut a JOIN cut b ON a.rest = b.rest AND a.k = b.k AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM cut a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM cut a JOIN words b ON a.rest = b.word),
best AS (SELECT word, count(*) AS n_near, first(near ORDER BY near_n DESC, near) AS near, max(near_n) AS near_n FROM links GROUP BY word),
forms AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 10 * w.n THEN near END AS form,
    CASE WHEN near_n >= 10 * w.n THEN near_n END AS form_n FROM words w LEFT JOIN best USING (word)),
walk AS (SELECT word, form AS last FROM forms WHERE form IS NOT NULL UNION ALL SELECT w.word, f.form FROM walk w JOIN forms f ON w.last = f.word WHERE f.form IS NOT NULL),
ends AS (SELECT w.word, w.last AS root FROM walk w JOIN forms f ON w.last = f.word WHERE f.form IS NULL)
SELECT f.word, f.form, coalesce(e.root, f.word) AS root, f.n, f.n_near, f.form_n FROM forms f LEFT JOIN ends e USING (word)
"""

OP13 = rf"""
WITH {CRC},
turns AS (
  SELECT conv_id AS c, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS said,
    len(regexp_extract_all(coalesce(text, ''), '[^ 	-]+')) AS words, turn FROM conversations WHERE conv_id IS NOT NULL),
convs AS (SELECT c, list({{'said': said, 'words': words}} ORDER BY turn NULLS FIRST, said) AS turns FROM turns GROUP BY c),
taken AS (SELECT c, turns, c - c % 20 AS donor, ({crc32("c::VARCHAR")} % 4)::BIGINT AS h FROM convs, tab),
rebuilt AS (SELECT a.c, list_concat(coalesce(b.turns, [])[1:a.h], a.turns[a.h + 1:]) AS turns FROM taken a LEFT JOIN convs b ON a.donor = b.c),
members AS (
  SELECT c, d, len(turns) = d AS is_end, CASE WHEN d > 0 THEN turns[d].words ELSE 0 END AS words,
    array_to_string(list_transform(turns[1:d], lambda t: t.said), '') AS key FROM rebuilt, unnest(range(len(turns) + 1)) u(d)),
nodes AS (
  SELECT key, d, min(c) AS conv_id, count(*) AS n, any_value(words) AS words,
    coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (is_end), '') AS ended FROM members GROUP BY key, d),
counted AS (
  SELECT n.*, p.conv_id AS parent_conv_id, (SELECT count(*) FROM nodes k WHERE k.d = n.d + 1 AND left(k.key, 32 * n.d) = n.key) AS children
  FROM nodes n LEFT JOIN nodes p ON p.d = n.d - 1 AND p.key = left(n.key, 32 * (n.d - 1)::INT)),
sums AS (
  SELECT k AS d, left(key, 32 * k) AS key, sum(CASE WHEN children = 0 THEN 1 ELSE 0 END) AS leaves, sum((n - 1) * words) AS saved
  FROM counted, unnest(range(d + 1)) u(k) GROUP BY ALL)
SELECT conv_id, d AS depth, parent_conv_id, n AS n_convs, children AS n_children, leaves::BIGINT AS n_leaves, saved::BIGINT AS saved_tokens,
  sha256(ended) AS ends_sha256 FROM counted JOIN sums USING (d, key)
"""


def sql() -> dict[str, str]:
    return {"op2_warc": OP2, "op7_mixing": OP7, "op10_embedding_dedup": OP10, "op11_chat": OP11, "op12_spelling": OP12, "op13_trie": OP13}
