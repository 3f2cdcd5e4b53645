"""SQL of the operators over tries, spellings and mixes."""

from __future__ import annotations


def crc32_sql(text: str) -> str:
    """The unsigned CRC-32 of a text's UTF-8 bytes."""
    codes = f"list_transform(range(1, octet_length(encode({text})) + 1), lambda i: ('0x' || hex(array_slice(encode({text}), i, i)))::bigint)"
    eight = "list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]::bigint[]), lambda v, z: xor(v >> 1, 3988292384 * (v & 1)))"
    return f"xor(list_reduce(list_prepend(4294967295::bigint, {codes}), lambda c, b: {eight}), 4294967295::bigint)"


# Byte windows that start at two places, as runs of starts; what lies between the runs is kept.
OP3_SQL = """
WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS b FROM documents),
w AS (SELECT doc_id, i, md5(array_slice(b, i, i + 399)) AS h FROM (SELECT doc_id, b, unnest(range(1, octet_length(b)::bigint - 398)) AS i FROM d)),
r AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY h) AS c FROM w) WHERE c > 1),
m AS (SELECT doc_id, i, coalesce(i > lag(i) OVER up + 400, true)::int AS fresh FROM r WINDOW up AS (PARTITION BY doc_id ORDER BY i)),
g AS (SELECT doc_id, min(i) AS a, max(i) + 399 AS z FROM (SELECT doc_id, i, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM m) GROUP BY doc_id, k),
e AS (SELECT doc_id, coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY a), 0) + 1 AS s, a - 1 AS t FROM g
      UNION ALL SELECT doc_id, max(z) + 1, NULL FROM g GROUP BY doc_id),
k AS (SELECT e.doc_id, string_agg(CASE WHEN s <= coalesce(t, octet_length(b)) THEN hex(array_slice(b, s, coalesce(t, octet_length(b)))) ELSE '' END, '' ORDER BY s) AS kept
      FROM e JOIN d USING (doc_id) GROUP BY e.doc_id),
n AS (SELECT doc_id, sum(z - a + 1) AS gone, count(*) AS spans FROM g GROUP BY doc_id)
SELECT d.doc_id, octet_length(b)::bigint AS n_bytes, coalesce(gone, 0)::bigint AS n_removed, coalesce(spans, 0)::bigint AS n_spans,
       CASE WHEN gone IS NULL THEN sha256(b) ELSE sha256(unhex(kept)) END AS kept_sha256
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN k USING (doc_id)
"""


# A node's subtree is found by the paths of its nodes' smallest members.
OP11_SQL = rf"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
k AS (SELECT conv_id, turn, sha256(octet_length(encode(role)) || ':' || role || ':' || text) AS name, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS w FROM t),
o AS (SELECT conv_id, name, w, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, name) AS p FROM k),
c AS (SELECT conv_id, {crc32_sql('conv_id::varchar')} % 4 AS h FROM (SELECT DISTINCT conv_id FROM t)),
r AS (SELECT c.conv_id, 0 AS part, p, name, w FROM c JOIN o ON o.conv_id = c.conv_id - c.conv_id % 20 AND p <= h
      UNION ALL SELECT c.conv_id, 1, p, name, w FROM c JOIN o ON o.conv_id = c.conv_id AND p > h),
q AS (SELECT conv_id, row_number() OVER up AS depth, string_agg(name, ',') OVER up AS path, w FROM r WINDOW up AS (PARTITION BY conv_id ORDER BY part, p)),
m AS (SELECT conv_id, depth, md5(path) AS prefix, w, coalesce(lag(md5(path)) OVER (PARTITION BY conv_id ORDER BY depth), '') AS parent FROM q
      UNION ALL SELECT conv_id, 0, '', 0, NULL FROM c),
l AS (SELECT *, max(depth) OVER (PARTITION BY conv_id) AS size FROM m),
n AS (SELECT depth, prefix, any_value(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(w) AS w,
             coalesce(string_agg(conv_id::varchar, ',' ORDER BY conv_id) FILTER (WHERE size = depth), '') AS ends FROM l GROUP BY depth, prefix),
ch AS (SELECT n.*, coalesce(x.n, 0) AS n_children FROM n LEFT JOIN (SELECT parent AS prefix, depth - 1 AS depth, count(*) AS n FROM n GROUP BY ALL) x USING (prefix, depth)),
s AS (SELECT m.depth, m.prefix, sum((ch.n_convs - 1) * ch.w) AS saved, count(*) FILTER (WHERE ch.n_children = 0) AS n_leaves
      FROM ch JOIN m ON m.conv_id = ch.conv_id AND m.depth <= ch.depth GROUP BY ALL)
SELECT ch.conv_id, ch.depth::bigint AS depth, up.conv_id AS parent_conv_id, ch.n_convs, ch.n_children, s.n_leaves, s.saved::bigint AS saved_tokens, sha256(ch.ends) AS ends_sha256
FROM ch JOIN s USING (depth, prefix) LEFT JOIN n up ON up.depth = ch.depth - 1 AND up.prefix = ch.parent
"""


# Near words by what is left when a code point is deleted; forms are followed by a recursive query.
OP12_SQL = rf"""
WITH RECURSIVE d AS (SELECT coalesce(doc_id::varchar, '') AS id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
runs AS (SELECT id, unnest(regexp_extract_all(text, '[a-z\x{{C0}}-\x{{FF}}]+')) AS run FROM d),
hashed AS (SELECT run, {crc32_sql("(id || ':' || run)")} AS h FROM runs WHERE length(run) >= 7),
words AS (SELECT CASE WHEN h % 31 = 0 THEN left(run, (h % length(run))::int) || substr(run, (h % length(run))::int + 2) ELSE run END AS word FROM hashed),
v AS MATERIALIZED (SELECT word, count(*) AS n FROM words WHERE length(word) >= 7 GROUP BY word HAVING count(*) >= 2),
cut AS MATERIALIZED (SELECT word, n, i, left(word, i::int - 1) || substr(word, i::int + 1) AS rest FROM (SELECT *, unnest(range(1, length(word) + 1)) AS i FROM v)),
pairs AS (SELECT a.word, b.word AS other, b.n AS other_n FROM cut a JOIN cut b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word AND length(a.word) = length(b.word)
          UNION SELECT c.word, v.word, v.n FROM cut c JOIN v ON v.word = c.rest UNION SELECT v.word, c.word, c.n FROM cut c JOIN v ON v.word = c.rest),
best AS (SELECT word, count(*) AS n_near, first(other ORDER BY other_n DESC, other) AS other, max(other_n) AS other_n FROM pairs GROUP BY word),
f AS MATERIALIZED (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 10 * n THEN other END AS form, CASE WHEN other_n >= 10 * n THEN other_n END AS form_n
      FROM v LEFT JOIN best USING (word)),
up AS (SELECT word, coalesce(form, word) AS root, form IS NOT NULL AS moved FROM f
       UNION ALL SELECT up.word, f.form, true FROM up JOIN f ON f.word = up.root AND f.form IS NOT NULL WHERE up.moved),
last AS (SELECT up.word, up.root FROM up JOIN f ON f.word = up.root WHERE f.form IS NULL)
SELECT f.word, f.form, last.root, f.n, f.n_near, f.form_n FROM f JOIN last USING (word)
"""


# Taken words are what lies in the first words of a source's shuffled stream that reach its target.
OP13_SQL = r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint AS size FROM documents),
s AS (SELECT *, CASE place % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w
      FROM (SELECT source, sum(size)::bigint AS source_size, row_number() OVER (ORDER BY source IS NULL, source) - 1 AS place FROM d GROUP BY source)),
o AS (SELECT *, 3 * source_size AS cap, sum(source_size) OVER ()::double AS total, sum(w) OVER ()::double AS ws,
             coalesce(sum(3 * source_size) OVER before, 0)::double AS caps, coalesce(sum(w) OVER before, 0)::double AS wcap, row_number() OVER (ORDER BY source_size::double / w, place) AS k
      FROM s WINDOW before AS (ORDER BY source_size::double / w, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
fix AS (SELECT total - caps AS lft, ws - wcap AS parts, k FROM o WHERE NOT (w::double * (total - caps) / (ws - wcap) > cap) ORDER BY k LIMIT 1),
g AS (SELECT source, source_size, CASE WHEN o.k < fix.k THEN cap::double ELSE w::double * lft / parts END AS target, cap FROM o, fix),
r AS (SELECT *, least(floor(target + 0.5)::bigint, cap) AS total FROM g),
e AS (SELECT *, total // greatest(source_size, 1) AS epochs, total - total // greatest(source_size, 1) * source_size AS rest FROM r),
b AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY md5(coalesce(doc_id::varchar, '')), doc_id NULLS FIRST, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::bigint AS begins FROM d)
SELECT b.doc_id, b.size, e.source_size, e.target, (epochs * size + greatest(0, least(begins + size, rest) - begins))::bigint AS taken
FROM b JOIN e ON b.source IS NOT DISTINCT FROM e.source
"""
