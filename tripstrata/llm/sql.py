"""SQL (DuckDB) for the operators that it can express, written from their contracts alone."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def crc32(text: str) -> str:
    """The checksum of an expression's UTF-8 bytes: each byte is taken in and then shifted out bit by bit."""
    steps = f"""flatten(list_transform(range(strlen({text})), lambda i:
      [CAST('0x' || substr(hex(encode({text})), 2 * i + 1, 2) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))"""
    return f"""xor(list_reduce(list_concat([4294967295::BIGINT], {steps}), lambda c, x:
      CASE WHEN x >= 0 THEN xor(c, x) WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END),
      4294967295::BIGINT)"""


def similar(width: int, percent: int, columns: str) -> str:
    """Components of documents whose sets of ``width`` words are similar enough."""
    return rf"""
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
shingled AS (
  SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {width} THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - {width} + 2), lambda i: array_to_string(w[i : i + {width - 1}], ' '))
    END) AS shingle FROM worded),
elements AS (SELECT DISTINCT doc_id, shingle FROM shingled),
sizes AS (SELECT doc_id, count(*) AS n FROM elements GROUP BY ALL),
pairs AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common
  FROM elements a JOIN elements b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT x, y FROM pairs JOIN sizes s ON s.doc_id = x JOIN sizes t ON t.doc_id = y
  WHERE 100 * common >= {percent} * (s.n + t.n - common)),
ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reached AS (
  SELECT doc_id, doc_id AS node FROM documents UNION
  SELECT doc_id, y FROM reached JOIN ways ON node = x),
found AS (SELECT doc_id, min(node) AS component_id FROM reached GROUP BY doc_id)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, {columns}
FROM found LEFT JOIN sizes USING (doc_id)"""


OP11 = rf"""
WITH RECURSIVE runs AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
                                           '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS run FROM documents),
kinds AS (SELECT doc_id, run, count(*) AS n FROM runs WHERE length(run) >= 6 GROUP BY ALL),
keyed AS (SELECT *, doc_id || ':' || run AS key FROM kinds),
marked AS (SELECT run, n, {crc32("key")} AS h FROM keyed),
spelt AS (
  SELECT CASE WHEN h % 199 = 0
    THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM marked),
counted AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM spelt WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
shortened AS (
  SELECT word, k, substr(word, 1, k - 1) || substr(word, k + 1) AS rest
  FROM counted, unnest(range(1, length(word) + 1)) AS places(k)),
pairs AS (
  SELECT a.word, b.word AS near FROM shortened a JOIN shortened b USING (k, rest) WHERE a.word <> b.word
  UNION SELECT word, rest FROM shortened SEMI JOIN counted c ON c.word = rest
  UNION SELECT rest, word FROM shortened SEMI JOIN counted c ON c.word = rest),
best AS (
  SELECT p.word, near, c.n AS near_n, count(*) OVER (PARTITION BY p.word) AS n_near
  FROM pairs p JOIN counted c ON c.word = near
  QUALIFY row_number() OVER (PARTITION BY p.word ORDER BY c.n DESC, near) = 1),
formed AS (
  SELECT c.word, c.n, coalesce(n_near, 0) AS n_near,
         CASE WHEN near_n >= 5 * c.n THEN near END AS form, CASE WHEN near_n >= 5 * c.n THEN near_n END AS form_n
  FROM counted c LEFT JOIN best USING (word)),
walked AS (
  SELECT word, word AS stop FROM formed
  UNION SELECT w.word, f.form FROM walked w JOIN formed f ON f.word = w.stop WHERE f.form IS NOT NULL),
ends AS (SELECT w.word, stop FROM walked w JOIN formed f ON f.word = w.stop WHERE f.form IS NULL)
SELECT word, form, stop AS root, n, CAST(n_near AS BIGINT) AS n_near, form_n FROM formed JOIN ends USING (word)"""

OP13 = f"""
WITH told AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
hashed AS (
  SELECT *, sha256(concat(strlen(role), ':', role, text)) AS key, strlen(text) AS size FROM told),
turns AS (
  SELECT conv_id, key, size,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, key) - 1 AS place FROM hashed),
named AS (SELECT DISTINCT conv_id, CAST(conv_id AS VARCHAR) AS name FROM turns),
ids AS (SELECT conv_id, {crc32("name")} % 9 AS h FROM named),
both_parts AS (
  SELECT i.conv_id, 0 AS part, t.place, t.key, t.size
  FROM ids i JOIN turns t ON t.conv_id = i.conv_id - i.conv_id % 5 WHERE t.place < h
  UNION ALL SELECT t.conv_id, 1, t.place, t.key, t.size FROM turns t JOIN ids i USING (conv_id) WHERE t.place >= h),
rebuilt AS (
  SELECT conv_id, coalesce(string_agg(key, '' ORDER BY part, place), '') AS path,
         coalesce(list(size ORDER BY part, place) FILTER (key IS NOT NULL), []) AS sizes
  FROM ids LEFT JOIN both_parts USING (conv_id) GROUP BY conv_id),
prefixes AS (
  SELECT conv_id, d, substr(path, 1, 64 * d) AS prefix, d = len(sizes) AS ends_here,
         CASE WHEN d = 0 THEN 0 ELSE sizes[d] END AS size
  FROM rebuilt, unnest(range(0, len(sizes) + 1)) AS depths(d)),
nodes AS (
  SELECT prefix, CAST(d AS BIGINT) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(size) AS size,
         coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends_here), '') AS ends
  FROM prefixes GROUP BY prefix, d),
children AS (
  SELECT substr(prefix, 1, 64 * (depth - 1)) AS prefix, count(*) AS n_children
  FROM nodes WHERE depth > 0 GROUP BY ALL),
known AS (SELECT *, coalesce(n_children, 0) AS kids FROM nodes LEFT JOIN children USING (prefix)),
sums AS (
  SELECT substr(prefix, 1, 64 * a) AS prefix, sum((n_convs - 1) * size) AS saved, count_if(kids = 0) AS leaves
  FROM known, unnest(range(0, depth + 1)) AS above(a) GROUP BY ALL)
SELECT k.conv_id, k.depth, p.conv_id AS parent_conv_id, k.n_convs, k.kids AS n_children,
       CAST(leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, sha256(k.ends) AS ends_sha256
FROM known k JOIN sums USING (prefix)
LEFT JOIN nodes p ON k.depth > 0 AND p.prefix = substr(k.prefix, 1, 64 * (k.depth - 1))"""
