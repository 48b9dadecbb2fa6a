"""DuckDB SQL of the exact operators: the contract by plain joins over all windows, shingles and words."""

from __future__ import annotations

from .collocations import lowered
from .decontaminate import WINDOW as ITEM_WINDOW
from .phrases import WINDOW
from .spelling import TIMES

#: Fixed value: words of the contracts between ASCII white space.
SPACED = r"[^\x20\x09-\x0D]+"

#: Rows of one id are one document to each other, and a missing id counts as larger than all others.
PHRASES = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS nr, doc_id, coalesce(doc_id, 9223372036854775807) AS id,
    regexp_extract_all(coalesce(text, ''), '{SPACED}') AS w FROM documents),
windows AS (
  SELECT nr, id, i, array_to_string(w[i:i + {WINDOW - 1}], ' ') AS phrase
  FROM (SELECT nr, id, w, unnest(range(1, len(w) - {WINDOW - 2})) AS i FROM docs)),
owned AS (SELECT nr, id, i, min(id) OVER (PARTITION BY phrase) AS owner FROM windows),
gone AS (SELECT DISTINCT nr, unnest(range(i, i + {WINDOW})) AS pos FROM owned WHERE owner < id),
placed AS (SELECT nr, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS pos FROM docs),
told AS (
  SELECT p.nr, count(g.pos) AS n_removed, string_agg(p.word, ' ' ORDER BY p.pos) FILTER (g.pos IS NULL) AS kept
  FROM placed p LEFT JOIN gone g ON g.nr = p.nr AND g.pos = p.pos GROUP BY p.nr)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(t.n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(t.kept, '')) AS kept_sha256
FROM docs d LEFT JOIN told t ON t.nr = d.nr
"""

#: Windows that follow each other in item and document make the longest match; the first of equally long ones counts.
DECONTAMINATION = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS nr, doc_id,
    regexp_extract_all({lowered("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
items AS (
  SELECT row_number() OVER () AS item, id, w, least(len(w), {ITEM_WINDOW}) AS size
  FROM (SELECT DISTINCT coalesce(item_id::VARCHAR, '') AS id,
    regexp_extract_all({lowered("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark) WHERE len(w) > 0),
wanted AS (
  SELECT item, id, size, q, array_to_string(w[q:q + size - 1], ' ') AS phrase
  FROM (SELECT *, unnest(range(1, len(w) - size + 2)) AS q FROM items)),
windows AS (
  SELECT nr, i, size, array_to_string(w[i:i + size - 1], ' ') AS phrase
  FROM (SELECT nr, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM docs, (SELECT DISTINCT size FROM items))),
found AS (SELECT d.nr, d.i, d.size, t.item, t.id, t.q FROM windows d JOIN wanted t ON t.size = d.size AND t.phrase = d.phrase),
marked AS (
  SELECT nr, count(DISTINCT pos) AS n_hit FROM (SELECT nr, unnest(range(i, i + size)) AS pos FROM found) GROUP BY nr),
named AS (
  SELECT nr, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT nr, id FROM found) GROUP BY nr),
runs AS (
  SELECT nr, min(i) AS i, count(*) + any_value(size) - 1 AS words
  FROM (SELECT *, i - row_number() OVER (PARTITION BY nr, item, i - q ORDER BY i) AS run FROM found)
  GROUP BY nr, item, i - q, run),
longest AS (SELECT nr, i - 1 AS longest_start, words FROM runs QUALIFY row_number() OVER (PARTITION BY nr ORDER BY words DESC, i) = 1)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(m.n_hit, 0)::BIGINT AS n_hit, coalesce(n.n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(n.ids, '')) AS items_sha256, coalesce(m.n_hit > 0 AND 20 * m.n_hit >= len(d.w), false) AS contaminated,
  coalesce(l.words, 0)::BIGINT AS longest_words, l.longest_start::BIGINT AS longest_start
FROM docs d LEFT JOIN marked m ON m.nr = d.nr LEFT JOIN named n ON n.nr = d.nr LEFT JOIN longest l ON l.nr = d.nr
"""

#: Links are joined on shared shingles; the smallest id that they lead to names a component.
NEAR_DUPLICATES = rf"""
WITH RECURSIVE docs AS (
  SELECT doc_id, regexp_extract_all({lowered("coalesce(text, '')")}, '{SPACED}') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM docs),
items AS (SELECT doc_id, len(s) AS n, unnest(s) AS item FROM sets),
links AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM items a JOIN items b ON a.item = b.item AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id HAVING 100 * count(*) >= 85 * (any_value(a.n) + any_value(b.n) - count(*))),
reached AS (
  SELECT x, y FROM links UNION SELECT r.x, l.y FROM reached r JOIN links l ON l.x = r.y),
named AS (SELECT x, min(y) AS low FROM reached GROUP BY x)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, least(s.doc_id, n.low) AS component_id,
  coalesce(s.doc_id = least(s.doc_id, n.low), true) AS kept
FROM sets s LEFT JOIN named n ON n.x = s.doc_id
"""

#: Letters of the runs are below U+0100, so each has one or two bytes; crc32 goes over them with its usual table.
#: Words that lose a letter at one place each meet those that are one letter longer, or that differ at this place.
SPELLING = rf"""
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda b: list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b)) AS steps),
runs AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS id, unnest(regexp_extract_all({lowered('text')}, '[a-z\x{{00C0}}-\x{{00FF}}]{{7,}}')) AS run FROM documents),
bytes AS (
  SELECT run, flatten(list_transform(string_split(id || ':' || run, ''),
    lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT] ELSE [192 + unicode(c) // 64, 128 + unicode(c) % 64]::BIGINT[] END)) AS b FROM runs),
hashed AS (
  SELECT run, xor(list_reduce(b, lambda c, x: xor(c >> 8, steps[(xor(c, x) & 255) + 1]), 4294967295), 4294967295) AS h FROM bytes, crc),
slipped AS (
  SELECT CASE WHEN h % 31 = 0 THEN left(run, h % length(run)) || substring(run, h % length(run) + 2) ELSE run END AS word FROM hashed),
words AS (SELECT word, count(*) AS n FROM slipped WHERE length(word) >= 7 GROUP BY word HAVING count(*) >= 2),
cut AS (SELECT word, n, k, left(word, k - 1) || substring(word, k + 1) AS less FROM (SELECT *, unnest(range(1, length(word) + 1)) AS k FROM words)),
pairs AS (
  SELECT a.word AS x, b.word AS y FROM cut a JOIN cut b ON a.less = b.less AND a.k = b.k AND a.word <> b.word
  UNION SELECT c.word, w.word FROM cut c JOIN words w ON w.word = c.less
  UNION SELECT w.word, c.word FROM cut c JOIN words w ON w.word = c.less),
ways AS (SELECT p.x AS word, w.n AS n, p.y AS other, o.n AS other_n FROM pairs p JOIN words w ON w.word = p.x JOIN words o ON o.word = p.y),
best AS (SELECT *, count(*) OVER (PARTITION BY word) AS n_near FROM ways QUALIFY row_number() OVER (PARTITION BY word ORDER BY other_n DESC, other) = 1),
forms AS (SELECT word, other AS form, other_n AS form_n FROM best WHERE other_n >= {TIMES} * n),
ends AS (SELECT word, form AS root, 1 AS steps FROM forms UNION ALL SELECT e.word, f.form, e.steps + 1 FROM ends e JOIN forms f ON f.word = e.root),
roots AS (SELECT word, arg_max(root, steps) AS root FROM ends GROUP BY word)
SELECT w.word, f.form, coalesce(r.root, w.word) AS root, w.n::BIGINT AS n, coalesce(b.n_near, 0)::BIGINT AS n_near, f.form_n::BIGINT AS form_n
FROM words w LEFT JOIN best b ON b.word = w.word LEFT JOIN forms f ON f.word = w.word LEFT JOIN roots r ON r.word = w.word
"""
