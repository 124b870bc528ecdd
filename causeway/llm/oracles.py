"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from .collocations import INSIDE, LEAST, LONGEST, SCALE, TOP
from .mixing import LIMIT, SHARE, WEIGHTS

WORDS = r"regexp_extract_all(translate(coalesce({0}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP1 = rf"""
WITH item AS (SELECT coalesce(CAST(item_id AS VARCHAR), 'null') AS item, {WORDS.format('text')} AS w FROM benchmark),
bench AS (
  SELECT DISTINCT item, least(10, len(w)) AS n, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS win
  FROM (SELECT item, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM item WHERE len(w) > 0)),
lengths AS (SELECT DISTINCT n FROM bench),
doc AS (SELECT row_number() OVER () AS r, doc_id, {WORDS.format('text')} AS w FROM documents),
win AS (
  SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS win
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM doc, lengths WHERE len(w) >= n)),
hit AS (SELECT r, i, n, item FROM win JOIN bench USING (n, win)),
word AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hit) GROUP BY r),
found AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
          FROM (SELECT DISTINCT r, item FROM hit) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN word USING (r) LEFT JOIN found USING (r)"""

OP10 = f"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
         md5('42|' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS k FROM documents),
src AS (SELECT source, CAST(sum(size) AS BIGINT) AS s FROM sized GROUP BY source),
weighed AS (
  SELECT source, s, {LIMIT} * s AS cap,
         CAST([{', '.join(map(str, WEIGHTS))}][(row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % {len(WEIGHTS)} + 1] AS DOUBLE) AS w FROM src),
ranked AS (SELECT *, cap / w AS ratio, row_number() OVER (ORDER BY cap / w, encode(source) NULLS LAST) AS place FROM weighed),
levelled AS (
  SELECT *, (CAST(sum(s) OVER () AS DOUBLE) * {SHARE}::DOUBLE - coalesce(CAST(sum(cap) OVER (ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS DOUBLE), 0))
            / sum(w) OVER (ORDER BY place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM ranked),
first AS (SELECT arg_min(level, place) AS level, min(place) AS place FROM levelled WHERE ratio > level),
goal AS (
  SELECT l.source, l.s, CASE WHEN f.place IS NULL OR l.place < f.place THEN CAST(l.cap AS DOUBLE) ELSE f.level * l.w END AS target
  FROM levelled l, first f),
placed AS (
  SELECT d.doc_id, d.size, g.s AS source_size, g.target,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k, d.doc_id, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
         CAST(floor(g.target) AS BIGINT) AS budget
  FROM sized d JOIN goal g ON d.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, target,
       CAST(CASE WHEN source_size = 0 THEN 0 ELSE (budget // source_size) * size
            + greatest(0, least(budget % source_size - before, size)) END AS BIGINT) AS taken
FROM placed"""

OP11 = rf"""
WITH piece AS (
  SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(unnest(regexp_split_to_array(translate(coalesce(text, ''),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?
-]')), '[^ 	]+') AS w FROM documents),
total AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM piece GROUP BY lang),
spot AS (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM piece, range(1, {LONGEST + 1}) t(m) WHERE len(w) >= m),
f AS (SELECT lang, CAST(m AS BIGINT) AS m, array_to_string(w[i:i + m - 1], ' ') AS phrase, count(*) AS f
      FROM spot GROUP BY ALL HAVING count(*) >= {LEAST}),
cut AS (SELECT lang, phrase, m, f AS a, string_split(phrase, ' ') AS w, unnest(range(1, m)) AS k FROM f WHERE m > 1),
scored AS (
  SELECT c.lang, c.phrase, a, k, x.f AS l, y.f AS r, CAST((CAST({SCALE} AS HUGEINT) * a) // (CAST(x.f AS HUGEINT) + y.f) AS BIGINT) AS score
  FROM cut c JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:k], ' ')
  JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[k + 1:], ' ')),
weakest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
wide AS (SELECT lang, f, string_split(phrase, ' ') AS w, m, unnest(range(2, m)) AS k FROM f WHERE m > 2),
inner_ AS (SELECT lang, array_to_string(w[i:i + k - 1], ' ') AS phrase, max(f) AS around
           FROM (SELECT *, unnest(range(1, m - k + 2)) AS i FROM wide) GROUP BY ALL),
kept AS (SELECT w.* FROM weakest w LEFT JOIN inner_ i USING (lang, phrase)
         WHERE around IS NULL OR CAST(100 AS HUGEINT) * around < CAST({INSIDE} AS HUGEINT) * a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN total USING (lang) WHERE rank <= {TOP}"""

TURN = "md5(length(role) || '|' || role || text)"

# crc32 of a decimal text: each byte is folded in, then eight steps of the reversed polynomial.
CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: ascii(x)::BIGINT)),
  lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[],
    lambda v, z: xor(v >> 1, CASE WHEN v & 1 = 1 THEN 3988292384::BIGINT ELSE 0 END))), 4294967295::BIGINT)"""

OP12 = f"""
WITH said AS (SELECT CAST(conv_id AS BIGINT) AS c, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
              FROM conversations WHERE conv_id IS NOT NULL),
ordered AS (SELECT c, role, text, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, {TURN}) AS pos FROM said),
conv AS (SELECT c, count(*) AS n, c - c % 100 AS root, {CRC} % 6 AS h FROM ordered GROUP BY c),
rebuilt AS (
  SELECT conv.c, o.pos, role, text FROM conv JOIN ordered o ON o.c = conv.root AND o.pos <= conv.h
  UNION ALL
  SELECT conv.c, o.pos - conv.h + least(conv.h, coalesce(r.n, 0)), role, text
  FROM conv JOIN ordered o ON o.c = conv.c AND o.pos > conv.h LEFT JOIN conv r ON r.c = conv.root),
path AS (
  SELECT c, pos AS d, md5(string_agg({TURN}, ',') OVER (PARTITION BY c ORDER BY pos)) AS k, length(text) AS chars FROM rebuilt
  UNION ALL SELECT c, 0, '', 0 FROM conv),
lens AS (SELECT c, max(d) AS len FROM path GROUP BY c),
node AS (
  SELECT d, k, min(c) AS conv_id, count(*) AS n, any_value(chars) AS chars,
         coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE d = len), '') AS ends
  FROM path JOIN lens USING (c) GROUP BY d, k),
up AS (SELECT n.d, n.k, p.k AS pk FROM node n JOIN path p ON p.c = n.conv_id AND p.d = n.d - 1),
kids AS (SELECT d - 1 AS d, pk AS k, count(*) AS n_children FROM up GROUP BY ALL),
below AS (
  SELECT p.d, p.k, sum(CASE WHEN kids.k IS NULL THEN 1 ELSE 0 END) AS n_leaves, sum((n.n - 1) * n.chars) AS saved
  FROM node n LEFT JOIN kids ON kids.d = n.d AND kids.k = n.k JOIN path p ON p.c = n.conv_id AND p.d <= n.d GROUP BY p.d, p.k)
SELECT n.conv_id, n.d AS depth, parent.conv_id AS parent_conv_id, n.n AS n_convs, coalesce(n_children, 0) AS n_children,
       CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, sha256(n.ends) AS ends_sha256
FROM node n JOIN below USING (d, k) LEFT JOIN kids USING (d, k)
LEFT JOIN up ON up.d = n.d AND up.k = n.k LEFT JOIN node parent ON parent.d = n.d - 1 AND parent.k = up.pk"""

ORACLES = {"op1_decontamination": OP1, "op10_mixing": OP10, "op11_collocations": OP11, "op12_prefix_trie": OP12}
