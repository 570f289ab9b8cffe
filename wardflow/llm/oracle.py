"""DuckDB SQL for the registered queries that SQL can express."""

from __future__ import annotations

ORACLE_SQL: dict[str, str] = {}

# Word pattern, weights and shares of the mix.
ORACLE_SQL["op2_source_mix"] = r"""
WITH quality AS (
  SELECT doc_id, 1.0::DOUBLE + 2.0::DOUBLE * coalesce(avg(quality), 0.5) AS quality
  FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
), sized AS (
  SELECT d.doc_id, d.source,
         coalesce(length(regexp_extract_all(d.text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         coalesce(q.quality, 2.0::DOUBLE) AS weight
  FROM documents d LEFT JOIN quality q ON d.doc_id = q.doc_id
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size, sum(sum(size)) OVER () * 1.5::DOUBLE AS budget,
         CASE (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3
           WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS w,
         sum(size) * 2.0::DOUBLE AS most
  FROM sized GROUP BY source
), filled AS (
  SELECT *, (budget - coalesce(sum(most) OVER (ORDER BY most / w, source NULLS LAST
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(w) OVER (ORDER BY most / w, source NULLS LAST
                 ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM sources
), final AS (
  SELECT *, first_value(CASE WHEN level * w < most THEN level END IGNORE NULLS)
              OVER (ORDER BY most / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS held
  FROM filled
), targets AS (
  SELECT source, source_size, coalesce(least(held * w, most), most) AS target FROM final
), keyed AS (
  SELECT s.*, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size) ELSE 0 END::INT AS whole,
         -ln((('0x' || substr(md5(coalesce(s.doc_id::VARCHAR, '')), 1, 12))::BIGINT + 0.5::DOUBLE)
             / 281474976710656::DOUBLE) / s.weight AS key
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
), summed AS (
  SELECT *, target - whole * source_size AS budget,
         coalesce(sum(size) OVER (PARTITION BY source ORDER BY key, doc_id, size
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM keyed
), taken AS (
  SELECT *, CASE WHEN size = 0 THEN 0
           ELSE whole + CASE WHEN budget > 0 AND before + size / 2 <= budget THEN 1 ELSE 0 END END AS epochs
  FROM summed
)
SELECT doc_id, size, source_size, target, (size * epochs)::BIGINT AS taken, source, epochs::INTEGER AS epochs
FROM taken
"""

# Separators of words, window length, share of hit words.
ORACLE_SQL["op6_decontaminate"] = r"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, doc_id,
         list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM documents
), items AS (
  SELECT DISTINCT item_id,
         list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS k, array_to_string(w[s : s + least(len(w), 13) - 1], ' ') AS words
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS s FROM items WHERE len(w) > 0)
), places AS (
  SELECT rid, k, s, array_to_string(w[s : s + k - 1], ' ') AS words
  FROM (SELECT rid, w, k, unnest(range(1, len(w) - k + 2)) AS s
        FROM docs, (SELECT DISTINCT k FROM windows) WHERE len(w) >= k)
), hits AS (
  SELECT p.rid, p.s, p.k, v.item_id FROM places p JOIN windows v ON p.k = v.k AND p.words = v.words
), counted AS (
  SELECT rid, count(DISTINCT place) AS n_hit
  FROM (SELECT rid, unnest(range(s, s + k)) AS place FROM (SELECT DISTINCT rid, s, k FROM hits)) GROUP BY rid
), listed AS (
  SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT rid, item_id::VARCHAR AS item FROM hits WHERE item_id IS NOT NULL) GROUP BY rid
), places_of AS (
  SELECT rid, unnest(w) AS word, generate_subscripts(w, 1) AS spot FROM docs
), rare AS (
  SELECT item_id, w, word FROM (SELECT DISTINCT item_id, w, unnest(w) AS word FROM items WHERE len(w) > 0)
  JOIN (SELECT word, count(*) AS n FROM places_of GROUP BY word) USING (word)
  QUALIFY row_number() OVER (PARTITION BY item_id, w ORDER BY n, word) <= 3
), close AS (
  SELECT rid, item_id, w, count(DISTINCT r.word) OVER (PARTITION BY rid, item_id, w ORDER BY spot
           RANGE BETWEEN CURRENT ROW AND 25 FOLLOWING) AS seen
  FROM places_of p JOIN rare r ON p.word = r.word
), near AS (
  SELECT rid, count(DISTINCT c.item_id::VARCHAR) AS n_near
  FROM close c JOIN (SELECT item_id, w, count(*) AS wanted FROM rare GROUP BY item_id, w HAVING count(*) > 1) t
    ON c.item_id IS NOT DISTINCT FROM t.item_id AND c.w = t.w AND c.seen = t.wanted
  GROUP BY rid
)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(c.n_hit, 0)::BIGINT AS n_hit,
       coalesce(l.n_items, 0)::BIGINT AS n_items, sha256(coalesce(l.ids, '')) AS items_sha256,
       coalesce(c.n_hit, 0) > 0 AND 20 * coalesce(c.n_hit, 0) >= len(d.w) AS contaminated,
       coalesce(n.n_near, 0)::BIGINT AS n_near
FROM docs d LEFT JOIN counted c USING (rid) LEFT JOIN listed l USING (rid) LEFT JOIN near n USING (rid)
"""

# White space, least words of a line to be compared, and with one edit.
ORACLE_SQL["op4_line_dedup"] = r"""
WITH lines AS (
  SELECT rid, doc_id, no,
         list_filter(regexp_split_to_array(line, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM (SELECT row_number() OVER () AS rid, doc_id, unnest(string_split(text, chr(10))) AS line,
               generate_subscripts(string_split(text, chr(10)), 1) - 1 AS no FROM documents)
), compared AS (
  SELECT *, len(w) AS n, array_to_string(w, ' ') AS words FROM lines WHERE len(w) >= 2
), firsts AS (
  SELECT words, any_value(w) AS w, any_value(n) AS n, min(struct_pack(d := doc_id, l := no)) AS first
  FROM compared GROUP BY words
), variants AS (
  SELECT words, n, first, g AS gap, array_to_string(list_concat(w[1 : g - 1], w[g + 1 :]), ' ') AS rest
  FROM (SELECT *, unnest(range(1, n + 1)) AS g FROM firsts WHERE n >= 8)
), near AS (
  SELECT a.words FROM variants a JOIN variants b
    ON a.rest = b.rest AND a.gap = b.gap AND a.n = b.n AND b.first < a.first
  UNION SELECT a.words FROM variants a JOIN firsts b ON a.rest = b.words AND b.n >= 8 AND b.first < a.first
  UNION SELECT b.words FROM variants a JOIN firsts b ON a.rest = b.words AND b.n >= 8 AND a.first < b.first
), gone AS (
  SELECT c.rid, c.no FROM compared c JOIN firsts f USING (words)
  WHERE struct_pack(d := c.doc_id, l := c.no) <> f.first OR c.words IN (SELECT words FROM near)
), listed AS (
  SELECT rid, count(*) AS n_removed, string_agg(no::VARCHAR, ',' ORDER BY no) AS removed_lines FROM gone GROUP BY rid
)
SELECT d.doc_id, coalesce(len(string_split(d.text, chr(10))), 0)::BIGINT AS n_lines,
       coalesce(l.n_removed, 0)::BIGINT AS n_removed, coalesce(l.removed_lines, '') AS removed_lines
FROM (SELECT row_number() OVER () AS rid, doc_id, text FROM documents) d LEFT JOIN listed l USING (rid)
"""


# License names with the words of their usual notices, threshold.
_TEMPLATES = (
    "(0, 'Apache-2.0', 'Licensed under the Apache License, Version 2.0'), "
    "(1, 'MIT', 'Released under the MIT License'), "
    "(2, 'GPL-3.0', 'This work is licensed under the GNU General Public License, version 3'), "
    "(3, 'CC-BY-NC-4.0', 'Licensed under CC BY-NC 4.0'), "
    "(4, 'CC-BY-SA-4.0', 'Licensed under CC BY-SA 4.0'), "
    "(5, 'BSD-3-Clause', 'Redistribution and use in source and binary forms are permitted'), "
    "(6, 'MPL-2.0', 'This Source Code Form is subject to the terms of the Mozilla Public License'), "
    "(7, 'Proprietary', 'All rights reserved')"
)
ORACLE_SQL["op3_license_scan"] = r"""
WITH templates AS (SELECT * FROM (VALUES @TEMPLATES@) t(i, name, text)),
tt AS (SELECT i, name, unnest(list_filter(list_distinct(regexp_split_to_array(lower(text), '[^a-z0-9]+')),
              lambda x: x <> '')) AS term FROM templates),
files AS (
  SELECT row_number() OVER () AS rid, doc_id, text,
    CASE WHEN doc_id IS NULL THEN NULL ELSE coalesce(source, 'none')
      || CASE WHEN doc_id % 100 = 0 THEN '' ELSE '/' || floor(doc_id / 100)::BIGINT END
      || CASE WHEN doc_id % 10 = 0 THEN '' ELSE '/' || floor(doc_id / 10)::BIGINT END
      || CASE WHEN doc_id % 10 = 0 THEN '/LICENSE-' ELSE '/file-' END || doc_id END AS path
  FROM documents
), df AS (
  SELECT term, count(*) AS df FROM (
    SELECT unnest(list_distinct(regexp_split_to_array(lower(text), '[^a-z0-9]+'))) AS term FROM files)
  WHERE term IN (SELECT term FROM tt) GROUP BY term
), n AS (SELECT count(*) AS n FROM files),
idf AS (
  SELECT term, ln((n + 1.0::DOUBLE) / (coalesce(df, 0) + 1.0::DOUBLE)) + 1.0::DOUBLE AS idf
  FROM (SELECT DISTINCT term FROM tt) LEFT JOIN df USING (term), n
), w AS (
  SELECT i, name, term, idf, idf / sqrt(sum(idf * idf) OVER (PARTITION BY i)) AS w FROM tt JOIN idf USING (term)
), lines AS (
  SELECT rid, no, list_filter(list_distinct(regexp_split_to_array(lower(line), '[^a-z0-9]+')),
           lambda x: x <> '') AS terms
  FROM (SELECT rid, unnest(string_split(text, chr(10))) AS line,
               generate_subscripts(string_split(text, chr(10)), 1) AS no FROM files)
), hits AS (
  SELECT rid, no, len(terms) AS n_terms, term, idf FROM
    (SELECT rid, no, terms, unnest(terms) AS term FROM lines) JOIN idf USING (term)
), norms AS (
  SELECT rid, no, sqrt(sum(idf * idf) + (any_value(n_terms) - count(*))
    * (ln(any_value(n.n) + 1.0::DOUBLE) + 1.0::DOUBLE) ** 2) AS norm FROM hits, n GROUP BY rid, no
), scores AS (
  SELECT rid, no, i, name, round(sum(h.idf * w.w) / any_value(norm), 6) AS score
  FROM hits h JOIN w USING (term) JOIN norms USING (rid, no) GROUP BY rid, no, i, name
), own AS (
  SELECT rid, name AS own_license, score AS own_score FROM scores WHERE score >= 0.6
  QUALIFY row_number() OVER (PARTITION BY rid ORDER BY score DESC, no, i) = 1
), located AS (
  SELECT f.rid, doc_id, path, own_license, own_score FROM files f LEFT JOIN own USING (rid)
), dirs AS (
  SELECT regexp_replace(path, '/[^/]*$', '') AS dir, arg_min(own_license, path) AS license
  FROM located WHERE doc_id % 10 = 0 AND own_license IS NOT NULL GROUP BY 1
), above AS (
  SELECT l.rid, arg_max(d.dir, length(d.dir)) AS dir, arg_max(d.license, length(d.dir)) AS license
  FROM located l JOIN dirs d ON d.dir IN (regexp_replace(l.path, '/[^/]*$', ''),
    regexp_replace(l.path, '/[^/]*/[^/]*$', ''), regexp_replace(l.path, '/[^/]*/[^/]*/[^/]*$', ''))
  WHERE l.own_license IS NULL GROUP BY l.rid
)
SELECT doc_id, path, own_license, round(own_score, 4) AS own_score,
       coalesce(own_license, a.license) AS license, a.dir AS inherited_from
FROM located LEFT JOIN above a USING (rid)
""".replace("@TEMPLATES@", _TEMPLATES)


# Divisor of the ids, crc32 polynomial, most shared turns.
ORACLE_SQL["op12_conversation_trie"] = r"""
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
           md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS place
  FROM conversations WHERE conv_id IS NOT NULL
), crc AS (
  SELECT conv_id, xor(list_reduce(list_concat([4294967295::BIGINT],
           list_transform(range(length(conv_id::VARCHAR)), lambda i: ascii(substr(conv_id::VARCHAR, i + 1, 1))::BIGINT)),
           lambda c, b: list_reduce(list_concat([xor(c, b)], range(8)),
             lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) AS code
  FROM (SELECT DISTINCT conv_id FROM turns)
), heads AS (SELECT conv_id, code % 4 AS h, conv_id - conv_id % 20 AS source FROM crc
), rebuilt AS (
  SELECT h.conv_id, 0 AS own, t.place, struct_pack(r := role, t := text) AS turn
  FROM heads h JOIN turns t ON t.conv_id = h.source AND t.place <= h.h
  UNION ALL
  SELECT h.conv_id, 1, t.place, struct_pack(r := role, t := text)
  FROM heads h JOIN turns t ON t.conv_id = h.conv_id AND t.place > h.h
), convs AS (
  SELECT h.conv_id, coalesce(list(turn ORDER BY own, place) FILTER (WHERE turn IS NOT NULL), []) AS turns
  FROM heads h LEFT JOIN rebuilt r ON r.conv_id = h.conv_id GROUP BY h.conv_id
), members AS (
  SELECT conv_id, len(turns) AS n, d AS depth, turns[1 : d] AS path
  FROM (SELECT *, unnest(range(len(turns) + 1)) AS d FROM convs)
), nodes AS (
  SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE n = depth), '') AS ends,
         CASE WHEN depth = 0 THEN 0
           ELSE (count(*) - 1) * len(regexp_extract_all(path[depth].t, '[^\x20\x09-\x0D]+')) END AS saved
  FROM members GROUP BY path, depth
), linked AS (
  SELECT a.*, b.conv_id AS parent_conv_id FROM nodes a
  LEFT JOIN nodes b ON a.depth > 0 AND b.depth = a.depth - 1 AND b.path = a.path[1 : a.depth - 1]
), counted AS (
  SELECT l.*, (SELECT count(*) FROM linked c WHERE c.parent_conv_id = l.conv_id AND c.depth = l.depth + 1) AS n_children
  FROM linked l
), above AS (
  SELECT path[1 : d] AS top, (n_children = 0)::BIGINT AS leaf, saved
  FROM (SELECT path, n_children, saved, unnest(range(depth + 1)) AS d FROM counted)
), rolled AS (SELECT top, sum(leaf)::BIGINT AS n_leaves, sum(saved)::BIGINT AS saved_tokens FROM above GROUP BY top)
SELECT conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, sha256(ends) AS ends_sha256
FROM counted c JOIN rolled r ON r.top = c.path
"""


# Divisors of ids, scale of components, numbers of rows, window in percent.
ORACLE_SQL["op11_hard_negatives"] = """
WITH kept AS (
  SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.id AS anchor_id, r.id, a.label = r.label AS same, list_inner_product(a.v, r.v)::BIGINT AS score
  FROM kept a JOIN kept r ON a.id <> r.id WHERE a.id % 50 = 0
), positives AS (
  SELECT * FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
)
SELECT p.anchor_id, p.id AS positive_id,
       (row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY n.score DESC, n.id))::INTEGER AS rank,
       n.id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same
  AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score
QUALIFY rank <= 3
"""
