"""DuckDB SQL of the operators that SQL can express."""

from __future__ import annotations

_SMALL = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SPACED = r"'[^\x20\x09-\x0D]+'"
_ALNUM = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"

OP1 = """
WITH h AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
b AS (SELECT doc_id, i AS pos, substr(x, 2 * i + 1, 2) AS pair, CASE WHEN 2 * i + 100 <= length(x) THEN substr(x, 2 * i + 1, 100) END AS s
      FROM (SELECT doc_id, x, unnest(range(0, length(x) // 2)) AS i FROM h)),
r AS (SELECT doc_id, pos, pair, s IS NOT NULL AND min(doc_id) OVER (PARTITION BY s) < doc_id AS rep FROM b),
c AS (SELECT doc_id, pos, pair, bool_or(rep) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS gone FROM r),
e AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY pos), false) AS begins FROM c),
a AS (SELECT doc_id, count(*) AS n_bytes, count(*) FILTER (gone) AS n_removed, count(*) FILTER (begins) AS n_spans,
             string_agg(pair, '' ORDER BY pos) FILTER (NOT gone) AS kept FROM e GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_bytes, 0) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM documents d LEFT JOIN a USING (doc_id)
"""

OP3 = f"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_SMALL}, {_SPACED}) AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + 2], ' ') AS g FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 1, 2))) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * shared >= 90 * (a.n + b.n - shared)),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
reach AS (SELECT doc_id AS origin, doc_id AS node FROM documents UNION SELECT origin, y FROM reach JOIN e ON x = node)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, low AS component_id
FROM documents d LEFT JOIN n USING (doc_id) JOIN (SELECT origin AS doc_id, min(node) AS low FROM reach GROUP BY origin) USING (doc_id)
"""

OP7 = f"""
WITH iw AS (SELECT item_id, regexp_extract_all({_SMALL}, {_ALNUM}) AS ws FROM benchmark),
iws AS (SELECT DISTINCT item_id, n, array_to_string(ws[i:i + n - 1], ' ') AS s
        FROM (SELECT item_id, ws, least(len(ws), 10) AS n, unnest(range(1, len(ws) - least(len(ws), 10) + 2)) AS i FROM iw WHERE len(ws) > 0)),
dw AS (SELECT doc_id, regexp_extract_all({_SMALL}, {_ALNUM}) AS ws FROM documents),
dws AS (SELECT doc_id, n, i, array_to_string(ws[i:i + n - 1], ' ') AS s
        FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM dw, (SELECT DISTINCT n FROM iws) WHERE len(ws) >= n)),
hits AS (SELECT doc_id, item_id, n, i FROM dws JOIN iws USING (n, s)),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
          FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id)
SELECT doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       n_hit IS NOT NULL AS contaminated
FROM dw LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""

OP8 = f"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), {_SPACED}) AS ws FROM documents),
t AS (SELECT doc_id, i AS pos, ws[i] AS word, CASE WHEN i + 19 <= len(ws) THEN array_to_string(ws[i:i + 19], ' ') END AS s
      FROM (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS i FROM w)),
r AS (SELECT doc_id, pos, word, s IS NOT NULL AND row_number() OVER (PARTITION BY s ORDER BY doc_id, pos) > 1 AS rep FROM t),
c AS (SELECT doc_id, pos, word, bool_or(rep) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS gone FROM r),
a AS (SELECT doc_id, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY pos) FILTER (NOT gone) AS kept FROM c GROUP BY doc_id)
SELECT doc_id, len(ws) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM w LEFT JOIN a USING (doc_id)
"""

# CRC-32 of the decimal digits of a number, bit by bit.
_CRC32 = """xor(list_reduce(range(1, length({0}::VARCHAR) + 1), lambda crc_, i_: list_reduce(range(0, 8),
    lambda bit_, k_: CASE WHEN bit_ & 1 = 1 THEN xor(bit_ >> 1, 3988292384) ELSE bit_ >> 1 END, xor(crc_, ascii(({0}::VARCHAR)[i_])::BIGINT)), 4294967295::BIGINT), 4294967295)"""

OP11 = f"""
WITH own AS (SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
             row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
               sha256(strlen(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, ''))) - 1 AS i FROM conversations WHERE conv_id IS NOT NULL),
convs AS (SELECT c, {_CRC32.format("c")} % 6 AS h FROM (SELECT DISTINCT c FROM own)),
built AS (SELECT k.c, 0 AS part, o.i, o.role, o.text FROM convs k JOIN own o ON o.c = k.c - k.c % 100 AND o.i < k.h
          UNION ALL SELECT k.c, 1, o.i, o.role, o.text FROM convs k JOIN own o ON o.c = k.c AND o.i >= k.h),
runs AS (SELECT c, count(*) OVER w AS depth, list({{'role': role, 'text': text}}) OVER w AS prefix, length(text) AS chars, count(*) OVER (PARTITION BY c) AS len
         FROM built WINDOW w AS (PARTITION BY c ORDER BY part, i)),
nodes AS (SELECT depth, prefix, min(c) AS conv_id, count(*) AS n_convs, min(chars) AS chars, string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (len = depth) AS ends
          FROM runs GROUP BY depth, prefix
          UNION ALL SELECT 0, [], min(c), count(*), 0, string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (c NOT IN (SELECT c FROM built)) FROM convs),
kids AS (SELECT p.depth, p.prefix, count(*) AS n FROM nodes p JOIN nodes k ON k.depth = p.depth + 1 AND k.prefix[1:p.depth] = p.prefix GROUP BY ALL),
up AS (SELECT k.depth, k.prefix, p.conv_id FROM nodes p JOIN nodes k ON k.depth = p.depth + 1 AND k.prefix[1:p.depth] = p.prefix),
facts AS (SELECT n.*, coalesce(kids.n, 0) AS n_children, up.conv_id AS parent_conv_id FROM nodes n LEFT JOIN kids USING (depth, prefix) LEFT JOIN up USING (depth, prefix)),
sums AS (SELECT a.depth, a.prefix, sum((b.n_convs - 1) * b.chars)::BIGINT AS saved_tokens, count(*) FILTER (b.n_children = 0) AS n_leaves
         FROM facts a JOIN facts b ON b.depth >= a.depth AND b.prefix[1:a.depth] = a.prefix GROUP BY ALL)
SELECT conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, sha256(coalesce(ends, '')) AS ends_sha256 FROM facts JOIN sums USING (depth, prefix)
WHERE n_convs > 0
"""

_FIELD = "coalesce(strlen({0}::VARCHAR)::VARCHAR || ':' || {0}::VARCHAR, '-')"
_LEAF = "sha256(" + " || ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", "n_chars", "{0}")) + ")"
_CHANGED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
# A tree's levels: pos is a node's place on its level, n how many that level has.
_UP = """{name} AS (SELECT tree, 0 AS level, pos, digest, n FROM {leaves}
  UNION ALL SELECT tree, level + 1, pos // 8, sha256(string_agg(digest, '' ORDER BY pos)), (n + 7) // 8 FROM {name} WHERE n > 1 GROUP BY tree, level, pos // 8, n)"""
# Folding: a leaf's own digest takes its place among its siblings, level by level.
_FOLD = """{name} AS (SELECT key, tree, 0 AS level, pos, digest, sibs FROM {start}
  UNION ALL SELECT f.key, f.tree, f.level + 1, f.pos // 8, sha256(string_agg(CASE WHEN u.pos = f.pos THEN f.digest ELSE u.digest END, '' ORDER BY u.pos)),
    f.sibs || coalesce(string_agg(u.digest, '' ORDER BY u.pos) FILTER (u.pos <> f.pos), '')
  FROM {name} f JOIN {up} u ON u.tree = f.tree AND u.level = f.level AND u.pos // 8 = f.pos // 8 AND u.n > 1 GROUP BY f.key, f.tree, f.level, f.pos, f.digest, f.sibs)"""

OP12 = f"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS key, doc_id, coalesce('=' || lang, '-') AS tree, {_LEAF.format("text")} AS leaf,
    CASE WHEN {_CRC32.format("doc_id")} % 3 = 0 THEN {_LEAF.format(_CHANGED)} ELSE {_LEAF.format("text")} END AS changed FROM documents),
leaves AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS n FROM d),
own AS (SELECT tree, pos, leaf AS digest, n FROM leaves),
{_UP.format(name="up", leaves="own")},
subs AS (SELECT tree AS of_tree, digest, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n FROM up WHERE n = 1),
tops AS (SELECT '' AS tree, pos, digest, n FROM subs),
{_UP.format(name="above", leaves="tops")},
begun AS (SELECT key, tree, pos, changed AS digest, '' AS sibs FROM leaves),
{_FOLD.format(name="fold", start="begun", up="up")},
middle AS (SELECT f.key, '' AS tree, s.pos, f.digest, f.sibs, s.digest AS subroot
           FROM (SELECT key, arg_max(tree, level) AS tree, arg_max(digest, level) AS digest, arg_max(sibs, level) AS sibs FROM fold GROUP BY key) f JOIN subs s ON s.of_tree = f.tree),
{_FOLD.format(name="fold2", start="middle", up="above")},
ends AS (SELECT key, arg_max(digest, level) AS folded_root, arg_max(sibs, level) AS sibs FROM fold2 GROUP BY key)
SELECT doc_id, leaf, subroot, root, sha256(ends.sibs) AS proof_sha256, folded_root, folded_root = root AS verified
FROM leaves JOIN ends USING (key) JOIN (SELECT key, subroot FROM middle) USING (key), (SELECT digest AS root FROM above WHERE n = 1)
"""
