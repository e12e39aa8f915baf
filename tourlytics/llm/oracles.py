"""DuckDB SQL for the queries that SQL can express, written apart from the operators."""

from __future__ import annotations

#: The words of a document with their places, and every run of WIDTH words.
PHRASES = r"""WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
w AS (SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS p FROM d),
g AS (SELECT doc_id, p, string_agg(w, ' ') OVER f AS k, count(*) OVER f AS n FROM w
  WINDOW f AS (PARTITION BY doc_id ORDER BY p ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING)),
l AS (SELECT doc_id, p, row_number() OVER (PARTITION BY k ORDER BY doc_id, p) AS nth FROM g WHERE n = 20),
c AS (SELECT DISTINCT doc_id, unnest(range(p, p + 20)) AS p FROM l WHERE nth > 1)
SELECT d.doc_id, any_value(len(d.ws)) AS n_words, count(c.p) AS n_removed,
  sha256(coalesce(string_agg(w.w, ' ' ORDER BY w.p) FILTER (WHERE c.p IS NULL), '')) AS kept_sha256
FROM d LEFT JOIN w ON w.doc_id = d.doc_id LEFT JOIN c ON c.doc_id = w.doc_id AND c.p = w.p GROUP BY d.doc_id"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


def _runs(words: str, size: int) -> str:
    """Runs of ``size`` words of a table (id, w, p, n): id, p, the run and its size."""
    return f"""SELECT id, p, string_agg(w, ' ') OVER f AS k, count(*) OVER f AS size, n FROM {words}
  WINDOW f AS (PARTITION BY id ORDER BY p ROWS BETWEEN CURRENT ROW AND {size - 1} FOLLOWING)"""


LEAKS = (
    f"""WITH d AS (SELECT doc_id AS id, {_WORDS} AS ws FROM documents),
w AS (SELECT id, unnest(ws) AS w, generate_subscripts(ws, 1) AS p, len(ws) AS n FROM d),
b AS (SELECT item_id AS id, {_WORDS} AS ws FROM benchmark),
bw AS (SELECT id, unnest(ws) AS w, generate_subscripts(ws, 1) AS p, len(ws) AS n FROM b),
"""
    + ",\n".join(
        f"""i{s} AS (SELECT DISTINCT id, k FROM ({_runs("bw", s)}) WHERE size = {s} AND {"n >= 10" if s == 10 else f"n = {s}"}),
h{s} AS (SELECT r.id, r.p, {s} AS size, i.id AS item FROM ({_runs("w", s)}) r JOIN i{s} i ON i.k = r.k WHERE r.size = {s})"""
        for s in range(1, 11)
    )
    + ",\nh AS ("
    + " UNION ALL ".join(f"SELECT * FROM h{s}" for s in range(1, 11))
    + """),
c AS (SELECT id, count(DISTINCT p) AS n_hit FROM (SELECT id, unnest(range(p, p + size)) AS p FROM h) GROUP BY id),
t AS (SELECT id, count(DISTINCT item) AS n_items, array_to_string(list_sort(list_distinct(list(item::VARCHAR))), ',') AS items
  FROM h GROUP BY id)
SELECT d.id AS doc_id, len(d.ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c ON c.id = d.id LEFT JOIN t ON t.id = d.id"""
)

VECTORS = """WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0 AND len([x FOR x IN embedding IF x <> 0]) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.93),
n AS (SELECT a, count(*) AS n_links FROM l GROUP BY a),
r AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON l.a = r.b),
m AS (SELECT a, least(a, min(b)) AS component_id FROM r GROUP BY a)
SELECT e.vec_id, coalesce(n_links, 0) AS n_links, coalesce(component_id, e.vec_id) AS component_id,
  coalesce(component_id, e.vec_id) = e.vec_id AS kept
FROM embeddings e LEFT JOIN n ON n.a = e.vec_id LEFT JOIN m ON m.a = e.vec_id"""

_NORM = r"trim(regexp_replace(lower({}), '\s+', ' ', 'g'), ' ')"

QUOTES = (
    r"""WITH RECURSIVE m AS (SELECT row_number() OVER () AS r, conv_id, turn, role,
  translate(text, chr(1), ' ') AS text FROM conversations),
s AS (SELECT r, conv_id, turn, string_split_regex(text, '\r?\n') AS ls FROM m WHERE text IS NOT NULL),
n AS (SELECT r, conv_id, turn, generate_subscripts(ls, 1) AS p, unnest(ls) AS line FROM s),
q AS (SELECT *, regexp_extract(line, '^[ \t]*>[> \t]*') AS prefix FROM n),
u AS (SELECT r, conv_id, turn, p, substr(line, length(prefix) + 1) AS said,
  length(prefix) - length(replace(prefix, '>', '')) AS level FROM q),
runs AS (SELECT *, sum(new) OVER (PARTITION BY r ORDER BY p) AS run FROM (SELECT *,
  (level IS DISTINCT FROM lag(level) OVER (PARTITION BY r ORDER BY p))::INT AS new FROM u)),
ps AS (SELECT r, conv_id, turn, run, any_value(level) AS level, string_agg(said, chr(10) ORDER BY p) AS said
  FROM runs GROUP BY r, conv_id, turn, run),
own AS (SELECT r, regexp_replace(coalesce(string_agg(said, chr(10) ORDER BY run) FILTER (WHERE level = 0), ''),
  '^\s+|\s+$', '', 'g') AS text FROM ps GROUP BY r),
parts AS (SELECT m.conv_id, m.turn, unnest(list_concat([own.text], list_concat(
  string_split_regex(own.text, '\n[ \t]*\n'), string_split(own.text, chr(10))))) AS part
  FROM m JOIN own ON own.r = m.r WHERE m.conv_id IS NOT NULL AND m.turn IS NOT NULL),
said AS (SELECT conv_id, """
    + _NORM.format("part")
    + r""" AS k, min(turn) AS first FROM parts GROUP BY ALL),
whole AS (SELECT DISTINCT ps.conv_id, ps.turn, ps.level, ps.said, """
    + _NORM.format("ps.said")
    + r""" AS k FROM ps WHERE ps.level > 0 AND ps.conv_id IS NOT NULL AND ps.turn IS NOT NULL),
found AS (SELECT w.*, CASE WHEN first < w.turn THEN first END AS original
  FROM whole w LEFT JOIN said USING (conv_id, k) WHERE w.k <> ''),
lines AS (SELECT f.conv_id, f.turn, f.level, unnest(string_split(f.said, chr(10))) AS line FROM found f
  WHERE original IS NULL AND contains(f.said, chr(10))),
keyed AS (SELECT DISTINCT conv_id, turn, level, """
    + _NORM.format("line")
    + r""" AS k FROM lines),
links AS (SELECT conv_id, turn, level, k, min(original) AS original FROM (
  SELECT conv_id, turn, level, k, original FROM found WHERE original IS NOT NULL OR NOT contains(said, chr(10))
  UNION ALL SELECT x.conv_id, x.turn, x.level, x.k, CASE WHEN first < x.turn THEN first END
  FROM keyed x LEFT JOIN said USING (conv_id, k) WHERE x.k <> '') GROUP BY conv_id, turn, level, k),
reply AS (SELECT conv_id, turn, coalesce(max(original) FILTER (WHERE level = 1), max(original)) AS reply_to,
  count(*) AS n_quoted, count(original) AS n_linked FROM links GROUP BY conv_id, turn),
up AS (SELECT conv_id, turn, reply_to AS root_turn, 1 AS depth FROM reply WHERE reply_to IS NOT NULL
  UNION ALL SELECT up.conv_id, up.turn, reply.reply_to, up.depth + 1 FROM up
  JOIN reply ON reply.conv_id = up.conv_id AND reply.turn = up.root_turn WHERE reply.reply_to IS NOT NULL),
top AS (SELECT conv_id, turn, min(root_turn) AS root_turn, max(depth) AS depth FROM up GROUP BY conv_id, turn)
SELECT m.conv_id, m.turn, m.role, own.text, reply_to, coalesce(root_turn, m.turn) AS root_turn,
  coalesce(depth, 0)::BIGINT AS depth, coalesce(n_quoted, 0) AS n_quoted, coalesce(n_linked, 0) AS n_linked
FROM m LEFT JOIN own ON own.r = m.r
LEFT JOIN reply ON reply.conv_id = m.conv_id AND reply.turn = m.turn
LEFT JOIN top ON top.conv_id = m.conv_id AND top.turn = m.turn"""
)
