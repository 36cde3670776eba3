"""DuckDB twins of the queries that SQL can express."""

from __future__ import annotations

_REST = "CASE WHEN strpos({0}, '://') > 0 THEN substr({0}, strpos({0}, '://') + 3) ELSE '' END"
_HOST = "translate(regexp_extract({0}, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_PATH = "regexp_extract({0}, '^[^/?#]*([^?#]*)', 1)"
_QUERY = "regexp_extract({0}, '^[^?#]*([?][^#]*)', 1)"
_QUOTED = """\\s*=\\s*(?:"([^"]*)"|''([^'']*)''|([^\\s"''>]+))"""


def _attribute(name: str) -> str:
    return " || ".join(f"regexp_extract(tag, '(?i)\\b{name}{_QUOTED}', {g})" for g in (1, 2, 3))


# segment by segment; a dot segment at the end leaves a slash
_FOLD = (
    "(list_reduce(string_split({0}, '/'), lambda done, x: CASE x WHEN '.' THEN done WHEN '..' THEN regexp_replace(done, '/?[^/]*$', '') "
    "ELSE done || '/' || x END) || CASE WHEN regexp_matches({0}, '/\\.\\.?$') THEN '/' ELSE '' END)"
)


def _target(host: str, path: str) -> str:
    """What ``href`` on a page names, before dot segments are folded."""
    folder = f"regexp_replace({path}, '[^/]*$', '')"
    return f"""CASE
      WHEN regexp_matches(href, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN href
      WHEN href LIKE '//%' THEN 'x:' || href
      WHEN href LIKE '/%' THEN 'x://' || {host} || href
      WHEN href LIKE '?%' THEN 'x://' || {host} || {path} || href
      WHEN href = '' OR href LIKE '#%' OR href LIKE '%:%' THEN NULL
      ELSE 'x://' || {host} || CASE WHEN {folder} = '' THEN '/' ELSE {folder} END || href END"""


OP1 = rf"""
WITH RECURSIVE rules(verdict, host, path) AS (
  VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
         ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
rows_ AS (
  SELECT page_id, {_HOST.format("rest")} AS host, {_PATH.format("rest")} AS path, {_QUERY.format("rest")} AS query,
         html, coalesce(strpos(url, '://'), 0) > 0 AS given
  FROM (SELECT *, {_REST.format("coalesce(url, '')")} AS rest FROM pages)),
found AS (
  SELECT host, path, query, html, regexp_extract(html, '(?i)<base\b[^>]*>') AS tag
  FROM rows_ WHERE given AND regexp_matches(html, '(?i)canonical|refresh')),
based AS (
  SELECT *, {_REST.format("base")} AS rest FROM (
    SELECT *, coalesce({_target("host", "path")}, 'x://' || host || path) AS base
    FROM (SELECT *, replace(trim({_attribute("href")}, ' '), '&amp;', '&') AS href FROM found))),
tags AS (
  SELECT host || path || query AS a, {_HOST.format("rest")} AS host, CASE WHEN href = '' THEN path ELSE {_FOLD.format(_PATH.format("rest"))} END AS path,
         unnest(regexp_extract_all(html, '(?i)<(?:link|meta)\b[^>]*>')) AS tag
  FROM based),
hrefs AS (
  SELECT a, host, path, replace(trim(CASE
      WHEN regexp_matches({_attribute("rel")}, '(?i)(^|\s)canonical(\s|$)') THEN {_attribute("href")}
      WHEN lower({_attribute("http-equiv")}) = 'refresh'
        THEN regexp_extract({_attribute("content")}, '(?i)url\s*=\s*[''"]?([^''">]*)', 1) END, ' '), '&amp;', '&') AS href
  FROM tags),
targets AS (
  SELECT a, {_REST.format("dst")} AS rest FROM (SELECT a, {_target("host", "path")} AS dst FROM hrefs) WHERE dst IS NOT NULL),
edges AS (
  SELECT a, {_HOST.format("rest")} || {_FOLD.format(_PATH.format("rest"))} || {_QUERY.format("rest")} AS b FROM targets),
both_ AS (SELECT a, b FROM edges UNION SELECT b, a FROM edges),
judged AS (
  SELECT node, arg_max(verdict, length(r.host || r.path)) AS verdict
  FROM (SELECT DISTINCT a AS node, regexp_extract(a, '^[^/?#]*') AS host, {_PATH.format("a")} AS path FROM both_) n
  JOIN rules r ON (n.host = r.host OR ends_with(n.host, '.' || r.host)) AND starts_with(n.path, r.path)
  GROUP BY node),
blocked(node) AS (
  SELECT node FROM judged WHERE verdict = 'block' UNION SELECT b FROM blocked JOIN both_ ON a = node),
own AS (
  SELECT u.host, u.path, arg_max(r.host || r.path, length(r.host || r.path)) AS rule,
         arg_max(r.verdict, length(r.host || r.path)) AS verdict
  FROM (SELECT DISTINCT host, path FROM rows_) u
  JOIN rules r ON (u.host = r.host OR ends_with(u.host, '.' || r.host)) AND starts_with(u.path, r.path)
  GROUP BY u.host, u.path)
SELECT p.page_id, p.host, p.path, o.rule,
       coalesce(o.verdict, CASE WHEN b.node IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict,
       o.rule IS NULL AND b.node IS NOT NULL AS via_alias
FROM rows_ p LEFT JOIN own o ON o.host = p.host AND o.path = p.path
LEFT JOIN blocked b ON p.given AND b.node = p.host || p.path || p.query
"""

_BLANK = "' ' || chr(9) || chr(11) || chr(12) || chr(13)"

OP7 = f"""
WITH raw AS (
  SELECT doc_id, i - 1 AS num, txt FROM (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS txt,
           unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i
    FROM documents WHERE text IS NOT NULL)),
lines AS (
  SELECT doc_id, num, trim(txt, {_BLANK}) AS bare, words,
         row_number() OVER (PARTITION BY doc_id ORDER BY num) - 1 AS pos,
         sum(words) OVER (PARTITION BY doc_id ORDER BY num)::BIGINT AS total
  FROM (SELECT *, len(regexp_extract_all(txt, '[^\\x20\\x09-\\x0D]+')) AS words FROM raw) WHERE words > 0),
ends AS (
  SELECT a.doc_id, a.pos AS lo, min(b.pos) + 1 AS hi FROM lines a
  JOIN lines b ON b.doc_id = a.doc_id AND b.pos >= a.pos AND b.pos < a.pos + 50 AND b.total - a.total + a.words >= 50
  GROUP BY ALL),
windows AS (
  SELECT e.doc_id, lo, hi, string_agg(bare, chr(10) ORDER BY pos) AS content
  FROM ends e JOIN lines l ON l.doc_id = e.doc_id AND l.pos >= lo AND l.pos < hi GROUP BY ALL),
firsts AS (SELECT content, min(struct_pack(d := doc_id, p := lo)) AS f FROM windows GROUP BY content),
matches AS (
  SELECT doc_id, lo, hi, f.d AS src, lo - f.p AS shift FROM windows JOIN firsts USING (content)
  WHERE NOT (doc_id = f.d AND lo = f.p)),
begun AS (
  SELECT *, coalesce(lo > max(hi) OVER (PARTITION BY doc_id, src, shift ORDER BY lo, hi
                                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), true)::INT AS b FROM matches),
runs AS (
  SELECT doc_id, src, shift, min(lo) AS lo, max(hi) AS hi FROM (
    SELECT *, sum(b) OVER (PARTITION BY doc_id, src, shift ORDER BY lo, hi ROWS UNBOUNDED PRECEDING) AS island FROM begun)
  GROUP BY doc_id, src, shift, island),
steps AS (
  SELECT r.*, k FROM runs r, range(1, 52) t(k)),
grown AS (
  SELECT s.doc_id, s.src, s.shift, s.lo, s.hi,
         least(50, min(k) FILTER (WHERE x.bare IS NULL OR y.bare IS NULL OR x.bare <> y.bare) - 1) AS onward,
         least(50, min(k) FILTER (WHERE u.bare IS NULL OR v.bare IS NULL OR u.bare <> v.bare) - 1) AS back
  FROM steps s
  LEFT JOIN lines x ON x.doc_id = s.doc_id AND x.pos = s.hi + k - 1
  LEFT JOIN lines y ON y.doc_id = s.src AND y.pos = s.hi - s.shift + k - 1
  LEFT JOIN lines u ON u.doc_id = s.doc_id AND u.pos = s.lo - k
  LEFT JOIN lines v ON v.doc_id = s.src AND v.pos = s.lo - s.shift - k
  GROUP BY ALL),
cut AS (
  SELECT doc_id,
         CASE WHEN doc_id = src AND lo < hi - shift THEN hi - shift
              WHEN doc_id = src THEN greatest(lo - coalesce(back, 50), hi - shift + coalesce(onward, 50))
              ELSE lo - coalesce(back, 50) END AS lo,
         CASE WHEN doc_id = src AND lo < hi - shift THEN hi ELSE hi + coalesce(onward, 50) END AS hi
  FROM grown),
spans AS (
  SELECT c.doc_id, a.num AS lo, b.num + 1 AS hi FROM cut c
  JOIN lines a ON a.doc_id = c.doc_id AND a.pos = c.lo JOIN lines b ON b.doc_id = c.doc_id AND b.pos = c.hi - 1
  WHERE c.lo < c.hi),
joined AS (
  SELECT *, coalesce(lo > max(hi) OVER (PARTITION BY doc_id ORDER BY lo, hi
                                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), true)::INT AS b FROM spans),
gone AS (
  SELECT doc_id, min(lo) AS lo, max(hi) AS hi FROM (
    SELECT *, sum(b) OVER (PARTITION BY doc_id ORDER BY lo, hi ROWS UNBOUNDED PRECEDING) AS island FROM joined)
  GROUP BY doc_id, island),
listed AS (
  SELECT doc_id, sum(hi - lo)::INT AS n_removed, string_agg(lo || ':' || hi, ',' ORDER BY lo) AS removed
  FROM gone GROUP BY doc_id),
kept AS (
  SELECT r.doc_id, string_agg(txt, chr(10) ORDER BY num) AS text FROM raw r
  WHERE NOT EXISTS (SELECT 1 FROM gone g WHERE g.doc_id = r.doc_id AND r.num >= g.lo AND r.num < g.hi) GROUP BY r.doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN 0 ELSE len(string_split(d.text, chr(10))) END::INT AS n_lines,
       coalesce(n_removed, 0) AS n_removed, coalesce(removed, '') AS removed,
       CASE WHEN d.text IS NOT NULL THEN sha256(coalesce(k.text, '')) END AS text_sha256
FROM documents d LEFT JOIN listed l USING (doc_id) LEFT JOIN kept k USING (doc_id)
"""

OP8 = """
WITH turns AS (
  SELECT DISTINCT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
placed AS (
  SELECT *, row_number() OVER w AS place,
         list({'role': role, 'text': text}) OVER (w ROWS UNBOUNDED PRECEDING) AS prefix,
         lead(conv_id) OVER w IS NULL AS last
  FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
whole AS (
  SELECT min(conv_id) AS conv_id, place, prefix, count(*) AS copies FROM placed WHERE last GROUP BY place, prefix),
kept AS (
  SELECT * FROM whole w WHERE NOT EXISTS (
    SELECT 1 FROM placed p WHERE NOT p.last AND p.place = w.place AND p.prefix = w.prefix))
SELECT k.conv_id, k.place::INTEGER AS n_turns, k.copies,
       string_agg('<|im_start|>' || replace(t.role, '<|', '< |') || chr(10) || replace(t.text, '<|', '< |')
                  || '<|im_end|>' || chr(10), '' ORDER BY t.place) AS text
FROM kept k JOIN placed t ON t.conv_id = k.conv_id GROUP BY k.conv_id, k.place, k.copies
"""

_FINITE = "embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"

OP9 = f"""
WITH v AS (
  SELECT *, row_number() OVER () AS row_no FROM (
    SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS e FROM embeddings WHERE vec_id IS NOT NULL AND {_FINITE})),
scored AS (
  SELECT q.row_no, q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON c.row_no <> q.row_no WHERE q.vec_id % 20 = 0)
SELECT query_id, (row_number() OVER w)::INTEGER AS rank, vec_id, score FROM scored
WINDOW w AS (PARTITION BY row_no ORDER BY score DESC, vec_id) QUALIFY rank <= 20
"""

OP10 = f"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND {_FINITE} AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
least AS (SELECT a, least(a, min(b)) AS name FROM reach GROUP BY a),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, coalesce(name, vec_id) AS component_id,
       vec_id = coalesce(name, vec_id) AS kept
FROM embeddings LEFT JOIN counts c ON c.a = vec_id LEFT JOIN least l ON l.a = vec_id
"""

def _nibbles() -> str:
    """What four zero bits make of the CRC-32 register, for each value of the bits that leave it."""
    table = []
    for value in range(16):
        for _ in range(4):
            value = value >> 1 ^ (0xEDB88320 if value & 1 else 0)
        table.append(str(value))
    return f"[{', '.join(table)}]"


def _crc32(text: str) -> str:
    """CRC-32 of a text's UTF-8, from its hex digits, the low one of each byte first."""
    digits = f"hex(encode({text}))"
    nibble = f"instr('0123456789ABCDEF', {digits}[i + 2 - 2 * (i % 2) : i + 2 - 2 * (i % 2)]) - 1"
    return (
        f"xor(list_reduce(list_prepend(4294967295, list_transform(range(length({digits})), lambda i: {nibble})), "
        f"lambda c, b: xor(c >> 4, {_nibbles()}[xor(c, b) % 16 + 1])), 4294967295)"
    )


_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP11 = f"""
WITH RECURSIVE
runs AS (
  SELECT doc_id, run, count(*) AS k
  FROM (SELECT doc_id, unnest(regexp_extract_all({_LOWER}, '[a-zÀ-ÿ]+')) AS run FROM documents) GROUP BY ALL),
named AS (SELECT run, k, coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run AS name FROM runs),
hashed AS (SELECT run, k, {_crc32("name")} AS h FROM named),
v AS MATERIALIZED (
  SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word,
         CAST(sum(k) AS BIGINT) AS n
  FROM hashed GROUP BY 1 HAVING length(word) >= 5 AND n >= 3),
less AS MATERIALIZED (
  SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS rest
  FROM (SELECT word, n, unnest(range(length(word))) AS i FROM v)),
near AS MATERIALIZED (
  SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM less a JOIN less b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT a.word, a.n, b.word, b.n FROM less a JOIN v b ON a.rest = b.word
  UNION SELECT b.word, b.n, a.word, a.n FROM less a JOIN v b ON a.rest = b.word),
best AS (
  SELECT word, count(*) OVER (PARTITION BY word) AS n_near, other, other_n,
         row_number() OVER (PARTITION BY word ORDER BY other_n DESC, other) AS place
  FROM near),
forms AS MATERIALIZED (
  SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 2 * v.n THEN other END AS form,
         CASE WHEN other_n >= 2 * v.n THEN other_n END AS form_n
  FROM v LEFT JOIN best b ON b.word = v.word AND b.place = 1),
way(word, here) AS (
  SELECT word, word FROM forms UNION ALL SELECT w.word, f.form FROM way w JOIN forms f ON f.word = w.here WHERE f.form IS NOT NULL),
ends AS (SELECT w.word, w.here AS root FROM way w JOIN forms f ON f.word = w.here WHERE f.form IS NULL)
SELECT word, form, root, n, CAST(n_near AS BIGINT) AS n_near, CAST(form_n AS BIGINT) AS form_n FROM forms JOIN ends USING (word)
"""

_FEATURES = f"""
  SELECT *, list_concat(words, list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1])) AS features FROM (
    SELECT *, coalesce(regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), []) AS words FROM {{0}})"""

OP13 = f"""
WITH
docs AS MATERIALIZED (
  SELECT doc_id, len(words) AS n_words, len(features) AS n_features, features, row_number() OVER () AS place
  FROM ({_FEATURES.format("documents")})),
own AS MATERIALIZED (SELECT place, unnest(features) AS feature FROM docs),
wanted AS MATERIALIZED (SELECT unnest(features) AS feature FROM ({_FEATURES.format("benchmark")})),
hashed AS MATERIALIZED (
  SELECT feature, {_crc32("feature")} % 10000 AS bucket FROM (SELECT feature FROM own UNION SELECT feature FROM wanted)),
s AS (SELECT bucket, count(*) AS s FROM own JOIN hashed USING (feature) GROUP BY 1),
t AS (SELECT bucket, count(*) AS t FROM wanted JOIN hashed USING (feature) GROUP BY 1),
sums AS (SELECT (SELECT count(*) FROM own) AS ss, (SELECT count(*) FROM wanted) AS tt),
gain AS MATERIALIZED (
  SELECT bucket, CAST(floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * (ss + 10000) / ((s + 1)::DOUBLE * (tt + 10000)))) AS BIGINT) AS gain
  FROM s LEFT JOIN t USING (bucket), sums),
weights AS (SELECT place, CAST(floor(sum(gain)::DOUBLE / count(*)) AS BIGINT) AS weight FROM own JOIN hashed USING (feature) JOIN gain USING (bucket) GROUP BY 1),
scored AS (
  SELECT doc_id, n_words, CAST(n_features AS BIGINT) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln(
    (CAST('0x' || substr(sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296.0::DOUBLE))) AS BIGINT) AS score
  FROM docs LEFT JOIN weights USING (place)),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id NULLS LAST) AS place,
         floor(25 * count(*) FILTER (n_words >= 20) OVER () / 100) AS drawn
  FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN n_words >= 20 AND place <= drawn THEN place END AS rank FROM placed
"""

SQL: dict[str, str] = {
    "op1_url_filter": OP1,
    "op7_line_dedup": OP7,
    "op8_chat_format": OP8,
    "op9_top_k": OP9,
    "op10_metric_join": OP10,
    "op11_spelling_variants": OP11,
    "op13_resample": OP13,
}
