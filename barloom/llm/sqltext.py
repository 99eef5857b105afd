"""SQL of the operators that SQL can express."""

from barloom.llm.op8_license_scan import COPYRIGHT_LINE, KNOWN, MARKS, RESTRICTED, SPELLINGS, catalogue

_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)

DECONTAMINATE = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, w, least(len(w), 10) AS n FROM (SELECT item_id, {_WORDS} AS w FROM benchmark) WHERE len(w) > 0),
windows AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i : i + n - 1], ' ') AS span
  FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM b)),
places AS (
  SELECT doc_id, i, n, array_to_string(w[i : i + n - 1], ' ') AS span
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
        FROM d, (SELECT DISTINCT n FROM windows) AS lengths WHERE len(w) >= n)),
hits AS (SELECT doc_id, i, n, item_id FROM places JOIN windows USING (n, span)),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
"""

JACCARD = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS shingle
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
both_ AS (
  SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS c FROM s AS a JOIN s AS b USING (shingle)
  WHERE a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
links AS (
  SELECT u, v FROM both_ JOIN n AS x ON x.doc_id = u JOIN n AS y ON y.doc_id = v WHERE 100 * c >= 80 * (x.n + y.n - c)),
reach AS (
  SELECT u, v FROM links
  UNION SELECT reach.u, links.v FROM reach JOIN links ON links.u = reach.v),
lowest AS (SELECT u AS doc_id, min(v) AS v FROM reach GROUP BY u)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, least(d.doc_id, coalesce(v, d.doc_id)) AS component_id
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN lowest USING (doc_id)
"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _canonical(column: str) -> str:
    out = (f"regexp_replace(translate(coalesce({column}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
           f"'abcdefghijklmnopqrstuvwxyz'), {_quoted(COPYRIGHT_LINE)}, '\\1', 'g')")
    for variant, one in SPELLINGS:
        out = f"replace({out}, {_quoted(variant)}, {_quoted(one)})"
    return f"trim(regexp_replace({out}, {_quoted(MARKS)}, ' ', 'g'))"


_LISTED = catalogue()
_BAD = ", ".join(map(_quoted, sorted({*RESTRICTED, *(r["license"] for r in _LISTED if r["restricted"] == "1")})))

LICENSES = f"""
WITH k AS (
  SELECT digest, min(license) AS license FROM (
    SELECT sha256({_canonical('text')}) AS digest, license
    FROM (VALUES {', '.join(f'({_quoted(a)}, {_quoted(b)})' for a, b in KNOWN)}) AS t(license, text)
    UNION ALL FROM (VALUES {', '.join(f"({_quoted(r['sha256'])}, {_quoted(r['license'])})" for r in _LISTED)}) AS l(digest, license))
  GROUP BY digest),
w AS (SELECT doc_id, CASE WHEN {_canonical('text')} <> '' THEN sha256({_canonical('text')}) END AS digest FROM documents),
l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents),
f AS (
  SELECT doc_id, count(*) AS n, string_agg(DISTINCT k.license, ',' ORDER BY k.license) AS names,
    bool_or(k.license IN ({_BAD})) AS bad
  FROM l JOIN k ON k.digest = sha256({_canonical('line')}) AND {_canonical('line')} <> '' GROUP BY doc_id)
SELECT w.doc_id, w.digest, k.license, CAST(coalesce(n, 0) AS BIGINT) AS n_license_lines,
  coalesce(names, '') AS line_licenses,
  coalesce(bad, false) OR coalesce(k.license IN ({_BAD}), false) AS restricted
FROM w LEFT JOIN k USING (digest) LEFT JOIN f USING (doc_id)
"""


def _vector_codes(rounds: int = 6) -> str:
    assigned = """a{i} AS MATERIALIZED (
  SELECT r, p, e, d FROM (
    SELECT r, p, e, CAST(sum((x - c) * (x - c)) AS BIGINT) AS d FROM cells JOIN b{i} USING (p, j) GROUP BY r, p, e)
  QUALIFY row_number() OVER (PARTITION BY r, p ORDER BY d, e) = 1)"""
    moved = """b{k} AS MATERIALIZED (
  SELECT p, e, j, coalesce((s - (((s % n) + n) % n)) // n, c) AS c FROM b{i} LEFT JOIN (
    SELECT p, e, j, CAST(sum(x) AS BIGINT) AS s, count(*) AS n FROM cells JOIN a{i} USING (r, p) GROUP BY p, e, j)
  USING (p, e, j))"""
    steps = [x.format(i=i, k=i + 1) for i in range(rounds) for x in (assigned, moved)] + [assigned.format(i=rounds)]
    return f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id, embedding) AS r, vec_id, label,
    list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
cells AS MATERIALIZED (
  SELECT r, i // (len(v) // 8) AS p, i % (len(v) // 8) AS j, v[i + 1] AS x
  FROM (SELECT r, v, unnest(range(len(v))) AS i FROM kept)),
b0 AS MATERIALIZED (SELECT p, r - 1 AS e, j, x AS c FROM cells WHERE r <= 16),
{", ".join(steps)},
coded AS (SELECT r, string_agg(printf('%02x', CAST(e AS INT)), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error
  FROM a{rounds} GROUP BY r)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY p, e, j)) FROM b{rounds}) AS codebooks_sha256
FROM kept JOIN coded USING (r)
"""


VECTOR_CODES = _vector_codes()

WARC = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS n FROM pages),
t AS (SELECT *, max(page_id) OVER (PARTITION BY html) AS top FROM p)
SELECT page_id, n AS payload_bytes, sha1(html) AS payload_digest,
  CASE WHEN n >= 1000 AND page_id < top THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 1000 AND page_id < top THEN top END AS refers_to
FROM t
"""

_CRC = (
    "xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(range(1, len(c) + 1), "
    "lambda i: ascii(substr(c, i, 1))::BIGINT)), lambda a, b: list_reduce(list_concat([xor(a, b)], "
    "[0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda x, y: xor(x >> 1, (x & 1) * 3988292384::BIGINT))), 4294967295::BIGINT)"
)

PREFIX_TRIE = f"""
WITH t AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, id) AS pos, id, size
  FROM (SELECT conv_id, turn, len(coalesce(text, '')) AS size, substr(sha256(
          octet_length(encode(coalesce(role, '')))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')), 1, 32) AS id
        FROM conversations WHERE conv_id IS NOT NULL)),
c AS (SELECT conv_id, {_CRC} % 6 AS h FROM (SELECT DISTINCT conv_id, CAST(conv_id AS VARCHAR) AS c FROM t)),
r AS (
  SELECT c.conv_id, 0 AS own, pos, id, size FROM c JOIN t ON t.conv_id = c.conv_id - c.conv_id % 100 AND pos <= h
  UNION ALL SELECT c.conv_id, 1, pos, id, size FROM c JOIN t ON t.conv_id = c.conv_id AND pos > h),
s AS (
  SELECT conv_id, row_number() OVER w AS depth, string_agg(id, '') OVER w AS key, size
  FROM r WINDOW w AS (PARTITION BY conv_id ORDER BY own, pos)
  UNION ALL SELECT conv_id, 0, '', 0 FROM c),
n AS MATERIALIZED (
  SELECT depth, key, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(size) AS size FROM s GROUP BY depth, key),
e AS (
  SELECT key, string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) AS ends
  FROM (SELECT conv_id, max_by(key, depth) AS key FROM s GROUP BY conv_id) GROUP BY key),
k AS (SELECT substr(key, 1, 32 * (depth - 1)) AS key, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY 1),
b AS (
  SELECT key, sum(leaf) AS n_leaves, sum(saved) AS saved_tokens
  FROM (SELECT substr(n.key, 1, 32 * unnest(range(0, depth + 1))) AS key, CAST(n_children IS NULL AS INT) AS leaf,
          (n_convs - 1) * size AS saved FROM n LEFT JOIN k ON k.key = n.key) GROUP BY key)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, CAST(n.n_convs AS BIGINT) AS n_convs,
  CAST(coalesce(n_children, 0) AS BIGINT) AS n_children, CAST(n_leaves AS BIGINT) AS n_leaves,
  CAST(saved_tokens AS BIGINT) AS saved_tokens, sha256(coalesce(ends, '')) AS ends_sha256
FROM n LEFT JOIN n AS p ON n.depth > 0 AND p.depth = n.depth - 1 AND p.key = substr(n.key, 1, 32 * (n.depth - 1))
LEFT JOIN e ON e.key = n.key LEFT JOIN k ON k.key = n.key JOIN b ON b.key = n.key
"""
