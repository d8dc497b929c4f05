"""The queries of this subpackage that SQL can express, in SQL for DuckDB."""

WARC_FIXITY = r"""
WITH p AS (
  SELECT page_id, url, coalesce(html, '') AS html, left(md5(coalesce(url, '')), 2) AS mark FROM pages
), c AS (
  SELECT *, CASE mark
    WHEN '01' THEN left(html, CAST(floor(length(html) / 2) AS BIGINT))
    WHEN '02' THEN left(html, greatest(length(html) - 1, 0)) || '~'
    ELSE html END AS changed
  FROM p
), h AS (
  SELECT *, 'WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: resource' || chr(13) || chr(10)
    || 'WARC-Record-ID: <urn:page:' || coalesce(CAST(page_id AS VARCHAR), '') || '>' || chr(13) || chr(10)
    || 'WARC-Target-URI: ' || coalesce(url, '') || chr(13) || chr(10)
    || 'WARC-Date: 1970-01-01T00:00:00Z' || chr(13) || chr(10)
    || 'Content-Type: text/html' || chr(13) || chr(10) || 'Content-Length: ' AS head
  FROM c
), r AS (
  SELECT page_id, url, mark,
    head || strlen(html) || chr(13) || chr(10) || chr(13) || chr(10) || html
      || chr(13) || chr(10) || chr(13) || chr(10) AS record,
    head || strlen(changed) || chr(13) || chr(10) || chr(13) || chr(10) || changed
      || chr(13) || chr(10) || chr(13) || chr(10) AS other
  FROM h
), d AS (
  SELECT page_id, url, mark, CAST(strlen(record) AS BIGINT) AS length, sha256(record) AS digest,
    sha256(other) AS other_digest
  FROM r
), n AS (
  SELECT *, row_number() OVER (ORDER BY page_id NULLS FIRST, url NULLS FIRST, digest) - 1 AS number FROM d
), f AS (
  SELECT *, CAST(number // 1000 AS BIGINT) AS file FROM n
)
SELECT page_id, url, file,
  CAST(coalesce(sum(length) OVER (PARTITION BY file ORDER BY number
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS "offset",
  length, digest,
  CASE WHEN mark = '00' THEN 'missing' WHEN digest <> other_digest THEN 'damaged' ELSE 'intact' END AS state
FROM f
"""

_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
  'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

DECONTAMINATION = f"""
WITH dw AS (
  SELECT doc_id, {_WORDS} AS w FROM documents
), bw AS (
  SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark
), bs AS (
  SELECT item, w, least(len(w), 10) AS size FROM bw WHERE len(w) > 0
), bwin AS (
  SELECT DISTINCT item, size, array_to_string(w[p : p + size - 1], ' ') AS win
  FROM (SELECT item, w, size, unnest(range(1, len(w) - size + 2)) AS p FROM bs)
), dwin AS (
  SELECT doc_id, p, size, array_to_string(w[p : p + size - 1], ' ') AS win
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS p
        FROM dw, (SELECT DISTINCT size FROM bwin) WHERE len(w) >= size)
), hits AS (
  SELECT doc_id, p, size, item FROM dwin JOIN bwin USING (size, win)
), cover AS (
  SELECT doc_id, count(DISTINCT q) AS n_hit
  FROM (SELECT doc_id, unnest(range(p, p + size)) AS q FROM hits) GROUP BY doc_id
), found AS (
  SELECT doc_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256
  FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, coalesce(items_sha256, sha256('')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN cover USING (doc_id) LEFT JOIN found USING (doc_id)
"""

HARD_NEGATIVES = """
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same,
    CAST(list_dot_product(a.v, r.v) AS BIGINT) AS score
  FROM e AS a JOIN e AS r ON a.vec_id <> r.vec_id WHERE a.vec_id % 100 = 0
), p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id,
  CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""

FILL_IN_MIDDLE = """
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents
), g AS (
  SELECT doc_id, t, length(t) AS n, CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
    CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4
  FROM d
), c AS (
  SELECT doc_id, t, n, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
    CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
      WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM g
), p AS (
  SELECT *, substring(t, 1, a) AS pre, substring(t, a + 1, b - a) AS mid, substring(t, b + 1) AS suf FROM c
)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
  CASE WHEN form <> 'plain' THEN CAST(a AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(b - a AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
    ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM p
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op3_warc_fixity": WARC_FIXITY,
        "op7_decontamination": DECONTAMINATION,
        "op11_hard_negatives": HARD_NEGATIVES,
        "op12_fill_in_middle": FILL_IN_MIDDLE,
    }
