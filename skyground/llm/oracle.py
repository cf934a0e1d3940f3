"""The corpus queries as DuckDB SQL, where SQL can state them."""

from __future__ import annotations

from skyground.llm.line_dedup import MIN_CHARS, MIN_SITES
from skyground.llm.secret_scan import ACCESS, ASSIGN, FEW_DOCS, HEX, MANY_DOCS, MAX_OWNERS, TOKEN

LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

CODE_SEARCH = """
WITH v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x <> 0)) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, r.vec_id, list_inner_product(q.e, r.e) AS score
  FROM v q JOIN v r ON q.vec_id <> r.vec_id AND len(q.e) = len(r.e) WHERE q.vec_id % 20 = 0
), o AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score FROM s
)
SELECT query_id, rank, vec_id, score FROM o WHERE rank <= 20
"""

EXACT_DEDUP = f"""
WITH d AS (SELECT doc_id, sha256({LOWERED}) AS text_sha256 FROM documents)
SELECT doc_id,
       max(doc_id) OVER w AS keep_id,
       count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept,
       text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256)
"""

LINE_DEDUP = f"""
WITH l AS (
  SELECT doc_id, source, trim(line, ' ') AS line, line AS raw, pos
  FROM (SELECT doc_id, source, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
               generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents)
), b AS (
  SELECT line FROM l WHERE length(line) >= {MIN_CHARS}
  GROUP BY line HAVING count(DISTINCT coalesce(source, '')) >= {MIN_SITES}
)
SELECT doc_id, count(*) AS n_lines, count(b.line) AS n_removed,
       sha256(coalesce(string_agg(raw, chr(10) ORDER BY pos) FILTER (WHERE b.line IS NULL), '')) AS kept_sha256
FROM l LEFT JOIN b USING (line) GROUP BY doc_id
"""


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def _spans(kind: str, rank: int, pattern: str, secret: str, keep: str) -> str:
    """Matches with their places: a match starts where the pieces and matches before it end."""
    p = _quoted(pattern)
    return f"""
  SELECT row, source, '{kind}' AS kind, {rank} AS rank, start, start + length(m) AS stop, secret FROM (
    SELECT row, source, m, secret,
           sum(length(piece)) OVER w + coalesce(sum(length(m)) OVER (
             PARTITION BY row ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
    FROM (
      SELECT row, source, unnest(regexp_extract_all(text, {p})) AS m,
             unnest(regexp_extract_all(text, {p}, {secret})) AS secret,
             unnest(string_split_regex(text, {p})[1:len(regexp_extract_all(text, {p}))]) AS piece,
             generate_subscripts(regexp_extract_all(text, {p}), 1) AS i
      FROM d WHERE regexp_matches(text, {p})
    ) WINDOW w AS (PARTITION BY row ORDER BY i)
  ) WHERE {keep}"""


SECRET_SCAN = f"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, coalesce(source, '') AS source, coalesce(text, '') AS text
           FROM documents),
base AS ({
    " UNION ALL ".join(
        (
            _spans("assign", 0, ASSIGN, "2", "length(secret) >= 8"),
            _spans("access", 1, ACCESS, "0", "length(m) >= 16"),
            _spans("hex", 2, HEX, "0", "length(m) >= 32"),
        )
    )
}),
tokens AS (SELECT * FROM ({
    _spans(
        "owned",
        3,
        TOKEN,
        "0",
        "regexp_matches(m, '[A-Z]') AND regexp_matches(m, '[a-z]') AND regexp_matches(m, '[0-9]')",
    )
}) t WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.row = t.row AND b.start < t.stop AND t.start < b.stop)),
owners AS (
  SELECT secret, count(DISTINCT source) AS n_owners, count(DISTINCT row) AS n_docs
  FROM (FROM base UNION ALL FROM tokens) GROUP BY secret
),
spans AS (
  SELECT s.*, n_owners, n_docs,
         (n_owners <= {MAX_OWNERS} OR (n_owners <= {MAX_OWNERS} + 1 AND n_docs <= {FEW_DOCS})) AND n_docs < {MANY_DOCS} AS live
  FROM (FROM base UNION ALL FROM tokens) s JOIN owners USING (secret)
),
grouped AS (
  SELECT row,
         count(*) FILTER (WHERE kind = 'assign') AS n_assign,
         count(*) FILTER (WHERE kind = 'access') AS n_access,
         count(*) FILTER (WHERE kind = 'hex') AS n_hex,
         count(*) FILTER (WHERE kind = 'owned' AND live) AS n_owned,
         count(*) FILTER (WHERE kind <> 'owned' AND live) AS n_live,
         count(*) FILTER (WHERE kind <> 'owned' AND NOT live) AS n_example,
         max(n_docs) AS n_docs, max(n_owners) AS n_owners,
         string_agg(concat_ws(':', kind, start::BIGINT, stop::BIGINT), ',' ORDER BY start, rank)
           FILTER (WHERE kind <> 'owned') AS base,
         string_agg(concat_ws(':', kind, start::BIGINT, stop::BIGINT), ',' ORDER BY start, rank)
           FILTER (WHERE kind <> 'owned' OR live) AS spans
  FROM spans GROUP BY row
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans,
       coalesce(n_owned, 0) AS n_owned, coalesce(n_live, 0) AS n_live, coalesce(n_example, 0) AS n_example,
       coalesce(n_docs, 0) AS n_docs, coalesce(n_owners, 0) AS n_owners
FROM d LEFT JOIN grouped USING (row)
"""

URL_LISTS = r"""
WITH p AS (
  SELECT row_number() OVER () AS row, page_id,
         nullif(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#@]*@)?([^/:?#]+)', 2)), '') AS host,
         list_filter(string_split(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), '/'),
                     lambda s: s <> '') AS segments,
         string_split(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), '/')[2] AS segment,
         TIMESTAMP '2024-01-01' + to_days((page_id * 7919 % 365)::INT) AS t
  FROM pages
), names AS (
  SELECT 'host' AS kind, 'block' AS verdict, 2 AS every, host AS pattern FROM p WHERE host IS NOT NULL
  UNION SELECT 'domain', 'block', 3, array_to_string(string_split(host, '.')[-2:], '.') FROM p WHERE host IS NOT NULL
  UNION SELECT 'prefix', 'allow', 3, host || '/' || segment FROM p WHERE segment <> '' AND host IS NOT NULL
), coded AS (
  SELECT *, ('0x' || substr(md5(pattern), 1, 6))::INT AS c FROM names
), entries AS (
  SELECT kind, verdict, pattern, TIMESTAMP '2024-01-01' + to_days(c % 200 + lo) AS since,
         CASE WHEN lo = 0 THEN TIMESTAMP '2024-01-01' + to_days(c % 200 + 60) ELSE TIMESTAMP '9999-12-31' END AS until
  FROM coded, (VALUES (0), (120)) v(lo) WHERE c % every = 0
), asked AS (
  SELECT row, t, 'host' AS kind, host AS pattern FROM p WHERE host IS NOT NULL
  UNION SELECT row, t, 'domain', array_to_string(string_split(host, '.')[i:], '.')
    FROM p, range(1, 12) r(i) WHERE i <= len(string_split(host, '.'))
  UNION SELECT row, t, 'prefix', host || '/' || array_to_string(segments[:i], '/')
    FROM p, range(1, 50) r(i) WHERE i <= len(segments) AND host IS NOT NULL
), best AS (
  SELECT row, count(*) AS n_active,
         max(struct_pack(long := length(pattern), lenient := verdict = 'allow', kind := kind, pattern := pattern,
                         verdict := verdict, since := since)) AS b
  FROM asked JOIN entries USING (kind, pattern) WHERE since <= t AND t < until GROUP BY row
)
SELECT page_id, host, b.verdict AS verdict, b.kind AS kind, b.pattern AS pattern, coalesce(n_active, 0) AS n_active
FROM p LEFT JOIN best USING (row)
"""

QUALITY_RULES = r"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents),
t AS (
  SELECT row, doc_id, text,
         list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words,
         list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
  FROM d
), windows AS (
  SELECT row, i, array_to_string(words[i:i + 7], ' ') AS window8
  FROM (SELECT row, words, unnest(range(1, len(words) - 6)) AS i FROM t)
), repeated AS (
  SELECT row, i, lead(i) OVER (PARTITION BY row ORDER BY i) AS next_i
  FROM (SELECT row, i, count(*) OVER (PARTITION BY row, window8) AS n FROM windows) WHERE n > 1
), covered AS (
  SELECT row, sum(least(8, coalesce(next_i - i, 8)))::BIGINT AS n FROM repeated GROUP BY row
), m AS (
  SELECT doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
         length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words,
         len(lines) AS n_lines,
         len(list_filter(words, lambda w: NOT regexp_matches(w, '\p{L}'))) AS n_letterless,
         len(list_filter(lines, lambda l: regexp_matches(l, '^[\x20\x09\x0B-\x0D]*[-*•‣▪●][\x20\x09-\x0D]'))) AS n_bullets,
         len(list_filter(lines, lambda l: regexp_matches(l, '(\.\.\.|…)[\x20\x09\x0B-\x0D]*$'))) AS n_ellipses
  FROM t LEFT JOIN covered USING (row)
), j AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR word_chars < 3 * n_words OR word_chars > 10 * n_words OR 10 * n_symbols > n_words
            OR 100 * n_dup_lines > 30 * n_lines OR 100 * n_letterless > 20 * n_words
            OR 100 * n_bullets > 90 * n_lines OR 100 * n_ellipses > 30 * n_lines) AS kept
FROM j
"""

HARD_NEGATIVES = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same, list_inner_product(a.e, r.e)::BIGINT AS score
  FROM v a JOIN v r ON a.vec_id <> r.vec_id WHERE a.vec_id % 50 = 0
), p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id,
       (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id))::INT AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
"""

ORACLE: dict[str, str] = {
    "op1_code_search": CODE_SEARCH,
    "op2_exact_dedup": EXACT_DEDUP,
    "op4_line_dedup": LINE_DEDUP,
    "op5_secret_scan": SECRET_SCAN,
    "op10_url_lists": URL_LISTS,
    "op12_quality_rules": QUALITY_RULES,
    "op13_hard_negatives": HARD_NEGATIVES,
}
