"""DuckDB SQL for the queries that SQL can express."""

ORACLES: dict[str, str] = {}

# Every step is written out: lines with words, the rule each breaks, windows of three words.
ORACLES["op10_quality_rules"] = r"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents
), words AS (
  SELECT rid, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM docs
), grams AS (
  SELECT rid, unnest(range(1, len(w) - 1)) AS i, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) AS g
  FROM words WHERE len(w) >= 3
), again AS (
  SELECT rid, i FROM grams QUALIFY count(*) OVER (PARTITION BY rid, g) > 1
), covered AS (
  SELECT rid, count(DISTINCT i + k) AS n_repeat_words FROM again, (VALUES (0), (1), (2)) AS v(k) GROUP BY rid
), lines AS (
  SELECT rid, line, count(*) AS n FROM (SELECT rid, unnest(string_split(t, chr(10))) AS line FROM docs)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY rid, line
), sized AS (
  SELECT *, length(regexp_replace(line, '[\x20\x09-\x0D]', '', 'g')) AS chars,
    length(line) - length(regexp_replace(line, '[#*$%&|<>]', '', 'g')) AS symbols,
    len(list_filter(regexp_split_to_array(line, '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS n_words
  FROM lines
), judged AS (
  SELECT *, NOT (symbols > 0.08 * chars
    OR (NOT regexp_matches(line, '\p{Ll}') AND regexp_matches(line, '\p{Lu}') AND length(line) >= 16)
    OR (n_words < 6 AND NOT regexp_matches(line, '[.!?…:;]["''”’»)\]]*[\x20\x09-\x0D]*$'))
    OR (n_words < 30 AND regexp_matches(line, '(?i)\b(all rights reserved|cookies?|privacy policy|terms of (use|service)|javascript|lorem ipsum|sign (in|up)|log ?in|subscribe|click here|read more|share this|licensed under|copyright|powered by|skip to content)\b|©'))) AS good
  FROM sized
), line_sums AS (
  SELECT rid, sum(n)::BIGINT AS n_lines, (sum(n) - count(*))::BIGINT AS n_dup_lines, coalesce(sum(chars) FILTER (WHERE good), 0)::BIGINT AS good_chars
  FROM judged GROUP BY rid
), counts AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
    (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
    coalesce(n_lines, 0) AS n_lines, coalesce(good_chars, 0) AS good_chars
  FROM docs JOIN words USING (rid) LEFT JOIN covered USING (rid) LEFT JOIN line_sums USING (rid)
), failed AS (
  SELECT *, n_words < 50 OR n_repeat_words > 0.5 * n_words AS base_failed FROM counts
)
SELECT *, NOT base_failed AND word_chars - good_chars <= 0.5 * word_chars AS kept FROM failed
"""

# The entries are derived as in the query; a rule is in force if the last state at or before
# the fetch lists it.
ORACLES["op6_url_filter"] = r"""
WITH captures AS (
  SELECT DISTINCT page_id, url, (DATE '2024-01-01' + CAST(page_id * 37 % 366 AS INTEGER))::DATE AS fetched_at,
    nullif(regexp_replace(regexp_replace(regexp_replace(regexp_extract(lower(url), '^[a-z][a-z0-9+.-]*://([^/?#]*)', 1), '^.*@', ''), ':\d*$', ''), '\.$', ''), '') AS host,
    regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1) AS path
  FROM pages
), names AS (
  SELECT 'hosts' AS list_name, 'host' AS kind, host AS value FROM captures
  UNION SELECT 'domains', 'domain', regexp_extract(host, '^[^.]+\.(.+\..+)$', 1) FROM captures
  UNION SELECT 'folders', 'path', host || '/' || regexp_extract(path, '^/([^/]+)/', 1) || '/' FROM captures WHERE regexp_extract(path, '^/([^/]+)/', 1) <> ''
), digits AS (
  SELECT *, list_transform([1, 2, 3, 4, 5, 6], lambda i: strpos('0123456789abcdef', substr(md5(value), i, 1)) - 1) AS d FROM names WHERE value <> ''
), chosen AS (
  SELECT list_name, kind, value, d, d[2] * 16 + d[3] AS day FROM digits WHERE d[1] < 5
), states AS (
  SELECT list_name, kind, value, day, true AS listed FROM chosen
  UNION ALL SELECT list_name, kind, value, day + 20 + d[4], false FROM chosen WHERE d[6] < 12
  UNION ALL SELECT list_name, kind, value, day + 60 + d[5], true FROM chosen WHERE d[6] < 6
), dated AS (
  SELECT list_name, kind, value, listed, (DATE '2024-01-01' + CAST(day AS INTEGER))::DATE AS since,
    lead((DATE '2024-01-01' + CAST(day AS INTEGER))::DATE) OVER (PARTITION BY list_name, kind, value ORDER BY day) AS until
  FROM states
), keys AS (
  SELECT page_id, url, 'host' AS kind, host AS value FROM captures
  UNION SELECT page_id, url, 'domain', array_to_string(list_slice(string_split(host, '.'), i, 99), '.')
    FROM (SELECT *, unnest(range(1, len(string_split(host, '.')) + 1)) AS i FROM captures WHERE host IS NOT NULL)
  UNION SELECT page_id, url, 'path', host || '/' || array_to_string(list_slice(f, 1, i), '/') || '/'
    FROM (SELECT *, unnest(range(1, len(f) + 1)) AS i FROM (
      SELECT *, list_filter(string_split(regexp_extract(path, '(?s)^(.*)/', 1), '/'), lambda x: x <> '') AS f FROM captures WHERE host IS NOT NULL))
), met AS (
  SELECT DISTINCT page_id, url, list_name, kind, value FROM keys JOIN captures USING (page_id, url) JOIN dated USING (kind, value)
  WHERE listed AND since <= fetched_at AND (until IS NULL OR fetched_at < until)
), counted AS (
  SELECT page_id, url, count(*) AS n_rules, array_to_string(list_sort(list_distinct(list(list_name))), ',') AS lists FROM met GROUP BY page_id, url
)
SELECT page_id, url, fetched_at, n_rules IS NOT NULL AS blocked, coalesce(n_rules, 0)::BIGINT AS n_rules, coalesce(lists, '') AS lists
FROM captures LEFT JOIN counted USING (page_id, url)
"""

# Levels by recursion: nodes of a level, then each leaf's way up through the runs, twice
# (inside its language, then over the languages).
_MERKLE_FIELDS = ("CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)")


def _merkle_leaf(text: str) -> str:
    parts = [f"coalesce(strlen({v}) || ':' || {v}, '-')" for v in (*_MERKLE_FIELDS, text)]
    return f"sha256({' || '.join(parts)})"


def _merkle_climb(tree: str, start: str) -> str:
    return f"""
{tree} AS (
  {start}
  UNION ALL
  SELECT name, level + 1, idx // 8, sha256(string_agg(digest, '' ORDER BY idx)), (any_value(n) + 7) // 8
  FROM {tree} WHERE n > 1 GROUP BY name, level, idx // 8
), {tree}_runs AS (
  SELECT name, level, idx // 8 AS run, list(digest ORDER BY idx) AS d FROM {tree} WHERE n > 1 GROUP BY ALL
)"""


def _merkle_fold(fold: str, tree: str, start: str) -> str:
    return f"""
{fold} AS (
  {start}
  UNION ALL
  SELECT rid, f.name, f.level + 1, f.idx // 8,
    sha256(array_to_string(list_transform(r.d, lambda x, i: CASE WHEN i = f.idx % 8 + 1 THEN f.cur ELSE x END), '')),
    f.proof || array_to_string(list_transform(r.d, lambda x, i: CASE WHEN i = f.idx % 8 + 1 THEN '' ELSE x END), '')
  FROM {fold} f JOIN {tree}_runs r ON r.name = f.name AND r.level = f.level AND r.run = f.idx // 8
), {fold}_ends AS (
  SELECT * FROM {fold} QUALIFY row_number() OVER (PARTITION BY rid ORDER BY level DESC) = 1
)"""


_CRC = """list_reduce(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT)),
    lambda c, b: list_reduce([1, 2, 3, 4, 5, 6, 7, 8], lambda x, i: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END, xor(c, b)), CAST(4294967295 AS BIGINT))"""

ORACLES["op13_merkle_manifest"] = f"""
WITH RECURSIVE leaves AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce('=' || lang, '') AS name, {_merkle_leaf('text')} AS leaf,
    {_merkle_leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS forged,
    coalesce(xor({_CRC}, 4294967295) % 3 = 0, false) AS tampered
  FROM documents
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY name ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx FROM leaves
), {_merkle_climb("tree", "SELECT name, 0 AS level, idx, leaf AS digest, count(*) OVER (PARTITION BY name) AS n FROM placed")},
subroots AS (
  SELECT name, digest, row_number() OVER (ORDER BY name) - 1 AS idx FROM tree WHERE n = 1
), {_merkle_climb("top", "SELECT '' AS name, 0 AS level, idx, digest, count(*) OVER () AS n FROM subroots")},
{_merkle_fold("low", "tree", "SELECT rid, name, 0 AS level, idx, CASE WHEN tampered THEN forged ELSE leaf END AS cur, '' AS proof FROM placed")},
{_merkle_fold("high", "top", "SELECT rid, '' AS name, 0 AS level, s.idx, cur, proof FROM low_ends l JOIN subroots s USING (name)")}
SELECT doc_id, leaf, s.digest AS subroot, t.digest AS root, sha256(h.proof) AS proof_sha256, h.cur AS folded_root, h.cur = t.digest AS verified
FROM placed p JOIN subroots s USING (name) JOIN high_ends h USING (rid) JOIN top t ON t.n = 1
"""
