"""DuckDB SQL for the queries that SQL can express. Bounds and lists come from the operators' parameters."""

from __future__ import annotations

from lodestrata.llm import rules, urls

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _texts(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def url_filter() -> str:
    table = ", ".join(f"('{v}', '{r}', '{r.partition('/')[0]}', '/{r.partition('/')[2]}')" for v, r in urls.RULES)
    listed = " OR ".join(f"host = '{h}' OR ends_with(host, '.{h}')" for h in urls.BLOCKED_HOSTS)
    return f"""
WITH split AS (
  SELECT page_id,
    coalesce(translate(regexp_extract(url, '://([^/?#]*)', 1), '{_UPPER}', '{_LOWER}'), '') AS host,
    coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages
), rules(verdict, rule, rule_host, rule_path) AS (VALUES {table}),
fits AS (
  SELECT s.page_id, arg_max(r.rule, length(r.rule)) AS rule, arg_max(r.verdict, length(r.rule)) AS verdict
  FROM split s JOIN rules r ON (s.host = r.rule_host OR ends_with(s.host, '.' || r.rule_host)) AND starts_with(s.path, r.rule_path)
  GROUP BY s.page_id
)
SELECT s.page_id, s.host, s.path, f.rule, coalesce(f.verdict, CASE WHEN {listed} THEN 'block' ELSE 'allow' END) AS verdict
FROM split s LEFT JOIN fits f USING (page_id)
"""


def quality_rules() -> str:
    bounds = []
    for rule in rules.TABLE:
        above, below = rule.ratio.split(" / ")
        bounds.append(f"(CASE WHEN {below} > 0 THEN {above}::DOUBLE / {below} ELSE 0 END BETWEEN {rule.low} AND {rule.high})")
    word = rules.WORD.replace("+", "")
    return f"""
WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{rules.WORD}') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{word}')) AS lines
  FROM documents
), places AS (
  SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM texts
), windows AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i], w[i + 1], w[i + 2]) AS n FROM places
), covered AS (
  SELECT doc_id, count(DISTINCT j) AS n_repeat_words FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS j FROM windows WHERE n > 1) GROUP BY doc_id
), counted AS (
  SELECT t.doc_id, len(w)::BIGINT AS n_words,
    length(regexp_replace(t, '[\\x20\\x09-\\x0D]', '', 'g'))::BIGINT AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    length(regexp_replace(t, '[^A-Z]', '', 'g'))::BIGINT AS n_upper,
    len(list_filter(w, lambda x: x IN ({_texts(rules.STOP_FORMS)})))::BIGINT AS n_stop_words,
    len(lines)::BIGINT AS n_lines, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
    coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
  FROM texts t LEFT JOIN covered USING (doc_id)
), failed AS (
  SELECT *, n_words < {rules.MIN_WORDS} OR 100 * n_repeat_words > {rules.MAX_REPEAT_PERCENT} * n_words AS base_failed FROM counted
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND {' AND '.join(bounds)} AS kept FROM failed
"""


def archives() -> str:
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    number = "('0x' || substr(hex40, 5 * k + 1, 5))::BIGINT"
    quad = " || ".join(f"substr('{letters}', (({number} >> {s}) & 31)::INT + 1, 1)" for s in (15, 10, 5, 0))
    base32 = " || ".join(f"({quad.replace('5 * k + 1', str(5 * k + 1))})" for k in range(8))
    return f"""
WITH payloads AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
hashed AS (SELECT page_id, payload, octet_length(encode(payload))::BIGINT AS payload_bytes, sha1(payload) AS hex40, max(page_id) OVER (PARTITION BY payload) AS top FROM payloads)
SELECT page_id, payload_bytes, {base32} AS payload_digest,
  CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> top THEN top END AS refers_to
FROM hashed
"""
