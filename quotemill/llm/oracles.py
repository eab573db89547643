"""The same results as SQL over the same tables, where SQL can express the operator."""

from __future__ import annotations

ORACLES: dict[str, str] = {
    "op1_url_filter": r"""
WITH split AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), raw AS (
  SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw_host FROM split
), parts AS (
  SELECT page_id, translate(raw_host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(substr(rest, length(raw_host) + 1), '^[^?#]*') AS path FROM raw
), rules(site, start, says) AS (
  VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
    ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
), matched AS (
  SELECT p.page_id, p.host, p.path, arg_max(site || start, length(site || start)) AS rule,
    arg_max(says, length(site || start)) AS says
  FROM parts p LEFT JOIN rules r
    ON (p.host = r.site OR ends_with(p.host, '.' || r.site)) AND starts_with(p.path, r.start)
  GROUP BY ALL
)
SELECT page_id, host, path, rule, coalesce(says, CASE WHEN list_has_any(string_split(host, '.'),
    ['spam-farm', 'cheap-pills', 'casino', 'free-money']) THEN 'block' ELSE 'allow' END) AS verdict
FROM matched
""",
    "op10_quality": r"""
WITH base AS (
  SELECT doc_id, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), word AS (
  SELECT doc_id, unnest(words) AS w, generate_subscripts(words, 1) AS pos FROM base
), gram AS (
  SELECT doc_id, pos, w || ' ' || lead(w) OVER d || ' ' || lead(w, 2) OVER d AS g FROM word
  WINDOW d AS (PARTITION BY doc_id ORDER BY pos)
), twice AS (
  SELECT doc_id, pos FROM (
    SELECT doc_id, pos, count(*) OVER (PARTITION BY doc_id, g) AS n FROM gram WHERE g IS NOT NULL
  ) c WHERE n > 1
), covered AS (
  SELECT doc_id, count(*) AS n_repeat_words FROM (
    SELECT DISTINCT doc_id, pos + k AS at FROM twice, (VALUES (0), (1), (2)) t(k)
  ) u GROUP BY doc_id
), line AS (
  SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT l) AS n_dup_lines FROM (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS l FROM base
  ) s WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY doc_id
), figures AS (
  SELECT doc_id, text, words, CAST(len(words) AS BIGINT) AS n_words,
    CAST(coalesce(list_sum(list_transform(words, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
    CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
    coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_lines, 0) AS n_lines,
    coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM base LEFT JOIN line USING (doc_id) LEFT JOIN covered USING (doc_id)
), judged AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    10 * n_symbols > n_words
    OR word_chars < 2 * n_words OR word_chars > 15 * n_words
    OR 10 * n_dup_lines > 3 * n_lines
    OR 100 * len(regexp_extract_all(text, '[0-9]')) > 30 * word_chars
    OR 100 * len(list_filter(words, lambda x: NOT regexp_matches(x, '[A-Za-z\x{80}-\x{10FFFF}]'))) > 20 * n_words
    AS rejected
  FROM figures
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT rejected AS kept
FROM judged
""",
    "op11_collocations": r"""
WITH piece AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS p
  FROM documents
), words AS (
  SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM piece
), total AS (
  SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM words GROUP BY lang
), f AS (
  SELECT lang, size, phrase, CAST(count(*) AS BIGINT) AS f FROM (
    SELECT lang, size, unnest(list_transform(range(1, len(w) - size + 2), lambda i: array_to_string(w[i:i + size - 1], ' '))) AS phrase
    FROM words, (VALUES (1), (2), (3), (4)) s(size) WHERE len(w) >= size
  ) g GROUP BY ALL
), candidate AS (
  SELECT lang, size, phrase, string_split(phrase, ' ') AS w, f AS a FROM f WHERE size > 1 AND f >= 30
), halves AS (
  SELECT lang, phrase, a, k, array_to_string(w[1:k], ' ') AS head, array_to_string(w[k + 1:], ' ') AS rest
  FROM candidate, (VALUES (1), (2), (3)) t(k) WHERE k < size
), cut AS (
  SELECT h.lang, h.phrase, h.a, h.k, x.f AS l, y.f AS r, CAST(CAST(2000000 AS HUGEINT) * h.a // (x.f + y.f) AS BIGINT) AS score
  FROM halves h JOIN f x ON x.lang = h.lang AND x.phrase = h.head JOIN f y ON y.lang = h.lang AND y.phrase = h.rest
), best AS (
  SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), inside AS (
  SELECT lang, array_to_string(w[s:s + m - 1], ' ') AS phrase, max(a) AS longer
  FROM candidate, (VALUES (1), (2), (3)) t(s), (VALUES (2), (3)) u(m) WHERE m < size AND s + m - 1 <= size GROUP BY ALL
), kept AS (
  SELECT b.* FROM best b LEFT JOIN inside i USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 80 * a
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN total USING (lang) WHERE rank <= 2000
""",
    "op12_decontamination": r"""
WITH item AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), win AS (
  SELECT DISTINCT item_id, size, unnest(list_transform(range(1, len(w) - size + 2), lambda i: array_to_string(w[i:i + size - 1], ' '))) AS win
  FROM (SELECT item_id, w, least(len(w), 10) AS size FROM item WHERE len(w) > 0) i
), doc AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), run AS (
  SELECT doc_id, size, start, array_to_string(w[start:start + size - 1], ' ') AS win
  FROM (SELECT doc_id, size, w, unnest(range(1, len(w) - size + 2)) AS start FROM doc, (SELECT DISTINCT size FROM win) s) r
), found AS (
  SELECT doc_id, start, size, win FROM run WHERE win IN (SELECT win FROM win)
), hit AS (
  SELECT doc_id, count(DISTINCT start + k) AS n_hit FROM found, range(0, 10) t(k) WHERE k < size GROUP BY doc_id
), named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (
    SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found JOIN win USING (win)
  ) d GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM doc LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
""",
}
