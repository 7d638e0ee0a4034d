"""SQL for the queries that SQL can express over whole tables."""

from __future__ import annotations

OP5 = r"""
WITH cut AS (
    SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
    FROM pages
), parts AS (
    SELECT page_id,
        translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
    FROM cut
), judged AS (
    SELECT page_id, host, path, CASE
        WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/es/') THEN 'example.org/es/'
        WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/en/1') THEN 'example.org/en/1'
        WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/fr/') THEN 'com/fr/'
        WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/de/') THEN 'com/de/'
        WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/') THEN 'org/'
        END AS rule
    FROM parts
)
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('org/', 'com/fr/') THEN 'allow'
    WHEN rule IS NOT NULL THEN 'block'
    WHEN regexp_matches(host || ' ' || path, '(^|\.)spam-farm\.|(^|\.)cheap-pills\.|(^|\.)[a-z0-9-]*\bfree-money\b'
        || '|(^|\.)([a-z0-9]+-)*casino(-[a-z0-9]+)*\.| /([^/]+/)*wp-login\.php$'
        || '| /([^/]+/)*checkout/session-[0-9a-f]{8,}') THEN 'block'
    ELSE 'allow' END AS verdict
FROM judged
"""


#: Figures of whole texts, failures by source, and the beta-binomial prior of all sources.
OP11 = r"""
WITH texts AS (
    SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t FROM documents
), words AS (
    SELECT r, doc_id, source, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM texts
), windows AS (
    SELECT r, unnest(range(1, len(w) - 1)) AS i, w FROM words WHERE len(w) >= 3
), found AS (
    SELECT r, i, count(*) OVER (PARTITION BY r, w[i], w[i + 1], w[i + 2]) AS c FROM windows
), covered AS (
    SELECT r, count(DISTINCT p) AS n_repeat_words FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM found WHERE c > 1) GROUP BY r
), lines AS (
    SELECT r, unnest(string_split(t, chr(10))) AS line FROM texts
), repeated AS (
    SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
    FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r
), figures AS (
    SELECT doc_id, source, len(w) AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
        length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
        coalesce(n_lines, 0) AS n_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
    FROM words LEFT JOIN covered USING (r) LEFT JOIN repeated USING (r)
), failed AS (
    SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
        [n_words < 50, 100 * n_repeat_words > 50 * n_words, 10 * n_symbols > word_chars, 2 * n_dup_lines > n_lines] AS rules
    FROM figures
), hosts AS (
    SELECT source, rule, count(*) AS n, count(*) FILTER (WHERE rules[rule]) AS f
    FROM failed, range(1, 5) AS g(rule) WHERE source IS NOT NULL GROUP BY source, rule
), sums AS (
    SELECT rule, count(*) AS k, sum(n)::DOUBLE AS docs, sum(f) / sum(n) AS p, sum(n * n)::DOUBLE AS squares, sum(f * f / n) AS s
    FROM hosts GROUP BY rule
), priors AS (
    SELECT rule, p, least(greatest(CASE WHEN docs - squares / docs - (k - 1) > 0
        THEN ((s - docs * p * p) / nullif(p * (1 - p), 0) - (k - 1)) / (docs - squares / docs - (k - 1)) ELSE 0 END, 1e-6), 0.5) AS rho
    FROM sums
), verdicts AS (
    SELECT source, bool_or(CASE WHEN p = 0 OR p = 1 THEN p ELSE (f + p * (1 / rho - 1)) / (n + 1 / rho - 1) END > 0.5) AS rejected
    FROM hosts JOIN priors USING (rule) GROUP BY source
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND NOT coalesce(rejected, false) AS kept
FROM failed LEFT JOIN verdicts USING (source)
"""

#: The checksum is spelled out by its polynomial; near words meet by equal rests, and roots follow forms recursively.
OP13 = r"""
WITH RECURSIVE bits AS (
    SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, b:
        CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)) AS t
), runs AS (
    SELECT coalesce(doc_id::VARCHAR, '') AS id,
        translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]{5,}')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
    FROM documents
), counted AS (
    SELECT id, run, hex(encode(id || ':' || run)) AS x, count(*) AS n FROM runs GROUP BY id, run
), hashed AS (
    SELECT run, n, xor(list_reduce(list_transform(range(length(x) // 2), lambda i: ('0x' || x[2 * i + 1 : 2 * i + 2])::BIGINT),
        lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) AS h
    FROM counted, bits
), seen AS (
    SELECT CASE WHEN h % 97 = 0 THEN run[: h % length(run)] || run[h % length(run) + 2 :] ELSE run END AS word, n FROM hashed
), words AS (
    SELECT word, sum(n)::BIGINT AS n FROM seen WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3
), spots AS (
    SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words
), rests AS (
    SELECT word, n, i, word[: i - 1] || word[i + 1 :] AS rest FROM spots
), near AS (
    SELECT a.word, b.word AS other, b.n AS other_n FROM rests a JOIN rests b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
    UNION SELECT a.word, b.word, b.n FROM rests a JOIN words b ON a.rest = b.word
    UNION SELECT b.word, a.word, a.n FROM rests a JOIN words b ON a.rest = b.word
), best AS (
    SELECT word, count(*) AS n_near, max(other_n) AS most FROM near GROUP BY word
), led AS (
    SELECT word, min(other) AS other, most FROM near JOIN best USING (word) WHERE other_n = most GROUP BY word, most
), forms AS (
    SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN led.most >= 2 * n THEN other END AS form,
        CASE WHEN led.most >= 2 * n THEN led.most END AS form_n
    FROM words LEFT JOIN best USING (word) LEFT JOIN led USING (word)
), walk AS (
    SELECT word, word AS root FROM words
    UNION ALL SELECT walk.word, form FROM walk JOIN forms ON forms.word = walk.root WHERE form IS NOT NULL
), roots AS (
    SELECT walk.word, root FROM walk JOIN forms ON forms.word = root WHERE form IS NULL
)
SELECT word, n, n_near, form, form_n, root FROM forms JOIN roots USING (word)
"""


def oracle_sql() -> dict[str, str]:
    return {"op5_urls": OP5, "op11_host_rules": OP11, "op13_spelling": OP13}
