"""DuckDB SQL with the rows of the registered corpus queries, where SQL can express them."""

from __future__ import annotations

from millrace.llm.licences import TEMPLATES, template_bigrams

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

QUALITY = rf"""
WITH w AS (SELECT doc_id, source, coalesce(text, '') AS text, {WORDS} AS w FROM documents),
numbered AS (SELECT row_number() OVER () AS r, * FROM w),
places AS (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM numbered WHERE len(w) >= 3),
grams AS (SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g FROM places),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS c FROM grams) WHERE c > 1),
covered AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY r),
lines AS (SELECT r, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM numbered),
m AS (
  SELECT n.doc_id, n.source, len(n.w)::BIGINT AS n_words, length(array_to_string(n.w, ''))::BIGINT AS word_chars,
         length(regexp_replace(n.text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         (len(l.l) - len(list_distinct(l.l)))::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words,
         len(l.l) AS n_lines
  FROM numbered n JOIN lines l USING (r) LEFT JOIN covered c USING (r)),
f AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
         [n_words < 50, 100 * n_repeat_words > 50 * n_words, 10 * n_symbols > n_words,
          10 * n_dup_lines > 3 * n_lines, word_chars > 12 * n_words OR word_chars < 2 * n_words] AS fails
  FROM m),
flags AS (SELECT source, unnest(range(1, 6)) AS rule, unnest(fails) AS failed FROM f WHERE source IS NOT NULL),
hosts AS (SELECT source, rule, count(*) AS n, count_if(failed) AS k FROM flags GROUP BY ALL),
means AS (SELECT rule, sum(k) / sum(n) AS m, count(*) AS h, sum(n) AS t FROM hosts GROUP BY rule),
spread AS (SELECT rule, any_value(m) AS m, any_value(h) AS h, any_value(t) AS t, sum(n * pow(k / n - m, 2)) AS s
           FROM hosts JOIN means USING (rule) GROUP BY rule),
prior AS (SELECT rule, m, CASE WHEN s - m * (1 - m) * h > 0
          THEN least(1e6, greatest(1.0, m * (1 - m) / ((s - m * (1 - m) * h) / t) - 1)) ELSE 1e6 END AS strength FROM spread),
bad AS (SELECT DISTINCT source FROM hosts JOIN prior USING (rule) WHERE (k + m * strength) / (n + strength) > 0.5)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       bad.source IS NOT NULL AS host_rejected, NOT base_failed AND bad.source IS NULL AS kept
FROM f LEFT JOIN bad ON f.source = bad.source
"""

URLS = r"""
WITH rules(rule, verdict) AS (VALUES ('com/', 'allow'), ('example.com/en/', 'block'), ('www.example.com/en/', 'allow'),
                                     ('net/es/', 'block'), ('net/fr/', 'block')),
parts AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
split AS (SELECT row_number() OVER () AS r, page_id,
                 translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                 regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM parts),
fits AS (SELECT r, rule, verdict FROM split JOIN rules
         ON (host = split_part(rule, '/', 1) OR ends_with(host, '.' || split_part(rule, '/', 1)))
         AND starts_with(path, substr(rule, strpos(rule, '/')))),
best AS (SELECT r, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict FROM fits GROUP BY r)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM split LEFT JOIN best USING (r)
"""

_TEMPLATES = ", ".join(
    f"({i}, '{name}', [{', '.join(repr(g) for g in template_bigrams(text))}])" for i, (name, text) in enumerate(TEMPLATES)
)

LICENCES = rf"""
WITH templates(i, licence, grams) AS (VALUES {_TEMPLATES}),
texts AS (SELECT row_number() OVER () AS r, doc_id,
                 regexp_replace(lower(coalesce(text, '')), '[^\p{{L}}\p{{N}}\n]+', ' ', 'g') AS t FROM documents),
lines AS (
  SELECT r, unnest(range(1, len(string_split(t, chr(10))) + 1)) AS line, unnest(string_split(t, chr(10))) AS u FROM texts
  UNION ALL SELECT r, 0, replace(t, chr(10), ' ') FROM texts WHERE contains(t, chr(10))),
units AS (SELECT r, line, list_distinct(list_transform(range(1, len(w)), lambda k: w[k] || ' ' || w[k + 1])) AS g
          FROM (SELECT r, line, regexp_extract_all(u, '[^ ]+') AS w FROM lines)),
scored AS (SELECT r, line, i, licence, 2.0 * len(list_intersect(g, grams)) / (len(g) + len(grams)) AS dice
           FROM units JOIN templates ON list_has_any(g, grams)),
best AS (SELECT r, line, arg_max(licence, dice - i / 1e6) AS licence, max(dice) AS dice FROM scored WHERE dice >= 0.8 - 1e-9 GROUP BY r, line),
found AS (SELECT r, count(*) AS n_found, arg_min(licence, line) AS licence, arg_min(dice, line)::DOUBLE AS dice,
                 string_agg(line || ':' || licence, ',' ORDER BY line) AS lines FROM best GROUP BY r)
SELECT doc_id, coalesce(n_found, 0)::BIGINT AS n_found, found.licence AS licence, coalesce(lines, '') AS lines, dice
FROM texts LEFT JOIN found USING (r)
"""

_PLAIN = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_NORMAL = rf"regexp_extract_all({_PLAIN}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

LEAKS = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_NORMAL} AS w FROM documents),
i AS (SELECT item_id, w, least(10, len(w)) AS k FROM (SELECT item_id, {_NORMAL} AS w FROM benchmark) WHERE len(w) > 0),
grams AS (SELECT DISTINCT item_id, k, array_to_string(w[p:p + k - 1], ' ') AS g
          FROM (SELECT *, unnest(range(1, len(w) - k + 2)) AS p FROM i)),
places AS (SELECT r, k, p, array_to_string(w[p:p + k - 1], ' ') AS g
           FROM (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS p FROM d, (SELECT DISTINCT k FROM grams))),
hits AS (SELECT r, p, k, item_id FROM places JOIN grams USING (k, g)),
covered AS (SELECT r, count(DISTINCT q) AS n FROM (SELECT r, unnest(range(p, p + k)) AS q FROM hits) GROUP BY r),
named AS (SELECT r, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items
          FROM (SELECT DISTINCT r, item_id::VARCHAR AS item FROM hits WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(covered.n, 0)::BIGINT AS n_hit, coalesce(named.n, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, covered.n IS NOT NULL AS contaminated
FROM d LEFT JOIN covered USING (r) LEFT JOIN named USING (r)
"""

ORACLE: dict[str, str] = {"op1_quality_rules": QUALITY, "op8_licence_scan": LICENCES, "op9_url_cascade": URLS, "op13_benchmark_leaks": LEAKS}
