"""SQL for the operators that SQL can express, written from their definitions and not from their plans."""

from __future__ import annotations

from . import licenses, mixing, urls


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


# Every rule against every url.
URLS = f"""
WITH rules(deciding, rank, name, verdict, regex) AS (VALUES {", ".join(
    f"({int(r.deciding)}, {len(r.name) if r.deciding else 2 if r.verdict == 'allow' else 1}, {quoted(r.name)}, {quoted(r.verdict)}, {quoted(r.regex)})"
    for r in urls.BASE_RULES + urls.PATTERN_RULES)}),
rest AS (
  SELECT row_number() OVER () AS n, page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages
),
parts AS (
  SELECT n, page_id, translate(regexp_extract(r, '^[^/?#]*'), '{urls.UPPER}', '{urls.LOWER}') AS host, substr(r, length(regexp_extract(r, '^[^/?#]*')) + 1) AS tail FROM rest
),
best AS (
  SELECT n, max({{'d': deciding, 'k': rank, 'n': name, 'v': verdict}}) AS b FROM parts, rules WHERE regexp_matches(host || tail, regex) GROUP BY n
)
SELECT page_id, host, regexp_extract(tail, '^[^?#]*') AS path, CASE WHEN b.d = 1 THEN b.n END AS rule, coalesce(b.v, 'allow') AS verdict,
       CASE WHEN b.d = 0 THEN b.n END AS pattern
FROM parts LEFT JOIN best USING (n)
"""

# All quotients are listed and ranked.
MIX = f"""
WITH RECURSIVE sizes AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
         md5('{mixing.SEED}|' || coalesce(doc_id::VARCHAR, 'null') || '|' || coalesce(text, '')) AS h
  FROM documents
),
weighed AS (
  SELECT source, sum(size)::BIGINT AS words, count(*) AS docs, [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight FROM sizes GROUP BY source
),
-- Sources above three times their words stop there, and what they leave is shared again.
sharing AS (
  SELECT 0 AS step, source, words, weight, false AS stopped, (sum(words) OVER ())::DOUBLE / (sum(weight) OVER ()) * weight AS target FROM weighed
  UNION ALL
  SELECT step + 1, source, words, weight, stopped OR target > 3 * words,
         CASE WHEN stopped OR target > 3 * words THEN 3.0::DOUBLE * words
              ELSE ((sum(words) OVER ()) - coalesce(sum(CASE WHEN stopped OR target > 3 * words THEN 3 * words END) OVER (), 0))::DOUBLE
                   / (sum(CASE WHEN stopped OR target > 3 * words THEN 0 ELSE weight END) OVER ()) * weight END
  FROM sharing WHERE step < (SELECT count(*) FROM weighed)
),
targets AS (SELECT source, words, target FROM sharing WHERE step = (SELECT count(*) FROM weighed)),
dealt AS (
  SELECT s.*, words, target, ('0x' || substr(h, 1, 8))::BIGINT % greatest(ceil(words / {mixing.SHARD_WORDS})::BIGINT, ceil(docs / {mixing.SHARD_DOCS})::BIGINT, 1) AS shard
  FROM sizes s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source JOIN weighed w USING (words) WHERE w.source IS NOT DISTINCT FROM t.source
),
shards AS (
  SELECT source, shard, ceil(sum(size) / {mixing.BLOCK_WORDS})::BIGINT AS blocks, any_value(target) * sum(size)::BIGINT / any_value(words) AS due
  FROM dealt GROUP BY source, shard HAVING sum(size) > 0
),
quotients AS (
  SELECT source, shard, row_number() OVER (ORDER BY due / (2 * k + 1) DESC, source NULLS LAST, shard, k) AS place
  FROM shards, LATERAL (SELECT unnest(range(3 * blocks + 16)) AS k)
),
won AS (
  SELECT source, shard, count(*) AS n FROM quotients
  WHERE place <= (SELECT round_even(sum(size) / {mixing.BLOCK_WORDS}.0, 0) FROM sizes) GROUP BY source, shard
),
given AS (
  SELECT s.source, s.shard, blocks, least(coalesce(n, 0), 3 * blocks) AS quota,
         ('0x' || substr(md5('{mixing.SEED}|' || coalesce(s.source, 'null') || '|' || s.shard), 1, 8))::BIGINT % blocks AS start
  FROM shards s LEFT JOIN won w ON s.source IS NOT DISTINCT FROM w.source AND s.shard = w.shard
),
placed AS (SELECT *, (sum(size) OVER (PARTITION BY source, shard ORDER BY h, size ROWS UNBOUNDED PRECEDING) - size)::BIGINT AS a FROM dealt),
runs AS (
  SELECT p.*, coalesce(quota // blocks, 0) AS rounds, start * {mixing.BLOCK_WORDS} AS f1, (start + quota % blocks) * {mixing.BLOCK_WORDS} AS t1,
         greatest(start + quota % blocks - blocks, 0) * {mixing.BLOCK_WORDS} AS t2
  FROM placed p LEFT JOIN given g ON p.source IS NOT DISTINCT FROM g.source AND p.shard = g.shard
)
SELECT doc_id, size, words AS source_size, target,
       (rounds * size + coalesce(greatest(least(a + size, t1) - greatest(a, f1), 0), 0) + coalesce(greatest(least(a + size, t2) - a, 0), 0))::BIGINT AS taken
FROM runs
"""

# Every signature against every document that holds its keyword; a detection goes if another contains it.
_RULES = licenses.signatures()
_NAMED = [(k, i) for k, numbers in licenses.keywords_of(_RULES).items() for i in numbers]
_BASE = [(" " + "  ".join(p.split()) + " ", label) for p, label in licenses.BASE_PHRASES]
_SPACED = "' ' || trim(regexp_replace(translate(coalesce(text, ''), '{}', '{}'), '{}', '  ', 'g')) || ' '".format(licenses.UPPER, licenses.LOWER, licenses.BETWEEN)
LICENSES = f"""
WITH rules(rule, keyword, label, sure, regex) AS (VALUES {", ".join(
    f"({i}, {quoted(k)}, {quoted(_RULES[i].label)}, {float(_RULES[i].confidence)}::DOUBLE, {quoted(_RULES[i].regex)})" for k, i in _NAMED)}),
spaced AS (SELECT row_number() OVER () AS n, doc_id, {_SPACED} AS t FROM documents),
docs AS (
  SELECT n, doc_id, t, (len(t) - len(replace(t, ' ', ''))) // 2 AS words, regexp_extract_all(t, '{"|".join(w for w, _ in _BASE)}') AS hits,
         string_split_regex(t, '{"|".join(w for w, _ in _BASE)}') AS gaps
  FROM (SELECT n, doc_id, CASE WHEN trim(t) = '' THEN '' ELSE t END AS t FROM spaced)
),
places AS (
  SELECT n, rule, label, sure, list_transform(regexp_extract_all(t, regex), lambda m: len(m)) AS hit, list_transform(string_split_regex(t, regex), lambda g: len(g)) AS gap
  FROM docs JOIN rules ON contains(t, ' ' || keyword || ' ') AND regexp_matches(t, regex)
),
found AS (
  SELECT n, rule, label, sure, a, a + hit[i] AS b
  FROM (SELECT *, i, list_sum(gap[1:i]) + coalesce(list_sum(hit[1:i - 1]), 0) AS a FROM places, LATERAL (SELECT unnest(range(1, len(hit) + 1)) AS i))
),
kept AS (
  SELECT n, label, sure FROM found f WHERE NOT EXISTS (
    SELECT 1 FROM found g WHERE g.n = f.n AND g.a <= f.a AND g.b >= f.b AND (g.a < f.a OR g.b > f.b OR g.rule < f.rule))
),
named AS (SELECT n, list(DISTINCT label) AS labels, max(sure) AS sure FROM kept GROUP BY n),
based AS (
  SELECT *, list_filter([{", ".join(f"CASE WHEN contains(t, {quoted(w)}) THEN {quoted(label)} END" for w, label in _BASE)}], lambda x: x IS NOT NULL) AS base FROM docs
)
SELECT doc_id, words::BIGINT AS n_words, len(hits)::BIGINT AS n_base,
       CASE WHEN len(hits) > 0 THEN ((len(gaps[1]) - len(replace(gaps[1], ' ', ''))) // 2)::BIGINT END AS first_word,
       CASE WHEN len(hits) > 0 THEN (words - (len(gaps[-1] || hits[-1]) - len(replace(gaps[-1] || hits[-1], ' ', ''))) // 2)::BIGINT END AS last_word,
       array_to_string(list_sort(base), ',') AS base_labels,
       array_to_string(list_sort(list_distinct(list_concat(base, coalesce(labels, [])))), ',') AS labels,
       greatest(coalesce(sure, 0), CASE WHEN len(base) > 0 THEN 0.5 ELSE 0 END)::DOUBLE AS score
FROM based LEFT JOIN named USING (n)
"""
