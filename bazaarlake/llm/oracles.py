"""The queries that SQL can express, as SQL over the same tables."""

import itertools

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

_COUNTS = rf"""
d AS (
  SELECT doc_id, lang, source, coalesce(text, '') AS t, {_WORDS} AS w FROM documents
),
win AS (
  SELECT doc_id, i, array_to_string(w[i:i + 7], ' ') AS g
  FROM d, unnest(range(1, len(w) - 6)) AS u(i)
  WHERE len(w) >= 8
),
rep AS (
  SELECT doc_id, i FROM win
  QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1
),
gap AS (
  SELECT doc_id, least(8, coalesce(lead(i) OVER (PARTITION BY doc_id ORDER BY i) - i, 8)) AS n
  FROM rep
),
cov AS (SELECT doc_id, CAST(sum(n) AS BIGINT) AS n_repeat_words FROM gap GROUP BY doc_id),
e AS (
  SELECT doc_id, count(*) AS n_echoes
  FROM d, unnest(range(2, len(w) + 1)) AS u(i)
  WHERE w[i] = w[i - 1]
  GROUP BY doc_id
),
l AS (
  SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT x) AS n_dup_lines
  FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS x FROM d)
  WHERE regexp_matches(x, '[^\x20\x09-\x0D]')
  GROUP BY doc_id
),
m AS (
  SELECT d.doc_id, lang, source, CAST(len(w) AS BIGINT) AS n_words,
    CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(length(t) - length(translate(t, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
    CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines,
    coalesce(n_repeat_words, 0) AS n_repeat_words,
    coalesce(n_echoes, 0) AS n_echoes
  FROM d LEFT JOIN l USING (doc_id) LEFT JOIN cov USING (doc_id) LEFT JOIN e USING (doc_id)
),
b AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
    word_chars * 100 // greatest(n_words, 1) AS mean_word,
    n_symbols * 1000 // greatest(word_chars, 1) AS symbol_share,
    n_dup_lines * 1000 // greatest(n_lines, 1) AS repeat_line_share,
    n_repeat_words * 1000 // greatest(n_words, 1) AS repeat_word_share,
    n_echoes * 1000 // greatest(n_words, 1) AS echo_share
  FROM m
)
"""

OP10 = rf"""
WITH {_COUNTS},
v AS (
  SELECT lang, source, measure, v FROM (
    SELECT lang, source,
      unnest(['mean_word', 'symbol_share', 'repeat_line_share', 'repeat_word_share',
        'echo_share']) AS measure,
      unnest([mean_word, symbol_share, repeat_line_share, repeat_word_share, echo_share]) AS v
    FROM b WHERE NOT base_failed
  )
),
w AS (
  SELECT lang, source, measure,
    v // (1 << greatest(length(bin(v)) - 5, 0)) * (1 << greatest(length(bin(v)) - 5, 0)) AS bucket
  FROM v
),
own AS (
  SELECT lang, source, measure, count(*) AS n,
    list_sort(list(bucket))[CAST(ceil(count(*) / 4.0) AS BIGINT)] AS q1,
    list_sort(list(bucket))[CAST(ceil(3 * count(*) / 4.0) AS BIGINT)] AS q3
  FROM w GROUP BY ALL
),
by_lang AS (
  SELECT lang, measure, count(*) AS n,
    list_sort(list(bucket))[CAST(ceil(count(*) / 4.0) AS BIGINT)] AS q1,
    list_sort(list(bucket))[CAST(ceil(3 * count(*) / 4.0) AS BIGINT)] AS q3
  FROM w GROUP BY ALL
),
whole AS (
  SELECT measure,
    list_sort(list(bucket))[CAST(ceil(count(*) / 4.0) AS BIGINT)] AS q1,
    list_sort(list(bucket))[CAST(ceil(3 * count(*) / 4.0) AS BIGINT)] AS q3
  FROM w GROUP BY ALL
),
q AS (
  SELECT o.lang, o.source, o.measure,
    CASE WHEN o.n >= 200 THEN o.q1 WHEN g.n >= 200 THEN g.q1 ELSE a.q1 END AS q1,
    CASE WHEN o.n >= 200 THEN o.q3 WHEN g.n >= 200 THEN g.q3 ELSE a.q3 END AS q3
  FROM own o
  JOIN by_lang g ON o.lang IS NOT DISTINCT FROM g.lang AND o.measure = g.measure
  JOIN whole a ON o.measure = a.measure
),
f AS (
  SELECT lang, source,
    max(CASE WHEN measure = 'mean_word' THEN q1 - 4 * greatest(q3 - q1, 40) END) AS lo,
    max(CASE WHEN measure = 'mean_word' THEN q3 + 4 * greatest(q3 - q1, 40) END) AS hi,
    max(CASE WHEN measure = 'symbol_share' THEN q3 + 4 * greatest(q3 - q1, 10) END) AS sy,
    max(CASE WHEN measure = 'repeat_line_share' THEN q3 + 4 * greatest(q3 - q1, 100) END) AS li,
    max(CASE WHEN measure = 'repeat_word_share' THEN q3 + 4 * greatest(q3 - q1, 75) END) AS re,
    max(CASE WHEN measure = 'echo_share' THEN q3 + 20 * greatest(q3 - q1, 5) END) AS ec
  FROM q GROUP BY lang, source
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  coalesce(NOT base_failed AND mean_word BETWEEN lo AND hi AND symbol_share <= sy
    AND repeat_line_share <= li AND repeat_word_share <= re AND echo_share <= ec, false) AS kept
FROM b LEFT JOIN f
  ON b.lang IS NOT DISTINCT FROM f.lang AND b.source IS NOT DISTINCT FROM f.source
"""

_ORDERS = ", ".join(f"('{''.join(p)}')" for p in itertools.permutations("ABCDE"))

OP11 = rf"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws
  FROM documents
),
f AS (
  SELECT doc_id, part,
    CASE WHEN len(ws) < 50 THEN 'A' ELSE '' END
    || CASE WHEN 100 * len(list_distinct(ws)) < 65 * len(ws) THEN 'B' ELSE '' END
    || CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t)
       THEN 'C' ELSE '' END
    || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
    || CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 'E' ELSE '' END AS fails
  FROM d
),
g AS (
  SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic
  FROM labels GROUP BY doc_id
),
c AS (
  SELECT part, fails, count(*) AS n, count(*) FILTER (WHERE good) AS good,
    count(*) FILTER (WHERE toxic) AS toxic
  FROM f LEFT JOIN g USING (doc_id) GROUP BY ALL
),
o AS (
  SELECT filter_order, CAST(step AS INTEGER) AS step, filter_order[step] AS letter,
    substr(filter_order, 1, step - 1) AS earlier
  FROM (VALUES {_ORDERS}) AS p(filter_order), range(1, 6) AS s(step)
),
x AS (
  SELECT *, contains(fails, letter) AS hit, translate(fails, earlier, '') = fails AS here
  FROM c, o
),
y AS (
  SELECT part, filter_order, step, letter,
    CAST(sum(n) FILTER (WHERE here AND NOT hit) AS BIGINT) AS kept,
    CAST(sum(n) FILTER (WHERE here AND hit) AS BIGINT) AS removed,
    CAST(sum(n) FILTER (WHERE hit AND NOT here) AS BIGINT) AS redundant,
    CAST(sum(n) FILTER (WHERE fails = letter) AS BIGINT) AS unique_fails,
    CAST(sum(good) FILTER (WHERE here AND hit) AS BIGINT) AS good_lost,
    CAST(sum(toxic) FILTER (WHERE here AND hit) AS BIGINT) AS toxic_lost
  FROM x GROUP BY part, filter_order, step, letter
)
SELECT part, filter_order, step, coalesce(kept, 0) AS kept, coalesce(removed, 0) AS removed,
  coalesce(redundant, 0) AS redundant, coalesce(unique_fails, 0) AS unique_fails,
  coalesce(good_lost, 0) AS good_lost, coalesce(toxic_lost, 0) AS toxic_lost,
  CAST(coalesce(sum(removed) OVER (PARTITION BY part, letter), 0) AS BIGINT) AS shapley
FROM y
"""

OP12 = """
WITH v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))
    AND list_bool_or(list_transform(embedding, lambda x: x <> 0))
),
p AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id
  WHERE q.vec_id % 20 = 0
)
SELECT query_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id, score
FROM p
WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER w <= 20
"""

ORACLES = {
    "op10_adaptive_quality": OP10,
    "op11_filter_audit": OP11,
    "op12_onebit_neighbours": OP12,
}
