"""Plain SQL for the quality rules, with its own words and numbers."""

QUALITY = r"""
WITH texts AS (
  SELECT doc_id, lang, coalesce(text, '') AS t FROM documents
), split AS (
  SELECT doc_id, lang, t,
         list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda w: w <> '') AS ws,
         list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS ls
  FROM texts
), numbered AS (
  SELECT row_number() OVER () AS r, * FROM split
), windows AS (
  SELECT r, i, array_to_string(ws[i : i + 4], chr(0)) AS g
  FROM numbered, unnest(range(1, len(ws) - 3)) AS u(i)
), twice AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS c FROM windows) WHERE c > 1
), covered AS (
  SELECT r, count(DISTINCT i + d) AS n FROM twice, unnest([0, 1, 2, 3, 4]) AS v(d) GROUP BY r
), counts AS (
  SELECT doc_id, lang, len(ws) AS n_words,
         length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
         len(ls) - len(list_distinct(ls)) AS n_dup_lines,
         coalesce(covered.n, 0) AS n_repeat_words,
         length(regexp_replace(t, '[^!?]+', '', 'g')) AS n_shouts,
         len(ls) AS n_lines
  FROM numbered LEFT JOIN covered USING (r)
), scored AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
         greatest(CAST(n_symbols AS DOUBLE) / greatest(n_words, 1) / CAST(0.1 AS DOUBLE),
                  CAST(n_shouts AS DOUBLE) / greatest(n_words, 1) / CAST(0.2 AS DOUBLE),
                  CAST(n_dup_lines AS DOUBLE) / greatest(n_lines, 1) / CAST(0.3 AS DOUBLE),
                  CAST(n_repeat_words AS DOUBLE) / greatest(n_words, 1) / CAST(0.1 AS DOUBLE)) AS badness
  FROM counts
), known AS (
  SELECT doc_id, min(quality) AS quality FROM labels
  WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id
), holdout AS (
  SELECT lang, badness, quality FROM scored JOIN known USING (doc_id) WHERE NOT base_failed
), tests AS (
  SELECT lang, c AS cutoff,
         count(*) FILTER (quality = 1) AS n,
         count(*) FILTER (quality = 1 AND badness > c) AS wrong,
         count(*) FILTER (quality = 0 AND badness > c) AS hits
  FROM holdout, unnest([0.25::DOUBLE, 0.5, 1.0, 2.0, 4.0, 8.0]) AS u(c) GROUP BY ALL
), chances AS (
  SELECT *, count(*) OVER () AS m,
         list_sum(list_transform(range(0, wrong + 1), lambda i:
           exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1)
               + i * ln(0.02::DOUBLE) + (n - i) * ln(0.98::DOUBLE)))) AS chance
  FROM tests WHERE true
), chosen AS (
  SELECT lang AS held, arg_max(cutoff, (hits - wrong) * 1000.0 + cutoff) AS cutoff
  FROM chances WHERE n > 0 AND wrong <= n * 0.02 AND chance <= 0.05 / m GROUP BY lang
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_shouts, n_lines,
       base_failed, NOT base_failed AND NOT coalesce(badness > cutoff, false) AS kept, badness, cutoff
FROM scored LEFT JOIN chosen ON lang IS NOT DISTINCT FROM held
"""
