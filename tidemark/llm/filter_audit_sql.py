"""Plain SQL for the filter audit: every document through every order, step by step."""

AUDIT = r"""
WITH texts AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents
), split AS (
  SELECT *, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda w: w <> '') AS ws,
         min(doc_id) OVER (PARTITION BY t) AS least_id
  FROM texts
), judged AS (
  SELECT doc_id, part, {
    'A': len(ws) < 50,
    'B': 100 * len(list_distinct(ws)) < 65 * len(ws),
    'C': 100 * length(regexp_replace(t, '[^A-Z]+', '', 'g')) > 5 * length(t),
    'D': regexp_matches(t, '[#$%&*|]'),
    'E': coalesce(doc_id > least_id, false)
  } AS f
  FROM split
), letters AS (
  SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c
), orders AS (
  SELECT a.c || b.c || d.c || e.c || g.c AS filter_order
  FROM letters a, letters b, letters d, letters e, letters g
  WHERE len(list_distinct([a.c, b.c, d.c, e.c, g.c])) = 5
), steps AS (
  SELECT filter_order, step, substr(filter_order, step, 1) AS letter, substr(filter_order, 1, step - 1) AS earlier
  FROM orders, unnest([1, 2, 3, 4, 5]) AS u(step)
), known AS (
  SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
), failed AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
         (CASE WHEN f.A THEN 'A' ELSE '' END) || (CASE WHEN f.B THEN 'B' ELSE '' END)
           || (CASE WHEN f.C THEN 'C' ELSE '' END) || (CASE WHEN f.D THEN 'D' ELSE '' END)
           || (CASE WHEN f.E THEN 'E' ELSE '' END) AS fails
  FROM judged LEFT JOIN known USING (doc_id)
), grouped AS (
  SELECT part, fails, good, toxic, count(*) AS n FROM failed GROUP BY ALL
), met AS (
  SELECT part, filter_order, step, letter, fails, n, good, toxic,
         contains(fails, letter) AS hit,
         length(translate(fails, earlier, '')) < length(fails) AS gone
  FROM grouped, steps
), audited AS (
  SELECT part, filter_order, step, letter,
         coalesce(sum(n) FILTER (NOT hit AND NOT gone), 0)::BIGINT AS kept,
         coalesce(sum(n) FILTER (hit AND NOT gone), 0)::BIGINT AS removed,
         coalesce(sum(n) FILTER (hit AND gone), 0)::BIGINT AS redundant,
         coalesce(sum(n) FILTER (fails = letter), 0)::BIGINT AS unique_fails,
         coalesce(sum(n) FILTER (hit AND NOT gone AND good), 0)::BIGINT AS good_lost,
         coalesce(sum(n) FILTER (hit AND NOT gone AND toxic), 0)::BIGINT AS toxic_lost
  FROM met GROUP BY ALL
)
SELECT part, filter_order, step::INTEGER AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, letter))::BIGINT AS shapley
FROM audited
"""
