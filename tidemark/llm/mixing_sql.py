"""Plain SQL for the mix: each level by its definition, each prefix by a running sum."""

# Of all levels that some child would set, the one at which the children take the whole budget.
_LEVEL = """
{n}_nodes AS (
  SELECT {path}, {n}, sum(capacity) AS capacity, max(w_{n}) AS w, max(budget) AS budget
  FROM {source} GROUP BY ALL
), {n}_filled AS (
  SELECT *, sum(capacity) OVER before AS taken, sum(w) OVER onward AS weights
  FROM {n}_nodes
  WINDOW before AS (PARTITION BY {path} ORDER BY capacity / w::DOUBLE, {n} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
         onward AS (PARTITION BY {path} ORDER BY capacity / w::DOUBLE, {n} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
), {n}_levels AS (
  SELECT {path}, {n}, capacity, w, (budget - coalesce(taken, 0))::DOUBLE / weights AS lvl FROM {n}_filled
), {n}_shares AS (
  SELECT {path}, {n},
         CASE WHEN capacity / w::DOUBLE <= lvl THEN capacity
              ELSE least(capacity, floor(max(CASE WHEN capacity / w::DOUBLE > lvl THEN lvl END)
                                         OVER (PARTITION BY {path}) * w)::BIGINT) END AS share
  FROM {n}_levels
), {n}_leaves AS (
  SELECT l.* EXCLUDE (budget), s.share AS budget FROM {source} l JOIN {n}_shares s USING ({path}, {n})
)"""

MIX = (
    r"""
WITH docs AS (
  SELECT doc_id, lang, source,
         len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '')) AS tokens,
         CASE try_cast(nullif(regexp_extract(coalesce(source, ''), '^src([0-9]{1,9})$', 1), '') AS INT) // 5
              WHEN 0 THEN 'web' WHEN 1 THEN 'books' WHEN 2 THEN 'forums' WHEN 3 THEN 'reference' ELSE 'other' END AS domain,
         md5(coalesce(text, '')) AS tie
  FROM documents
), leaves AS (
  SELECT 0 AS root, domain, coalesce(lang, '') AS lang, coalesce(source, '') AS source, sum(tokens)::BIGINT AS tokens
  FROM docs GROUP BY ALL
), weighed AS (
  SELECT *, 2 * tokens AS capacity,
         least(floor(sum(tokens) OVER () * 0.6::DOUBLE)::BIGINT, 2 * sum(tokens) OVER ())::BIGINT AS budget,
         CASE domain WHEN 'web' THEN 40 WHEN 'books' THEN 30 WHEN 'forums' THEN 20 WHEN 'reference' THEN 10 ELSE 5 END AS w_domain,
         CASE lang WHEN 'en' THEN 50 WHEN 'de' THEN 20 WHEN 'fr' THEN 20 WHEN 'es' THEN 10 ELSE 5 END AS w_lang,
         1 AS w_source
  FROM leaves
), """
    + ", ".join(
        _LEVEL.format(n=n, path=path, source=source)
        for n, path, source in (
            ("domain", "root", "weighed"),
            ("lang", "root, domain", "domain_leaves"),
            ("source", "root, domain, lang", "lang_leaves"),
        )
    )
    + """, passes AS (
  SELECT doc_id, domain, lang, source, tokens, e AS epoch, tie,
         md5('17|' || e || '|' || coalesce(doc_id::VARCHAR, tie)) AS place
  FROM docs, unnest([0, 1]) AS u(e)
), running AS (
  SELECT *, sum(tokens) OVER (PARTITION BY domain, lang, source ORDER BY epoch, place, tie
                              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS used
  FROM passes
)
SELECT r.doc_id, r.domain, r.lang, r.source, r.epoch::BIGINT AS epoch,
       least(r.tokens, l.budget - (r.used - r.tokens))::BIGINT AS tokens
FROM running r JOIN source_leaves l
  ON r.domain = l.domain AND coalesce(r.lang, '') = l.lang AND coalesce(r.source, '') = l.source
WHERE r.used <= l.budget OR r.used - r.tokens < l.budget
"""
)
