"""Plain SQL for the licence scan."""

from tidemark.llm.licenses import TEMPLATES


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_ROWS = ", ".join(f"({_quoted(n)}, {_quoted(t)})" for n, t in TEMPLATES.items())
_WORDS = (
    "list_filter(regexp_split_to_array(translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
    r"'abcdefghijklmnopqrstuvwxyz'), '[^\p{{L}}\p{{N}}]+'), lambda w: w <> '')"
)
_PAIRS = "list_distinct(list_transform(range(1, len({0})), lambda i: {0}[i] || ' ' || {0}[i + 1]))"

LICENSES = f"""
WITH templates AS (
  SELECT name, {_WORDS.format("body")} AS ws FROM (VALUES {_ROWS}) AS v(name, body)
), known AS (
  SELECT name, {_PAIRS.format("ws")} AS grams FROM templates
), lines AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls, coalesce(text, '') AS whole FROM documents
), units AS (
  SELECT doc_id, 0 AS unit, whole AS body FROM lines WHERE len(ls) > 1
  UNION ALL
  SELECT doc_id, i AS unit, ls[i] AS body FROM lines, unnest(range(1, len(ls) + 1)) AS u(i)
), worded AS (
  SELECT doc_id, unit, {_WORDS.format("body")} AS ws FROM units
), counted AS (
  SELECT row_number() OVER () AS r, doc_id, unit, {_PAIRS.format("ws")} AS grams FROM worded WHERE len(ws) > 1
), compared AS (
  SELECT r, doc_id, unit, name, len(c.grams) AS n,
         2.0::DOUBLE * len(list_intersect(c.grams, k.grams)) / (len(c.grams) + len(k.grams)) AS dice
  FROM counted c JOIN known k ON 2.0::DOUBLE * least(len(c.grams), len(k.grams)) >= 0.8 * (len(c.grams) + len(k.grams)) - 1e-6
)
SELECT doc_id, unit::BIGINT AS unit, arg_min(name, (-dice, name)) AS license, max(dice) AS dice,
       any_value(n)::BIGINT AS n_bigrams
FROM compared WHERE dice >= 0.8 GROUP BY r, doc_id, unit
"""
