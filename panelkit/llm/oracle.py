"""SQL for DuckDB with the results of those queries that SQL can express."""

from __future__ import annotations

from panelkit.llm import line_dedup, mixing, quality_rules, queries

# The words, and the windows of eight that come again, of every text.
_RULES = r"""
WITH docs AS (
  SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
),
windows AS (
  SELECT row, i, array_to_string(words[i:i + 7], ' ') AS w
  FROM (SELECT row, words, unnest(range(1, len(words) - 6)) AS i FROM docs WHERE len(words) > 8)
),
again AS (SELECT row, i FROM windows QUALIFY count(*) OVER (PARTITION BY row, w) > 1),
repeats AS (
  SELECT row, count(DISTINCT i + k) AS n_repeat_words
  FROM again, (SELECT unnest(range(8)) AS k) GROUP BY row
),
measured AS (
  SELECT doc_id,
         CAST(len(words) AS BIGINT) AS n_words,
         CAST(length(text) - length(regexp_replace(text, '[^\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         coalesce(n_repeat_words, 0) AS n_repeat_words,
         CAST(len(lines) AS BIGINT) AS n_lines,
         CAST(length(regexp_replace(text, '[\x00-\x40\x5B-\x60\x7B-\x7F]', '', 'g')) AS BIGINT) AS n_letters,
         CAST(length(regexp_replace(text, '[^A-Z]', '', 'g')) AS BIGINT) AS n_upper,
         CAST(len(list_filter(range(2, len(words) + 1), lambda i: words[i] = words[i - 1])) AS BIGINT) AS n_stutters
  FROM docs LEFT JOIN repeats USING (row)
),
judged AS (
  SELECT *, CAST(
    CASE WHEN n_words < 20 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 30 * n_words THEN 2 ELSE 0 END
    + CASE WHEN 10 * n_symbols > 2 * n_words THEN 4 ELSE 0 END + CASE WHEN 2 * n_dup_lines > n_lines THEN 8 ELSE 0 END
    + CASE WHEN word_chars < 2 * n_words OR word_chars > 20 * n_words THEN 16 ELSE 0 END
    + CASE WHEN 2 * n_letters < word_chars THEN 32 ELSE 0 END + CASE WHEN 2 * n_upper > n_letters THEN 64 ELSE 0 END
    + CASE WHEN 5 * n_stutters > n_words THEN 128 ELSE 0 END AS BIGINT) AS failed
  FROM measured
)"""

# Lines with a word that repeat an earlier one, of any length. An edit counts in lines of 20 characters or more; it leaves
# their first or their last nine characters alone.
_LINES = rf"""
WITH lines AS (
  SELECT doc_id, unnest(range(len(string_split(text, chr(10))))) AS pos, unnest(string_split(text, chr(10))) AS line
  FROM documents
),
known AS (
  SELECT line, min(doc_id * 1000000 + pos) AS first FROM lines
  WHERE length(line) >= {line_dedup.MIN_CHARS} OR regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY line
),
long AS (SELECT * FROM known WHERE length(line) >= {line_dedup.MIN_CHARS}),
pairs AS (
  SELECT a.line, b.line AS earlier FROM long a JOIN long b
  ON left(a.line, 9) = left(b.line, 9) AND b.first < a.first AND abs(length(a.line) - length(b.line)) <= 1
  UNION
  SELECT a.line, b.line AS earlier FROM long a JOIN long b
  ON right(a.line, 9) = right(b.line, 9) AND b.first < a.first AND abs(length(a.line) - length(b.line)) <= 1
),
sized AS (
  SELECT line, CASE WHEN length(line) >= length(earlier) THEN line ELSE earlier END AS x,
         CASE WHEN length(line) >= length(earlier) THEN earlier ELSE line END AS y
  FROM pairs
),
near AS (
  SELECT DISTINCT line FROM sized
  WHERE CASE WHEN length(x) = length(y)
        THEN len(list_filter(range(1, length(x) + 1), lambda i: substr(x, i, 1) <> substr(y, i, 1))) <= 1
        ELSE len(list_filter(range(1, length(x) + 1), lambda i: substr(x, 1, i - 1) || substr(x, i + 1) = y)) > 0 END
),
judged AS (
  SELECT doc_id, pos, line,
         coalesce(near.line IS NOT NULL OR first < doc_id * 1000000 + pos, false) AS gone
  FROM lines LEFT JOIN known USING (line) LEFT JOIN near USING (line)
),
texts AS (
  SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
         coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '') AS rest
  FROM judged GROUP BY doc_id
)
SELECT doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_dropped, 0) AS n_dropped,
       CAST(length(rest) AS BIGINT) AS n_left, sha256(rest) AS left_sha256
FROM documents LEFT JOIN texts USING (doc_id)"""


def _fill(name: str, nodes: str) -> str:
    """Budgets of the children in ``nodes`` (path, parent, cap, of_parent)."""
    return f"""
{name} AS (
  SELECT path, CASE WHEN ratio IS NULL THEN 0.0
              WHEN ratio <= level THEN CAST(cap AS DOUBLE)
              ELSE max(CASE WHEN ratio > level THEN level END) OVER (PARTITION BY parent) * weight END AS budget
  FROM (
    SELECT *, CASE WHEN weight > 0 THEN
        (of_parent - coalesce(CAST(sum(cap) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS DOUBLE), 0))
        / sum(weight) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) END AS level
    FROM (
      SELECT n.*, coalesce(given, 1.0::DOUBLE) AS weight, CASE WHEN coalesce(given, 1.0) > 0 THEN cap / coalesce(given, 1.0::DOUBLE) END AS ratio
      FROM ({nodes}) n LEFT JOIN weights USING (path)
    )
    WINDOW w AS (PARTITION BY parent ORDER BY ratio ASC NULLS LAST, path)
  )
)"""


def _mixing() -> str:
    given = ", ".join(f"({list(p)!r}, {w}::DOUBLE)" for p, w in queries.WEIGHTS.items())
    caps = f"CAST(sum(supply) * {queries.EPOCHS} AS DOUBLE) AS cap"
    levels = []
    for k in range(1, len(mixing.LEVELS) + 1):
        if k == 1:
            of_parent = f"(SELECT floor(sum(supply) * {queries.SHARE}::DOUBLE) FROM leaves)"
            nodes = f"SELECT path[1:1] AS path, []::VARCHAR[] AS parent, {caps}, {of_parent} AS of_parent FROM leaves GROUP BY 1"
        else:
            nodes = f"""SELECT c.*, p.budget AS of_parent
      FROM (SELECT path[1:{k}] AS path, path[1:{k - 1}] AS parent, {caps} FROM leaves GROUP BY 1, 2) c
      JOIN level{k - 1} p ON p.path = c.parent"""
        levels.append(_fill(f"level{k}", nodes))
    return f"""
WITH sizes AS (
  SELECT doc_id, md5(coalesce(text, '')) AS row, ['domain' || CAST(CAST(regexp_extract(source, '(\\d+)$', 1) AS BIGINT) % {queries.DOMAINS} AS VARCHAR), lang, source] AS path,
         CAST(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS n_tokens
  FROM documents
),
leaves AS (SELECT path, sum(n_tokens) AS supply FROM sizes GROUP BY path),
weights(path, given) AS (VALUES {given}),{",".join(levels)},
plan AS (
  SELECT path, CAST(supply AS BIGINT) AS supply, CAST(floor(budget) AS BIGINT) AS target
  FROM leaves JOIN level{len(mixing.LEVELS)} USING (path)
),
placed AS (
  SELECT doc_id, path, n_tokens, target // supply AS whole, target % supply AS left_over,
         md5(concat_ws('|', '11', CAST(target // supply AS VARCHAR), CAST(doc_id AS VARCHAR), row, CAST(copy AS VARCHAR))) AS place
  FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, path, row) - 1 AS copy FROM sizes) JOIN plan USING (path)
),
added AS (SELECT *, sum(n_tokens) OVER (PARTITION BY path ORDER BY place) AS upto FROM placed)
SELECT doc_id, path[1] AS domain, path[2] AS lang, path[3] AS source, n_tokens,
       CASE WHEN n_tokens > 0 THEN whole + CASE WHEN left_over > 0 AND upto <= left_over THEN 1 ELSE 0 END ELSE 0 END AS epochs
FROM added"""


# Every order of five filters, document by document: a document falls to the first that it fails.
_AUDIT = r"""
WITH measured AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents
),
marks AS (
  SELECT doc_id, bool_or(coalesce(quality = 1, false)) AS good, bool_or(coalesce(toxic = 1, false)) AS toxic
  FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
),
judged AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
         list_concat(
           CASE WHEN len(words) < 200 THEN ['A'] ELSE [] END,
           CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN ['B'] ELSE [] END,
           CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text) THEN ['C'] ELSE [] END,
           CASE WHEN regexp_matches(text, '[#$%&*|]') THEN ['D'] ELSE [] END,
           CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY text) THEN ['E'] ELSE [] END) AS fails
  FROM measured LEFT JOIN marks USING (doc_id)
),
kinds AS (
  SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS n_good, count(*) FILTER (toxic) AS n_toxic
  FROM judged GROUP BY part, fails
),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c),
orders AS (
  SELECT [a.c, b.c, c.c, d.c, e.c] AS names FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.c, b.c, c.c, d.c, e.c])) = 5
),
steps AS (SELECT names, unnest(range(1, 6)) AS step FROM orders),
counted AS (
  SELECT part, array_to_string(names, '') AS filter_order, CAST(step AS INTEGER) AS step, names[step] AS name,
         sum(CASE WHEN NOT list_has_any(fails, names[:step]) THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN list_contains(fails, names[step]) AND NOT list_has_any(fails, names[:step - 1]) THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN list_contains(fails, names[step]) AND list_has_any(fails, names[:step - 1]) THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN fails = [names[step]] THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN list_contains(fails, names[step]) AND NOT list_has_any(fails, names[:step - 1]) THEN n_good ELSE 0 END) AS good_lost,
         sum(CASE WHEN list_contains(fails, names[step]) AND NOT list_has_any(fails, names[:step - 1]) THEN n_toxic ELSE 0 END) AS toxic_lost
  FROM kinds, steps GROUP BY part, names, step
)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, name) AS BIGINT) AS shapley
FROM counted"""

ORACLE = {
    "op1_quality_rules": _RULES
    + f"""
SELECT *, failed & {quality_rules.mask("base-1")} <> 0 AS base_failed,
       failed & {quality_rules.mask("base-1") | quality_rules.mask(quality_rules.POLICY)} = 0 AS kept
FROM judged""",
    "op5_line_dedup": _LINES,
    "op8_mixing": _mixing(),
    "op12_filter_audit": _AUDIT,
}
