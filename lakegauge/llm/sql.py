"""SQL twins (DuckDB) of the queries that SQL can express."""

from __future__ import annotations

from lakegauge.llm import decontaminate as D
from lakegauge.llm import licenses as L
from lakegauge.llm.quality import BOILERPLATE, SEPARATORS, Limits

_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"
_LIMITS = Limits()
_SEPARATORS = ", ".join(f"'{s}'" for s in SEPARATORS)

OP1 = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t
           FROM documents),
w AS (SELECT rid, doc_id, t, {_WORDS.format('t')} AS ws FROM d),
windows AS (SELECT rid, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS win
            FROM (SELECT rid, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
twice AS (SELECT rid, i FROM windows
          QUALIFY count(*) OVER (PARTITION BY rid, win) > 1),
repeats AS (SELECT rid, count(DISTINCT p) AS n
            FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM twice)
            GROUP BY rid),
lines AS (SELECT rid, line, {_WORDS.format('line')} AS ws
          FROM (SELECT rid, unnest(string_split(t, chr(10))) AS line FROM d)),
filled AS (SELECT rid, line, len(ws) AS n, ws, array_to_string(ws, ' ') AS joined
           FROM lines WHERE len(ws) > 0),
judged AS (
  SELECT rid, line, n,
    (n >= 3 AND NOT regexp_matches(line, '[.!?:…]'))
    OR 100 * len(regexp_extract_all(joined || ' ', '[!?#*$%&]{{2,}} '))
         > {_LIMITS.max_marked_pct} * n
    OR 100 * len(list_filter(ws, lambda x: x IN ({_SEPARATORS})))
         >= {_LIMITS.min_menu_pct} * n
    OR regexp_matches(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '{"|".join(BOILERPLATE)}') AS fails
  FROM filled),
by_doc AS (
  SELECT rid, count(*) - count(DISTINCT line) AS n_dup_lines,
         coalesce(sum(n) FILTER (fails), 0) AS n_lost_words
  FROM judged GROUP BY rid),
measured AS (
  SELECT doc_id, len(ws) AS n_words,
    coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS word_chars,
    len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols,
    coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words,
    coalesce(n_lost_words, 0) AS n_lost_words
  FROM w LEFT JOIN by_doc USING (rid) LEFT JOIN repeats r USING (rid)),
based AS (SELECT *, n_words < {_LIMITS.min_words}
            OR 100 * n_repeat_words > {_LIMITS.max_repeat_pct} * n_words
            AS base_failed FROM measured)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words,
  CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
  CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
  CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
  NOT base_failed AND 100 * n_lost_words <= {_LIMITS.max_lost_pct} * n_words AS kept,
  CAST(n_lost_words AS BIGINT) AS n_lost_words
FROM based
"""

_STRIPPED = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def _shared_lines(table: str) -> str:
    """CTEs on (rid, doc_id, text): lines, shared keys and kept texts."""
    return f"""
lines AS (
  SELECT rid, place, line, translate(trim(line, {_STRIPPED}),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT rid, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
               generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1)
                 AS place FROM {table})),
shared AS (SELECT key FROM lines WHERE key <> '' GROUP BY key
           HAVING count(DISTINCT rid) >= 10),
cut AS (
  SELECT rid, count(*) AS n_lines, count(s.key) AS n_dropped,
    coalesce(string_agg(line, chr(10) ORDER BY place)
               FILTER (s.key IS NULL), '') AS kept
  FROM lines l LEFT JOIN shared s ON s.key = l.key GROUP BY rid)"""


OP4 = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, text FROM documents),
{_shared_lines('d')}
SELECT doc_id, CAST(n_lines AS BIGINT) AS n_lines,
  CAST(n_dropped AS BIGINT) AS n_dropped, sha256(kept) AS kept_sha256
FROM d JOIN cut USING (rid)
"""


def shingle_classes(table: str) -> str:
    """CTEs on (rid, doc_id, text): sets of shingles and links between rows."""
    return f"""
spoken AS (
  SELECT rid, doc_id, {_WORDS.format("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS ws
  FROM {table}),
shingles AS (
  SELECT DISTINCT rid, CASE WHEN len(ws) < 5 THEN array_to_string(ws, ' ')
    ELSE array_to_string(ws[i:i + 4], ' ') END AS s
  FROM (SELECT rid, ws, unnest(range(1, greatest(len(ws) - 3, 2))) AS i
        FROM spoken WHERE len(ws) > 0)),
sizes AS (SELECT rid, count(*) AS n FROM shingles GROUP BY rid),
common AS (
  SELECT a.rid AS a, b.rid AS b, count(*) AS k
  FROM (SELECT * FROM shingles) a JOIN shingles b ON a.s = b.s AND a.rid < b.rid
  GROUP BY ALL),
links AS (
  SELECT a, b FROM common JOIN sizes x ON x.rid = a JOIN sizes y ON y.rid = b
  WHERE 100 * k >= 75 * (x.n + y.n - k)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links)"""


REACHED = """
reached(a, b) AS (
  SELECT rid, rid FROM sizes
  UNION SELECT r.a, e.b FROM reached r JOIN both_ways e ON e.a = r.b)"""

OP2 = f"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS rid, doc_id, text
                     FROM documents),
{shingle_classes('d')},
{REACHED},
lowest AS (SELECT r.a AS rid, min(d.doc_id) AS component_id
           FROM reached r JOIN d ON d.rid = r.b GROUP BY r.a)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles,
  coalesce(component_id, doc_id) AS component_id
FROM d LEFT JOIN sizes USING (rid) LEFT JOIN lowest USING (rid)
"""


def benchmark_matches(table: str) -> str:
    """CTEs on (rid, doc_id, text): documents with a benchmark passage. Without
    seeds: every pair of equal words gives its alignment."""
    words = _WORDS.format("lower(text)")
    return f"""
dw AS (SELECT rid, doc_id, unnest(ws) AS w, unnest(range(len(ws))) AS place
       FROM (SELECT rid, doc_id, {words} AS ws FROM {table})),
bw AS (SELECT item_id, least({D.WINDOW}, len(ws)) AS long, unnest(ws) AS w,
              unnest(range(len(ws))) AS k
       FROM (SELECT item_id, {words} AS ws FROM benchmark)),
aligned AS (
  SELECT rid, doc_id, item_id, long, place - k AS shift, k
  FROM dw JOIN bw USING (w)),
enough AS (
  SELECT rid, item_id, shift FROM aligned GROUP BY rid, item_id, long, shift
  HAVING 100 * count(*) >= {D.MIN_EQUAL} * long),
best AS (
  SELECT doc_id, item_id, max(100.0::DOUBLE * n / long) AS equal_pct
  FROM (SELECT doc_id, item_id, long, count(*) OVER (
          PARTITION BY rid, item_id, shift ORDER BY k
          RANGE BETWEEN {D.WINDOW - 1} PRECEDING AND CURRENT ROW) AS n
        FROM aligned JOIN enough USING (rid, item_id, shift))
  GROUP BY doc_id, item_id),
leaks AS (SELECT doc_id, count(*) AS n_items, max(equal_pct) AS best_pct
          FROM best WHERE equal_pct >= {D.MIN_EQUAL} GROUP BY doc_id)"""


OP9 = f"""
WITH numbered AS (SELECT row_number() OVER () AS rid, * FROM documents),
{benchmark_matches('numbered')}
SELECT d.doc_id, l.doc_id IS NOT NULL AS contaminated,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, best_pct
FROM documents d LEFT JOIN leaks l ON l.doc_id IS NOT DISTINCT FROM d.doc_id
"""


_LOWER = """translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
  'abcdefghijklmnopqrstuvwxyz')"""


def _listed(words: str) -> str:
    return "[" + ", ".join(f"'{word}'" for word in words.split()) + "]"


_PHRASES = ", ".join(f"({_listed(p)}, '{label}')" for p, label in L.BASE.items())
_TEMPLATES = ", ".join(
    f"({number}, '{t.label}', {_listed(t.text)}, {_listed(t.key)}::VARCHAR[])"
    for number, t in enumerate(L.TEMPLATES)
)

OP13 = rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all({_LOWER},
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
phrases(phrase, label) AS (VALUES {_PHRASES}),
based AS (
  SELECT rid, i - 1 AS pos, label
  FROM (SELECT rid, ws, unnest(range(1, len(ws) + 1)) AS i FROM d), phrases
  WHERE ws[i] = phrase[1] AND ws[i:i + len(phrase) - 1] = phrase),
bases AS (
  SELECT rid, count(*) AS n_base, min(pos) AS first_word, max(pos) AS last_word,
         list(label) AS base FROM based GROUP BY rid),
templates(template, label, words, key) AS (VALUES {_TEMPLATES}),
grams AS (
  SELECT template, i - 1 AS place, words[i:i + {L.SHINGLE - 1}] AS gram
  FROM (SELECT template, words,
               unnest(range(1, len(words) - {L.SHINGLE - 2})) AS i FROM templates)),
telling AS (
  SELECT template, i - 1 AS place
  FROM (SELECT template, words, key,
               unnest(range(1, len(words) - {L.SHINGLE - 2})) AS i FROM templates),
       (SELECT unnest(range(0, 100)) AS k)
  WHERE k <= len(key) - {L.SHINGLE} AND i > k
    AND words[i - k:i - k + len(key) - 1] = key),
rolled AS (
  SELECT rid, i - 1 AS pos, ws[i:i + {L.SHINGLE - 1}] AS gram
  FROM (SELECT rid, ws, unnest(range(1, len(ws) - {L.SHINGLE - 2})) AS i FROM d)),
hits AS (SELECT rid, template, pos, place, pos - place AS diagonal
         FROM rolled JOIN grams USING (gram)),
begun AS (
  SELECT *, coalesce(diagonal - lag(diagonal) OVER w <= {L.DRIFT}, false) AS goes_on
  FROM (SELECT DISTINCT rid, template, diagonal FROM hits)
  WINDOW w AS (PARTITION BY rid, template ORDER BY diagonal)),
numbered AS (
  SELECT *, count(*) FILTER (NOT goes_on) OVER (
    PARTITION BY rid, template ORDER BY diagonal) AS span FROM begun),
found AS (SELECT DISTINCT rid, template, span, place
          FROM hits JOIN numbered USING (rid, template, diagonal)),
shares AS (
  SELECT rid, template, span, count(DISTINCT place + k) AS covered
  FROM (SELECT *, unnest(range(0, {L.SHINGLE})) AS k FROM found) GROUP BY ALL),
told AS (
  SELECT rid, template, span, count(t.place) AS n
  FROM found f LEFT JOIN telling t USING (template, place) GROUP BY ALL),
spans AS (
  SELECT rid, label, covered / len(words) AS share
  FROM shares JOIN told USING (rid, template, span) JOIN templates USING (template)
  WHERE covered / len(words) >= {L.MIN_SHARE}
    AND n = greatest(0, len(key) - {L.SHINGLE - 1})),
added AS (SELECT rid, list(label) AS more, max(share) AS best, count(*) AS n_spans
          FROM spans GROUP BY rid)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words,
  CAST(coalesce(n_base, 0) AS BIGINT) AS n_base,
  CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
  array_to_string(list_sort(list_distinct(coalesce(base, []))), ',') AS base_labels,
  array_to_string(list_sort(list_distinct(
    list_concat(coalesce(base, []), coalesce(more, [])))), ',') AS labels,
  CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(best, 0.0)::DOUBLE END AS score,
  CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans
FROM d LEFT JOIN bases USING (rid) LEFT JOIN added USING (rid)
"""


OP12 = rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws
  FROM (SELECT lang, unnest(regexp_split_to_array({_LOWER},
          '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
places AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM pieces),
counts AS (
  SELECT lang, m, ws[i:i + m - 1] AS ws, count(*) AS f
  FROM places, (SELECT unnest([1, 2, 3, 4]) AS m)
  WHERE i + m - 1 <= len(ws) GROUP BY lang, m, ws[i:i + m - 1]),
totals AS (SELECT lang, sum(f) AS n FROM counts WHERE m = 1 GROUP BY lang),
candidates AS (SELECT * FROM counts WHERE m > 1 AND f >= 30),
inner_parts AS (
  SELECT lang, ws[i:i + size - 1] AS ws, max(f) AS most
  FROM (SELECT *, unnest(range(1, m + 1)) AS i FROM candidates),
       (SELECT unnest([2, 3]) AS size)
  WHERE size < m AND i + size - 1 <= m GROUP BY lang, ws[i:i + size - 1]),
kept AS (
  SELECT c.* FROM candidates c LEFT JOIN inner_parts p USING (lang, ws)
  WHERE most IS NULL OR 100 * most < 80 * f),
cuts AS (
  SELECT c.lang, c.ws, c.f AS a, c.k AS k, x.f AS l, y.f AS r,
    (2000000::HUGEINT * c.f) // (x.f + y.f) AS score
  FROM (SELECT *, unnest(range(1, m)) AS k FROM kept) c
  JOIN counts x ON x.lang = c.lang AND x.ws = c.ws[1:c.k]
  JOIN counts y ON y.lang = c.lang AND y.ws = c.ws[c.k + 1:c.m]),
lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (
             PARTITION BY lang, ws ORDER BY score, k) = 1),
ranked AS (
  SELECT *, row_number() OVER (
    PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM (SELECT *, array_to_string(ws, ' ') AS phrase FROM lowest))
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a,
  CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n,
  CAST(score AS BIGINT) AS score
FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_quality_rules": OP1,
        "op2_ngram_join": OP2,
        "op4_line_dedup": OP4,
        "op9_decontamination": OP9,
        "op12_collocations": OP12,
        "op13_license_scan": OP13,
    }
