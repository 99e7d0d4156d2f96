"""Reference SQL of the queries whose results SQL can state, over whole tables."""

from __future__ import annotations

from tagweave.llm import secrets
from tagweave.llm.licenses import MIN_DICE, TEMPLATES
from tagweave.llm.rules import BOILERPLATE, BOILERPLATE_WORDS, MAX_LOST, MAX_MARKED, MIN_SEPARATORS

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _words(text: str) -> str:
    """Lower-cased words of digits, letters and everything beyond ASCII."""
    return rf"regexp_extract_all(translate({text}, '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


def _blank_words(text: str) -> str:
    return rf"regexp_extract_all({text}, '[^\x20\x09-\x0D]+')"


DECONTAMINATION = f"""
WITH d AS (SELECT doc_id, {_words("coalesce(text, '')")} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_words("coalesce(text, '')")} AS w FROM benchmark),
items AS (SELECT item, w, least(13, len(w)) AS size FROM b WHERE len(w) > 0),
windows AS (
  SELECT DISTINCT item, size, array_to_string(w[k : k + size - 1], ' ') AS shown
  FROM (SELECT item, w, size, unnest(range(1, len(w) - size + 2)) AS k FROM items)),
places AS (
  SELECT doc_id, size, k, array_to_string(w[k : k + size - 1], ' ') AS shown
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS k
        FROM d, (SELECT DISTINCT size FROM items) WHERE len(w) >= size)),
met AS (SELECT doc_id, k, places.size, item FROM places JOIN windows USING (size, shown)),
hit AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(k, k + size)) AS p FROM (SELECT DISTINCT doc_id, k, size FROM met)) GROUP BY doc_id),
found AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item FROM met) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN found USING (doc_id)
"""

_TEMPLATE_ROWS = ", ".join("('{}', '{}')".format(name, text.replace("'", "''")) for name, text in TEMPLATES)
_BIGRAMS = "list_distinct(list_transform(range(1, len(w)), lambda k: w[k] || ' ' || w[k + 1]))"

LICENSES = f"""
WITH templates AS (
  SELECT license, {_BIGRAMS} AS grams FROM (SELECT license, {_words("text")} AS w FROM (VALUES {_TEMPLATE_ROWS}) AS v(license, text))),
lines AS (
  SELECT doc_id, i, {_words("line")} AS w
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i
        FROM documents WHERE text IS NOT NULL)),
runs AS (
  SELECT doc_id, i, w, sum(CASE WHEN len(w) = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM lines),
texts AS (
  SELECT doc_id, w FROM lines
  UNION ALL SELECT doc_id, flatten(list(w ORDER BY i)) FROM runs GROUP BY doc_id, run
  UNION ALL SELECT doc_id, flatten(list(w ORDER BY i)) FROM lines GROUP BY doc_id),
units AS (SELECT doc_id, {_BIGRAMS} AS grams FROM texts WHERE len(w) > 1),
dice AS (
  SELECT doc_id, license, 2 * len(list_intersect(u.grams, t.grams)) / (len(u.grams) + len(t.grams)) AS dice
  FROM units u JOIN templates t
    ON len(u.grams) <= len(t.grams) * {2 / MIN_DICE - 1 + 1e-9} AND len(t.grams) <= len(u.grams) * {2 / MIN_DICE - 1 + 1e-9}),
best AS (SELECT doc_id, license, max(dice) AS dice FROM dice WHERE dice >= {MIN_DICE} GROUP BY doc_id, license),
found AS (
  SELECT doc_id, count(*) AS n, string_agg(license, ',' ORDER BY license) AS licenses, max(dice) AS dice FROM best GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0) AS n_licenses, coalesce(licenses, '') AS licenses, dice AS best_dice
FROM documents LEFT JOIN found USING (doc_id)
"""

QUALITY_RULES = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, {_blank_words("coalesce(text, '')")} AS w FROM documents),
grams AS (
  SELECT doc_id, k, count(*) OVER (PARTITION BY doc_id, w[k], w[k + 1], w[k + 2]) AS n
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS k FROM d)),
repeated AS (
  SELECT doc_id, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT doc_id, unnest([k, k + 1, k + 2]) AS p FROM grams WHERE n > 1) GROUP BY doc_id),
lines AS (
  SELECT doc_id, i, line, {_blank_words("line")} AS w
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM d)),
judged AS (
  SELECT doc_id, len(w) AS n, row_number() OVER (PARTITION BY doc_id, line ORDER BY i) > 1 AS duplicate,
    CASE WHEN NOT regexp_matches(line, '[A-Za-z]|[^\x00-\x7F]') THEN len(w) > 1
      ELSE (len(w) <= {BOILERPLATE_WORDS} AND regexp_matches(translate(line, '{_UPPER}', '{_LOWER}'), '{"|".join(BOILERPLATE)}'))
        OR (separators >= {MIN_SEPARATORS} AND 5 * separators >= 2 * (len(w) - separators))
        OR (len(w) > 2 AND marked > {MAX_MARKED} * len(w)) END AS bad
  FROM (SELECT *, len(list_filter(w, lambda x: x IN ('|', '>', '»', '›', '/'))) AS separators,
               len(list_filter(w, lambda x: regexp_matches(x, '[#*$%&|<>][#*$%&|<>]|!!'))) AS marked
        FROM lines WHERE len(w) > 0)),
lost AS (
  SELECT doc_id, sum(CASE WHEN bad OR duplicate THEN n ELSE 0 END) AS lost, sum(CASE WHEN duplicate THEN 1 ELSE 0 END) AS dup
  FROM judged GROUP BY doc_id),
counted AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
         CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
         CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
         CAST(coalesce(dup, 0) AS BIGINT) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(lost, 0) AS lost
  FROM d LEFT JOIN repeated USING (doc_id) LEFT JOIN lost USING (doc_id)),
based AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counted)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND lost <= {MAX_LOST} * n_words AS kept
FROM based
"""

REPEATS = """
WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS b FROM documents),
sized AS (SELECT doc_id, b, octet_length(b) AS n FROM d),
strings AS (
  SELECT doc_id, p, md5(b[p : p + 399]) AS h FROM (SELECT doc_id, b, unnest(range(1, n - 398)) AS p FROM sized WHERE n >= 400)),
again AS (SELECT doc_id, p FROM (SELECT doc_id, p, count(*) OVER (PARTITION BY h) AS n FROM strings) WHERE n > 1),
marked AS (SELECT doc_id, p, lag(p) OVER (PARTITION BY doc_id ORDER BY p) AS before FROM again),
numbered AS (
  SELECT doc_id, p, sum(CASE WHEN before IS NULL OR p > before + 400 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY p) AS run
  FROM marked),
spans AS (SELECT doc_id, min(p) AS s, max(p) + 400 AS e FROM numbered GROUP BY doc_id, run),
kept AS (
  SELECT doc_id, lag(e, 1, 1) OVER (PARTITION BY doc_id ORDER BY s) AS s, s AS e FROM spans
  UNION ALL SELECT doc_id, max(e), NULL FROM spans GROUP BY doc_id),
rest AS (
  SELECT doc_id, string_agg(hex(b[s : coalesce(e - 1, n)]), '' ORDER BY s) AS digits
  FROM kept JOIN sized USING (doc_id) WHERE s < coalesce(e, n + 1) GROUP BY doc_id),
gone AS (SELECT doc_id, sum(e - s) AS n_removed, count(*) AS n_spans FROM spans GROUP BY doc_id)
SELECT doc_id, n AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       CASE WHEN n_removed IS NULL THEN sha256(b) ELSE sha256(unhex(coalesce(digits, ''))) END AS kept_sha256
FROM sized LEFT JOIN gone USING (doc_id) LEFT JOIN rest USING (doc_id)
"""


def _quoted(pattern: str) -> str:
    return pattern.replace("'", "''")


def _matches(kind: int, pattern: str, kept: str = "true", table: str = "d") -> str:
    """Matches with their places: what stands before the i-th one are i pieces and i - 1 matches."""
    p = _quoted(pattern)
    return f"""SELECT doc_id, {kind} AS kind, shown, start, start + length(shown) AS stop FROM (
      SELECT doc_id, m[i] AS shown, CAST(list_sum(list_transform(g[1 : i], lambda x: length(x)))
             + coalesce(list_sum(list_transform(m[1 : i - 1], lambda x: length(x))), 0) AS BIGINT) AS start
      FROM (SELECT doc_id, m, g, unnest(range(1, len(m) + 1)) AS i
            FROM (SELECT doc_id, regexp_extract_all(t, '{p}') AS m, string_split_regex(t, '{p}') AS g FROM {table} WHERE regexp_matches(t, '{p}'))))
    WHERE {kept}"""


_ALLOWED = " OR ".join(f"regexp_matches(shown, '{_quoted(p)}')" for p in secrets.ALLOWED)
_NAMES = "[" + ", ".join(f"'{k}'" for k in secrets.KINDS) + "][kind + 1]"
_LIST = f"string_agg({_NAMES} || ':' || start || ':' || stop, ',' ORDER BY start, kind, stop)"

_WANTED = f"regexp_matches(shown, '[0-9]') AND regexp_matches(shown, '[A-Za-z]') AND NOT ({_ALLOWED})"
_CLASS_BITS = f"""CASE WHEN regexp_full_match(shown, '[0-9a-fA-F]+') THEN {secrets.HEX_BITS}
    WHEN regexp_matches(shown, '{secrets.SEPARATOR}') THEN
      CASE WHEN regexp_matches(shown, '[A-Z]') AND regexp_matches(shown, '[a-z]') THEN {secrets.CLASS_BITS["base64"]} ELSE {secrets.MIXED_BITS} END
    WHEN NOT regexp_matches(shown, '[A-Z]') THEN {secrets.CLASS_BITS["lower"]}
    WHEN NOT regexp_matches(shown, '[a-z]') THEN {secrets.CLASS_BITS["upper"]}
    ELSE {secrets.CLASS_BITS["mixed"]} END"""

# Base spans and runs with a placeholder's word are blanked in the text; windows are counted anew.
SECRETS = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
base AS (
  {_matches(0, secrets.ASSIGN, f"length(regexp_extract(shown, '{_quoted(secrets.ASSIGN)}', 2)) >= {secrets.ASSIGNED}")}
  UNION ALL {_matches(1, secrets.ACCESS)}
  UNION ALL {_matches(2, secrets.HEX)}),
gaps AS (
  SELECT doc_id, t, start, stop, coalesce(max(stop) OVER (
    PARTITION BY doc_id ORDER BY start, stop ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS seen
  FROM base JOIN d USING (doc_id)),
blanked AS (
  SELECT doc_id, string_agg(CASE WHEN start > seen THEN substr(t, seen + 1, start - seen) ELSE '' END
             || repeat(' ', greatest(stop - greatest(seen, start), 0)), '' ORDER BY start, stop) || substr(any_value(t), max(stop) + 1) AS r
  FROM gaps GROUP BY doc_id),
rest AS (SELECT doc_id, coalesce(r, t) AS t FROM d LEFT JOIN blanked USING (doc_id)),
plain AS (
  SELECT doc_id, CASE WHEN regexp_matches(t, '{secrets.PLACEHOLDER}') THEN array_to_string(list_transform(
           regexp_extract_all(t, '[A-Za-z0-9]+|[^A-Za-z0-9]+'),
           lambda x: CASE WHEN regexp_matches(x, '{secrets.PLACEHOLDER}') THEN repeat(' ', length(x)) ELSE x END), '') ELSE t END AS t
  FROM rest),
free AS (
  {_matches(3, secrets.RUN, _WANTED, "plain")}
  UNION ALL {_matches(3, secrets.WHOLE, f"regexp_matches(shown, '{secrets.SEPARATOR}') AND {_WANTED}", "plain")}),
windows AS (
  SELECT doc_id, kind, start, shown, i, substr(shown, i + 1, {secrets.WINDOW}) AS w
  FROM (SELECT *, unnest(range(0, length(shown) - {secrets.WINDOW - 1})) AS i FROM free)),
rated AS (
  SELECT *, log2({secrets.WINDOW}) - list_sum(list_transform(map_values(list_histogram(string_split(w, ''))), lambda n: n * log2(n)))
            / {secrets.WINDOW} AS bits FROM windows),
high AS (
  SELECT DISTINCT doc_id, kind, start + min(i) AS start, start + max(i) + {secrets.WINDOW} AS stop FROM rated
  WHERE bits >= {_CLASS_BITS}
  GROUP BY doc_id, kind, start, shown),
every AS (SELECT doc_id, kind, start, stop FROM base UNION ALL SELECT * FROM high),
listed AS (SELECT doc_id, {_LIST} AS spans FROM every GROUP BY doc_id),
based AS (
  SELECT doc_id, {_LIST} AS spans, count(*) FILTER (kind = 0) AS a, count(*) FILTER (kind = 1) AS k, count(*) FILTER (kind = 2) AS h
  FROM base GROUP BY doc_id)
SELECT d.doc_id, coalesce(a, 0) AS n_assign, coalesce(k, 0) AS n_access, coalesce(h, 0) AS n_hex,
       sha256(coalesce(based.spans, '')) AS base_sha256, coalesce(listed.spans, '') AS spans
FROM d LEFT JOIN based USING (doc_id) LEFT JOIN listed USING (doc_id)
"""

COLLOCATIONS = rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
places AS (
  SELECT lang, w, size, unnest(range(1, len(w) - size + 2)) AS k
  FROM words, (VALUES (1), (2), (3)) AS sizes(size) WHERE len(w) >= size),
grams AS (
  SELECT lang, size, w[k : k + size - 1] AS w, count(*) AS f FROM places GROUP BY ALL),
totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM grams WHERE size = 1 GROUP BY lang),
candidates AS (SELECT * FROM grams WHERE size > 1 AND f >= 10),
parts AS (
  SELECT lang, w[k : k + 1] AS w, max(f) AS longer
  FROM (SELECT lang, w, f, unnest([1, 2]) AS k FROM candidates WHERE size = 3) GROUP BY ALL),
kept AS (
  SELECT c.* FROM candidates c LEFT JOIN parts p ON c.lang = p.lang AND c.w = p.w
  WHERE longer IS NULL OR 100 * longer < 50 * f),
cuts AS (
  SELECT c.lang, c.w, c.f AS a, k, x.f AS l, y.f AS r,
         CAST(CAST(1000000 AS HUGEINT) * c.f * c.f // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
  FROM (SELECT *, unnest(range(1, size)) AS k FROM kept) c
  JOIN grams x ON x.lang = c.lang AND x.w = c.w[1 : k] JOIN grams y ON y.lang = c.lang AND y.w = c.w[k + 1 : c.size]),
best AS (SELECT *, row_number() OVER (PARTITION BY lang, w ORDER BY score, k) AS place FROM cuts),
ranked AS (
  SELECT lang, array_to_string(w, ' ') AS phrase, a, l, r, score,
         row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(w, ' ')) AS rank
  FROM best WHERE place = 1)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""

ARCHIVE = """
WITH p AS (
  SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
  FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes < 100 OR page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to
FROM f
"""
