"""DuckDB statements for the corpus queries that SQL can express."""

from __future__ import annotations

from tallyloom.llm import decontamination, periodic, suffixes, warc
from tallyloom.llm.secret_scan import BASE, RULES, Rule


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _rule_spans(number: int, rule: Rule) -> str:
    """Spans of one rule, from the lengths of the pieces between matches and of the matches before."""
    expression = _text(("(?i)" if rule.any_case else "") + rule.expression)
    return f"""
  SELECT doc_id, {number} AS number, '{rule.kind}' AS kind, size,
         list_sum([length(x) for x in gaps[1:i]]) + coalesce(list_sum([length(x) for x in found[1:i - 1]]), 0) AS start,
         length(found[i]) AS width
  FROM (
    SELECT *, unnest(range(1, len(found) + 1)) AS i, unnest([length(x) for x in measured]) AS size
    FROM (
      SELECT doc_id, string_split_regex(text, {expression}) AS gaps, regexp_extract_all(text, {expression}) AS found,
             regexp_extract_all(text, {expression}, {rule.group}) AS measured
      FROM texts WHERE regexp_matches(text, {expression})
    )
  ) WHERE size >= {rule.least}"""


def _secrets() -> str:
    counts = ", ".join(f"count(*) FILTER (kind = '{rule.kind}') AS n_{rule.kind}" for rule in BASE)
    listed = "string_agg(kind || ':' || start || ':' || (start + width), ',' ORDER BY start, number)"
    return f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
spans AS ({" UNION ALL ".join(_rule_spans(n, r) for n, r in enumerate(RULES))}),
counted AS (
  SELECT doc_id, {counts}, {listed} FILTER (number < {len(BASE)}) AS base, {listed} AS spans FROM spans GROUP BY doc_id
)
SELECT doc_id, {", ".join(f"coalesce(n_{r.kind}, 0)::BIGINT AS n_{r.kind}" for r in BASE)},
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM texts LEFT JOIN counted USING (doc_id)"""


_PAGES = f"""
WITH payloads AS (
  SELECT page_id, coalesce(html, '') AS payload, strlen(coalesce(html, '')) AS payload_bytes FROM pages
),
firsts AS (
  SELECT *, CASE WHEN payload_bytes >= {warc.REVISIT_BYTES} THEN max(page_id) OVER (PARTITION BY payload) ELSE page_id END AS first
  FROM payloads
)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, sha1(payload) AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM firsts"""

_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _words(table: str, name: str) -> str:
    lowered = f"translate(coalesce(text, ''), '{_LETTERS}', '{_LETTERS.lower()}')"
    return f"SELECT {name}, regexp_extract_all({lowered}, '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+') AS words FROM {table}"


_CONTAMINATION = f"""
WITH items AS ({_words("benchmark", "item_id")}),
windows AS MATERIALIZED (
  SELECT DISTINCT item_id, size, array_to_string(words[i:i + size - 1], ' ') AS gram FROM (
    SELECT *, unnest(range(1, len(words) - size + 2)) AS i FROM (
      SELECT *, least({decontamination.WINDOW}, len(words)) AS size FROM items WHERE len(words) > 0
    )
  )
),
texts AS MATERIALIZED ({_words("documents", "doc_id")}),
grams AS (
  SELECT doc_id, size, i, array_to_string(words[i:i + size - 1], ' ') AS gram FROM (
    SELECT *, unnest(range(1, len(words) - size + 2)) AS i
    FROM texts, (SELECT DISTINCT size FROM windows) WHERE len(words) >= size
  )
),
hits AS MATERIALIZED (SELECT doc_id, item_id, i, size FROM grams JOIN windows USING (size, gram)),
covered AS (
  SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS place FROM hits) GROUP BY doc_id
),
listed AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id
)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND {decontamination.HIT_SHARE} * coalesce(n_hit, 0) >= len(words) AS contaminated
FROM texts LEFT JOIN covered USING (doc_id) LEFT JOIN listed USING (doc_id)"""

# The checksum of a decimal id, a byte and its eight bits at a time.
_CRC32 = """xor(4294967295::UBIGINT, list_reduce(
    list_concat([4294967295::UBIGINT], list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::UBIGINT)),
    lambda crc, byte: list_reduce(
      list_concat([xor(crc, byte)], list_transform(range(8), lambda i: 0::UBIGINT)),
      lambda s, i: xor(s >> 1, CASE WHEN s & 1 = 1 THEN 3988292384::UBIGINT ELSE 0::UBIGINT END))))"""

_PERIODIC = f"""
WITH texts AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words, {_CRC32}::BIGINT AS h FROM documents
),
sized AS (SELECT doc_id, words, len(words) AS n, h, h // 10 AS g, CASE WHEN len(words) > 0 THEN (h // 10) % len(words) END AS a FROM texts),
planted AS MATERIALIZED (
  SELECT doc_id, n, CASE WHEN h % 10 = 0 AND n > 0 THEN
    list_transform(range(n), lambda i: words[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + g % 8)) END])
    ELSE words END AS words
  FROM sized
),
grams AS (
  SELECT doc_id, n, i, array_to_string(words[i + 1:i + {periodic.LEAST // 2}], ' ') AS gram
  FROM (SELECT *, unnest(range(n - {periodic.LEAST // 2 - 1})) AS i FROM planted)
),
equal AS (
  SELECT x.doc_id, y.i - x.i AS q, x.i AS i FROM grams x JOIN grams y ON x.doc_id = y.doc_id AND x.gram = y.gram AND x.i < y.i AND 2 * (y.i - x.i) <= x.n
),
stretches AS (
  SELECT doc_id, q, min(i) AS start, count(*) + {periodic.LEAST // 2 - 1} AS shared
  FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM equal) GROUP BY doc_id, q, island
),
runs AS (
  SELECT doc_id, start, shared + q AS length, min(q) AS period FROM stretches
  WHERE shared >= q AND shared + q >= {periodic.LEAST} GROUP BY doc_id, start, shared + q
),
listed AS (
  SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS listing,
         first(start ORDER BY length DESC, start, period) AS start, max(length) AS length,
         first(period ORDER BY length DESC, start, period) AS period
  FROM runs GROUP BY doc_id
),
dropped AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM runs),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS collapsed
  FROM (SELECT doc_id, unnest(words) AS word, unnest(range(n)) AS i FROM planted) ANTI JOIN dropped USING (doc_id, i) GROUP BY doc_id
)
SELECT doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, start::BIGINT AS start, length::BIGINT AS length, period::BIGINT AS period,
       (1000 * length // period)::BIGINT AS exponent_milli, sha256(coalesce(listing, '')) AS runs_sha256,
       sha256(coalesce(collapsed, '')) AS collapsed_sha256
FROM planted LEFT JOIN listed USING (doc_id) LEFT JOIN kept USING (doc_id)"""


def _components(words: int, percent: int, kept: str = "") -> str:
    """Components of texts whose shingle sets are similar; every pair that shares a shingle is counted."""
    lowered = f"translate(coalesce(text, ''), '{_LETTERS}', '{_LETTERS.lower()}')"
    return f"""
WITH RECURSIVE texts AS (SELECT doc_id, regexp_extract_all({lowered}, '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
shingles AS MATERIALIZED (
  SELECT DISTINCT doc_id, shingle FROM (
    SELECT doc_id, unnest(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < {words} THEN [array_to_string(words, ' ')]
      ELSE list_transform(range(1, len(words) - {words - 2}), lambda i: array_to_string(words[i:i + {words - 1}], ' ')) END) AS shingle
    FROM texts
  )
),
sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common FROM shingles x JOIN shingles y ON x.shingle = y.shingle AND x.doc_id < y.doc_id GROUP BY ALL
),
links AS MATERIALIZED (
  SELECT a, b FROM shared JOIN sizes s ON s.doc_id = a JOIN sizes t ON t.doc_id = b WHERE 100 * common >= {percent} * (s.n + t.n - common)
),
ways AS MATERIALIZED (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT reached.doc_id, ways.b FROM reached JOIN ways ON ways.a = reached.other
)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id{kept}
FROM (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id) LEFT JOIN sizes USING (doc_id)"""


# Every start of a whole run, runs of equal bytes counted, their places put together; bytes are numbered from 1.
_REPEATS = f"""
WITH texts AS MATERIALIZED (SELECT doc_id, encode(coalesce(text, '')) AS raw, strlen(coalesce(text, '')) AS n FROM documents),
starts AS MATERIALIZED (
  SELECT doc_id, i, raw[i:i + {suffixes.SIZE - 1}] AS run FROM (SELECT *, unnest(range(1, n - {suffixes.SIZE - 2})) AS i FROM texts)
),
repeated AS (SELECT doc_id, i FROM starts JOIN (SELECT run FROM starts GROUP BY run HAVING count(*) > 1) USING (run)),
marked AS (
  SELECT doc_id, i, i > coalesce(lag(i) OVER (PARTITION BY doc_id ORDER BY i) + {suffixes.SIZE}, 0) AS fresh FROM repeated
),
spans AS MATERIALIZED (
  SELECT doc_id, min(i) AS start, max(i) + {suffixes.SIZE} AS stop
  FROM (SELECT *, sum(fresh::INTEGER) OVER (PARTITION BY doc_id ORDER BY i) AS span FROM marked) GROUP BY doc_id, span
),
gaps AS (
  SELECT doc_id, coalesce(lag(stop) OVER (PARTITION BY doc_id ORDER BY start), 1) AS a, start AS b FROM spans
  UNION ALL SELECT doc_id, max(stop), any_value(n) + 1 FROM spans JOIN texts USING (doc_id) GROUP BY doc_id
),
kept AS (SELECT doc_id, string_agg(hex(raw[a:b - 1]), '' ORDER BY a) AS bytes FROM gaps JOIN texts USING (doc_id) WHERE b > a GROUP BY doc_id),
counted AS (SELECT doc_id, sum(stop - start) AS n_removed, count(*) AS n_spans FROM spans GROUP BY doc_id)
SELECT doc_id, n::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
       CASE WHEN n_spans IS NULL THEN sha256(raw) ELSE sha256(unhex(coalesce(bytes, ''))) END AS kept_sha256
FROM texts LEFT JOIN counted USING (doc_id) LEFT JOIN kept USING (doc_id)"""


def oracle_sql() -> dict[str, str]:
    return {
        "op7_jaccard_join": _components(4, 85),
        "op9_suffix_dedup": _REPEATS,
        "op12_minhash_near_dedup": _components(4, 80, ", doc_id = component_id AS kept"),
    } | {"op3_warc": _PAGES, "op5_secret_scan": _secrets(), "op10_decontamination": _CONTAMINATION, "op13_periodic_runs": _PERIODIC}
