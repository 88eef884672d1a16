"""The same results as DuckDB SQL over the same tables, for checking the queries."""

from __future__ import annotations

from tallyloom.operators import kmeans as km
from tallyloom.operators.sampling import SEED
from tallyloom.plans import tables
from tallyloom.plans.queries import BLOCK_ANSWERS, BLOCK_TITLES, KERNELS, PER_TOPIC, SAMPLED

# More rounds than any of the test scales needs; converged means stay as they are.
KMEANS_ROUNDS = 20


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _list(values) -> str:
    return "[" + ", ".join(_text(v) for v in values) + "]"


# Inputs, as common table expressions.

_POSTINGS = """
postings AS (
  SELECT 1::INTEGER AS posting_type, o_orderkey AS id,
         CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey * 10 + 1 END::BIGINT AS accepted_answer,
         NULL::BIGINT AS parent_id, length(o_orderpriority)::INTEGER AS score,
         o_orderpriority AS tags
  FROM orders
  UNION ALL
  SELECT 2::INTEGER, l_orderkey * 10 + l_linenumber, NULL::BIGINT,
         CASE WHEN (l_orderkey * 10 + l_linenumber) % 97 = 0 THEN -1
              WHEN (l_orderkey * 10 + l_linenumber) % 101 <> 0 THEN l_orderkey END::BIGINT,
         l_quantity::INTEGER - 25, NULL::VARCHAR
  FROM lineitem
)"""

_QUESTIONS_ANSWERS = _POSTINGS + """,
questions AS (SELECT * FROM postings WHERE posting_type = 1),
answers AS (
  SELECT * FROM postings WHERE posting_type = 2 AND parent_id IS NOT NULL AND parent_id <> -1
)"""

_VECTORS = _QUESTIONS_ANSWERS + f""",
vectors AS (
  SELECT q.id AS qid, ((list_position({_list(tables.TOPICS)}, q.tags) - 1) * {km.SPREAD})::INTEGER AS x,
         greatest(max(a.score), 0)::INTEGER AS y
  FROM questions q JOIN answers a ON q.id = a.parent_id
  WHERE list_position({_list(tables.TOPICS)}, q.tags) > 0
  GROUP BY q.id, q.tags
)"""

_ARTICLES = """
articles AS (SELECT 'doc' || doc_id AS title, text FROM documents)"""

_VOCABULARY = f"""
vocabulary AS (
  SELECT unnest({_list(tables.TERMS)}) AS term, unnest(range({len(tables.TERMS)})) AS position
)"""

_MENTIONS = _ARTICLES + "," + _VOCABULARY + """,
mentions AS (
  SELECT v.term, a.title, a.text, v.position
  FROM articles a JOIN vocabulary v ON list_contains(string_split(a.text, ' '), v.term)
)"""

_PAIR_MENTIONS = _ARTICLES + f""",
letters AS (SELECT unnest(string_split('{tables.LETTERS}', '')) AS letter),
vocabulary AS (
  SELECT a.letter || b.letter AS term,
         (row_number() OVER (ORDER BY a.letter, b.letter) - 1)::INTEGER AS position
  FROM letters a, letters b WHERE a.letter <> '' AND b.letter <> ''
),
tokens AS (SELECT DISTINCT title, text, unnest(string_split(text, ' ')) AS term FROM articles),
mentions AS (SELECT term, title, text, position FROM tokens JOIN vocabulary USING (term))"""

_TABLE_MENTIONS = _ARTICLES + """,
vocabulary AS (
  SELECT term, CAST('0x' || substr(md5(term), 1, 8) AS BIGINT) AS position FROM (
    SELECT unnest(string_split(text, ' ')) AS term FROM conversations UNION SELECT c_name FROM customer
  ) WHERE length(term) >= 3
),
tokens AS (SELECT DISTINCT title, text, unnest(string_split(text, ' ')) AS term FROM articles),
mentions AS (SELECT term, title, text, position FROM tokens JOIN vocabulary USING (term))"""

_LOOKED_UP = _ARTICLES + f""",
vocabulary AS (
  SELECT unnest({_list(tables.LOOKED_UP)}) AS term, unnest(range({len(tables.LOOKED_UP)})) AS position
),
tokens AS (SELECT DISTINCT title, unnest(string_split(text, ' ')) AS term FROM articles),
mentions AS (SELECT term, title, position FROM tokens JOIN vocabulary USING (term))"""

_SURVEY = """
survey AS (
  SELECT 'r-' || l_orderkey || '-' || l_linenumber AS tucaseid,
         (1 + l_partkey % 5)::INTEGER AS telfs,
         (1 + l_suppkey % 2)::INTEGER AS tesex,
         (10 + l_orderkey % 75)::INTEGER AS teage,
         (300 + l_partkey % 301)::DOUBLE AS t010101,
         (l_suppkey % 61)::DOUBLE AS t030101,
         (l_orderkey % 91)::DOUBLE AS t110101,
         (l_linenumber * 5)::DOUBLE AS t180101,
         (l_linenumber * 3)::DOUBLE AS t180301,
         (l_quantity * 7)::DOUBLE AS t050101,
         (l_suppkey % 31)::DOUBLE AS t180501,
         (l_partkey % 121)::DOUBLE AS t020101,
         (l_orderkey % 181)::DOUBLE AS t120301,
         l_linenumber::DOUBLE AS t189999,
         999::DOUBLE AS t170101
  FROM lineitem
)"""

_SUMMARY = _SURVEY + """,
summary AS (
  SELECT CASE WHEN telfs >= 1 AND telfs < 3 THEN 'working' ELSE 'not working' END AS working,
         CASE WHEN tesex = 1 THEN 'male' ELSE 'female' END AS sex,
         CASE WHEN teage BETWEEN 15 AND 22 THEN 'young'
              WHEN teage BETWEEN 23 AND 55 THEN 'active' ELSE 'elder' END AS age,
         (t010101 + t030101 + t110101 + t180101 + t180301) / 60.0::DOUBLE AS "primaryNeeds",
         (t050101 + t180501) / 60.0::DOUBLE AS work,
         (t020101 + t120301 + t189999) / 60.0::DOUBLE AS other
  FROM survey WHERE telfs <= 4
)"""

_LISTINGS = """
listings AS (
  SELECT o_orderpriority AS street, o_custkey::INTEGER AS zip,
         floor(o_totalprice)::INTEGER AS price
  FROM orders
)"""


def _with(inputs: str, query: str) -> str:
    return f"WITH {inputs.strip()}\n{query.strip()}"


def _block(key: str, size: str) -> str:
    number = f"CAST('0x' || substr(md5(CAST({key} AS VARCHAR)), 1, 8) AS BIGINT)"
    return f"CASE WHEN {size} > 1 THEN {number} % {size} ELSE 0 END"


_LOT = f"md5('{SEED}:' || qid)"

_STRATIFIED = f"""
  SELECT * FROM (
    SELECT qid, x, y, (row_number() OVER (PARTITION BY x ORDER BY {_LOT}, qid))::INTEGER AS rank
    FROM vectors
  ) WHERE rank <= {PER_TOPIC}"""

_START = _VECTORS + f""",
points AS MATERIALIZED (
  SELECT x::BIGINT AS x, y::BIGINT AS y, count(*) AS wt FROM vectors GROUP BY x, y
),
m0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY x, rank) - 1 AS i, x::BIGINT AS x, y::BIGINT AS y,
         false AS done
  FROM ({_STRATIFIED})
)"""


def _closest(means: str) -> str:
    return f"""
  SELECT x, y, wt, i AS cluster FROM (
    SELECT p.x, p.y, p.wt, m.i, row_number() OVER (
             PARTITION BY p.x, p.y
             ORDER BY (p.x - m.x) * (p.x - m.x) + (p.y - m.y) * (p.y - m.y), m.i) AS r
    FROM points p, {means} m
  ) WHERE r = 1"""


def _round(number: int) -> str:
    """One round of assigning and averaging; means that have converged are passed on."""
    old, new = f"m{number - 1}", f"m{number}"
    return f""",
a{number} AS MATERIALIZED ({_closest(old)}),
{new} AS MATERIALIZED (
  SELECT i, CASE WHEN done THEN x ELSE nx END AS x, CASE WHEN done THEN y ELSE ny END AS y,
         done OR sum((nx - x) * (nx - x) + (ny - y) * (ny - y)) OVER () < {km.ETA} AS done
  FROM (
    SELECT o.i, o.x, o.y, o.done,
           coalesce(s.nx, o.x) AS nx, coalesce(s.ny, o.y) AS ny
    FROM {old} o LEFT JOIN (
      SELECT cluster, (sum(x * wt) // sum(wt))::BIGINT AS nx, (sum(y * wt) // sum(wt))::BIGINT AS ny
      FROM a{number} GROUP BY cluster
    ) s ON o.i = s.cluster
  )
)"""


def kmeans_converged() -> str:
    """Whether the rounds were enough for the tables at hand."""
    return _with(_kmeans(KMEANS_ROUNDS), f"SELECT bool_and(done) FROM m{KMEANS_ROUNDS}")


def _kmeans(rounds: int) -> str:
    return _START + "".join(_round(n) for n in range(1, rounds + 1))


def _means(rounds: int) -> str:
    means = f"SELECT i::INTEGER AS cluster, x::INTEGER AS x, y::INTEGER AS y FROM m{rounds}"
    return _with(_kmeans(rounds), means)


_RESULTS = _kmeans(KMEANS_ROUNDS) + f""",
assigned AS MATERIALIZED (
  SELECT v.x, v.y, c.cluster FROM vectors v JOIN (
    {_closest(f'm{KMEANS_ROUNDS}')}
  ) c ON v.x = c.x AND v.y = c.y
),
topics AS (SELECT cluster, x, count(*) AS n FROM assigned GROUP BY cluster, x),
ranked AS (
  SELECT cluster, x, n, sum(n) OVER (PARTITION BY cluster) AS size,
         row_number() OVER (PARTITION BY cluster ORDER BY n DESC, x) AS r
  FROM topics
),
medians AS (
  SELECT cluster, trunc(median(y))::INTEGER AS median FROM assigned GROUP BY cluster
),
results AS (
  SELECT cluster, ({_list(tables.TOPICS)})[x // {km.SPREAD} + 1] AS label, 100.0::DOUBLE * n / size AS percent,
         size::BIGINT AS size, median
  FROM ranked JOIN medians USING (cluster) WHERE r = 1
)"""

# Rounds until the means have converged, a row per mean.
_HISTORY = _with(
    _kmeans(KMEANS_ROUNDS),
    "\nUNION ALL ".join(
        f"SELECT {n} AS iteration, o.i::INTEGER AS cluster, o.x::INTEGER AS old_x, o.y::INTEGER AS old_y, m.x::INTEGER AS new_x, "
        f"m.y::INTEGER AS new_y, coalesce(s.size, 0)::BIGINT AS size, ((m.x - o.x) * (m.x - o.x) + (m.y - o.y) * (m.y - o.y))::DOUBLE AS distance "
        f"FROM m{n - 1} o JOIN m{n} m USING (i) LEFT JOIN (SELECT cluster, sum(wt) AS size FROM a{n} GROUP BY cluster) s ON s.cluster = o.i "
        "WHERE NOT o.done"
        for n in range(1, KMEANS_ROUNDS + 1)
    ),
)

_DRAWN = _VECTORS + f""",
points AS (SELECT x, y, count(*) AS wt FROM vectors GROUP BY x, y),
lots AS (
  SELECT x, y, copy, sum(step) OVER (PARTITION BY x, y ORDER BY copy) AS key FROM (
    SELECT x, y, copy, -ln((CAST('0x' || substr(md5('{SEED}:' || x || ':' || y || ':' || copy), 1, 13) AS BIGINT)::DOUBLE + 0.5)
      / {1 << 52}::DOUBLE) / (wt - copy + 1) AS step
    FROM (SELECT *, unnest(range(1, least(wt, {SAMPLED}) + 1)) AS copy FROM points)
  )
)"""

_RANKED = "SELECT term, count(*) AS n FROM mentions GROUP BY term, position ORDER BY n DESC, position"
_RANK_FOUND = _with(_MENTIONS, _RANKED)


def _index_blocks(mentions: str) -> str:
    return _with(
        mentions
        + f""",
entries AS (SELECT term, title, count(*) AS copies FROM mentions GROUP BY term, title),
sizes AS (
  SELECT term, ceil(count(*) / {BLOCK_TITLES})::BIGINT AS blocks FROM entries GROUP BY term
),
blocked AS (
  SELECT term, title, copies, {_block('title', 'blocks')} AS block
  FROM entries JOIN sizes USING (term)
)""",
        "SELECT term, block::BIGINT AS block, string_agg(title, ',' ORDER BY title) AS titles, "
        "sum(copies)::BIGINT AS n FROM blocked GROUP BY term, block",
    )


_GROUPED = _with(
    _SUMMARY,
    """
SELECT working, sex, age, round(avg("primaryNeeds"), 1) AS "primaryNeeds",
       round(avg(work), 1) AS work, round(avg(other), 1) AS other
FROM summary GROUP BY working, sex, age ORDER BY working, sex, age""",
)

_PRIMARY = ("t010101", "t030101", "t110101", "t180101", "t180301")
_WORK = ("t050101", "t180501")
_OTHER = ("t020101", "t120301", "t189999")
_NONE = ("t170101",)


def _classified() -> str:
    groups = (("'primaryNeeds'", _PRIMARY), ("'work'", _WORK), ("'other'", _OTHER))
    rows = [
        f"SELECT '{name}' AS name, {label} AS category, sum({name}) AS minutes FROM survey"
        for label, names in (*groups, ("NULL::VARCHAR", _NONE))
        for name in names
    ]
    return _with(_SURVEY, "\nUNION ALL ".join(rows))


_LINES = _with(
    _POSTINGS,
    """
SELECT posting_type || ',' || id || ',' || coalesce(accepted_answer::VARCHAR, '') || ',' ||
       coalesce(parent_id::VARCHAR, '') || ',' || score ||
       CASE WHEN tags IS NULL THEN '' ELSE ',' || tags END AS value
FROM postings""",
)

_GROUP_AVG = _with(_LISTINGS, "SELECT zip, avg(price)::DOUBLE AS avg_price FROM listings GROUP BY zip")


def oracle_sql() -> dict[str, str]:
    return {
        "src_text": _LINES,
        "src_postings": _with(_POSTINGS, "SELECT * FROM postings"),
        "src_csv_header_typed": _with(
            _SURVEY,
            "SELECT * REPLACE (telfs::DOUBLE AS telfs, tesex::DOUBLE AS tesex, "
            "teage::DOUBLE AS teage) FROM survey",
        ),
        "src_csv_infer": _with(_SURVEY, "SELECT * FROM survey"),
        "src_json_typed": "SELECT * FROM events",
        "src_article_dump": _with(_ARTICLES, "SELECT title, text FROM articles"),
        "src_article_records": _with(_ARTICLES, "SELECT title, text FROM articles"),
        "mention_count": _with(
            _ARTICLES,
            "SELECT 'the' AS term, count(*) AS n FROM articles "
            "WHERE list_contains(string_split(text, ' '), 'the')",
        ),
        "rank_scan": _with(
            _MENTIONS,
            "SELECT v.term, count(m.title) AS n FROM vocabulary v "
            "LEFT JOIN mentions m ON v.term = m.term "
            "GROUP BY v.term, v.position ORDER BY n DESC, v.position",
        ),
        "rank_reduce": _RANK_FOUND,
        "rank_index": _RANK_FOUND,
        "inverted_index": _with(_MENTIONS, "SELECT term, title, text FROM mentions"),
        "inverted_index_blocks": _index_blocks(_MENTIONS),
        "rank_index_long": _with(_PAIR_MENTIONS, _RANKED),
        "inverted_index_long": _with(_PAIR_MENTIONS, "SELECT term, title, text FROM mentions"),
        "inverted_index_blocks_long": _index_blocks(_PAIR_MENTIONS),
        "rank_vocabulary_table": _with(
            _TABLE_MENTIONS,
            "SELECT v.term, count(m.title) AS n FROM vocabulary v LEFT JOIN mentions m ON v.term = m.term "
            "GROUP BY v.term, v.position ORDER BY n DESC, v.position, v.term",
        ),
        "index_vocabulary_table": _with(_TABLE_MENTIONS, "SELECT term, title, text FROM mentions"),
        "stored_index_lookup": _with(_LOOKED_UP, "SELECT term, title, count(*) AS copies FROM mentions GROUP BY term, title"),
        "stored_index_rank": _with(_LOOKED_UP, _RANKED),
        "word_count": _with(
            _ARTICLES,
            "SELECT word, count(*) AS n, word || ' ' || count(*) AS line FROM "
            "(SELECT unnest(string_split(text, ' ')) AS word FROM articles) "
            "WHERE word <> '' GROUP BY word",
        ),
        "select_where_sort": "SELECT c_custkey::INTEGER AS id, 'Nation' || c_nationkey AS lname, "
        "c_name AS fname FROM customer WHERE c_mktsegment = 'BUILDING' AND c_nationkey < 15 "
        "ORDER BY id",
        "group_max": _with(_LISTINGS, "SELECT zip, max(price) AS max_price FROM listings GROUP BY zip"),
        "group_min": _with(_LISTINGS, "SELECT zip, min(price) AS min_price FROM listings GROUP BY zip"),
        "group_avg": _GROUP_AVG,
        "group_avg_typed": _GROUP_AVG,
        "group_count_2key": "SELECT user_id::INTEGER AS author, event_type AS forum, count(*) AS n "
        "FROM events GROUP BY user_id, event_type ORDER BY forum, n DESC, author",
        "row_count": "SELECT count(*) AS n FROM lineitem",
        "global_sum": _with(
            _POSTINGS, "SELECT coalesce(sum(score), 0)::BIGINT AS total FROM postings"
        ),
        "global_max": _with(_LISTINGS, "SELECT max(price) AS largest FROM listings"),
        "row_extract": _GROUP_AVG,
        "column_classify": _classified(),
        "timeuse_summary": _with(_SUMMARY, "SELECT * FROM summary"),
        "timeuse_summary_long": _with(_SUMMARY, "SELECT * FROM summary"),
        "timeuse_typed_rows": _with(_SUMMARY, "SELECT * FROM summary"),
        "timeuse_grouped": _GROUPED,
        "timeuse_sql": _GROUPED,
        "timeuse_typed": _GROUPED,
        "posting_pairs": "SELECT o_orderkey AS qid, o_orderpriority AS tags, "
        "l_orderkey * 10 + l_linenumber AS answer_id, l_quantity::INTEGER - 25 AS answer_score "
        "FROM orders JOIN lineitem ON o_orderkey = l_orderkey "
        "WHERE (l_orderkey * 10 + l_linenumber) % 97 <> 0 AND (l_orderkey * 10 + l_linenumber) % 101 <> 0",
        "posting_groups": _with(
            _QUESTIONS_ANSWERS
            + f""",
added AS (
  SELECT id, parent_id, score, count(*) AS copies FROM answers GROUP BY id, parent_id, score
),
sizes AS (
  SELECT parent_id, ceil(count(*) / {BLOCK_ANSWERS})::BIGINT AS blocks
  FROM added GROUP BY parent_id
),
blocked AS (
  SELECT q.id AS qid, q.tags, a.id, a.score, a.copies, {_block('a.id', 'blocks')} AS block
  FROM questions q JOIN added a ON q.id = a.parent_id JOIN sizes s ON s.parent_id = q.id
)""",
            "SELECT qid, block::BIGINT AS block, tags, "
            "string_agg(id || ':' || score || ':' || copies, ',' ORDER BY id, score) AS answers "
            "FROM blocked GROUP BY qid, block, tags",
        ),
        "posting_highscore": _with(
            _QUESTIONS_ANSWERS,
            "SELECT q.id AS qid, q.accepted_answer, q.score, q.tags, "
            "greatest(max(a.score), 0)::INTEGER AS high_score "
            "FROM questions q JOIN answers a ON q.id = a.parent_id "
            "GROUP BY q.id, q.accepted_answer, q.score, q.tags",
        ),
        "posting_vectors": _with(_VECTORS, "SELECT qid, x, y FROM vectors"),
        "sample_uniform": _with(
            _VECTORS, f"SELECT qid, x, y FROM vectors ORDER BY {_LOT}, qid LIMIT 45"
        ),
        "sample_stratified": _with(_VECTORS, _STRATIFIED),
        "nearest_center": _with(
            _START
            + f""",
closest AS ({_closest('m0')})""",
            "SELECT v.qid, v.x, v.y, c.cluster::INTEGER AS cluster "
            "FROM vectors v JOIN closest c ON v.x = c.x AND v.y = c.y",
        ),
        "kmeans_step": _means(1),
        "kmeans": _means(KMEANS_ROUNDS),
        "kmeans_bounded": _means(KMEANS_ROUNDS),
        "kmeans_history": _HISTORY,
        "sample_points": _with(_DRAWN, f"SELECT x, y, copy FROM lots ORDER BY key, x, y LIMIT {SAMPLED}"),
        "sample_points_stratified": _with(
            _DRAWN,
            "SELECT x, y, copy, rank::INTEGER AS rank FROM (SELECT *, row_number() OVER (PARTITION BY x ORDER BY key, x, y) AS rank FROM lots) "
            f"WHERE rank <= {SAMPLED}",
        ),
        "group_median": "SELECT l_returnflag, median(round(l_extendedprice * 100)::BIGINT) AS median FROM lineitem GROUP BY l_returnflag",
        "kmeans_late_start": _means(3),
        "kmeans_compiled": _means(KMEANS_ROUNDS),
        "cluster_results": _with(_RESULTS, "SELECT * EXCLUDE (cluster) FROM results ORDER BY median, cluster"),
        "cluster_report": _with(
            _RESULTS,
            "SELECT printf('%7d  %-17s (%-5.1f%%)      %7d', median, label, percent, size) AS line "
            "FROM results ORDER BY median, cluster",
        ),
        "cluster_report_rows": _with(
            _RESULTS,
            f"SELECT unnest(range(1, {len(km.REPORT_HEADER) + 1}))::INTEGER AS number, unnest({_list(km.REPORT_HEADER)}) AS line "
            f"UNION ALL SELECT ({len(km.REPORT_HEADER)} + row_number() OVER (ORDER BY median, cluster))::INTEGER, "
            "printf('%7d  %-17s (%-5.1f%%)      %7d', median, label, percent, size) FROM results",
        ),
        "set_reconcile": """
SELECT 'unexpected' AS side, key FROM (
  SELECT l_orderkey AS key FROM lineitem EXCEPT SELECT o_orderkey FROM orders)
UNION ALL
SELECT 'missing' AS side, key FROM (
  SELECT o_orderkey AS key FROM orders EXCEPT SELECT l_orderkey FROM lineitem)""",
        "order_check_ranges": """
SELECT user_id, ts, value, previous FROM (
  SELECT user_id, ts, value, lag(value) OVER (PARTITION BY user_id ORDER BY ts) AS previous
  FROM events
) WHERE previous < value""",
        "order_check": """
SELECT user_id, event_id, value, previous FROM (
  SELECT user_id, event_id, value,
         lag(value) OVER (PARTITION BY user_id ORDER BY event_id) AS previous
  FROM events
) WHERE previous < value""",
    }
