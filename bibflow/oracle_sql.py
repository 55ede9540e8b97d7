"""DuckDB SQL that recomputes each registered query from the base tables.

These are the independent oracles of ``__spark_entry__.oracle_sql()``:
they never read JSON, they rebuild the expected rows from ``orders``,
``lineitem``, ``part`` and ``supplier`` with joins, the way a reader of
``bibflow.fixtures`` would compute them by hand.
"""

from __future__ import annotations

# Record-level rows of the nested feed, typed (date, int flag).
_NESTED_CTE = """
li AS (SELECT l_orderkey, l_partkey AS code, l_suppkey FROM lineitem),
lk AS (SELECT p_partkey, p_brand AS abbrev, p_name AS name FROM part),
subj AS (
  SELECT DISTINCT li.l_orderkey AS k, CAST(li.code AS VARCHAR) AS subject_code,
         lk.name AS subject_name, lk.abbrev AS subject_abbrev
  FROM li LEFT JOIN lk ON lk.p_partkey = li.code),
auth AS (
  SELECT DISTINCT li.l_orderkey AS k, s.s_name AS author_given_name,
         CAST(li.l_suppkey AS VARCHAR) AS author_surname,
         'https://example.org/author/' || CAST(li.l_suppkey AS VARCHAR) AS author_url,
         CAST(to_json({'@id': CAST(s.s_nationkey AS VARCHAR)}) AS VARCHAR) AS author_affiliation
  FROM li LEFT JOIN supplier s ON s.s_suppkey = li.l_suppkey),
nl AS (SELECT l_orderkey AS k, count(*) AS n_lines FROM lineitem GROUP BY l_orderkey),
nested AS (
  SELECT o.o_orderkey AS seq,
    CASE WHEN o.o_orderkey % 50 = 0 THEN NULL ELSE '10.1000/' || CAST(o.o_orderkey AS VARCHAR) END AS doi,
    'order ' || CAST(o.o_orderkey AS VARCHAR) AS title,
    'Abstract of order ' || CAST(o.o_orderkey AS VARCHAR) AS abstract,
    CASE WHEN o.o_orderstatus = 'F' THEN 'Conference Paper' ELSE 'Article' END AS document_type,
    CASE WHEN o.o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'Conference Proceeding'
         ELSE 'Journal' END AS source_type,
    CAST(o.o_orderdate AS DATE) AS publication_date,
    'Journal of ' || o.o_orderpriority AS source_title,
    'Publisher ' || o.o_orderstatus AS publisher,
    CASE WHEN o.o_orderkey % 7 = 0 THEN '"' || o.o_orderpriority || '"'
         ELSE CAST(to_json([{'$': o.o_orderpriority}, {'$': o.o_orderstatus}]) AS VARCHAR) END AS author_keywords,
    CASE WHEN o.o_orderstatus = 'O'
         THEN CAST(to_json({'agency': 'Agency ' || CAST(o.o_custkey AS VARCHAR)}) AS VARCHAR)
    END AS funding_details,
    CAST(nl.n_lines AS INTEGER) AS ref_count,
    CASE WHEN o.o_orderstatus = 'O' THEN 1 ELSE 0 END AS open_access,
    CAST(to_json({'@id': CAST(o.o_orderkey AS VARCHAR)}) AS VARCHAR) AS affiliation,
    'eng' AS language,
    CAST(o.o_custkey AS INTEGER) AS cited_by,
    o.o_orderstatus AS status_state,
    concat_ws('-', CAST(year(o.o_orderdate) AS VARCHAR),
              CASE WHEN o.o_orderstatus = 'P' THEN NULL ELSE CAST(month(o.o_orderdate) AS VARCHAR) END,
              CAST(day(o.o_orderdate) AS VARCHAR)) AS delivered_date
  FROM orders o LEFT JOIN nl ON nl.k = o.o_orderkey)
"""

# Record-level rows of the scraped feed, typed.
_SCRAPED_CTE = """
scraped AS (
  SELECT o.o_orderkey AS seq,
    CASE WHEN o.o_orderkey % 50 = 0 THEN NULL
         WHEN o.o_orderstatus = 'P' THEN '10.2000/' || CAST(o.o_orderkey AS VARCHAR)
         ELSE '10.1000/' || CAST(o.o_orderkey AS VARCHAR) END AS doi,
    'scraped order ' || CAST(o.o_orderkey AS VARCHAR) AS title,
    'Scraped abstract ' || CAST(o.o_orderkey AS VARCHAR) AS abstract,
    CASE WHEN o.o_orderkey % 11 = 0 THEN NULL
         WHEN o.o_orderstatus = 'F' THEN 'Conference Paper' ELSE 'Article' END AS document_type,
    CASE WHEN o.o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'Conference Proceeding'
         ELSE 'Journal' END AS source_type,
    CASE WHEN o.o_orderkey % 13 = 0 THEN NULL ELSE CAST(o.o_orderdate AS DATE) END AS publication_date,
    'Journal of ' || o.o_orderpriority AS source_title,
    CAST(NULL AS VARCHAR) AS publisher,
    CASE WHEN o.o_orderkey % 5 = 0 THEN '[]'
         WHEN o.o_orderkey % 7 = 0 THEN '"' || o.o_orderpriority || '"'
         ELSE CAST(to_json([{'$': o.o_orderpriority}]) AS VARCHAR) END AS author_keywords,
    CAST(NULL AS VARCHAR) AS funding_details,
    CAST(NULL AS INTEGER) AS ref_count,
    CASE WHEN o.o_orderstatus = 'O' THEN 1 ELSE 0 END AS open_access,
    CASE WHEN o.o_orderstatus = 'P' THEN NULL
         ELSE CAST(to_json({'@id': CAST(o.o_custkey AS VARCHAR)}) AS VARCHAR) END AS affiliation,
    CAST(NULL AS VARCHAR) AS language,
    CAST(o.o_custkey AS INTEGER) AS cited_by,
    CAST(NULL AS VARCHAR) AS status_state,
    CAST(NULL AS VARCHAR) AS delivered_date
  FROM orders o)
"""

# Table form of one (record, subject, author) row.
_TABLE_COLS = """
  r.doi, r.title, r.abstract, r.document_type, r.source_type,
  strftime(r.publication_date, '%Y-%m-%d') AS publication_date,
  r.source_title, r.publisher, r.author_keywords,
  s.subject_code, s.subject_name, s.subject_abbrev,
  a.author_given_name, a.author_surname, a.author_url, a.author_affiliation,
  CASE WHEN a.k IS NULL THEN NULL ELSE CAST(to_json({
      'preferred-name': {'ce:given-name': a.author_given_name, 'ce:surname': a.author_surname},
      'author-url': a.author_url, 'affiliation': CAST(a.author_affiliation AS JSON),
      '@auid': a.author_surname}) AS VARCHAR) END AS author_details,
  r.funding_details, r.ref_count, CAST(r.open_access AS BOOLEAN) AS open_access,
  r.affiliation, r.language, r.cited_by, r.status_state, r.delivered_date,
  {subject_json} AS subject_area
"""

_SUBJECT_JSON = """CASE WHEN s.k IS NULL THEN NULL ELSE CAST(to_json({
      '@code': s.subject_code, '@abbrev': s.subject_abbrev, '$': s.subject_name, '@_fa': 'true'}) AS VARCHAR) END"""

_FILTER = """
  r.doi IS NOT NULL AND (
    (r.document_type = 'Conference Paper' AND r.source_type = 'Conference Proceeding') OR
    (r.document_type <> 'Conference Paper' AND r.source_type <> 'Conference Proceeding'))
"""

_SURVIVOR_ORDER = """
  s.subject_code DESC NULLS LAST, s.subject_abbrev DESC NULLS LAST, s.subject_name DESC NULLS LAST,
  a.author_given_name DESC NULLS LAST, a.author_surname DESC NULLS LAST,
  a.author_url DESC NULLS LAST, a.author_affiliation DESC NULLS LAST
"""


def _exploded(rec: str, subjects: str) -> str:
    return f"""
  FROM {rec} r
  LEFT JOIN {subjects} s ON s.k = r.seq
  LEFT JOIN auth a ON a.k = r.seq
  WHERE {_FILTER}"""


def cross_explode() -> str:
    cols = _TABLE_COLS.replace("{subject_json}", _SUBJECT_JSON)
    return f"WITH {_NESTED_CTE} SELECT {cols} {_exploded('nested', 'subj')}"


def nested_pipeline() -> str:
    cols = _TABLE_COLS.replace("{subject_json}", _SUBJECT_JSON)
    return (f"WITH {_NESTED_CTE} SELECT {cols} {_exploded('nested', 'subj')} "
            f"QUALIFY row_number() OVER (PARTITION BY r.doi ORDER BY r.seq DESC, {_SURVIVOR_ORDER}) = 1")


# The scraped feed has one subject whose fields are all NULL.
_NULL_SUBJECT = """, nosubj AS (SELECT o_orderkey AS k, CAST(NULL AS VARCHAR) AS subject_code,
   CAST(NULL AS VARCHAR) AS subject_name, CAST(NULL AS VARCHAR) AS subject_abbrev FROM orders)"""


def scraped_pipeline() -> str:
    cols = _TABLE_COLS.replace("{subject_json}", "'{}'")
    return (f"WITH {_NESTED_CTE}, {_SCRAPED_CTE} {_NULL_SUBJECT} SELECT {cols} "
            f"{_exploded('scraped', 'nosubj')} "
            f"QUALIFY row_number() OVER (PARTITION BY r.doi ORDER BY r.seq DESC, {_SURVIVOR_ORDER}) = 1")


_ORDER_KEYS = """s.subject_code AS o1, s.subject_abbrev AS o2, s.subject_name AS o3,
  a.author_given_name AS o4, a.author_surname AS o5, a.author_url AS o6, a.author_affiliation AS o7"""


def merge_feeds() -> str:
    nested_cols = _TABLE_COLS.replace("{subject_json}", _SUBJECT_JSON)
    scraped_cols = _TABLE_COLS.replace("{subject_json}", "'{}'")
    return f"""WITH {_NESTED_CTE}, {_SCRAPED_CTE} {_NULL_SUBJECT},
  both_feeds AS (
    SELECT 1 AS feed_rank, r.seq AS seq, {nested_cols}, {_ORDER_KEYS}
    {_exploded('nested', 'subj')}
    UNION ALL
    SELECT 2 AS feed_rank, r.seq AS seq, {scraped_cols}, {_ORDER_KEYS}
    {_exploded('scraped', 'nosubj')})
SELECT * EXCLUDE (feed_rank, seq, o1, o2, o3, o4, o5, o6, o7) FROM both_feeds
QUALIFY row_number() OVER (PARTITION BY doi ORDER BY feed_rank DESC, seq DESC,
  o1 DESC NULLS LAST, o2 DESC NULLS LAST, o3 DESC NULLS LAST, o4 DESC NULLS LAST,
  o5 DESC NULLS LAST, o6 DESC NULLS LAST, o7 DESC NULLS LAST) = 1"""


def _with(*ctes: str) -> str:
    return "WITH " + ", ".join(c.strip() for c in ctes) + " "


_COUNTS = """n_s AS (SELECT k, CAST(count(*) AS INTEGER) AS n FROM subj GROUP BY k),
n_a AS (SELECT k, CAST(count(*) AS INTEGER) AS n FROM auth GROUP BY k)"""

_RECORD_SCALARS = """r.seq, r.doi, r.title, r.abstract, r.document_type, r.source_type,
  r.publication_date, r.source_title, r.publisher, r.author_keywords, r.funding_details,
  r.ref_count, r.open_access, r.affiliation, r.language, r.cited_by, r.status_state,
  r.delivered_date"""


def flatten_nested() -> str:
    return (_with(_NESTED_CTE, _COUNTS) +
            f"""SELECT {_RECORD_SCALARS}, coalesce(ns.n, 0) AS n_subjects, coalesce(na.n, 0) AS n_authors
            FROM nested r LEFT JOIN n_s ns ON ns.k = r.seq LEFT JOIN n_a na ON na.k = r.seq""")


def flatten_scraped() -> str:
    return (_with(_NESTED_CTE, _SCRAPED_CTE, _COUNTS) +
            f"""SELECT {_RECORD_SCALARS}, coalesce(na.n, 0) AS n_authors
            FROM scraped r LEFT JOIN n_a na ON na.k = r.seq""")


def align_schema() -> str:
    return (_with(_NESTED_CTE, _SCRAPED_CTE) +
            f"""SELECT 1 AS feed_rank, {_RECORD_SCALARS} FROM nested r
            UNION ALL SELECT 2 AS feed_rank, {_RECORD_SCALARS} FROM scraped r""")


def author_fields() -> str:
    return (_with(_NESTED_CTE) +
            """SELECT r.seq, a.author_given_name, a.author_surname, a.author_url, a.author_affiliation
            FROM nested r LEFT JOIN auth a ON a.k = r.seq""")


def explode_subjects() -> str:
    return (_with(_NESTED_CTE) +
            f"""SELECT r.seq, s.subject_code, s.subject_name, s.subject_abbrev,
            {_SUBJECT_JSON} AS subject_area
            FROM nested r LEFT JOIN subj s ON s.k = r.seq""")


def explode_authors() -> str:
    return (_with(_NESTED_CTE) +
            """SELECT r.seq, r.doi, CASE WHEN a.k IS NULL THEN NULL ELSE CAST(to_json({
              'preferred-name': {'ce:given-name': a.author_given_name, 'ce:surname': a.author_surname},
              'author-url': a.author_url, 'affiliation': CAST(a.author_affiliation AS JSON),
              '@auid': a.author_surname}) AS VARCHAR) END AS author_details
            FROM nested r LEFT JOIN auth a ON a.k = r.seq""")


def key_not_null() -> str:
    return _with(_NESTED_CTE, _SCRAPED_CTE) + "SELECT seq, doi FROM scraped WHERE doi IS NOT NULL"


def type_agreement() -> str:
    return (_with(_NESTED_CTE, _SCRAPED_CTE) +
            """SELECT seq, document_type, source_type FROM scraped
            WHERE (document_type = 'Conference Paper' AND source_type = 'Conference Proceeding')
               OR (document_type <> 'Conference Paper' AND source_type <> 'Conference Proceeding')""")


def sink_coerce() -> str:
    return (_with(_NESTED_CTE, _SCRAPED_CTE) +
            """SELECT seq, strftime(publication_date, '%Y-%m-%d') AS publication_date,
            CAST(open_access AS BOOLEAN) AS open_access, author_keywords, affiliation
            FROM scraped""")


def parse_records() -> str:
    return """SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
              FROM events"""


# Text renderings of order values, some deliberately malformed.
_DATE_TEXT = """CASE WHEN o_orderkey % 10 = 0 THEN 'bad-' || CAST(o_orderkey AS VARCHAR)
                     WHEN o_orderkey % 10 = 5 THEN strftime(o_orderdate, '%Y-13-%d')
                     ELSE strftime(o_orderdate, '%Y-%m-%d') END"""
_INT_TEXT = """CASE WHEN o_orderkey % 10 = 0 THEN 'x' || CAST(o_custkey AS VARCHAR)
                    WHEN o_orderkey % 10 = 5 THEN CAST(o_custkey AS VARCHAR) || '.0'
                    WHEN o_orderkey % 10 = 3 THEN ' ' || CAST(o_custkey AS VARCHAR) || ' '
                    ELSE CAST(o_custkey AS VARCHAR) END"""


def safe_date() -> str:
    return f"SELECT o_orderkey, {_DATE_TEXT} AS text, TRY_CAST({_DATE_TEXT} AS DATE) AS value FROM orders"


def safe_int() -> str:
    return (f"SELECT o_orderkey, {_INT_TEXT} AS text, "
            f"TRY_CAST(TRY_CAST(trim({_INT_TEXT}) AS DOUBLE) AS INTEGER) AS value FROM orders")


def concat_date_parts() -> str:
    return """SELECT o_orderkey, concat_ws('-',
                CASE WHEN o_orderkey % 50 = 0 THEN NULL ELSE CAST(year(o_orderdate) AS VARCHAR) END,
                CASE WHEN o_orderkey % 50 = 0 OR o_orderstatus = 'P' THEN NULL
                     ELSE CAST(month(o_orderdate) AS VARCHAR) END,
                CASE WHEN o_orderkey % 50 = 0 THEN NULL ELSE CAST(day(o_orderdate) AS VARCHAR) END)
              AS delivered_date FROM orders"""


def flag_normalize() -> str:
    return """SELECT o_orderkey, coalesce(CASE o_orderstatus WHEN 'O' THEN true WHEN 'F' THEN false END,
              false) AS open_access FROM orders"""


def json_keywords() -> str:
    return """SELECT conv_id, turn, coalesce(CASE WHEN role = 'system' THEN NULL ELSE
              CAST(to_json(list_transform(string_split(text, chr(10)), lambda x: {'$': x})) AS VARCHAR) END,
              '[]') AS author_keywords FROM conversations"""


def json_affiliation() -> str:
    return """SELECT conv_id, turn, CASE WHEN role = 'system' THEN NULL ELSE
              CAST(to_json({'role': role, 'turn': turn}) AS VARCHAR) END AS affiliation
              FROM conversations"""


def upsert_latest() -> str:
    return """SELECT * FROM events
              QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1"""


_CONVERSATIONS = "SELECT conv_id, turn, role, text FROM conversations"


def split_concat_json() -> str:
    return _CONVERSATIONS


def json_array_docs() -> str:
    return _CONVERSATIONS


def ndjson_docs() -> str:
    return _CONVERSATIONS


def quarantine_records() -> str:
    return """SELECT CASE WHEN conv_id % 10 = 0 THEN 'malformed' ELSE 'ok' END AS status,
              count(*) AS n FROM conversations GROUP BY 1"""


def quarantine_files() -> str:
    return """WITH parts AS (
                SELECT floor(conv_id / 10) % 10 = 0 AS cut, count(*) AS n FROM conversations
                GROUP BY floor(conv_id / 10), floor(turn / 64))
              SELECT CASE WHEN cut THEN 'truncated' ELSE 'ok' END AS status,
                     count(*) AS n_files,
                     CAST(sum(CASE WHEN cut THEN n - 1 ELSE n END) AS BIGINT) AS n_records,
                     CAST(sum(CASE WHEN cut THEN 1 ELSE 0 END) AS BIGINT) AS n_errors
              FROM parts GROUP BY 1"""


_ORDER_ROWS = """SELECT CAST(year(o_orderdate) AS INTEGER) AS year, o_orderkey, o_custkey,
                 o_orderstatus, CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority
                 FROM orders"""


def year_scan() -> str:
    return _ORDER_ROWS


def year_range_scan() -> str:
    # Years 1996-2000, ``*.json`` names only: the odd years were written as JSON.
    return f"SELECT * FROM ({_ORDER_ROWS}) WHERE year BETWEEN 1996 AND 2000 AND year % 2 = 1"


def single_year() -> str:
    return f"SELECT * FROM ({_ORDER_ROWS}) WHERE year = 1997"


def year_audit() -> str:
    return """WITH y AS (SELECT CAST(range AS INTEGER) AS year FROM range(1993, 2005)),
              d AS (SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS year FROM orders)
              SELECT y.year, CASE WHEN d.year IS NULL THEN 'missing'
                                  WHEN y.year % 2 = 1 OR y.year IN (1999, 2000) THEN 'ok'
                                  ELSE 'empty' END AS status
              FROM y LEFT JOIN d ON d.year = y.year"""


def file_audit() -> str:
    return """SELECT year, count(*) AS n_records, CAST(0 AS BIGINT) AS n_errors,
                     CAST(CASE WHEN year IN (1999, 2000) THEN 1 ELSE 0 END AS BIGINT) AS n_empty_files
              FROM (SELECT CAST(year(o_orderdate) AS INTEGER) AS year FROM orders) GROUP BY year"""


def chunk_assign() -> str:
    return """SELECT event_id, row_number() OVER (ORDER BY event_id) AS position,
                     CAST((row_number() OVER (ORDER BY event_id) - 1) // 1000 AS BIGINT) AS chunk_id
              FROM events"""


def ingest_metrics() -> str:
    return """WITH c AS (SELECT event_type, (row_number() OVER (ORDER BY event_id) - 1) // 1000 AS chunk_id
                         FROM events)
              SELECT CAST(chunk_id AS BIGINT) AS chunk_id, count(*) AS chunk_size,
                     count(*) FILTER (WHERE event_type = 'error') AS n_flagged,
                     CAST(chunk_id * 1000 + count(*) AS BIGINT) AS running_total
              FROM c GROUP BY chunk_id"""


def record_size_profile() -> str:
    return """SELECT source, n_records, avg_bytes, max_bytes,
                     CAST(floor(0.75 * 24 * 1024 * 1024 * 1024 / avg_bytes) AS BIGINT) AS chunk_size,
                     CAST(floor(128 * 1024 * 1024 / avg_bytes) AS BIGINT) AS records_per_file
              FROM (SELECT source, count(*) AS n_records,
                           avg(strlen(CAST(to_json(d) AS VARCHAR))) AS avg_bytes,
                           CAST(max(strlen(CAST(to_json(d) AS VARCHAR))) AS INTEGER) AS max_bytes
                    FROM documents d GROUP BY source)"""


def record_size_quantiles() -> str:
    return """SELECT source, count(*) AS n_records, CAST(min(n) AS BIGINT) AS min_bytes, CAST(max(n) AS BIGINT) AS max_bytes,
                     true AS p50_near, true AS p95_near, true AS p99_near
              FROM (SELECT source, strlen(CAST(to_json(d) AS VARCHAR)) AS n FROM documents d) GROUP BY source"""


def schema_drift() -> str:
    """Fields of the event properties by event type, declared: ``k`` a number, ``ref`` text."""
    return """WITH e AS (SELECT event_type AS "group", props, unnest(json_keys(props)) AS key FROM events WHERE json_valid(props)),
  m AS (SELECT "group", '$[' || chr(39) || key || chr(39) || ']' AS path, json_type(props, '$."' || key || '"') AS t FROM e),
  seen AS (SELECT "group", path, CASE WHEN t IN ('VARCHAR') THEN 'string' WHEN t IN ('OBJECT', 'ARRAY', 'BOOLEAN', 'NULL') THEN lower(t)
             ELSE 'number' END AS kind, count(*) AS n_records FROM m GROUP BY ALL
           UNION ALL SELECT event_type, '$', 'malformed', count(*) FROM events WHERE NOT coalesce(json_valid(props), false) GROUP BY 1),
  declared(path, want) AS (VALUES ('$[''k'']', 'number'), ('$[''ref'']', 'any'))
SELECT s."group", s.path, s.kind, s.n_records, CASE WHEN want IS NULL THEN 'new' WHEN want IN ('any', kind) OR kind = 'null' THEN 'declared'
         ELSE 'changed' END AS status FROM seen s LEFT JOIN declared d ON d.path = s.path
UNION ALL SELECT g.event_type, d.path, NULL, 0, 'absent' FROM (SELECT DISTINCT event_type FROM events) g, declared d
WHERE NOT EXISTS (FROM seen s WHERE s."group" IS NOT DISTINCT FROM g.event_type AND s.path = d.path)"""


def merge_feeds_fill_nulls() -> str:
    """K04 with per-column NULL filling: each column's latest non-NULL value."""
    from bibflow.schemas import RECORD_NAMES

    nested_cols = _TABLE_COLS.replace("{subject_json}", _SUBJECT_JSON)
    scraped_cols = _TABLE_COLS.replace("{subject_json}", "'{}'")
    filled = ",\n  ".join(
        f"first({c} ORDER BY feed_rank DESC, seq DESC) FILTER (WHERE {c} IS NOT NULL) AS {c}"
        for c in RECORD_NAMES if c != "doi")
    return f"""WITH {_NESTED_CTE}, {_SCRAPED_CTE} {_NULL_SUBJECT},
  both_feeds AS (
    SELECT 1 AS feed_rank, r.seq AS seq, {nested_cols}, {_ORDER_KEYS}
    {_exploded('nested', 'subj')}
    UNION ALL
    SELECT 2 AS feed_rank, r.seq AS seq, {scraped_cols}, {_ORDER_KEYS}
    {_exploded('scraped', 'nosubj')}),
  per_record AS (
    SELECT * FROM both_feeds
    QUALIFY row_number() OVER (PARTITION BY feed_rank, seq ORDER BY
      o1 DESC NULLS LAST, o2 DESC NULLS LAST, o3 DESC NULLS LAST, o4 DESC NULLS LAST,
      o5 DESC NULLS LAST, o6 DESC NULLS LAST, o7 DESC NULLS LAST) = 1)
SELECT doi,
  {filled}
FROM per_record GROUP BY doi"""


def lines_multi_object() -> str:
    return """
SELECT CASE WHEN conv_id % 10 = 0 THEN 'malformed' ELSE 'ok' END AS status, count(*) AS n
FROM conversations GROUP BY 1
"""


def document_multi_value(convs_per_file: int, turns_per_file: int) -> str:
    return f"""
WITH f AS (SELECT conv_id // {convs_per_file} AS g, turn // {turns_per_file} AS p FROM conversations)
SELECT 'ok' AS status, count(*) AS n FROM f WHERE g % 10 <> 0 HAVING count(*) > 0
UNION ALL
SELECT 'malformed_file', count(DISTINCT (g, p)) FROM f WHERE g % 10 = 0 HAVING count(*) > 0
"""


def underscore_files(n_hidden: int) -> str:
    return f"""
SELECT 'ok' AS status, count(*) AS n FROM orders
UNION ALL
SELECT 'hidden_name', CAST({n_hidden} AS BIGINT)
"""


def corrected_titles() -> str:
    return f"""
SELECT doi, CASE WHEN CAST(split_part(doi, '/', 2) AS BIGINT) % 3 = 0 THEN 'corrected ' || title ELSE title END AS title
FROM ({nested_pipeline()})
"""


def chunk_feed(chunk_size: int) -> str:
    return f"""
WITH n AS (SELECT count(*) AS n FROM orders),
c AS (SELECT unnest(range(0, (n + {chunk_size} - 1) // {chunk_size})) AS chunk_id, n FROM n)
SELECT chunk_id, least({chunk_size}, n - chunk_id * {chunk_size}) AS chunk_size,
       least((chunk_id + 1) * {chunk_size}, n) AS running_total
FROM c
"""


# Records of ``write_mistyped_tree`` that are set aside, and authors that are.
_MISTYPED = """judged AS (SELECT r.*, coalesce(na.n, 0) AS n_authors, r.seq % 20 AS kind,
  r.seq % 20 IN (1, 2, 4) AS aside, r.seq % 20 = 3 AND coalesce(na.n, 0) >= 2 AS one_off
  FROM nested r LEFT JOIN n_a na ON na.k = r.seq)"""


def quarantine_types() -> str:
    root = "$[''abstracts-retrieval-response'']"
    return (_with(_NESTED_CTE, _COUNTS, _MISTYPED) + f"""
SELECT 'wrong_type' AS status, '{root}[''coredata'']' AS path, count(*) AS n FROM judged WHERE kind = 1 HAVING count(*) > 0
UNION ALL SELECT 'wrong_type', '{root}', count(*) FROM judged WHERE kind = 4 HAVING count(*) > 0
UNION ALL SELECT 'unknown_record', '$', count(*) FROM judged WHERE kind = 2 HAVING count(*) > 0
UNION ALL SELECT 'wrong_element', '{root}[''authors''][''author''][]', count(*) FROM judged WHERE one_off HAVING count(*) > 0
UNION ALL SELECT CASE WHEN coalesce({_FILTER}, false) THEN 'kept' ELSE 'filtered' END, NULL, count(*) FROM judged r WHERE NOT aside GROUP BY 1
UNION ALL SELECT 'authors', NULL, CAST(coalesce(sum(n_authors), 0) AS BIGINT) FROM judged WHERE NOT aside""")


def stream_counts() -> str:
    return (_with(_NESTED_CTE, _COUNTS, _MISTYPED) + f"""
SELECT count(*) AS n_read, count(*) FILTER (WHERE NOT aside AND coalesce({_FILTER}, false)) AS n_kept,
  count(*) FILTER (WHERE NOT aside AND NOT coalesce({_FILTER}, false)) AS n_filtered, count(*) FILTER (WHERE aside) AS n_quarantined,
  count(*) FILTER (WHERE one_off) AS n_elements, count(*) AS running_total FROM judged r""")


def stream_admission(n_hidden: int, n_empty: int) -> str:
    return f"""SELECT count(*) AS n_read, CAST(0 AS BIGINT) AS n_over_budget, true AS several_batches,
                      CAST({n_hidden} AS BIGINT) AS n_hidden, CAST({n_empty} AS BIGINT) AS n_empty FROM orders"""


# Orders whose scraped record stands in a ``*.json`` file of 2013 to 2023 (``write_scraped_tree``).
_IN_RANGE = "SELECT o_orderkey FROM orders WHERE year(o_orderdate) + 16 BETWEEN 2013 AND 2023 AND o_orderkey % 10 <> 0"


def scraped_files_pipeline() -> str:
    return f"SELECT * FROM ({scraped_pipeline()}) WHERE CAST(split_part(doi, '/', 2) AS BIGINT) IN ({_IN_RANGE})"


def merge_files_pipeline() -> str:
    return f"""WITH flat AS MATERIALIZED ({scraped_files_pipeline()})
SELECT * FROM flat UNION ALL SELECT * FROM ({nested_pipeline()}) WHERE doi NOT IN (SELECT doi FROM flat)"""
