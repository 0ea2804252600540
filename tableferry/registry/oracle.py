"""The registered queries as SQL over the same tables, for comparison."""

from __future__ import annotations

from tableferry.registry.queries import EXCLUDED, MIDDLE, PIECES, PLAIN_LOADS, REPORT_TITLE, TABLES

# Columns of the given tables.
COLUMNS = {
    "region": "r_regionkey r_name",
    "nation": "n_nationkey n_name n_regionkey",
    "customer": "c_custkey c_name c_nationkey c_acctbal c_mktsegment",
    "supplier": "s_suppkey s_name s_nationkey s_acctbal",
    "part": "p_partkey p_name p_brand p_type p_size p_retailprice",
    "orders": "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority",
    "lineitem": "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice"
    " l_discount l_tax l_returnflag l_linestatus l_shipdate",
    "documents": "doc_id text lang source n_chars",
    "pages": "page_id url html",
    "benchmark": "item_id text",
    "labels": "doc_id quality toxic",
    "conversations": "conv_id turn role text",
}
STAMP = "TIMESTAMP '2024-01-01 00:00:00'"
LATER = "TIMESTAMP '2024-01-02 03:04:05'"
SYNCED = tuple(sorted(t for t in TABLES if t not in EXCLUDED))


def _count_rows(tables, name="table_name", count="row_count") -> str:
    return " UNION ALL ".join(
        f"SELECT '{t}' AS {name}, COUNT(*) AS {count} FROM {t}" for t in tables
    )


def _load(table: str) -> str:
    columns = ", ".join(f'{c} AS "{c.upper()}"' for c in COLUMNS[table].split())
    return f'SELECT {columns}, {STAMP} AS "LOADED_AT_UTC" FROM {table}'


_EVENTS = f"""
    SELECT event_id AS "EVENT_ID", ts AS "TS", user_id AS "USER_ID", event_type AS "EVENT_TYPE",
           value AS "VALUE", CAST(json(props) AS VARCHAR) AS "PROPS", {STAMP} AS "LOADED_AT_UTC"
    FROM events
"""

_TARGET_TYPE = """
    CASE source_type
        WHEN 'integer' THEN 'INTEGER'
        WHEN 'bigint' THEN 'BIGINT'
        WHEN 'double precision' THEN 'FLOAT'
        WHEN 'timestamp without time zone' THEN 'TIMESTAMP_NTZ'
        WHEN 'jsonb' THEN 'VARIANT'
        ELSE 'TEXT'
    END
"""

_INTROSPECT = f"""
    WITH listed AS (
        SELECT DISTINCT table_name, column_name, CAST(ordinal_position AS INTEGER) AS ordinal,
            CASE
                WHEN table_name = 'events' AND column_name = 'props' THEN 'jsonb'
                WHEN data_type = 'INTEGER' THEN 'integer'
                WHEN data_type = 'BIGINT' THEN 'bigint'
                WHEN data_type = 'DOUBLE' THEN 'double precision'
                WHEN data_type = 'VARCHAR' THEN 'text'
                WHEN data_type = 'TIMESTAMP' THEN 'timestamp without time zone'
                WHEN data_type = 'FLOAT[]' THEN 'ARRAY'
            END AS source_type
        FROM information_schema.columns
        WHERE table_name IN ({", ".join(f"'{t}'" for t in SYNCED)})
    )
    SELECT table_name, ordinal, column_name, source_type,
           {_TARGET_TYPE} AS target_type, {_TARGET_TYPE} AS stored_type
    FROM listed
"""

_STALE = """
    SELECT 'customer' AS t, COUNT(*) AS n FROM customer
    UNION ALL SELECT 'events', COUNT(*) FROM events
    UNION ALL SELECT 'nation', COUNT(*) FROM nation
    UNION ALL SELECT 'region', COUNT(*) FROM region
    UNION ALL SELECT 'orders', COUNT(*) FROM orders WHERE o_orderdate < TIMESTAMP '2001-01-01'
"""

_COMPARED = f"""
    WITH s AS ({_count_rows(TABLES, "t", "n")}), g AS ({_STALE})
    SELECT s.t AS table_name, s.n AS source_count, g.n AS target_count,
           s.n IS DISTINCT FROM g.n AS is_mismatch,
           CASE WHEN g.n IS NULL THEN 0 ELSE g.n - s.n END AS diff,
           g.n IS NULL AS target_missing
    FROM s LEFT JOIN g ON s.t = g.t
"""

_FAILING = """
    SELECT 'customer' AS t, COUNT(*) AS n FROM customer
    UNION ALL SELECT 'events', COUNT(*) FROM events
    UNION ALL SELECT 'orders', COUNT(*) FROM orders
    UNION ALL SELECT 'supplier', COUNT(*) FROM supplier
"""

_PROFILE = f"""
    WITH listed AS (
        {_count_rows(SYNCED, "table_name", "row_count")}
        UNION ALL SELECT 'etl_metadata', {len(SYNCED)}
    ), ranked AS (
        SELECT *, COUNT(*) OVER () AS n_tables,
               CAST(ROW_NUMBER() OVER (ORDER BY table_name) AS INTEGER) AS rn
        FROM listed
    )
    SELECT 'ods' AS schema_name, n_tables, table_name, rn,
           GREATEST(n_tables - 10, 0) AS n_more, row_count
    FROM ranked WHERE rn <= 10
"""


def _json_text(column: str) -> str:
    """Text as an ASCII JSON string."""
    return f"""
    '"' || list_aggregate(list_transform(string_split({column}, ''), lambda c:
        CASE
            WHEN c = '"' THEN '\\"'
            WHEN c = '\\' THEN '\\\\'
            WHEN unicode(c) = 10 THEN '\\n'
            WHEN unicode(c) = 13 THEN '\\r'
            WHEN unicode(c) = 9 THEN '\\t'
            WHEN unicode(c) > 126 THEN printf('\\u%04x', unicode(c))
            ELSE c
        END), 'string_agg', '') || '"'
    """


def _number(column: str) -> str:
    return f"CAST({column} AS VARCHAR)"


def _moment(column: str) -> str:
    return f"""
    '"' || strftime({column}, '%Y-%m-%d %H:%M:%S')
        || CASE WHEN microsecond({column}) % 1000000 = 0 THEN ''
                ELSE '.' || lpad(CAST(microsecond({column}) % 1000000 AS VARCHAR), 6, '0') END || '"'
    """


def _row_hash(table: str, key: str, *parts: str) -> str:
    row = " || ', ' || ".join(f"COALESCE({part}, 'null')" for part in parts)
    return f"""SELECT {key}, md5('[' || {row} || ']') AS "ROW_HASH" FROM {table}"""


# Columns that are neither numbers nor text in double quotes.
_MOMENTS = ("o_orderdate", "l_shipdate", "ts")
_TEXTS = """
    r_name n_name c_name c_mktsegment s_name p_name p_brand p_type o_orderstatus o_orderpriority l_returnflag
    l_linestatus event_type text lang source url html role
""".split()
_FLOATS = """
    '[' || list_aggregate(list_transform(embedding, lambda x: CAST(x AS VARCHAR)), 'string_agg', ', ') || ']'
"""
_ALL_COLUMNS = COLUMNS | {
    "events": "event_id ts user_id event_type value props",
    "embeddings": "vec_id embedding label",
}


def _checksum(table: str) -> str:
    def part(column: str) -> str:
        if column in _MOMENTS:
            return _moment(column)
        if column in _TEXTS:
            return _json_text(column)
        return {"props": "props", "embedding": _FLOATS}.get(column, _number(column))

    hashed = _row_hash(table, "1 AS one", *map(part, _ALL_COLUMNS[table].split()))

    def half(start: int) -> str:
        number = f"""CAST('0x' || substr("ROW_HASH", {start}, 16) AS UBIGINT)"""
        return f"CAST(COALESCE(SUM({number}), 0) AS VARCHAR)"

    return f"""
        SELECT '{table}' AS table_name, COUNT(*) AS row_count,
               COUNT(*) || ':' || {half(1)} || ':' || {half(17)} AS checksum FROM ({hashed})
    """


_VERSIONS = """
    new AS (
        SELECT CASE WHEN o_orderkey % 50 <> 8 THEN o_orderkey END AS k, o_custkey, o_totalprice, o_orderpriority
        FROM orders),
    old AS (
        SELECT CASE WHEN o_orderkey % 50 <> 8 THEN o_orderkey END AS k, o_custkey,
               CASE WHEN o_orderkey % 10 = 5 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
               CASE WHEN o_orderkey % 50 = 8 AND o_custkey % 2 = 0 THEN 'none' ELSE o_orderpriority END
                   AS o_orderpriority
        FROM orders WHERE o_orderkey % 10 <> 3
        UNION ALL SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM orders WHERE o_orderkey % 25 = 0
        UNION ALL SELECT CASE WHEN (o_orderkey + 1000000000) % 50 <> 8 THEN o_orderkey + 1000000000 END, o_custkey,
                         o_totalprice, o_orderpriority FROM orders WHERE o_orderkey % 10 = 7)
"""

_LINEITEM_PARTS = [
    *(_number(c) for c in COLUMNS["lineitem"].split()[:8]),
    _json_text("l_returnflag"),
    _json_text("l_linestatus"),
    _moment("l_shipdate"),
]


def _altered(parts: list[str], n_old: int) -> str:
    key = "l_orderkey, l_partkey, l_linenumber"
    chosen = "(SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem ORDER BY ALL LIMIT 3)"
    hashed = _row_hash("lineitem", f"{key}, l_suppkey", *parts)
    return f"""
        SELECT {key}, "ROW_HASH" AS row_hash, CAST({n_old} * COUNT(*) AS BIGINT) AS n_old,
               CAST({1 - n_old} * COUNT(*) AS BIGINT) AS n_new
        FROM ({hashed}) WHERE (l_orderkey, l_linenumber, l_partkey, l_suppkey) IN {chosen} GROUP BY ALL
    """


_INCREMENTS = f"""
    SELECT {STAMP} AS "LOAD_START", COUNT(*) AS "ROWS_LOADED", epoch_us(MAX(ts)) AS "LAST_SOURCE_ID"
    FROM events WHERE ts < TIMESTAMP '{MIDDLE}'
    UNION ALL
    SELECT {LATER}, COUNT(*) FILTER (ts >= TIMESTAMP '{MIDDLE}'), epoch_us(MAX(ts)) FROM events
    UNION ALL
    SELECT TIMESTAMP '2024-01-03 00:00:00', 0, epoch_us(MAX(ts)) FROM events
"""


def _head(column: str) -> str:
    return f"substr(COALESCE({column}, ''), 1, 50)"


_PURGE = " OR ".join(f"contains({_head('text')}, '{p}')" for p in ("The ", "And ", "Of,"))

ORACLE: dict[str, str] = {
    "discover_tables": "SELECT *, 'BASE TABLE' AS table_type FROM (" + _count_rows(SYNCED) + ")",
    "row_counts": _count_rows(TABLES),
    "introspect_columns": _INTROSPECT,
    **{f"load_{table}": _load(table) for table in PLAIN_LOADS},
    "load_events_variant": _EVENTS,
    "load_embeddings_text": """
        SELECT vec_id AS "VEC_ID", label AS "LABEL", CAST(i AS INTEGER) AS "POS",
               CAST(embedding[i + 1] AS DOUBLE) AS "VALUE"
        FROM (SELECT *, UNNEST(range(len(embedding))) AS i FROM embeddings)
    """,
    "variant_path_agg": """
        SELECT event_type AS "EVENT_TYPE", COUNT(*) AS "N_EVENTS",
               CAST(SUM(CAST(props->>'$.k' AS BIGINT)) AS BIGINT) AS "SUM_K"
        FROM events GROUP BY event_type
    """,
    "binary_hex_roundtrip": """
        SELECT doc_id AS "DOC_ID", lower(hex(encode(text))) AS "BODY_HEX",
               CAST(octet_length(encode(text)) AS INTEGER) AS "N_BYTES"
        FROM documents
    """,
    "load_lenient_json": """
        SELECT conv_id AS "CONV_ID", turn AS "TURN",
               COALESCE(json_valid(text) AND trim(text) <> 'null', FALSE) AS "HAS_JSON"
        FROM conversations
    """,
    "swap_publishes_new_rows": f"""
        SELECT s_suppkey AS "KEY", s_name AS "NAME", s_acctbal AS "BALANCE",
               {LATER} AS "LOADED_AT_UTC" FROM supplier
    """,
    "backup_keeps_old_rows": f"""
        SELECT c_custkey AS "KEY", c_name AS "NAME", c_mktsegment AS "SEGMENT",
               {STAMP} AS "LOADED_AT_UTC" FROM customer
    """,
    "failed_validation_keeps_final": f"""SELECT *, 'VALIDATION_FAILED' AS "SECOND_LOAD" FROM ({_EVENTS})""",
    "malformed_json_is_error": f"""
        SELECT {STAMP} AS "LOADED_AT_UTC", COUNT(*) AS "N_ROWS",
               CAST(SUM(n_chars) AS BIGINT) AS "SUM_CHARS", 'ERROR' AS "SECOND_LOAD"
        FROM documents
    """,
    "sync_results": f"""
        SELECT t AS "table", 'SUCCESS' AS status, n AS rows_loaded, n AS rows_validated,
               n AS expected_count, n AS actual_count FROM ({_count_rows(SYNCED, "t", "n")})
    """,
    "validate_counts_all": f"""
        SELECT t AS table_name, n AS expected_count, n AS actual_count, TRUE AS ok
        FROM ({_count_rows(SYNCED, "t", "n")})
    """,
    "validate_json_types": """
        SELECT * FROM (VALUES ('events', 'props', 'VARIANT', TRUE), ('orders', 'props', 'MISSING', FALSE))
            AS checks(table_name, column_name, actual_type, ok)
    """,
    "load_audit": f"""
        SELECT t AS "TABLE_NAME", 'public' AS "SOURCE_SCHEMA", 'FULL_LOAD' AS "LOAD_TYPE",
               n AS "ROWS_LOADED", n AS "ROWS_VALIDATED", {STAMP} AS "LOAD_START",
               {STAMP} AS "LOAD_END", {STAMP} AS "LOADED_AT_UTC", 'SUCCESS' AS "STATUS",
               TRUE AS "UNSET"
        FROM ({_count_rows(SYNCED, "t", "n")})
    """,
    "audit_key_check": f"""
        SELECT 'rows' AS what, CAST({len(SYNCED)} AS BIGINT) AS n
        UNION ALL SELECT 'duplicate keys', 0
    """,
    "run_summary": f"""
        SELECT 'SUCCESS' AS status, CAST({len(SYNCED)} AS INTEGER) AS tables_processed,
               CAST({len(SYNCED)} AS INTEGER) AS successes, CAST(0 AS INTEGER) AS failures,
               CAST(SUM(n) AS BIGINT) AS total_rows, '' AS failed_tables,
               CAST(125.9 AS DOUBLE) AS duration
        FROM ({_count_rows(SYNCED, "t", "n")})
    """,
    "run_report": f"""
        SELECT '{REPORT_TITLE}: Sync Completed | 2024-01-01 00:00:00 UTC | 2m 5s' || chr(10) || chr(10)
               || '* Successes (' || COUNT(*) || ')*' || chr(10)
               || string_agg('`' || t || '`', ' ' ORDER BY t) || chr(10) AS report
        FROM ({_count_rows(SYNCED, "t", "n")})
    """,
    "failing_run_results": f"""
        SELECT t AS "table", CASE t WHEN 'events' THEN 'VALIDATION_FAILED' ELSE 'SUCCESS' END AS status,
               n AS rows_loaded, CASE t WHEN 'events' THEN 0 ELSE n END AS rows_validated,
               n AS expected_count, n AS actual_count,
               CASE t WHEN 'events' THEN 'Count or type validation failed' ELSE '' END AS error
        FROM ({_FAILING})
    """,
    "failing_run_failures": f"""
        SELECT t AS "table", 'VALIDATION_FAILED' AS status, n AS rows_loaded,
               CAST(0 AS BIGINT) AS rows_validated, n AS expected_count, n AS actual_count,
               'Count or type validation failed' AS error
        FROM ({_FAILING}) WHERE t = 'events'
    """,
    "failing_run_summary": f"""
        SELECT 'FAILURE' AS status, CAST(4 AS INTEGER) AS tables_processed,
               CAST(3 AS INTEGER) AS successes, CAST(1 AS INTEGER) AS failures,
               CAST(SUM(n) AS BIGINT) AS total_rows,
               'events: Count or type validation failed' AS failed_tables,
               CAST(125.9 AS DOUBLE) AS duration
        FROM ({_FAILING})
    """,
    "failing_run_report": f"""
        SELECT '{REPORT_TITLE}: Sync Failed | 2024-01-01 00:00:00 UTC | 2m 5s' || chr(10) || chr(10)
               || '* Failures (1)*' || chr(10)
               || '`events` - Count or type validation failed (PG: ' || max(n) FILTER (t = 'events')
               || ' -> SNOW: ' || max(n) FILTER (t = 'events') || ')' || chr(10) || chr(10)
               || '* Successes (3)*' || chr(10) || '`customer` `orders` `supplier`' || chr(10) AS report
        FROM ({_FAILING})
    """,
    "reconcile_counts": f"""
        SELECT * REPLACE (COALESCE(target_count, -1) AS target_count) FROM ({_COMPARED})
    """,
    "reconcile_totals": f"""
        SELECT COUNT(*) AS tables, CAST(SUM(source_count) AS BIGINT) AS source_total,
               CAST(SUM(target_count) AS BIGINT) AS target_total,
               COUNT(*) FILTER (is_mismatch) AS mismatches
        FROM ({_COMPARED})
    """,
    "reconcile_report": f"""
        WITH c AS ({_COMPARED})
        SELECT CASE WHEN is_mismatch THEN '✗' ELSE '✓' END || ' ' || rpad(table_name, 40, ' ')
               || ' | PG: ' || lpad(CAST(source_count AS VARCHAR), 10, ' ')
               || ' | SF: ' || rpad(COALESCE(CAST(target_count AS VARCHAR), 'NOT FOUND'), 10, ' ') AS line
        FROM c
        UNION ALL
        SELECT '  ' || rpad(table_name, 40, ' ') || ' | Diff: '
               || lpad(CASE WHEN diff >= 0 THEN '+' ELSE '' END || CAST(diff AS VARCHAR), 10, ' ')
        FROM c WHERE is_mismatch
        UNION ALL
        SELECT 'TOTALS: PostgreSQL: ' || lpad(CAST(SUM(source_count) AS VARCHAR), 10, ' ')
               || ' | Snowflake: ' || lpad(CAST(SUM(target_count) AS VARCHAR), 10, ' ')
        FROM c
    """,
    "reconcile_synced": f"""
        SELECT t AS table_name, n AS source_count, t IN ('benchmark', 'labels') AS is_mismatch,
               CAST(0 AS BIGINT) AS diff, t IN ('benchmark', 'labels') AS target_missing
        FROM ({_count_rows(TABLES, "t", "n")})
    """,
    "catalog_profile": _PROFILE,
    "catalog_profile_lines": f"""
        WITH p AS ({_PROFILE})
        SELECT CAST(0 AS INTEGER) AS position, '✓ ods: ' || n_tables || ' tables' AS line
        FROM p WHERE rn = 1
        UNION ALL SELECT rn, '    ' || table_name || ': ' || row_count || ' rows' FROM p
        UNION ALL SELECT 11, '    ... and ' || n_more || ' more tables' FROM p WHERE rn = 1
    """,
    "schema_table_counts": f"SELECT 'ods' AS schema_name, CAST({len(SYNCED) + 1} AS BIGINT) AS n_tables",
    "row_hash_orders": _row_hash(
        "orders",
        "o_orderkey",
        _number("o_orderkey"),
        _number("o_custkey"),
        _json_text("o_orderstatus"),
        _number("o_totalprice"),
        _moment("o_orderdate"),
        _json_text("o_orderpriority"),
    ),
    "row_hash_lineitem": _row_hash(
        "lineitem",
        "l_orderkey, l_partkey, l_linenumber",
        *(_number(c) for c in COLUMNS["lineitem"].split()[:8]),
        """'"' || l_returnflag || '"'""",
        """'"' || l_linestatus || '"'""",
        _moment("l_shipdate"),
    ),
    "row_hash_events": _row_hash(
        "events",
        "event_id",
        _number("event_id"),
        _moment("ts"),
        _number("user_id"),
        """'"' || event_type || '"'""",
        _number("value"),
        "props",
    ),
    "row_hash_conversations": _row_hash(
        "conversations",
        "conv_id, turn",
        _number("conv_id"),
        _number("turn"),
        _json_text("role"),
        _json_text("text"),
    ),
    "purge_messages": f"""
        SELECT conv_id, turn, {_head("text")} AS head FROM conversations WHERE {_PURGE}
    """,
    "purge_totals": f"""
        SELECT COUNT(*) AS messages, COUNT(*) FILTER ({_PURGE}) AS purged FROM conversations
    """,
    "change_sets": f"""
        WITH {_VERSIONS},
        d AS (SELECT * EXCLUDE (s), SUM(s) AS delta
              FROM (SELECT *, 1 AS s FROM new UNION ALL SELECT *, -1 FROM old) GROUP BY ALL HAVING SUM(s) <> 0),
        p AS (SELECT k FROM d WHERE k IS NOT NULL GROUP BY k
              HAVING SUM(GREATEST(delta, 0)) = 1 AND SUM(GREATEST(-delta, 0)) = 1),
        f AS (SELECT d.*, p.k IS NOT NULL AS paired FROM d LEFT JOIN p ON d.k = p.k)
        SELECT CASE WHEN paired THEN 'update' WHEN delta > 0 THEN 'insert' ELSE 'delete' END AS op,
               CAST(ABS(delta) AS BIGINT) AS copies, k, o_custkey, o_totalprice, o_orderpriority
        FROM f WHERE NOT paired OR delta > 0
    """,
    "pointer_publish": f"""
        SELECT * REPLACE ({LATER} AS "LOADED_AT_UTC"), 'final' AS "VERSION" FROM ({_load("orders")})
        UNION ALL
        SELECT *, 'backup' AS "VERSION" FROM ({_load("orders")}) WHERE "O_ORDERKEY" % 2 = 0
    """,
    "resumed_load": f"""
        SELECT CAST(COALESCE(l_orderkey % {PIECES}, 0) AS INTEGER) AS piece, COUNT(*) AS n_rows,
               SUM(l_quantity) AS sum_quantity, CAST(2 AS BIGINT) AS reused
        FROM lineitem GROUP BY ALL
    """,
    "change_sets_applied": f"WITH {_VERSIONS} SELECT * FROM new",
    "table_checksums": " UNION ALL ".join(_checksum(table) for table in TABLES),
    "checksum_tree_rows": _altered(_LINEITEM_PARTS, 1)
    + " UNION ALL "
    + _altered([p.replace("l_quantity", "(l_quantity + 1)") for p in _LINEITEM_PARTS], 0),
    "incremental_events": f"""
        SELECT * REPLACE (CASE WHEN "TS" < TIMESTAMP '{MIDDLE}' THEN {STAMP} ELSE {LATER} END AS "LOADED_AT_UTC")
        FROM ({_EVENTS})
    """,
    "incremental_audit": f"""SELECT *, 'INCREMENTAL' AS "LOAD_TYPE", 'SUCCESS' AS "STATUS" FROM ({_INCREMENTS})""",
}
