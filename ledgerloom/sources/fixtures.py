"""Ledger views over the driver's raw tables.

Each view is one SELECT that Spark and DuckDB both run; ``{name}`` stands for a raw table
and the ``<...>`` marks are the few spots where the dialects differ.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_SPARK = {"<ntz>": "TIMESTAMP_NTZ", "<explode>": "explode(array", "<end>": ")"}
_DUCKDB = {"<ntz>": "TIMESTAMP", "<explode>": "unnest(list_value", "<end>": ")"}

_MODE = "CAST(CASE {c} WHEN 'F' THEN 100 WHEN 'O' THEN 20 ELSE 10 END AS SMALLINT)".format(c="o_orderstatus")
_VERSION_ID = (
    "(year(o_orderdate) * 100 + CAST(substr(o_orderpriority, 1, 1) AS INT) * 10"
    " + CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END)"
)
_VERSION_KEY = (
    "'V' || CAST(year(o_orderdate) AS STRING) AS repository_version,"
    " o_orderpriority AS repository_database_type, o_orderstatus AS created_by_version"
)

VIEWS = {
    # Some ids are not those that runs and migrations name, some names are null and some texts too
    # long, and some products are stored twice.
    "product": """
        SELECT CASE WHEN c_custkey % 97 = 13 THEN -c_custkey ELSE c_custkey END AS id,
               CASE WHEN c_custkey % 89 = 0 THEN CAST(NULL AS STRING) ELSE c_name END AS name,
               CASE WHEN c_custkey % 61 = 0 THEN repeat(c_mktsegment, 150) ELSE c_mktsegment END AS description,
               CAST('1992-01-01 00:00:00' AS <ntz>) AS created_at
        FROM {customer}
        UNION ALL
        SELECT c_custkey, c_name, 'stored again', CAST('1992-01-02 00:00:00' AS <ntz>)
        FROM {customer} WHERE c_custkey % 53 = 0""",
    # All versions; those of 1996 with status P are stored twice, and those from 1998 on under
    # another name and id, so that runs and requests miss them.
    "migrator_version": f"""
        SELECT CAST(id AS BIGINT) AS id, repository_version, repository_database_type,
               created_by_version, min(created_at) AS created_at
        FROM (
            SELECT {_VERSION_ID} + CASE WHEN year(o_orderdate) < 1998 THEN 0 ELSE 5 END AS id,
                   CASE WHEN year(o_orderdate) < 1998 THEN 'V' ELSE 'next-V' END
                   || CAST(year(o_orderdate) AS STRING) AS repository_version,
                   o_orderpriority AS repository_database_type, o_orderstatus AS created_by_version,
                   o_orderdate AS created_at
            FROM {{orders}}
            UNION ALL
            SELECT {_VERSION_ID} + 4 AS id, {_VERSION_KEY}, o_orderdate AS created_at
            FROM {{orders}} WHERE year(o_orderdate) = 1996 AND o_orderstatus = 'P'
        ) v
        GROUP BY id, repository_version, repository_database_type, created_by_version""",
    # Every 7th run is open.
    "migration_run": f"""
        SELECT o_orderkey AS id, CAST({_VERSION_ID} AS BIGINT) AS migrator_version_id,
               o_custkey AS product_id,
               CAST(CASE WHEN o_orderkey % 223 = 2 THEN 55 ELSE {_MODE} END AS SMALLINT) AS migration_run_mode_id,
               CAST(CASE WHEN o_orderkey % 227 = 3 THEN 12 WHEN o_orderkey % 7 = 0 THEN 10
                    WHEN o_orderkey % 11 = 0 THEN 90 ELSE 100 END AS SMALLINT) AS migration_result_id,
               CASE WHEN o_orderkey % 229 = 4 THEN CAST(NULL AS STRING) ELSE o_orderpriority END AS environment,
               CASE WHEN o_orderstatus <> 'P' THEN 'R' || CAST(year(o_orderdate) - 1 AS STRING) END
                    AS from_release_version,
               CASE WHEN o_orderkey % 233 = 5 AND o_orderkey % 7 <> 0 THEN repeat('R', 101)
                    ELSE 'R' || CAST(year(o_orderdate) AS STRING) END AS to_release_version,
               o_orderdate AS started_at,
               CASE WHEN o_orderkey % 7 = 0 THEN NULL
                    ELSE o_orderdate + INTERVAL 1 SECOND * CAST(floor(o_totalprice) AS INT) END
                    AS finished_at,
               CAST(NULL AS BIGINT) AS duration_in_ms
        FROM {{orders}}""",
    "migration_run_meta": """
        SELECT CASE WHEN o_orderkey % 239 = 6 THEN -o_orderkey ELSE o_orderkey END AS migration_run_id,
               '{"priority": "' || o_orderpriority || '"}' AS migration_run_settings_json,
               CASE WHEN o_orderstatus = 'F' THEN 'customer ' || CAST(o_custkey AS STRING) END AS description
        FROM {orders}
        UNION ALL
        SELECT o_orderkey, CAST(NULL AS STRING), 'stored again' FROM {orders} WHERE o_orderkey % 241 = 0""",
    # The raw line items repeat (order, line), so ids repeat as well.
    "migration": f"""
        SELECT l_orderkey * 8 + l_linenumber AS id,
               o_custkey AS product_id,
               CASE WHEN l_partkey % 223 = 2 THEN -l_orderkey ELSE l_orderkey END AS migration_run_id,
               CAST(CASE WHEN l_partkey % 227 = 3 THEN 55 ELSE {_MODE} END AS SMALLINT) AS migration_run_mode_id,
               CAST(CASE WHEN l_partkey % 229 = 4 THEN 77 WHEN l_linestatus = 'O' THEN 100 ELSE 50 END
                    AS SMALLINT) AS migration_operation_id,
               CAST(CASE l_linenumber WHEN 1 THEN 1 WHEN 2 THEN 10 WHEN 3 THEN 11 WHEN 4 THEN 90
                    WHEN 5 THEN 91 WHEN 6 THEN 99 ELSE 100 END AS SMALLINT) AS migration_result_id,
               CAST(CASE WHEN l_partkey % 233 = 5 THEN 98 WHEN l_returnflag = 'A' THEN 99
                    WHEN l_returnflag = 'N' THEN 11 ELSE 10 END AS SMALLINT) AS migration_state_id,
               o_orderpriority AS environment,
               CASE WHEN l_partkey % 239 = 6 THEN CAST(NULL AS STRING)
                    ELSE 'R' || CAST(year(l_shipdate) AS STRING) END AS release_version,
               l_returnflag AS target_group_alias, l_linestatus AS target_alias,
               CASE WHEN l_partkey % 241 = 7 THEN repeat('f', 201)
                    ELSE 'file_' || CAST(l_partkey AS STRING) END AS filename, l_linenumber AS file_order_id,
               md5(CAST(l_partkey AS STRING)) AS file_up_hash,
               CASE WHEN l_tax > 0.04 THEN md5(CAST(l_suppkey AS STRING)) END AS file_up_config_hash,
               md5(CAST(l_partkey * 2 AS STRING)) AS file_up_blocks_hash,
               CAST(CASE l_returnflag WHEN 'A' THEN l_quantity WHEN 'N' THEN 0
                    ELSE floor(l_quantity / 2) END AS INT) AS file_up_blocks_migrated,
               CAST(l_quantity AS INT) AS file_up_blocks_total,
               CASE WHEN l_tax > 0.04 THEN '{{"part": ' || CAST(l_partkey AS STRING) || '}}' END
                    AS file_up_config_json,
               l_linestatus = 'O' AS migrate_down_file_exists,
               CASE WHEN l_linestatus = 'O' THEN md5(CAST(l_partkey * 3 AS STRING)) END AS file_down_hash,
               CAST(NULL AS STRING) AS file_down_config_hash,
               CASE WHEN l_linestatus = 'O' THEN md5(CAST(l_partkey * 5 AS STRING)) END
                    AS file_down_blocks_hash,
               CASE WHEN l_linestatus = 'O' THEN 0 END AS file_down_blocks_migrated,
               CASE WHEN l_linestatus = 'O' THEN l_linenumber END AS file_down_blocks_total,
               CAST(NULL AS STRING) AS file_down_config_json,
               l_shipdate AS started_at,
               CASE WHEN l_returnflag <> 'R' THEN l_shipdate + INTERVAL 1 SECOND * CAST(l_quantity AS INT) END
                    AS finished_at,
               CAST(NULL AS BIGINT) AS duration_in_ms
        FROM {{lineitem}} JOIN {{orders}} ON l_orderkey = o_orderkey""",
    # Each order is one recorded version of its customer's migration file.
    "migration_history": f"""
        SELECT o_orderkey AS id, o_custkey AS migration_id,
               o_custkey AS product_id,
               CASE WHEN o_orderkey % 223 = 2 THEN -o_orderkey ELSE o_orderkey END AS migration_run_id,
               {_MODE} AS migration_run_mode_id,
               CAST(CASE o_orderstatus WHEN 'P' THEN 50 ELSE 100 END AS SMALLINT) AS migration_operation_id,
               CAST(CASE WHEN o_orderkey % 11 = 0 THEN 90 ELSE 100 END AS SMALLINT) AS migration_result_id,
               CAST(CASE o_orderstatus WHEN 'F' THEN 99 WHEN 'O' THEN 11 ELSE 10 END AS SMALLINT)
                    AS migration_state_id,
               o_orderpriority AS environment, 'R' || CAST(year(o_orderdate) AS STRING) AS release_version,
               CASE WHEN o_orderkey % 227 = 3 THEN CAST(NULL AS STRING) ELSE o_orderstatus END
                    AS target_group_alias,
               CASE WHEN o_orderkey % 229 = 4 THEN repeat('main', 26) ELSE 'main' END AS target_alias,
               'file_' || CAST(o_custkey AS STRING) AS filename, 1 AS file_order_id,
               md5(CAST(o_orderkey AS STRING)) AS file_up_hash, CAST(NULL AS STRING) AS file_up_config_hash,
               md5(CAST(o_custkey AS STRING)) AS file_up_blocks_hash,
               CASE o_orderstatus WHEN 'F' THEN 5 ELSE 2 END AS file_up_blocks_migrated,
               5 AS file_up_blocks_total, CAST(NULL AS STRING) AS file_up_config_json,
               false AS migrate_down_file_exists, CAST(NULL AS STRING) AS file_down_hash,
               CAST(NULL AS STRING) AS file_down_config_hash, CAST(NULL AS STRING) AS file_down_blocks_hash,
               CAST(NULL AS INT) AS file_down_blocks_migrated, CAST(NULL AS INT) AS file_down_blocks_total,
               CAST(NULL AS STRING) AS file_down_config_json, o_orderdate AS started_at,
               o_orderdate + INTERVAL 1 SECOND * CAST(floor(o_totalprice) AS INT) AS finished_at,
               CAST(NULL AS BIGINT) AS duration_in_ms
        FROM {{orders}}""",
    "migration_log": """
        SELECT event_id AS id, CAST(CASE event_type WHEN 'error' THEN 4 ELSE 2 END AS SMALLINT) AS log_level_id,
               CASE event_type WHEN 'view' THEN 10 WHEN 'click' THEN 20 WHEN 'signup' THEN 60
                    WHEN 'purchase' THEN 70 ELSE 81 END AS migration_event_id,
               CAST(NULL AS SMALLINT) AS run_mode_id, CAST(user_id AS INT) AS product_id,
               CAST(NULL AS INT) AS migration_run_id, CAST(NULL AS STRING) AS environment,
               CAST(NULL AS STRING) AS release_version, CAST(NULL AS STRING) AS target_group_alias,
               CAST(NULL AS STRING) AS target_alias,
               CASE WHEN event_id % 251 = 9 THEN repeat('long', 76) END AS filename,
               CAST(NULL AS INT) AS file_order_id, CAST(NULL AS INT) AS file_block_id,
               props AS message, CASE WHEN event_id % 257 = 8 THEN NULL ELSE ts END AS created_at
        FROM {events}""",
    # Each line break of a document becomes a GO line.
    "script": """
        SELECT 'doc_' || CAST(doc_id AS STRING) AS filename, doc_id, lang AS release_version,
               source AS target_group_alias,
               replace(text, chr(10), chr(10) || 'GO' || chr(10)) AS content
        FROM {documents}""",
    # The same files with a settings comment at the top, and a GO line inside that comment; every
    # ninth has a second one at its end.
    "script_with_settings": """
        SELECT 'doc_' || CAST(doc_id AS STRING) AS filename, doc_id, lang AS release_version,
               source AS target_group_alias,
               CASE WHEN lang = 'fr' THEN '' ELSE '/* [Settings]' || chr(10) || 'lang=' || lang || chr(10)
                    || 'GO' || chr(10) || '*/' || chr(10) END
               || replace(text, chr(10), chr(10) || 'GO' || chr(10))
               || CASE WHEN doc_id % 9 = 0 THEN '/*[Settings] n=' || CAST(doc_id AS STRING) || ' */' ELSE '' END
               AS content
        FROM {documents}""",
    # The same files with what a lexer has to tell apart between their lines: line comments with marks,
    # nested comments, and literals and names with marks and GO lines; some end inside one of them.
    "script_marked": """
        SELECT doc_id, lang AS release_version,
               replace(text, chr(10), chr(10) || 'GO' || chr(10) || CASE doc_id % 8
                   WHEN 0 THEN '-- see /* here' || chr(10) || 'SELECT 1' || chr(10) || '-- end */' || chr(10)
                   WHEN 1 THEN '/* a /* b' || chr(10) || 'GO' || chr(10) || '*/ DROP TABLE t; */'
                   WHEN 2 THEN 'PRINT ' || chr(39) || '/* keep' || chr(10) || 'GO' || chr(10)
                        || chr(39) || chr(39) || ' */' || chr(39) || chr(10)
                   WHEN 3 THEN 'SELECT [a]]/*' || chr(10) || 'GO' || chr(10) || '] FROM "b--' || chr(39) || chr(10)
                        || 'go' || chr(10) || '"' || chr(10)
                   WHEN 4 THEN '/* don' || chr(39) || 't /*/ x */ */ -- ' || chr(39) || chr(10) || ' GO ' || chr(10)
                   WHEN 5 THEN '/*/* 1 */ /* "2" */ /* [3 */*/GO' || chr(10) || '**/ / *' || chr(10)
                   WHEN 6 THEN chr(39) || chr(10) || 'GO' || chr(10) || '--' || chr(39) || '/**/' || chr(10)
                   ELSE '' END)
               || CASE doc_id % 5 WHEN 1 THEN '/* open' || chr(10) || 'GO' || chr(10) || 'x'
                   WHEN 2 THEN chr(39) || 'open' || chr(10) || 'GO' || chr(10) || 'x' ELSE '' END AS content
        FROM {documents}""",
    # A later state of the files: some renamed (removed + added), some changed.
    "script_next": """
        SELECT CASE WHEN doc_id % 10 = 0 THEN 'new_' ELSE 'doc_' END || CAST(doc_id AS STRING) AS filename,
               doc_id, lang AS release_version, source AS target_group_alias,
               replace(text, chr(10), chr(10) || 'GO' || chr(10))
               || CASE WHEN doc_id % 13 = 0 THEN 'x' ELSE '' END AS content
        FROM {documents}""",
    # Templates: documents with placeholders put in, and one config row per target group.
    "template": """
        SELECT doc_id, source AS target_group_alias,
               'IF OBJECT_ID(''{CFG:SchemaName}.{CFG:TableBaseName}Log'') IS NULL' || chr(10)
               || replace(text, chr(10), chr(10) || '[{CFG:SchemaName}].[' || lang || ']')
               || CASE WHEN lang = 'de' THEN '{CFG:Unknown}' ELSE '' END AS content
        FROM {documents}""",
    "template_config": """
        SELECT source AS target_group_alias, 'schema_' || source AS schema_name,
               CASE WHEN source < 'src15' THEN 'base{CFG:SchemaName}' END AS table_base_name
        FROM {documents} GROUP BY source""",
    # Names to get or create: 64 hot part names (some blank), new supplier names (some too long),
    # known customer names.
    "product_request": """
        SELECT p_partkey * 3 AS request_id,
               CASE p_size WHEN 50 THEN '   ' WHEN 49 THEN CAST(NULL AS STRING) ELSE p_name END AS name,
               p_type AS description
        FROM {part}
        UNION ALL
        SELECT s_suppkey * 3 + 1, CASE WHEN s_suppkey % 17 = 0 THEN repeat(s_name, 9) ELSE s_name END,
               CASE WHEN s_suppkey % 19 = 0 THEN repeat('supplier', 126) ELSE 'supplier' END FROM {supplier}
        UNION ALL
        SELECT c_custkey * 3 + 2, c_name, c_mktsegment FROM {customer}""",
    "version_request": """
        SELECT o_orderkey AS request_id,
               CASE WHEN o_orderkey % 257 = 1 THEN repeat('V', 101)
                    ELSE 'V' || CAST(year(o_orderdate) AS STRING) END AS repository_version,
               o_orderpriority AS repository_database_type,
               CASE WHEN o_orderkey % 263 = 1 THEN CAST(NULL AS STRING) ELSE o_orderstatus END
                   AS created_by_version
        FROM {orders}""",
    # Every run asks to run again; those that ended in an error ask for a repair as well. Some name
    # a product, mode, result or version that does not exist, or a text that is too long.
    "run_request": f"""
        SELECT o_orderkey AS request_id,
               o_orderdate + INTERVAL 1 SECOND * CAST(floor(o_totalprice) AS INT) AS requested_at,
               CASE WHEN o_orderkey % 503 = 2 THEN -o_custkey ELSE o_custkey END AS product_id,
               CASE WHEN o_orderkey % 501 = 1 THEN CAST(NULL AS STRING)
                    WHEN o_orderkey % 509 = 3 THEN repeat('e', 101) ELSE o_orderpriority END AS environment,
               CAST(CASE WHEN o_orderkey % 521 = 4 THEN 55 ELSE {_MODE} END AS SMALLINT) AS migration_run_mode_id,
               CAST({_VERSION_ID} AS BIGINT) AS migrator_version_id,
               CAST(CASE WHEN o_orderkey % 523 = 5 THEN 12 ELSE 10 END AS SMALLINT) AS migration_result_id,
               CASE WHEN o_orderkey % 541 = 6 THEN repeat('r', 101) END AS from_release_version,
               'R' || CAST(year(o_orderdate) AS STRING) AS to_release_version,
               o_orderkey % 11 = 0 AS fix
        FROM {{orders}}""",
    # One schema per customer: complete, empty, without version table, one table short, with others.
    "catalog_schema": "SELECT 'repo_' || CAST(c_custkey AS STRING) AS schema_name FROM {customer}",
    "catalog_table": """
        SELECT schema_name, table_name FROM (
            SELECT 'repo_' || CAST(c_custkey AS STRING) AS schema_name, c_mktsegment,
                   <explode>('migration_operation', 'migration_result', 'migration_run_mode',
                       'migration_state', 'migrator_version', 'product', 'migration_run',
                       'migration_run_meta', 'migration', 'migration_history', 'invoice')<end> AS table_name
            FROM {customer}) c
        WHERE CASE c_mktsegment
              WHEN 'AUTOMOBILE' THEN table_name <> 'invoice'
              WHEN 'BUILDING' THEN table_name = 'invoice'
              WHEN 'FURNITURE' THEN table_name <> 'migrator_version'
              WHEN 'HOUSEHOLD' THEN table_name <> 'product'
              ELSE true END""",
    # Call parameters of every event: one good, one that may not fit, one of an unknown type,
    # and one name given twice.
    "parameter": """
        SELECT event_id AS request_id, '@UserId' AS name, 'int' AS type_name,
               CAST(user_id AS STRING) AS value FROM {events}
        UNION ALL
        SELECT event_id, '@Level', 'sbyte', CAST(event_id % 300 AS STRING) FROM {events}
        UNION ALL
        SELECT event_id, '@Wait', 'TimeSpan', '00:00:01' FROM {events}
        UNION ALL
        SELECT event_id, CASE event_type WHEN 'error' THEN '@UserId' ELSE '@Message' END, 'string',
               CASE event_type WHEN 'view' THEN '' WHEN 'click' THEN CAST(NULL AS STRING) ELSE props END
        FROM {events}""",
    # A call parameter of every type, good and bad in turn, and whether the store would take it whole.
    "typed_parameter": """
        SELECT event_id AS request_id, '@P' AS name, s.type_name, s.value, s.fits
        FROM {events} e JOIN (VALUES
            (0, 'byte', '255', true), (1, 'byte', '256', false), (2, 'sbyte', '-128', true), (3, 'sbyte', '128', false),
            (4, 'short', '-32768', true), (5, 'short', '40000', false), (6, 'ushort', '65535', true),
            (7, 'ushort', '-1', false), (8, 'int', ' 12 ', true), (9, 'int', '2147483648', false),
            (10, 'uint', '4294967295', true), (11, 'uint', '1.5', false), (12, 'long', '-9223372036854775808', true),
            (13, 'long', '9223372036854775808', false), (14, 'ulong', '18446744073709551615', true),
            (15, 'ulong', '18446744073709551616', false), (16, 'float', '1.5e3', true), (17, 'float', 'x', false),
            (18, 'double', '-.25', true), (19, 'double', '1,5', false), (20, 'decimal', '12345.0123456789', true),
            (21, 'decimal', '0.123456789012345', false), (22, 'decimal(10,2)', '12345678.90', true),
            (23, 'decimal(10,2)', '1.005', false), (24, 'decimal(5,0)', '123456', false), (25, 'bool', 'True', true),
            (26, 'bool', 'yes', false), (27, 'string', 'any', true), (28, 'char', 'x', true), (29, 'char', 'xy', false),
            (30, 'Guid', '0F8FAD5B-D9CB-469F-A165-70867728950E', true), (31, 'Guid', '0F8FAD5B', false),
            (32, 'DateTime', '2020-01-01 10:00:00', true), (33, 'DateTime', '2020-01-01T10:00:00+05:00', false),
            (34, 'DateTime', '2020-13-01', false), (35, 'DateTimeOffset', '2020-01-01T10:00:00+05:00', true),
            (36, 'DateTimeOffset', 'soon', false), (37, 'byte[]', 'bytes', true), (38, 'XElement', '<a/>', true),
            (39, 'XmlDocument', '<a/>', true), (40, 'int?', CAST(NULL AS STRING), true), (41, 'int?', 'x', false),
            (42, 'decimal?', '2.50', true), (43, 'decimal', '1e3', false), (44, 'DateTime', '1000-01-01', true),
            (45, 'DateTime', '2020-01-01 00:00:00.1234567', false), (46, 'DateTime', '2020-01-01 00:00:00.1234560', true),
            (47, 'DateTimeOffset', '2020-01-01T00:00:00.123456789Z', false),
            (48, 'DateTimeOffset', '2020-01-01T00:00:00.123456000Z', true)
        ) s(place, type_name, value, fits) ON event_id % 49 = s.place""",
    "event_text": """
        SELECT event_id, CAST(user_id AS STRING) AS user_text,
               regexp_extract(props, '([0-9]+)', 1) AS k_text,
               CASE event_type WHEN 'error' THEN 'n/a' ELSE CAST(event_id AS STRING) END AS id_text,
               CASE event_type WHEN 'view' THEN 'true' WHEN 'click' THEN 'false' ELSE 'maybe' END AS flag_text
        FROM {events}""",
    # Result lines as a store would return them, good and bad.
    "result_line": """
        SELECT event_id, CASE event_type
               WHEN 'view' THEN CAST(event_id AS STRING) || ',Run with Id [' || CAST(user_id AS STRING) || '] created'
               WHEN 'click' THEN '-1,Tables found, but not all, ' || props
               WHEN 'signup' THEN CAST(event_id AS STRING)
               WHEN 'purchase' THEN 'x' || CAST(event_id AS STRING) || ',bad code'
               ELSE CAST(NULL AS STRING) END AS line
        FROM {events}""",
    # Order dates moved back so that they fall on both sides of 1753.
    "old_date": """
        SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN NULL
               ELSE o_orderdate - INTERVAL 244 YEAR END AS moved
        FROM {orders}""",
    # New log lines: one per run.
    "log_entry": f"""
        SELECT CAST(CASE WHEN o_orderkey % 11 = 0 THEN 4 ELSE 2 END AS SMALLINT) AS log_level_id,
               80 AS migration_event_id, {_MODE} AS run_mode_id, CAST(o_custkey AS INT) AS product_id,
               CAST(o_orderkey AS INT) AS migration_run_id, o_orderpriority AS environment,
               'R' || CAST(year(o_orderdate) AS STRING) AS release_version,
               CAST(NULL AS STRING) AS target_group_alias, CAST(NULL AS STRING) AS target_alias,
               CAST(NULL AS STRING) AS filename, CAST(NULL AS INT) AS file_order_id,
               CAST(NULL AS INT) AS file_block_id, 'Run of ' || CAST(o_custkey AS STRING) AS message
        FROM {{orders}}""",
}

RAW_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()
_RAW = re.compile(r"\{(%s)\}" % "|".join(RAW_TABLES))


def _text(view: str, dialect: dict[str, str]) -> str:
    text = VIEWS[view]
    for mark, word in dialect.items():
        text = text.replace(mark, word)
    return text


def duckdb_ctes(*views: str) -> str:
    """``WITH`` clause that defines the given views over the raw tables."""
    return "WITH " + ",\n".join(
        f"{view} AS ({_RAW.sub(lambda m: m.group(1), _text(view, _DUCKDB))})" for view in views
    )


_SCHEMAS: dict[str, T.StructType] = {}


def raw(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A raw table; its schema is read from the file footers only the first time."""
    path = f"{sf_dir}/{table}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One ledger view as a lazy DataFrame over the raw Parquet tables."""
    text = _text(name, _SPARK)
    tables = sorted(set(_RAW.findall(text)))
    # Braces that do not name a raw table belong to the text itself.
    marked = _RAW.sub(lambda m: f"\x01{m.group(1)}\x02", text).replace("{", "{{").replace("}", "}}")
    query = marked.replace("\x01", "{").replace("\x02", "}")
    return spark.sql(query, **{t: raw(spark, sf_dir, t) for t in tables})


def events_to_log(events: DataFrame) -> DataFrame:
    """The view ``migration_log`` over a given (also streaming) table of events."""
    text = _text("migration_log", _SPARK)
    return events.sparkSession.sql(text, events=events)
