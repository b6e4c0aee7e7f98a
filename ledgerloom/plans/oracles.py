"""DuckDB SQL for each registered query, written without looking at the Spark plan."""

from __future__ import annotations

from ledgerloom.sources.fixtures import duckdb_ctes
from ledgerloom.sources.master import TOOL, master_rows
from ledgerloom.sources.tables import (
    FOREIGN_KEYS,
    PRIMARY_KEYS,
    REPOSITORY_TABLES,
    TABLES,
    UNIQUE_KEYS,
    VERSION_KEY,
)

_NOW = "TIMESTAMP '2030-01-02 03:04:05'"
_RUN_KEY = "product_id, environment, migration_run_mode_id"
_STATE = """id, product_id, migration_run_id, migration_operation_id, migration_result_id,
    migration_state_id, release_version, target_group_alias, target_alias, filename, file_order_id,
    file_up_hash, file_up_config_hash, file_up_blocks_hash, file_up_blocks_migrated,
    file_up_blocks_total, migrate_down_file_exists, file_down_hash, file_down_config_hash,
    file_down_blocks_hash, file_down_blocks_migrated, file_down_blocks_total"""


def _quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _dimension_cte(table: str) -> str:
    rows = ", ".join(f"({i}, {_quote(n)}, {_quote(d)})" for i, n, d in master_rows()[table])
    return f"{table} AS (SELECT * FROM (VALUES {rows}) AS t(id, name, description))"


_DIMENSIONS = list(master_rows())
_FACTS = [t for t in TABLES if t not in _DIMENSIONS]


def _all_tables() -> str:
    return duckdb_ctes(*_FACTS) + ",\n" + ",\n".join(_dimension_cte(t) for t in _DIMENSIONS)


def _fk_orphans() -> str:
    parts = [
        f"""SELECT '{child}' AS child_table, '{column}' AS child_column, '{parent}' AS parent_table,
            CAST(c.{column} AS BIGINT) AS key_value, count(*) AS n_rows
            FROM {child} c
            WHERE c.{column} IS NOT NULL
              AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.id = c.{column})
            GROUP BY c.{column}"""
        for child, column, parent in FOREIGN_KEYS
    ]
    return _all_tables() + "\n" + "\nUNION ALL\n".join(parts)


def _pk_duplicates() -> str:
    parts = []
    for rules in (PRIMARY_KEYS, UNIQUE_KEYS):
        for table, (column,) in rules.items():
            parts.append(
                f"""SELECT '{table}' AS table_name, '{column}' AS key_columns,
                coalesce(CAST({column} AS VARCHAR), 'NULL') AS key_value, count(*) AS n_rows
                FROM {table} GROUP BY {column} HAVING count(*) > 1"""
            )
    return _all_tables() + "\n" + "\nUNION ALL\n".join(parts)


def _null_length_report() -> str:
    parts = []
    for table, columns in TABLES.items():
        for c in columns:
            nulls = "0" if c.nullable else f"count(*) FILTER ({c.name} IS NULL)"
            too_long = (
                f"count(*) FILTER (greatest(1, length(rtrim({c.name}))) > {c.max_length})"
                if c.max_length
                else "0"
            )
            # max() leaves the null texts out.
            size = (
                f"max(CASE WHEN {c.name} IS NOT NULL THEN greatest(1, length({c.name})) END)"
                if c.is_text
                else "NULL"
            )
            parts.append(
                f"""SELECT '{table}' AS table_name, '{c.name}' AS column_name,
                CAST({nulls} AS BIGINT) AS null_violations, CAST({too_long} AS BIGINT) AS length_violations,
                CAST({size} AS INTEGER) AS max_size FROM {table} HAVING count(*) >= 0"""
            )
    return _all_tables() + "\n" + "\nUNION ALL\n".join(parts)


def _completeness() -> str:
    expected = sorted(REPOSITORY_TABLES)
    values = ", ".join(f"({i}, '{t}')" for i, t in enumerate(expected))
    return duckdb_ctes("catalog_schema", "catalog_table") + f""",
    expected AS (SELECT * FROM (VALUES {values}) AS e(pos, table_name)),
    wanted AS (SELECT s.schema_name, e.pos, e.table_name FROM catalog_schema s CROSS JOIN expected e),
    checked AS (
        SELECT w.schema_name, count(c.table_name) AS found,
               max(CASE WHEN c.table_name = 'migrator_version' THEN 1 ELSE 0 END) AS versioned,
               coalesce(string_agg(CASE WHEN c.table_name IS NULL THEN w.table_name END, ',' ORDER BY w.pos), '')
                   AS missing
        FROM wanted w LEFT JOIN catalog_table c
          ON c.schema_name = w.schema_name AND c.table_name = w.table_name
        GROUP BY w.schema_name)
    SELECT schema_name, found AS tables_found,
           CASE WHEN versioned = 1 AND found = 10 THEN 'complete'
                WHEN versioned = 0 AND found = 0 THEN 'absent' ELSE 'corrupt' END AS status,
           CASE WHEN (versioned = 1 AND found = 10) OR found = 0 THEN 0 ELSE -1 END AS result_code,
           CASE WHEN (versioned = 1 AND found = 10) OR found = 0 THEN NULL
                ELSE '{TOOL} repository incomplete or corrupt. Repository contains [' || found
                     || CASE WHEN versioned = 1 THEN '] tables instead of [10].'
                        ELSE '] tables instead of the expected amount of [0].' END END AS message,
           missing
    FROM checked"""


def _decode(table: str, columns: dict[str, str], keep: str) -> str:
    names = ", ".join(
        f"d{i}.name AS {c.removesuffix('_id')}_name" for i, c in enumerate(columns)
    )
    joins = " ".join(
        f"LEFT JOIN {dim} d{i} ON d{i}.id = m.{c}" for i, (c, dim) in enumerate(columns.items())
    )
    ids = ", ".join(f"m.{c}" for c in columns)
    dims = ", ".join(_dimension_cte(d) for d in dict.fromkeys(columns.values()))
    return f"{duckdb_ctes(table)}, {dims} SELECT {keep}, {ids}, {names} FROM {table} m {joins}"


def _reasons(kind: str, columns: dict[str, str]) -> str:
    """A message that lists the columns whose condition holds, or null."""
    parts = ", ".join(f"CASE WHEN {holds} THEN '{name}' END" for name, holds in columns.items())
    return f"nullif('{kind} [' || concat_ws(' ', {parts}) || '] is not allowed!', '{kind} [] is not allowed!')"


def _long(column: str, limit: int) -> str:
    return f"length(rtrim({column})) > {limit}"


# New products: first request of each name that is not blank, not too long for the DDL and not
# stored, in the order of md5.
_PRODUCTS = duckdb_ctes("product_request", "product") + f""",
    judged AS (
        SELECT *, CASE WHEN name IS NULL OR length(rtrim(name)) = 0
                       THEN 'Product with empty name [' || coalesce(name, 'NULL') || '] is not allowed!'
                       ELSE {_reasons("Product with too long", {"name": _long("name", 100), "description": _long("description", 1000)})}
                       END AS refusal
        FROM product_request),
    known AS (SELECT name, count(*) AS n, min(id) AS id FROM product WHERE name IS NOT NULL GROUP BY name),
    named AS (
        SELECT name, min(request_id) AS first_id FROM judged WHERE refusal IS NULL GROUP BY name),
    fresh AS (
        SELECT n.name, n.first_id,
               (SELECT coalesce(max(id), 0) FROM product)
               + row_number() OVER (ORDER BY md5(n.name), n.name) AS new_id
        FROM named n WHERE NOT EXISTS (SELECT 1 FROM product p WHERE p.name = n.name)),
    answered AS (
        SELECT r.request_id, r.name, r.refusal, k.id AS known_id, f.first_id, k.n > 1 AS twice,
               CASE WHEN refusal IS NULL AND coalesce(k.n, 1) = 1 THEN coalesce(k.id, f.new_id) END AS id
        FROM judged r LEFT JOIN known k ON k.name = r.name LEFT JOIN fresh f ON f.name = r.name),
    product_answer AS (
        SELECT request_id, coalesce(id, -1) AS result_code,
               CASE WHEN refusal IS NOT NULL THEN refusal
                    WHEN twice THEN 'Multiple [Product]-entries found for Product [' || name || '].'
                    ELSE 'Product [' || name || '] with Id [' || id || '] '
                         || CASE WHEN known_id IS NULL AND request_id = first_id
                                 THEN 'successfully created' ELSE 'found' END END AS message, id
        FROM answered)"""

_KEY_TEXT = " || chr(31) || ".join(VERSION_KEY)
_VERSION_ENTRY = f"""'RepositoryVersion [' || coalesce(repository_version, 'NULL') || '], RepositoryDatabaseType ['
    || coalesce(repository_database_type, 'NULL') || '], {TOOL}Version [' || coalesce(created_by_version, 'NULL') || '].'"""
_VERSIONS = duckdb_ctes("version_request", "migrator_version") + f""",
    judged AS (
        SELECT *, CASE WHEN {" OR ".join(f"{k} IS NULL" for k in VERSION_KEY)}
                       THEN 'Incomplete version key: ' || {_VERSION_ENTRY}
                       ELSE {_reasons("Version key with too long", {k: _long(k, 100) for k in VERSION_KEY})}
                       END AS refusal
        FROM version_request),
    known AS (
        SELECT {", ".join(VERSION_KEY)}, count(*) AS n, min(id) AS id FROM migrator_version
        GROUP BY {", ".join(VERSION_KEY)}),
    asked AS (
        SELECT {", ".join(VERSION_KEY)}, min(request_id) AS first_id FROM judged WHERE refusal IS NULL
        GROUP BY {", ".join(VERSION_KEY)}),
    fresh AS (
        SELECT *, (SELECT max(id) FROM migrator_version) + row_number() OVER (ORDER BY md5({_KEY_TEXT})) AS new_id
        FROM asked ANTI JOIN known USING ({", ".join(VERSION_KEY)}))
    SELECT r.request_id,
           CASE WHEN refusal IS NOT NULL OR k.n > 1 THEN -1 ELSE coalesce(k.id, f.new_id) END AS result_code,
           CASE WHEN refusal IS NOT NULL THEN refusal
                WHEN k.n > 1 THEN 'Multiple [MigratorVersion]-entries found for RepositoryVersion ['
                    || r.repository_version || '], RepositoryDatabaseType [' || r.repository_database_type
                    || '], {TOOL}Version [' || r.created_by_version || '].'
                WHEN k.n = 1 THEN '{TOOL} repository already exists. Using VersionId [' || k.id || '].'
                WHEN r.request_id = f.first_id
                    THEN '{TOOL} repository already exists. New VersionId [' || f.new_id || '] created.'
                ELSE '{TOOL} repository already exists. Using VersionId [' || f.new_id || '].' END AS message,
           CASE WHEN refusal IS NULL AND coalesce(k.n, 1) = 1 THEN coalesce(k.id, f.new_id) END AS id
    FROM judged r LEFT JOIN known k USING ({", ".join(VERSION_KEY)})
    LEFT JOIN fresh f USING ({", ".join(VERSION_KEY)})"""

# A request the DDL lets into the run table; the parents are the tables its foreign keys name.
_MODE_IDS = ", ".join(str(row[0]) for row in master_rows()["migration_run_mode"])
_RESULT_IDS = ", ".join(str(row[0]) for row in master_rows()["migration_result"])
_NEEDED = ("product_id", "environment", "migration_run_mode_id", "migrator_version_id", "migration_result_id")
_RUN_REFUSAL = f"""coalesce(
    {_reasons("MigrationRun without", {c: f"{c} IS NULL" for c in _NEEDED})},
    {_reasons("MigrationRun with unknown", {
        "product_id": "product_id NOT IN (SELECT id FROM product)",
        "migrator_version_id": "migrator_version_id NOT IN (SELECT id FROM migrator_version)",
        "migration_run_mode_id": f"migration_run_mode_id NOT IN ({_MODE_IDS})",
        "migration_result_id": f"migration_result_id NOT IN ({_RESULT_IDS})",
    })},
    {_reasons("MigrationRun with too long", {
        c: _long(c, 100) for c in ("environment", "from_release_version", "to_release_version")
    })})"""

_REPAIRED = f"""
    SELECT m.* REPLACE (
        CASE WHEN m.finished_at IS NULL AND a.product_id IS NOT NULL THEN 91
             ELSE m.migration_result_id END AS migration_result_id,
        CASE WHEN m.finished_at IS NULL AND a.product_id IS NOT NULL THEN {_NOW}
             ELSE m.finished_at END AS finished_at)
    FROM migration_run m
    LEFT JOIN (SELECT DISTINCT {_RUN_KEY} FROM <asked>
               WHERE fix AND environment IS NOT NULL) a USING ({_RUN_KEY})"""


def _admission(fix: str, numbered_by: str = "") -> str:
    """Requests in order per key; ``fix`` is the SQL of the repair flag. Ids go by md5 within ``numbered_by``."""
    return duckdb_ctes("run_request", "migration_run", "product", "migrator_version") + f""",
    open_key AS (SELECT DISTINCT {_RUN_KEY} FROM migration_run WHERE finished_at IS NULL),
    numbered AS (
        SELECT *, {fix} AS wants_fix, refusal IS NULL AS valid
        FROM (SELECT *, {_RUN_REFUSAL} AS refusal FROM run_request)),
    placed AS (
        SELECT n.*, o.product_id IS NOT NULL AS was_open,
               row_number() OVER w AS turn,
               coalesce(max(CASE WHEN wants_fix THEN 1 ELSE 0 END) OVER (
                   PARTITION BY n.valid, n.product_id, n.environment, n.migration_run_mode_id
                   ORDER BY n.requested_at, n.request_id
                   ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), 0) = 1 AS ended_later
        FROM numbered n LEFT JOIN open_key o
          ON o.product_id = n.product_id AND o.environment = n.environment
         AND o.migration_run_mode_id = n.migration_run_mode_id
        WINDOW w AS (PARTITION BY n.valid, n.product_id, n.environment, n.migration_run_mode_id
                     ORDER BY n.requested_at, n.request_id)),
    entering AS (SELECT *, valid AND (wants_fix OR (turn = 1 AND NOT was_open)) AS entered FROM placed),
    decided AS (
        SELECT *, CASE WHEN entered THEN (SELECT max(id) FROM migration_run) + row_number() OVER (
                      PARTITION BY entered ORDER BY {numbered_by}md5(CAST(request_id AS VARCHAR))) END AS new_id
        FROM entering)"""


def _admission_results(fix: str) -> str:
    return _admission(fix) + """
    SELECT d.request_id, CASE WHEN entered THEN new_id ELSE -1 END AS result_code,
           CASE WHEN NOT valid THEN refusal
                WHEN entered THEN 'MigrationRun with Id [' || new_id
                    || '] successfully created for ProductId [' || d.product_id || ']'
                ELSE 'MigrationRun for Product [' || coalesce(p.name, 'NULL') || '] with Id ['
                    || d.product_id || '] is currently in progress. Parallel migrations for the same product'
                    || ' with MigrationRunModeId [Migrate=' || d.migration_run_mode_id
                    || '] are not allowed!' END AS message,
           CASE WHEN entered THEN new_id END AS id
    FROM decided d LEFT JOIN (SELECT id, min(name) AS name FROM product GROUP BY id) p ON p.id = d.product_id"""


def _admission_ledger(numbered_by: str = "") -> str:
    return _admission("fix", numbered_by) + f""",
    repaired AS ({_REPAIRED.replace("<asked>", "(SELECT * FROM numbered WHERE valid)")})
    SELECT * FROM repaired
    UNION ALL BY NAME
    SELECT new_id AS id, migrator_version_id, product_id, migration_run_mode_id,
           CASE WHEN ended_later THEN 91 ELSE migration_result_id END AS migration_result_id,
           environment, from_release_version, to_release_version, {_NOW} AS started_at,
           CASE WHEN ended_later THEN {_NOW} END AS finished_at, CAST(NULL AS BIGINT) AS duration_in_ms
    FROM decided WHERE entered"""


def _current_from_history() -> str:
    body = ", ".join(c.name for c in TABLES["migration"] if c.name != "id")
    return duckdb_ctes("migration_history") + f"""
    SELECT migration_id AS id, {body} FROM migration_history
    QUALIFY row_number() OVER (PARTITION BY migration_id ORDER BY id DESC) = 1"""


_SUMMARY = """
    SELECT migration_run_mode_id, migration_result_id, count(*) AS n_runs,
           count(*) FILTER (finished_at IS NULL) AS n_open,
           CAST(sum(ms) AS BIGINT) AS total_ms, avg(ms) AS avg_ms, max(ms) AS max_ms
    FROM (SELECT *, epoch_ms(finished_at) - epoch_ms(started_at) AS ms FROM {runs}) r
    GROUP BY ALL"""

# Comments out, then blocks between GO lines; blank blocks do not count.
_BLOCKS = r"""regexp_split_to_array(regexp_replace(content, '(?s)/\*.*?\*/', '', 'g'),
    '(?im)^[ \t]*GO[ \t]*\r?$')"""

# The same from left to right: d is the depth of comments, q the open quote, bracket or line comment,
# p the last character of a mark, o the text so far and c that of the open comment, which counts if
# it is never closed. Line breaks outside the code are chr(1) until the blocks are cut.
_SCANNED = r"""
    pieces AS (
        SELECT doc_id, release_version, list_transform(
                   regexp_extract_all(content, ']]|[-/*''"\[\]\n]|[^-/*''"\[\]\n]+'),
                   lambda t: {'d': 0, 'q': '', 'p': '', 'o': t, 'c': ''}) AS tokens
        FROM script_marked),
    scanned AS (
        SELECT doc_id, release_version, list_reduce(
            list_prepend({'d': 0, 'q': '', 'p': '', 'o': '', 'c': ''}, tokens), lambda a, t: CASE
                WHEN a.d = 1 AND a.p || t.o = '*/' THEN {'d': 0, 'q': '', 'p': '', 'o': a.o, 'c': ''}
                WHEN a.d > 0 AND a.p || t.o IN ('*/', '/*')
                    THEN {'d': a.d + CASE t.o WHEN '*' THEN 1 ELSE -1 END, 'q': '', 'p': '', 'o': a.o, 'c': a.c || t.o}
                WHEN a.d > 0 THEN {'d': a.d, 'q': '', 'p': t.o, 'o': a.o, 'c': a.c || t.o}
                WHEN a.q = '' AND a.p || t.o = '/*'
                    THEN {'d': 1, 'q': '', 'p': '', 'o': left(a.o, length(a.o) - 1), 'c': '/*'}
                WHEN a.q = '' AND a.p || t.o = '--' THEN {'d': 0, 'q': '--', 'p': '', 'o': a.o || t.o, 'c': ''}
                WHEN a.q = '' THEN {'d': 0, 'q': CASE WHEN t.o IN ('''', '"', '[') THEN t.o ELSE '' END,
                                    'p': t.o, 'o': a.o || t.o, 'c': ''}
                WHEN a.q = '--' AND t.o = chr(10) OR a.q = '[' AND t.o = ']' OR a.q IN ('''', '"') AND t.o = a.q
                    THEN {'d': 0, 'q': '', 'p': '', 'o': a.o || t.o, 'c': ''}
                ELSE {'d': 0, 'q': a.q, 'p': '', 'o': a.o || CASE WHEN t.o = chr(10) THEN chr(1) ELSE t.o END, 'c': ''}
            END) AS s
        FROM pieces),
    cut AS (
        SELECT doc_id, release_version, list_filter(
                   regexp_split_to_array(s.o || s.c, '(?im)^[ \t]*GO[ \t]*\r?$'),
                   lambda b: regexp_matches(replace(b, chr(1), chr(10)), '\S')) AS blocks
        FROM scanned)"""
_SPACE = " || ".join(f"chr({c})" for c in (32, 9, 10, 11, 12, 13))
_SETTINGS = r"(?s)/\*\s*\[Settings\](.*?)\*/"

ORACLES: dict[str, str] = {
    "state_select": duckdb_ctes("migration") + f"""
        SELECT {_STATE} FROM migration
        WHERE product_id = 7 AND environment = '1-URGENT' AND migration_run_mode_id = 100""",
    "state_select_many": duckdb_ctes("migration", "migration_run") + f"""
        SELECT {_STATE}, environment, migration_run_mode_id FROM migration m WHERE EXISTS (
            SELECT 1 FROM migration_run r WHERE r.finished_at IS NULL AND r.product_id = m.product_id
               AND r.environment = m.environment AND r.migration_run_mode_id = m.migration_run_mode_id)""",
    "lookup_cardinality": duckdb_ctes("version_request", "migrator_version") + f"""
        SELECT {", ".join(VERSION_KEY)}, count(v.id) AS n_rows,
               CASE WHEN count(v.id) = 1 THEN min(v.id) END AS id,
               CASE count(v.id) WHEN 0 THEN 'missing' WHEN 1 THEN 'found' ELSE 'ambiguous' END AS status
        FROM (SELECT DISTINCT {", ".join(VERSION_KEY)} FROM version_request) r
        LEFT JOIN migrator_version v USING ({", ".join(VERSION_KEY)})
        GROUP BY {", ".join(VERSION_KEY)}""",
    "decode_dimensions": _decode(
        "migration",
        {
            "migration_run_mode_id": "migration_run_mode",
            "migration_result_id": "migration_result",
            "migration_operation_id": "migration_operation",
            "migration_state_id": "migration_state",
        },
        "m.id, m.file_up_hash",
    ),
    "decode_log": _decode(
        "migration_log",
        {"migration_event_id": "migration_event", "run_mode_id": "migration_run_mode"},
        "m.id, m.log_level_id",
    ),
    "run_summary": duckdb_ctes("migration_run") + _SUMMARY.format(runs="migration_run"),
    "run_durations": duckdb_ctes("migration_run") + """
        SELECT id, started_at, finished_at, epoch_ms(finished_at) - epoch_ms(started_at) AS duration_in_ms
        FROM migration_run""",
    "state_summary": duckdb_ctes("migration") + """
        SELECT migration_state_id, migration_result_id, migration_run_mode_id, count(*) AS n_files
        FROM migration GROUP BY ALL""",
    "block_progress": duckdb_ctes("migration") + """
        SELECT release_version, target_group_alias, target_alias, count(*) AS n_files,
               CAST(sum(file_up_blocks_migrated) AS BIGINT) AS up_migrated,
               CAST(sum(file_up_blocks_total) AS BIGINT) AS up_total,
               CAST(sum(file_down_blocks_migrated) AS BIGINT) AS down_migrated,
               CAST(sum(file_down_blocks_total) AS BIGINT) AS down_total,
               count(*) FILTER (file_up_blocks_migrated < file_up_blocks_total) AS n_unfinished
        FROM migration GROUP BY ALL""",
    "fk_orphans": _fk_orphans(),
    "fk_orphan_rows": duckdb_ctes("migration_run", "migrator_version") + """
        SELECT id, migrator_version_id, started_at FROM migration_run r
        WHERE NOT EXISTS (SELECT 1 FROM migrator_version v WHERE v.id = r.migrator_version_id)""",
    "pk_duplicates": _pk_duplicates(),
    "null_length_report": _null_length_report(),
    "null_length_on_write": _null_length_report(),
    "completeness": _completeness(),
    "product_get_or_create": _PRODUCTS + " SELECT * FROM product_answer",
    "product_new_rows": _PRODUCTS + f"""
        SELECT f.new_id AS id, f.name, r.description, {_NOW} AS created_at
        FROM fresh f JOIN product_request r ON r.request_id = f.first_id""",
    "version_get_or_create": _VERSIONS,
    "run_repair": duckdb_ctes("migration_run", "run_request") + _REPAIRED.replace("<asked>", "run_request"),
    "run_admission": _admission_results("false"),
    "run_insert": _admission_results("fix"),
    "run_ledger_after_insert": _admission_ledger(),
    "current_from_history": _current_from_history(),
    "current_kept_up_to_date": _current_from_history(),
    "envelope_parse": duckdb_ctes("result_line") + """,
        cut AS (SELECT event_id, line, strpos(line, ',') AS comma FROM result_line),
        parts AS (
            SELECT event_id,
                   TRY_CAST(CASE WHEN comma > 0 THEN substr(line, 1, comma - 1) ELSE line END AS BIGINT)
                       AS result_code,
                   CASE WHEN comma > 0 THEN substr(line, comma + 1) END AS message
            FROM cut)
        SELECT event_id, result_code, message,
               CASE WHEN result_code < 0 THEN 'Error' WHEN result_code >= 0 THEN 'Debug' END AS log_level,
               result_code >= 0 AS is_ok
        FROM parts""",
    "envelope_format": _PRODUCTS + """
        SELECT request_id, CAST(result_code AS VARCHAR) || ',' || message AS line FROM product_answer""",
    "date_floor": duckdb_ctes("old_date") + """
        SELECT o_orderkey, CASE WHEN moved < TIMESTAMP '1753-01-01' THEN TIMESTAMP '1753-01-01'
                                ELSE moved END AS moved
        FROM old_date""",
    "typed_cast": duckdb_ctes("event_text") + """,
        typed AS (
            SELECT event_id, TRY_CAST(user_text AS INTEGER) AS user_text,
                   CAST(TRY_CAST(k_text AS UTINYINT) AS SMALLINT) AS k_text,
                   TRY_CAST(id_text AS SMALLINT) AS id_text, TRY_CAST(flag_text AS BOOLEAN) AS flag_text
            FROM event_text)
        SELECT *, concat_ws(',', CASE WHEN id_text IS NULL THEN 'id_text' END,
                            CASE WHEN flag_text IS NULL THEN 'flag_text' END) AS bind_errors
        FROM typed""",
    "parameter_binding": duckdb_ctes("parameter") + """
        SELECT request_id, name, type_name, value,
               CASE type_name WHEN 'int' THEN 'Int32' WHEN 'sbyte' THEN 'SByte' WHEN 'string' THEN 'String'
                    END AS db_type,
               CAST(CASE WHEN type_name = 'string' AND value IS NOT NULL THEN greatest(1, length(value)) END AS INTEGER)
                   AS size,
               CASE WHEN count(*) OVER (PARTITION BY request_id, name) > 1 THEN 'duplicate name'
                    WHEN type_name = 'TimeSpan' THEN 'unsupported type'
                    WHEN type_name = 'sbyte' AND TRY_CAST(value AS TINYINT) IS NULL THEN 'bad value'
                    ELSE 'ok' END AS status
        FROM parameter""",
    "template_render": duckdb_ctes("template", "template_config") + """
        SELECT t.doc_id, t.target_group_alias,
               -- Schema names first go to a mark, because a base name holds a placeholder itself.
               replace(replace(replace(t.content, '{CFG:SchemaName}', chr(1)),
                       '{CFG:TableBaseName}', coalesce(c.table_base_name, '{CFG:TableBaseName}')),
                       chr(1), c.schema_name) AS rendered,
               concat_ws(',', CASE WHEN c.table_base_name IS NULL THEN 'TableBaseName' END,
                         CASE WHEN contains(t.content, '{CFG:Unknown}') THEN 'Unknown' END) AS unresolved
        FROM template t JOIN template_config c USING (target_group_alias)""",
    "script_blocks": duckdb_ctes("script_with_settings") + rf"""
        SELECT doc_id, CAST(pos AS INTEGER) AS block_no, block
        FROM (SELECT doc_id, unnest(blocks) AS block, generate_subscripts(blocks, 1) AS pos
              FROM (SELECT doc_id, list_filter({_BLOCKS}, lambda b: regexp_matches(b, '\S')) AS blocks
                    FROM script_with_settings) s) t""",
    "script_marked_blocks": duckdb_ctes("script_marked") + "," + _SCANNED + """
        SELECT doc_id, release_version, CAST(pos AS INTEGER) AS block_no, replace(block, chr(1), chr(10)) AS block
        FROM (SELECT doc_id, release_version, unnest(blocks) AS block, generate_subscripts(blocks, 1) AS pos FROM cut)""",
    "script_block_counts": duckdb_ctes("script") + rf"""
        SELECT filename, doc_id, release_version, target_group_alias,
               CAST(len(list_filter({_BLOCKS}, lambda b: regexp_matches(b, '\S'))) AS INTEGER) AS blocks_total
        FROM script""",
    "script_hash": duckdb_ctes("script_with_settings") + rf"""
        SELECT filename, doc_id, release_version, target_group_alias, sha256(content) AS file_hash,
               CASE WHEN regexp_matches(content, '{_SETTINGS}')
                    THEN sha256(array_to_string(regexp_extract_all(content, '{_SETTINGS}', 1), chr(10)))
                    END AS config_hash,
               sha256(regexp_replace(content, '{_SETTINGS}', '', 'g')) AS blocks_hash
        FROM script_with_settings""",
    "file_order": duckdb_ctes("script") + """
        SELECT release_version, target_group_alias, filename,
               row_number() OVER (ORDER BY release_version, target_group_alias, filename) AS file_order_id
        FROM script""",
    # Block lists are compared as they are, without hashes.
    "script_resume": duckdb_ctes("script", "script_next") + rf""",
        a AS (SELECT *, CASE doc_id % 3 WHEN 0 THEN len(blocks) // 3 WHEN 1 THEN len(blocks) ELSE 0 END AS done
              FROM (SELECT release_version, target_group_alias, filename, doc_id,
                           list_transform(list_filter({_BLOCKS}, lambda b: regexp_matches(b, '\S')), lambda b: trim(b, {_SPACE})) AS blocks FROM script)),
        b AS (SELECT release_version, target_group_alias, filename,
                     list_transform(list_filter({_BLOCKS}, lambda b: regexp_matches(b, '\S')), lambda b: trim(b, {_SPACE})) AS blocks FROM script_next),
        s AS (SELECT release_version, target_group_alias, filename, done, len(b.blocks) AS total,
                     CASE WHEN a.blocks IS NULL THEN 'Added' WHEN b.blocks IS NULL THEN 'Removed'
                          WHEN a.blocks = b.blocks THEN 'Unchanged'
                          WHEN a.blocks[1 : done] = b.blocks[1 : done] THEN 'Rest changed'
                          ELSE 'Prefix changed' END AS status
              FROM a FULL JOIN b USING (release_version, target_group_alias, filename))
        SELECT release_version, target_group_alias, filename, status, CAST(done AS INTEGER) AS blocks_migrated,
               CAST(total AS INTEGER) AS blocks_total,
               CAST(CASE WHEN goes THEN coalesce(done, 0) + 1 END AS INTEGER) AS first_block,
               CAST(CASE WHEN goes THEN total - coalesce(done, 0) ELSE 0 END AS INTEGER) AS blocks_to_run
        FROM (SELECT *, status IN ('Added', 'Unchanged', 'Rest changed') AND total > coalesce(done, 0) AS goes FROM s)""",
    "script_drift": duckdb_ctes("script", "script_next") + """
        SELECT release_version, target_group_alias, filename,
               sha256(a.content) AS previous_hash, sha256(b.content) AS current_hash,
               CASE WHEN a.content IS NULL THEN 'Added' WHEN b.content IS NULL THEN 'Removed'
                    WHEN sha256(a.content) = sha256(b.content) THEN 'Unchanged' ELSE 'Changed' END AS drift
        FROM script a FULL JOIN script_next b USING (release_version, target_group_alias, filename)""",
    "log_append": duckdb_ctes("log_entry", "migration_log") + f"""
        SELECT (SELECT max(id) FROM migration_log)
               + row_number() OVER (ORDER BY md5(CAST(migration_run_id AS VARCHAR))) AS id,
               *, {_NOW} AS created_at
        FROM log_entry""",
    "log_stream": duckdb_ctes("migration_log") + " SELECT * FROM migration_log",
    "repository_load": duckdb_ctes("migration_run", "run_request") + f""",
        repaired AS ({_REPAIRED.replace("<asked>", "run_request")})""" + _SUMMARY.format(runs="repaired"),
    "run_apply": _admission_results("fix"),
    "run_ledger_applied": _admission_ledger(),
    "product_apply": _PRODUCTS + " SELECT * FROM product_answer",
    "log_append_stored": duckdb_ctes("log_entry", "migration_log") + f"""
        SELECT * FROM migration_log
        UNION ALL BY NAME
        SELECT (SELECT max(id) FROM migration_log)
               + row_number() OVER (ORDER BY md5(CAST(migration_run_id AS VARCHAR))) AS id,
               *, {_NOW} AS created_at
        FROM log_entry""",
    "product_ledger_applied_twice": _PRODUCTS + f"""
        SELECT id, name, description, created_at FROM product
        UNION ALL
        SELECT f.new_id, f.name, r.description, {_NOW} FROM fresh f JOIN product_request r ON r.request_id = f.first_id""",
    "run_ledger_applied_twice": _admission_ledger(),
    "run_ledger_live": _admission_ledger(
        "CASE WHEN year(requested_at) < 1994 THEN 1 WHEN year(requested_at) < 1997 THEN 2 ELSE 3 END, "
    ),
    "log_activity_live": duckdb_ctes("migration_log") + f""",
        {_dimension_cte("migration_event")}, {_dimension_cte("migration_run_mode")},
        come AS (SELECT *, CASE migration_event_id WHEN 10 THEN 1 WHEN 20 THEN 2 ELSE 3 END AS part FROM migration_log),
        before AS (
            SELECT part, max(max(created_at)) OVER (
                       ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS newest
            FROM come GROUP BY part),
        timed AS (SELECT * FROM come JOIN before USING (part))
        SELECT date_trunc('hour', l.created_at) AS hour, l.log_level_id, l.migration_event_id, l.run_mode_id,
               count(*) AS n_entries,
               count(*) FILTER (l.created_at < l.newest - INTERVAL 1 DAY) AS n_late,
               e.name AS migration_event_name, m.name AS run_mode_name
        FROM timed l LEFT JOIN migration_event e ON e.id = l.migration_event_id
             LEFT JOIN migration_run_mode m ON m.id = l.run_mode_id
        GROUP BY ALL""",
    "log_append_numbered": duckdb_ctes("log_entry", "migration_log") + f"""
        SELECT * FROM migration_log
        UNION ALL BY NAME
        SELECT (SELECT max(id) FROM migration_log)
               + row_number() OVER (ORDER BY md5(CAST(migration_run_id AS VARCHAR))) AS id,
               *, {_NOW} AS created_at
        FROM log_entry""",
    "log_stream_numbered": duckdb_ctes("migration_log") + """
        SELECT * REPLACE (row_number() OVER (ORDER BY md5(CAST(id AS VARCHAR))) AS id) FROM migration_log""",
    "log_stream_once": duckdb_ctes("migration_log") + " SELECT * FROM migration_log",
    "parameter_types": duckdb_ctes("typed_parameter") + """
        SELECT request_id, name, type_name, value,
               CASE regexp_replace(replace(type_name, '?', ''), '[(].*', '')
                    WHEN 'byte' THEN 'Byte' WHEN 'sbyte' THEN 'SByte' WHEN 'short' THEN 'Int16'
                    WHEN 'ushort' THEN 'UInt16' WHEN 'int' THEN 'Int32' WHEN 'uint' THEN 'UInt32'
                    WHEN 'long' THEN 'Int64' WHEN 'ulong' THEN 'UInt64' WHEN 'float' THEN 'Single'
                    WHEN 'double' THEN 'Double' WHEN 'decimal' THEN 'Decimal' WHEN 'bool' THEN 'Boolean'
                    WHEN 'string' THEN 'String' WHEN 'char' THEN 'StringFixedLength' WHEN 'Guid' THEN 'Guid'
                    WHEN 'DateTime' THEN 'DateTime' WHEN 'DateTimeOffset' THEN 'DateTimeOffset'
                    WHEN 'byte[]' THEN 'Binary' ELSE 'Xml' END AS db_type,
               CAST(CASE WHEN type_name = 'string' THEN length(value) END AS INTEGER) AS size,
               CASE WHEN fits THEN 'ok' ELSE 'bad value' END AS status
        FROM typed_parameter""",
}
ORACLES["state_select_stored"] = ORACLES["state_select_many"]
