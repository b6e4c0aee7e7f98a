"""Master data of the ledger and the text constants of its messages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.sources.tables import struct_type

# The tool that owns a ledger puts its own name into messages and event names. It is an
# argument everywhere; this is only the default.
TOOL = "Migrator"

# Version of the repository layout.
REPOSITORY_VERSION = "2025-02-12.1"

# Rows of the dimensions.
RUN_MODES = [
    (10, "Validate", "Validates configuration and all migration files. Does NOT perform actual migration against target databases."),
    (20, "Simulate", "Validates configuration and all migration files. Simulates the entire migration process. Does NOT perform actual migrations against target databases."),
    (100, "Migrate", "Validates configuration and all migration files. Performs actual migrations against target databases."),
]
OPERATIONS = [
    (5, "Rollback", "Performing Rollback of current MigrationRun"),
    (50, "MigrateDown", "Performing Down-Migration"),
    (100, "MigrateUp", "Performing Up-Migration"),
]
RESULTS = [
    (1, "Unprocessed", "Migration-file was found but has neither been processed nor migrated"),
    (10, "Running", "Migration process is currently running"),
    (11, "Skipped", "Migration process was skipped"),
    (90, "Error", "Migration(s) stopped due to error(s)"),
    (91, "ManuallyTerminatedByFix", "Migration(s) remained in a problematic or unclear state and were manually set to a terminated state"),
    (100, "Ok", "Migration(s) successfully executed"),
]
STATES = [
    (10, "Unclear", "Migration process is currently running"),
    (11, "NotMigrated", "Migration process was skipped"),
    (99, "Migrated", "Migration(s) stopped due to error(s)"),
]
EVENTS = [
    (0, "UnspecifiedEvent"),
    (10, "CommandLineParsing"),
    (20, "EnvironmentVariableReplacement"),
    (31, "CreateDatabaseLogger"),
    (32, "CreateCompositeLogger"),
    (40, "Validate{tool}Options"),
    (50, "CreateApplicationHost"),
    (60, "InitializeDalSpecificProperties"),
    (70, "ValidateConnectionStrings"),
    (80, "{tool}ServiceStart"),
    (100, "CreateAndStart{tool}Service"),
    (1000, "{tool}ServiceShutdown"),
]

# Ids with a meaning of their own.
RESULT_FIXED = 91
MODE_MIGRATE = 100

MODE_IDS = [row[0] for row in RUN_MODES]
RESULT_IDS = [row[0] for row in RESULTS]


def master_rows(tool: str = TOOL) -> dict[str, list[tuple]]:
    return {
        "migration_run_mode": RUN_MODES,
        "migration_operation": OPERATIONS,
        "migration_result": RESULTS,
        "migration_state": STATES,
        "migration_event": [(i, name.format(tool=tool), "") for i, name in EVENTS],
    }


def dimension(spark: SparkSession, table: str, tool: str = TOOL) -> DataFrame:
    """One of the five dimensions (at most 12 rows) as literal rows."""
    schema = struct_type(table)
    names = ", ".join(schema.names)
    columns = ", ".join(f"CAST({f.name} AS {f.dataType.simpleString()}) AS {f.name}" for f in schema)
    rows = ", ".join(
        "(" + ", ".join(str(v) if isinstance(v, int) else _quoted(v) for v in row) + ")"
        for row in master_rows(tool)[table]
    )
    return spark.sql(f"SELECT {columns} FROM VALUES {rows} AS t({names})")


def _quoted(text: str) -> str:
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def dimensions(spark: SparkSession, tool: str = TOOL) -> dict[str, DataFrame]:
    return {name: dimension(spark, name, tool) for name in master_rows(tool)}
