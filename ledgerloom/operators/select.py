"""Reading the ledger: state selects, lookups, decoding, summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.values import duration_ms
from ledgerloom.operators.joins import lookup, with_keys
from ledgerloom.plans.storage import stored
from ledgerloom.sources.tables import RUN_KEY, TABLES

# Columns of a migration that the state select leaves out.
_NOT_SELECTED = {
    "migration_run_mode_id",
    "environment",
    "file_up_config_json",
    "file_down_config_json",
    "started_at",
    "finished_at",
    "duration_in_ms",
}
STATE_COLUMNS = [c.name for c in TABLES["migration"] if c.name not in _NOT_SELECTED]


def state_select(
    migration: DataFrame, product_id: int, environment: str, run_mode_id: int
) -> DataFrame:
    """All migrations of one product, environment and run mode."""
    return migration.where(
        (F.col("product_id") == product_id)
        & (F.col("environment") == environment)
        & (F.col("migration_run_mode_id") == run_mode_id)
    ).select(*STATE_COLUMNS)


def _others(columns: list[str]) -> list[str]:
    return [c for c in STATE_COLUMNS if c not in columns]


def state_select_many(migration: DataFrame, keys: DataFrame) -> DataFrame:
    """The state select for a table of keys; a key asked for twice counts once.

    Requests are not paired with migrations: many requests of one hot key would repeat all its
    rows. A request finds its rows again by its key. Runs jobs on the key columns, after which the
    wide migrations are not shuffled.
    """
    return state_select_asked(migration, stored(keys.select(*RUN_KEY).distinct(), "asked-keys"))


def state_select_asked(migration: DataFrame, asked: DataFrame) -> DataFrame:
    """The same for keys that are written already, each once."""
    return with_keys(migration, asked, RUN_KEY).select(*RUN_KEY, *_others(RUN_KEY))


def match_cardinality(
    keys: DataFrame, ledger: DataFrame, on: list[str], id_col: str = "id"
) -> DataFrame:
    """For each distinct key: rows in the ledger, the id if there is exactly one, and the case."""
    asked = keys.select(*on).distinct()
    # Of the ledger only the asked keys are grouped.
    found = (
        lookup(ledger.select(*on, id_col), asked, on, "left_semi")
        .groupBy(*on)
        .agg(F.count("*").alias("_rows"), F.min(id_col).alias("_first_id"))
    )
    rows = F.coalesce(F.col("_rows"), F.lit(0))
    return asked.join(found, on, "left").select(
        *on,
        rows.alias("n_rows"),
        F.when(rows == 1, F.col("_first_id")).alias("id"),
        F.when(rows == 0, "missing").when(rows == 1, "found").otherwise("ambiguous").alias("status"),
    )


def decode(rows: DataFrame, dims: dict[str, DataFrame], columns: dict[str, str]) -> DataFrame:
    """Add the name for each id column: ``columns`` maps an id column to its dimension.

    The new column is the id column with ``_name`` in place of ``_id``; unknown ids give null.
    No broadcast hint: master data is a literal of known size, and a stored dimension is sized
    by its files, so Spark broadcasts both by itself.
    """
    for id_col, dim in columns.items():
        names = dims[dim].select(
            F.col("id").cast("bigint").alias("_dim_id"),
            F.col("name").alias(id_col.removesuffix("_id") + "_name"),
        )
        match = F.col(id_col).cast("bigint") == F.col("_dim_id")
        rows = rows.join(names, match, "left").drop("_dim_id")
    return rows


# Which dimension explains which id column.
RUN_DIMENSIONS = {
    "migration_run_mode_id": "migration_run_mode",
    "migration_result_id": "migration_result",
}
MIGRATION_DIMENSIONS = {
    **RUN_DIMENSIONS,
    "migration_operation_id": "migration_operation",
    "migration_state_id": "migration_state",
}
LOG_DIMENSIONS = {"migration_event_id": "migration_event", "run_mode_id": "migration_run_mode"}


def run_summary(runs: DataFrame) -> DataFrame:
    """Runs per mode and result: all, open, and the times of the finished ones."""
    spent = duration_ms(F.col("started_at"), F.col("finished_at"))
    return runs.groupBy("migration_run_mode_id", "migration_result_id").agg(
        F.count("*").alias("n_runs"),
        F.count_if(F.col("finished_at").isNull()).alias("n_open"),
        F.sum(spent).alias("total_ms"),
        F.avg(spent).alias("avg_ms"),
        F.max(spent).alias("max_ms"),
    )


def state_summary(migration: DataFrame) -> DataFrame:
    """Files per state, result and run mode."""
    return migration.groupBy(
        "migration_state_id", "migration_result_id", "migration_run_mode_id"
    ).agg(F.count("*").alias("n_files"))


def block_progress(migration: DataFrame) -> DataFrame:
    """Blocks migrated against all blocks per release and target, upwards and downwards."""
    total = F.sum("file_up_blocks_total")
    migrated = F.sum("file_up_blocks_migrated")
    return migration.groupBy("release_version", "target_group_alias", "target_alias").agg(
        F.count("*").alias("n_files"),
        migrated.alias("up_migrated"),
        total.alias("up_total"),
        F.sum("file_down_blocks_migrated").alias("down_migrated"),
        F.sum("file_down_blocks_total").alias("down_total"),
        F.count_if(F.col("file_up_blocks_migrated") < F.col("file_up_blocks_total")).alias("n_unfinished"),
    )


def with_duration(rows: DataFrame) -> DataFrame:
    """Fill ``duration_in_ms`` from the start and finish times; null while unfinished."""
    return rows.withColumn(
        "duration_in_ms", duration_ms(F.col("started_at"), F.col("finished_at"))
    )
