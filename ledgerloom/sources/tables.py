"""Definitions of the twelve ledger tables.

Spark checks neither keys nor ``NOT NULL`` on Parquet tables, so the rules are kept here
as data and applied by ``operators.checks``.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import types as T

# Tables, columns, lengths and nullability of the ledger. "!" = not null.
_DIMENSION = "id smallint!, name varchar(100), description varchar(1000)"
_DIMENSION_NAMED = "id smallint!, name varchar(100)!, description varchar(1000)"
_MIGRATION_BODY = """
    product_id bigint!, migration_run_id bigint!, migration_run_mode_id smallint!,
    migration_operation_id smallint!, migration_result_id smallint!, migration_state_id smallint!,
    environment varchar(100)!, release_version varchar(100)!, target_group_alias varchar(100)!,
    target_alias varchar(100)!, filename varchar(200)!, file_order_id int!,
    file_up_hash varchar(100)!, file_up_config_hash varchar(100), file_up_blocks_hash varchar(100)!,
    file_up_blocks_migrated int!, file_up_blocks_total int!, file_up_config_json string,
    migrate_down_file_exists boolean!,
    file_down_hash varchar(100), file_down_config_hash varchar(100), file_down_blocks_hash varchar(100),
    file_down_blocks_migrated int, file_down_blocks_total int, file_down_config_json string,
    started_at timestamp_ntz, finished_at timestamp_ntz, duration_in_ms bigint"""
_COLUMNS = {
    "migration_operation": _DIMENSION,
    "migration_result": _DIMENSION_NAMED,
    "migration_run_mode": _DIMENSION_NAMED,
    "migration_state": _DIMENSION,
    "migrator_version": """
        id bigint!, repository_version varchar(100)!, repository_database_type varchar(100)!,
        created_by_version varchar(100)!, created_at timestamp_ntz!""",
    "product": """
        id bigint!, name varchar(100)!, description varchar(1000), created_at timestamp_ntz!""",
    "migration_run": """
        id bigint!, migrator_version_id bigint!, product_id bigint!, migration_run_mode_id smallint!,
        migration_result_id smallint!, environment varchar(100)!, from_release_version varchar(100),
        to_release_version varchar(100), started_at timestamp_ntz!, finished_at timestamp_ntz,
        duration_in_ms bigint""",
    "migration_run_meta": """
        migration_run_id bigint!, migration_run_settings_json string, description string""",
    "migration": "id bigint!," + _MIGRATION_BODY,
    "migration_history": "id bigint!, migration_id bigint!," + _MIGRATION_BODY,
    "migration_event": "id int!, name varchar(100)!, description varchar(1000)",
    "migration_log": """
        id bigint!, log_level_id smallint!, migration_event_id int, run_mode_id smallint,
        product_id int, migration_run_id int, environment varchar(100), release_version varchar(100),
        target_group_alias varchar(100), target_alias varchar(100), filename varchar(300),
        file_order_id int, file_block_id int, message string, created_at timestamp_ntz!""",
}

# Primary keys, the one unique key, and the foreign keys.
PRIMARY_KEYS = {
    name: ("migration_run_id",) if name == "migration_run_meta" else ("id",) for name in _COLUMNS
}
UNIQUE_KEYS = {"product": ("name",)}
FOREIGN_KEYS = [
    ("migration", "product_id", "product"),
    ("migration", "migration_run_id", "migration_run"),
    ("migration", "migration_run_mode_id", "migration_run_mode"),
    ("migration", "migration_operation_id", "migration_operation"),
    ("migration", "migration_state_id", "migration_state"),
    ("migration", "migration_result_id", "migration_result"),
    ("migration_history", "migration_run_id", "migration_run"),
    ("migration_history", "migration_id", "migration"),
    ("migration_history", "product_id", "product"),
    ("migration_run", "product_id", "product"),
    ("migration_run", "migration_result_id", "migration_result"),
    ("migration_run", "migration_run_mode_id", "migration_run_mode"),
    ("migration_run", "migrator_version_id", "migrator_version"),
    ("migration_run_meta", "migration_run_id", "migration_run"),
]

LOG_TABLES = ("migration_event", "migration_log")
REPOSITORY_TABLES = tuple(name for name in _COLUMNS if name not in LOG_TABLES)

RUN_KEY = ["product_id", "environment", "migration_run_mode_id"]
VERSION_KEY = ["repository_version", "repository_database_type", "created_by_version"]

# How the large tables are looked up; stored rows are kept in this order. The id comes last, so
# that the rows of one hot key can lie in several files.
LOOKUP_ORDER = {
    "migration_run": [*RUN_KEY, "id"],
    "migration": [*RUN_KEY, "id"],
    "migration_history": ["migration_id", "id"],
    "migration_log": ["product_id", "id"],
}

# Columns with Bloom filters: rows that were appended are not yet in the order of the others, so the
# least and the largest value of a file say little.
BLOOM_FILTERS = {
    "product": ["name"],
    "migration_run": ["product_id"],
    "migration": ["product_id"],
    "migration_history": ["migration_id"],
    "migration_log": ["product_id"],
}


def write_options(table: str) -> dict[str, str]:
    """Options for writing a table as Parquet; the size of a filter follows its distinct values."""
    filters = {f"parquet.bloom.filter.enabled#{c}": "true" for c in BLOOM_FILTERS.get(table, [])}
    return {**filters, "parquet.bloom.filter.adaptive.enabled": "true"} if filters else {}


_SPARK_TYPES = {
    "smallint": T.ShortType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "boolean": T.BooleanType(),
    "string": T.StringType(),
    "timestamp_ntz": T.TimestampNTZType(),
}


@dataclass(frozen=True)
class Column:
    name: str
    sql_type: str
    nullable: bool
    max_length: int | None

    @property
    def is_text(self) -> bool:
        return self.sql_type == "string" or self.max_length is not None

    @property
    def spark_type(self) -> T.DataType:
        return T.StringType() if self.is_text else _SPARK_TYPES[self.sql_type]


def _column(text: str) -> Column:
    name, sql_type = text.split()
    length = re.search(r"\((\d+)\)", sql_type)
    return Column(
        name,
        sql_type.rstrip("!"),
        not sql_type.endswith("!"),
        int(length.group(1)) if length else None,
    )


TABLES: dict[str, list[Column]] = {
    name: [_column(part) for part in spec.split(",")] for name, spec in _COLUMNS.items()
}


def struct_type(table: str) -> T.StructType:
    """Schema for reading or creating rows; lengths stay in the field metadata."""
    return T.StructType(
        [
            T.StructField(
                c.name, c.spark_type, c.nullable, {"max_length": c.max_length} if c.max_length else {}
            )
            for c in TABLES[table]
        ]
    )


def ddl(table: str) -> str:
    """Column list for ``CREATE TABLE``; Spark enforces ``VARCHAR(n)`` on insert."""
    return ", ".join(
        f"{c.name} {c.sql_type.upper()}" + ("" if c.nullable else " NOT NULL") for c in TABLES[table]
    )
