"""What the database enforced and Parquet does not: keys, references, nulls, lengths, tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ledgerloom.functions.values import shown, text_units_sql
from ledgerloom.sources.master import TOOL
from ledgerloom.sources.tables import (
    FOREIGN_KEYS,
    PRIMARY_KEYS,
    REPOSITORY_TABLES,
    TABLES,
    UNIQUE_KEYS,
)


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def duplicate_keys(table: DataFrame, key: list[str]) -> DataFrame:
    """Key values that occur more than once, with their number of rows."""
    return table.groupBy(*key).agg(F.count("*").alias("n_rows")).where("n_rows > 1")


def key_violations(tables: dict[str, DataFrame]) -> DataFrame:
    """Duplicate groups of every declared primary and unique key of the given tables."""
    declared = [(t, key) for rules in (PRIMARY_KEYS, UNIQUE_KEYS) for t, key in rules.items()]
    return _union(
        [
            duplicate_keys(tables[t], list(key)).select(
                F.lit(t).alias("table_name"),
                F.lit(",".join(key)).alias("key_columns"),
                F.concat_ws(",", *[shown(F.col(k)) for k in key]).alias("key_value"),
                "n_rows",
            )
            for t, key in declared
            if t in tables
        ]
    )


def orphan_rows(child: DataFrame, column: str, parent: DataFrame, parent_key: str = "id") -> DataFrame:
    """Child rows whose key is set but has no parent."""
    known = parent.select(F.col(parent_key).alias("_parent_key"))
    return child.where(F.col(column).isNotNull()).join(
        known, F.col(column) == F.col("_parent_key"), "left_anti"
    )


def foreign_key_violations(tables: dict[str, DataFrame]) -> DataFrame:
    """Unknown key values of every declared foreign key, with the number of rows that hold them.

    Each child table is read once: its keys are counted per (constraint, value) on the map side,
    so hot keys shrink to one row before the shuffle, and one anti join serves all constraints.
    """
    declared = [fk for fk in FOREIGN_KEYS if fk[0] in tables and fk[2] in tables]
    children = list(dict.fromkeys(child for child, _, _ in declared))
    parents = list(dict.fromkeys(parent for _, _, parent in declared))
    counted = _union([_key_counts(tables[c], c, declared, parents) for c in children])
    known = _union(
        [
            tables[p].selectExpr(f"{i} AS parent_no", "CAST(id AS BIGINT) AS key_value")
            for i, p in enumerate(parents)
        ]
    )

    def text(position: int, number: str) -> Column:
        return F.get(F.array(*[F.lit(fk[position]) for fk in declared]), F.col(number))

    # The value first: Spark sorts by the leading key, and the number alone is the same for many.
    return counted.join(known, ["key_value", "parent_no"], "left_anti").select(
        text(0, "fk_no").alias("child_table"),
        text(1, "fk_no").alias("child_column"),
        text(2, "fk_no").alias("parent_table"),
        "key_value",
        "n_rows",
    )


def _key_counts(
    child: DataFrame, name: str, declared: list[tuple[str, str, str]], parents: list[str]
) -> DataFrame:
    # Numbers, not names, are grouped and shuffled.
    entries = ", ".join(
        f"struct({i} AS fk_no, {parents.index(parent)} AS parent_no, CAST({column} AS BIGINT) AS key_value)"
        for i, (table, column, parent) in enumerate(declared)
        if table == name
    )
    return (
        child.selectExpr(f"inline(array({entries}))")
        .where("key_value IS NOT NULL")
        .groupBy("fk_no", "parent_no", "key_value")
        .agg(F.count("*").alias("n_rows"))
    )


def column_report(tables: dict[str, DataFrame]) -> DataFrame:
    """Per column: nulls that are not allowed, texts that are too long, and the widest text.

    One pass per table. Trailing blanks do not make a text too long: a store trims them to fit.
    """
    return _union([_column_report(name, df) for name, df in tables.items()])


def _column_measures(table: str) -> tuple[list[str], str]:
    """Aggregates over the rows of a table, and the report rows made of them."""
    # As SQL text: one expression per measure, where the Column API would take dozens of calls.
    measures, entries = [], []
    for i, c in enumerate(TABLES[table]):
        nulls, too_long, size = "0L", "0L", "CAST(NULL AS INT)"
        if not c.nullable:
            nulls = f"nulls_{i}"
            measures.append(f"count_if({c.name} IS NULL) AS {nulls}")
        if c.max_length:
            too_long = f"long_{i}"
            # A text never has more UTF-16 units than UTF-8 bytes; most rows stop at the first test.
            measures.append(
                f"count_if(octet_length({c.name}) > {c.max_length}"
                f" AND {text_units_sql(f'rtrim({c.name})')} > {c.max_length}) AS {too_long}"
            )
        if c.is_text:
            size = f"greatest(1, size_{i})"
            measures.append(f"max({text_units_sql(c.name)}) AS size_{i}")
            size = f"IF(size_{i} IS NULL, NULL, {size})"
        entries.append(
            f"struct('{table}' AS table_name, '{c.name}' AS column_name, {nulls} AS null_violations,"
            f" {too_long} AS length_violations, {size} AS max_size)"
        )
    return measures, f"inline(array({', '.join(entries)}))"


def _column_report(table: str, df: DataFrame) -> DataFrame:
    measures, entries = _column_measures(table)
    return df.selectExpr(*measures).selectExpr(entries)


def observe_columns(table: str, df: DataFrame) -> tuple[DataFrame, Callable[[], DataFrame]]:
    """The rows, and the report that ``column_report`` gives of them once they have been written.

    Nulls, lengths and widths are counted while the rows pass by; no other pass is needed.
    """
    measures, entries = _column_measures(table)
    seen = Observation()
    observed = df.observe(seen, *[F.expr(m) for m in measures])

    def report() -> DataFrame:
        values = [(k, v) for k, v in seen.get.items()]
        types = ", ".join(f"{k} {'int' if k.startswith('size_') else 'bigint'}" for k, _ in values)
        return df.sparkSession.createDataFrame([tuple(v for _, v in values)], types).selectExpr(entries)

    return observed, report


def completeness(
    schemas: DataFrame, catalog: DataFrame, prefix: str = "", tool: str = TOOL
) -> DataFrame:
    """Whether each schema holds a whole repository, none, or a broken one.

    ``schemas`` has ``schema_name``; ``catalog`` has ``schema_name`` and ``table_name``. A
    schema with the version table must have all tables, one without it must have none.
    """
    expected = sorted(REPOSITORY_TABLES)
    size = len(expected)
    has = {t: F.coalesce(F.col(f"_has_{t}"), F.lit(0)) for t in expected}
    present = (
        catalog.where(F.col("table_name").isin(*[prefix + t for t in expected]))
        .groupBy("schema_name")
        .agg(
            *[
                F.max(F.when(F.col("table_name") == prefix + t, 1).otherwise(0)).alias(f"_has_{t}")
                for t in expected
            ]
        )
    )
    found = reduce(lambda a, b: a + b, has.values())
    versioned = has["migrator_version"] == 1
    broken = F.concat(
        F.lit(f"{tool} repository incomplete or corrupt. Repository contains ["),
        found.cast("string"),
        F.when(versioned, f"] tables instead of [{size}].").otherwise(
            "] tables instead of the expected amount of [0]."
        ),
    )
    status = (
        F.when(versioned & (found == size), "complete")
        .when(~versioned & (found == 0), "absent")
        .otherwise("corrupt")
    )
    corrupt = status == "corrupt"
    return schemas.join(present, "schema_name", "left").select(
        "schema_name",
        found.cast("bigint").alias("tables_found"),
        status.alias("status"),
        F.when(corrupt, -1).otherwise(0).alias("result_code"),
        F.when(corrupt, broken).alias("message"),
        F.concat_ws(",", *[F.when(has[t] == 0, prefix + t) for t in expected]).alias("missing"),
    )
