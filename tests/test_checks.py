import pytest

from ledgerloom.operators import checks, select
from ledgerloom.sources import master
from ledgerloom.sources.tables import FOREIGN_KEYS, REPOSITORY_TABLES, TABLES, struct_type


def test_table_definitions():
    assert len(TABLES) == 12 and len(REPOSITORY_TABLES) == 10
    assert len(FOREIGN_KEYS) == 14
    assert len(TABLES["migration"]) == 29
    assert [c.name for c in TABLES["migration_history"]][2:] == [c.name for c in TABLES["migration"]][1:]
    assert len(select.STATE_COLUMNS) == 22


def test_master_data(spark):
    counts = {name: df.count() for name, df in master.dimensions(spark, "Tool").items()}
    assert counts == {
        "migration_run_mode": 3, "migration_operation": 3, "migration_result": 6,
        "migration_state": 3, "migration_event": 12,
    }
    events = master.dimension(spark, "migration_event", "Tool")
    assert events.where("id = 80").first().name == "ToolServiceStart"
    assert events.dtypes == [("id", "int"), ("name", "string"), ("description", "string")]


@pytest.mark.parametrize(
    "tables,status,message,missing",
    [
        (REPOSITORY_TABLES, "complete", None, 0),
        ((), "absent", None, 10),
        (("invoice",), "absent", None, 10),
        (
            tuple(t for t in REPOSITORY_TABLES if t != "product"),
            "corrupt",
            "T repository incomplete or corrupt. Repository contains [9] tables instead of [10].",
            1,
        ),
        (
            ("product", "migration"),
            "corrupt",
            "T repository incomplete or corrupt. Repository contains [2] tables instead of the expected amount of [0].",
            8,
        ),
    ],
)
def test_completeness(spark, tables, status, message, missing):
    schemas = spark.createDataFrame([("s",)], "schema_name string")
    catalog = spark.createDataFrame(
        [("s", "app_" + t) for t in tables] + [("other", "app_product")], "schema_name string, table_name string"
    )
    row = checks.completeness(schemas, catalog, "app_", "T").first()
    assert (row.status, row.message) == (status, message)
    assert row.result_code == (-1 if status == "corrupt" else 0)
    assert len([m for m in row.missing.split(",") if m]) == missing


def test_orphans_ignore_null_keys(spark):
    child = spark.createDataFrame([(1, 5), (2, 6), (3, None)], "id int, parent int")
    parent = spark.createDataFrame([(5,)], "id int")
    assert [r.id for r in checks.orphan_rows(child, "parent", parent).collect()] == [2]


def test_duplicate_keys(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (None, "c"), (None, "c")], "x int, y string")
    got = sorted(tuple(r) for r in checks.duplicate_keys(df, ["x", "y"]).collect() if r.x is not None)
    assert got == [(1, "a", 2)]


def test_column_report(spark):
    rows = [(1, "a" * 100, None), (2, "a" * 100 + "  ", "😀"), (3, "a" * 101, ""), (4, None, None)]
    schema = "id bigint, name string, description string"
    df = spark.createDataFrame(rows, schema).selectExpr("*", "CAST(NULL AS TIMESTAMP_NTZ) AS created_at")
    got = {r.column_name: tuple(r)[2:] for r in checks.column_report({"product": df}).collect()}
    assert got == {
        "id": (0, 0, None),
        "name": (1, 1, 102),
        "description": (0, 0, 2),
        "created_at": (4, 0, None),
    }


def test_column_report_of_an_empty_table(spark):
    empty = spark.createDataFrame([], struct_type("product"))
    got = checks.column_report({"product": empty}).collect()
    assert {tuple(r)[2:] for r in got} == {(0, 0, None)}


def test_decode_unknown_id(spark):
    df = spark.createDataFrame([(100,), (7,), (None,)], "migration_result_id smallint")
    got = select.decode(df, master.dimensions(spark), {"migration_result_id": "migration_result"}).collect()
    assert {tuple(r) for r in got} == {(100, "Ok"), (7, None), (None, None)}


def test_match_cardinality(spark):
    ledger = spark.createDataFrame([(1, "a"), (2, "b"), (3, "b")], "id int, k string")
    keys = spark.createDataFrame([("a",), ("b",), ("c",), ("a",)], "k string")
    got = {tuple(r) for r in select.match_cardinality(keys, ledger, ["k"]).collect()}
    assert got == {("a", 1, 1, "found"), ("b", 2, None, "ambiguous"), ("c", 0, None, "missing")}
