"""Changes to the ledger against one-by-one handling of the same requests."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import changes
from ledgerloom.sources.tables import struct_type

NOW = dt.datetime(2030, 1, 1)
EARLY = dt.datetime(2020, 1, 1)

REQUEST = (
    "request_id bigint, requested_at timestamp_ntz, product_id bigint, environment string,"
    " migration_run_mode_id smallint, migrator_version_id bigint, migration_result_id smallint,"
    " from_release_version string, to_release_version string, fix boolean"
)


def product_table(spark, rows):
    return spark.createDataFrame(
        [(i, name, None, EARLY) for i, name in rows], struct_type("product")
    )


def version_table(spark, rows):
    return spark.createDataFrame([(*row, EARLY) for row in rows], struct_type("migrator_version"))


def one_version(spark):
    return version_table(spark, [(1, "v", "Spark", "b")])


def run_table(spark, rows):
    """Rows of (id, key, finished)."""
    data = [
        (i, 1, p, m, 10, e, None, None, EARLY, EARLY if finished else None, None)
        for i, (p, e, m), finished in rows
    ]
    return spark.createDataFrame(data, struct_type("migration_run"))


def request_table(spark, rows):
    """Rows of (id, key, seconds, fix)."""
    data = [
        (i, EARLY + dt.timedelta(seconds=s), p, e, m, 1, 10, None, None, fix)
        for i, (p, e, m), s, fix in rows
    ]
    return spark.createDataFrame(data, REQUEST)


def names(spark, rows):
    return spark.createDataFrame(rows, "request_id bigint, name string, description string")


class TestProducts:
    def test_edge_cases(self, spark):
        requests = names(
            spark,
            [
                (1, None, "x"), (2, "", "x"), (3, "   ", "x"), (4, "A", "first"), (5, "A ", "x"),
                (6, "a", "x"), (7, "Known", "x"), (8, "A", "second"),
            ],
        )
        answer = changes.get_or_create_products(requests, product_table(spark, [(5, "Known")]), NOW)
        got = {r.request_id: r for r in answer.results.collect()}
        assert [got[i].result_code for i in (1, 2, 3)] == [-1, -1, -1]
        assert got[1].message == "Product with empty name [NULL] is not allowed!"
        assert got[3].message == "Product with empty name [   ] is not allowed!"
        assert (got[7].result_code, got[7].message) == (5, "Product [Known] with Id [5] found")
        assert got[4].message == f"Product [A] with Id [{got[4].id}] successfully created"
        assert got[8].message == f"Product [A] with Id [{got[4].id}] found"
        # Binary equality: three different new names, dense ids after 5.
        assert {got[i].id for i in (4, 5, 6)} == {6, 7, 8}
        new = {r.id: r for r in answer.new_rows.collect()}
        assert set(new) == {6, 7, 8}
        assert new[got[4].id].description == "first"
        assert new[got[4].id].created_at == NOW

    def test_ignoring_case(self, spark):
        requests = names(spark, [(1, "abc", None), (2, "ABC ", None), (3, "Known ", None)])
        answer = changes.get_or_create_products(
            requests, product_table(spark, [(5, "kNOWN")]), NOW, changes.ignoring_case
        )
        got = {r.request_id: r for r in answer.results.collect()}
        assert got[1].id == got[2].id == 6
        assert got[3].id == 5
        assert [r.name for r in answer.new_rows.collect()] == ["abc"]

    def test_name_stored_twice_is_an_error(self, spark):
        stored = product_table(spark, [(1, "A"), (2, "A")])
        answer = changes.get_or_create_products(names(spark, [(1, "A", None)]), stored, NOW)
        assert answer.results.first()[1:] == (-1, "Multiple [Product]-entries found for Product [A].", None)
        assert answer.new_rows.count() == 0

    def test_too_long_texts_are_refused(self, spark):
        rows = [(1, "n" * 101, None), (2, "ok", "d" * 1001), (3, "n" * 100 + "  ", None), (4, "ok", None)]
        answer = changes.get_or_create_products(names(spark, rows), product_table(spark, []), NOW)
        got = {r.request_id: (r.result_code, r.message) for r in answer.results.collect()}
        assert got[1] == (-1, "Product with too long [name] is not allowed!")
        assert got[2] == (-1, "Product with too long [description] is not allowed!")
        assert got[3][0] > 0 and "successfully created" in got[4][1]

    def test_empty_tables(self, spark):
        nothing = product_table(spark, [])
        assert changes.get_or_create_products(names(spark, []), nothing).results.count() == 0
        one = changes.get_or_create_products(names(spark, [(1, "A", None)]), nothing)
        assert one.results.first().id == 1
        created = one.new_rows.first().created_at
        assert abs(created - dt.datetime.now(dt.UTC).replace(tzinfo=None)) < dt.timedelta(minutes=5)


@pytest.mark.parametrize("seed", range(3))
def test_products_against_one_by_one(spark, seed):
    rng = random.Random(seed)
    stored = [(i, f"n{rng.randint(0, 9)}{i}") for i in range(1, 8)]
    pool = [n for _, n in stored] + [f"new{i}" for i in range(12)] + [None, "", "  "]
    requests = [(i, "hot" if rng.random() < 0.35 else rng.choice(pool), f"d{i}") for i in range(90)]

    table, expected = dict((n, i) for i, n in stored), {}
    for i, name, _ in requests:
        if not (name or "").rstrip(" "):
            expected[i] = "not allowed"
        elif name in table:
            expected[i] = "found"
        else:
            table[name], expected[i] = i, "created"

    answer = changes.get_or_create_products(names(spark, requests), product_table(spark, stored), NOW)
    results = answer.results.collect()
    assert len(results) == len(requests)
    assert all(expected[r.request_id] in r.message for r in results)
    ids = {}
    for r in results:
        name = requests[r.request_id][1]
        if r.id is not None:
            assert ids.setdefault(name, r.id) == r.id
    assert {n: i for n, i in ids.items() if (i, n) in stored} == {n: i for i, n in stored if n in ids}
    new = {r.name: r for r in answer.new_rows.collect()}
    assert sorted(r.id for r in new.values()) == list(range(8, 8 + len(new)))
    assert {n: r.id for n, r in new.items()} == {n: ids[n] for n in new}
    firsts = {requests[i][1]: requests[i][2] for i, what in expected.items() if what == "created"}
    assert {n: r.description for n, r in new.items()} == firsts


def test_versions(spark):
    stored = version_table(
        spark, [(1, "v1", "Spark", "b1"), (2, "v2", "Spark", "b1"), (3, "v2", "Spark", "b1")]
    )
    requests = spark.createDataFrame(
        [
            (1, "v1", "Spark", "b1"), (2, "v2", "Spark", "b1"), (3, "v3", "Spark", "b1"),
            (4, "v3", "Spark", "b1"), (5, None, "Spark", "b1"),
        ],
        "request_id bigint, repository_version string, repository_database_type string,"
        " created_by_version string",
    )
    answer = changes.get_or_create_versions(requests, stored, NOW, tool="Tool")
    got = {r.request_id: (r.result_code, r.message) for r in answer.results.collect()}
    entry = "RepositoryVersion [{}], RepositoryDatabaseType [Spark], ToolVersion [b1]."
    assert got == {
        1: (1, "Tool repository already exists. Using VersionId [1]."),
        2: (-1, "Multiple [MigratorVersion]-entries found for " + entry.format("v2")),
        3: (4, "Tool repository already exists. New VersionId [4] created."),
        4: (4, "Tool repository already exists. Using VersionId [4]."),
        5: (-1, "Incomplete version key: " + entry.format("NULL")),
    }
    assert [tuple(r) for r in answer.new_rows.collect()] == [(4, "v3", "Spark", "b1", NOW)]


class TestRepair:
    def test_only_open_runs_of_asked_keys_change(self, spark):
        key, other = (1, "DEV", 100), (2, "DEV", 100)
        runs = run_table(
            spark, [(1, key, False), (2, key, False), (3, key, True), (4, other, False)]
        )
        asked = request_table(spark, [(1, key, 0, True), (2, key, 1, True)])
        got = {r.id: r for r in changes.repair_runs(runs, asked, NOW).collect()}
        assert len(got) == 4
        assert [(got[i].migration_result_id, got[i].finished_at) for i in (1, 2, 3, 4)] == [
            (91, NOW), (91, NOW), (10, EARLY), (10, None),
        ]
        assert changes.repair_runs(runs, asked, NOW).schema.names == runs.schema.names


def one_by_one(runs, requests):
    """Handle requests in order, as separate calls would. Returns admitted ids and all runs."""
    table = [{"key": key, "open": not finished, "result": 10} for _, key, finished in runs]
    admitted = set()
    for request_id, key, _, fix in sorted(requests, key=lambda r: (r[2], r[0])):
        if None in key:
            continue
        if fix:
            for run in table:
                if run["key"] == key and run["open"]:
                    run.update(open=False, result=91)
        if any(run["key"] == key and run["open"] for run in table):
            continue
        admitted.add(request_id)
        table.append({"key": key, "open": True, "result": 10})
    return admitted, sorted((r["key"], r["open"], r["result"]) for r in table)


class TestAdmission:
    def test_messages(self, spark):
        busy, free, unknown = (1, "DEV", 100), (1, "QA", 100), (9, "DEV", 100)
        runs = run_table(spark, [(40, busy, False), (41, unknown, False)])
        requests = request_table(
            spark,
            [
                (1, busy, 0, None), (2, free, 1, None), (3, free, 0, None), (4, unknown, 0, None),
                (5, (1, None, 100), 0, None),
            ],
        )
        # A product stored twice gives one answer.
        products = product_table(spark, [(1, "Shop"), (1, "Shop")])
        answer = changes.admit_runs(requests, runs, products, one_version(spark), NOW)
        got = {r.request_id: r for r in answer.results.collect()}
        text = (
            "MigrationRun for Product [{}] with Id [{}] is currently in progress. Parallel migrations"
            " for the same product with MigrationRunModeId [Migrate=100] are not allowed!"
        )
        assert (got[1].result_code, got[1].message) == (-1, text.format("Shop", 1))
        assert (got[2].result_code, got[2].message) == (-1, text.format("Shop", 1))
        assert (got[4].result_code, got[4].message) == (
            -1, "MigrationRun with unknown [product_id] is not allowed!"
        )
        assert len(got) == answer.results.count() == 5
        assert got[5].message == "MigrationRun without [environment] is not allowed!"
        assert got[3].id == 42
        assert got[3].message == (
            f"MigrationRun with Id [{got[3].id}] successfully created for ProductId [1]"
        )
        new = answer.new_runs.collect()
        assert [(r.id, r.environment, r.started_at, r.finished_at) for r in new] == [
            (got[3].id, "QA", NOW, None)
        ]

    def test_empty_ledger_and_no_requests(self, spark):
        runs, products = run_table(spark, []), product_table(spark, [])
        nothing = changes.admit_runs(request_table(spark, []), runs, products, version_table(spark, []), NOW)
        assert nothing.results.count() == nothing.runs.count() == 0
        request = request_table(spark, [(7, (1, "DEV", 100), 0, False)])
        products = product_table(spark, [(1, "Shop")])
        one = changes.admit_runs(request, runs, products, one_version(spark), NOW, "fix")
        assert one.results.first().result_code == 1
        none = changes.admit_runs(request, runs, products, version_table(spark, []), NOW, "fix")
        assert none.results.first().message == "MigrationRun with unknown [migrator_version_id] is not allowed!"

    def test_refused_requests_do_not_hold_their_key(self, spark):
        """What the foreign keys and lengths of the run table keep out."""
        key, long = (1, "DEV", 100), (1, "e" * 101, 100)
        rows = [(1, (1, "DEV", 55), 0, None), (2, long, 0, None), (3, key, 1, None), (4, key, 2, None)]
        good = request_table(spark, rows)
        first = good.where("request_id = 3")
        early = first.withColumn("requested_at", F.lit(EARLY).cast("timestamp_ntz"))
        bad = [
            early.withColumn("request_id", F.lit(n)).withColumn(c, F.lit(v).cast(t))
            for n, c, v, t in [
                (10, "migration_result_id", 12, "smallint"), (11, "migrator_version_id", 777, "bigint"),
                (12, "from_release_version", "r" * 101, "string"), (13, "migration_result_id", None, "smallint"),
            ]
        ]
        requests = good
        for more in bad:
            requests = requests.unionByName(more)
        answer = changes.admit_runs(requests, run_table(spark, []), product_table(spark, [(1, "S")]), one_version(spark), NOW)
        got = {r.request_id: r.message for r in answer.results.collect()}
        text = "MigrationRun {} is not allowed!"
        assert got[1] == text.format("with unknown [migration_run_mode_id]")
        assert got[2] == text.format("with too long [environment]")
        assert got[10] == text.format("with unknown [migration_result_id]")
        assert got[11] == text.format("with unknown [migrator_version_id]")
        assert got[12] == text.format("with too long [from_release_version]")
        assert got[13] == text.format("without [migration_result_id]")
        assert "successfully created" in got[3] and "in progress" in got[4]
        assert [r.id for r in answer.new_runs.collect()] == [1]

    @pytest.mark.parametrize("seed", range(6))
    @pytest.mark.parametrize("with_fix", [True, False])
    def test_against_one_by_one(self, spark, seed, with_fix):
        rng = random.Random(seed)
        hot = (1, "DEV", 100)

        def key():
            if rng.random() < 0.35:
                return hot
            env = rng.choice(["DEV", "QA", "PROD", None if rng.random() < 0.3 else "DEV"])
            return (rng.randint(1, 4), env, rng.choice([10, 100]))

        runs = [(i, k, rng.random() < 0.6) for i, k in enumerate((key() for _ in range(30)), 1) if None not in k]
        requests = [
            (i, key(), rng.randint(0, 20), with_fix and rng.random() < 0.3) for i in range(100, 180)
        ]
        answer = changes.admit_runs(
            request_table(spark, requests),
            run_table(spark, runs),
            product_table(spark, [(i, f"p{i}") for i in range(1, 5)]),
            one_version(spark),
            NOW,
            "fix" if with_fix else None,
        )
        admitted, table = one_by_one(runs, requests)
        results = answer.results.collect()
        assert len(results) == len(requests)
        assert {r.request_id for r in results if r.result_code > 0} == admitted
        ids = [r.id for r in results if r.id is not None]
        assert len(set(ids)) == len(ids) and min(ids, default=999) > max(r[0] for r in runs)
        after = [
            ((r.product_id, r.environment, r.migration_run_mode_id), r.finished_at is None, r.migration_result_id)
            for r in answer.runs.collect()
        ]
        assert sorted(after) == table


def test_current_from_history(spark):
    schema = struct_type("migration_history")
    blank = {f.name: None for f in schema}

    def row(i, migration, name):
        values = {
            f.name: 0 if f.dataType.typeName() in ("integer", "long", "short") else
            False if f.dataType.typeName() == "boolean" else
            "" if f.dataType.typeName() == "string" else None
            for f in schema
        }
        return tuple({**blank, **values, "id": i, "migration_id": migration, "filename": name}.values())

    history = spark.createDataFrame([row(1, 7, "a"), row(3, 7, "c"), row(2, 7, "b"), row(4, 8, "d")], schema)
    current = changes.current_from_history(history)
    assert current.columns == struct_type("migration").names
    assert sorted((r.id, r.filename) for r in current.collect()) == [(7, "c"), (8, "d")]
    assert current.where(F.col("id") == 7).count() == 1
