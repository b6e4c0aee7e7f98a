"""The log stream and the stored repository."""

import datetime as dt
import time
import uuid
from collections import Counter

import pytest

from pyspark.sql import functions as F

from ledgerloom.operators import changes
from ledgerloom.operators.select import state_select
from ledgerloom.plans.storage import create_file, subfolders
from ledgerloom.sources import log, ranges
from ledgerloom.sources.fixtures import view
from ledgerloom.sources.marks import HighWater
from ledgerloom.sources.repository import RefusedRows, Repository
from ledgerloom.sources.tables import LOOKUP_ORDER, REPOSITORY_TABLES, struct_type
from ledgerloom.streaming import log_stream as stream

NOW = dt.datetime(2030, 1, 1)
ENTRY = "event_id bigint, ts timestamp_ntz, message string"


def write(spark, folder, rows):
    spark.createDataFrame(rows, ENTRY).coalesce(1).write.mode("append").parquet(folder)


def at(minute):
    return dt.datetime(2024, 1, 1, 12, minute)


class TestStream:
    @pytest.fixture
    def paths(self, tmp_path):
        return {name: str(tmp_path / name) for name in ("source", "log", "checkpoint")}

    def run(self, spark, paths, key=None, files_per_batch=None):
        entries = stream.read_stream(
            spark, paths["source"], struct_type_of(spark), files_per_batch=files_per_batch
        )
        if key:
            entries = stream.without_repeats(entries, key, "ts", "10 minutes")
        stream.append_stream(entries, lambda df: df, paths["log"], paths["checkpoint"]).awaitTermination()
        return sorted(r.event_id for r in spark.read.parquet(paths["log"]).collect())

    def test_restart_adds_nothing_twice(self, spark, paths):
        write(spark, paths["source"], [(1, at(0), "a"), (2, at(1), "b")])
        assert self.run(spark, paths) == [1, 2]
        assert self.run(spark, paths) == [1, 2]
        # Very late entries are appended like all others: a plain append has no watermark.
        write(spark, paths["source"], [(3, at(2), "c"), (4, dt.datetime(2000, 1, 1), "d")])
        assert self.run(spark, paths) == [1, 2, 3, 4]

    def test_many_batches(self, spark, paths):
        for i in range(5):
            write(spark, paths["source"], [(i, at(i), "x")])
        assert self.run(spark, paths, files_per_batch=1) == [0, 1, 2, 3, 4]

    def test_repeats_are_dropped_across_batches(self, spark, paths):
        write(spark, paths["source"], [(1, at(0), "a"), (1, at(0), "a"), (2, at(1), "b")])
        assert self.run(spark, paths, ["event_id"]) == [1, 2]
        write(spark, paths["source"], [(2, at(2), "b"), (3, at(3), "c")])
        assert self.run(spark, paths, ["event_id"]) == [1, 2, 3]


def struct_type_of(spark):
    return spark.createDataFrame([], ENTRY).schema


def test_log_append_in_two_steps(spark, tmp_path):
    path = str(tmp_path / "log")
    entry = "migration_run_id int, message string"
    others = [f"NULL AS {n}" for n in struct_type("migration_log").names
              if n not in ("id", "created_at", "migration_run_id", "message", "log_level_id")]

    def entries(ids):
        rows = spark.createDataFrame([(i, f"m{i}") for i in ids], entry)
        return rows.selectExpr("*", "2 AS log_level_id", *others)

    empty = spark.createDataFrame([], struct_type("migration_log"))
    log.append_log(log.log_rows(entries(range(5)), empty, ["migration_run_id"], NOW), path)
    stored = spark.read.schema(struct_type("migration_log")).parquet(path)
    log.append_log(log.log_rows(entries(range(5, 8)), stored, ["migration_run_id"], NOW), path)
    stored = spark.read.schema(struct_type("migration_log")).parquet(path)
    rows = stored.collect()
    assert sorted(r.id for r in rows) == list(range(1, 9))
    assert {r.id for r in rows if r.migration_run_id >= 5} == {6, 7, 8}
    assert {r.created_at for r in rows} == {NOW}


class TestRepository:
    @pytest.fixture
    def repo(self, spark):
        return Repository(spark, f"ledger_{uuid.uuid4().hex}", prefix="app_", tool="Tool")

    def test_life_of_a_repository(self, spark, repo):
        assert repo.check().first().status == "absent"
        assert repo.check_create("1.0", "Spark", NOW) == (
            "1,Tool repository-tables with master data and new VersionId [1] successfully created"
        )
        assert repo.check().first().status == "complete"
        found = "1,Tool repository already exists. Using VersionId [1]."
        assert repo.check_create("1.0", "Spark", NOW) == found
        assert repo.check_create("1.1", "Spark", NOW) == (
            "2,Tool repository already exists. New VersionId [2] created."
        )
        assert repo.read("migrator_version").count() == 2
        counts = {t: repo.read(t).count() for t in REPOSITORY_TABLES}
        assert counts["migration_result"] == 6 and counts["migration"] == 0

        requests = spark.createDataFrame([(1, "Shop", "d")], "request_id int, name string, description string")
        repo.append("product", changes.get_or_create_products(requests, repo.read("product"), NOW).new_rows)
        again = changes.get_or_create_products(requests, repo.read("product"), NOW)
        assert again.results.first().message == "Product [Shop] with Id [1] found"

        repo.replace("product", repo.read("product").selectExpr("id", "upper(name) AS name", "description", "created_at"))
        assert [r.name for r in repo.read("product").collect()] == ["SHOP"]

        spark.sql(f"DROP TABLE {repo.name('migration')}")
        assert repo.check_create("1.0", "Spark", NOW) == (
            "-1,Tool repository incomplete or corrupt. Repository contains [9] tables instead of [10]."
        )

    def test_answers_stay_as_they_are(self, spark, repo):
        """Before and after the new rows are stored; also for runs, with and without repair."""
        repo.check_create("1.0", "Spark", NOW)
        names = spark.createDataFrame([(1, "A", None), (2, "A", None)], "request_id int, name string, description string")
        answer = changes.get_or_create_products(names, repo.read("product"), NOW)
        before = sorted(answer.results.collect())
        repo.append("product", answer.new_rows)
        assert sorted(answer.results.collect()) == before and answer.new_rows.count() == 1
        assert [r.message.rsplit(" ", 1)[1] for r in before] == ["created", "found"]
        keys = spark.createDataFrame([(1, "v", "Spark", "b")], "request_id int, repository_version string, repository_database_type string, created_by_version string")
        versions = changes.get_or_create_versions(keys, repo.read("migrator_version"), NOW)
        before = versions.results.collect()
        repo.append("migrator_version", versions.new_rows)
        assert versions.results.collect() == before
        columns = "request_id bigint, requested_at timestamp_ntz, product_id bigint, environment string, migration_run_mode_id smallint, migrator_version_id bigint, migration_result_id smallint, from_release_version string, to_release_version string, fix boolean"
        asked = [(i, at(i), 1, "DEV", 100, 1, 10, None, None, False) for i in (1, 2)]
        requests = spark.createDataFrame(asked, columns)
        runs = changes.admit_runs(requests, repo.read("migration_run"), repo.read("product"), repo.read("migrator_version"), NOW)
        before = sorted(runs.results.collect())
        repo.append("migration_run", runs.new_runs)
        assert sorted(runs.results.collect()) == before and [r.result_code for r in before] == [1, -1]
        fixed = repo.apply_runs(requests.withColumn("fix", F.lit(True)), NOW, "fix")
        got = sorted(fixed.collect())
        stored = {r.id: r for r in repo.read("migration_run").collect()}
        assert {r.id for r in got} == {2, 3} and set(stored) == {1, 2, 3}
        assert [stored[i].finished_at is None for i in (1, 2, 3)].count(True) == 1

    def test_repair_leaves_finished_runs_alone(self, spark, repo):
        repo.check_create("1.0", "Spark", NOW)
        repo.replace("migration_run", view(spark, "/root/testdata/sf0.001", "migration_run"))
        finished = spark.table(repo.name("migration_run"))
        files = set(finished.inputFiles())
        n_open, n = spark.table(repo.name("migration_run_open")).count(), repo.read("migration_run").count()
        keys = view(spark, "/root/testdata/sf0.001", "run_request").where("fix")
        expected = changes.repair_runs(repo.read("migration_run"), keys, NOW).where("finished_at IS NULL").count()
        repo.repair_runs(keys, NOW)
        left = spark.table(repo.name("migration_run_open")).count()
        assert left == expected < n_open and repo.read("migration_run").count() == n
        assert files <= set(spark.table(repo.name("migration_run")).inputFiles())
        repo.vacuum()
        assert repo.read("migration_run").count() == n
        assert len(subfolders(spark, f"{repo.location}/app_migration_run_open")) == 1
        repo.drop()
        assert subfolders(spark, repo.location) == [] and not repo.exists("product")

    def test_nothing_is_written_for_a_known_version(self, spark, repo):
        repo.check_create("1.0", "Spark", NOW)
        files = repo.read("migrator_version").inputFiles()
        for _ in range(2):
            repo.check_create("1.0", "Spark", NOW)
        spark.catalog.refreshTable(repo.name("migrator_version"))
        assert repo.read("migrator_version").inputFiles() == files

    def test_replaced_table_is_laid_out_for_lookups(self, spark, conf, repo):
        conf({"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "6"})
        repo.check_create("1.0", "Spark", NOW)
        rows = view(spark, "/root/testdata/sf0.001", "migration")
        repo.replace("migration", rows)
        stored = repo.read("migration")
        ranges = (
            stored.groupBy(F.input_file_name().alias("f"))
            .agg(F.min("product_id").alias("low"), F.max("product_id").alias("high"))
            .orderBy("low")
            .collect()
        )
        assert len(ranges) == 6
        assert all(a.high <= b.low for a, b in zip(ranges, ranges[1:]))
        key = (13, "1-URGENT", 100)
        expected = sorted(tuple(r) for r in state_select(rows, *key).select("id", "filename").collect())
        got = state_select(stored, *key)
        assert sorted(tuple(r) for r in got.select("id", "filename").collect()) == expected
        text = got._jdf.queryExecution().executedPlan().toString()
        assert "PushedFilters: [IsNotNull(product_id)" in text

    def test_large_table_is_laid_out_part_by_part(self, spark, conf, repo, monkeypatch):
        conf({"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "3"})
        monkeypatch.setattr(ranges, "SMALL_BYTES", 0)
        monkeypatch.setattr(ranges, "ROWS_AT_ONCE", 400)
        repo.check_create("1.0", "Spark", NOW)
        some = view(spark, "/root/testdata/sf0.001", "migration").orderBy("id").limit(1000)
        # One key with a third of the rows, null keys, and rows that are repeated.
        hot = some.limit(500).withColumns({"product_id": F.lit(7).cast("bigint"), "environment": F.lit("hot")})
        none = some.limit(9).withColumns({c: F.lit(None).cast(t) for c, t in some.dtypes if c in ("product_id", "environment")})
        rows = some.unionByName(hot).unionByName(none).unionByName(none)
        assert len(ranges.part_starts(rows, LOOKUP_ORDER["migration"])) == 3
        expected = Counter(map(str, rows.collect()))
        repo.replace("migration", rows)
        stored = repo.read("migration")
        assert Counter(map(str, stored.collect())) == expected
        key = F.struct(*LOOKUP_ORDER["migration"])
        files = stored.groupBy(F.input_file_name().alias("f")).agg(F.min(key).alias("low"), F.max(key).alias("high"))
        assert files.count() > 6
        assert repo._ids("migration").reserve(1) >= stored.select(F.max("id")).first()[0]
        late = files.crossJoin(files.toDF("g", "low2", "high2")).where("f <> g AND low < low2 AND high > low2")
        assert late.isEmpty()
        broken = rows.withColumn("filename", F.when(F.col("id") % 5 > 0, F.col("filename")))
        with pytest.raises(RefusedRows) as refused:
            repo.replace("migration", broken, checked=True)
        assert refused.value.columns["filename"][0] == broken.where("filename IS NULL").count() > 0
        assert Counter(map(str, repo.read("migration").collect())) == expected

    def test_replace_leaves_no_shuffle_files(self, spark, repo):
        def shuffled():
            disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
            return {name for name in disk.getAllBlocks().mkString(" ").split() if name.startswith("shuffle_")}

        repo.check_create("1.0", "Spark", NOW)
        rows, before = view(spark, "/root/testdata/sf0.001", "migration"), shuffled()
        repo.replace("migration", rows)
        until = time.time() + 5  # they are removed in the background
        while shuffled() - before and time.time() < until:
            time.sleep(0.1)
        assert shuffled() <= before

    def test_log_tables(self, repo):
        assert repo.check_create_log() == "1,Database logging infrastructure successfully created"
        assert repo.check_create_log() == "0,Database logging infrastructure already exists"
        assert repo.read("migration_event").count() == 12
        # The log alone is not a repository.
        assert repo.check().first().status == "absent"

    def test_too_long_text_is_refused(self, spark, repo):
        repo.check_create("1.0", "Spark", NOW)
        rows = spark.createDataFrame([(1, "x" * 101, None, NOW)], struct_type("product"))
        with pytest.raises(Exception, match="EXCEED_LIMIT_LENGTH|length limitation"):
            repo.append("product", rows)

    def test_two_prefixes_in_one_schema(self, spark):
        """Neither vacuum nor drop touches the tables of another prefix."""
        schema = f"ledger_{uuid.uuid4().hex}"
        a, b = Repository(spark, schema, prefix="a_"), Repository(spark, schema, prefix="b_")
        names = spark.createDataFrame([(1, "A", None)], "request_id int, name string, description string")
        for repo in (a, b):
            repo.check_create("1.0", "Spark", NOW)
            repo.apply_products(names, NOW)
        a.replace("product", a.read("product"))
        a.vacuum()
        assert [r.read("product").count() for r in (a, b)] == [1, 1] == [r.read("migrator_version").count() for r in (a, b)]
        a.drop()
        assert not a.exists("product") and b.read("product").count() == 1 and b.check().first().status == "complete"
        assert b.apply_products(names, NOW).first().message == "Product [A] with Id [1] found"
        b.drop()
        assert not spark.catalog.databaseExists(schema)


class Broken(Exception):
    pass


class TestBatches:
    """A batch applied again, as a whole or after a failure at any step, has the outcome of one."""

    COLUMNS = (
        "request_id bigint, requested_at timestamp_ntz, product_id bigint, environment string, migration_run_mode_id smallint,"
        " migrator_version_id bigint, migration_result_id smallint, from_release_version string, to_release_version string, fix boolean"
    )

    def repository(self, spark):
        repo = Repository(spark, f"ledger_{uuid.uuid4().hex}", prefix="app_")
        repo.check_create("1.0", "Spark", NOW)
        names = spark.createDataFrame([(i, f"P{i}", None) for i in range(1, 4)], "request_id int, name string, description string")
        repo.apply_products(names, NOW)
        repo.apply_runs(self.requests(spark, [(1, 1, False), (2, 2, False)]), NOW, "fix")
        return repo

    def requests(self, spark, rows):
        rows = [(i, at(i), product, "DEV", 100, 1, 10, None, None, fix) for i, product, fix in rows]
        return spark.createDataFrame(rows, self.COLUMNS)

    def state(self, repo):
        return {t: sorted(map(str, repo.read(t).collect())) for t in ("product", "migration_run")}

    # Product 1 is open and repaired twice, 2 is open, 3 is free.
    RUNS = [(11, 1, True), (12, 1, True), (13, 2, False), (14, 3, False), (15, 3, False), (16, 9, False)]
    NAMES = [(1, "P2"), (2, "Q"), (3, "Q"), (4, " ")]

    def names(self, spark, rows=NAMES):
        return spark.createDataFrame([(*r, None) for r in rows], "request_id int, name string, description string")

    @pytest.fixture(scope="class")
    def once(self, spark):
        """Answers and tables of runs applied once, and then also of products."""
        repo = self.repository(spark)
        runs = sorted(repo.apply_runs(self.requests(spark, self.RUNS), NOW, "fix").collect())
        after_runs = self.state(repo)
        products = sorted(repo.apply_products(self.names(spark), NOW).collect())
        return runs, after_runs, products, self.state(repo)

    def test_again_as_a_whole(self, spark, once):
        twice = self.repository(spark)
        runs, _, products, state = once
        expected = [products, runs]
        later = NOW + dt.timedelta(days=1)
        for now in (NOW, later):
            got = [sorted(twice.apply_products(self.names(spark), now, "b1").collect()),
                   sorted(twice.apply_runs(self.requests(spark, self.RUNS), now, "fix", "b2").collect())]
            assert got == expected and self.state(twice) == state
        # Another batch in between changes nothing about it, and it ends no run of that batch.
        twice.apply_runs(self.requests(spark, [(21, 3, True)]), NOW, "fix", "b3")
        before = self.state(twice)
        assert sorted(twice.apply_runs(self.requests(spark, self.RUNS), later, "fix", "b2").collect()) == expected[1]
        assert self.state(twice) == before

    def test_a_batch_that_grows(self, spark):
        repo = self.repository(spark)
        first = repo.apply_products(self.names(spark), NOW, "b/1").collect()
        grown = repo.apply_products(self.names(spark, [*self.NAMES, (5, "R")]), NOW, "b/1").collect()
        assert sorted(grown)[:4] == sorted(first) and sorted(grown)[4].message == "Product [R] with Id [5] successfully created"
        assert repo.read("product").count() == 5

    @pytest.mark.parametrize("step", ["_store", "append", "repair_runs", "_point", "_insert:0", "_insert:1", "_insert:2"])
    def test_again_after_a_failure(self, spark, monkeypatch, once, step):
        broken = self.repository(spark)
        requests = self.requests(spark, self.RUNS)
        name, _, n = step.partition(":")
        calls = []

        def fail(*args, **more):
            calls.append(1)
            if len(calls) > int(n or 0):
                raise Broken
            return original(*args, **more)

        original = getattr(broken, name)
        monkeypatch.setattr(broken, name, fail)
        with pytest.raises(Broken):
            broken.apply_runs(requests, NOW, "fix", "b")
        monkeypatch.undo()
        assert sorted(broken.apply_runs(requests, NOW + dt.timedelta(days=1), "fix", "b").collect()) == once[0]
        assert self.state(broken) == once[1]

    def test_the_next_batch_finishes_the_one_before(self, spark, monkeypatch):
        repo = self.repository(spark)
        monkeypatch.setattr(repo, "append", lambda *a: (_ for _ in ()).throw(Broken()))
        with pytest.raises(Broken):
            repo.apply_products(self.names(spark), NOW, "b1")
        monkeypatch.undo()
        answer = repo.apply_products(self.names(spark, [(1, "Q")]), NOW, "b2").first()
        assert answer.message == "Product [Q] with Id [4] found" and repo.read("product").count() == 4


class TestHighWater:
    def test_claims(self, spark, tmp_path):
        marks = HighWater(spark, str(tmp_path / "ids"))
        assert marks.top() is None and marks.reserve(3) == 0 and marks.reserve(2) == 3 and marks.top() == 5
        marks.raise_to(4)
        marks.raise_to(None)
        assert marks.top() == 5 and marks.reserve(0) == 5
        marks.raise_to(100)
        assert HighWater(spark, marks.folder).reserve(1) == 100
        assert len(list((tmp_path / "ids").glob("0*"))) <= 3

    def test_two_writers(self, spark, tmp_path, monkeypatch):
        """A writer whose range was taken between its look and its claim takes the next one."""
        first, second = (HighWater(spark, str(tmp_path / "ids")) for _ in range(2))
        look, taken = first.top, []

        def late():
            top = look()
            if not taken:
                taken.append(second.reserve(4))
            return top

        monkeypatch.setattr(first, "top", late)
        assert first.reserve(2) == 4 and taken == [0] and second.top() == 6

    def test_a_writer_that_failed(self, spark, tmp_path):
        marks = HighWater(spark, str(tmp_path / "ids"))
        marks.reserve(7)
        create_file(spark, f"{marks.folder}/{7:020d}", "")
        assert marks.reserve(1) == 8 and marks.top() == 9

    def test_log_is_not_read_for_an_append(self, spark):
        repo = Repository(spark, f"ledger_{uuid.uuid4().hex}")
        repo.check_create_log()
        sf = "/root/testdata/sf0.001"
        repo.replace("migration_log", view(spark, sf, "migration_log").where("created_at IS NOT NULL"))
        top, n = repo.read("migration_log").agg(F.max("id")).first()[0], repo.read("migration_log").count()
        scans = []
        original = repo.read
        repo.read = lambda table: scans.append(table) or original(table)
        entries = view(spark, sf, "log_entry")
        repo.append_log(entries, ["migration_run_id"], NOW)
        rows = log.log_rows(entries, 5, ["migration_run_id"], NOW)
        assert scans == [] and "migration_log" not in rows._jdf.queryExecution().optimizedPlan().toString()
        ids = [r.id for r in original("migration_log").where(F.col("id") > top).select("id").collect()]
        assert sorted(ids) == list(range(top + 1, top + 1 + entries.count())) and original("migration_log").count() == n + len(ids)
        repo.drop()
