"""Streams that admit runs and count the log, and lookups that leave out files."""

import datetime as dt
import os
import uuid
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import changes, select
from ledgerloom.operators.joins import any_of, few_values, with_keys
from ledgerloom.plans.storage import stored, written_tables
from ledgerloom.sources import log, master, repository
from ledgerloom.sources.fixtures import view
from ledgerloom.sources.repository import Repository
from ledgerloom.sources.tables import RUN_KEY, TABLES
from ledgerloom.streaming import live
from ledgerloom.streaming import log_stream as stream

SF = "/root/testdata/sf0.001"
NOW = dt.datetime(2030, 1, 2, 3, 4, 5)


@pytest.fixture
def repo(spark):
    made = Repository(spark, f"live_{uuid.uuid4().hex}", prefix="app_")
    made.check_create("1.0", "Spark", NOW)
    yield made
    made.drop()


def add(source, rows):
    rows.coalesce(1).write.mode("append").parquet(source)


def uncommit(checkpoint, number):
    """As if the process had ended before a micro-batch was committed."""
    for name in (f"{number}", f".{number}.crc"):
        os.remove(checkpoint / "commits" / name)


class TestAdmitStream:
    def tables(self, spark, repo):
        for table in ("product", "migrator_version", "migration_run"):
            repo.replace(table, view(spark, SF, table))

    def start(self, spark, repo, tmp_path, requests):
        source = stream.read_stream(spark, str(tmp_path / "source"), requests.schema)
        paths = [str(tmp_path / p) for p in ("answers", "checkpoint")]
        live.admit_stream(repo, source, "s", *paths, NOW, "fix").awaitTermination()
        return {r.request_id: (r.result_code, r.message) for r in spark.read.parquet(paths[0]).collect()}

    def test_a_batch_that_runs_again_answers_the_same(self, spark, repo, tmp_path):
        self.tables(spark, repo)
        requests = view(spark, SF, "run_request")
        middle = requests.agg(F.percentile_approx("request_id", 0.5)).first()[0]
        for part in (F.col("request_id") <= middle, F.col("request_id") > middle):
            add(str(tmp_path / "source"), requests.where(part))
            answers = self.start(spark, repo, tmp_path, requests)
        runs = Counter(map(str, repo.read("migration_run").collect()))
        assert len(answers) == requests.count()
        uncommit(tmp_path / "checkpoint", 1)
        assert self.start(spark, repo, tmp_path, requests) == answers
        assert Counter(map(str, repo.read("migration_run").collect())) == runs

    def test_one_open_run_per_key(self, spark, repo, tmp_path):
        """A key stays held over micro-batches until a repair; other batches count as well."""
        self.tables(spark, repo)
        free = view(spark, SF, "run_request").where("product_id > 0 AND environment IS NOT NULL")
        some = free.join(view(spark, SF, "migration_run"), ["product_id"], "left_anti").limit(1).first()
        one = (some or free.first()).asDict() | {
            "migration_run_mode_id": 100, "migration_result_id": 10, "environment": "live", "from_release_version": None,
        }

        def ask(number, fix):
            return spark.createDataFrame([one | {"request_id": number, "fix": fix}], free.schema)

        codes = []
        for number, fix in ((1, False), (2, False), (3, True), (4, False)):
            add(str(tmp_path / "source"), ask(number, fix))
            codes.append(self.start(spark, repo, tmp_path, free)[number][0])
        assert codes[0] > 0 and codes[1] == codes[3] == -1 and codes[2] == codes[0] + 1
        assert repo.apply_runs(ask(5, False), NOW, "fix").first().result_code == -1
        ends = repo.read("migration_run").where("environment = 'live'").orderBy("id").collect()
        assert [(r.id, r.finished_at) for r in ends] == [(codes[0], NOW), (codes[2], None)]

    def test_admission_reads_open_runs_only(self, spark, repo, monkeypatch):
        self.tables(spark, repo)
        read = []
        admit = changes.admit_runs
        monkeypatch.setattr(changes, "admit_runs", lambda asked, runs, *a, **k: read.append(runs) or admit(asked, runs, *a, **k))
        repo.apply_runs(view(spark, SF, "run_request"), NOW)
        [runs] = read
        assert {name.split("/app_")[1].split("/")[0] for name in runs.inputFiles()} == {"migration_run_open"}


class TestLogActivity:
    DAY = dt.timedelta(days=1)

    def rows(self, spark, times):
        """Log rows of level 2 and event 10, one per time."""
        names = [f.name for f in log.log_schema()]
        at = {"id": 1, "log_level_id": 2, "migration_event_id": 10}
        return spark.createDataFrame([tuple((at | {"created_at": t}).get(n) for n in names) for t in times], log.log_schema())

    def counts(self, spark, activity):
        return {r.hour: (r.n_entries, r.n_late) for r in activity.read(master.dimensions(spark)).collect()}

    def test_late_entries_count_and_a_batch_counts_once(self, spark, tmp_path):
        activity = live.LogActivity(spark, str(tmp_path / "a"), self.DAY)
        assert self.counts(spark, activity) == {}
        day = dt.datetime(2024, 3, 31, 2, 30)  # an hour that some zones skip
        first = self.rows(spark, [day, day + dt.timedelta(minutes=29), None])
        second = self.rows(spark, [day - self.DAY, day - self.DAY + dt.timedelta(minutes=29), None])
        activity.add(first, 0)
        for _ in range(2):
            activity.add(second, 1)
        hour = day.replace(minute=0)
        assert self.counts(spark, activity) == {hour: (2, 0), hour - self.DAY: (2, 1), None: (2, 0)}
        names = {(r.migration_event_name, r.run_mode_name) for r in activity.read(master.dimensions(spark)).collect()}
        assert len(names) == 1 and None not in {n for n, _ in names}

    def test_without_times_and_without_rows(self, spark, tmp_path):
        activity = live.LogActivity(spark, str(tmp_path / "a"), self.DAY)
        activity.add(self.rows(spark, []), 0)
        activity.add(self.rows(spark, [None, None]), 1)
        assert self.counts(spark, activity) == {None: (2, 0)}

    @pytest.mark.parametrize("merge_every", [1, 2, 100])
    def test_adding_up_changes_nothing(self, spark, tmp_path, merge_every):
        activity = live.LogActivity(spark, str(tmp_path / "a"), self.DAY, merge_every)
        start = dt.datetime(2024, 1, 1)
        for number in range(5):
            activity.add(self.rows(spark, [start + dt.timedelta(hours=number // 2)] * (number + 1)), number)
            activity.vacuum()
        hours = {0: (3, 0), 1: (7, 0), 2: (5, 0)}
        expected = {start + dt.timedelta(hours=h): n for h, n in hours.items()}
        assert self.counts(spark, activity) == expected
        activity.add(self.rows(spark, [start + dt.timedelta(hours=2)] * 5), 4)  # again, after it was added up
        assert self.counts(spark, activity) == expected
        left = len(os.listdir(tmp_path / "a" / "counts"))
        assert left <= max(merge_every, 2)

    def test_a_failure_before_the_note(self, spark, tmp_path, monkeypatch):
        activity = live.LogActivity(spark, str(tmp_path / "a"), self.DAY)
        monkeypatch.setattr(live, "write_file", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        rows = self.rows(spark, [dt.datetime(2024, 1, 1)])
        with pytest.raises(OSError, match="lost"):
            activity.add(rows, 0)
        assert self.counts(spark, activity) == {}
        monkeypatch.undo()
        activity.add(rows, 0)
        assert self.counts(spark, activity) == {dt.datetime(2024, 1, 1): (1, 0)}

    def test_stream_goes_on_and_runs_again(self, spark, tmp_path):
        source, checkpoint = tmp_path / "source", tmp_path / "checkpoint"
        activity = live.LogActivity(spark, str(tmp_path / "a"), self.DAY)

        def run():
            entries = stream.read_stream(spark, str(source), log.log_schema())
            activity.start(entries, lambda df: df, str(checkpoint)).awaitTermination()
            return self.counts(spark, activity)

        hour = dt.datetime(2024, 1, 5)
        add(str(source), self.rows(spark, [hour]))
        assert run() == {hour: (1, 0)}
        add(str(source), self.rows(spark, [hour, hour - 2 * self.DAY]))
        both = {hour: (2, 0), hour - 2 * self.DAY: (1, 1)}
        assert run() == both
        uncommit(checkpoint, 1)
        assert run() == both


class TestPrunedSelect:
    def rows_read(self, df):
        """Rows that come out of the scans of a plan."""
        df.collect()
        read, todo = 0, [df._jdf.queryExecution().executedPlan()]
        while todo:
            node = todo.pop()
            kind = node.getClass().getSimpleName()
            if kind == "AdaptiveSparkPlanExec":
                todo.append(node.executedPlan())
                continue
            if kind.endswith("QueryStageExec"):
                todo.append(node.plan())
                continue
            if kind == "FileSourceScanExec":
                read += node.metrics().apply("numOutputRows").value()
            todo += [node.children().apply(i) for i in range(node.children().size())]
        return read

    def test_files_without_the_asked_products_are_left_out(self, spark, repo):
        """Files that overlap in their products, as many appends leave them."""
        limits = {c.name: c.max_length for c in TABLES["migration"] if c.max_length}
        fitting = {n: F.left(F.col(n), F.lit(limit)) for n, limit in limits.items()}
        migrations = view(spark, SF, "migration").withColumns(fitting).cache()
        ids = [r[0] for r in migrations.select("product_id").distinct().orderBy("product_id").collect()]
        for part in range(12):
            repo.append("migration", migrations.where(F.pmod(F.xxhash64("product_id"), F.lit(12)) == part).coalesce(1))
        whole = migrations.count()
        keys = migrations.where(F.col("product_id") == ids[len(ids) // 2])
        found = repo.state_select_many(keys)
        got = Counter(map(str, found.collect()))
        assert got == Counter(map(str, select.state_select_many(migrations, keys).collect())) and got
        assert self.rows_read(found) < whole / 4
        migrations.unpersist()

    @pytest.mark.parametrize("few", [0, 3, 100])
    def test_same_rows_however_many_keys(self, spark, repo, few, monkeypatch):
        migrations = view(spark, SF, "migration")
        repo.replace("migration", migrations)
        monkeypatch.setattr(repository, "few_values", lambda asked, column: few_values(asked, column, few))
        keys = view(spark, SF, "migration_run").where("finished_at IS NULL").limit(20)
        keys = keys.unionByName(keys.withColumn("environment", F.lit(None).cast("string")))
        for asked in (keys, keys.where("false")):
            want = Counter(map(str, select.state_select_many(migrations, asked).collect()))
            assert Counter(map(str, repo.state_select_many(asked).collect())) == want

    @pytest.mark.parametrize("few", [0, 10_000])
    def test_stored_migrations_are_not_shuffled(self, spark, conf, repo, few, monkeypatch):
        """Whether the asked keys or a filter of them go to the tasks."""
        conf({"spark.sql.autoBroadcastJoinThreshold": "20k" if few == 0 else "-1"})
        monkeypatch.setattr(select, "with_keys", lambda rows, asked, on: with_keys(rows, asked, on, few))
        migrations = view(spark, SF, "migration")
        repo.replace("migration", migrations)
        keys = view(spark, SF, "migration_run").where("finished_at IS NULL")
        found = repo.state_select_many(keys)
        assert "Exchange hashpartitioning" not in found._jdf.queryExecution().executedPlan().toString()
        got = Counter(map(str, found.collect()))
        want = migrations.join(keys.select(*RUN_KEY).distinct(), RUN_KEY, "left_semi").select(*found.columns)
        assert got == Counter(map(str, want.collect())) and got

    def test_few_values(self, spark):
        rows = spark.createDataFrame([(1,), (None,), (2,), (2,)], "k int")
        assert sorted(few_values(rows, "k", 2)) == [1, 2] and few_values(rows, "k", 1) is None
        for n in range(9):
            assert spark.range(20).where(any_of("id", list(range(n)))).count() == n


class TestWrittenTables:
    def written(self, spark):
        folder = spark.conf.get("spark.checkpoint.dir").removeprefix("file://").removeprefix("file:")
        return set(os.listdir(folder))

    def test_scopes_remove_their_own_folders(self, spark):
        before = self.written(spark)
        outside = stored(spark.range(3), "outside")
        with written_tables(spark):
            outer = stored(spark.range(5), "outer")
            with pytest.raises(OSError, match="lost"), written_tables(spark):
                stored(spark.range(7), "inner")
                raise OSError("lost")
            assert {n.split("-")[0] for n in self.written(spark) - before} == {"outside", "outer"}
            assert outer.count() == 5
        assert {n.split("-")[0] for n in self.written(spark) - before} == {"outside"}
        assert outside.count() == 3

    def test_batches_of_a_repository_leave_no_folder(self, spark, repo):
        TestAdmitStream().tables(spark, repo)
        before = self.written(spark)
        answers = repo.apply_runs(view(spark, SF, "run_request"), NOW, "fix", batch="b")
        names = spark.createDataFrame([(1, "new", None)], "request_id int, name string, description string")
        products = repo.apply_products(names, NOW)
        assert self.written(spark) == before
        assert answers.count() == view(spark, SF, "run_request").count() and products.first().result_code > 0

    def test_a_batch_writes_its_runs_once_and_joins_the_open_ones_once(self, spark, repo, monkeypatch):
        """New runs are read from the outcome; open runs, joined with the keys of repairs, are written."""
        TestAdmitStream().tables(spark, repo)
        names = []
        monkeypatch.setattr(repository, "stored", lambda rows, name: names.append(name) or stored(rows, name))
        runs = {r.id for r in repo.read("migration_run").select("id").collect()}
        answers = repo.apply_runs(view(spark, SF, "run_request"), NOW, "fix").where("result_code > 0")
        assert names == ["repaired-runs"]
        entered = {r.id for r in answers.collect()}
        assert entered and {r.id for r in repo.read("migration_run").select("id").collect()} == runs | entered
