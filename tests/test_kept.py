"""The kept current state, the numbered stream, and checks while rows are written."""

import datetime as dt
import os
import random
import uuid

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import changes, checks
from ledgerloom.sources.current import CurrentState
from ledgerloom.sources.fixtures import view
from ledgerloom.sources.repository import RefusedRows, Repository
from ledgerloom.sources.tables import struct_type
from ledgerloom.streaming import log_stream as stream

NOW = dt.datetime(2030, 1, 1)
SF = "/root/testdata/sf0.001"


class TestCurrentState:
    def history(self, spark, ids):
        """Rows (history id, migration id)."""
        rows = spark.createDataFrame(ids, "id bigint, migration_id bigint")
        others = [
            F.lit(None).cast(f.dataType).alias(f.name)
            for f in struct_type("migration_history").fields
            if f.name not in ("id", "migration_id", "filename", "product_id")
        ]
        return rows.select("*", F.concat(F.lit("v"), "id").alias("filename"), F.col("id").alias("product_id"), *others)

    def state(self, kept):
        return {r.id: r.filename for r in kept.read().collect()}

    def test_equal_to_a_full_recompute(self, spark, tmp_path):
        random.seed(1)
        kept = CurrentState(spark, str(tmp_path / "state"), buckets=8)
        assert kept.read().count() == 0 and kept.merge(self.history(spark, [])) == []
        seen = []
        for size in (50, 1, 200, 3):
            part = [(random.randrange(10_000), random.randrange(60)) for _ in range(size)]
            part = [p for i, p in enumerate(part) if p[0] not in {q[0] for q in seen + part[:i]}]
            seen += part
            kept.merge(self.history(spark, part))
            whole = changes.current_from_history(self.history(spark, seen))
            assert kept.read().columns == whole.columns
            assert sorted(map(str, kept.read().collect())) == sorted(map(str, whole.collect()))
            before = self.state(kept)
            kept.merge(self.history(spark, part))  # the same again changes nothing
            assert self.state(kept) == before
        kept.vacuum()
        assert self.state(kept) == before
        assert len([n for n in os.listdir(tmp_path / "state" / "manifests") if n[0] != "."]) == 1

    def test_other_buckets_are_not_touched(self, spark, tmp_path):
        kept = CurrentState(spark, str(tmp_path / "state"), buckets=16)
        kept.merge(self.history(spark, [(i, i) for i in range(200)]))
        files = set(kept.read().inputFiles())
        [bucket] = kept.merge(self.history(spark, [(1000, 7)]))
        after = set(kept.read().inputFiles())
        gone = files - after
        assert len(files & after) >= 15 and all(f"bucket={bucket}/" in f for f in gone | (after - files))
        assert self.state(kept)[7] == "v1000" and kept.read().count() == 200

    def test_a_failure_before_the_manifest(self, spark, tmp_path, monkeypatch):
        kept = CurrentState(spark, str(tmp_path / "state"), buckets=4)
        kept.merge(self.history(spark, [(1, 1), (2, 2)]))
        monkeypatch.setattr("ledgerloom.sources.current.write_file", lambda *a: (_ for _ in ()).throw(OSError()))
        with pytest.raises(OSError):
            kept.merge(self.history(spark, [(3, 1)]))
        monkeypatch.undo()
        assert self.state(kept) == {1: "v1", 2: "v2"}
        kept.merge(self.history(spark, [(3, 1)]))
        assert self.state(kept) == {1: "v3", 2: "v2"}

    def test_the_number_of_buckets_is_kept(self, spark, tmp_path):
        CurrentState(spark, str(tmp_path / "s"), buckets=4).merge(self.history(spark, [(1, 1)]))
        with pytest.raises(ValueError):
            CurrentState(spark, str(tmp_path / "s"), buckets=5).read()


class TestNumberedStream:
    ENTRY = "id bigint, message string"

    def run(self, spark, tmp_path):
        schema = spark.createDataFrame([], self.ENTRY).schema
        entries = stream.read_stream(spark, str(tmp_path / "source"), schema, files_per_batch=1)
        paths = [str(tmp_path / p) for p in ("log", "checkpoint")]
        stream.append_numbered_stream(entries, lambda df: df, ["message"], *paths).awaitTermination()
        return {r.message: r.id for r in spark.read.parquet(paths[0]).collect()}

    def write(self, spark, tmp_path, messages):
        rows = spark.createDataFrame([(0, m) for m in messages], self.ENTRY)
        rows.coalesce(1).write.mode("append").parquet(str(tmp_path / "source"))

    def test_ids_go_on_and_a_batch_keeps_its_own(self, spark, tmp_path):
        for i in range(3):
            self.write(spark, tmp_path, [f"m{i}{k}" for k in range(5 + i)])
        first = self.run(spark, tmp_path)
        assert sorted(first.values()) == list(range(1, 19))
        assert self.run(spark, tmp_path) == first
        # The last batch was written and not committed: it runs again.
        commits = tmp_path / "checkpoint" / "commits"
        for name in ("2", ".2.crc"):
            os.remove(commits / name)
        self.write(spark, tmp_path, ["late"])
        again = self.run(spark, tmp_path)
        assert again == {**first, "late": 19}

    def test_a_failure_between_note_and_rows(self, spark, tmp_path, monkeypatch):
        self.write(spark, tmp_path, ["a", "b"])
        monkeypatch.setattr(stream, "assign_ids", lambda *a, **k: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(Exception, match="lost"):
            self.run(spark, tmp_path)
        monkeypatch.undo()
        assert sorted(self.run(spark, tmp_path).values()) == [1, 2]


class TestChecksWhileWriting:
    def test_report_of_written_rows(self, spark, tmp_path):
        """The same counts as the report in a pass of its own, from one read of the rows."""
        rows = view(spark, SF, "migration_run")
        observed, report = checks.observe_columns("migration_run", rows)
        observed.write.parquet(str(tmp_path / "t"))
        assert sorted(map(str, report().collect())) == sorted(map(str, checks.column_report({"migration_run": rows}).collect()))
        assert "Exchange" not in observed._jdf.queryExecution().executedPlan().toString()
        empty, report = checks.observe_columns("product", spark.createDataFrame([], struct_type("product")))
        empty.write.parquet(str(tmp_path / "e"))
        assert {tuple(r)[2:] for r in report().collect()} == {(0, 0, None)}

    def test_broken_rows_are_refused(self, spark):
        repo = Repository(spark, f"ledger_{uuid.uuid4().hex}", prefix="app_")
        repo.check_create("1.0", "Spark", NOW)
        columns = "id bigint, name string, description string, created_at timestamp_ntz"
        good = spark.createDataFrame([(1, "A", None, NOW), (2, "B", "b", NOW)], columns)
        repo.replace("product", good, checked=True)
        bad = spark.createDataFrame([(3, None, None, NOW), (4, "x" * 101, "y" * 1001, None), (5, "ok", None, NOW)], columns)
        with pytest.raises(RefusedRows) as refused:
            repo.replace("product", bad, checked=True)
        assert refused.value.columns == {"name": (1, 1), "description": (0, 1), "created_at": (1, 0)}
        assert sorted(r.name for r in repo.read("product").collect()) == ["A", "B"]
        names = spark.createDataFrame([(1, "C", None)], "request_id int, name string, description string")
        assert repo.apply_products(names, NOW).first().id == 3  # the ids of refused rows stay free
        repo.drop()
