"""A stored ledger: tables of a catalog schema, created once, appended to or replaced."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.envelope import format_envelope
from ledgerloom.functions.values import moment
from ledgerloom.operators import changes, select
from ledgerloom.operators.checks import completeness, observe_columns
from ledgerloom.operators.joins import any_of, few_values, lookup
from ledgerloom.plans.storage import FREE_SHUFFLES, remove_folder, settings, stored, subfolders, written_tables
from ledgerloom.sources import log, ranges
from ledgerloom.sources.batches import RequestLedger
from ledgerloom.sources.marks import HighWater
from ledgerloom.sources.master import REPOSITORY_VERSION, TOOL, dimension, master_rows
from ledgerloom.sources.tables import (
    LOG_TABLES,
    LOOKUP_ORDER,
    REPOSITORY_TABLES,
    RUN_KEY,
    VERSION_KEY,
    ddl,
    struct_type,
    write_options,
)


# Open runs, which change, are kept apart from the finished ones, which don't.
_OPEN_RUNS = "migration_run_open"


def _now() -> dt.datetime:
    return dt.datetime.now(dt.UTC).replace(tzinfo=None)


class RefusedRows(ValueError):
    """Rows that break the rules of their table; ``columns``: nulls and too long texts by column."""

    def __init__(self, table: str, columns: dict[str, tuple[int, int]]):
        super().__init__(f"{table}: {columns}")
        self.columns = columns


class Repository:
    """Ledger tables in one schema. ``prefix`` comes before every table name.

    The tables lie below ``location``, by default the schema's folder in the warehouse, each in a
    folder with the prefix, so several repositories share a schema. A store without transactions
    cannot undo a half-done creation; the next check then reports the repository as incomplete.

    Batches have an identity: one that is applied again, also after a failure in between, gets the
    same answers and stores nothing twice. One writer at a time applies batches.
    """

    def __init__(
        self,
        spark: SparkSession,
        schema: str,
        prefix: str = "",
        location: str | None = None,
        tool: str = TOOL,
    ):
        self.spark = spark
        self.schema = schema
        self.prefix = prefix
        warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
        self.location = location or f"{warehouse}/{schema}.db"
        self.tool = tool

    def name(self, table: str) -> str:
        return f"`{self.schema}`.`{self.prefix}{table}`"

    def exists(self, table: str) -> bool:
        return self.spark.catalog.tableExists(self.name(table))

    def read(self, table: str) -> DataFrame:
        rows = self.spark.table(self.name(table))
        if table == "migration_run":
            return rows.union(self.spark.table(self.name(_OPEN_RUNS)))
        return rows

    def _ids(self, table: str) -> HighWater:
        return HighWater(self.spark, f"{self.location}/_ids/{self.prefix}{table}")

    def _requests(self, table: str) -> RequestLedger:
        return RequestLedger(self.spark, f"{self.location}/_requests/{self.prefix}{table}")

    def append(self, table: str, rows: DataFrame, written: bool = False) -> None:
        """Add rows; each file is sorted for lookups, without a shuffle. Ids after theirs are free.

        Runs are read once for each of their two tables, so they are written before, unless they are
        ``written`` already.
        """
        if table == "migration_run":
            with written_tables(self.spark):
                rows = rows if written else stored(rows, "new-runs")
                self._insert(table, rows.where("finished_at IS NOT NULL"))
                self._insert(_OPEN_RUNS, rows.where("finished_at IS NULL"))
        else:
            self._insert(table, rows)

    def _insert(self, stored_as: str, rows: DataFrame) -> None:
        table = "migration_run" if stored_as == _OPEN_RUNS else stored_as
        rows = rows.select(*struct_type(table).names)
        if table in LOOKUP_ORDER:
            rows = rows.sortWithinPartitions(*LOOKUP_ORDER[table])
        top, rows = self._observed(rows)
        rows.write.insertInto(self.name(stored_as))
        self._raise(table, top)

    def _observed(self, rows: DataFrame) -> tuple[Observation | None, DataFrame]:
        """The rows, and their highest id once they are written, without another pass."""
        if dict(rows.dtypes).get("id") != "bigint":
            return None, rows
        top = Observation()
        return top, rows.observe(top, F.max("id").alias("id"))

    def _raise(self, table: str, top: Observation | None) -> None:
        if top is not None:
            self._ids(table).raise_to(top.get["id"])

    def replace(self, table: str, rows: DataFrame, checked: bool = False) -> None:
        """Store a new version of a table that may be computed from the old one.

        With ``checked``, rows with nulls or texts that the table does not allow are refused: they are
        counted while they are written, and the table keeps its old version.

        The rows go to a new folder and the table is then pointed there, so the files being
        read are never overwritten and a failed write leaves the old version in place. Large
        tables are range-partitioned by their lookup order: a lookup skips, by the file
        statistics, all files but the few with its key. A table of many rows is first written as parts,
        each a range of keys, and laid out part by part, so that not all of it is shuffled at a time.
        Old folders stay until ``vacuum``.
        """
        parts = {table: rows}
        if table == "migration_run":
            parts = {table: rows.where("finished_at IS NOT NULL"), _OPEN_RUNS: rows.where("finished_at IS NULL")}
        folders = {stored_as: self._write(stored_as, part, checked) for stored_as, part in parts.items()}
        for stored_as, folder in folders.items():
            self._point(stored_as, folder)

    def _write(self, stored_as: str, rows: DataFrame, checked: bool = False) -> str:
        """Rows in a new folder, in lookup order."""
        with written_tables(self.spark), settings(self.spark, FREE_SHUFFLES):
            return self._write_in_order(stored_as, rows, checked)

    def _write_in_order(self, stored_as: str, rows: DataFrame, checked: bool) -> str:
        table = "migration_run" if stored_as == _OPEN_RUNS else stored_as
        folder = self._folder(stored_as)
        rows = rows.select(*struct_type(table).names)
        order = LOOKUP_ORDER.get(table)
        starts = ranges.part_starts(rows, order) if order else []
        if order and not starts:
            rows = ranges.in_order(rows, order)
        top, rows = self._observed(rows)
        report = None
        if checked:
            rows, report = observe_columns(table, rows)

        def write(some: DataFrame) -> None:
            some.write.mode("append").options(**write_options(table)).parquet(folder)

        parts = ranges.written_parts(rows, order, starts) if starts else []
        if not starts:
            write(rows)
        broken = report().where("null_violations > 0 OR length_violations > 0").collect() if report else []
        if broken:
            remove_folder(self.spark, folder)
            raise RefusedRows(table, {r.column_name: (r.null_violations, r.length_violations) for r in broken})
        for part in parts:
            write(ranges.in_order(self.spark.read.schema(rows.schema).parquet(part), order))
            remove_folder(self.spark, part)
        self._raise(table, top)
        return folder

    def _point(self, stored_as: str, folder: str) -> None:
        self.spark.sql(f"ALTER TABLE {self.name(stored_as)} SET LOCATION '{folder}'")
        self.spark.catalog.refreshTable(self.name(stored_as))

    def repair_runs(
        self, keys: DataFrame, now: dt.datetime | None = None, below: int | None = None, again: bool = False
    ) -> None:
        """End the open runs of the given keys, with ``below`` only those with a smaller id.

        Only open runs are read and written: those that stay open to a new folder, the ended ones
        behind the finished runs. ``keys`` must not depend on the run table. ``again`` leaves out
        runs that an earlier try, which failed in between, has put there already.
        """
        now = _now() if now is None else now
        runs = self.spark.table(self.name(_OPEN_RUNS))
        older = F.lit(True) if below is None else F.col("id") < below
        repaired = changes.repair_runs(runs.where(older), keys, now).unionByName(runs.where(~older))
        with written_tables(self.spark):
            repaired = stored(repaired, "repaired-runs")  # read three times, with the sample for the ranges
            still_open = self._write(_OPEN_RUNS, repaired.where("finished_at IS NULL"))
            ended = repaired.where("finished_at IS NOT NULL")
            if again:
                ended = self._missing(ended, self.spark.table(self.name("migration_run")))
            self._insert("migration_run", ended)
        self._point(_OPEN_RUNS, still_open)

    def _missing(self, rows: DataFrame, table: DataFrame) -> DataFrame:
        """The rows whose id is not in the stored table yet; written, because it is about to change."""
        ends = rows.agg(F.min("id"), F.max("id")).first()
        near = table.where(F.col("id").between(*ends)).select("id").distinct()
        return stored(lookup(rows, near, ["id"], "left_anti"), "missing-rows")

    def _store(self, table: str, outcome: DataFrame, again: bool) -> None:
        """Store what an outcome changes; ``again`` after a try that may have stored a part of it."""
        with written_tables(self.spark):
            self._store_parts(table, outcome, again)

    def _store_parts(self, table: str, outcome: DataFrame, again: bool) -> None:
        new = changes.new_rows_of(outcome)
        if table == "migration_run" and not outcome.where("repairs").isEmpty():
            first = new.agg(F.min("id").alias("id"), F.min("started_at").alias("at")).first()
            self.repair_runs(changes.repair_keys_of(outcome), first["at"], below=first["id"], again=again)
        if again:
            new = self._missing(new, self.read(table))
        if not new.isEmpty():
            self.append(table, new, True)

    def recover(self, table: str) -> None:
        """Store what batches before a failure have decided and not stored."""
        for note, outcome in self._requests(table).pending():
            if outcome is not None:
                self._store(table, outcome, again=True)
            self._requests(table).stored(note)

    def _apply(
        self, table: str, requests: DataFrame, batch: str | None, decide: Callable[[DataFrame, Callable], object]
    ) -> DataFrame:
        """Answers to a batch: those in the request ledger, and of the others by ``decide``."""
        ledger = self._requests(table)
        self.recover(table)
        batch = batch or uuid.uuid4().hex
        known = ledger.answered(batch)
        if known is not None:
            answered = known.select("request_id").distinct()
            requests = lookup(requests, answered, ["request_id"], "left_anti")
            if requests.isEmpty():
                return changes.results_of(known)
        written: list[tuple[str, DataFrame]] = []

        def store(outcome: DataFrame) -> DataFrame:
            written.append(ledger.write(batch, outcome))
            return written[0][1]

        with written_tables(self.spark):  # answers are read from the request ledger
            answer = decide(requests, store)
        [(note, outcome)] = written
        self._store(table, outcome, again=False)
        ledger.stored(note)
        return answer.results if known is None else changes.results_of(known).unionByName(answer.results)

    def apply_products(
        self, requests: DataFrame, now: dt.datetime | None = None, batch: str | None = None
    ) -> DataFrame:
        """Get or create products, store the new ones, and return the answers."""
        reserve = self._ids("product").reserve
        return self._apply(
            "product",
            requests,
            batch,
            lambda asked, store: changes.get_or_create_products(
                asked, self.read("product"), now, reserve=reserve, store=store
            ),
        )

    def apply_versions(
        self, requests: DataFrame, now: dt.datetime | None = None, batch: str | None = None
    ) -> DataFrame:
        """Get or create versions, store the new ones, and return the answers."""
        reserve = self._ids("migrator_version").reserve
        return self._apply(
            "migrator_version",
            requests,
            batch,
            lambda asked, store: changes.get_or_create_versions(
                asked, self.read("migrator_version"), now, self.tool, reserve=reserve, store=store
            ),
        )

    def apply_runs(
        self, requests: DataFrame, now: dt.datetime | None = None, fix: str | None = None, batch: str | None = None
    ) -> DataFrame:
        """Admit run requests, repair and store runs, and return the answers.

        Of the run table only the open runs are read.
        """
        now = _now() if now is None else now
        return self._apply(
            "migration_run",
            requests,
            batch,
            lambda asked, store: changes.admit_runs(
                asked, self.spark.table(self.name(_OPEN_RUNS)), self.read("product"), self.read("migrator_version"),
                now, fix, reserve=self._ids("migration_run").reserve, store=store,
            ),
        )

    def state_select_many(self, keys: DataFrame) -> DataFrame:
        """The state select for a table of keys, over the stored migrations.

        The products of a few keys go to the scan as a condition, which by statistics and Bloom
        filters leaves out all that can't have them; of many keys, the least and the largest product.
        What follows is the same in both cases, and shuffles no stored migrations.
        """
        migrations, asked = self.read("migration"), stored(keys.select(*RUN_KEY).distinct(), "asked-keys")
        products = few_values(asked, "product_id")
        if products is None:
            ends = asked.agg(F.min("product_id"), F.max("product_id")).first()
            migrations = migrations.where(F.col("product_id").between(*ends))
        else:
            migrations = migrations.where(any_of("product_id", products))
        return select.state_select_asked(migrations, asked)

    def append_log(self, entries: DataFrame, key: list[str], now: dt.datetime | None = None) -> None:
        """Append entries to the log with ids after its highest one, which is not read for it.

        ``key`` names columns that tell the entries apart.
        """
        base = self._ids("migration_log").reserve(entries.count())
        self.append("migration_log", log.log_rows(entries, base, key, now))

    def _stored_as(self) -> list[str]:
        """Own tables that exist."""
        return [t for t in (*REPOSITORY_TABLES, *LOG_TABLES, _OPEN_RUNS) if self.exists(t)]

    def vacuum(self) -> None:
        """Delete the folders that no table of this repository points to any more; no query may
        still read them."""
        for table in self._stored_as():
            described = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.name(table)}").where("col_name = 'Location'")
            current = described.first().data_type.rstrip("/").rsplit("/", 1)[-1]
            for folder in subfolders(self.spark, f"{self.location}/{self.prefix}{table}"):
                if folder.rstrip("/").rsplit("/", 1)[-1] != current:
                    remove_folder(self.spark, folder)

    def drop(self) -> None:
        """Remove the tables of this repository with their files, and the schema if nothing else is in it."""
        for table in self._stored_as():
            self.spark.sql(f"DROP TABLE {self.name(table)}")
            for kept in (f"{self.prefix}{table}", f"_ids/{self.prefix}{table}", f"_requests/{self.prefix}{table}"):
                remove_folder(self.spark, f"{self.location}/{kept}")
        if self.spark.catalog.databaseExists(self.schema) and not self.spark.catalog.listTables(self.schema):
            self.spark.sql(f"DROP SCHEMA `{self.schema}`")
            remove_folder(self.spark, self.location)

    def catalog(self) -> DataFrame:
        """The tables of the schema, as ``schema_name`` and ``table_name``."""
        names = []
        if self.spark.catalog.databaseExists(self.schema):
            names = [(self.schema, t.name) for t in self.spark.catalog.listTables(self.schema)]
        return self.spark.createDataFrame(names, "schema_name string, table_name string")

    def check(self) -> DataFrame:
        schema = self.spark.createDataFrame([(self.schema,)], "schema_name string")
        return completeness(schema, self.catalog(), self.prefix, self.tool)

    def check_create(
        self,
        created_by_version: str,
        database_type: str,
        now: dt.datetime | None = None,
        repository_version: str = REPOSITORY_VERSION,
    ) -> str:
        """Create the repository if absent and return the envelope with the version id."""
        state = self.check().first()
        if state.status == "corrupt":
            return f"{state.result_code},{state.message}"
        request = self.spark.createDataFrame(
            [(1, repository_version, database_type, created_by_version)],
            "request_id bigint, " + ", ".join(f"{k} string" for k in VERSION_KEY),
        )
        if state.status == "absent":
            self._create(REPOSITORY_TABLES)
            first = request.withColumnRenamed("request_id", "id")
            self.append("migrator_version", first.withColumn("created_at", moment(now)))
            # Result messages, here and below.
            return (
                f"1,{self.tool} repository-tables with master data and new VersionId [1]"
                " successfully created"
            )
        answer = self.apply_versions(request, now)
        line = format_envelope(F.col("result_code"), F.col("message"))
        return answer.select(line.alias("line")).first().line

    def check_create_log(self) -> str:
        """Create the log tables if absent; envelope code 1 if created, 0 if present."""
        if self.exists("migration_log"):
            return "0,Database logging infrastructure already exists"
        self._create(LOG_TABLES)
        return "1,Database logging infrastructure successfully created"

    def _folder(self, table: str) -> str:
        return f"{self.location}/{self.prefix}{table}/{uuid.uuid4().hex}"

    def _create(self, tables: tuple[str, ...]) -> None:
        self.spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{self.schema}` LOCATION '{self.location}'")
        for table in tables:
            for name in (table, _OPEN_RUNS) if table == "migration_run" else (table,):
                options = ", ".join(f"'{key}' = '{value}'" for key, value in write_options(table).items())
                self.spark.sql(
                    f"CREATE TABLE {self.name(name)} ({ddl(table)}) USING PARQUET"
                    + (f" OPTIONS ({options})" if options else "")
                    + f" LOCATION '{self._folder(name)}'"
                )
            if table in master_rows():
                self.append(table, dimension(self.spark, table, self.tool).coalesce(1))
