"""The registered queries: every operator over ledger views of the driver's tables."""

from __future__ import annotations

import datetime as dt
import functools
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions import values as V
from ledgerloom.functions.envelope import format_envelope, parse_envelope
from ledgerloom.functions.scripts import split_blocks
from ledgerloom.operators import changes, checks, parameters, scripts, select
from ledgerloom.plans.storage import new_folder, remove_folder, stored
from ledgerloom.sources import fixtures, log, master
from ledgerloom.sources.current import CurrentState
from ledgerloom.sources.fixtures import view
from ledgerloom.sources.repository import Repository
from ledgerloom.sources.tables import TABLES, VERSION_KEY
from ledgerloom.streaming import live
from ledgerloom.streaming import log_stream as stream

NOW = dt.datetime(2030, 1, 2, 3, 4, 5)
SETTINGS_TAG = "Settings"

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _ledger(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """All twelve ledger tables: dimensions from master data, the rest from the views."""
    dims = master.dimensions(spark)
    return {t: dims[t] if t in dims else view(spark, sf, t) for t in TABLES}


# --- reading -----------------------------------------------------------------------------


@query
def state_select(spark: SparkSession, sf: str) -> DataFrame:
    return select.state_select(view(spark, sf, "migration"), 7, "1-URGENT", master.MODE_MIGRATE)


@query
def state_select_many(spark: SparkSession, sf: str) -> DataFrame:
    open_runs = view(spark, sf, "migration_run").where("finished_at IS NULL")
    return select.state_select_many(view(spark, sf, "migration"), open_runs)


@query
def lookup_cardinality(spark: SparkSession, sf: str) -> DataFrame:
    requests, versions = view(spark, sf, "version_request"), view(spark, sf, "migrator_version")
    return select.match_cardinality(requests, versions, VERSION_KEY)


@query
def decode_dimensions(spark: SparkSession, sf: str) -> DataFrame:
    rows = view(spark, sf, "migration").select(
        "id", "file_up_hash", *select.MIGRATION_DIMENSIONS
    )
    return select.decode(rows, master.dimensions(spark), select.MIGRATION_DIMENSIONS)


@query
def decode_log(spark: SparkSession, sf: str) -> DataFrame:
    rows = view(spark, sf, "migration_log").select("id", "log_level_id", *select.LOG_DIMENSIONS)
    return select.decode(rows, master.dimensions(spark), select.LOG_DIMENSIONS)


@query
def run_summary(spark: SparkSession, sf: str) -> DataFrame:
    return select.run_summary(view(spark, sf, "migration_run"))


@query
def run_durations(spark: SparkSession, sf: str) -> DataFrame:
    runs = select.with_duration(view(spark, sf, "migration_run"))
    return runs.select("id", "started_at", "finished_at", "duration_in_ms")


@query
def state_summary(spark: SparkSession, sf: str) -> DataFrame:
    return select.state_summary(view(spark, sf, "migration"))


@query
def block_progress(spark: SparkSession, sf: str) -> DataFrame:
    return select.block_progress(view(spark, sf, "migration"))


# --- checks ------------------------------------------------------------------------------


@query
def fk_orphans(spark: SparkSession, sf: str) -> DataFrame:
    return checks.foreign_key_violations(_ledger(spark, sf))


@query
def fk_orphan_rows(spark: SparkSession, sf: str) -> DataFrame:
    runs, versions = view(spark, sf, "migration_run"), view(spark, sf, "migrator_version")
    orphans = checks.orphan_rows(runs, "migrator_version_id", versions)
    return orphans.select("id", "migrator_version_id", "started_at")


@query
def pk_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    return checks.key_violations(_ledger(spark, sf))


@query
def null_length_report(spark: SparkSession, sf: str) -> DataFrame:
    return checks.column_report(_ledger(spark, sf))


@query
def null_length_on_write(spark: SparkSession, sf: str) -> DataFrame:
    """The same report of all tables, made while they are written."""
    reports = []
    for table, rows in _ledger(spark, sf).items():
        observed, report = checks.observe_columns(table, rows)
        folder = new_folder(spark, table)
        observed.write.parquet(folder)
        remove_folder(spark, folder)
        reports.append(report())
    return functools.reduce(DataFrame.union, reports)


@query
def completeness(spark: SparkSession, sf: str) -> DataFrame:
    return checks.completeness(view(spark, sf, "catalog_schema"), view(spark, sf, "catalog_table"))


# --- changes -----------------------------------------------------------------------------


@query
def product_get_or_create(spark: SparkSession, sf: str) -> DataFrame:
    requests, products = view(spark, sf, "product_request"), view(spark, sf, "product")
    return changes.get_or_create_products(requests, products, NOW).results


@query
def product_new_rows(spark: SparkSession, sf: str) -> DataFrame:
    requests, products = view(spark, sf, "product_request"), view(spark, sf, "product")
    return changes.get_or_create_products(requests, products, NOW).new_rows


@query
def version_get_or_create(spark: SparkSession, sf: str) -> DataFrame:
    requests, versions = view(spark, sf, "version_request"), view(spark, sf, "migrator_version")
    return changes.get_or_create_versions(requests, versions, NOW).results


@query
def run_repair(spark: SparkSession, sf: str) -> DataFrame:
    asked = view(spark, sf, "run_request").where("fix")
    return changes.repair_runs(view(spark, sf, "migration_run"), asked, NOW)


def _admit(spark: SparkSession, sf: str, fix: str | None = None) -> changes.Admission:
    return changes.admit_runs(
        view(spark, sf, "run_request"),
        view(spark, sf, "migration_run"),
        view(spark, sf, "product"),
        view(spark, sf, "migrator_version"),
        NOW,
        fix,
    )


@query
def run_admission(spark: SparkSession, sf: str) -> DataFrame:
    return _admit(spark, sf).results


@query
def run_insert(spark: SparkSession, sf: str) -> DataFrame:
    return _admit(spark, sf, "fix").results


@query
def run_ledger_after_insert(spark: SparkSession, sf: str) -> DataFrame:
    return _admit(spark, sf, "fix").runs


@query
def current_from_history(spark: SparkSession, sf: str) -> DataFrame:
    return changes.current_from_history(view(spark, sf, "migration_history"))


@query
def current_kept_up_to_date(spark: SparkSession, sf: str) -> DataFrame:
    """The kept state after the history came in three parts, the oldest one last and one twice."""
    history = view(spark, sf, "migration_history")
    year = F.year("started_at")
    state = CurrentState(spark, new_folder(spark, "current"), buckets=32)
    newest = history.where(year >= 1997)
    for part in (newest, history.where((year >= 1994) & (year < 1997)), newest, history.where(year < 1994)):
        state.merge(part)
    return state.read()


# --- values ------------------------------------------------------------------------------


@query
def envelope_parse(spark: SparkSession, sf: str) -> DataFrame:
    lines = view(spark, sf, "result_line")
    return lines.select("event_id", parse_envelope(F.col("line")).alias("e")).select("event_id", "e.*")


@query
def envelope_format(spark: SparkSession, sf: str) -> DataFrame:
    results = product_get_or_create(spark, sf)
    line = format_envelope(F.col("result_code"), F.col("message"))
    return results.select("request_id", line.alias("line"))


@query
def date_floor(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, "old_date").select("o_orderkey", V.floor_date(F.col("moved")).alias("moved"))


@query
def typed_cast(spark: SparkSession, sf: str) -> DataFrame:
    types = {"user_text": "int", "k_text": "byte", "id_text": "short", "flag_text": "bool"}
    return V.bind_columns(view(spark, sf, "event_text"), types)


@query
def parameter_binding(spark: SparkSession, sf: str) -> DataFrame:
    return parameters.bind_parameters(view(spark, sf, "parameter"))


@query
def parameter_types(spark: SparkSession, sf: str) -> DataFrame:
    return parameters.bind_parameters(view(spark, sf, "typed_parameter"))


# --- scripts -----------------------------------------------------------------------------


@query
def template_render(spark: SparkSession, sf: str) -> DataFrame:
    keys = {"SchemaName": "schema_name", "TableBaseName": "table_base_name"}
    templates, config = view(spark, sf, "template"), view(spark, sf, "template_config")
    return scripts.render_templates(templates, config, ["target_group_alias"], keys)


@query
def script_blocks(spark: SparkSession, sf: str) -> DataFrame:
    files = view(spark, sf, "script_with_settings").select("doc_id", "content")
    return scripts.script_blocks(files)


@query
def script_marked_blocks(spark: SparkSession, sf: str) -> DataFrame:
    """Blocks of scripts with nested comments, and with marks in literals, names and line comments."""
    return scripts.script_blocks(view(spark, sf, "script_marked"))


@query
def script_block_counts(spark: SparkSession, sf: str) -> DataFrame:
    return scripts.block_counts(view(spark, sf, "script"))


@query
def script_hash(spark: SparkSession, sf: str) -> DataFrame:
    return scripts.script_hashes(view(spark, sf, "script_with_settings"), SETTINGS_TAG)


@query
def file_order(spark: SparkSession, sf: str) -> DataFrame:
    return scripts.file_order(view(spark, sf, "script"))


@query
def script_resume(spark: SparkSession, sf: str) -> DataFrame:
    """Where files go on that ran by a third, by all of their blocks, or not at all, in their later state."""
    before = view(spark, sf, "script")
    third = F.floor(F.size(split_blocks(F.col("content"), comments=False)) / 3).cast("int")
    migrated = F.when(F.col("doc_id") % 3 == 0, third).when(F.col("doc_id") % 3 == 1, 1 << 30).otherwise(0)
    progress = scripts.script_progress(before, migrated)
    return scripts.resume_points(progress, view(spark, sf, "script_next"))


@query
def script_drift(spark: SparkSession, sf: str) -> DataFrame:
    before = scripts.script_hashes(view(spark, sf, "script"), SETTINGS_TAG)
    after = scripts.script_hashes(view(spark, sf, "script_next"), SETTINGS_TAG)
    return scripts.script_drift(before, after)


# --- log and stored repository -----------------------------------------------------------


@query
def log_append(spark: SparkSession, sf: str) -> DataFrame:
    entries, old = view(spark, sf, "log_entry"), view(spark, sf, "migration_log")
    return log.log_rows(entries, old, ["migration_run_id"], NOW)


@query
def log_stream(spark: SparkSession, sf: str) -> DataFrame:
    schema = fixtures.raw(spark, sf, "events").schema
    entries = stream.read_stream(spark, sf, schema, "events.parquet")
    target = new_folder(spark, "log-stream")
    running = stream.append_stream(
        entries, fixtures.events_to_log, f"{target}/log", f"{target}/checkpoint"
    )
    running.awaitTermination()
    remove_folder(spark, f"{target}/checkpoint")
    return spark.read.schema(log.log_schema()).parquet(f"{target}/log")


@query
def log_stream_numbered(spark: SparkSession, sf: str) -> DataFrame:
    """The log of a stream whose rows are numbered from batch to batch."""
    schema = fixtures.raw(spark, sf, "events").schema
    entries = stream.read_stream(spark, sf, schema, "events.parquet")
    target = new_folder(spark, "log-stream-numbered")
    running = stream.append_numbered_stream(
        entries, fixtures.events_to_log, ["id"], f"{target}/log", f"{target}/checkpoint"
    )
    running.awaitTermination()
    remove_folder(spark, f"{target}/checkpoint")
    return spark.read.schema(log.log_schema()).parquet(f"{target}/log").select(*log.log_schema().names)


@query
def log_append_stored(spark: SparkSession, sf: str) -> DataFrame:
    """The log after new entries were appended to the stored one."""
    folder = new_folder(spark, "log")
    log.append_log(view(spark, sf, "migration_log").select(*log.log_schema().names), folder)
    stored_log = spark.read.schema(log.log_schema()).parquet(folder)
    rows = log.log_rows(view(spark, sf, "log_entry"), stored_log, ["migration_run_id"], NOW)
    log.append_log(stored(rows, "log-rows"), folder)
    return spark.read.schema(log.log_schema()).parquet(folder)


@query
def log_stream_once(spark: SparkSession, sf: str) -> DataFrame:
    """The log of a source that sends every event twice, without the repeats."""
    schema = fixtures.raw(spark, sf, "events").schema
    entries = stream.read_stream(spark, sf, schema, "events.parquet")
    twice = entries.withColumn("_again", F.explode(F.array(F.lit(1), F.lit(2)))).drop("_again")
    once = stream.without_repeats(twice, ["event_id"], "ts", "1 day")
    target = new_folder(spark, "log-stream-once")
    running = stream.append_stream(once, fixtures.events_to_log, f"{target}/log", f"{target}/checkpoint")
    running.awaitTermination()
    remove_folder(spark, f"{target}/checkpoint")
    return spark.read.schema(log.log_schema()).parquet(f"{target}/log")


def _in_repository(spark: SparkSession, sf: str, tables: list[str], then: Callable) -> DataFrame:
    """What ``then`` returns from a repository with the given tables, which is removed again."""
    repo = Repository(spark, f"loaded_{uuid.uuid4().hex}", prefix="app_")
    try:
        repo.check_create("1.0", "Spark", NOW)
        for table in tables:
            repo.replace(table, view(spark, sf, table))
        return stored(then(repo), "from-repository")
    finally:
        repo.drop()


@query
def repository_load(spark: SparkSession, sf: str) -> DataFrame:
    """Create a repository, store products and runs, repair the open runs and clean up."""

    def work(repo: Repository) -> DataFrame:
        repo.repair_runs(view(spark, sf, "run_request").where("fix"), NOW)
        repo.vacuum()
        return select.run_summary(repo.read("migration_run"))

    return _in_repository(spark, sf, ["product", "migration_run"], work)


@query
def product_apply(spark: SparkSession, sf: str) -> DataFrame:
    """The answers to a batch of product requests, read after its new rows were stored."""
    requests = view(spark, sf, "product_request")
    return _in_repository(spark, sf, ["product"], lambda repo: repo.apply_products(requests, NOW))


@query
def run_apply(spark: SparkSession, sf: str) -> DataFrame:
    """The answers to a batch of run requests, read after its runs were repaired and stored."""
    requests = view(spark, sf, "run_request")
    tables = ["product", "migrator_version", "migration_run"]
    return _in_repository(spark, sf, tables, lambda repo: repo.apply_runs(requests, NOW, "fix"))


@query
def run_ledger_applied(spark: SparkSession, sf: str) -> DataFrame:
    """The stored run table after a batch of run requests was applied to it."""

    def work(repo: Repository) -> DataFrame:
        repo.apply_runs(view(spark, sf, "run_request"), NOW, "fix")
        return repo.read("migration_run")

    return _in_repository(spark, sf, ["product", "migrator_version", "migration_run"], work)


@query
def product_ledger_applied_twice(spark: SparkSession, sf: str) -> DataFrame:
    """The stored products after one batch was applied twice."""

    def work(repo: Repository) -> DataFrame:
        for _ in range(2):
            repo.apply_products(view(spark, sf, "product_request"), NOW, batch="names")
        return repo.read("product")

    return _in_repository(spark, sf, ["product"], work)


@query
def run_ledger_applied_twice(spark: SparkSession, sf: str) -> DataFrame:
    """The stored run table after one batch, with repairs, was applied twice."""

    def work(repo: Repository) -> DataFrame:
        for _ in range(2):
            repo.apply_runs(view(spark, sf, "run_request"), NOW, "fix", batch="runs")
        return repo.read("migration_run")

    return _in_repository(spark, sf, ["product", "migrator_version", "migration_run"], work)


@query
def state_select_stored(spark: SparkSession, sf: str) -> DataFrame:
    """The state select for all open runs, over stored migrations."""
    open_runs = view(spark, sf, "migration_run").where("finished_at IS NULL")
    return _in_repository(spark, sf, ["migration"], lambda repo: repo.state_select_many(open_runs))


def _arriving(spark: SparkSession, parts: list[DataFrame], follow: Callable) -> None:
    """Add the parts to a folder one after another; ``follow`` starts a stream on it after each."""
    source = new_folder(spark, "arriving")
    for part in parts:
        part.write.mode("append").parquet(source)
        follow(stream.read_stream(spark, source, part.schema)).awaitTermination()
    remove_folder(spark, source)


@query
def run_ledger_live(spark: SparkSession, sf: str) -> DataFrame:
    """The stored run table after a stream of requests, which come in three parts in their order."""
    asked, year = view(spark, sf, "run_request"), F.year("requested_at")
    parts = [asked.where(year < 1994), asked.where((year >= 1994) & (year < 1997)), asked.where(year >= 1997)]

    def work(repo: Repository) -> DataFrame:
        paths = [f"{repo.location}/{p}" for p in ("answers", "checkpoint")]
        _arriving(spark, parts, lambda asked: live.admit_stream(repo, asked, "live", *paths, NOW, "fix"))
        return repo.read("migration_run")

    return _in_repository(spark, sf, ["product", "migrator_version", "migration_run"], work)


@query
def log_activity_live(spark: SparkSession, sf: str) -> DataFrame:
    """Log entries by hour, counted by a stream: views come first, then clicks, then the rest."""
    events, kind = fixtures.raw(spark, sf, "events"), F.coalesce(F.col("event_type"), F.lit(""))
    parts = [events.where(kind == "view"), events.where(kind == "click"), events.where(~kind.isin("view", "click"))]
    folder = new_folder(spark, "log-activity")
    activity = live.LogActivity(spark, folder, dt.timedelta(days=1), merge_every=2)
    _arriving(spark, parts, lambda come: activity.start(come, fixtures.events_to_log, f"{folder}/checkpoint"))
    return activity.read(master.dimensions(spark))


@query
def log_append_numbered(spark: SparkSession, sf: str) -> DataFrame:
    """The stored log after entries were appended, numbered by its high-water mark."""

    def work(repo: Repository) -> DataFrame:
        repo.check_create_log()
        repo.replace("migration_log", view(spark, sf, "migration_log"))
        repo.append_log(view(spark, sf, "log_entry"), ["migration_run_id"], NOW)
        return repo.read("migration_log")

    return _in_repository(spark, sf, [], work)
