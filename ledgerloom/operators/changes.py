"""Changes to the ledger, for any number of requests at once.

The outcome of a batch is written to the shared folder when it is computed, so answers and new rows
belong together and stay as they are whatever is stored in the ledger later. Storing the new rows
is up to ``sources.repository``.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.values import is_blank, moment, shown, text_units
from ledgerloom.operators.ids import assign_ids, next_id_base
from ledgerloom.operators.joins import lookup
from ledgerloom.plans.storage import stored
from ledgerloom.sources.master import MODE_IDS, RESULT_FIXED, RESULT_IDS, TOOL
from ledgerloom.sources.tables import RUN_KEY, TABLES, VERSION_KEY


def same_text(value: Column) -> Column:
    """Key parts are equal if they are the same text."""
    return value


def ignoring_case(value: Column) -> Column:
    """Key parts are equal whatever their case and trailing blanks, as in many stores."""
    return F.lower(F.rtrim(value))


def _named(columns: list[tuple[str, Column]]) -> Column:
    """Names of the columns whose condition holds, with blanks between; an empty text for none."""
    return F.concat_ws(" ", *[F.when(holds, F.lit(name)) for name, holds in columns])


def _too_long(table: str, columns: list[str]) -> Column:
    """Names of the text columns that do not fit their table; trailing blanks do not count."""
    limits = {c.name: c.max_length for c in TABLES[table] if c.max_length}
    return _named([(n, text_units(F.rtrim(F.col(n))) > limits[n]) for n in columns])


@dataclass(frozen=True)
class GetOrCreate:
    """``results``: request_id, result_code, message, id. ``new_rows``: rows to append.

    Both are read from the stored outcome.
    """

    results: DataFrame
    new_rows: DataFrame


_RESULT = ["request_id", "result_code", "message", "id"]

# Takes a number of ids and returns the one before the first of them.
Reserve = Callable[[int], int]
# Writes an outcome and returns it as it was written.
Store = Callable[[DataFrame], DataFrame]


def new_rows_of(outcome: DataFrame) -> DataFrame:
    """The rows that a stored outcome adds to its table."""
    return outcome.where("new IS NOT NULL").select("id", "new.*")


def results_of(outcome: DataFrame) -> DataFrame:
    return outcome.select(*_RESULT)


def repair_keys_of(outcome: DataFrame) -> DataFrame:
    """The run keys whose open runs a stored outcome ends: those of admitted requests that repair."""
    return outcome.where("repairs").select(*[F.col(f"new.{c}").alias(c) for c in RUN_KEY]).distinct()


def _get_or_create(
    requests: DataFrame,
    ledger: DataFrame,
    table: str,
    key: list[str],
    refusal: Column,
    messages: dict[str, Column],
    values: dict[str, Column],
    equal: Callable[[Column], Column],
    reserve: Reserve | None,
    store: Store | None,
) -> GetOrCreate:
    """Ids of the requested keys; a key without a ledger row gets a new one, once.

    ``refusal`` is a message for requests that can't be stored, null for the others. The messages
    by status may name the column ``_id``. The ledger is cut down to the asked keys before it is
    grouped, and only keys that are not in it are numbered.
    """
    parts = [f"_key_{k}" for k in key]
    keyed = [equal(F.col(k)).alias(p) for k, p in zip(key, parts)]
    refused = refusal.alias("_refusal")
    asked = (
        requests.select("request_id", *keyed, refused)
        .where("_refusal IS NULL")
        .groupBy(*parts)
        .agg(F.min("request_id").alias("_first"))
    )
    known = (
        lookup(ledger.select(*keyed, "id"), asked, parts, "left_semi")
        .groupBy(*parts)
        .agg(F.count("*").alias("_rows"), F.min("id").alias("_known_id"))
    )
    both = stored(lookup(asked, known, parts), f"{table}-keys")
    fresh = both.where("_rows IS NULL").select(*parts, "_first")
    base = next_id_base(ledger) if reserve is None else reserve(fresh.count())
    numbered = assign_ids(fresh, parts, base, id_col="_id")
    once = F.col("_rows") == 1
    stood = both.where("_rows IS NOT NULL").select(
        *parts,
        "_first",
        F.when(once, F.col("_known_id")).alias("_id"),
        F.when(once, "found").otherwise("ambiguous").alias("_status"),
    )
    resolved = stood.unionByName(numbered.withColumn("_status", F.lit("created")))

    joined = lookup(requests.select("*", *keyed, refused), resolved, parts)
    is_new = (F.col("_status") == "created") & (F.col("request_id") == F.col("_first"))
    status = (
        F.when(F.col("_refusal").isNotNull(), "refused")
        .when(is_new, "created")
        .when(F.col("_status") == "created", "found")
        .otherwise(F.col("_status"))
    )
    valid = F.col("_refusal").isNull()
    rows = joined.withColumn("_id", F.when(valid, F.col("_id"))).withColumn("_status", status)
    message = F.col("_refusal")
    for name, text in messages.items():
        message = F.when(F.col("_status") == name, text).otherwise(message)
    new = F.struct(
        *[values.get(c.name, F.col(c.name)).cast(c.spark_type).alias(c.name) for c in TABLES[table] if c.name != "id"]
    )
    outcome = rows.select(
        "request_id",
        F.coalesce("_id", F.lit(-1).cast("bigint")).alias("result_code"),
        message.alias("message"),
        F.col("_id").alias("id"),
        F.when(F.col("_status") == "created", new).alias("new"),
    )
    outcome = stored(outcome, f"{table}-outcome") if store is None else store(outcome)
    return GetOrCreate(results_of(outcome), new_rows_of(outcome))


def get_or_create_products(
    requests: DataFrame,
    products: DataFrame,
    now: dt.datetime | None = None,
    equal: Callable[[Column], Column] = same_text,
    reserve: Reserve | None = None,
    store: Store | None = None,
) -> GetOrCreate:
    """Id of each requested product name; unknown names are added once.

    ``requests`` has ``request_id`` (unique), ``name`` and ``description``. Requests count in
    the order of their ids. An empty name, a text that is too long for the table, and a name that
    is stored more than once are errors. Runs jobs and stores the outcome, with ``store`` if it is
    given; ``reserve`` gives out ids, by default those after the highest one in the table.
    """
    too_long = _too_long("product", ["name", "description"])
    # Result messages.
    refusal = F.when(
        is_blank(F.col("name")),
        F.concat(F.lit("Product with empty name ["), shown(F.col("name")), F.lit("] is not allowed!")),
    ).when(too_long != "", F.concat(F.lit("Product with too long ["), too_long, F.lit("] is not allowed!")))
    known = F.concat(F.lit("Product ["), "name", F.lit("] with Id ["), F.col("_id").cast("string"), F.lit("] "))
    messages = {
        "found": F.concat(known, F.lit("found")),
        "created": F.concat(known, F.lit("successfully created")),
        "ambiguous": F.concat(F.lit("Multiple [Product]-entries found for Product ["), "name", F.lit("].")),
    }
    values = {"created_at": moment(now)}
    return _get_or_create(
        requests, products, "product", ["name"], refusal, messages, values, equal, reserve, store
    )


def get_or_create_versions(
    requests: DataFrame,
    versions: DataFrame,
    now: dt.datetime | None = None,
    tool: str = TOOL,
    equal: Callable[[Column], Column] = same_text,
    reserve: Reserve | None = None,
    store: Store | None = None,
) -> GetOrCreate:
    """Id of each requested version (three-part key); unknown versions are added once.

    ``requests`` has ``request_id`` (unique) and the three key columns. A key stored more than
    once is an error, and so are a null and a too long text in a key: the ledger could not store
    them. Runs jobs and stores the outcome.
    """
    missing = _named([(k, F.col(k).isNull()) for k in VERSION_KEY])
    too_long = _too_long("migrator_version", VERSION_KEY)
    layout, database, build = [shown(F.col(k)) for k in VERSION_KEY]
    # Result messages.
    entry = F.concat(
        F.lit("RepositoryVersion ["), layout, F.lit("], RepositoryDatabaseType ["), database,
        F.lit(f"], {tool}Version ["), build, F.lit("]."),
    )
    exists, text_id = f"{tool} repository already exists. ", F.col("_id").cast("string")
    refusal = F.when(missing != "", F.concat(F.lit("Incomplete version key: "), entry)).when(
        too_long != "", F.concat(F.lit("Version key with too long ["), too_long, F.lit("] is not allowed!"))
    )
    messages = {
        "ambiguous": F.concat(F.lit("Multiple [MigratorVersion]-entries found for "), entry),
        "found": F.concat(F.lit(exists + "Using VersionId ["), text_id, F.lit("].")),
        "created": F.concat(F.lit(exists + "New VersionId ["), text_id, F.lit("] created.")),
    }
    values = {"created_at": moment(now)}
    return _get_or_create(
        requests, versions, "migrator_version", VERSION_KEY, refusal, messages, values, equal, reserve, store
    )


def repair_runs(
    runs: DataFrame,
    keys: DataFrame,
    now: dt.datetime | None = None,
    fix_result_id: int = RESULT_FIXED,
) -> DataFrame:
    """The run table with the open runs of the given keys ended by ``fix_result_id``.

    Only the result and the finish time change. Finished runs, most of the table, take no part
    in the join and are not shuffled.
    """
    asked = keys.select(*RUN_KEY).distinct().withColumn("_asked", F.lit(True))
    hit = F.col("_asked").isNotNull()
    open_runs = lookup(runs.where(F.col("finished_at").isNull()), asked, RUN_KEY)
    changed = {
        "migration_result_id": F.when(hit, F.lit(fix_result_id).cast("smallint")).otherwise(
            F.col("migration_result_id")
        ),
        "finished_at": F.when(hit, moment(now)),
    }
    repaired = open_runs.select(*[changed.get(c, F.col(c)).alias(c) for c in runs.columns])
    return runs.where(F.col("finished_at").isNotNull()).unionByName(repaired)


@dataclass(frozen=True)
class Admission:
    """``results``: request_id, result_code, message, id. ``new_runs``: rows to append.
    ``repair_keys``: run keys whose open runs end first.

    All three are stored and do not change. ``runs``, the whole run table afterwards, is computed
    from the run table as it is when ``runs`` is evaluated.
    """

    results: DataFrame
    new_runs: DataFrame
    repair_keys: DataFrame
    runs: DataFrame


# Columns a run cannot be stored without.
_REQUIRED = [*RUN_KEY, "migrator_version_id", "migration_result_id"]
_RUN_TEXTS = ["environment", "from_release_version", "to_release_version"]


def _parents(table: DataFrame, rows: DataFrame, column: str, *more: Column) -> DataFrame:
    """One row per id of ``table`` that ``rows`` refers to, however often it is stored."""
    asked = rows.select(F.col(column)).distinct()
    found = lookup(table.withColumnRenamed("id", column), asked, [column], "left_semi")
    return found.groupBy(column).agg(F.lit(True).alias(f"_has_{column}"), *more)


def admit_runs(
    requests: DataFrame,
    runs: DataFrame,
    products: DataFrame,
    versions: DataFrame,
    now: dt.datetime | None = None,
    fix: str | None = None,
    fix_result_id: int = RESULT_FIXED,
    reserve: Reserve | None = None,
    store: Store | None = None,
) -> Admission:
    """Admit run requests whose key (product, environment, mode) has no open run.

    ``requests`` has ``request_id`` (unique), ``requested_at`` and the columns of a new run. The
    outcome is that of handling them one by one by (requested_at, request_id): the first one of
    a free key enters, and later ones find its run open. A request whose column ``fix`` is true
    first ends all open runs of its key, those entered before it included, and so always enters.
    No run ends by itself during a batch.

    Requests that the ledger could not store are errors and do not hold their key: without a
    required value, with a product, version, mode or result that does not exist, or with a text
    that is too long. Ids are dense over the admitted requests.

    Runs jobs and stores the outcome, with ``store`` if it is given; ``reserve`` gives out ids, by
    default those after the highest one in the table. All is decided on the narrow columns; whole
    requests are shuffled once, to make the new runs.
    """
    wants_fix = F.coalesce(F.col(fix), F.lit(False)) if fix else F.lit(False)
    narrow = stored(
        requests.select(
            "request_id",
            "requested_at",
            *_REQUIRED,
            wants_fix.alias("_fix"),
            _too_long("migration_run", _RUN_TEXTS).alias("_too_long"),
        ),
        "run-requests",
    )
    names = _parents(products.select("id", "name"), narrow, "product_id", F.min("name").alias("_product"))
    builds = _parents(versions.select("id"), narrow, "migrator_version_id")
    checked = lookup(lookup(narrow, names, ["product_id"]), builds, ["migrator_version_id"])
    missing = _named([(c, F.col(c).isNull()) for c in _REQUIRED])
    unknown = _named(
        [
            ("product_id", F.col("_has_product_id").isNull()),
            ("migrator_version_id", F.col("_has_migrator_version_id").isNull()),
            ("migration_run_mode_id", ~F.col("migration_run_mode_id").isin(MODE_IDS)),
            ("migration_result_id", ~F.col("migration_result_id").isin(RESULT_IDS)),
        ]
    )
    # Result messages.
    what = lambda kind, columns: F.concat(
        F.lit(f"MigrationRun {kind} ["), columns, F.lit("] is not allowed!")
    )
    refusal = (
        F.when(missing != "", what("without", missing))
        .when(unknown != "", what("with unknown", unknown))
        .when(F.col("_too_long") != "", what("with too long", F.col("_too_long")))
    )
    checked = checked.select(
        "request_id", "requested_at", *RUN_KEY, "_fix", "_product", refusal.alias("_refusal")
    )
    complete = checked.where("_refusal IS NULL")

    # Per key: the first request, and the last one that repairs. Both combine on the map side.
    turn = F.struct("requested_at", "request_id", "_fix")
    keyed = complete.groupBy(*RUN_KEY).agg(
        F.min(turn).alias("_first"), F.max(F.when(F.col("_fix"), turn)).alias("_last_fix")
    )
    asked = complete.select(*RUN_KEY).distinct()
    open_runs = runs.where(F.col("finished_at").isNull()).select(*RUN_KEY)
    open_keys = lookup(open_runs, asked, RUN_KEY, "left_semi").distinct().withColumn("_open", F.lit(True))
    state = keyed.join(open_keys, RUN_KEY, "left")
    first_id = F.col("_first.request_id")
    enters = F.col("_open").isNull() | F.col("_first._fix")
    # The one run of this batch that is still open at its end.
    stays_id = F.coalesce(F.col("_last_fix.request_id"), F.when(enters, first_id))
    first = F.struct(
        first_id.alias("request_id"), enters.alias("_enters"), first_id.eqNullSafe(stays_id).alias("_stays")
    )
    last = F.struct(stays_id.alias("request_id"), F.lit(True).alias("_enters"), F.lit(True).alias("_stays"))
    two = stays_id.isNotNull() & (stays_id != first_id)
    marks = state.select(F.inline(F.when(two, F.array(first, last)).otherwise(F.array(first))))

    # From here on the join key is the unique request id, so hot run keys play no part.
    valid = F.col("_refusal").isNull()
    entered = valid & (F.col("_fix") | F.coalesce(F.col("_enters"), F.lit(False)))
    decided = lookup(checked, marks, ["request_id"]).select(
        "request_id",
        *[F.col(c).alias(f"_{c}") for c in RUN_KEY],
        "_product",
        "_refusal",
        entered.alias("_entered"),
        F.coalesce("_stays", F.lit(False)).alias("_stays"),
        (entered & F.col("_fix")).alias("_repairs"),
    )
    decided = stored(decided, "run-decided")
    entering = decided.where("_entered").select("request_id")
    base = next_id_base(runs) if reserve is None else reserve(entering.count())
    numbered = assign_ids(entering, ["request_id"], base, id_col="_id")
    # Plain joins: the id is unique, and what the first one has dealt out by it stays where it is.
    answered = decided.join(numbered, "request_id", "left")
    rows = requests.join(answered, "request_id", "left")
    # Result messages.
    message = (
        F.when(F.col("_refusal").isNotNull(), F.col("_refusal"))
        .when(
            F.col("_entered"),
            F.concat(
                F.lit("MigrationRun with Id ["), F.col("_id").cast("string"),
                F.lit("] successfully created for ProductId ["), shown(F.col("_product_id")), F.lit("]"),
            ),
        )
        .otherwise(
            F.concat(
                F.lit("MigrationRun for Product ["), shown(F.col("_product")),
                F.lit("] with Id ["), shown(F.col("_product_id")),
                F.lit("] is currently in progress. Parallel migrations for the same product with"
                      " MigrationRunModeId [Migrate="), shown(F.col("_migration_run_mode_id")),
                F.lit("] are not allowed!"),
            )
        )
    )
    stays = F.col("_stays")
    values = {
        "migration_result_id": F.when(stays, F.col("migration_result_id")).otherwise(F.lit(fix_result_id)),
        "started_at": moment(now),
        "finished_at": F.when(~stays, moment(now)),
        "duration_in_ms": F.lit(None),
    }
    new = F.struct(
        *[
            values.get(c.name, F.col(c.name)).cast(c.spark_type).alias(c.name)
            for c in TABLES["migration_run"]
            if c.name != "id"
        ]
    )
    outcome = rows.select(
        "request_id",
        F.coalesce("_id", F.lit(-1).cast("bigint")).alias("result_code"),
        message.alias("message"),
        F.col("_id").alias("id"),
        F.when(F.col("_entered"), new).alias("new"),
        F.col("_repairs").alias("repairs"),
    )
    outcome = stored(outcome, "run-outcome") if store is None else store(outcome)
    new_runs, repair_keys = new_rows_of(outcome), repair_keys_of(outcome)
    repaired = repair_runs(runs, repair_keys, now, fix_result_id)
    return Admission(results_of(outcome), new_runs, repair_keys, repaired.unionByName(new_runs))


def newest_history(history: DataFrame) -> DataFrame:
    """The history row with the largest id of each migration.

    Spark turns the filter on the first row into a group limit that already runs before the
    shuffle, so of a hot migration each task passes on one row only. This beats ``max_by`` of a
    struct, which sorts as well and builds the struct for every row.
    """
    newest = Window.partitionBy("migration_id").orderBy(F.desc("id"))
    return history.withColumn("_nth", F.row_number().over(newest)).where("_nth = 1").drop("_nth")


def current_from_history(history: DataFrame) -> DataFrame:
    """Current state of each migration: that of its newest history row."""
    body = [c.name for c in TABLES["migration"] if c.name != "id"]
    return newest_history(history).select(F.col("migration_id").alias("id"), *body)
