"""What the physical plans must and must not hold."""

import datetime as dt
import hashlib
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from ledgerloom.operators import changes, ids, joins, select
from ledgerloom.operators.ids import assign_ids, next_id_base, running_sums
from ledgerloom.plans.queries import QUERIES
from ledgerloom.plans.session import build_session, shuffle_partitions
from ledgerloom.plans.storage import ensure_checkpoint_dir, new_folder
from ledgerloom.sources.fixtures import view
from ledgerloom.sources.tables import RUN_KEY, TABLES, struct_type

SF = "/root/testdata/sf0.001"
LAZY = [q for q in QUERIES if q not in ("log_stream", "repository_load", "file_order")]


def plan(df, mode="executedPlan"):
    return getattr(df._jdf.queryExecution(), mode)().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_python_and_no_cross_join(spark, name):
    text = plan(entry.queries()[name](spark, SF))
    for word in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in text


def test_state_select_prunes_and_pushes_down(spark, conf):
    conf({"spark.sql.maxMetadataStringLength": "2000"})
    text = plan(entry.queries()["state_select"](spark, SF))
    assert "EqualTo(o_custkey,7)" in text and "EqualTo(o_orderpriority,1-URGENT)" in text
    columns = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    assert not any("l_discount" in c or "l_extendedprice" in c or "o_totalprice" in c for c in columns)


def test_only_bucket_counts_go_to_one_task(spark):
    """The one window without a partition in ``assign_ids`` sums the bucket counts."""
    keys = spark.range(100_000).selectExpr("CAST(id AS STRING) AS k")
    text = plan(assign_ids(keys, ["k"]))
    single = text.split("Exchange SinglePartition")
    assert len(single) == 2
    assert "functions=[sum(_n" in single[1].split("\n")[1]


def test_running_sums(spark, conf):
    """Totals before a row, with more ranges than one task sums."""
    conf({"spark.sql.shuffle.partitions": "7"})
    rows = spark.range(1000).selectExpr("id % 10 AS g", "id", "CAST(id % 3 AS BIGINT) AS n")
    got = running_sums(rows, [F.desc("g"), "id"], {"before": F.col("n"), "rank": F.lit(1)}).collect()
    before = rank = 0
    for row in sorted(got, key=lambda r: (-r.g, r.id)):
        assert (row.before, row["rank"]) == (before, rank)
        before, rank = before + row.n, rank + 1
    assert rank == 1000
    assert running_sums(rows.limit(0), ["id"], {"before": F.col("n")}).count() == 0


def test_offsets_over_several_runs_of_buckets(spark, monkeypatch):
    monkeypatch.setattr(ids, "_BUCKETS_PER_SUM", 4)
    keys = spark.range(500).selectExpr("CAST(id AS STRING) AS k")
    got = {r.k: r.id for r in assign_ids(keys, ["k"], buckets=64).collect()}
    assert [got[k] for k in sorted(got, key=lambda k: hashlib.md5(k.encode()).hexdigest())] == list(range(1, 501))


@pytest.mark.parametrize("buckets", [1, 16, 100, 4096])
def test_ids_do_not_depend_on_the_buckets(spark, buckets):
    keys = spark.range(500).selectExpr("CAST(id AS STRING) AS k")
    got = {r.k: r.id for r in assign_ids(keys, ["k"], start=10, buckets=buckets).collect()}
    ordered = sorted(got, key=lambda k: hashlib.md5(k.encode()).hexdigest())
    assert [got[k] for k in ordered] == list(range(11, 511))


def test_ids_where_and_next_base(spark):
    rows = spark.createDataFrame([(i, i % 2 == 0) for i in range(20)], "id int, wanted boolean")
    got = assign_ids(rows, ["id"], next_id_base(rows), "new_id", where=rows.wanted).collect()
    assert sorted(r.new_id for r in got if r.wanted) == list(range(20, 30))
    assert {r.new_id for r in got if not r.wanted} == {None}
    with pytest.raises(ValueError):
        assign_ids(rows, ["id"], buckets=2**40)


def test_history_is_cut_before_the_shuffle(spark):
    text = plan(entry.queries()["current_from_history"](spark, SF))
    shuffle = text.index("Exchange hashpartitioning(migration_id")
    assert "WindowGroupLimit" in text[shuffle:] and "Partial" in text[shuffle:]


SKEW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2000",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2000",
    "spark.sql.shuffle.partitions": "8",
}


def test_hot_name_is_split(spark, conf, monkeypatch):
    """One name holds a third of the requests: AQE splits its partition and no row is lost."""
    conf(SKEW)
    requests = spark.range(0, 60_000, 1, 16).selectExpr(
        "id AS request_id",
        "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('name ', id % 1000) END AS name",
        "'x' AS description",
    )
    products = spark.createDataFrame([], struct_type("product"))
    # The outcome as a plan instead of a stored table.
    monkeypatch.setattr(changes, "stored", lambda df, name: df)
    results = changes.get_or_create_products(requests, products).results
    rows = results.collect()
    assert len(rows) == 60_000
    assert "skew=true" in plan(results)
    assert len({r.id for r in rows}) == 1 + len({i % 1000 for i in range(60_000) if i % 3})


def test_hot_run_key_is_split(spark, conf):
    conf(SKEW)
    runs = spark.range(0, 60_000, 1, 16).selectExpr(
        "id", "1L AS migrator_version_id", "IF(id % 3 = 0, 1L, id) AS product_id",
        "CAST(100 AS SMALLINT) AS migration_run_mode_id", "CAST(10 AS SMALLINT) AS migration_result_id",
        "'DEV' AS environment", "'r' AS from_release_version", "'r' AS to_release_version",
        "CAST('2020-01-01' AS TIMESTAMP_NTZ) AS started_at", "CAST(NULL AS TIMESTAMP_NTZ) AS finished_at",
        "CAST(NULL AS BIGINT) AS duration_in_ms",
    )
    repaired = changes.repair_runs(runs, runs.where("product_id < 2"), dt.datetime(2030, 1, 1))
    assert repaired.where("finished_at IS NOT NULL").count() == 20_001
    rows = repaired.collect()
    assert len(rows) == 60_000
    assert "skew=true" in plan(repaired)


def test_storage_follows_the_session(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert ensure_checkpoint_dir(spark) == folder
    assert new_folder(spark, "x").startswith(folder + "/x-")
    assert new_folder(spark, "x") != new_folder(spark, "x")


def test_shuffle_partitions():
    assert shuffle_partitions(0, 8) == 8
    assert shuffle_partitions(100 * 10**12, 4000) == 745_059


def test_session_sized_for_its_input(spark, conf):
    conf({"spark.sql.shuffle.partitions": "4"})
    assert build_session(input_bytes=64 * 128 * 1024 * 1024) is spark
    assert spark.conf.get("spark.sql.shuffle.partitions") == "64"


def test_request_table_is_read_twice(spark, conf, tmp_path):
    """The narrow columns once to decide, the whole rows once to make new runs."""
    conf({"spark.sql.maxMetadataStringLength": "2000"})
    requests = view(spark, SF, "run_request")
    path = str(tmp_path / "requests")
    requests.write.parquet(path)
    counted = spark.read.parquet(path)
    reads = []
    real = changes.stored

    def stored(df, name):
        reads.append(df._jdf.queryExecution().executedPlan().toString().count(path))
        return real(df, name)

    try:
        changes.stored = stored
        tables = [view(spark, SF, t) for t in ("migration_run", "product", "migrator_version")]
        changes.admit_runs(counted, *tables, fix="fix")
    finally:
        changes.stored = real
    assert sum(reads) == 2


def _migrations(spark, n):
    """Rows of two keys each, some without a part of the key; every row comes twice."""
    values = {
        "id": F.col("id"),
        "product_id": F.when(F.col("id") % 101 != 0, F.col("id") % (n // 2)),
        "environment": F.when(F.col("id") % 103 != 0, F.concat(F.lit("env "), F.col("id") % 2)),
        "migration_run_mode_id": F.lit(100),
        "file_up_hash": F.md5(F.col("id").cast("string")),
    }
    rows = spark.range(n).union(spark.range(n))
    columns = [values.get(c.name, F.lit(None)).cast(c.spark_type).alias(c.name) for c in TABLES["migration"]]
    return rows.select(*columns)


def test_state_select_of_many_keys_shuffles_no_wide_rows(spark, conf):
    conf({"spark.sql.autoBroadcastJoinThreshold": "30k"})
    rows = _migrations(spark, 60_000)
    keys = rows.where("product_id % 2 = 0").select(*RUN_KEY).unionByName(rows.limit(5).select(*RUN_KEY))
    keys = keys.withColumn("environment", F.when(F.col("product_id") % 10 != 0, F.col("environment")))
    found = select.state_select_many(rows, keys)
    assert "Exchange hashpartitioning" not in plan(found)
    want = rows.join(keys.distinct(), RUN_KEY, "left_semi").select(*found.columns)
    assert found.count() == want.count() > 40_000
    assert found.exceptAll(want).isEmpty() and want.exceptAll(found).isEmpty()


def test_rows_with_keys_are_those_of_the_semi_join_however_full_the_filter_is(spark, monkeypatch):
    rows, keys = spark.range(60_000).selectExpr("id % 30000 AS k", "id"), spark.range(0, 40_000, 2).toDF("k")
    want = sorted(map(tuple, rows.join(keys, "k", "left_semi").collect()))
    for blocks in (1, 2, 2**13):
        monkeypatch.setattr(joins, "_MOST_BLOCKS", blocks)
        assert sorted(map(tuple, joins.with_keys(rows, keys, ["k"], few=0).collect())) == want
    assert joins.with_keys(rows, keys.where("false"), ["k"], few=-1).isEmpty()
