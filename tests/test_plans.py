"""Physical plans: what is broadcast, pushed down, pre-aggregated and split."""

from __future__ import annotations

from contextlib import contextmanager

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tidemark.functions.casts import text_schema
from tidemark.operators import sizes
from tidemark.operators.changes import changed_since
from tidemark.operators.lookup import add_reference
from tidemark.operators.merge import merge, shared_keys
from tidemark.operators.sizes import fits_broadcast, measured_bytes
from tidemark.queries import QUERIES
from tidemark.session import settings_for, sized_for
from tidemark.sources import paged
from tidemark.workspace import Workspace, shared_root

HOT_ROWS = 20_000
COLD_ROWS = 40_000


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    df.collect()
    text = plan(df)
    assert "isFinalPlan=true" in text
    return text


@contextmanager
def settings(spark, **values):
    keys = {name.replace("__", "."): value for name, value in values.items()}
    old = {key: spark.conf.get(key, None) for key in keys}
    for key, value in keys.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in old.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


@pytest.fixture
def small_partitions(spark):
    """Sizes at which a few thousand rows count as a skewed partition."""
    with settings(
        spark,
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="32KB",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="64KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
    ):
        yield


def hot_and_cold(spark, hot_key):
    """A third of the rows share ``hot_key``; the others have a key each."""
    rows = spark.range(0, HOT_ROWS + COLD_ROWS, 1, 16)
    key = F.when(F.col("id") % 3 == 0, F.lit(hot_key)).otherwise(F.col("id"))
    return rows.select(key.alias("k"), F.col("id").alias("v"), F.sha2(F.hex("id"), 256).alias("w"))


@pytest.fixture
def any_size(spark, monkeypatch):
    """Takes the measured way at any size, and keeps Spark from broadcasting by itself."""
    monkeypatch.setattr(sizes, "WORTH_SPARING", 0)
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        yield


def test_small_reference_is_broadcast_and_main_not_moved(spark, workspace, any_size):
    main = workspace.store(hot_and_cold(spark, 0), "main")
    reference = workspace.store(spark.range(100).select("id", F.col("id").alias("p")), "ref")
    text = plan(add_reference(main, reference, "k", "id", "p", "p"))
    assert "BroadcastHashJoin" in text and "LeftOuter, BuildRight" in text
    assert text.count("Exchange hashpartitioning") == 1  # of the reference, for its distinct


@pytest.mark.parametrize("name", ["enrich_left_join_broadcast", "merge_upsert_broadcast"])
@pytest.mark.parametrize("sf", ["0.01", "0.1"])
def test_registered_forms_broadcast_by_measure(spark, name, sf):
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        text = plan(QUERIES[name](spark, f"/root/testdata/sf{sf}"))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


@pytest.mark.parametrize("hot", [0, None])
def test_hot_name_is_split(spark, workspace, small_partitions, hot):
    rows = hot_and_cold(spark, hot).withColumn("k", F.col("k").cast("string"))
    main = workspace.store(rows, "main")
    names = spark.range(0, 5000).select(F.col("id").cast("string").alias("n"), F.lit(1).alias("p"))
    reference = workspace.store(names, "ref")
    joined = add_reference(main, reference, "k", "n", "p", "p", broadcast_limit=0)
    assert "SortMergeJoin(skew=true)" in final_plan(joined)
    assert joined.count() == HOT_ROWS + COLD_ROWS


def test_hot_target_key_is_split(spark, workspace, small_partitions):
    target = workspace.store(hot_and_cold(spark, 0), "target")
    source = spark.range(0, 3000).select(
        F.col("id").alias("k"), F.lit(-1).alias("v"), F.lit("new").alias("w")
    )
    merged = merge(target, source, ["k"], workspace=workspace, broadcast_limit=0)
    assert "SortMergeJoin(skew=true)" in final_plan(merged)
    assert merged.filter("w = 'new' and k = 0").count() == HOT_ROWS


def test_hot_target_key_is_split_among_many_partitions(spark, workspace, small_partitions):
    initial = "spark__sql__adaptive__coalescePartitions__initialPartitionNum"
    with settings(spark, **{initial: "2500"}):
        test_hot_target_key_is_split(spark, workspace, None)


def test_hot_source_key_is_split(spark, workspace, small_partitions):
    known = spark.range(50_000, 103_000).select(
        F.col("id").alias("k"), F.col("id").alias("v"), F.lit("old").alias("w")
    )
    target = workspace.store(known, "target")
    batch = hot_and_cold(spark, 0)
    merged = merge(target, batch, ["k"], workspace=workspace, broadcast_limit=0)
    assert "SortMergeJoin(skew=true)" in final_plan(merged)
    assert merged.count() == batch.filter("k < 50000").count() + 53_000


def test_nothing_is_joined_without_a_match(spark, workspace):
    target = workspace.store(hot_and_cold(spark, 0).filter("k > 10"), "target")
    batch = hot_and_cold(spark, 0).filter("k <= 10")
    text = plan(merge(target, batch, ["k"], workspace=workspace, broadcast_limit=0))
    assert "Join" not in text and "Exchange" not in text


def test_null_target_keys_are_not_shuffled(spark, workspace, small_partitions):
    target = workspace.store(hot_and_cold(spark, None), "target")
    source = spark.range(0, 3000).select(
        F.col("id").alias("k"), F.lit(-1).alias("v"), F.lit("new").alias("w")
    )
    merged = merge(target, source, ["k"], workspace=workspace, broadcast_limit=0)
    text = final_plan(merged)
    assert "IsNull(k)" in text
    assert merged.filter("k is null").count() == HOT_ROWS


def test_small_batch_leaves_the_target_in_place(spark, workspace, any_size):
    target = workspace.store(hot_and_cold(spark, 0), "target")
    batch = spark.range(10).select(
        F.col("id").alias("k"), F.lit(1).alias("v"), F.lit("x").alias("w")
    )
    text = plan(merge(target, batch, ["k"], workspace=workspace))
    assert "Exchange hashpartitioning" not in text
    assert "BroadcastHashJoin" in text and "LeftOuter, BuildRight" in text


def test_keys_are_counted_before_the_shuffle(spark, workspace):
    target = workspace.store(hot_and_cold(spark, 0), "target")
    source = workspace.store(hot_and_cold(spark, 0), "source")
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        text = plan(shared_keys(target, source, ["k"], broadcast_limit=0))
    assert text.count("Exchange") == 1
    assert "partial_sum" in text
    assert "ReadSchema: struct<k:bigint>" in text


def test_instants_are_stored_with_bounds(spark, workspace):
    stored = workspace.store(spark.sql("select timestamp '2024-01-01 00:00:00' as at"), "at")
    text = plan(stored.filter("at is null"))
    assert "PushedFilters: [IsNull(at)]" in text
    (path,) = [p for p in stored.inputFiles() if p.endswith(".parquet")]
    column = pq.ParquetFile(path.removeprefix("file://")).metadata.row_group(0).column(0)
    assert column.physical_type == "INT64" and column.statistics.null_count == 0


def test_distinct_is_pre_aggregated(spark, workspace):
    rows = workspace.store(hot_and_cold(spark, 0), "rows")
    text = plan(rows.distinct())
    assert text.count("HashAggregate") == 2 and text.count("Exchange") == 1


def test_change_filter_reaches_the_scan(spark):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select("event_id", "ts")
    text = plan(changed_since(events, "ts", "ts", "2024-01-28").select("event_id"))
    assert "PushedFilters: [" in text and "GreaterThanOrEqual(ts," in text
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in text


def test_broadcast_needs_a_measured_bound(spark, workspace, monkeypatch):
    df = spark.createDataFrame(
        [("abc", 1, ("x" * 100, None)), (None, None, None)],
        "s string, n long, box struct<a: string, b: long>",
    )
    assert 103 + 2 * 8 * 5 <= measured_bytes(df) <= 400
    assert measured_bytes(df.select(F.array("n").alias("a"))) is None
    stored = workspace.store(df, "rows")
    assert not fits_broadcast(stored, stored)
    monkeypatch.setattr(sizes, "WORTH_SPARING", 0)
    large = workspace.store(hot_and_cold(spark, 0), "large")
    assert fits_broadcast(stored, large)
    assert not fits_broadcast(stored, large, 0)
    assert not fits_broadcast(large, stored)


def test_shared_folder_comes_from_the_session(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert shared_root(spark) == folder
    assert Workspace(spark).root.startswith(folder)


def test_page_plan_covers_every_row():
    for rows in (0, 1, 99, 100, 101, 1000):
        starts = [*paged.page_starts(rows, 70), rows]
        covered = [k for start, stop in zip(starts, starts[1:]) for k in range(start, stop)]
        assert covered == list(range(rows))


def test_partitions_follow_the_input_size(spark):
    shuffle = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    split = "spark.sql.files.maxPartitionBytes"
    small = settings_for(spark, 10**6)
    assert small[shuffle] == "8" and int(small[split]) == 128 * 2**20
    assert settings_for(spark, 2**40)[shuffle] == "8192"
    huge = settings_for(spark, 100 * 10**12)
    assert 9e8 < int(huge[split]) <= 2**30
    # What the driver tracks is bounded: map tasks times reduce tasks.
    assert 10**8 < int(huge[shuffle]) * (100 * 10**12 // int(huge[split])) <= 10**9
    before = spark.conf.get(split)
    with sized_for(spark, 2**40):
        aggregated = spark.range(10).groupBy(F.col("id") % 3).count()
        assert ", 8192)" in plan(aggregated)
    assert spark.conf.get(split) == before and spark.conf.get(shuffle, None) is None


def test_sizes_of_loads_side_by_side_do_not_outlast_them(spark):
    shuffle = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    before = spark.conf.get(shuffle, None)
    first, second = sized_for(spark, 2**40), sized_for(spark, 2**39)
    first.__enter__()
    second.__enter__()
    first.__exit__(None, None, None)
    assert spark.conf.get(shuffle) == "4096"
    second.__exit__(None, None, None)
    assert spark.conf.get(shuffle, None) == before
    with sized_for(spark, 2**40):
        with sized_for(spark, 2**39):
            assert spark.conf.get(shuffle) == "4096"
        assert spark.conf.get(shuffle) == "8192"
    assert spark.conf.get(shuffle, None) == before


def test_text_schema(spark):
    schema = spark.range(1).select("id", F.lit(1.0).alias("x")).schema
    assert text_schema(schema).simpleString() == "struct<id:string,x:string>"
