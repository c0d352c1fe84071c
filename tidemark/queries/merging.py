"""Merges of changed orders into the orders known before.

The target holds the orders dated before 2000. The batch holds the orders dated
since 1998, every one read twice, with a higher price, with no status while
pending and with no segment for machinery customers. So some orders are only in
the target, some in both, some only in the batch. The priority is part of the
key and null where it is not specified.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.changes import changed_since
from tidemark.operators.lookup import add_reference
from tidemark.operators.merge import merge, multi_match_keys
from tidemark.plans.merges import merge_stored
from tidemark.queries.registry import query, table
from tidemark.sources.tables import StoredTable
from tidemark.workspace import Workspace

KNOWN_BEFORE = "2000-01-01"
CHANGED_SINCE = "1998-01-01"
# The batch of a single load: the changes of the weeks around KNOWN_BEFORE.
RECENT = ("1999-12-15", "2000-01-15")
KEYS = ["o_orderdate", "o_orderkey", "o_orderpriority"]
FLAT = KEYS + ["o_orderstatus", "o_totalprice", "custkey", "segment"]


def orders_with_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    priority = F.nullif(F.col("o_orderpriority"), F.lit("4-NOT SPECIFIED"))
    return table(spark, sf_dir, "orders").withColumn("o_orderpriority", priority)


def with_segment(orders: DataFrame, customers: DataFrame) -> DataFrame:
    return add_reference(orders, customers, "o_custkey", "c_custkey", "c_mktsegment", "segment")


def _target(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = orders_with_null_keys(spark, sf_dir).filter(
        F.col("o_orderdate") < F.lit(KNOWN_BEFORE).cast("timestamp_ntz")
    )
    return with_segment(known, table(spark, sf_dir, "customer"))


def _batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = orders_with_null_keys(spark, sf_dir)
    changed = changed_since(orders, "o_orderdate", "o_orderdate", CHANGED_SINCE)
    changed = changed.withColumn("o_totalprice", F.col("o_totalprice") + 1)
    changed = changed.withColumn("o_orderstatus", F.nullif("o_orderstatus", F.lit("P")))
    segment = F.nullif(F.col("c_mktsegment"), F.lit("MACHINERY"))
    customers = table(spark, sf_dir, "customer").withColumn("c_mktsegment", segment)
    return with_segment(changed.unionAll(changed).distinct(), customers)


def flat(orders: DataFrame) -> DataFrame:
    nested = {"custkey": "o_custkey.o_custkey", "segment": "o_custkey.segment"}
    return orders.select(*[F.col(nested.get(c, c)).alias(c) for c in FLAT])


def _merged(
    workspace: Workspace, target: DataFrame, batch: DataFrame, **options: object
) -> DataFrame:
    return merge(workspace.store(target, "target"), batch, KEYS, workspace=workspace, **options)


TARGET_SQL = f"""
    SELECT o_orderdate, o_orderkey, nullif(o_orderpriority, '4-NOT SPECIFIED') AS o_orderpriority,
           o_orderstatus, o_totalprice, o_custkey AS custkey, c_mktsegment AS segment
    FROM orders LEFT JOIN customer ON c_custkey = o_custkey
    WHERE o_orderdate < DATE '{KNOWN_BEFORE}'
"""
BATCH_SQL = f"""
    SELECT o_orderdate, o_orderkey, nullif(o_orderpriority, '4-NOT SPECIFIED') AS o_orderpriority,
           nullif(o_orderstatus, 'P') AS o_orderstatus, o_totalprice + 1 AS o_totalprice,
           o_custkey AS custkey, nullif(c_mktsegment, 'MACHINERY') AS segment
    FROM orders LEFT JOIN customer ON c_custkey = o_custkey
    WHERE o_orderdate >= DATE '{CHANGED_SINCE}'
"""


def merge_sql(target: str, batch: str, keep: tuple[str, ...] = ()) -> str:
    """A merge as a full outer join: batch values where there is a batch row."""
    same = " AND ".join(f"t.{k} = s.{k}" for k in KEYS)
    values = []
    for c in FLAT:
        side, first, second = ("t", "t", "s") if c in keep else ("s", "s", "t")
        values.append(f"CASE WHEN {side}.present THEN {first}.{c} ELSE {second}.{c} END AS {c}")
    return f"""
    WITH target AS ({target}), batch AS ({batch})
    SELECT {", ".join(values)}
    FROM (SELECT *, true AS present FROM target) t
    FULL OUTER JOIN (SELECT *, true AS present FROM batch) s ON {same}
    """


@query(merge_sql(TARGET_SQL, BATCH_SQL))
def merge_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    batch = _batch(spark, sf_dir)
    return flat(_merged(Workspace(spark), _target(spark, sf_dir), batch))


RECENT_SQL = f"""
    {BATCH_SQL} AND o_orderdate >= DATE '{RECENT[0]}' AND o_orderdate < DATE '{RECENT[1]}'
"""


@query(merge_sql(TARGET_SQL, RECENT_SQL))
def merge_upsert_broadcast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batch of a few weeks, measured as at size: it is broadcast, the target stays."""
    dates = [F.lit(day).cast("timestamp_ntz") for day in RECENT]
    batch = _batch(spark, sf_dir).filter(
        (F.col("o_orderdate") >= dates[0]) & (F.col("o_orderdate") < dates[1])
    )
    return flat(_merged(Workspace(spark), _target(spark, sf_dir), batch, worth_sparing=0))


@query(merge_sql(TARGET_SQL, BATCH_SQL, keep=("o_orderstatus",)))
def merge_keep_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The status of a known order is never overwritten."""
    batch = _batch(spark, sf_dir)
    target = _target(spark, sf_dir)
    return flat(_merged(Workspace(spark), target, batch, keep_target=("o_orderstatus",)))


@query(
    f"SELECT o_orderkey, custkey, segment FROM ({merge_sql(TARGET_SQL, BATCH_SQL)}) AS merged"
)
def merge_struct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nested column is replaced whole, a null field included."""
    merged = _merged(Workspace(spark), _target(spark, sf_dir), _batch(spark, sf_dir))
    return merged.select("o_orderkey", "o_custkey.o_custkey", "o_custkey.segment").toDF(
        "o_orderkey", "custkey", "segment"
    )


@query(
    f"""
    SELECT * FROM ({merge_sql(TARGET_SQL, BATCH_SQL)}) AS merged
    UNION ALL
    SELECT {", ".join(FLAT)} FROM ({BATCH_SQL}) AS batch WHERE o_orderpriority IS NULL
    """
)
def merge_null_key_reapply(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applied twice: batch rows with a null in the key are inserted twice."""
    workspace = Workspace(spark)
    batch = workspace.store(_batch(spark, sf_dir), "batch")
    once = _merged(workspace, _target(spark, sf_dir), batch, source_is_stored=True)
    return flat(_merged(workspace, once, batch, source_is_stored=True))


NULL_FREE = "WHERE o_orderpriority IS NOT NULL"


@query(
    merge_sql(
        f"SELECT * FROM ({TARGET_SQL}) AS t {NULL_FREE}",
        f"SELECT * FROM ({BATCH_SQL}) AS s {NULL_FREE}",
    )
)
def merge_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applied twice: with whole keys the second time changes nothing."""
    workspace = Workspace(spark)
    whole = F.col("o_orderpriority").isNotNull()
    batch = workspace.store(_batch(spark, sf_dir).filter(whole), "batch")
    target = _target(spark, sf_dir).filter(whole)
    once = _merged(workspace, target, batch, source_is_stored=True)
    return flat(_merged(workspace, once, batch, source_is_stored=True))


@query(
    f"""
    WITH target AS ({TARGET_SQL}), batch AS ({BATCH_SQL})
    SELECT {", ".join(f"CASE WHEN s.present THEN s.{c} ELSE t.{c} END AS {c}" for c in FLAT)}
    FROM (SELECT *, true AS present FROM target) t
    FULL OUTER JOIN (SELECT *, true AS present FROM batch) s
      ON {" AND ".join(f"t.{k} IS NOT DISTINCT FROM s.{k}" for k in KEYS)}
    """
)
def merge_null_safe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nulls in a key match each other."""
    batch = _batch(spark, sf_dir)
    return flat(_merged(Workspace(spark), _target(spark, sf_dir), batch, null_safe_keys=True))


@query(
    """
    SELECT l_orderkey, l_linenumber, count(*) AS source_rows
    FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
    """
)
def merge_multi_match_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    keys = ["l_orderkey", "l_linenumber"]
    return multi_match_keys(lines.select(*keys).distinct(), lines, keys)


@query(merge_sql(TARGET_SQL, BATCH_SQL))
def merge_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only months with a match are written anew; what has none is appended."""
    workspace = Workspace(spark)
    target = _target(spark, sf_dir)
    stored = StoredTable(spark, workspace.path("orders"), target.schema, "o_orderdate")
    stored.publish(target)
    batch = workspace.store(_batch(spark, sf_dir), "batch")
    merge_stored(stored, batch, KEYS, workspace=workspace)
    return flat(stored.read())
