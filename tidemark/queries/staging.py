"""Casts, rejects, truncate-and-load, table creation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.functions.casts import coerce, coerce_or_reject
from tidemark.queries.registry import query, table
from tidemark.sources.tables import StoredTable
from tidemark.workspace import Workspace


@query("SELECT * FROM lineitem")
def coerce_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    raw = lines.select(*[F.col(c).cast("string").alias(c) for c in lines.columns])
    return coerce(raw, lines.schema)


@query(
    """
    SELECT o_orderkey,
           TRY_CAST(CASE WHEN o_orderstatus = 'P' THEN o_orderpriority
                         ELSE o_custkey::VARCHAR END AS BIGINT) AS o_custkey,
           o_orderstatus = 'P' AS rejected
    FROM orders
    """
)
def coerce_permissive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pending orders arrive with text where the customer number belongs."""
    pending = F.col("o_orderstatus") == "P"
    raw = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string"),
        F.when(pending, F.col("o_orderpriority"))
        .otherwise(F.col("o_custkey").cast("string"))
        .alias("o_custkey"),
    )
    schema = StructType().add("o_orderkey", "long").add("o_custkey", "long")
    good, rejects = coerce_or_reject(raw, schema)
    order_of_reject = F.get_json_object("record", "$.o_orderkey").cast("bigint")
    return good.withColumn("rejected", F.lit(False)).unionAll(
        rejects.select(
            order_of_reject.alias("o_orderkey"),
            F.lit(None).cast("bigint").alias("o_custkey"),
            F.col("columns").contains("o_custkey").alias("rejected"),
        )
    )


@query("SELECT * FROM customer")
def truncate_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer")
    staged = StoredTable(spark, Workspace(spark).path("stg_customer"), customers.schema)
    staged.publish(customers.withColumn("c_acctbal", F.lit(0.0)))
    staged.publish(customers)
    return staged.read()


@query(
    """
    SELECT c_mktsegment, count(*) AS rows_before, 0::BIGINT AS rows_after
    FROM customer GROUP BY c_mktsegment
    """
)
def create_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer")
    created = StoredTable(spark, Workspace(spark).path("customer"), customers.schema)
    created.publish(customers)
    before = created.read().groupBy("c_mktsegment").agg(F.count("*").alias("rows_before"))
    created.create_empty()
    after = created.read().groupBy("c_mktsegment").agg(F.count("*").alias("rows_after"))
    joined = before.join(after, "c_mktsegment", "left")
    return joined.select(
        "c_mktsegment", "rows_before", F.coalesce("rows_after", F.lit(0)).alias("rows_after")
    )
