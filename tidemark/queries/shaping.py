"""Distinct, projection, lookup, parametrised table names."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.lookup import add_reference, reference_values
from tidemark.queries.registry import query, table
from tidemark.sources.names import name_table, rename_table
from tidemark.sources.tables import StoredTable
from tidemark.workspace import Workspace


@query("SELECT DISTINCT * FROM lineitem")
def distinct_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Returned lines have been read twice."""
    lines = table(spark, sf_dir, "lineitem")
    return lines.unionAll(lines.filter("l_returnflag = 'R'")).distinct()


@query("SELECT DISTINCT c_nationkey AS name, c_mktsegment AS value FROM customer")
def ref_project_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reference_values(table(spark, sf_dir, "customer"), "c_nationkey", "c_mktsegment")


def count_of(spark: SparkSession, name: str) -> DataFrame:
    """Row count of a table whose name is an argument."""
    return spark.sql("SELECT count(*) AS row_count FROM IDENTIFIER(:name)", args={"name": name})


@query(
    """
    SELECT 'customer' AS name, count(*) AS row_count FROM customer
    UNION ALL SELECT 'orders', count(*) FROM orders
    UNION ALL SELECT 'lineitem', count(*) FROM lineitem
    """
)
def param_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = []
    for name in ("customer", "orders", "lineitem"):
        table(spark, sf_dir, name).createOrReplaceTempView(f"param_{name}")
        count = count_of(spark, f"param_{name}")
        counts.append(count.select(F.lit(name).alias("name"), "row_count"))
    return reduce(DataFrame.unionAll, counts)


@query("SELECT * FROM customer")
def table_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Named while empty, published and appended to, then read by name in another session."""
    customers = table(spark, sf_dir, "customer")
    stored = StoredTable(spark, Workspace(spark).path("customer"), customers.schema)
    stored.create_empty()
    name_table(stored, "named_customer")
    stored.publish(customers.filter("c_nationkey < 10"))
    stored.append(customers.filter("c_nationkey >= 10 or c_nationkey is null"))
    rename_table(stored, "named_customer")
    return spark.newSession().table("named_customer")


LABELLED_SQL = """
    SELECT d.doc_id, d.lang, d.source, d.n_chars, l.quality
    FROM documents d
    LEFT JOIN (SELECT DISTINCT doc_id, quality FROM labels) l ON l.doc_id = d.doc_id
    """


@query(LABELLED_SQL)
def enrich_left_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels cover some of the documents."""
    return _labelled(spark, sf_dir)


@query(LABELLED_SQL)
def enrich_left_join_broadcast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as at size: labels measured, and broadcast where they fit."""
    return _labelled(spark, sf_dir, worth_sparing=0)


def _labelled(spark: SparkSession, sf_dir: str, **options: object) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    labels = table(spark, sf_dir, "labels")
    joined = add_reference(documents, labels, "doc_id", "doc_id", "quality", "quality", **options)
    return joined.select("doc_id.doc_id", "lang", "source", "n_chars", "doc_id.quality")


@query(
    """
    SELECT c.c_custkey, c.c_name, c.c_nationkey AS nation_key, n.n_name AS nation_name,
           false AS nation_is_null
    FROM customer c LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey
    """
)
def struct_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    nations = table(spark, sf_dir, "nation")
    joined = add_reference(customers, nations, "c_nationkey", "n_nationkey", "n_name", "n_name")
    return joined.select(
        "c_custkey",
        "c_name",
        F.col("c_nationkey.c_nationkey").alias("nation_key"),
        F.col("c_nationkey.n_name").alias("nation_name"),
        F.col("c_nationkey").isNull().alias("nation_is_null"),
    )
