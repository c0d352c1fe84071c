"""Whole loads of orders and customers, page by page.

Every order is read twice, as when rows move between pages, and has a null in
its key where the priority is not specified.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.plans.loads import Loader
from tidemark.plans.spec import Dataset, LoadSpec, Lookup
from tidemark.queries.merging import (
    KEYS,
    flat,
    merge_sql,
    orders_with_null_keys,
)
from tidemark.queries.registry import query, table
from tidemark.sources.table_pages import TablePages
from tidemark.workspace import Workspace

FULL_RUN = "2001-01-01"
DELTA_RUN = "2001-08-02"
DAYS_AGO = 365
DELTA_SINCE = "2000-08-02"
TIME_ZONE = "spark.sql.session.timeZone"


class _Shop:
    """The remote side, and a loader reading it."""

    def __init__(self, spark: SparkSession, sf_dir: str, month_of: str | None = None):
        workspace = Workspace(spark)
        self.orders = orders_with_null_keys(spark, sf_dir)
        self.customers = table(spark, sf_dir, "customer")
        spec = LoadSpec(
            main=self._dataset("orders", self.orders, "o_orderkey", "o_orderdate"),
            reference=self._dataset("customer", self.customers, "c_custkey"),
            lookup=Lookup("o_custkey", "c_custkey", "c_mktsegment", "segment"),
            target_name="orders",
            target_columns=tuple(self.orders.columns),
            keys=tuple(KEYS),
            keep_target=("o_orderstatus",),
            month_of=month_of,
        )
        self.spark, self.spec, self.root = spark, spec, workspace.path("lake")

    def _dataset(self, name: str, df: DataFrame, row_id: str, date: str | None = None) -> Dataset:
        return Dataset(name, df.schema, table=TablePages(df, row_id, date, date, stride=25_000))

    @contextmanager
    def loader(self, orders: DataFrame) -> Iterator[Loader]:
        """A loader that is sent ``orders``, each of them twice; meanwhile the session is at UTC."""
        main = self.spec.main
        sent = replace(main, table=main.table.serving(orders.unionAll(orders)))
        zone = self.spark.conf.get(TIME_ZONE)
        self.spark.conf.set(TIME_ZONE, "UTC")
        try:
            yield Loader(self.spark, replace(self.spec, main=sent), self.root)
        finally:
            self.spark.conf.set(TIME_ZONE, zone)


SEGMENT_SQL = """
    SELECT o_orderdate, o_orderkey, nullif(o_orderpriority, '4-NOT SPECIFIED') AS o_orderpriority,
           {status} AS o_orderstatus, {price} AS o_totalprice,
           o_custkey AS custkey, c_mktsegment AS segment
    FROM orders LEFT JOIN customer ON c_custkey = o_custkey
"""
LOADED_SQL = SEGMENT_SQL.format(status="o_orderstatus", price="o_totalprice")
CHANGED_SQL = SEGMENT_SQL.format(status="'X'", price="o_totalprice + 1")


@query(LOADED_SQL)
def full_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    shop = _Shop(spark, sf_dir)
    with shop.loader(shop.orders) as loader:
        loader.full_load(FULL_RUN)
    return flat(loader.target.read())


DELTA_SQL = merge_sql(
    f"{LOADED_SQL} WHERE o_orderdate < DATE '{FULL_RUN}'",
    f"{CHANGED_SQL} WHERE o_orderdate >= DATE '{DELTA_SINCE}'",
    keep=("o_orderstatus",),
)


@query(DELTA_SQL)
def delta_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A full load of the orders there were then, and a year's look-back later."""
    return _loaded_and_changed(_Shop(spark, sf_dir))


@query(DELTA_SQL)
def delta_load_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same loads into a table of months, of which only those looked back at are written."""
    return _loaded_and_changed(_Shop(spark, sf_dir, month_of="o_orderdate"))


def _loaded_and_changed(shop: _Shop) -> DataFrame:
    before = F.col("o_orderdate") < F.lit(FULL_RUN).cast("timestamp_ntz")
    with shop.loader(shop.orders.filter(before)) as loader:
        loader.full_load(FULL_RUN)
    changed = shop.orders.withColumn("o_totalprice", F.col("o_totalprice") + 1)
    with shop.loader(changed.withColumn("o_orderstatus", F.lit("X"))) as loader:
        loader.delta_load(DELTA_RUN, DAYS_AGO)
    return flat(loader.target.read())
