"""Counting, paging, filtering and landing, on the events table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.functions.casts import coerce
from tidemark.functions.dates import landing_path_column, since_column
from tidemark.functions.json_text import first_count, flatten_pages
from tidemark.operators.changes import changed_since
from tidemark.operators.pages import ROW_NO, number_rows, one_page, page_offset, page_offsets
from tidemark.queries.registry import query, table
from tidemark.sources.landing import land, read_landed
from tidemark.sources.table_pages import TablePages
from tidemark.workspace import Workspace

SINCE = "2024-01-28"
STRIDE = 2500


def _updated_at() -> Column:
    """Each event is taken to be updated as many hours later as its user's number."""
    return F.expr("ts + make_dt_interval(0, cast(user_id as int), 0, 0)")


def _events_with_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("updated", _updated_at())


def _numbered_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return number_rows(table(spark, sf_dir, "events"), "event_id", Workspace(spark))


def _from_bodies(source: TablePages, since: str | None, schema: StructType) -> DataFrame:
    """Pages as they are sent, and what a load reads of them."""
    pages = source.pages(since, Workspace(source.rows.sparkSession))
    return coerce(flatten_pages(pages, "body", schema), schema)


@query("SELECT count(*) AS row_count FROM events")
def page_count_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").agg(F.count("*").alias("row_count"))


CHANGED = f"ts >= DATE '{SINCE}' OR ts + to_hours(user_id) >= DATE '{SINCE}'"


@query(f"SELECT count(*) AS row_count FROM events WHERE {CHANGED}")
def delta_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    changed = changed_since(_events_with_update(spark, sf_dir), "ts", "updated", SINCE)
    return changed.agg(F.count("*").alias("row_count"))


@query(f"SELECT unnest(range(0, (SELECT count(*) FROM events), {STRIDE})) AS page_offset")
def page_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_offsets(table(spark, sf_dir, "events"), STRIDE)


@query("SELECT * FROM events")
def page_scan_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return _from_bodies(TablePages(events, "event_id", stride=STRIDE), None, events.schema)


@query("SELECT * FROM events")
def page_scan_strided(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages below the stride: every stride takes several calls, and no row is lost."""
    events = table(spark, sf_dir, "events")
    return _from_bodies(TablePages(events, "event_id", stride=700), None, events.schema)


@query(f"SELECT * FROM events WHERE {CHANGED}")
def page_scan_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _events_with_update(spark, sf_dir)
    source = TablePages(events, "event_id", "ts", "updated", hidden=("updated",), stride=STRIDE)
    return _from_bodies(source, SINCE, events.drop("updated").schema)


@query(f"SELECT * FROM events ORDER BY event_id LIMIT {STRIDE} OFFSET {2 * STRIDE - 7}")
def page_single(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One page by its offset: a filter on row numbers."""
    return one_page(_numbered_events(spark, sf_dir), 2 * STRIDE - 7, STRIDE)


@query(
    f"""
    WITH numbered AS (SELECT *, row_number() OVER (ORDER BY event_id) - 1 AS n FROM events)
    SELECT n - n % {STRIDE} AS page_offset, count(*) AS row_count,
           min(event_id) AS first_id, max(event_id) AS last_id
    FROM numbered GROUP BY ALL
    """
)
def page_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The keys that each page holds."""
    pages = _numbered_events(spark, sf_dir).groupBy(page_offset(STRIDE).alias("page_offset"))
    return pages.agg(
        F.count("*").alias("row_count"),
        F.min("event_id").alias("first_id"),
        F.max("event_id").alias("last_id"),
    )


@query(
    f"""
    SELECT event_id FROM (SELECT event_id, row_number() OVER (ORDER BY event_id) - 1 AS n FROM events)
    WHERE n % {STRIDE} < {STRIDE // 10}
    """
)
def page_scan_parity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A limit below the stride with one call for each page: the rest of a stride is never read."""
    within = F.col(ROW_NO) - page_offset(STRIDE)
    return _numbered_events(spark, sf_dir).filter(within < STRIDE // 10).select("event_id")


@query(f"SELECT *, ts + to_hours(user_id) AS updated FROM events WHERE {CHANGED}")
def delta_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changed_since(_events_with_update(spark, sf_dir), "ts", "updated", SINCE)


@query(
    """
    SELECT event_id, 'created' AS change, ts AS changed_at FROM events
    UNION ALL
    SELECT event_id, 'updated' AS change, ts + to_hours(user_id) AS changed_at FROM events
    """
)
def page_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _events_with_update(spark, sf_dir)
    schema = StructType().add("event_id", "long").add("change", "string")
    schema = schema.add("changed_at", "timestamp_ntz")

    def change(kind: str, at: str) -> Column:
        return F.struct(
            F.col("event_id").cast("string").alias("event_id"),
            F.lit(kind).alias("change"),
            F.col(at).cast("string").alias("changed_at"),
        )

    both = F.array(change("created", "ts"), change("updated", "updated"))
    answers = events.select(F.to_json(both).alias("body"))
    return coerce(flatten_pages(answers, "body", schema), schema)


@query("SELECT event_type, count(*) AS row_count FROM events GROUP BY event_type")
def json_element(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = table(spark, sf_dir, "events").groupBy("event_type").count()
    answer = F.to_json(F.array(F.struct(F.col("count").cast("string").alias("count"))))
    answers = counts.select("event_type", answer.alias("body"))
    return answers.select("event_type", first_count(F.col("body")).alias("row_count"))


@query(
    """
    SELECT event_id, strftime(ts, '%Y-%m-%d') AS run_date,
           strftime(ts::DATE - INTERVAL 2 DAY, '%Y-%m-%d') AS since
    FROM events
    """
)
def lookback_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = table(spark, sf_dir, "events").select(
        "event_id", F.date_format("ts", "yyyy-MM-dd").alias("run_date")
    )
    return runs.withColumn("since", since_column(F.col("run_date"), 2))


@query(
    """
    SELECT o_orderkey,
           'output/orders/' || year(o_orderdate) || '/' || month(o_orderdate) || '/'
               || day(o_orderdate) AS folder
    FROM orders
    """
)
def landing_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = landing_path_column("output", "orders", F.col("o_orderdate"))
    return table(spark, sf_dir, "orders").select("o_orderkey", folder.alias("folder"))


@query("SELECT * FROM events")
def landing_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    root = Workspace(spark).root
    land(events, root, "events", "2024-01-31")
    return coerce(read_landed(spark, root, "events", "2024-01-31", events.schema), events.schema)
