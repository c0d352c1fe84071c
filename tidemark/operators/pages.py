"""Pages of a table: rows numbered in the order of a key, and the pages they fall into."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.casts import quoted
from tidemark.workspace import Workspace

ROW_NO = "__row_no"
# ``monotonically_increasing_id`` keeps the partition above these bits and the row below.
_ROW_BITS = 33


def number_rows(df: DataFrame, row_id: str, workspace: Workspace) -> DataFrame:
    """``df`` with ``__row_no``, 0, 1, 2, … in the order of ``row_id``.

    Two passes: rows are sorted into ranges and written with their places there, then
    ranges are counted and the counts added up. Only those, a row for each range, meet in one task.
    """
    ordered = df.orderBy(quoted(row_id)).withColumn("__place", F.monotonically_increasing_id())
    held = workspace.store(ordered, "ordered")
    part = F.shiftright("__place", _ROW_BITS)
    counts = held.groupBy(part.alias("__part")).agg(F.count("*").alias("__rows"))
    earlier = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    first = F.coalesce(F.sum("__rows").over(earlier), F.lit(0)).alias("__first")
    starts = workspace.store(counts.select("__part", first), "starts")
    within = F.col("__place").bitwiseAND((1 << _ROW_BITS) - 1)
    # As many rows as ranges, which are tasks of one stage.
    numbered = held.withColumn("__part", part).join(F.broadcast(starts), "__part")
    return numbered.select(*[quoted(c) for c in df.columns], (F.col("__first") + within).alias(ROW_NO))


def page_offset(stride: int) -> Column:
    """Row number at which a numbered row's page starts."""
    return F.col(ROW_NO) - F.col(ROW_NO) % stride


def one_page(numbered: DataFrame, offset: int, limit: int) -> DataFrame:
    """The rows of one page: offset and limit as a filter, no further sort."""
    page = numbered.filter((F.col(ROW_NO) >= offset) & (F.col(ROW_NO) < offset + limit))
    return page.drop(ROW_NO)


def page_offsets(df: DataFrame, stride: int) -> DataFrame:
    """First row number of each page of ``df``; no pages where there are no rows."""
    return df.sparkSession.range(0, df.count(), stride).select(F.col("id").alias("page_offset"))


def page_bodies(numbered: DataFrame, stride: int, columns: list[str]) -> DataFrame:
    """The pages as a service sends them: ``body``, a JSON list of records all text, in order.

    Nulls are left out of a record. A page's rows meet in one task, ``stride`` of them at most.
    """
    record = F.to_json(F.struct(*[quoted(c).cast("string").alias(c) for c in columns]))
    rows = numbered.select(page_offset(stride).alias("offset"), F.struct(ROW_NO, record.alias("record")).alias("row"))
    pages = rows.groupBy("offset").agg(F.sort_array(F.collect_list("row"))["record"].alias("records"))
    body = F.concat(F.lit("["), F.array_join("records", ","), F.lit("]"))
    return pages.select(F.col("offset").cast("string").alias("after"), body.alias("body"))
