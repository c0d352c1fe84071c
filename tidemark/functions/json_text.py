"""Records held in JSON text: lists of them in pages, and single ones in lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.functions.casts import CORRUPT


def _list_only(text: Column) -> Column:
    """An error answer is a single object; taking it for a row would hide the error."""
    message = F.concat(F.lit("expected a JSON list, got: "), text)
    return F.when(F.ltrim(text).startswith("["), text).otherwise(F.raise_error(message))


def _variants(pages: DataFrame, text: str) -> DataFrame:
    """``record``: each record of each page, as a variant.

    Variants keep up to 38 digits of a number; a body is no larger than they may be.
    """
    records = F.parse_json(_list_only(F.col(text))).cast("array<variant>")
    return pages.select(F.explode(records).alias("record"))


def page_records(pages: DataFrame, text: str = "body") -> DataFrame:
    """``record``: the JSON text of each record of each page, with all its keys, on one line."""
    return _variants(pages, text).select(F.to_json("record").alias("record"))


def flatten_pages(pages: DataFrame, text: str, schema: StructType) -> DataFrame:
    """The declared columns, all text, of each record in each page; what is no object is corrupt."""
    fields = F.col("record").try_cast("map<string,string>")
    records = _variants(pages, text).withColumn("fields", fields)
    return records.select(
        *[F.col("fields")[field.name].alias(field.name) for field in schema],
        F.when(F.col("fields").isNull(), F.to_json("record")).alias(CORRUPT),
    )


def first_count(text: Column) -> Column:
    """The number in a count answer such as ``[{"count": "35"}]``."""
    rows = F.from_json(_list_only(text), "array<struct<count:string>>", {"mode": "FAILFAST"})
    return rows[0]["count"].cast("bigint")
