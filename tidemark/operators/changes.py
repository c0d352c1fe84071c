"""The incremental filter."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.casts import quoted


def changed_since(df: DataFrame, created: str, updated: str, since: str) -> DataFrame:
    """Rows created or updated on or after ``since``; there is no upper bound."""
    # A typed literal keeps the comparison on the column's own type, so it can be pushed down.
    created_from = F.lit(since).cast(df.schema[created].dataType)
    updated_from = F.lit(since).cast(df.schema[updated].dataType)
    return df.filter((quoted(created) >= created_from) | (quoted(updated) >= updated_from))
