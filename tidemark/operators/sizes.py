"""Measured bounds for what may be broadcast."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    CalendarIntervalType,
    DataType,
    DecimalType,
    MapType,
    StringType,
    StructType,
    VariantType,
)

from tidemark.functions.casts import quoted

BROADCAST_LIMIT = 64 * 1024 * 1024
# Below this, shuffling a side costs less than measuring the other one.
WORTH_SPARING = 64 * 1024 * 1024
_WORD = 8


def _variable_bytes(value: Column, kind: DataType) -> Column | None:
    """Bytes beyond the fixed slot; None where no bound is worked out."""
    if isinstance(kind, (ArrayType, MapType, VariantType)):
        return None
    if isinstance(kind, (StringType, BinaryType)):
        return F.coalesce(F.octet_length(value), F.lit(0)) + _WORD
    if isinstance(kind, StructType):
        parts = [_variable_bytes(value[field.name], field.dataType) for field in kind]
        if any(part is None for part in parts):
            return None
        return sum(parts, F.lit(_WORD * (len(parts) + 1)))
    if isinstance(kind, (DecimalType, CalendarIntervalType)):
        return F.lit(2 * _WORD)
    return F.lit(0)


def measured_bytes(df: DataFrame) -> int | None:
    """Upper bound on the rows' size in memory, from one aggregation over them."""
    parts = [_variable_bytes(quoted(field.name), field.dataType) for field in df.schema]
    if any(part is None for part in parts):
        return None
    per_row = sum(parts, F.lit(_WORD * (len(parts) + 2))).cast("bigint")
    return df.agg(F.coalesce(F.sum(per_row), F.lit(0)).alias("bytes")).first()["bytes"]


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's own estimate; for a scan, the size of its files."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def fits_broadcast(
    df: DataFrame,
    to_spare: DataFrame,
    limit: int = BROADCAST_LIMIT,
    worth_sparing: int | None = None,
) -> bool:
    """True if ``df`` is to be broadcast so that ``to_spare`` need not be shuffled.

    Its measured size must be within ``limit`` and below that of the side spared, which
    must have ``worth_sparing`` bytes (``WORTH_SPARING``) for the measuring to pay.
    Estimates come first: they save measuring where the answer is plain.
    """
    spared = estimated_bytes(to_spare)
    least = WORTH_SPARING if worth_sparing is None else worth_sparing
    if spared < least or estimated_bytes(df) > limit:
        return False
    size = measured_bytes(df)
    return size is not None and size <= min(limit, spared)


def broadcast_if(df: DataFrame, small: bool) -> DataFrame:
    """Marked for broadcast, or left for a shuffled join."""
    return F.broadcast(df) if small else df
