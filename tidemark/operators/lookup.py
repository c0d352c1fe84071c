"""Add a value from a reference table, as a nested column."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.casts import quoted
from tidemark.operators.sizes import BROADCAST_LIMIT, broadcast_if, fits_broadcast


def reference_values(reference: DataFrame, name: str, value: str) -> DataFrame:
    """Distinct (name, value) pairs, columns renamed to ``name`` and ``value``."""
    return reference.select(quoted(name).alias("name"), quoted(value).alias("value")).distinct()


def add_reference(
    main: DataFrame,
    reference: DataFrame,
    column: str,
    reference_name: str,
    reference_value: str,
    value_field: str,
    broadcast_limit: int = BROADCAST_LIMIT,
    worth_sparing: int | None = None,
) -> DataFrame:
    """Turn text column ``column`` into struct<``column``, ``value_field``>, in place.

    Left outer: a row without a match keeps a struct whose value is null. A name
    with two values gives two rows.

    A reference whose measured size is within the limit is broadcast, so that a
    ``main`` of ``worth_sparing`` bytes or more is not moved. Otherwise Spark chooses; in a shuffled join,
    adaptive execution splits the partition of a name, or of null, that holds
    much of ``main``.
    """
    raw = reference.select(quoted(reference_name), quoted(reference_value))
    # Measured before duplicates go: a scan without a shuffle, and still an upper bound.
    small = fits_broadcast(raw, main, broadcast_limit, worth_sparing)
    pairs = reference_values(reference, reference_name, reference_value)
    pairs = pairs.select(F.col("name").alias("__name"), F.col("value").alias("__value"))
    joined = main.join(broadcast_if(pairs, small), quoted(column) == F.col("__name"), "left")
    nested = F.struct(quoted(column).alias(column), F.col("__value").alias(value_field))
    return joined.select(
        *[nested.alias(c) if c == column else quoted(c) for c in main.columns]
    )
