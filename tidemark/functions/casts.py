"""From all-text records to declared types."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType, StructField, StructType

CORRUPT = "_corrupt_record"


def quoted(name: str) -> Column:
    return F.col(f"`{name}`")


def text_schema(schema: StructType) -> StructType:
    """The same columns, all text: the form in which records are landed."""
    return StructType([StructField(field.name, StringType()) for field in schema])


def _unreadable(name: str, kind: DataType) -> Column:
    return quoted(name).isNotNull() & quoted(name).try_cast(kind).isNull()


def _refusal(name: str, kind: DataType) -> Column:
    return F.concat(
        F.lit(f"column {name}: cannot read '"),
        quoted(name),
        F.lit(f"' as {kind.simpleString()}"),
    )


def _value(field: StructField) -> Column:
    """The value, cast once; text that cannot be read is an error."""
    text = quoted(field.name)
    if isinstance(field.dataType, StringType):
        return text.alias(field.name)
    refused = F.raise_error(_refusal(field.name, field.dataType)).cast(field.dataType)
    read = F.coalesce(text.try_cast(field.dataType), F.when(text.isNotNull(), refused))
    return read.alias(field.name)


def coerce(raw: DataFrame, schema: StructType) -> DataFrame:
    """Strict form: any unreadable line or value is an error.

    The values are made as one struct, so each of them is checked whichever columns are used
    later, and the check does not lean on ANSI mode, which a session may have turned off.
    """
    if CORRUPT in raw.columns:
        broken = quoted(CORRUPT).isNotNull()
        message = F.concat(F.lit("unreadable line: "), quoted(CORRUPT))
        raw = raw.filter(F.when(broken, F.raise_error(message).cast("boolean")).otherwise(True))
    return raw.select(F.inline(F.array(F.struct(*[_value(field) for field in schema]))))


def coerce_or_reject(raw: DataFrame, schema: StructType) -> tuple[DataFrame, DataFrame]:
    """Permissive form: ``(typed rows, rejected records)``.

    A record is rejected whole. Rejects keep the record's text and the names of
    the columns that could not be read.
    """
    typed = [field for field in schema if not isinstance(field.dataType, StringType)]
    faults = [
        F.when(_unreadable(field.name, field.dataType), F.lit(field.name)) for field in typed
    ]
    text = F.to_json(F.struct(*[quoted(field.name) for field in schema]))
    broken = F.lit(False)
    if CORRUPT in raw.columns:
        broken = quoted(CORRUPT).isNotNull()
        faults.append(F.when(broken, F.lit(CORRUPT)))
        text = F.coalesce(quoted(CORRUPT), text)
    unreadable = [_unreadable(field.name, field.dataType) for field in typed]
    bad = reduce(Column.__or__, unreadable, broken)
    good = raw.filter(~bad).select(
        *[quoted(field.name).try_cast(field.dataType).alias(field.name) for field in schema]
    )
    rejects = raw.filter(bad).select(
        text.alias("record"),
        F.array_join(F.array_compact(F.array(*faults)), ",").alias("columns"),
    )
    return good, rejects
