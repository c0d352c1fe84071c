"""Landing zone: one folder per source and day, one JSON record per line."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidemark.functions.casts import CORRUPT, text_schema
from tidemark.functions.dates import landing_path
from tidemark.functions.json_text import page_records

# Microseconds; the JSON writer's own default stops at milliseconds.
TIMESTAMP_TEXT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
# Keys that start so are the service's own.
SYSTEM_PREFIX = ":"


def land(df: DataFrame, root: str, name: str, run_date: str | dt.date) -> str:
    """Write the day's rows as records, replacing those of an earlier run that day."""
    path = landing_path(root, name, run_date)
    writer = df.write.mode("overwrite")
    writer = writer.option("timestampFormat", TIMESTAMP_TEXT + "XXX")
    writer.option("timestampNTZFormat", TIMESTAMP_TEXT).json(path)
    return path


def land_pages(pages: DataFrame, root: str, name: str, run_date: str | dt.date) -> str:
    """Write the records of the day's pages with all that was sent, replacing an earlier run's."""
    path = landing_path(root, name, run_date)
    page_records(pages).write.mode("overwrite").text(path)
    return path


def read_landed(
    spark: SparkSession, root: str, name: str, run_date: str | dt.date, schema: StructType
) -> DataFrame:
    """All records of a source and day, as text.

    Reading quoted numbers straight into number columns would turn them to null
    without an error, so typing is a separate step. A line that is no JSON object
    shows up in the corrupt-record column.
    """
    fields = [*text_schema(schema).fields, StructField(CORRUPT, StringType())]
    reader = spark.read.schema(StructType(fields)).option("columnNameOfCorruptRecord", CORRUPT)
    return reader.json(landing_path(root, name, run_date))


class DriftError(ValueError):
    """Records have lost a declared key and come with others."""


@dataclass(frozen=True)
class Drift:
    """Keys that records have and the schema does not, and declared ones that no record has."""

    undeclared: tuple[str, ...] = ()
    absent: tuple[str, ...] = ()

    def check(self, name: str) -> None:
        """A service leaves out nulls, so an absent key alone may be a column without values;
        together with a key that is new it is taken for a change of the dataset.
        """
        if self.absent and self.undeclared:
            raise DriftError(f"{name}: no record has {self.absent}, but records have {self.undeclared}")


def drift_of(
    spark: SparkSession, root: str, name: str, run_date: str | dt.date, schema: StructType
) -> Drift:
    """How the keys of a day's landed records differ from the declared columns."""
    lines = spark.read.text(landing_path(root, name, run_date))
    keys = lines.select(F.explode(F.json_object_keys("value")).alias("key")).distinct()
    found = {row["key"] for row in keys.collect()}  # as many as there are different keys
    if not found:
        return Drift()
    unknown = {key for key in found - set(schema.names) if not key.startswith(SYSTEM_PREFIX)}
    return Drift(tuple(sorted(unknown)), tuple(c for c in schema.names if c not in found))
