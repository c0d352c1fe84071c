"""Full and incremental loads.

    extract   remote pages -> dated landing folder
    stage     landing folder -> typed staging table (truncate and load)
    transform staging tables -> distinct, enriched rows
    merge     enriched rows -> target table

The full load builds the target anew and publishes it last, so that a failure
on the way leaves the old one in place. The incremental load re-reads only the
main dataset, from ``days_ago`` days back, or from the day of the last load that the
target's record names if that is earlier, so that missed runs lose nothing.
"""

from __future__ import annotations

import datetime as dt
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from tidemark.functions.casts import coerce, coerce_or_reject, quoted
from tidemark.functions.dates import as_date, since_date
from tidemark.operators.lookup import add_reference
from tidemark.operators.sizes import estimated_bytes
from tidemark.plans.merges import merge_stored
from tidemark.plans.spec import Dataset, LoadSpec
from tidemark.session import require_utc, sized_for
from tidemark.sources import paged
from tidemark.sources.landing import Drift, drift_of, land_pages, read_landed
from tidemark.sources.names import name_table, rename_table
from tidemark.sources.tables import MissingTable, StoredTable
from tidemark.workspace import Workspace

REJECT_SCHEMA = StructType(
    [StructField("record", StringType()), StructField("columns", StringType())]
)


@dataclass(frozen=True)
class LoadReport:
    """Of the rows loaded: those with a null in the key, which every load that reads
    them inserts again, and those left out because they could not be typed. And by dataset,
    how the keys of its records differ from its columns.
    """

    null_key_rows: int
    rejected_rows: int
    drift: dict[str, Drift] = field(default_factory=dict)


def _day(run_date: str | dt.date) -> str:
    return as_date(run_date).isoformat()


class Loader:
    """Loads of one ``LoadSpec``, with landing and tables under ``root``."""

    def __init__(self, spark: SparkSession, spec: LoadSpec, root: str):
        require_utc(spark)
        paged.register(spark)
        self.spark = spark
        self.spec = spec
        self.root = root.rstrip("/")
        self.target = StoredTable(
            spark, f"{self.root}/tables/{spec.target_name}", spec.target_schema, spec.month_of
        )

    def staging(self, dataset: Dataset) -> StoredTable:
        path = f"{self.root}/staging/{dataset.staging_name}"
        return StoredTable(self.spark, path, dataset.schema)

    def rejects(self, dataset: Dataset) -> StoredTable:
        path = f"{self.root}/staging/{dataset.staging_name}_rejects"
        return StoredTable(self.spark, path, REJECT_SCHEMA)

    def create_tables(self) -> None:
        """Staging and target tables, empty, in place of what there was."""
        for dataset in (self.spec.main, self.spec.reference):
            self.staging(dataset).create_empty()
        self.target.create_empty()
        self._refresh_views()

    def create_views(self) -> None:
        """Name the staging and target tables in the session's catalog, for use in Spark SQL.

        From then on each load turns the names to what it has published, whichever loader or
        session of the catalog runs it.
        """
        for name, stored in self._names():
            name_table(stored, name)

    def _names(self) -> list[tuple[str, StoredTable]]:
        datasets = (self.spec.main, self.spec.reference)
        staged = [(dataset.staging_name, self.staging(dataset)) for dataset in datasets]
        return [*staged, (self.spec.target_name, self.target)]

    def extract(
        self,
        dataset: Dataset,
        run_date: str | dt.date,
        days_ago: int | str | None = None,
        mark: str | None = None,
    ) -> str:
        """Land the dataset, or what changed since ``days_ago`` days before ``run_date`` or, if
        that is earlier, since the day ``mark``.
        """
        since = since_date(run_date, days_ago)
        if since is not None and mark is not None:
            since = min(since, mark)
        workspace = Workspace(self.spark)
        try:
            if dataset.table is not None:
                pages = dataset.table.pages(since, workspace)
            else:
                reader = self.spark.read.format(paged.FORMAT).options(**dataset.reader)
                pages = (reader if since is None else reader.option("since", since)).load()
            return land_pages(pages, f"{self.root}/landing", dataset.name, run_date)
        finally:
            workspace.drop()

    def stage(self, dataset: Dataset, run_date: str | dt.date) -> Drift:
        """Replace the staging table by the day's landed records."""
        landed = (self.spark, f"{self.root}/landing", dataset.name, run_date, dataset.schema)
        raw = read_landed(*landed)
        with sized_for(self.spark, estimated_bytes(raw)):
            drift = drift_of(*landed)
            if self.spec.strict:
                drift.check(dataset.name)
                self.staging(dataset).publish(coerce(raw, dataset.schema))
                return drift
            good, rejected = coerce_or_reject(raw, dataset.schema)
            self.staging(dataset).publish(good)
            self.rejects(dataset).publish(rejected)
            return drift

    def transform(self) -> DataFrame:
        """Staged rows without copies, with their reference value."""
        lookup = self.spec.lookup
        return add_reference(
            self.staging(self.spec.main).read().distinct(),
            self.staging(self.spec.reference).read(),
            lookup.column,
            lookup.reference_name,
            lookup.reference_value,
            lookup.value_field,
            self.spec.broadcast_limit,
            self.spec.worth_sparing,
        )

    def full_load(self, run_date: str | dt.date, concurrent: bool = True) -> LoadReport:
        """Rebuild staging and target; ``concurrent`` reads the two datasets side by side."""
        datasets = [self.spec.main, self.spec.reference]

        @inheritable_thread_target(self.spark)
        def extract_and_stage(dataset: Dataset) -> Drift:
            self.extract(dataset, run_date)
            return self.stage(dataset, run_date)

        with ThreadPoolExecutor(max_workers=2 if concurrent else 1) as threads:
            found = list(threads.map(extract_and_stage, datasets))
        drift = {dataset.name: own for dataset, own in zip(datasets, found)}
        # Merging into an empty target inserts every row.
        staged = [self.staging(dataset).read() for dataset in datasets]
        with sized_for(self.spark, sum(map(estimated_bytes, staged))):
            self.target.publish(self.transform(), mark=_day(run_date))
        self._refresh_views()
        return LoadReport(self._null_keys(self.target.read()), self._rejected(datasets), drift)

    def delta_load(
        self, run_date: str | dt.date, days_ago: int | str | None = 2
    ) -> LoadReport:
        """Merge recent changes into the target that a full load has left."""
        for table in (self.staging(self.spec.reference), self.target):
            if not table.exists():
                raise MissingTable(f"no table at {table.path}; run the full load first")
        last = self.target.mark()
        self.extract(self.spec.main, run_date, days_ago, last)
        drift = {self.spec.main.name: self.stage(self.spec.main, run_date)}
        # A run for an earlier day than the last does not take the mark back; one after
        # tables were created leaves none, as it has not read what came before its look-back.
        complete = since_date(run_date, days_ago) is None or last is not None
        null_keys = self.merge_staged(max(_day(run_date), last or "") if complete else None)
        self._refresh_views()
        return LoadReport(null_keys, self._rejected([self.spec.main]), drift)

    def _refresh_views(self) -> None:
        for name, stored in self._names():
            rename_table(stored, name)

    def merge_staged(self, mark: str | None = None) -> int:
        """Transform what is staged and merge it; returns its number of null-key rows.

        ``mark`` is the day up to which the target is complete then.
        """
        workspace = Workspace(self.spark)
        staged = self.staging(self.spec.main).read()
        try:
            with sized_for(self.spark, estimated_bytes(staged)):
                columns = [quoted(c) for c in self.spec.target_columns]
                source = workspace.store(self.transform().select(*columns), "enriched")
            if source.isEmpty():
                if mark is not None and mark != self.target.mark():
                    self.target.set_mark(mark)
            else:
                merge_stored(
                    self.target,
                    source,
                    list(self.spec.keys),
                    workspace=workspace,
                    keep_target=self.spec.keep_target,
                    null_safe_keys=self.spec.null_safe_keys,
                    mark=mark,
                    broadcast_limit=self.spec.broadcast_limit,
                    worth_sparing=self.spec.worth_sparing,
                )
            return self._null_keys(source)
        finally:
            workspace.drop()

    def _null_keys(self, df: DataFrame) -> int:
        any_null = reduce(Column.__or__, [quoted(k).isNull() for k in self.spec.keys])
        return df.filter(any_null).count()

    def _rejected(self, datasets: list[Dataset]) -> int:
        if self.spec.strict:
            return 0
        return sum(self.rejects(dataset).read().count() for dataset in datasets)
