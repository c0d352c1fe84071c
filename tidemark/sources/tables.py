"""Stored tables: plain parquet folders with safe replacement."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark import storage
from tidemark.functions.casts import quoted
from tidemark.session import require_utc

MONTH = "load_month"
NO_MONTH = "__HIVE_DEFAULT_PARTITION__"  # Spark's folder of rows without a month
WHOLE = ""
# Entries of a commit record.
FOLDERS = "folders"
MARK = "mark"
# A month in more folders than this is written anew, into one.
SEGMENTS = 16


class MissingTable(LookupError):
    """A load needs a table that no earlier load has made."""


class StoredTable:
    """A table whose content is what its newest commit record lists.

    A version is a folder of files and, once they are written, a small record that
    names the folders the table consists of. Folders never change and readers follow
    the newest record, so a run that dies at any point leaves the table wholly old or
    wholly new. One writer at a time.

    With ``month_of``, folders hold one month of that column each. ``replace_months``
    writes single months, and its record takes the other months over from the one
    before: for tables too large to copy on every load. ``append`` writes its own rows only:
    the record then lists several folders of a month, or of a table without months, until
    there are more than ``SEGMENTS``.
    """

    def __init__(
        self, spark: SparkSession, path: str, schema: StructType, month_of: str | None = None
    ):
        if month_of:
            require_utc(spark)
        self.spark = spark
        self.path = path.rstrip("/")
        self.schema = schema
        self.month_of = month_of

    def versions(self) -> list[int]:
        names = storage.child_names(self.spark, self._records())
        return [int(name[:-5]) for name in names if name.endswith(".json") and name[:-5].isdigit()]

    def exists(self) -> bool:
        return bool(self.versions())

    def read(self, months: list[str | None] | None = None) -> DataFrame:
        """The table, or only some months of it; folders of other months stay unread."""
        folders = self._current()
        if months is not None:
            wanted = {month or NO_MONTH for month in months}
            folders = {month: held for month, held in folders.items() if month in wanted}
        return self._scan(folders)

    def folders(self) -> list[str]:
        """Paths of the folders that hold the content."""
        return self._paths(self._current())

    def publish(self, df: DataFrame, keep: int = 2, mark: str | None = None) -> int:
        """Make ``df`` the content, bound by column name; creates the table if needed.

        The ``keep`` newest versions stay, for readers that have started on one of them.
        ``mark`` goes into the record: the day up to which the content is complete.
        """
        return self._commit({}, df, None, keep, mark)

    def mark(self) -> str | None:
        """The mark of the newest record."""
        versions = self.versions()
        return self._content(versions[-1])[MARK] if versions else None

    def set_mark(self, mark: str, keep: int = 2) -> int:
        """A new version of the same content with another mark."""
        return self._put_record(self._next(), self._current(), keep, mark)

    def create_empty(self) -> int:
        return self.publish(self.spark.createDataFrame([], self.schema))

    def months_in(self, df: DataFrame) -> list[str | None]:
        """Months present in ``df``: bounded by the calendar, however large the data."""
        return [row[0] for row in df.select(self._month().alias(MONTH)).distinct().collect()]

    def replace_months(
        self, df: DataFrame, added: DataFrame | None = None, keep: int = 2, mark: str | None = None
    ) -> int:
        """A new version in which every month that occurs in ``df`` is that of ``df``.

        The rows of ``added`` then come in addition.
        """
        return self._commit(self._current(), df, added, keep, mark)

    def append(self, df: DataFrame, keep: int = 2, mark: str | None = None) -> int:
        """A new version with the rows of ``df`` in addition; no other row is written."""
        return self._commit(self._current(), None, df, keep, mark)

    def _next(self) -> int:
        return max(self._numbers() + self.versions(), default=0) + 1

    def _commit(
        self,
        others: dict[str, list[str]],
        replaced: DataFrame | None,
        added: DataFrame | None,
        keep: int,
        mark: str | None,
    ) -> int:
        folders, last = dict(others), self._next() - 1
        if replaced is not None:
            last += 1
            folders.update({month: [folder] for month, folder in self._write(replaced, last).items()})
        if added is not None:
            last += 1
            for month, folder in self._write(added, last).items():
                folders[month] = [*folders.get(month, []), folder]
        many = {month: held for month, held in folders.items() if len(held) > SEGMENTS}
        if many:
            last += 1
            whole = self._write(self._scan(many), last)
            folders.update({month: [folder] for month, folder in whole.items()})
        return self._put_record(last, folders, keep, mark)

    def _put_record(self, version: int, folders: dict[str, list[str]], keep: int, mark: str | None) -> int:
        record = json.dumps({FOLDERS: folders, MARK: mark}, sort_keys=True)
        storage.put_text(self.spark, self._record(version), record)
        self._clean(keep)
        return version

    def _clean(self, keep: int) -> None:
        """Drop old records, then folders no record names: replaced ones and those of dead writes."""
        versions = self.versions()
        for old in versions[:-keep]:
            storage.delete(self.spark, self._record(old))
        used = {
            folder
            for version in versions[-keep:]
            for held in self._folders(version).values()
            for folder in held
        }
        for number in self._numbers():
            folder = f"v{number:08d}"
            held = [name for name in used if name.split("/")[0] == folder]
            if not held:
                storage.delete(self.spark, f"{self.path}/{folder}")
            elif held != [folder]:
                for name in storage.child_names(self.spark, f"{self.path}/{folder}"):
                    if name.startswith(f"{MONTH}=") and f"{folder}/{name}" not in used:
                        storage.delete(self.spark, f"{self.path}/{folder}/{name}")

    def _numbers(self) -> list[int]:
        names = storage.child_names(self.spark, self.path)
        return [int(name[1:]) for name in names if name[0] == "v" and name[1:].isdigit()]

    def _records(self) -> str:
        return f"{self.path}/_records"

    def _record(self, version: int) -> str:
        return f"{self._records()}/{version:08d}.json"

    def _folders(self, version: int) -> dict[str, list[str]]:
        """Folders by month; without months all are under one name. Bounded by the calendar."""
        return self._content(version)[FOLDERS]

    def _content(self, version: int) -> dict:
        record = json.loads(storage.read_text(self.spark, self._record(version)))
        # Records once held the folders alone, and one of each month.
        record = record if FOLDERS in record else {FOLDERS: record, MARK: None}
        folders = {month: [held] if isinstance(held, str) else held for month, held in record[FOLDERS].items()}
        return {**record, FOLDERS: folders}

    def _current(self) -> dict[str, list[str]]:
        versions = self.versions()
        if not versions:
            raise MissingTable(f"no table at {self.path}; run the full load first")
        return self._folders(versions[-1])

    def _month(self) -> Column:
        return F.date_format(quoted(self.month_of), "yyyy-MM")

    def _paths(self, folders: dict[str, list[str]]) -> list[str]:
        return [f"{self.path}/{folder}" for held in folders.values() for folder in held]

    def _scan(self, folders: dict[str, list[str]]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*self._paths(folders))

    def _write(self, df: DataFrame, number: int) -> dict[str, str]:
        """Write ``df`` to the folder of that number; returns the folders by month."""
        folder = f"v{number:08d}"
        path = f"{self.path}/{folder}"
        columns = [quoted(c) for c in self.schema.names]
        if self.month_of is None:
            df.select(*columns).write.parquet(path)
            return {WHOLE: folder}
        # One month may hold much of the table: rebalance splits it over several tasks.
        by_month = df.select(*columns, self._month().alias(MONTH)).hint("rebalance", MONTH)
        by_month.write.partitionBy(MONTH).parquet(path)
        names = storage.child_names(self.spark, path)
        months = [name for name in names if name.startswith(f"{MONTH}=")]
        return {name[len(MONTH) + 1 :]: f"{folder}/{name}" for name in months}
