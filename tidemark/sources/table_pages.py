"""A Spark table in the place of a remote dataset, page by page."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame

from tidemark.operators.changes import changed_since
from tidemark.operators.pages import number_rows, page_bodies
from tidemark.workspace import Workspace


@dataclass(frozen=True, eq=False)
class TablePages:
    """Rows in the order of ``row_id``, ``stride`` a page; ``hidden`` columns are not sent."""

    rows: DataFrame
    row_id: str
    created: str | None = None
    updated: str | None = None
    hidden: tuple[str, ...] = ()
    stride: int = 10_000

    def serving(self, rows: DataFrame) -> TablePages:
        return replace(self, rows=rows)

    def pages(self, since: str | None, workspace: Workspace) -> DataFrame:
        """``after, body`` of each page, of the rows changed since a date or of all."""
        rows = self.rows
        if since is not None:
            rows = changed_since(rows, self.created, self.updated, since)
        sent = [c for c in self.rows.columns if c not in self.hidden]
        return page_bodies(number_rows(rows, self.row_id, workspace), self.stride, sent)
