"""Merges into stored tables that write what has changed only."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemark.operators.merge import sort_batch, updated
from tidemark.operators.sizes import estimated_bytes
from tidemark.session import sized_for
from tidemark.sources.tables import StoredTable
from tidemark.workspace import Workspace


def merge_stored(
    table: StoredTable,
    source: DataFrame,
    keys: list[str],
    *,
    workspace: Workspace,
    keep_target: tuple[str, ...] = (),
    null_safe_keys: bool = False,
    mark: str | None = None,
    **options: object,
) -> int:
    """Merge the stored ``source`` into ``table``; returns the new version.

    The rules are those of ``merge``. Rows without a match, those with a null in the key
    included, are appended. Of a table of months, whose month column must be a key, only the
    months with a match are written anew; without months, the whole table if anything matches.
    ``options`` are those of ``sort_batch``.
    """
    monthly = table.month_of is not None
    # A match is always in the row's own month; without a month there is none.
    months = table.months_in(source) if monthly else None
    if monthly and not null_safe_keys:
        months = [month for month in months if month is not None]
    known = table.read(months)
    with sized_for(table.spark, estimated_bytes(known) + estimated_bytes(source)):
        batch = sort_batch(
            known, source, keys, workspace=workspace, null_safe_keys=null_safe_keys,
            source_is_stored=True, **options,
        )
        if batch.updates is None:
            return table.append(batch.inserts, mark=mark)
        if monthly:
            known = table.read(table.months_in(batch.matched))
        after = updated(known, batch, keys, keep_target=keep_target, null_safe_keys=null_safe_keys)
        if monthly:
            return table.replace_months(after, batch.inserts, mark=mark)
        return table.publish(after.unionAll(batch.inserts), mark=mark)
