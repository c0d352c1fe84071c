"""MERGE for plain files: update matched rows, insert the rest, delete nothing.

A full outer join would do it in one step, but it can neither broadcast a small
batch nor split a key that holds much of the data. So rows are classified first:
the keys present on both sides are counted (pre-aggregated before the shuffle)
and stored. Updates then join the target, one row per key, and the other source
rows are appended. Every join has a plain scan on the side that may be skewed,
which lets adaptive execution split it, and a unique side opposite.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.casts import quoted
from tidemark.operators.sizes import BROADCAST_LIMIT, broadcast_if, fits_broadcast
from tidemark.workspace import Workspace


class MultipleMatchError(ValueError):
    """A target row is matched by more than one source row."""


def _any_null(keys: list[str]) -> Column:
    return reduce(Column.__or__, [quoted(k).isNull() for k in keys])


def _same_key(keys: list[str], prefix: str, null_safe: bool) -> Column:
    tests = []
    for k in keys:
        other = quoted(prefix + k)
        tests.append(quoted(k).eqNullSafe(other) if null_safe else quoted(k) == other)
    return reduce(Column.__and__, tests)


def _prefixed(df: DataFrame, columns: list[str], prefix: str) -> DataFrame:
    return df.select(*[quoted(c).alias(prefix + c) for c in columns])


def shared_keys(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    null_safe_keys: bool = False,
    broadcast_limit: int = BROADCAST_LIMIT,
    source_is_small: bool = False,
    worth_sparing: int | None = None,
) -> DataFrame:
    """Keys on both sides, with the number of source rows that carry each.

    ``source_is_small``: already measured to be within ``broadcast_limit``.
    """
    ours = target.select(*[quoted(k) for k in keys])
    theirs = source.select(*[quoted(k) for k in keys])
    if not null_safe_keys:
        ours, theirs = ours.filter(~_any_null(keys)), theirs.filter(~_any_null(keys))
    if source_is_small or fits_broadcast(theirs, ours, broadcast_limit, worth_sparing):
        # Only target keys that the batch mentions need to be shuffled.
        batch = F.broadcast(_prefixed(theirs, keys, "__"))
        ours = ours.join(batch, _same_key(keys, "__", null_safe_keys), "left_semi")
    both = ours.select("*", F.lit(0).alias("__n"), F.lit(True).alias("__hit")).unionAll(
        theirs.select("*", F.lit(1).alias("__n"), F.lit(False).alias("__hit"))
    )
    counts = both.groupBy(*[quoted(k) for k in keys]).agg(
        F.sum("__n").alias("source_rows"), F.max("__hit").alias("__hit")
    )
    return counts.filter((F.col("source_rows") > 0) & F.col("__hit")).drop("__hit")


def multi_match_keys(
    target: DataFrame, source: DataFrame, keys: list[str], **options
) -> DataFrame:
    """Keys that ``merge`` would refuse."""
    return shared_keys(target, source, keys, **options).filter(F.col("source_rows") > 1)


@dataclass(frozen=True)
class SortedBatch:
    """A source as seen from a target: what it updates there, and what comes in addition.

    ``matched`` holds the keys of both, ``small`` tells that the updates are to be broadcast.
    """

    matched: DataFrame
    updates: DataFrame | None
    inserts: DataFrame
    small: bool = False


def sort_batch(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    *,
    workspace: Workspace,
    null_safe_keys: bool = False,
    source_is_stored: bool = False,
    broadcast_limit: int = BROADCAST_LIMIT,
    worth_sparing: int | None = None,
) -> SortedBatch:
    """``source``, in the columns of ``target``, as updates and inserts.

    Of the target only the keys are read. Without a match there are no ``updates``.
    """
    source = source.select(
        *[quoted(f.name).cast(f.dataType).alias(f.name) for f in target.schema]
    )
    if not source_is_stored:
        source = workspace.store(source, "source")

    # A batch that fits a broadcast bounds its keys and its updates as well.
    small = fits_broadcast(source, target, broadcast_limit, worth_sparing)
    matched = workspace.store(
        shared_keys(target, source, keys, null_safe_keys, broadcast_limit, small, worth_sparing),
        "matched",
    )
    hits, most = matched.agg(F.count("*"), F.max("source_rows")).first()
    if not hits:
        return SortedBatch(matched, None, source)
    if most > 1:
        some = matched.filter(F.col("source_rows") > 1).limit(5).collect()
        named = "; ".join(str(row.asDict()) for row in some)
        raise MultipleMatchError(f"several source rows match one target row: {named}")

    keyed = source if null_safe_keys else source.filter(~_any_null(keys))
    hit_keys = _prefixed(matched, keys, "__")
    fits = small or fits_broadcast(hit_keys, keyed, broadcast_limit, worth_sparing)
    hit_keys = broadcast_if(hit_keys, fits)
    hit = _same_key(keys, "__", null_safe_keys)
    updates = keyed.join(hit_keys, hit, "left_semi")
    inserts = keyed.join(hit_keys, hit, "left_anti")
    if not null_safe_keys:
        inserts = inserts.unionAll(source.filter(_any_null(keys)))

    if not small:
        updates = workspace.store(updates, "updates")
        small = fits_broadcast(updates, target, broadcast_limit, worth_sparing)
    return SortedBatch(matched, updates, inserts, small)


def updated(
    target: DataFrame,
    batch: SortedBatch,
    keys: list[str],
    *,
    keep_target: tuple[str, ...] = (),
    null_safe_keys: bool = False,
) -> DataFrame:
    """All rows of ``target``, or of a part that holds all matches, with the batch's updates."""
    if batch.updates is None:
        return target
    columns = target.columns
    new = _prefixed(batch.updates, columns, "__new_").withColumn("__hit", F.lit(True))
    new = broadcast_if(new, batch.small)
    untouched = None
    if not batch.small and not null_safe_keys:
        # Null-key rows match nothing; shuffled, they would all meet in one partition.
        untouched = target.filter(_any_null(keys))
        target = target.filter(~_any_null(keys))
    is_hit = F.col("__hit").isNotNull()
    result = target.join(new, _same_key(keys, "__new_", null_safe_keys), "left").select(
        *[
            quoted(c)
            if c in keep_target
            else F.when(is_hit, quoted(f"__new_{c}")).otherwise(quoted(c)).alias(c)
            for c in columns
        ]
    )
    return result if untouched is None else result.unionAll(untouched)


def merge(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    *,
    keep_target: tuple[str, ...] = (),
    null_safe_keys: bool = False,
    **options: object,
) -> DataFrame:
    """The target after the merge, columns as in ``target``, bound by name.

    Matched rows take every source value, nulls included, but for the columns in
    ``keep_target``. Source rows without a match are inserted; target rows
    without one stay. A null in a key matches nothing, so such a source row is
    inserted on every run, unless ``null_safe_keys``.

    A side within ``broadcast_limit`` is broadcast to spare another of ``worth_sparing``
    bytes or more its shuffle. These and the other ``options`` are those of ``sort_batch``.

    ``target`` should be a scan: it is read more than once. The result reads
    intermediate tables, so drop the workspace only after using it.
    """
    batch = sort_batch(target, source, keys, null_safe_keys=null_safe_keys, **options)
    after = updated(target, batch, keys, keep_target=keep_target, null_safe_keys=null_safe_keys)
    return after.unionAll(batch.inserts)
