"""Mixing sources to target weights, exactly and by SQL functions only.

Documents get a key that is random but fixed: a hash of a seed and the id. They are sorted by
source and key into ranges, each range is summed, and sums of ranges give every document the
number of words that its source has before it. What a source is to give is cut there: as many
whole epochs as fit, then documents in the order of their keys up to the budget, the last of
them in part.

Running sums are made in two steps, within ranges and over the sums of ranges, so that no task
holds more of a source than one range. Equal keys do not defeat this, since a row number breaks
ties. Sources are ranked and their caps summed in the same way, as there may be many.

A target is ``weight * level``, or the cap of ``repeats`` times the source's size if that is
less. The level is where targets add up to the share; the capped sources are those with the
least cap for their weight, so one running sum over the sources in that order finds them.

Defined results: a null text has no words; a null source is one of its own, the last; rows of a
null or repeated id count each, and equal ones are interchangeable; without words all targets
are 0; an empty table gives an empty table. Columns other than id, source and text are carried
along if ``keep`` names them.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.casts import quoted
from tidemark.workspace import Workspace


@dataclass(frozen=True)
class Settings:
    #: Weights of the sources in their order, over and over.
    weights: tuple[int, ...] = (3, 1, 2)
    #: Words of the mix as a share of all words, in hundredths.
    percent: int = 150
    #: No document is taken more often than this; at least ``percent`` hundredths.
    repeats: int = 2
    seed: str = "mix"
    #: Rows that one range is to hold.
    range_rows: int = 2_000_000

    def __post_init__(self):
        if self.percent > 100 * self.repeats or min(self.weights) < 1:
            raise ValueError("need positive weights, and percent within repeats")


def n_words(text: Column) -> Column:
    """Words, runs of other characters than blanks: one mark for each, counted."""
    marks = F.regexp_replace(text, r"[^\x20\x09-\x0D]++", "x")
    count = F.length(F.translate(marks, " \t\n\x0b\x0c\r", ""))
    return F.coalesce(count, F.lit(0)).cast("bigint")


def running_sums(
    rows: DataFrame,
    group: list[str],
    order: Sequence[Column],
    sums: dict[str, str],
    workspace: Workspace,
    range_rows: int,
    of_group: DataFrame | None = None,
) -> DataFrame:
    """``rows`` with, for each name in ``sums``, the sum of its column over earlier rows of the group.

    ``order`` must tell apart the rows of a group, and ``group`` hold no nulls. A group may be
    spread over many ranges. Columns of ``of_group``, a row for each group, are added on the way:
    they join the few sums of ranges, not the rows of what may be one large group.
    """
    count = rows.count()
    least = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = max(1, -(-count // range_rows), min(least, count))
    dealt = rows.repartitionByRange(ranges, *[F.col(c) for c in group], *order)
    held = workspace.store(dealt.withColumn("__range", F.spark_partition_id()), "ranges")
    parts = held.groupBy(*group, "__range").agg(*[F.sum(c).alias(f"__{n}") for n, c in sums.items()])
    if of_group is not None:
        parts = parts.join(of_group, group)
    added = [] if of_group is None else [c for c in of_group.columns if c not in group]
    # A group has at most one row for each range.
    earlier = Window.partitionBy(*group).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    starts = [F.coalesce(F.sum(f"__{n}").over(earlier), F.lit(0)).alias(f"__{n}") for n in sums]
    starts = workspace.store(parts.select(*group, "__range", *added, *starts), "starts")
    own = Window.partitionBy(*group, "__range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    within = held.select("*", *[F.coalesce(F.sum(c).over(own), F.lit(0)).alias(n) for n, c in sums.items()])
    totals = [(F.col(n) + F.col(f"__{n}")).alias(n) for n in sums]
    return within.join(starts, [*group, "__range"]).select(*rows.columns, *added, *totals)


def source_targets(sizes: DataFrame, workspace: Workspace, settings: Settings = Settings()) -> DataFrame:
    """``sizes`` (``no_source``, ``source``, ``source_size``, a row each) with ``target`` and ``budget``."""
    one = sizes.withColumn("one", F.lit(1).cast("bigint")).withColumn("all", F.lit(0))
    by_name = [F.col("no_source"), F.col("source")]
    ranked = running_sums(one, ["all"], by_name, {"place": "one"}, workspace, settings.range_rows)
    weights = F.array(*[F.lit(w) for w in settings.weights])
    weight = weights[(F.col("place") % len(settings.weights)).cast("int")].cast("decimal(38,0)")
    # In hundredths, so that a share of all words is a whole number.
    cap = F.col("source_size").cast("decimal(38,0)") * (100 * settings.repeats)
    weighed = workspace.store(
        ranked.select("*", weight.alias("weight"), cap.cast("decimal(38,0)").alias("cap")), "weighed"
    )
    # Cap for weight, as whole numbers.
    by_cap = [F.col("cap") * (F.lit(math.lcm(*settings.weights)) / F.col("weight")).cast("int"), F.col("place")]
    before = {"cap_before": "cap", "weight_before": "weight"}
    summed = running_sums(weighed, ["all"], by_cap, before, workspace, settings.range_rows)
    total = weighed.agg(F.sum("source_size").alias("size"), F.sum("weight").alias("weight")).first()
    share, all_weights = settings.percent * int(total["size"] or 0), int(total["weight"] or 0)
    # Capped: at the level of those not capped before it, the source would get its cap or more.
    rest = F.lit(float(share)) - F.col("cap_before").cast("double")
    open_weight = F.lit(float(all_weights)) - F.col("weight_before").cast("double")
    full = F.col("cap").cast("double") * open_weight <= F.col("weight").cast("double") * rest
    flagged = workspace.store(summed.withColumn("full", full), "flagged")
    closed = flagged.filter("full").agg(F.sum("cap").alias("cap"), F.sum("weight").alias("weight")).first()
    left = float(share - int(closed["cap"] or 0))
    open_weights = float(all_weights - int(closed["weight"] or 0))
    by_level = F.col("weight").cast("double") * left / F.lit(open_weights or 1.0) / 100.0
    most = F.col("source_size") * settings.repeats
    target = F.when(F.col("full"), most.cast("double")).otherwise(by_level).alias("target")
    # A budget is whole words; a target that is a whole number but for rounding stays one.
    budget = F.least(F.floor(F.col("target") + 1e-6), most).alias("budget")
    return flagged.select("no_source", "source", "source_size", target).select("*", budget)


def mix(
    docs: DataFrame,
    workspace: Workspace,
    settings: Settings = Settings(),
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    keep: Sequence[str] = (),
) -> DataFrame:
    """Per document: ``id_col``, ``size`` in words, ``source_size``, its source's ``target`` and
    the words ``taken`` of it, repeats counted: whole epochs, and of the last its first words.
    """
    carried = [quoted(c).alias(f"__{n}") for n, c in enumerate(keep)]
    id_text = F.coalesce(quoted(id_col).cast("string"), F.lit(""))
    rows = docs.select(
        quoted(id_col).alias("id"),
        quoted(source_col).isNull().alias("no_source"),
        F.coalesce(quoted(source_col).cast("string"), F.lit("")).alias("source"),
        n_words(quoted(text_col)).alias("size"),
        F.md5(F.concat(F.lit(f"{settings.seed}:"), id_text)).alias("key"),
        F.monotonically_increasing_id().alias("row"),
        *carried,
    )
    held = workspace.store(rows, "sizes")
    by_source = ["no_source", "source"]
    sizes = workspace.store(held.groupBy(*by_source).agg(F.sum("size").alias("source_size")), "sources")
    targets = workspace.store(source_targets(sizes, workspace, settings), "targets")
    order = [F.col(c) for c in ("key", "id", "size", "row")]
    placed = running_sums(held, by_source, order, {"before": "size"}, workspace, settings.range_rows, targets)
    epochs = F.floor(F.col("budget") / F.greatest(F.col("source_size"), F.lit(1)))
    rest = F.col("budget") - epochs * F.col("source_size")
    part = F.least(F.greatest(rest - F.col("before"), F.lit(0)), F.col("size"))
    return placed.select(
        F.col("id").alias(id_col), "size", "source_size", "target",
        (epochs * F.col("size") + part).cast("bigint").alias("taken"),
        *[F.col(f"__{n}").alias(c) for n, c in enumerate(keep)],
    )
