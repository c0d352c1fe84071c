"""Near duplicates by MinHash: one-permutation sketches, banded buckets, star edges.

A document's set is its distinct word shingles. One permutation deals the set's
hashes to bins and keeps the least of each; an empty bin takes the value of a bin
chosen by a hash of its own number (optimal densification). Bins are read in
bands, and documents that agree on a band share a bucket.

In a bucket only star-shaped edges are compared: every member with the centre, which
is the member that shares buckets with most others. Members near it have their
link. The others are a bucket of their own, with a centre of its own, as long as a centre
takes a fair share of them. What no star has compared could still be linked: two members that
no centre took, or one near a centre and one that is not. Such pairs are found by a prefix
filter on what sets a text apart from the centre: the shingles that only one of the two holds.
Texts meet in a bucket for what they share with the centre, so these are mostly rare; the
common ones of a large star come last. Two texts differ in what sets just one
of them apart; if they are linked and the centre did not take both, they share some of it, and
one of its first few in any order. Numbers, places in the order and sizes rule out most of the
pairs that do. Only pairs that would join two components are compared. Links are confirmed on
whole sets.

Equal sets are one node from the start, so groups of copies cost nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.casts import quoted
from tidemark.llm.common import RID, map_batches, mix, numbered, shingles, slices, tidy, word_hashes, WordHashes
from tidemark.llm.components import components
from tidemark.operators.sizes import broadcast_if, fits_broadcast
from tidemark.workspace import Workspace


# A bucket's rest takes another star if the last one took at least one in so many of its members.
TAKEN = 4
# In a star of more members than LARGE, shingles that set apart one in COMMON of them come last.
# About SAMPLE members tell which these are; any order gives the same links.
LARGE = 32
COMMON = 4
SAMPLE = 24


@dataclass(frozen=True)
class Settings:
    """``words`` per shingle; documents are linked from ``percent`` similarity on.

    A pair of similarity s shares a bucket but for a chance of (1 - s**rows)**bands:
    7e-9 at 0.85, 3e-6 at 0.8 with the values given.
    """

    words: int = 5
    percent: int = 80
    bands: int = 32
    rows: int = 5

    @property
    def bins(self) -> int:
        return self.bands * self.rows


def _in_range(x: np.ndarray, n: int) -> np.ndarray:
    """Hashes to 0..n-1, in their order."""
    return ((x >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)


def _sets(values: np.ndarray, sizes: np.ndarray) -> list[np.ndarray]:
    return [np.unique(part) for part in np.split(values, np.cumsum(sizes)[:-1])]


def one_permutation(sets: list[np.ndarray], bins: int) -> np.ndarray:
    """A row of ``bins`` least hashes for each non-empty, sorted set."""
    out = np.zeros((len(sets), bins), np.uint64)
    filled = np.zeros((len(sets), bins), bool)
    for i, hashes in enumerate(sets):
        place = _in_range(hashes, bins).astype(np.int64)
        first = np.flatnonzero(np.diff(place, prepend=-1))
        out[i, place[first]] = hashes[first]
        filled[i, place[first]] = True
    row, hole = np.nonzero(~filled)
    attempt = 0
    while len(row):
        attempt += 1
        tries = mix(np.arange(bins, dtype=np.uint64) + np.uint64(attempt << 20))
        source = _in_range(mix(tries), bins).astype(np.int64)[hole]
        found = filled[row, source]
        out[row[found], hole[found]] = out[row[found], source[found]]
        row, hole = row[~found], hole[~found]
    return out


def band_keys(sketches: np.ndarray, settings: Settings) -> np.ndarray:
    parts = sketches.reshape(len(sketches), settings.bands, settings.rows)
    keys = np.broadcast_to(mix(np.arange(1, settings.bands + 1, dtype=np.uint64)), parts.shape[:2])
    for k in range(settings.rows):
        keys = mix(keys + parts[:, :, k])
    return keys


def _sketch(settings: Settings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordHashes()
        for batch in batches:
            for first, texts in slices(batch.column(1)):
                sets = _sets(*shingles(*word_hashes(texts, cache), settings.words))
                sizes = np.array([len(s) for s in sets], np.int64)
                keys = np.zeros((len(sets), settings.bands), np.uint64)
                if sizes.any():
                    some = np.flatnonzero(sizes)
                    drawn = one_permutation([sets[i] for i in some], settings.bins)
                    keys[some] = band_keys(drawn, settings)
                offsets = np.arange(len(sets) + 1, dtype=np.int32) * settings.bands
                bands = pa.ListArray.from_arrays(offsets, pa.array(keys.ravel().view(np.int64)))
                marks = pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary())
                rids = batch.column(0).slice(first, len(sets))
                yield pa.RecordBatch.from_arrays(
                    [rids, pa.array(sizes), marks, bands], ["rid", "n", "mark", "bands"]
                )

    return run


def _shingle_sets(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordHashes()
        for batch in batches:
            for first, texts in slices(batch.column(1)):
                sets = _sets(*shingles(*word_hashes(texts, cache), words))
                ends = np.cumsum([0, *map(len, sets)]).astype(np.int32)
                flat = pa.array(np.concatenate(sets).view(np.int64))
                rids = batch.column(0).slice(first, len(sets))
                lists = pa.ListArray.from_arrays(pa.array(ends), flat)
                yield pa.RecordBatch.from_arrays([rids, lists], ["rid", "shingles"])

    return run


def _judged(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs ``(a, b)`` with ``near``, the size ``n`` of ``a``, and in how many shingles they differ:
    ``own`` that only ``a`` holds and ``lacks`` that only ``b`` does.

    Where pairs have a column ``of``, the members of the star of ``b``, these are listed as
    ``apart``: all in a large star, else as many as are looked up.
    """
    left = sets.select(F.col("rid").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("rid").alias("b"), F.col("shingles").alias("sb"))
    joined = pairs.join(left, "a").join(right, "b")
    shared = F.size(F.array_intersect("sa", "sb"))
    counted = joined.select("*", F.size("sa").alias("n"), F.size("sb").alias("nb"), shared.alias("s"))
    near = (100 * F.col("s") >= percent * (F.col("n") + F.col("nb") - F.col("s"))).alias("near")
    columns = ["a", "b", near, "n", (F.col("n") - F.col("s")).alias("own"), (F.col("nb") - F.col("s")).alias("lacks")]
    if "of" in pairs.columns:
        listed = F.concat(F.array_except("sa", "sb"), F.array_except("sb", "sa"))
        columns += ["of", F.when(F.col("of") > LARGE, listed).otherwise(_first(listed, percent)).alias("apart")]
    return counted.select(*columns)


def _first(listed: Column, percent: int) -> Column:
    """What of a text of ``n`` shingles is looked up at most."""
    return F.slice(listed, 1, F.floor((100 - percent) * F.col("n") / percent).cast("int") + 1)


def _shared(members: DataFrame, workspace: Workspace) -> DataFrame:
    """Members ``(key, a)`` of buckets that hold several, with their number ``n``."""
    sizes = members.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    # Stored, so that the join may split a bucket that is large.
    return members.join(workspace.store(sizes, "sizes"), "key")


def _stars(todo: DataFrame, weights: DataFrame, workspace: Workspace) -> DataFrame:
    """Each member with its bucket's centre: the member that shares buckets with most others.

    In a family of edited copies that is the text the others come from, near to all.
    """
    ranked = todo.join(weights, "a")
    first = F.max(F.struct("weight", (-F.col("a")).alias("minus")))["minus"]
    centres = workspace.store(ranked.groupBy("key").agg((-first).alias("b")), "centres")
    return todo.join(centres, "key").filter("a != b").select("key", "a", "b")


def _rooted(df: DataFrame, roots: DataFrame, node: str, name: str) -> DataFrame:
    own = roots.select(F.col("node").alias(node), F.col("root").alias(name))
    return df.join(own, node, "left").withColumn(name, F.coalesce(name, node))


def _roots(todo: DataFrame, weights: DataFrame, sets: DataFrame, percent: int, workspace: Workspace) -> DataFrame:
    """Components of all members of ``todo`` that have a confirmed link."""
    rounds, roots = [], None
    while not todo.isEmpty():
        star = workspace.store(_stars(todo, weights, workspace), "star")
        pairs = workspace.store(star.select("a", "b").distinct(), "pairs")
        members = workspace.store(pairs.groupBy("b").agg(F.count("*").alias("of")), "members")
        judged = workspace.store(_judged(pairs.join(members, "b"), sets, percent), "judged")
        roots = components(judged.filter("near").select("a", "b"), workspace, roots)
        known = star.join(judged.select("a", "b", "near"), ["a", "b"])
        taken = known.groupBy("key").agg(F.count("*").alias("of"), F.sum(F.col("near").cast("int")).alias("taken"))
        again = taken.filter((TAKEN * F.col("taken") >= F.col("of")) & (F.col("of") - F.col("taken") > 1))
        again = workspace.store(again.select("key", F.lit(True).alias("again")), "again")
        marked = workspace.store(known.join(again, "key", "left"), "known")
        last = marked.groupBy("a", "b").agg(F.max(F.col("again").isNull()).alias("last"))
        rounds.append(judged.join(last, ["a", "b"]))
        todo = workspace.store(marked.filter("again and not near").select("key", "a"), "todo")
    if not rounds:
        return todo.select(F.col("a").alias("node"), F.col("a").alias("root")).limit(0)
    pairs = _between_stars(reduce(DataFrame.unionAll, rounds), roots, percent, workspace)
    found = workspace.store(_judged(pairs, sets, percent).filter("near").select("a", "b"), "found")
    return components(found, workspace, roots)


def _between_stars(known: DataFrame, roots: DataFrame, percent: int, workspace: Workspace) -> DataFrame:
    """Pairs of members of one star that it has not compared and that could be linked.

    Those are pairs of which the centre took one, and in a bucket's last star also pairs of which
    it took none. Let ``d`` shingles set a text of ``n`` apart from the centre. Texts x and y
    are linked if they differ in ``r * (nx + ny)`` shingles or fewer, ``r`` being (1 - t) / (1 + t)
    for the similarity t. They differ in ``dx + dy`` less twice the number ``k`` of those that set
    both apart, so ``2 * k >= dx + dy - r * (nx + ny)``, and that is above 0 unless the centre took
    both. Hence, in any common order, the first that sets both apart is followed by
    ``k - 1`` others in each list. Of the text with the smaller ``d - r * n`` it is
    among the first ``r * n + 1``. Of the other it is among the first ``r * n * (1 + 1 / t) + 1``,
    as ``dx`` and ``dy`` are no further apart than the texts and sizes differ by t at most.
    """
    less, more = 100 - percent, 100 + percent  # r is less / more
    rooted = _rooted(known.withColumnRenamed("b", "c"), roots, "a", "root")
    held = workspace.store(rooted.withColumn("d", F.col("own") + F.col("lacks")), "stars")
    # A star that took all its members has compared all that matters.
    open_ = workspace.store(held.filter("not near").select("c").distinct(), "open")
    columns = ["a", "root", "near", "last", "n", "own", "lacks", "d"]
    indexed = _rare_first(held.join(open_, "c"), percent, workspace)
    index = workspace.store(indexed.select("c", *columns, F.posexplode("first").alias("at", "shingle")), "index")
    small = index.filter(more * F.col("at") <= less * F.col("n"))
    x, y = (
        side.select("c", "shingle", F.struct(*columns, "at").alias(name))
        for side, name in ((small, "x"), (index, "y"))
    )

    def both(f: Callable) -> tuple[Column, Column]:
        return f(F.col("x")), f(F.col("y"))

    def least(f: Callable) -> Column:
        return F.least(*both(f))

    def may_share(k: Column) -> Column:
        dx, dy = both(lambda t: t["d"])
        nx, ny = both(lambda t: t["n"])
        return more * (dx + dy - 2 * k) <= less * (nx + ny)

    excess_x, excess_y = both(lambda t: more * t["d"] - less * t["n"])
    last_x, last_y = both(lambda t: t["last"] & ~t["near"])
    fits = [
        (excess_x < excess_y) | ((excess_x == excess_y) & (F.col("x.a") < F.col("y.a"))),
        F.col("x.root") != F.col("y.root"),
        (F.col("x.near") != F.col("y.near")) | (last_x & last_y),
        100 * least(lambda t: t["n"]) >= percent * F.greatest("x.n", "y.n"),
        may_share(least(lambda t: t["own"]) + least(lambda t: t["lacks"])),
        may_share(least(lambda t: t["d"] - t["at"])),
    ]
    joined = x.alias("l").join(
        y.alias("r"),
        (F.col("l.c") == F.col("r.c")) & (F.col("l.shingle") == F.col("r.shingle")) & reduce(Column.__and__, fits),
    )
    return joined.select(F.col("x.a").alias("a"), F.col("y.a").alias("b")).distinct()


def _rare_first(stars: DataFrame, percent: int, workspace: Workspace) -> DataFrame:
    """``stars`` with ``first``, what is looked up of ``apart``; in a large star its rare ones first."""
    some = F.pmod(F.xxhash64("c", "a"), F.col("of")) < SAMPLE
    large = stars.filter((F.col("of") > LARGE) & some)
    counts = large.select("c", "of", F.explode("apart").alias("shingle")).groupBy("c", "of", "shingle").agg(
        F.count("*").alias("n")
    )
    # So many times what sets a member apart on average, at most.
    common = counts.filter(COMMON * F.col("n") >= F.least("of", F.lit(SAMPLE))).groupBy("c").agg(
        F.sort_array(F.collect_list(F.struct("n", "shingle")))["shingle"].alias("common")
    )
    known = stars.join(workspace.store(common, "common"), "c", "left")
    rare = F.array_except("apart", "common")
    # Both in the order of their first list.
    last = F.array_except("common", F.array_except("common", "apart"))
    ordered = F.when(F.col("common").isNull(), F.col("apart")).otherwise(F.concat(rare, last))
    return known.withColumn("first", _first(ordered, percent))


def near_duplicates(
    docs: DataFrame,
    workspace: Workspace,
    settings: Settings = Settings(),
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``docs`` with ``n_shingles``, ``component_id`` and ``kept`` in place of the text.

    ``component_id`` is the smallest id of the documents reachable over links, its own
    included; ``kept`` marks that document. Null or blank texts have an empty set and no
    links. Rows with a repeated or null id are documents of their own: the first of them in
    order of text leads, and a null id sorts before all others.
    """
    with tidy(docs.sparkSession):
        rows = numbered(docs.select(quoted(id_col).alias("id"), quoted(text_col).alias("text")), "id", "text", workspace)
        rows = rows.select(F.col(RID).alias("rid"), "id", "text")
        schema = "rid bigint, n bigint, mark binary, bands array<bigint>"
        drawn = workspace.store(
            map_batches(rows.select("rid", "text"), _sketch(settings), schema), "sketches"
        )
        some = drawn.filter("n > 0")
        # Stored, so that the join may split a large group of copies.
        first = workspace.store(some.groupBy("mark").agg(F.min("rid").alias("a")), "marks")
        nodes = workspace.store(some.select("rid", "mark").join(first, "mark").select("rid", "a"), "nodes")
        leaders = nodes.filter("rid = a").select("rid")
        banded = some.join(leaders, "rid", "left_semi")
        banded = banded.select(F.col("rid").alias("a"), F.explode("bands").alias("key"))
        buckets = workspace.store(_shared(banded.select("key", "a"), workspace), "buckets")
        weights = workspace.store(buckets.groupBy("a").agg(F.sum("n").alias("weight")), "weights")

        wanted = weights.select(F.col("a").alias("rid"))
        texts = rows.select("rid", "text")
        chosen = broadcast_if(wanted, fits_broadcast(wanted, texts))
        sets = texts.join(chosen, "rid", "left_semi")
        sets = map_batches(sets, _shingle_sets(settings.words), "rid bigint, shingles array<bigint>")
        sets = workspace.store(sets, "sets")

        roots = _roots(buckets, weights, sets, settings.percent, workspace)
    led = nodes.join(roots.withColumnRenamed("node", "a"), "a", "left")
    led = led.select("rid", F.coalesce("root", "a").alias("root")).filter("rid != root")
    out = drawn.select("rid", "n").join(led, "rid", "left")
    out = out.select("rid", F.coalesce("root", "rid").alias("root"), F.col("n").alias("n_shingles"))
    return _with_ids(out, rows, id_col)


def _with_ids(out: DataFrame, rows: DataFrame, id_col: str) -> DataFrame:
    """Row numbers turned back to ids; where they are the ids, nothing is joined."""
    kept = (F.col("rid") == F.col("root")).alias("kept")
    ids = rows.select("rid", "id")
    if ids.filter("id is null or id != rid").isEmpty():
        named = out.select(F.col("rid").alias("id"), F.col("root").alias("component_id"), "n_shingles", kept, "rid")
    else:
        lead = ids.select(F.col("rid").alias("root"), F.col("id").alias("component_id"))
        named = out.join(ids, "rid").join(lead, "root").select("id", "component_id", "n_shingles", kept, "rid")
    return named.select(
        F.col("id").alias(id_col), "n_shingles", "component_id", "kept", F.col("rid").alias(RID)
    )
