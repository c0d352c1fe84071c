"""Hard negatives by Fagin's threshold algorithm, over blocks of rows and blocks of anchors.

Rows are packed into blocks, their components as integers. A block's rows are sorted by each
dimension. An anchor reads all these lists at once, from the high end where its own component
is positive and from the low end where it is negative, and scores what it meets by an exact
integer inner product. After each step the products at the places reached add up to a threshold
that no row still unread exceeds. The block is left once the threshold is strictly below the
last score that counts: for positives the k-th best of the anchor's label, for a window of
negatives its k-th best or, while it holds fewer, its lower bound. "Strictly", since a row of
equal score may have a smaller id.

A first pass finds the positives, whose scores are the windows of a second. In either, a task
takes one block of anchors and a strip of the row blocks, one after the other, and carries what
the anchors have found, so that later blocks are left sooner. It holds one block of each. Strips
are as few as keep the cores busy, one if there are many anchors, so that what the tasks return
grows with the anchors alone; an aggregation takes the best of it.

Defined results: rows with a null id, label or vector, or a component that is null or not
finite, take no part. Shorter vectors count as followed by zeros. Each row of a repeated id
counts, also as a partner of another one; rows of equal score and id are interchangeable. Scores
beyond a long become its nearest value, their order stays exact. Other columns are ignored, and
an empty table or one without anchors gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.casts import quoted
from tidemark.llm.common import map_batches
from tidemark.workspace import Workspace


@dataclass(frozen=True)
class Settings:
    #: Components are multiplied by this and rounded down; a power of two, so that no digit is lost.
    scale: int = 256
    positives: int = 5
    negatives: int = 5
    #: A negative's score as hundredths of the positive's, both ends included.
    low: int = 80
    high: int = 100
    rows_per_block: int = 4096
    anchors_per_block: int = 256
    #: Bounds a block also where vectors are long.
    block_bytes: int = 8_000_000
    #: Places of each list that the first step reads; each further step reads twice as many.
    first_step: int = 8
    #: Tasks of a pass at most; more pairs of blocks are taken one after the other.
    tasks: int = 100_000

    def __post_init__(self):
        if self.scale < 1 or self.scale & (self.scale - 1):
            raise ValueError(f"scale must be a power of two: {self.scale}")


_LONG = np.iinfo(np.int64)
# Whole numbers up to this are exact as doubles, and so are sums of products within it.
_EXACT = 1 << 53
_FOUND = "anchor bigint, anchor_id bigint, row bigint, id bigint, label bigint, score bigint, exact string"


# Blocks


def eligible(rows: DataFrame, id_col: str, vector_col: str, label: Column, anchor: Column) -> DataFrame:
    """Rows that take part: ``id``, ``label``, ``anchor`` (boolean) and ``vector``."""
    typed = rows.select(
        quoted(id_col).cast("bigint").alias("id"),
        label.cast("bigint").alias("label"),
        F.coalesce(anchor, F.lit(False)).alias("anchor"),
        quoted(vector_col).cast("array<double>").alias("vector"),
    )
    finite = F.forall("vector", lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    return typed.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & finite)


def _whole(vectors: list[np.ndarray], scale: int) -> tuple[np.ndarray, pa.DataType]:
    """Rows of integers of one width, and the type that holds them; doubles if none does."""
    table = np.zeros((len(vectors), max(map(len, vectors))))
    for row, vector in zip(table, vectors):
        row[: len(vector)] = vector
    with np.errstate(over="ignore"):
        rounded = np.floor(table * scale)
    largest = np.abs(rounded).max(initial=0)
    for kind, bound in ((pa.int16(), 1 << 15), (pa.int32(), 1 << 31)):
        if largest < bound:
            return rounded, kind
    return table, pa.float64()


def _integers(block: pa.RecordBatch, width: int, scale: int) -> np.ndarray:
    """The block's vectors as doubles that are whole numbers, or as Python integers."""
    flat = block["vector"].flatten()
    own = len(flat) // max(len(block), 1)
    table = flat.to_numpy(zero_copy_only=False).reshape(len(block), own)
    if flat.type == pa.float64():
        # A double this large is a whole number, which its product with the scale need not be.
        exact = [int(x) * scale if abs(x) >= _EXACT else math.floor(x * scale) for x in table.flat]
        table = np.array(exact, object).reshape(table.shape)
    wide = np.zeros((len(block), width), object if table.dtype == object else np.float64)
    wide[:, :own] = table
    return wide


def _serialized(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _block(payload: bytes) -> pa.RecordBatch:
    return next(iter(pa.ipc.open_stream(payload)))


def _packer(settings: Settings, most: float, most_bytes: float, names: list[str]):
    """Rows to blocks of at most ``most`` of them: the columns ``names``, and ``vector`` whole."""

    def packed(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(parts).combine_chunks()
        offsets = np.concatenate([[0], np.cumsum(pc.list_value_length(table["vector"]).to_numpy())])
        flat = pc.list_flatten(table["vector"]).to_numpy()
        vectors = [flat[i:j] for i, j in zip(offsets[:-1], offsets[1:])]
        values, kind = _whole(vectors, settings.scale)
        ends = pa.array(np.arange(len(vectors) + 1) * values.shape[1], pa.int32())
        lists = pa.ListArray.from_arrays(ends, pa.array(values.ravel().astype(kind.to_pandas_dtype())))
        columns = [table[c].combine_chunks() for c in names]
        batch = pa.RecordBatch.from_arrays([*columns, lists], [*names, "vector"])
        payload = pa.array([_serialized(batch)], pa.binary())
        number = pa.array([table["number"][0].as_py()], pa.int32())
        width = pa.array([values.shape[1]], pa.int32())
        return pa.RecordBatch.from_arrays([number, width, payload], ["number", "width", "payload"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, n, longest = [], 0, 1
        for batch in batches:
            lengths = pc.list_value_length(batch["vector"]).to_numpy()
            start = 0
            while start < len(batch):
                # Rows are as wide as the block's longest vector.
                widest = np.maximum.accumulate(np.maximum(lengths[start:], longest))
                room = (np.arange(n + 1, n + 1 + len(widest)) * widest * 8 <= most_bytes)
                fits = int(min(most - n, room.sum())) if n or room[0] else 1
                if fits > 0:
                    parts.append(batch.slice(start, fits))
                    n, longest, start = n + fits, int(widest[fits - 1]), start + fits
                if start < len(batch):
                    yield packed(parts)
                    parts, n, longest = [], 0, 1
        if n:
            yield packed(parts)

    return run


_PACKED = "number int, width int, payload binary"


# One anchor and one block


class _Best:
    """The best rows so far, by score and then by smaller id, of those a window takes."""

    def __init__(self, most: int, floor: float | int, ceiling: float | int):
        self.most, self.floor, self.ceiling = most, floor, ceiling
        self.rows: list[tuple] = []

    def add(self, scores, block: _RowBlock, places: np.ndarray) -> None:
        inside = (scores >= self.needed()) & (scores <= self.ceiling)
        if not inside.any():
            return
        scores, places = scores[inside], places[inside]
        if len(places) > self.most:
            # Those that tie with the last that fits stay for the order by id.
            least = np.sort(scores)[-self.most]
            scores, places = scores[scores >= least], places[scores >= least]
        new = zip((-s for s in map(int, scores)), *(c[places].tolist() for c in (block.id, block.row, block.label)))
        self.rows = sorted([*self.rows, *new])[: self.most]

    def needed(self) -> float | int:
        """No row below this score can come in."""
        return -self.rows[-1][0] if len(self.rows) == self.most else self.floor


class _RowBlock:
    def __init__(self, block: pa.RecordBatch, width: int, settings: Settings):
        self.row, self.id, self.label = (block[c].to_numpy() for c in ("row", "id", "label"))
        self.vectors = _integers(block, width, settings.scale)
        self.largest = int(np.abs(self.vectors).max(initial=0))
        order = np.argsort(self.vectors, axis=0, kind="stable")
        self.lists = np.ascontiguousarray(order.T)
        self.values = np.ascontiguousarray(np.take_along_axis(self.vectors, order, axis=0).T)


def _search(anchor: np.ndarray, block: _RowBlock, takes: np.ndarray, windows: list[_Best], step: int) -> int:
    """Fagin's algorithm on one block, for rows that ``takes`` marks; returns the depth reached."""
    n = len(block.id)
    vectors, values = block.vectors, block.values
    if block.largest * int(np.abs(anchor).max(initial=0)) * len(anchor) >= _EXACT:
        vectors, values, anchor = map(_python, (vectors, values, anchor))
    up, down = np.flatnonzero(anchor > 0), np.flatnonzero(anchor < 0)
    met = np.zeros(n, bool)
    depth = 0
    while depth < n:
        stop = min(depth + step, n) if len(up) + len(down) else n
        before = met.copy()
        if len(up) + len(down):
            met[block.lists[up, n - stop : n - depth].ravel()] = True
            met[block.lists[down, depth:stop].ravel()] = True
        else:  # every score is 0, so no list is worth reading before another
            met[:] = True
        new = np.flatnonzero(met & ~before & takes)
        if len(new):
            scores = vectors[new] @ anchor
            for window in windows:
                window.add(scores, block, new)
        depth, step = stop, 2 * step
        threshold = anchor[up] @ values[up, n - depth] + anchor[down] @ values[down, depth - 1]
        if all(threshold < window.needed() for window in windows):
            break
    return depth


def _python(whole: np.ndarray) -> np.ndarray:
    """Whole numbers as Python integers, whose sums are exact at any size."""
    return np.array([int(x) for x in whole.flat], object).reshape(whole.shape)


# Passes


def _pass(settings: Settings, width: int, negatives: bool):
    """Batches of (target, seq, payload), each target's anchors first and then its row blocks."""

    def windows(anchors: pa.RecordBatch) -> list[list[_Best]]:
        if not negatives:
            return [[_Best(settings.positives, -math.inf, math.inf)] for _ in range(len(anchors))]
        made = []
        for positives in anchors["positives"].to_pylist():
            # Exact scores travel as text: they may be beyond a long.
            scores = [int(p) for p in positives]
            bounds = [(-(-settings.low * s // 100), settings.high * s // 100) for s in scores]
            made.append([_Best(settings.negatives, low, high) for low, high in bounds])
        return made

    def found(anchors: pa.RecordBatch, best: list[list[_Best]]) -> Iterator[pa.RecordBatch]:
        rows = []
        for k, own in enumerate(best):
            head = (anchors["row"][k].as_py(), anchors["id"][k].as_py())
            for n, window in enumerate(own):
                rows += [
                    (*head, row, id_, n if negatives else label, min(max(-s, _LONG.min), _LONG.max), str(-s))
                    for s, id_, row, label in window.rows
                ]
        if rows:
            kinds = [pa.int64()] * 6 + [pa.string()]
            names = [part.split()[0] for part in _FOUND.split(", ")]
            columns = [pa.array(c, kind) for c, kind in zip(zip(*rows), kinds)]
            yield pa.RecordBatch.from_arrays(columns, names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target, anchors, vectors, best = None, None, None, None
        for batch in batches:
            for k in range(len(batch)):
                at, seq = batch["target"][k].as_py(), batch["seq"][k].as_py()
                if at != target and anchors is not None:
                    yield from found(anchors, best)
                    anchors = None
                target, block = at, _block(batch["payload"][k].as_buffer())
                if seq == _ANCHORS:
                    anchors, best = block, windows(block)
                    vectors = _integers(block, width, settings.scale)
                    continue
                if anchors is None:  # a number that no anchor has
                    continue
                rows = _RowBlock(block, width, settings)
                own_rows, labels = anchors["row"].to_numpy(), anchors["label"].to_numpy()
                for i, own in enumerate(best):
                    open_ = [w for w in own if w.floor <= w.ceiling]
                    if open_:
                        same = rows.label == labels[i]
                        takes = ~same if negatives else same & (rows.row != own_rows[i])
                        _search(vectors[i], rows, takes, open_, settings.first_step)
        if anchors is not None:
            yield from found(anchors, best)

    return run


# Order of a target's anchors among its blocks.
_ANCHORS = -1


def _meet(
    anchors: DataFrame, numbers: int, rows: DataFrame, width: int, settings: Settings, negatives: bool
) -> DataFrame:
    """Every block of ``anchors``, numbered up to ``numbers``, against every block of ``rows``."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    strips = max(1, min(math.ceil(2 * cores / numbers), rows.count()))
    strip = F.pmod(F.xxhash64("seq"), F.lit(strips)).cast("int").alias("strip")
    first = anchors.select(
        "number", F.explode(F.sequence(F.lit(0), F.lit(strips - 1))).alias("strip"),
        F.lit(_ANCHORS).cast("bigint").alias("seq"), "payload",
    )
    then = rows.select(
        F.explode(F.sequence(F.lit(0), F.lit(numbers - 1))).alias("number"), strip, "seq", "payload"
    )
    target = (F.col("number").cast("bigint") * strips + F.col("strip")).alias("target")
    tasks = min(numbers * strips, settings.tasks)
    dealt = first.unionByName(then).select(target, "seq", "payload")
    dealt = dealt.repartitionById(tasks, F.pmod(F.col("target"), F.lit(tasks)).cast("int"))
    ordered = dealt.sortWithinPartitions("target", "seq")
    return map_batches(ordered, _pass(settings, width, negatives), _FOUND)


@contextmanager
def _few_a_batch(spark: SparkSession) -> Iterator[None]:
    """A batch to Python holds few rows, as these are blocks."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, "8")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def mine(
    rows: DataFrame,
    workspace: Workspace,
    anchor: Column,
    label: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    settings: Settings = Settings(),
) -> DataFrame:
    """Per anchor, positive and rank: the negative, and both scores.

    An anchor's positives are its best other rows of its label; a positive's negatives are the
    best rows of other labels whose scores are from ``low`` to ``high`` hundredths of its own.
    """
    spark = rows.sparkSession
    kept = eligible(rows, id_col, vector_col, label, anchor)
    kept = kept.withColumn("row", F.monotonically_increasing_id()).withColumn("number", F.lit(0))
    names = ["row", "id", "label", "anchor"]
    packed = map_batches(kept, _packer(settings, settings.rows_per_block, settings.block_bytes, names), _PACKED)
    blocks = workspace.store(packed.withColumn("seq", F.monotonically_increasing_id()), "blocks")
    with _few_a_batch(spark):
        anchors = workspace.store(map_batches(blocks, _anchors(settings), _ANCHOR), "anchors")
    width = blocks.agg(F.max("width")).first()[0] or 1
    a_block = max(1, min(settings.anchors_per_block, settings.block_bytes // (8 * width)))
    numbers = max(1, math.ceil(anchors.count() / a_block))
    number = F.pmod(F.xxhash64("row"), F.lit(numbers)).cast("int")
    anchors = anchors.withColumn("number", number)

    def anchor_blocks(df: DataFrame, names: list[str], name: str) -> DataFrame:
        # A partition holds one number's anchors, and they are one block.
        dealt = df.repartitionById(numbers, F.col("number"))
        packer = _packer(settings, math.inf, math.inf, names)
        return workspace.store(map_batches(dealt, packer, _PACKED), name)

    first = anchor_blocks(anchors, ["row", "id", "label"], "anchor-blocks")
    with _few_a_batch(spark):
        found = workspace.store(_meet(first, numbers, blocks, width, settings, negatives=False), "positive-parts")
    positives = workspace.store(_ranked(found, ["anchor"], settings.positives), "positives")
    own = positives.groupBy(F.col("anchor").alias("row")).agg(
        F.sort_array(F.collect_list(F.struct("rank", "exact"))).alias("own")
    )
    with_own = anchors.join(own, "row").select("*", F.transform("own", lambda p: p["exact"]).alias("positives"))
    second = anchor_blocks(with_own.drop("own"), ["row", "id", "label", "positives"], "window-blocks")
    with _few_a_batch(spark):
        found = workspace.store(_meet(second, numbers, blocks, width, settings, negatives=True), "negative-parts")
    # The second pass gives the window, that is the positive's rank, in place of the label.
    window = (F.col("label") + 1).cast("int").alias("window")
    negatives = _ranked(found.select("*", window), ["anchor", "window"], settings.negatives)
    matched = negatives.alias("n").join(
        positives.alias("p"),
        (F.col("n.anchor") == F.col("p.anchor")) & (F.col("n.window") == F.col("p.rank")),
    )
    return matched.select(
        F.col("n.anchor_id").alias("anchor_id"), F.col("p.id").alias("positive_id"), F.col("n.rank").alias("rank"),
        F.col("n.id").alias("negative_id"), F.col("p.score").alias("positive_score"),
        F.col("n.score").alias("negative_score"),
    )


_ANCHOR = "row bigint, id bigint, label bigint, vector array<double>"


def _anchors(settings: Settings):
    """The anchors among blocks of rows, their components as they were, but for the scale."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for payload in batch["payload"]:
                block = _block(payload.as_buffer())
                own = block.filter(block["anchor"])
                vector = own["vector"].cast(pa.list_(pa.float64()))
                if block.schema.field("vector").type.value_type != pa.float64():
                    flat = pa.array(vector.flatten().to_numpy() / settings.scale)
                    vector = pa.ListArray.from_arrays(vector.offsets, flat)
                columns = [own[c] for c in ("row", "id", "label")]
                yield pa.RecordBatch.from_arrays([*columns, vector], ["row", "id", "label", "vector"])

    return run


def _ranked(found: DataFrame, group: list[str], most: int) -> DataFrame:
    """What the strips found of each group, at most a few rows each, in order, the best of it."""
    # Scores that are beyond a long tie as such; their digits tell them apart.
    digits = F.struct(F.length("exact"), "exact")
    order = Window.partitionBy(*group).orderBy(
        F.col("score").desc(),
        F.when(F.col("score") == int(_LONG.max), digits).desc(),
        F.when(F.col("score") == int(_LONG.min), digits).asc(),
        "id",
        "row",
    )
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)
