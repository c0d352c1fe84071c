"""Removal of repeated substrings: blockwise suffix sorting over a cover sample.

A byte goes if a string of ``length`` bytes that covers it also starts earlier. So only
suffixes that agree on ``length`` bytes matter, and they are found bucket by bucket.

Cover sample. Of every string of ``length`` bytes one place is sampled: where the least
hash of its 32-byte grams lies, the leftmost if several. The choice depends on the string
alone, so equal strings are sampled alike wherever they stand; that is what a difference
cover gives suffixes of one text, at a quarter of its density and over any number of
documents. Suffixes with the same sampled place form a block; a block's content has a
rank, its hash, and equal ranks tell long ties apart from the rest without a look at the
bytes: of blocks with equal rank all but the first go as a whole.

Buckets. Blocks of different rank that share the sampled gram may still share strings.
Their suffixes are dealt to finer buckets, of eight neighbouring ones, by the bytes that
all eight share; what is alone in its bucket is done. In a bucket a suffix differs from
others in at most seven bytes, which are sorted as a number.

Every step sorts a partition of Spark's and reads it as a stream, so memory is bounded
however many suffixes a bucket has. A task first sorts what it holds itself, so that a
passage repeated everywhere reaches the shuffle once per task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.casts import quoted
from tidemark.llm.common import RID, map_batches, mix, numbered, slices, tidy
from tidemark.workspace import Workspace

LENGTH = 100
GRAM = 32
FINE = 8
_FLUSH = 400_000
_POSITION = np.uint64((1 << 24) - 1)
_TABLE = mix(np.arange(1, 257, dtype=np.uint64))


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix(mix(a) + b)


class Hashes:
    """Hashes of the runs of 2, 4, … 64 bytes from each place of a buffer."""

    def __init__(self, buffer: np.ndarray):
        self.by_length = {1: _TABLE[buffer]}
        n = 1
        while n < 64:
            h = self.by_length[n]
            self.by_length[2 * n] = _pair(h[:-n], h[n:]) if len(h) > n else h[:0]
            n *= 2

    def of(self, length: int, at: np.ndarray | None = None) -> np.ndarray:
        """Hashes of runs of ``length`` bytes, from two runs that cover them."""
        half = 1 << (length.bit_length() - 1)
        h = self.by_length[half]
        if at is None:
            return _pair(h[: len(h) - (length - half)], h[length - half :])
        return _pair(h[at], h[at + length - half])


class Blocks:
    """The blocks of some documents laid end to end."""

    def __init__(self, texts: list[bytes], length: int = LENGTH):
        sizes = np.array([len(t) for t in texts], np.int64)
        self.buffer = np.frombuffer(b"".join(texts), np.uint8)
        self.starts = np.cumsum(sizes) - sizes
        self.hashes = Hashes(self.buffer)
        grams = self.hashes.by_length[GRAM]
        windows = self.hashes.of(length)
        owner = np.repeat(np.arange(len(texts)), sizes)
        n = max(0, len(self.buffer) - length + 1)
        suffix = np.flatnonzero(owner[:n] == owner[length - 1 :]) if n else np.zeros(0, np.int64)
        sampled = self._sampled(grams, length - GRAM + 1)[suffix] if n else suffix
        new = np.ones(len(suffix), bool)
        new[1:] = (sampled[1:] != sampled[:-1]) | (owner[suffix[1:]] != owner[suffix[:-1]])
        at = np.flatnonzero(new)
        self.first = suffix[at]
        self.last = suffix[np.append(at[1:], len(suffix)) - 1] if len(at) else suffix
        self.sample = sampled[at]
        self.owner = owner[self.first]
        self.gram = grams[self.sample]
        extent = (self.last - self.first).astype(np.uint64)
        self.rank = _pair(windows[self.first] + extent, windows[self.last])

    @staticmethod
    def _sampled(grams: np.ndarray, width: int) -> np.ndarray:
        """For each run of ``width`` grams, the place of its least, by 40 bits of hash."""
        places = np.arange(len(grams), dtype=np.uint64)
        base = places & ~_POSITION
        if len(grams) and base[-1]:
            # Beyond 16 MB a place does not fit; runs are searched in overlapping parts.
            step = (1 << 24) - width
            parts = [
                Blocks._sampled(grams[i : i + step + width - 1], width) + i
                for i in range(0, max(1, len(grams) - width + 1), step)
            ]
            return np.concatenate(parts)
        least = (grams & ~_POSITION) | places
        n = 1
        while 2 * n <= width:
            least = np.minimum(least[:-n], least[n:])
            n *= 2
        if width > n:
            least = np.minimum(least[: len(least) - (width - n)], least[width - n :])
        return (least & _POSITION).astype(np.int64)


def _starts(*columns: np.ndarray) -> np.ndarray:
    """True where a row differs from the one before in any of the sorted columns."""
    new = np.ones(len(columns[0]), bool)
    if len(new):
        new[1:] = np.any([c[1:] != c[:-1] for c in columns], axis=0)
    return new


# Rows go between steps as longs; a run is a first place and a number of suffixes.
_RUN_BITS = 8
REPEATED, MIXED = 0, 1


def _packed(first: np.ndarray, number: np.ndarray) -> np.ndarray:
    return (first << _RUN_BITS) | number


def _batch(names: list[str], *columns: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64, copy=False)) for c in columns], names)


_BLOCK_NAMES = ["gram", "rank", "doc", "run", "kind"]


def _block_rows(length: int):
    """Blocks to compare (kind MIXED); those a task finds repeated itself have kind REPEATED."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []

        def flush() -> pa.RecordBatch:
            gram, rank, doc, runs = (np.concatenate(c) for c in zip(*held))
            held.clear()
            order = np.lexsort((runs, doc, rank, gram))
            gram, rank, doc, runs = (c[order] for c in (gram, rank, doc, runs))
            first = _starts(gram, rank)
            kind = np.where(first, MIXED, REPEATED)
            return _batch(_BLOCK_NAMES, gram.view(np.int64), rank.view(np.int64), doc, runs, kind)

        for batch in batches:
            rids = batch.column(0).to_numpy(zero_copy_only=False)
            for start, texts in slices(batch.column(1)):
                blocks = Blocks(texts, length)
                doc = rids[start : start + len(texts)][blocks.owner]
                place = blocks.first - blocks.starts[blocks.owner]
                runs = _packed(place, blocks.last - blocks.first + 1)
                held.append((blocks.gram, blocks.rank, doc, runs))
                if sum(len(h[0]) for h in held) > _FLUSH:
                    yield flush()
        if held:
            yield flush()

    return run


def _judged(
    batches: Iterator[pa.RecordBatch], values: int
) -> Iterator[tuple[list[np.ndarray], np.ndarray, np.ndarray]]:
    """(columns, mixed, repeated) of rows sorted by a bucket, ``values`` columns and place.

    A row that repeats bucket and values is repeated. The first row of each value is mixed if
    its bucket has a second value, and neither of the two otherwise. One row is held back: the
    first of a bucket, until a second value shows.
    """
    held: list[np.ndarray] | None = None
    before: tuple | None = None
    for batch in batches:
        columns = [c.to_numpy() for c in batch.columns]
        if not len(columns[0]):
            continue
        opens, starts = _starts(columns[0]), _starts(*columns[: values + 1])
        head = tuple(c[0] for c in columns[: values + 1])
        opens[0] = before is None or before[0] != head[0]
        starts[0] = before != head
        before = tuple(c[-1] for c in columns[: values + 1])
        later = starts & ~opens
        bucket = np.cumsum(opens) - int(opens[0])  # 0: the bucket carried over, or the first
        several = np.bincount(bucket, weights=later, minlength=bucket[-1] + 1) > 0
        if held is not None and not opens[0] and several[0]:
            yield held, np.ones(1, bool), np.zeros(1, bool)
            held = None
        at = np.flatnonzero(opens)
        if len(at):
            last = at[-1]
            held = None if several[bucket[last]] else [c[last : last + 1] for c in columns]
        yield columns, later | (opens & several[bucket]), ~starts


def _judge_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted by kind, gram, rank, doc, run; what a task has found repeated passes through."""
    names = ["doc", "run", "kind"]

    def to_compare() -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kind = batch.column(4).to_numpy()
            known = int(np.searchsorted(kind, MIXED))
            if known:
                found.append(batch.slice(0, known).select(["doc", "run", "kind"]))
            if known < len(kind):
                yield batch.slice(known)

    found: list[pa.RecordBatch] = []
    for (_, _, doc, runs, _), mixed, repeated in _judged(to_compare(), 1):
        yield from found
        found.clear()
        keep = mixed | repeated
        yield _batch(names, doc[keep], runs[keep], np.where(mixed, MIXED, REPEATED)[keep])
    yield from found


def _fine_rows(length: int):
    """From each mixed block, its suffixes in runs of ``FINE`` by their distance to the sample.

    ``bucket`` stands for the bytes that all suffixes of a run share, ``left`` and ``right`` hold
    the seven bytes before and behind them, ``span`` which suffixes of the run there are."""
    common = length - FINE + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["bucket", "left", "right", "span", "doc", "place"]
        for batch in batches:
            rids, lists = batch.column(0).to_numpy(zero_copy_only=False), batch.column(2)
            for start, texts in slices(batch.column(1)):
                sizes = np.array([len(t) for t in texts], np.int64)
                starts = np.cumsum(sizes) - sizes
                own = lists.slice(start, len(texts))
                number = np.diff(own.offsets.to_numpy())
                runs = own.flatten().to_numpy()
                owner = np.repeat(np.arange(len(texts)), number)
                first = (runs >> _RUN_BITS) + starts[owner]
                last = first + (runs & ((1 << _RUN_BITS) - 1)) - 1
                buffer = np.frombuffer(b"".join(texts), np.uint8)
                hashes = Hashes(buffer)
                # A block's sample lies within its last suffix's grams; find it again.
                sample = _samples(hashes.by_length[GRAM], first, last, length)
                out = []
                for step in range(0, (length - GRAM) // FINE + 1):
                    # Suffixes at FINE * step to FINE * step + 7 bytes before the sample.
                    low = np.maximum(first, sample - FINE * step - FINE + 1)
                    high = np.minimum(last, sample - FINE * step)
                    have = low <= high
                    low, high, at = low[have], high[have], (sample - FINE * step)[have]
                    who = owner[have]
                    bucket = mix(hashes.of(common, at) + np.uint64(step))
                    near, far = low - (at - FINE + 1), high - (at - FINE + 1)
                    left = _number(buffer, at - FINE + 1, FINE - 1, near)
                    right = _number(buffer, at + common, FINE - 1, None, far)
                    out.append((bucket.view(np.int64), left, right, near * FINE + far, rids[start + who], low - starts[who]))
                yield _batch(names, *(np.concatenate(c) for c in zip(*out)))

    return run


def _samples(grams: np.ndarray, first: np.ndarray, last: np.ndarray, length: int) -> np.ndarray:
    """The sampled place of each block: the least gram that all its suffixes hold."""
    best, place = None, None
    for d in range(length - GRAM + 1):
        at = last + d
        inside = at <= first + length - GRAM
        value = np.where(inside, grams[np.minimum(at, len(grams) - 1)] >> np.uint64(24), np.uint64(1 << 41))
        if best is None:
            best, place = value, at
        else:
            less = value < best
            best, place = np.where(less, value, best), np.where(less, at, place)
    return place


def _number(buffer, start, n, skip=None, limit=None) -> np.ndarray:
    """``n`` bytes from each start as a number; of the first ``skip`` or from ``limit`` on, zeros."""
    out = np.zeros(len(start), np.int64)
    for k in range(n):
        byte = buffer[np.clip(start + k, 0, len(buffer) - 1)].astype(np.int64)
        use = (k >= skip) if skip is not None else (k < limit)
        out = (out << 8) | np.where(use, byte, 0)
    return out


def _judge_fine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by bucket, left, right, span and place. Runs equal in all are REPEATED but for the
    first; first ones of a bucket with others go on, suffix by suffix, as MIXED."""
    names = ["bucket", "code", "doc", "run", "kind"]

    def opened(bucket, left, right, span, doc, place):
        near, far = span // FINE, span % FINE
        parts = []
        for i in range(FINE):
            have = (near <= i) & (i <= far)
            # Suffix i holds the last 7 - i bytes before the common ones, and i behind.
            before = left[have] & ((1 << (8 * (FINE - 1 - i))) - 1)
            behind = right[have] >> (8 * (FINE - 1 - i))
            code = ((before << (8 * i)) | behind) * FINE + i
            at = _packed(place[have] + i - near[have], 1)
            parts.append((bucket[have], code, doc[have], at, np.full(have.sum(), MIXED)))
        return [np.concatenate(c) for c in zip(*parts)]

    for rows, mixed, same in _judged(batches, 3):
        bucket, left, right, span, doc, place = rows
        zero = np.zeros(same.sum(), np.int64)
        number = (span % FINE - span // FINE + 1)[same]
        yield _batch(names, zero, zero, doc[same], _packed(place[same], number), zero + REPEATED)
        yield _batch(names, *opened(*(c[mixed] for c in rows)))


def _judge_suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Suffixes sorted by bucket, code and place: all but the first of each are repeated."""
    before: tuple | None = None
    for batch in batches:
        bucket, code, doc, runs = (c.to_numpy() for c in batch.columns)
        if not len(bucket):
            continue
        again = ~_starts(bucket, code)
        again[0] = before == (bucket[0], code[0])
        before = (bucket[-1], code[-1])
        yield _batch(["doc", "run"], doc[again], runs[again])


def _removed(length: int):
    """Texts and the runs of repeated suffixes in them -> what is left, and counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["id", "n_bytes", "n_removed", "n_spans", "kept_bytes"]
        for batch in batches:
            lists = batch.column(2)
            for start, texts in slices(batch.column(1)):
                rows = []
                for i, text in enumerate(texts):
                    runs = lists[start + i].values
                    buffer = np.frombuffer(text, np.uint8)
                    if runs is None or not len(runs):
                        rows.append((len(text), 0, 0, text))
                        continue
                    runs = runs.to_numpy()
                    first = runs >> _RUN_BITS
                    edge = np.zeros(len(text) + 1, np.int64)
                    np.add.at(edge, first, 1)
                    np.add.at(edge, first + (runs & ((1 << _RUN_BITS) - 1)) + length - 1, -1)
                    gone = np.cumsum(edge[:-1]) > 0
                    spans = int(gone[0]) + int(np.count_nonzero(gone[1:] & ~gone[:-1]))
                    rows.append((len(text), int(gone.sum()), spans, buffer[~gone].tobytes()))
                n, removed, spans, kept = zip(*rows)
                ids = batch.column(0).slice(start, len(texts))
                columns = [ids, *(pa.array(c, pa.int64()) for c in (n, removed, spans)), pa.array(kept, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names)

    return run


def remove_repeats(
    docs: DataFrame,
    workspace: Workspace,
    length: int = LENGTH,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``id_col, n_bytes, n_removed, n_spans, kept_bytes`` for each document.

    Texts are UTF-8 bytes, null as empty; matches end with their document. Strings are judged
    on the input. "Earlier" means a smaller id, or an earlier place in the same document. Rows
    with repeated or null ids are documents of their own, nulls first, then by text. What is left
    need not be valid UTF-8, so it is binary.
    """
    if not 64 <= length <= 64 + GRAM + FINE:
        raise ValueError("strings of 64 to 104 bytes")
    with tidy(docs.sparkSession):
        rows = docs.select(quoted(id_col).alias("id"), quoted(text_col).alias("text"))
        rows = numbered(rows, "id", "text", workspace)
        texts = rows.select(F.col(RID).alias("doc"), "text")

        longs = "{} bigint".format
        blocks = map_batches(texts, _block_rows(length), ", ".join(map(longs, _BLOCK_NAMES)))
        bucket = F.when(F.col("kind") == MIXED, F.col("gram")).otherwise(F.xxhash64("doc"))
        dealt = blocks.repartition(bucket).sortWithinPartitions("kind", "gram", "rank", "doc", "run")
        judged = workspace.store(map_batches(dealt, _judge_blocks, "doc bigint, run bigint, kind bigint"), "judged")

        mixed = judged.filter(F.col("kind") == MIXED).groupBy("doc").agg(F.collect_list("run").alias("runs"))
        fine = texts.join(mixed, "doc").select("doc", "text", "runs")
        fine = map_batches(fine, 
            _fine_rows(length), "bucket bigint, left bigint, right bigint, span bigint, doc bigint, place bigint"
        )
        fine = fine.repartition("bucket").sortWithinPartitions("bucket", "left", "right", "span", "doc", "place")
        fine = map_batches(fine, _judge_fine, "bucket bigint, code bigint, doc bigint, run bigint, kind bigint")
        fine = workspace.store(fine, "fine")

        suffixes = fine.filter(F.col("kind") == MIXED).drop("kind").repartition("bucket", "code")
        suffixes = suffixes.sortWithinPartitions("bucket", "code", "doc", "run")
        suffixes = map_batches(suffixes, _judge_suffixes, "doc bigint, run bigint")
        found = suffixes
        for part in (judged, fine):
            found = found.unionAll(part.filter(F.col("kind") == REPEATED).select("doc", "run"))
        runs = workspace.store(found.groupBy("doc").agg(F.collect_list("run").alias("runs")), "runs")
    kind = rows.schema["id"].dataType.simpleString()
    joined = rows.select(F.col(RID).alias("doc"), "id", "text").join(runs, "doc", "left")
    out = map_batches(joined.select("id", "text", "runs"), 
        _removed(length), f"id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_bytes binary"
    )
    return out.withColumnRenamed("id", id_col)
