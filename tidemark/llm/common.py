"""Shared by the operators of this folder: row numbers, word hashes, settings."""

from __future__ import annotations

import ctypes
import re
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import lru_cache
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

import tidemark
from tidemark.functions.casts import quoted
from tidemark.workspace import Workspace

RID = "__rid"
SLICE_BYTES = 2_000_000
BLANKS = b" \t\n\x0b\x0c\r"  # \x20 and \x09-\x0D, as bytes.split() and strip() take them too
_BLANK = re.compile(rb"[\x20\x09-\x0D]")

_TIDY = {
    # Shuffle files go when the write that made them has ended, not when a collector runs.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}


@contextmanager
def tidy(spark: SparkSession, more: dict[str, str] | None = None) -> Iterator[None]:
    """Run stored steps one after the other, each clearing its own shuffle files.

    ``more`` holds further settings for these steps.
    """
    settings = {**_TIDY, **(more or {})}
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


@lru_cache(maxsize=8)
def _shipped(spark: SparkSession, application: str) -> tempfile.TemporaryDirectory:
    """Give the executors this package; they need not have it installed."""
    folder = tempfile.TemporaryDirectory(prefix="tidemark-")
    archive = f"{folder.name}/tidemark.zip"
    root = Path(tidemark.__file__).parent
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as to:
        for source in sorted(root.rglob("*.py")):
            to.write(source, source.relative_to(root.parent))
    spark.sparkContext.addPyFile(archive)
    return folder


# What a Python worker keeps between its tasks, by the operator that keeps it, and how to drop it.
_HELD: dict[str, Callable[[], None]] = {}


def hold(owner: str, drop: Callable[[], None]) -> None:
    """Called in a task: what ``drop`` drops stays until a task of another owner comes."""
    _HELD[owner] = drop


def _drop_others(owner: str | None) -> None:
    for other in [name for name in _HELD if name != owner]:
        _HELD.pop(other)()


def _give_back() -> None:
    """Return freed memory to the machine: an idle worker counts against its executor."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def map_batches(
    df: DataFrame, function: Callable, schema: str | StructType, owner: str | None = None
) -> DataFrame:
    """``mapInArrow`` with a function of this package. ``owner`` names what it holds, if anything."""
    spark = df.sparkSession
    _shipped(spark, spark.sparkContext.applicationId)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _drop_others(owner)
        yield from function(batches)
        _give_back()

    return df.mapInArrow(run, schema)


def numbered(docs: DataFrame, id_col: str, text_col: str, workspace: Workspace) -> DataFrame:
    """``docs`` with a unique long ``__rid`` that sorts as ``id_col`` does.

    Unique ids without nulls serve as they are. Otherwise the rows are sorted by
    id (nulls first) and text, numbered and stored, so that every row, repeated
    ones included, counts as a document of its own.
    """
    ids = docs.groupBy(quoted(id_col)).agg(F.count("*").alias("n"))
    if ids.filter((F.col("n") > 1) | quoted(id_col).isNull()).isEmpty():
        return docs.withColumn(RID, quoted(id_col).cast("bigint"))
    ordered = docs.orderBy(quoted(id_col).asc_nulls_first(), quoted(text_col).asc_nulls_first())
    return workspace.store(ordered.withColumn(RID, F.monotonically_increasing_id()), "numbered")


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """(first row, texts as bytes) for runs of rows of about ``limit`` bytes; null is empty."""
    raw = pc.fill_null(texts.cast(pa.large_binary()), b"")
    ends = np.cumsum(pc.binary_length(raw).to_numpy(zero_copy_only=False))
    first, before = 0, 0
    while first < len(raw):
        stop = max(first + 1, int(np.searchsorted(ends, before + limit, "right")))
        yield first, raw.slice(first, stop - first).to_pylist()
        first, before = stop, int(ends[stop - 1])


def pieces(text: bytes, limit: int = SLICE_BYTES) -> Iterator[bytes]:
    """A very long text cut at blanks, so that its words are never all held at once."""
    start = 0
    while len(text) - start > limit:
        cut = _BLANK.search(text, start + limit)
        stop = cut.start() if cut else len(text)
        yield text[start:stop]
        start = stop
    yield text[start:]


class WordHashes(dict):
    """64-bit hash of a word; keeps a bounded number of them."""

    LIMIT = 300_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def word_hashes(texts: list[bytes], cache: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, A-Z in lower case, and the number per text."""
    parts, counts = [], np.zeros(len(texts), np.int64)
    words: list[list[bytes]] = []

    def hashed() -> None:
        n = sum(map(len, words))
        flat = map(cache.__getitem__, chain.from_iterable(words))
        parts.append(np.fromiter(flat, np.uint64, n))
        words.clear()

    for i, text in enumerate(texts):
        for piece in pieces(text):
            words.append(piece.lower().split())
            counts[i] += len(words[-1])
            if len(text) > SLICE_BYTES:
                hashed()
    hashed()
    return np.concatenate(parts), counts


_MULTIPLY = np.uint64(0x9E3779B97F4A7C15)
_AGAIN = np.uint64(0xC2B2AE3D27D4EB4F)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _MULTIPLY
    return (x ^ (x >> np.uint64(29))) * _AGAIN


def shingles(hashes: np.ndarray, counts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``width`` words, text by text, and the number per text.

    A text of fewer words, but at least one, has its whole sequence as the only one.
    """
    sizes = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    values = np.empty(int(sizes.sum()), np.uint64)
    full = np.repeat(counts >= width, sizes)
    n = len(hashes) - width + 1
    if n > 0:
        owner = np.repeat(np.arange(len(counts)), counts)
        folded = hashes[:n].copy()
        for k in range(1, width):
            folded = mix(folded) + hashes[k : n + k]
        values[full] = mix(folded)[owner[:n] == owner[width - 1 :]]
    starts = np.cumsum(counts) - counts
    short = np.flatnonzero((counts > 0) & (counts < width))
    if len(short):
        values[~full] = [
            xxhash.xxh3_64_intdigest(hashes[starts[i] : starts[i] + counts[i]].tobytes())
            for i in short
        ]
    return values, sizes


def signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))
