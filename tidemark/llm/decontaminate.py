"""Benchmark decontamination: MinHash containment search, confirmed on whole sets.

Test items are partitioned by size, the number n of their distinct word shingles. An
item counts as contained from ``percent`` of them on, so it may lack n - need shingles.
Its sketch holds the n - need + 1 least shingle hashes (bottom-k MinHash): whatever the
document lacks, one of these must be there. The length of the sketch follows from the size
partition alone, so a short item in a document thousands of times its size is found as
surely as in a short one, without a similarity that the document's length would dilute.

Documents are scanned once for each block of items. A document whose shingles meet a
sketch is compared with the whole set of that item.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.casts import quoted
from tidemark.llm.common import map_batches, shingles, slices, word_hashes, WordHashes
from tidemark.operators.sizes import measured_bytes

# A block's share of the items' text; its hashes take about as much again.
BLOCK_BYTES = 16 * 1024 * 1024


def needed(sizes: np.ndarray, percent: int) -> np.ndarray:
    """Shingles that must be found, of each number of shingles."""
    return -(-sizes * percent // 100)


class ItemBlock:
    """Sketches and whole sets of some items, by width of shingle.

    An item of fewer than ``words`` words has its sequence as its only shingle, looked for
    among the documents' runs of that many words.
    """

    def __init__(self, ids: list[int | None], texts: list[bytes], words: int, percent: int):
        hashes, counts = word_hashes(texts, WordHashes())
        of_text = np.split(hashes, np.cumsum(counts)[:-1])
        sets = [np.zeros(0, np.uint64)] * len(texts)
        by_width: dict[int, list[int]] = defaultdict(list)
        for i, own in enumerate(of_text):
            if len(own):
                # A short item's sequence is hashed as the documents' runs of that many words are.
                width = min(len(own), words)
                sets[i] = np.unique(shingles(own, np.array([len(own)]), width)[0])
                by_width[width].append(i)
        self.ids = pa.array(ids, pa.int64())
        self.sizes = np.array([len(s) for s in sets], np.int64)
        self.need = needed(self.sizes, percent)
        self.widths = {}
        for width, items in by_width.items():
            keep = [self.sizes[i] - self.need[i] + 1 for i in items]
            sketch = np.unique(np.concatenate([sets[i][:k] for i, k in zip(items, keep)]))
            owners = np.repeat(items, [len(sets[i]) for i in items])
            every = np.concatenate([sets[i] for i in items])
            order = np.argsort(every, kind="stable")
            coarse = np.zeros(1 << 20, bool)
            coarse[(sketch >> np.uint64(44)).astype(np.int64)] = True
            self.widths[width] = (coarse, sketch, every[order], owners[order])

    def matches(self, hashes: np.ndarray, counts: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(text, item, shared shingles) for every item contained in a text."""
        for width, (coarse, sketch, every, owners) in self.widths.items():
            values, sizes = shingles(hashes, counts, width)
            runs = np.where(counts >= width, sizes, 0)  # a shorter text has no run of this width
            values, sizes = values[np.repeat(counts >= width, sizes)], runs
            maybe = np.flatnonzero(coarse[(values >> np.uint64(44)).astype(np.int64)])
            maybe = maybe[np.isin(values[maybe], sketch)]
            ends = np.cumsum(sizes)
            for text in np.unique(np.searchsorted(ends, maybe, "right")):
                own = np.unique(values[ends[text] - sizes[text] : ends[text]])
                low, high = np.searchsorted(every, own), np.searchsorted(every, own, "right")
                hit = high > low
                found = np.concatenate([owners[a:b] for a, b in zip(low[hit], high[hit])])
                items, shared = np.unique(found, return_counts=True)
                for item, n in zip(items, shared):
                    if n >= self.need[item]:
                        yield int(text), int(item), int(n)


def _search(block):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, cache = block.value, WordHashes()
        for batch in batches:
            for first, texts in slices(batch.column(1)):
                found = list(items.matches(*word_hashes(texts, cache)))
                text, item, shared = np.array(found, np.int64).reshape(-1, 3).T
                rids = batch.column(0).take(pa.array(text + first))
                ids = items.ids.take(pa.array(item))
                yield pa.RecordBatch.from_arrays(
                    [rids, ids, pa.array(items.sizes[item]), pa.array(shared)],
                    ["id", "item_id", "n_shingles", "n_shared"],
                )

    return run


def contained_items(
    docs: DataFrame,
    items: DataFrame,
    words: int = 5,
    percent: int = 80,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``(id_col, item_id, n_shingles, n_shared)`` for every document that contains
    ``percent`` or more of an item's distinct shingles of ``words`` words.

    Words are runs without blanks, A-Z in lower case. Null and blank texts contain nothing,
    blank items are in nothing. Repeated rows and null ids, of items too, give a row each. Items come to the tasks in blocks of bounded size, each with a scan of its
    own over ``docs``; their number grows with the items, not with the documents.
    """
    spark = docs.sparkSession
    named = items.select(quoted(item_col).cast("bigint").alias("id"), quoted(item_text_col).alias("text"))
    named = named.filter("text is not null")
    total = measured_bytes(named)
    blocks = max(1, math.ceil(total / block_bytes))
    kind = docs.schema[id_col].dataType
    out = None
    for b in range(blocks):
        own = named.filter(F.pmod(F.xxhash64("text"), F.lit(blocks)) == b) if blocks > 1 else named
        table = own.toArrow()
        texts = [text.encode() for text in table["text"].to_pylist()]
        ids = table["id"].to_pylist()
        if not texts:
            continue
        block = spark.sparkContext.broadcast(ItemBlock(ids, texts, words, percent))
        schema = f"id {kind.simpleString()}, item_id bigint, n_shingles bigint, n_shared bigint"
        scanned = docs.select(quoted(id_col).alias("id"), quoted(text_col).alias("text"))
        part = map_batches(scanned, _search(block), schema)
        out = part if out is None else out.unionAll(part)
    if out is None:
        out = docs.select(quoted(id_col).alias("id"), *[F.lit(0).cast("bigint").alias(c) for c in ("item_id", "n_shingles", "n_shared")]).limit(0)
    return out.withColumnRenamed("id", id_col)
