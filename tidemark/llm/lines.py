"""Line deduplication behind two Bloom filters.

The first scan fills two filters with the hashes of line keys: one of those seen, one
of those seen a second time. Both are cut into sectors of 4 KiB; all probes of a hash
fall into one sector, so that the filters of different tasks merge sector by sector:
a bit set in two "seen" filters is set in "seen twice". The second scan sends on only
keys whose probes are all in "seen twice"; their documents are counted exactly, by the
key's own bytes, and the first is chosen. A filter may err towards "twice", never
the other way, so no repeat is missed at any size.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.functions.casts import quoted
from tidemark.llm.common import RID, BLANKS, map_batches, mix, numbered, slices, tidy
from tidemark.operators.sizes import BROADCAST_LIMIT, measured_bytes
from tidemark.workspace import Workspace

SECTOR_BITS = 1 << 15
PROBES = 4
BITS_PER_LINE = 16
# Bound of a filter, and so of what is broadcast. Beyond 16 million distinct lines it fills
# up and more lines go to exact counting; results stay the same.
FILTER_BYTES = 32 * 1024 * 1024
LIST_BYTES = BROADCAST_LIMIT // 2
_FLUSH = 500_000


def line_key(line: bytes) -> bytes:
    return line.strip(BLANKS).lower()


def _keys(text: bytes) -> list[bytes]:
    """Distinct keys of a text's lines, the blank one left out."""
    return [key for key in dict.fromkeys(map(line_key, text.split(b"\n"))) if key]


def _probes(hashes: np.ndarray, sectors: int) -> tuple[np.ndarray, np.ndarray]:
    """Word and bit of each probe: arrays of (hashes, PROBES)."""
    sector = (((hashes >> np.uint64(32)) * np.uint64(sectors)) >> np.uint64(32)).astype(np.int64)
    spread = mix(hashes)[:, None] >> (np.arange(PROBES, dtype=np.uint64) * np.uint64(15))[None, :]
    place = (spread & np.uint64(SECTOR_BITS - 1)).astype(np.int64)
    word = sector[:, None] * (SECTOR_BITS // 32) + (place >> 5)
    return word, (np.uint32(1) << (place & 31).astype(np.uint32))


def _hashes(keys: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, keys), np.uint64, len(keys))


class FilterPair:
    def __init__(self, sectors: int):
        self.sectors = sectors
        self.once = np.zeros(sectors * SECTOR_BITS // 32, np.uint32)
        self.twice = np.zeros_like(self.once)

    def add(self, hashes: np.ndarray) -> None:
        """Hashes of line keys, one for each document that has the line."""
        values, counts = np.unique(hashes, return_counts=True)
        word, bit = _probes(values, self.sectors)
        again = (counts > 1) | ((self.once[word] & bit) != 0).all(axis=1)
        np.bitwise_or.at(self.twice, word[again], bit[again])
        # Bits that two hashes of this batch share need no care: a hash counts as a whole.
        np.bitwise_or.at(self.once, word, bit)

    def rows(self) -> Iterator[pa.RecordBatch]:
        width = SECTOR_BITS // 32
        once, twice = self.once.reshape(-1, width), self.twice.reshape(-1, width)
        used = np.flatnonzero(once.any(axis=1))
        for part in np.array_split(used, max(1, math.ceil(len(used) / 1024))):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(part.astype(np.int64)),
                    pa.array([once[i].tobytes() for i in part], pa.binary()),
                    pa.array([twice[i].tobytes() for i in part], pa.binary()),
                ],
                ["sector", "once", "twice"],
            )


def _fill(sectors: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, pending = FilterPair(sectors), []
        for batch in batches:
            for _, texts in slices(batch.column(0)):
                pending.extend(_hashes(_keys(text)) for text in texts)
                if sum(map(len, pending)) > _FLUSH:
                    pair.add(np.concatenate(pending))
                    pending = []
        if pending:
            pair.add(np.concatenate(pending))
        yield from pair.rows()

    return run


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by sector: the filters of all tasks, merged, only "twice" goes on."""
    now, once, twice = None, None, None

    def done() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([now], pa.int64()), pa.array([twice.tobytes()], pa.binary())], ["sector", "twice"]
        )

    for batch in batches:
        for sector, o, t in zip(*(column.to_pylist() for column in batch.columns)):
            o, t = np.frombuffer(o, np.uint32), np.frombuffer(t, np.uint32)
            if sector == now:
                twice |= t | (once & o)
                once |= o
            else:
                if now is not None:
                    yield done()
                now, once, twice = sector, o.copy(), t.copy()
    if now is not None:
        yield done()


def _twice_filter(texts: DataFrame, filter_bytes: int) -> np.ndarray:
    """Bits of the keys that at least two documents may have; at most ``filter_bytes``."""
    lines = F.regexp_count("text", F.lit("\n")) + 1
    total = texts.agg(F.coalesce(F.sum(lines), F.lit(0))).first()[0]
    most = filter_bytes * 8 // SECTOR_BITS
    sectors = min(max(1, math.ceil(total * BITS_PER_LINE / SECTOR_BITS)), most)
    partial = map_batches(texts.select("text"), _fill(sectors), "sector bigint, once binary, twice binary")
    sorted_ = partial.repartition("sector").sortWithinPartitions("sector")
    merged = map_batches(sorted_, _merge, "sector bigint, twice binary").toArrow()
    bits = np.zeros((sectors, SECTOR_BITS // 32), np.uint32)
    for sector, t in zip(merged["sector"].to_pylist(), merged["twice"].to_pylist()):
        bits[sector] = np.frombuffer(t, np.uint32)
    return bits.ravel()


def _suspects(bits):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        twice = bits.value
        sectors = len(twice) * 32 // SECTOR_BITS
        for batch in batches:
            rids = batch.column(0).to_numpy(zero_copy_only=False)
            for first, texts in slices(batch.column(1)):
                keys = [_keys(text) for text in texts]
                owner = np.repeat(rids[first : first + len(texts)], [len(k) for k in keys])
                flat = [key for own in keys for key in own]
                word, bit = _probes(_hashes(flat), sectors)
                hit = ((twice[word] & bit) != 0).all(axis=1)
                chosen = [flat[i] for i in np.flatnonzero(hit)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(owner[hit]), pa.array(chosen, pa.binary())], ["rid", "key"]
                )

    return run


def repeated_lines(
    rows: DataFrame, workspace: Workspace, min_documents: int, filter_bytes: int = FILTER_BYTES
) -> DataFrame:
    """``(key, first)``: line keys found in ``min_documents`` documents or more (2 at least)
    and the smallest ``__rid`` among them. ``rows`` has ``__rid`` and ``text``."""
    if min_documents < 2:
        raise ValueError("a line repeats from two documents on")
    spark = rows.sparkSession
    texts = rows.select(F.col(RID).alias("rid"), "text")
    bits = spark.sparkContext.broadcast(_twice_filter(texts, filter_bytes))
    found = map_batches(texts, _suspects(bits), "rid bigint, key binary")
    counted = found.groupBy("key").agg(F.count("*").alias("n"), F.min("rid").alias("first"))
    repeated = counted.filter(F.col("n") >= min_documents).select("key", "first")
    return workspace.store(repeated, "repeated_lines")


def _drop_listed(keys, keep_first: bool, names: list[str]):
    """Rewrite the texts of batches whose last two columns are row number and text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        listed = keys.value
        for batch in batches:
            rids = batch.column(batch.num_columns - 2).to_pylist()
            column = batch.column(batch.num_columns - 1)
            for start, texts in slices(column):
                out, counts, gone = [], [], []
                for rid, text in zip(rids[start : start + len(texts)], texts):
                    lines = text.split(b"\n")
                    kept, seen = [], set()
                    for line in lines:
                        key = line_key(line)
                        first = listed.get(key)
                        if first is None:
                            kept.append(line)
                        elif keep_first and first == rid and key not in seen:
                            seen.add(key)
                            kept.append(line)
                    out.append(b"\n".join(kept))
                    counts.append(len(lines))
                    gone.append(len(lines) - len(kept))
                new = [c.slice(start, len(texts)) for c in batch.columns[:-1]]
                new.append(pa.array(out, pa.binary()).cast(pa.string()))
                new += [pa.array(counts, pa.int64()), pa.array(gone, pa.int64())]
                yield pa.RecordBatch.from_arrays(new, names)

    return run


def _drop_joined(rows: DataFrame, repeated: DataFrame, keep_first: bool) -> DataFrame:
    """The same by joins, for a list of repeated lines too large to broadcast."""
    # Not $, which also matches before a last U+0085, U+2028 or U+2029.
    blank = r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+\z"
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    lines = rows.select(RID, F.posexplode(F.split("text", "\n", -1)).alias("at", "line"))
    trimmed = F.translate(F.regexp_replace("line", blank, ""), upper, lower)
    hits = lines.withColumn("key", F.encode(trimmed, "utf-8")).join(repeated, "key")
    of_key = hits.groupBy(RID, "key").agg(
        F.min("first").alias("first"), F.sort_array(F.collect_list("at")).alias("at")
    )
    spared = F.col("first") == F.col(RID) if keep_first else F.lit(False)
    at = F.when(spared, F.slice("at", F.lit(2), F.size("at"))).otherwise(F.col("at"))
    drops = of_key.groupBy(RID).agg(F.flatten(F.collect_list(at)).alias("drops"))
    split = F.split("text", "\n", -1)
    # A set kept as a map is searched line by line; the list of one document is short.
    left = F.filter(split, lambda line, i: ~F.array_contains("drops", i))
    joined = rows.join(drops, RID, "left")
    gone = F.coalesce(F.size("drops"), F.lit(0))
    text = F.when(gone > 0, F.array_join(left, "\n")).otherwise(F.col("text"))
    return joined.select(
        *[c for c in rows.columns if c != "text"],
        text.alias("text"),
        F.size(split).cast("bigint").alias("__lines"),
        gone.cast("bigint").alias("__gone"),
    )


def drop_repeated_lines(
    docs: DataFrame,
    workspace: Workspace,
    min_documents: int = 10,
    keep_first: bool = False,
    id_col: str = "doc_id",
    text_col: str = "text",
    list_bytes: int = LIST_BYTES,
    filter_bytes: int = FILTER_BYTES,
) -> DataFrame:
    """``docs`` without the lines that ``min_documents`` documents share.

    A line is compared by its key: blanks off both ends, A-Z in lower case. Blank lines
    stay. With ``keep_first`` the first occurrence stays, in the document with the smallest
    id. All columns stay, in place; ``__lines`` and ``__gone`` count a text's lines before
    and those dropped. A null text becomes empty, which is one line. Rows with repeated or null
    ids are documents of their own.
    """
    with tidy(docs.sparkSession):
        marked = numbered(docs, id_col, text_col, workspace)
        rest = [c for c in docs.columns if c != text_col]
        text = F.coalesce(quoted(text_col), F.lit("")).alias("text")
        carried = [quoted(c).alias(f"c{i}") for i, c in enumerate(rest)]
        rows = marked.select(*carried, F.col(RID), text)
        repeated = repeated_lines(rows, workspace, min_documents, filter_bytes)
        size = measured_bytes(repeated)
    if size <= list_bytes:
        found = repeated.toArrow()
        listed = dict(zip(found["key"].to_pylist(), found["first"].to_pylist()))
        keys = docs.sparkSession.sparkContext.broadcast(listed)
        schema = StructType(list(rows.schema.fields)).add("__lines", "long").add("__gone", "long")
        out = map_batches(rows, _drop_listed(keys, keep_first, schema.names), schema)
    else:
        out = _drop_joined(rows, repeated, keep_first)
    names = {c: f"c{i}" for i, c in enumerate(rest)} | {text_col: "text"}
    return out.select(*[F.col(names[c]).alias(c) for c in docs.columns], RID, "__lines", "__gone")
