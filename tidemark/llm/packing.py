"""Packing token sequences: best-fit decreasing over the histogram of lengths.

Documents are tokenized where they are and cut: full windows first, then one shorter
piece. Best-fit decreasing sees only lengths, and a length is a number up to the window
size. So the plan is made on counts: for each length, longest first, the tightest windows
that still take it are found with a segment tree indexed by remaining capacity, and whole
runs of windows in the same state are filled at once. The plan's size is bounded by the
window, not by the documents. Each piece then finds its place from its rank among the
pieces of its length, and ranks are counted in shares of bounded size.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.casts import quoted
from tidemark.llm.common import hold, map_batches, pieces, slices, tidy
from tidemark.workspace import Workspace

WINDOW = 4096
END_ID = 2
SHARE_ROWS = 200_000
# Text whose words are held at once; they take some twenty times as much.
SLICE_BYTES = 1_000_000
# A batch is held whole on either side of the pipe to Python, so its rows are counted by size.
SMALL_BATCHES = {"spark.sql.execution.arrow.maxBytesPerBatch": "4m"}
HELD = "tokenizer"
# A letter that str.lower() lowers by its place in the word, and blanks to str.split() alone.
ODD = "\u03a3\x1c\x1d\x1e\x1f"


class WordTokenizer:
    """Token ids by a tokenizer that drops blanks and never joins across them.

    Such a tokenizer gives a text the ids of its words, one after the other, so each word is
    tokenized once and kept, within a bound. Words that Unicode may lower by context, or that
    hold the separator or an added token, and tokenizers of other kinds, take the plain way.
    """

    #: Words of a generation, of which two are kept, and characters of them.
    KEEP = 300_000
    KEEP_CHARACTERS = 6_000_000
    SEPARATOR = "\x01"
    MARKS = ".,;:!?"

    def __init__(self, path: str):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # These are looked for in a text as it is, so a text that could spell one is left as it is.
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.added = [token.content.lower() for token in added]
        self.separator_id = self._plain(self.SEPARATOR)
        self.by_word = len(self.separator_id) == 1 and self._drops_blanks()
        # Of a word of plain letters the model alone makes the same tokens, at half the cost.
        tokens = self.tokenizer.model.tokenize("unforeseeably")
        self.direct = [t.id for t in tokens] == self._plain("unforeseeably")
        self.marks = {c: np.array(self._plain(c), np.uint32).tobytes() for c in self.MARKS}
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.characters = 0

    def _drops_blanks(self) -> bool:
        a, b, c = map(self._plain, "abc")
        marks = [self._plain(f"a{m} b") == a + self._plain(m) + b for m in self.MARKS]
        parted = self._plain(f"a {self.SEPARATOR} b") == a + self.separator_id + b
        return all(marks) and parted and self._plain("A\tb\n c") == a + b + c

    def _plain(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _batch(self, words: list[str]) -> list[bytes]:
        """Many words in one call, told apart by a separator that is a token of its own."""
        joined = f" {self.SEPARATOR} ".join(words)
        encoded = self.tokenizer.encode_batch_fast([joined], add_special_tokens=False)[0]
        ids = np.array(encoded.ids, np.uint32)
        cuts = np.flatnonzero(ids == self.separator_id[0])
        raw = ids.tobytes()
        starts, stops = [0, *(4 * cuts + 4).tolist()], [*(4 * cuts).tolist(), len(raw)]
        return [raw[a:b] for a, b in zip(starts, stops)]

    def _learn(self, words: set[str]) -> None:
        known = words & self.old.keys()
        self.new.update((word, self.old[word]) for word in known)
        words -= known
        # A mark behind letters is a token run of its own, so the letters are looked up alone.
        tails = [word for word in words if word[-1] in self.marks and word[:-1].isalpha()]
        missing = words.difference(tails)
        cores = {word[:-1] for word in tails}.difference(self.new)
        known = cores & self.old.keys()
        self.new.update((word, self.old[word]) for word in known)
        missing |= cores - known
        odd = {word for word in missing if self.SEPARATOR in word}
        if self.direct:
            letters = [word for word in missing if word.isascii() and word.isalpha()]
            tokenize = self.tokenizer.model.tokenize
            self.new.update([(w, array("I", [t.id for t in tokenize(w)]).tobytes()) for w in letters])
            missing.difference_update(letters)
        plain = list(missing - odd)
        for i in range(0, len(plain), 2000):
            self.new.update(zip(plain[i : i + 2000], self._batch(plain[i : i + 2000])))
        for word in odd:
            self.new[word] = np.array(self._plain(word), np.uint32).tobytes()
        new, marks = self.new, self.marks
        self.new.update([(word, new[word[:-1]] + marks[word[-1]]) for word in tails])

    def _lowered(self, text: str) -> str | None:
        """The text in lower case; None where this step might not agree with the tokenizer's."""
        if any(c in text for c in ODD):
            return None
        low = text.lower()
        if any(token in low for token in self.added):
            return None
        if text.isascii() or (is_normalized("NFC", text) and is_normalized("NFC", low)):
            return low
        return None

    def ids(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, as unsigned 32-bit numbers, little end first."""
        if not self.by_word:
            return [np.array(self._plain(text), np.uint32).tobytes() for text in texts]
        lowered = [self._lowered(text) for text in texts]
        words = [[] if low is None else low.split() for low in lowered]
        # Given the dict, difference() looks up each word; ``- keys()`` would walk all that is kept.
        unknown = set().union(*words).difference(self.new)
        self.characters += sum(map(len, unknown))
        self._learn(unknown)
        get = self.new.__getitem__
        out = [
            np.array(self._plain(text), np.uint32).tobytes() if low is None else b"".join(map(get, own))
            for own, low, text in zip(words, lowered, texts)
        ]
        if len(self.new) > self.KEEP or self.characters > self.KEEP_CHARACTERS:
            self.old, self.new = self.new, {}
            self.characters = 0
        return out


@lru_cache(maxsize=2)
def _tokenizer(path: str) -> WordTokenizer:
    return WordTokenizer(path)


def _cut(path: str, window: int, end_id: int, with_ids: bool):
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold(HELD, _tokenizer.cache_clear)
        tokenizer = _tokenizer(path)
        for batch in batches:
            for first, texts in slices(batch.column(1), SLICE_BYTES):
                whole = []
                if len(texts) == 1:
                    # One very long text, cut at blanks, where no token can cross.
                    parts = pieces(texts[0], SLICE_BYTES) if tokenizer.by_word else [texts[0]]
                    whole.append(b"".join(tokenizer.ids([p.decode()])[0] for p in parts) + end)
                else:
                    whole = [ids + end for ids in tokenizer.ids([t.decode() for t in texts])]
                rows = []
                for i, ids in enumerate(whole):
                    total = len(ids) // 4
                    for start in range(0, total, window):
                        part = ids[4 * start : 4 * (start + window)]
                        rows.append((first + i, start, len(part) // 4, zlib.crc32(part), total, part))
                place, start, length, crc, total, part = zip(*rows)
                columns = [batch.column(0).take(pa.array(place))]
                columns += [pa.array(x, pa.int64()) for x in (start, length, crc, total)]
                names = ["rid", "start", "length", "ids_crc32", "doc_tokens"]
                if with_ids:
                    ends = np.cumsum([0, *length]).astype(np.int32)
                    flat = pa.array(np.frombuffer(b"".join(part), "<u4").astype(np.int32))
                    columns.append(pa.ListArray.from_arrays(pa.array(ends), flat))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)

    return run


class CapacityTree:
    """Segment tree over remaining capacities: the least one, from a given one on, that has windows."""

    def __init__(self, window: int):
        self.size = 1 << window.bit_length()
        self.count = [0] * (2 * self.size)

    def add(self, capacity: int, n: int) -> None:
        node = self.size + capacity
        while node:
            self.count[node] += n
            node >>= 1

    def tightest(self, least: int) -> int | None:
        node = self.size + least
        if self.count[node]:
            return least
        while node > 1:
            if node % 2 == 0 and self.count[node + 1]:
                node += 1
                while node < self.size:
                    node = 2 * node if self.count[2 * node] else 2 * node + 1
                return node - self.size
            node >>= 1
        return None


def best_fit_decreasing(histogram: dict[int, int], window: int) -> list[tuple[int, int, int, int, int, int]]:
    """The plan for ``histogram`` (pieces of each length), as runs

    ``(length, first rank, pieces, first sequence, pieces per sequence, offset)``: the piece of
    rank first + i goes to sequence first + i // per, behind those before it there.
    """
    tree = CapacityTree(window)
    open_: dict[int, list[tuple[int, int]]] = {}  # capacity -> runs (first sequence, number)
    plan, sequences = [], 0
    for length in sorted(histogram, reverse=True):
        rank, left = 0, histogram[length]
        while left:
            capacity = tree.tightest(length)
            if capacity is not None:
                first, number = open_[capacity].pop()
                take = min(number, left)
                if number > take:
                    open_[capacity].append((first + take, number - take))
                tree.add(capacity, -take)
                plan.append((length, rank, take, first, 1, window - capacity))
                runs = [(capacity - length, first, take)]
                used = take
            else:
                # New windows, each filled with this length before the next is opened.
                per = window // length
                full, over = divmod(left, per)
                runs, used = [], left
                if full:
                    plan.append((length, rank, full * per, sequences, per, 0))
                    runs.append((window - per * length, sequences, full))
                if over:
                    plan.append((length, rank + full * per, over, sequences + full, over, 0))
                    runs.append((window - over * length, sequences + full, 1))
                sequences += full + bool(over)
            for rest, first, number in runs:
                if rest:
                    open_.setdefault(rest, []).append((first, number))
                    tree.add(rest, number)
            rank, left = rank + used, left - used
    return plan


def _place(plan):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths, ranks, first, per, offset = plan.value
        # Runs sorted by length and rank, so one search finds a piece's run.
        key = (lengths << 48) | ranks
        for batch in batches:
            length = batch.column(0).to_numpy()
            rank = batch.column(1).to_numpy()
            run_of = np.searchsorted(key, (length << 48) | rank, "right") - 1
            within = rank - ranks[run_of]
            sequence = first[run_of] + within // per[run_of]
            at = offset[run_of] + (within % per[run_of]) * length
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[2:], batch.column(0), pa.array(sequence), pa.array(at)],
                [*batch.schema.names[2:], "length", "sequence_id", "offset"],
            )

    return run


def pack(
    docs: DataFrame,
    workspace: Workspace,
    tokenizer_path: str,
    window: int = WINDOW,
    end_id: int = END_ID,
    with_ids: bool = False,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per piece: its document, its place there and its place in a sequence.

    ``id_col, start, length, ids_crc32, doc_tokens, sequence_id, offset`` and, ``with_ids``,
    the token ids. Every text is closed with ``end_id``, so null and blank texts are one token
    long. Rows with repeated or null ids are documents of their own. Sequences are filled from
    0 without gaps and never exceed ``window``.
    """
    spark = docs.sparkSession
    if window >= 1 << 13:
        raise ValueError("windows of 8191 tokens at most")
    with tidy(spark, SMALL_BATCHES):
        rows = docs.select(quoted(id_col).alias("id"), F.coalesce(quoted(text_col), F.lit("")).alias("text"))
        schema = "id long, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"
        schema = schema.replace("id long", f"id {rows.schema['id'].dataType.simpleString()}")
        schema += ", ids array<int>" if with_ids else ""
        cut = map_batches(rows, _cut(tokenizer_path, window, end_id, with_ids), schema, HELD)
        cut = workspace.store(cut.withColumn("share", F.xxhash64("id", "start", "ids_crc32")), "pieces")
        counted = cut.groupBy("length").agg(F.count("*").alias("n")).collect()  # at most ``window`` rows
        histogram = {row["length"]: row["n"] for row in counted}
        shares = max(1, sum(histogram.values()) // SHARE_ROWS)
        shared = cut.withColumn("share", F.pmod("share", F.lit(shares)))
        sizes = shared.groupBy("length", "share").agg(F.count("*").alias("n"))
        before = F.sum("n").over(
            Window.partitionBy("length").orderBy("share").rowsBetween(Window.unboundedPreceding, -1)
        )
        sizes = sizes.select("length", "share", F.coalesce(before, F.lit(0)).alias("before"))
        own = Window.partitionBy("length", "share").orderBy("id", "start", "ids_crc32")
        ranked = shared.withColumn("own", F.row_number().over(own) - 1).join(sizes, ["length", "share"])
        rest = [c for c in cut.columns if c not in ("length", "share")]
        ranked = ranked.select("length", (F.col("own") + F.col("before")).alias("rank"), *rest)
        runs = sorted(best_fit_decreasing(histogram, window))
        length, rank, _, first, per, offset = np.array(runs, np.int64).reshape(-1, 6).T.copy()
        plan = spark.sparkContext.broadcast((length, rank, first, per, offset))
    placed = ranked.select("length", "rank", *rest)
    out_schema = placed.drop("length", "rank").schema.add("length", "long")
    out_schema = out_schema.add("sequence_id", "long").add("offset", "long")
    out = map_batches(placed, _place(plan), out_schema)
    columns = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    return out.select(F.col("id").alias(id_col), *columns, *(["ids"] if with_ids else []))
