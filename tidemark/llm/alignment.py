"""Alignment of two tokenizers: where tokens of both end at one byte, groups are cut.

Tokenizer A is a byte-level BPE (``tokenizers`` file), B a sentencepiece model that puts a space
before each text; A is given that space too. Both then spell the same bytes, and a text is two
increasing lists of byte ends. Merging them is divided by merge-path: on evenly spaced diagonals
of the merge a binary search finds how many ends of A and of B lie before it, so every piece has
the same number of ends, however the two lists are mixed and however long a text is. A piece
finds its own common ends; an end whose two tokens fall into neighbouring pieces is found at the
boundary, where the pieces are stitched into groups.

Links are the pairs of tokens that end together. They are counted within each text, then over
the corpus by an ordinary aggregation; the table of pairs is broadcast if its measured size
allows and joined by a shuffle otherwise.

Defined results: a text that is null, empty, not valid UTF-8, or not spelled by A's or B's
tokens has no tokens and zeros; each row counts as a document of its own, also with a null or
repeated id; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.casts import quoted
from tidemark.llm.common import map_batches, slices
from tidemark.operators.sizes import BROADCAST_LIMIT, broadcast_if, measured_bytes
from tidemark.workspace import Workspace

#: Ends that one piece of the merge holds.
PIECE = 1 << 14
#: Characters tokenized at once, and bytes of text aligned at once.
CHUNK, STEP = 1 << 18, 1 << 21
#: Longer runs without (or of) blanks go to the tokenizer whose time does not grow with their square.
_LONG_RUN = re.compile(r"\S{400}|\s{400}")
#: Here a token of A and one of B end in any case: a letter or number behind a single space.
_SAFE_CUT = re.compile(r"(?<=[^\s▁]) (?=[^\W_])")
_SPACE_MARK = "▁"
_BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>")
# Fixed value: the split of byte-level BPE into words.
BYTE_LEVEL_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Ids of a pair share one long.
_SHIFT = 32

_COLUMNS = "n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string"
_COUNTS = "pairs array<bigint>, pair_links array<bigint>"
_GROUPS = "a_ids array<int>, b_ids array<int>, a_stops array<int>, b_stops array<int>"


def _byte_of_letter() -> dict[str, int]:
    """Byte-level vocabularies write printable bytes as themselves, others from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    letters = {chr(b): b for b in printable}
    return letters | {chr(0x100 + n): b for n, b in enumerate(others)}


def _objects(values: list[bytes]) -> np.ndarray:
    table = np.empty(len(values), object)
    table[:] = values
    return table


class Vocabulary:
    """Byte strings of a tokenizer's ids, and decimal texts of the ids."""

    def __init__(self, spellings: list[bytes]):
        self.spellings = _objects(spellings)
        self.lengths = np.array([len(s) for s in spellings], np.int64)
        decimals = [b"%d" % n for n in range(len(spellings))]
        self.inner = _objects([d + b"," for d in decimals])
        self.last = {end: _objects([d + end for d in decimals]) for end in (b"|", b";")}

    def spell(self, ids: np.ndarray) -> bytes:
        return b"".join(self.spellings[ids].tolist())


class ByteLevel:
    """Tokenizer A. Its ids are merge ranks, so ``tiktoken`` gives the same tokens, sooner."""

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self._plain = Tokenizer.from_file(path)
        self._plain.encode_special_tokens = True
        with open(path, encoding="utf-8") as file:
            model = json.load(file)
        letters = _byte_of_letter()
        special = {t["id"]: t["content"] for t in model["added_tokens"]}
        ranks = {
            bytes(letters[c] for c in text): n
            for text, n in model["model"]["vocab"].items()
            if n not in special
        }
        spellings = [b""] * (1 + max([*ranks.values(), *special]))
        for spelling, n in ranks.items():
            spellings[n] = spelling
        for n, text in special.items():
            spellings[n] = text.encode()
        self.vocabulary = Vocabulary(spellings)
        self._quick = tiktoken.Encoding(
            "byte-level", pat_str=BYTE_LEVEL_SPLIT, mergeable_ranks=ranks, special_tokens={}
        )

    def ids(self, text: str) -> np.ndarray:
        if _LONG_RUN.search(text):
            return np.array(self._plain.encode(text, add_special_tokens=False).ids, np.int64)
        return np.array(self._quick.encode_ordinary(text), np.int64)


class Pieces:
    """Tokenizer B."""

    def __init__(self, path: str):
        import sentencepiece

        self._model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self._model.id_to_piece(n) for n in range(self._model.get_piece_size())]
        self.vocabulary = Vocabulary([self._spelling(name) for name in names])
        #: No piece goes on over a space, so that a text may be cut before one.
        self.splits_at_spaces = not any(_SPACE_MARK in n.lstrip(_SPACE_MARK) for n in names)

    @staticmethod
    def _spelling(name: str) -> bytes:
        byte = _BYTE_PIECE.fullmatch(name)
        if byte:
            return bytes([int(byte[1], 16)])
        return name.replace(_SPACE_MARK, " ").encode()

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(ids, np.int64) for ids in self._model.encode(texts, num_threads=1)]


@lru_cache(maxsize=2)
def _tokenizers(path_a: str, path_b: str) -> tuple[ByteLevel, Pieces]:
    return ByteLevel(path_a), Pieces(path_b)


def merge_path(a: np.ndarray, b: np.ndarray, piece: int = PIECE) -> tuple[np.ndarray, np.ndarray]:
    """How many ends of ``a`` and ``b`` lie before each diagonal; ``a`` comes first of equals."""
    diagonals = np.append(np.arange(0, len(a) + len(b), piece), len(a) + len(b))
    low, high = np.maximum(diagonals - len(b), 0), np.minimum(diagonals, len(a))
    while (low < high).any():
        open_ = low < high
        middle = (low + high) // 2
        # The middle-th of a belongs before the diagonal if b's end across it is not smaller.
        across = np.clip(diagonals - middle - 1, 0, max(len(b) - 1, 0))
        takes = open_ & (a[np.minimum(middle, len(a) - 1)] <= b[across])
        low = np.where(takes, middle + 1, low)
        high = np.where(open_ & ~takes, middle, high)
    return low, diagonals - low


def _common(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``a`` and in ``b`` of the ends that a piece holds of both."""
    if not len(a) or not len(b):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    at = np.searchsorted(b, a)
    both = np.flatnonzero((at < len(b)) & (b[np.minimum(at, len(b) - 1)] == a))
    return both, at[both]


def common_ends(a: np.ndarray, b: np.ndarray, piece: int = PIECE) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of A and B before each common end, from pieces of equal work."""
    in_a, in_b = merge_path(a, b, piece)
    stops_a, stops_b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for k in range(len(in_a) - 1):
        i, j = in_a[k], in_b[k]
        if 0 < i and j < len(b) and a[i - 1] == b[j]:
            # The last end of the piece before is the first of this one: stitch them.
            stops_a.append(np.array([i]))
            stops_b.append(np.array([j + 1]))
        at_a, at_b = _common(a[i : in_a[k + 1]], b[j : in_b[k + 1]])
        stops_a.append(i + at_a + 1)
        stops_b.append(j + at_b + 1)
    return np.concatenate(stops_a), np.concatenate(stops_b)


def chunks(text: str, limit: int = CHUNK) -> Iterator[str]:
    """A long text cut at spaces where both tokenizers end a token; the space is left out."""
    start = 0
    while len(text) - start > limit:
        cut = _SAFE_CUT.search(text, start + limit)
        if cut is None:
            break
        yield text[start : cut.start()]
        start = cut.end()
    yield text[start:]


class _Document:
    """What is known of a text so far."""

    def __init__(self, keep_groups: bool):
        self.valid = True
        self.n_a = self.n_b = self.n_groups = 0
        self.digest = hashlib.sha256()
        self.keys: list[tuple[np.ndarray, np.ndarray]] = []
        self.groups: list[tuple[np.ndarray, ...]] | None = [] if keep_groups else None

    def add(self, ids_a, ids_b, stops_a, stops_b, rendered: list[bytes]) -> None:
        text = b"".join(rendered)[:-1]
        self.digest.update(b";" + text if self.n_groups else text)
        if self.groups is not None:
            self.groups.append((ids_a, ids_b, stops_a + self.n_a, stops_b + self.n_b))
        self.n_a += len(ids_a)
        self.n_b += len(ids_b)
        self.n_groups += len(stops_a)
        keys = (ids_a[stops_a - 1] << _SHIFT) | ids_b[stops_b - 1]
        self.keys.append(np.unique(keys, return_counts=True))

    def counted(self) -> tuple[np.ndarray, np.ndarray]:
        if len(self.keys) == 1:
            return self.keys[0]
        keys, at = np.unique(np.concatenate([k for k, _ in self.keys]), return_inverse=True)
        links = np.bincount(at, np.concatenate([n for _, n in self.keys])).astype(np.int64)
        return keys, links

    def row(self) -> dict:
        if not self.valid or not self.n_groups:
            empty = {"n_a": 0, "n_b": 0, "n_groups": 0, "n_links": 0, "groups_sha256": ""}
            lists = {"pairs": [], "pair_links": []}
            if self.groups is not None:
                lists |= {c: [] for c in ("a_ids", "b_ids", "a_stops", "b_stops")}
            return empty | lists
        keys, links = self.counted()
        row = {
            "n_a": self.n_a, "n_b": self.n_b, "n_groups": self.n_groups,
            "n_links": int(links.sum()), "groups_sha256": self.digest.hexdigest(),
            "pairs": keys, "pair_links": links,
        }
        if self.groups is not None:
            names = ("a_ids", "b_ids", "a_stops", "b_stops")
            row |= {c: np.concatenate(parts) for c, parts in zip(names, zip(*self.groups))}
        return row


def _align_step(step: list[tuple[_Document, str]], a: ByteLevel, b: Pieces) -> None:
    """Align chunks of about ``STEP`` bytes in one merge."""
    all_a = [a.ids(" " + text) for _, text in step]
    all_b = b.ids([text for _, text in step])
    good = []
    for (document, text), ids_a, ids_b in zip(step, all_a, all_b):
        spelled = b" " + text.encode()
        if a.vocabulary.spell(ids_a) == spelled == b.vocabulary.spell(ids_b):
            good.append((document, ids_a, ids_b))
        else:
            document.valid = False
    if not good:
        return
    ids_a = np.concatenate([x for _, x, _ in good])
    ids_b = np.concatenate([x for _, _, x in good])
    stops_a, stops_b = common_ends(
        np.cumsum(a.vocabulary.lengths[ids_a]), np.cumsum(b.vocabulary.lengths[ids_b])
    )
    rendered = _rendered(ids_a, ids_b, stops_a, stops_b, a.vocabulary, b.vocabulary)
    last_a = np.cumsum([len(x) for _, x, _ in good])
    last_b = np.cumsum([len(x) for _, _, x in good])
    # A chunk's end is a common end, so no group goes on over it.
    last_group = np.searchsorted(stops_a, last_a, "right")
    i = j = g = 0
    for n, (document, own_a, own_b) in enumerate(good):
        i2, j2, g2 = int(last_a[n]), int(last_b[n]), int(last_group[n])
        document.add(own_a, own_b, stops_a[g:g2] - i, stops_b[g:g2] - j, rendered[i + j : i2 + j2])
        i, j, g = i2, j2, g2


def _rendered(ids_a, ids_b, stops_a, stops_b, a: Vocabulary, b: Vocabulary) -> list[bytes]:
    """Ids as decimal texts in the order of the groups, each with the sign that follows it."""
    texts = np.empty(len(ids_a) + len(ids_b), object)
    for ids, stops, others, first, names, end in (
        (ids_a, stops_a, stops_b, True, a, b"|"),
        (ids_b, stops_b, stops_a, False, b, b";"),
    ):
        group = np.repeat(np.arange(len(stops)), np.diff(stops, prepend=0))
        before = np.concatenate([[0], others[:-1]]) if first else others
        place = np.arange(len(ids)) + before[group]
        texts[place] = names.inner[ids]
        texts[place[stops - 1]] = names.last[end][ids[stops - 1]]
    return texts.tolist()


_KINDS = {"bigint": pa.int64(), "string": pa.string()}
_KINDS |= {"array<bigint>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32())}


def _align_batches(path_a: str, path_b: str, keep_groups: bool):
    columns = ", ".join([_COLUMNS, _COUNTS] + [_GROUPS] * keep_groups).split(", ")
    made = {name: _KINDS[kind] for name, kind in map(str.split, columns)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = _tokenizers(path_a, path_b)
        limit = CHUNK if b.splits_at_spaces else 1 << 62
        for batch in batches:
            ids = batch.column(0)
            for first, texts in slices(batch.column(1)):
                documents = _align_texts(texts, a, b, limit, keep_groups)
                rows = [d.row() for d in documents]
                values = [pa.array([r[name] for r in rows], kind) for name, kind in made.items()]
                yield pa.RecordBatch.from_arrays([ids.slice(first, len(rows)), *values], ["doc", *made])

    return run


def _align_texts(texts: list[bytes], a, b, limit: int, keep_groups: bool) -> list[_Document]:
    documents, step, size = [], [], 0
    for raw in texts:
        document = _Document(keep_groups)
        documents.append(document)
        if not raw:
            continue
        try:
            text = raw.decode()
        except UnicodeDecodeError:
            document.valid = False
            continue
        for chunk in chunks(text, limit):
            step.append((document, chunk))
            size += len(chunk)
            if size >= STEP:
                _align_step(step, a, b)
                step, size = [], 0
    if step:
        _align_step(step, a, b)
    return documents


def align(
    docs: DataFrame,
    path_a: str,
    path_b: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep_groups: bool = False,
) -> DataFrame:
    """Per row: ``id_col``, numbers of tokens, groups and links, the digest of the groups, and
    the pairs of ids that end together (A's id in the upper half) with their numbers of links.

    With ``keep_groups`` also the ids of both tokenizers and, per group, how many of each lie
    before its end.
    """
    schema = f"doc struct<id:{docs.schema[id_col].dataType.simpleString()}>, {_COLUMNS}, {_COUNTS}"
    if keep_groups:
        schema += f", {_GROUPS}"
    rows = docs.select(F.struct(quoted(id_col).alias("id")).alias("doc"), quoted(text_col).alias("text"))
    done = map_batches(rows, _align_batches(path_a, path_b, keep_groups), schema)
    return done.select(F.col("doc.id").alias(id_col), *[c for c in done.columns if c != "doc"])


@dataclass(frozen=True)
class Counted:
    """Documents with their pairs, and the pairs of the corpus, both stored."""

    documents: DataFrame
    pairs: DataFrame


def count_pairs(aligned: DataFrame, workspace: Workspace) -> Counted:
    """``pairs``: ``pair``, ``links`` of the corpus that hold it, ``best``: no pair of its B id has more."""
    numbered = aligned.withColumn("__row", F.monotonically_increasing_id())
    documents = workspace.store(numbered, "aligned")
    sums = workspace.store(
        _exploded(documents).groupBy("pair").agg(F.sum("n").alias("links")), "pairs"
    )
    id_b = F.col("pair").bitwiseAND((1 << _SHIFT) - 1)
    most = sums.groupBy(id_b.alias("b")).agg(F.max("links").alias("most"))
    best = sums.withColumn("b", id_b).join(most, "b")
    flagged = best.select("pair", "links", (F.col("links") == F.col("most")).alias("best"))
    return Counted(documents, workspace.store(flagged, "best"))


def _exploded(documents: DataFrame) -> DataFrame:
    both = F.explode(F.arrays_zip("pairs", "pair_links")).alias("both")
    return documents.select("__row", both).select(
        "__row", F.col("both.pairs").alias("pair"), F.col("both.pair_links").alias("n")
    )


def with_pair_counts(counted: Counted, broadcast_limit: int = BROADCAST_LIMIT) -> DataFrame:
    """The documents with ``n_best``, links whose pair is its B id's most frequent, and
    ``count_sum``, the corpus's numbers of links summed over the document's links.
    """
    pairs = counted.pairs
    small = measured_bytes(pairs) <= broadcast_limit
    joined = _exploded(counted.documents).join(broadcast_if(pairs, small), "pair")
    sums = joined.groupBy("__row").agg(
        F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).alias("n_best"),
        F.sum(F.col("n") * F.col("links")).alias("count_sum"),
    )
    kept = counted.documents.drop("pairs", "pair_links").join(sums, "__row", "left")
    return kept.fillna(0, ["n_best", "count_sum"]).drop("__row")
