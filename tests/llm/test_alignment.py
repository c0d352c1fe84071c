"""Alignment of tokenizers against offsets worked out token by token."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import alignment
from tidemark.llm.queries import tokenizer_path

SF_DIR = "/root/testdata/sf0.001"
PATHS = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")
AWKWARD = [
    None, "", " ", "  \n\t ", "\n", "one", "▁", "a▁b", "x <|endoftext|> y</s><s><unk> z",
    "naïve Ünï ΣΑΣ 日本語 \U0001f600\U0001f600 ﬁ é́ \x00\x1c\x85　end ", "don't we'll I'M it's'",
    "x" * 3000, "ab1 " * 900 + " " * 1200 + "\n" * 900, "tail  two  spaces   three ", "1234567890 " * 50,
    "word " * 4 + "word", "word " * 4 + "word", "<0x41> literal byte piece", "a​b ́c ²x",
]


@pytest.fixture(scope="module")
def docs(spark):
    real = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text")
    odd = spark.createDataFrame([(n % 5 or None, t) for n, t in enumerate(AWKWARD)], "doc_id bigint, text string")
    clashing = ["doc", "id", "pairs", "pair", "links", "__row", "n_a", "best"]
    return real.unionAll(odd).withColumns({c: F.lit("x") for c in clashing}).cache()


@pytest.fixture(scope="module")
def plain_tokenizers():
    a = Tokenizer.from_file(PATHS[0])
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    letters = alignment._byte_of_letter()

    def both(text):
        ids_a = a.encode(" " + text, add_special_tokens=False).ids
        ids_b = b.encode(text)
        bytes_a = [bytes(letters[c] for c in a.id_to_token(n)) for n in ids_a]
        bytes_b = []
        for n in ids_b:
            piece = b.id_to_piece(n)
            byte = re.fullmatch("<0x(..)>", piece)
            bytes_b.append(bytes([int(byte[1], 16)]) if byte else piece.replace("▁", " ").encode())
        return list(zip(ids_a, bytes_a)), list(zip(ids_b, bytes_b))

    return both


def plain_groups(text, both):
    """(A's ids, B's ids) of each group; none for a text that is not spelled."""
    if not text:
        return []
    a, b = both(text)
    if not b"".join(t for _, t in a) == b"".join(t for _, t in b) == (" " + text).encode():
        return []
    groups, i, j = [], 0, 0
    while i < len(a):
        own, at_a, at_b = ([], []), 0, 0
        while not own[0] or at_a != at_b:
            if at_a <= at_b:
                own[0].append(a[i][0])
                at_a += len(a[i][1])
                i += 1
            else:
                own[1].append(b[j][0])
                at_b += len(b[j][1])
                j += 1
        groups.append(own)
    return groups


def plain(rows, both):
    all_groups = [(doc_id, plain_groups(text, both)) for doc_id, text in rows]
    counts = Counter((a[-1], b[-1]) for _, groups in all_groups for a, b in groups)
    best = {}
    for (_, b), n in counts.items():
        best[b] = max(best.get(b, 0), n)
    for doc_id, groups in all_groups:
        links = [(a[-1], b[-1]) for a, b in groups]
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        yield (
            doc_id, sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), len(links),
            sum(counts[k] == best[k[1]] for k in links), sum(counts[k] for k in links),
            hashlib.sha256(text.encode()).hexdigest() if groups else "",
        )


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.mark.parametrize("limit", [0, 1 << 26])
def test_against_plain_version(docs, workspace, plain_tokenizers, limit):
    counted = alignment.count_pairs(alignment.align(docs, *PATHS), workspace)
    got = alignment.with_pair_counts(counted, broadcast_limit=limit).select(*COLUMNS)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    expected = list(plain(rows, plain_tokenizers))
    assert Counter(map(tuple, got.collect())) == Counter(expected)
    assert any(r[3] == 0 for r in expected) and any(r[4] > r[5] for r in expected)


def test_groups_are_the_texts_tokens(docs, plain_tokenizers):
    got = alignment.align(docs, *PATHS, id_col="text", keep_groups=True).collect()
    for row in got:
        stops = list(zip(row["a_stops"], row["b_stops"]))
        starts = [(0, 0), *stops[:-1]]
        groups = [(row["a_ids"][i:k], row["b_ids"][j:m]) for (i, j), (k, m) in zip(starts, stops)]
        assert groups == [tuple(g) for g in plain_groups(row["text"], plain_tokenizers)]


def test_long_texts_are_cut_where_nothing_changes(plain_tokenizers):
    a, b = alignment._tokenizers(*PATHS)
    text = " ".join(t for t in AWKWARD if t and "▁" not in t) * 40
    assert len(list(alignment.chunks(text, 500))) > 50
    whole = alignment._align_texts([text.encode()], a, b, 1 << 62, True)[0].row()
    for limit in (50, 500, 20_000):
        cut = alignment._align_texts([text.encode()], a, b, limit, True)[0].row()
        assert cut["groups_sha256"] == whole["groups_sha256"]
        assert all(np.array_equal(cut[c], whole[c]) for c in ("pairs", "pair_links", "a_stops", "b_stops"))
    expected = plain_groups(text, plain_tokenizers)
    assert whole["n_groups"] == len(expected)


def test_a_bad_byte_makes_the_text_empty():
    a, b = alignment._tokenizers(*PATHS)
    row = alignment._align_texts([b"good \xff bad"], a, b, 100, False)[0].row()
    assert (row["n_a"], row["groups_sha256"], row["pairs"]) == (0, "", [])


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 6), max_size=60), st.lists(st.integers(1, 6), max_size=60), st.integers(1, 20))
def test_merge_path(steps_a, steps_b, piece):
    a, b = np.cumsum(steps_a, dtype=np.int64), np.cumsum(steps_b, dtype=np.int64)
    if not len(a) or not len(b):
        return
    in_a, in_b = alignment.merge_path(a, b, piece)
    sizes = np.diff(in_a + in_b)
    assert (sizes[:-1] == piece).all() and 0 <= sizes[-1] <= piece
    merged = sorted([(int(x), 0) for x in a] + [(int(x), 1) for x in b])
    assert [sum(s == 0 for _, s in merged[:d]) for d in in_a + in_b] == in_a.tolist()
    stops_a, stops_b = alignment.common_ends(a, b, piece)
    common = sorted(set(a.tolist()) & set(b.tolist()))
    assert a[stops_a - 1].tolist() == b[stops_b - 1].tolist() == common


def test_empty_table(docs, workspace):
    counted = alignment.count_pairs(alignment.align(docs.limit(0), *PATHS), workspace)
    assert alignment.with_pair_counts(counted).collect() == []
