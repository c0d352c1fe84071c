"""Mixing against a plain version: resharing round by round, documents cut one after the other."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tidemark.llm import mixing

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, source string, text string, size string, target string, row string"
AWKWARD = [
    (None, "src1", "no id here", "x", "y", "z"),
    (None, "src1", "no id here", "x", "y", "z"),
    (None, None, None, None, None, None),
    (1, None, "null source \t two  words\x0bmore\x85same", "x", "y", "z"),
    (1, None, "null source \t two  words\x0bmore\x85same", "x", "y", "z"),
    (2, "", "empty source", "x", "y", "z"),
    (3, "nothing", "", "x", "y", "z"),
    (4, "nothing", " \n\t", "x", "y", "z"),
    (5, "ünï", "wörds " * 5000, "x", "y", "z"),
    (6, "\U0001f600", "after the others by code point", "x", "y", "z"),
    (7, "￿", "before the one above", "x", "y", "z"),
    *[(8, "copies", "the same row again and again", "x", "y", "z")] * 60,
]


@pytest.fixture(scope="module")
def docs(spark):
    real = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "source", "text")
    real = real.withColumns({c: F.lit("x") for c in ("size", "target", "row")})
    return real.unionByName(spark.createDataFrame(AWKWARD, SCHEMA)).cache()


def plain_targets(sizes, weights=(3, 1, 2), percent=150, repeats=2):
    """Give out by weight; what is over a cap is given out again, until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[n % len(weights)] for n, s in enumerate(order)}
    targets, left, open_ = dict.fromkeys(sizes, 0.0), percent * sum(sizes.values()) / 100, set(sizes)
    while left > 1e-9 and open_:
        whole = sum(weight[s] for s in open_)
        for s in open_:
            targets[s] += left * weight[s] / whole
        left = sum(max(targets[s] - repeats * sizes[s], 0) for s in open_)
        targets = {s: min(t, repeats * sizes[s]) for s, t in targets.items()}
        open_ = {s for s in open_ if targets[s] < repeats * sizes[s]}
    return targets


def plain(rows):
    by_source = defaultdict(list)
    for doc_id, source, text in rows:
        size = len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
        key = hashlib.md5(f"mix:{'' if doc_id is None else doc_id}".encode()).hexdigest()
        by_source[source].append((key, doc_id is not None, doc_id or 0, size, doc_id))
    sizes = {s: sum(r[3] for r in own) for s, own in by_source.items()}
    for source, target in plain_targets(sizes).items():
        budget = int(target + 1e-6)
        whole = budget // sizes[source] if sizes[source] else 0
        left = budget - whole * sizes[source]
        for *_, size, doc_id in sorted(by_source[source], key=lambda r: r[:4]):
            part = min(left, size)
            left -= part
            yield doc_id, size, sizes[source], round(target, 4), whole * size + part


@pytest.mark.parametrize("range_rows", [7, 2_000_000])
def test_against_plain_version(docs, workspace, range_rows):
    got = mixing.mix(docs, workspace, mixing.Settings(range_rows=range_rows))
    assert got.columns == ["doc_id", "size", "source_size", "target", "taken"]
    rows = [(r[0], r[1], r[2], round(r[3], 4), r[4]) for r in got.collect()]
    expected = list(plain([(r["doc_id"], r["source"], r["text"]) for r in docs.collect()]))
    assert Counter(rows) == Counter(expected)
    assert all(taken <= 2 * size for _, size, _, _, taken in rows)


def test_budgets_are_met_and_reruns_agree(docs, workspace):
    kept = mixing.mix(docs, workspace, keep=["source", "row"])
    rows = [tuple(r) for r in kept.collect()]
    taken, targets = defaultdict(int), {}
    for _, _, _, target, words, source, _ in rows:
        taken[source] += words
        targets[source] = target
    assert all(0 <= targets[s] - taken[s] < 1 for s in targets)
    again = mixing.mix(docs.repartition(13), workspace, keep=["source", "row"])
    assert Counter(rows) == Counter(map(tuple, again.collect()))


def test_one_epoch_or_several(spark, workspace):
    rows = [(n, "ab"[n % 2], "word " * 10) for n in range(40)]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, text string")
    settings = mixing.Settings(weights=(1, 9), percent=100)
    got = mixing.mix(docs, workspace, settings, keep=["source"]).collect()
    # a by weight: 40 of 400 words, b: 360 of its 200 in two epochs.
    assert sum(r["taken"] for r in got if r["source"] == "a") == 40
    assert sum(r["taken"] for r in got if r["source"] == "b") == 360
    assert {r["taken"] for r in got if r["source"] == "b"} == {10, 20}


def test_empty_and_blank_tables(docs, workspace):
    assert mixing.mix(docs.limit(0), workspace).collect() == []
    blank = mixing.mix(docs.withColumn("text", F.lit(None).cast("string")), workspace).collect()
    assert {(r["size"], r["target"], r["taken"]) for r in blank} == {(0, 0.0, 0)}


def test_impossible_settings():
    with pytest.raises(ValueError):
        mixing.Settings(percent=201)
    with pytest.raises(ValueError):
        mixing.Settings(weights=(0,))


def test_main_path_is_native(docs, workspace):
    plan = mixing.mix(docs, workspace)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
