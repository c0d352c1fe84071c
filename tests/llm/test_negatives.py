"""Hard negatives against all pairs in plain Python integers."""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import negatives

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "vec_id bigint, embedding array<double>, label int"
SMALL = negatives.Settings(rows_per_block=16, anchors_per_block=2, first_step=2)


def plain(rows, anchors, settings=negatives.Settings()):
    kept = []
    for n, (id_, vector, label) in enumerate(rows):
        if id_ is None or label is None or vector is None:
            continue
        if any(x is None or not math.isfinite(x) for x in vector):
            continue
        kept.append((n, id_, [math.floor(settings.scale * x) for x in vector], label))
    found = []
    for n, id_, a, label in kept:
        if not anchors(id_):
            continue
        scored = [(-sum(x * y for x, y in zip(a, v)), other, m, its) for m, other, v, its in kept if m != n]
        positives = sorted(r for r in scored if r[3] == label)[: settings.positives]
        others = sorted(r for r in scored if r[3] != label)
        for p, positive, *_ in positives:
            fits = [r for r in others if settings.low * -p <= 100 * -r[0] <= settings.high * -p]
            for rank, (s, negative, *_) in enumerate(fits[: settings.negatives], 1):
                clip = lambda v: min(max(v, -(2**63)), 2**63 - 1)
                found.append((id_, positive, rank, negative, clip(-p), clip(-s)))
    return found


def mined(spark, workspace, rows, settings, every=3):
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    # Names that the operator uses itself.
    df = df.withColumns({c: F.lit("x") for c in ("id", "row", "number", "anchor", "vector", "seq")})
    return negatives.mine(
        df, workspace, anchor=F.col("vec_id") % every == 0, label=F.col("label"), settings=settings
    )


def check(spark, workspace, rows, settings=SMALL, every=3):
    got = mined(spark, workspace, rows, settings, every)
    assert got.columns == [
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    ]
    expected = plain(rows, lambda n: n % every == 0, settings)
    assert Counter(map(tuple, got.collect())) == Counter(expected)
    return expected


def vectors(n, width=6, seed=1):
    return np.random.default_rng(seed).normal(0, 0.3, (n, width)).tolist()


def test_given_rows(spark, workspace):
    table = spark.read.parquet(f"{SF_DIR}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in table.collect()]
    assert check(spark, workspace, rows, every=50)


def test_nulls_nans_ragged_and_empty_vectors(spark, workspace):
    v = vectors(30)
    rows = [(n, v[n], n % 3) for n in range(30)]
    rows += [(None, v[0], 0), (30, None, 0), (33, v[1], None), (36, [None] * 6, 1)]
    rows += [(39, [math.nan] + v[2][1:], 1), (42, [math.inf] + v[2][1:], 1), (45, [-math.inf], 2)]
    rows += [(48, [], 0), (51, v[3][:2], 1), (54, v[4] + [0.5, -0.5], 2), (55, v[4] + [0.4, 0.9], 0)]
    rows += [(57, [0.0] * 6, 1), (60, [0.0] * 6, 1), (61, [0.0] * 6, 2)]
    assert check(spark, workspace, rows)


def test_ties_and_copies(spark, workspace):
    same = [0.5, -0.25, 0.125]
    rows = [(n, same, n % 2) for n in range(120)]
    found = check(spark, workspace, rows)
    assert {r[3] for r in found if r[0] == 0} == {1, 3, 5, 7, 9}


def test_repeated_ids(spark, workspace):
    v = vectors(12, seed=3)
    rows = [(n % 4, v[n], n % 3) for n in range(12)] + [(3, v[3], 0)] * 8
    assert check(spark, workspace, rows)


@pytest.mark.parametrize("size", [1e7, 1e30])
def test_scores_beyond_doubles_and_longs(spark, workspace, size):
    v = (np.array(vectors(40, seed=5)) * size).tolist()
    assert check(spark, workspace, [(n, v[n], n % 2) for n in range(40)])


def test_same_for_all_block_sizes(spark, workspace):
    v = vectors(150, seed=7)
    rows = [(n, v[n], n % 4) for n in range(150)]
    for settings in (negatives.Settings(), negatives.Settings(block_bytes=200), negatives.Settings(tasks=2, rows_per_block=9, anchors_per_block=5)):
        check(spark, workspace, rows, settings)


def test_no_rows_and_no_anchors(spark, workspace):
    assert mined(spark, workspace, [], SMALL).collect() == []
    assert mined(spark, workspace, [(1, [0.1], 0), (2, [0.1], 1)], SMALL).collect() == []
    # One row of its label has no positive, a positive below 0 no window.
    assert mined(spark, workspace, [(3, [0.1], 0), (4, [0.1], 1)], SMALL).collect() == []
    assert mined(spark, workspace, [(3, [0.1], 0), (4, [-0.1], 0), (5, [-0.1], 1)], SMALL).collect() == []


def test_stops_before_the_end_of_the_lists():
    rng = np.random.default_rng(2)
    near = np.floor(256 * rng.normal(0, 0.02, (2000, 4)))
    near[7] = near[11] = [250, 250, 250, 250]
    import pyarrow as pa

    flat = pa.array(near.ravel().astype("int16"))
    lists = pa.ListArray.from_arrays(pa.array(np.arange(2001) * 4, pa.int32()), flat)
    number = pa.array(np.arange(2000))
    batch = pa.RecordBatch.from_arrays([number, number, number, lists], ["row", "id", "label", "vector"])
    settings = negatives.Settings()
    block = negatives._RowBlock(batch, 4, settings)
    best = negatives._Best(2, -math.inf, math.inf)
    depth = negatives._search(np.array([200.0, 210, 190, 220]), block, np.ones(2000, bool), [best], 8)
    assert [r[1] for r in best.rows] == [7, 11]
    assert depth < 100


def test_scale_must_be_a_power_of_two():
    with pytest.raises(ValueError):
        negatives.Settings(scale=100)
