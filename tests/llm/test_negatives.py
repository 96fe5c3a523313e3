"""Hard negatives against all pairs, and the index against plain products."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from slotviews.llm import negatives
from slotviews.llm.common import LARGEST, scaled

ROWS = "vec_id bigint, label int, v array<bigint>, key string, tile int, score bigint"


def expected(rows, positives=5, n=3, window=(50, 95)):
    """rows: (id, label, ints) without repeats."""
    usable = [r for r in dict.fromkeys((i, label, None if v is None else tuple(v)) for i, label, v in rows) if r[0] is not None and r[1] is not None and r[2] is not None and all(x is not None and abs(x) <= LARGEST for x in r[2])]
    out = []
    for a in usable:
        if a[0] % 50:
            continue
        scored = sorted(((-sum(x * y for x, y in zip(a[2], r[2], strict=False)), r[0], r[1]) for r in usable if r is not a))
        for minus, positive, _ in [s for s in scored if s[2] == a[1]][:positives]:
            p = -minus
            fits = [s for s in scored if s[2] != a[1] and window[0] * p <= -100 * s[0] <= window[1] * p][:n]
            out += [(a[0], positive, rank, s[1], p, -s[0]) for rank, s in enumerate(fits, 1)]
    return sorted(out)


def found(spark, rows, **options):
    table = spark.createDataFrame([(i, label, v, "k", 1, 2) for i, label, v in rows], ROWS)
    return sorted(tuple(r) for r in negatives.hard_negatives(table, F.col("vec_id") % 50 == 0, **options).collect())


def clustered(seed, n, dims, labels, scale=256):
    draw = np.random.default_rng(seed)
    centres = draw.normal(0, 1, (labels, dims))
    out = []
    for i in range(n):
        label = int(draw.integers(0, labels))
        x = centres[label] + draw.normal(0, 1.5, dims)
        out.append((i, label, [int(c) for c in np.floor(scale * x / np.linalg.norm(x))]))
    return out


@pytest.mark.parametrize("seed, n, dims, labels", [(1, 400, 64, 4), (2, 300, 9, 2), (3, 120, 64, 60)])
def test_agrees_with_all_pairs(spark, seed, n, dims, labels):
    rows = clustered(seed, n, dims, labels)
    assert found(spark, rows) == expected(rows)


def test_other_sizes_of_the_windows(spark):
    rows = clustered(4, 200, 16, 3)
    assert found(spark, rows, positives=2, negatives=7, window=(20, 60)) == expected(rows, 2, 7, (20, 60))


def test_odd_rows(spark):
    rows = clustered(5, 150, 8, 3)
    rows += [(200, None, [1] * 8), (250, 1, None), (300, 1, [1, None]), (None, 1, [1] * 8), (350, 1, []), (400, 2, [3, 4]), (450, 0, [0] * 8), (500, 1, [LARGEST + 1] * 8)]
    rows += [(550, 1, [LARGEST, -LARGEST] * 4), (551, 1, [LARGEST, -LARGEST] * 4), (552, 2, [LARGEST // 2, -LARGEST // 2] * 4 + [5]), (600, 9, [1] * 8)]
    rows += rows[:20]  # repeats count once
    assert found(spark, rows) == expected(rows)


def test_ties_go_to_smaller_ids(spark):
    rows = [(i, i % 2, [10, 10]) for i in range(101)] + [(i, 1, [7, 7]) for i in range(200, 230)]
    assert found(spark, rows) == expected(rows)


def test_one_label_and_an_empty_table(spark):
    assert found(spark, [(i, 1, [i, 1]) for i in range(60)]) == []
    assert found(spark, []) == []


def test_nothing_of_a_negative_positive(spark):
    rows = [(0, 1, [5, 0]), (1, 1, [-5, 0]), (2, 2, [-4, 0]), (3, 2, [0, 9]), (4, 1, [0, 3])]
    assert found(spark, rows) == expected(rows) == [(0, 4, 1, 3, 0, 0)]


@pytest.mark.parametrize("scale", [1, 256, 2**20])
def test_index_finds_all_pairs_above_thresholds(scale):
    draw = np.random.default_rng(scale)
    rows = (draw.normal(0, 1, (900, 40)) * np.linspace(3, 0.1, 40) * scale).astype(np.int64)
    anchors = rows[:50] + 1
    scores = anchors @ rows.T
    for share in (0.999, 0.9, 0.5, 0.0):
        thresholds = np.quantile(scores, share, axis=1).astype(np.int64)
        a, x, s = negatives.Index(rows).reach(anchors, thresholds)
        want = np.argwhere(scores >= thresholds[:, None])
        assert sorted(zip(a.tolist(), x.tolist(), strict=True)) == [tuple(p) for p in want.tolist()]
        assert (s == scores[a, x]).all()


def test_high_thresholds_leave_dimensions_out():
    draw = np.random.default_rng(9)
    rows = (draw.normal(0, 1, (500, 64)) * np.linspace(2, 0.05, 64) * 100).astype(np.int64)
    index = negatives.Index(rows)
    anchors = rows[:20]
    top = np.full(20, int(0.7 * (anchors**2).sum(1).max()))
    rests = index.norms(anchors[:, index.order].astype(float))
    lists = (rests.max(0) * index.tails >= top.min()).sum(1)
    assert lists.mean() < 0.6 * len(index.bounds)
    a, x, _ = index.reach(anchors, top)
    assert len(a) == int((anchors @ rows.T >= top[:, None]).sum())


def test_scaled_floors_and_refuses(spark):
    rows = spark.createDataFrame([([0.5, -0.001, None, float("nan"), float("-inf"), 1e30],)], "x array<float>")
    assert rows.select(scaled(F.col("x"), 256)).first()[0] == [128, -1, None, None, None, None]
