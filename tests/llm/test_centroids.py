"""k-means with bounds against full scans in plain Python integers."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from slotviews.llm import centroids
from slotviews.llm.common import LARGEST

TABLE = "vec_id bigint, embedding array<float>, label int, cluster int, v string, part string"


def plain(rows, first, rounds):
    """rows: (id, ints). Returns {id: (cluster, distance)} and the centroids."""
    now = [list(c) for c in first]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), k) for k, c in enumerate(now))

    for step in range(rounds + 1):
        found = [(i, v, *nearest(v)[::-1]) for i, v in rows]
        if step < rounds:
            for k in range(len(now)):
                own = [v for _, v, c, _ in found if c == k]
                if own:
                    now[k] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    return sorted((i, c, d) for i, _, c, d in found), now


def vectors(spark, rows, parts=4):
    return spark.createDataFrame(rows, "vec_id bigint, v array<int>").repartition(parts)


@pytest.mark.parametrize("dims, k, spread", [(2, 5, 40), (8, 12, 300), (3, 1, 9), (4, 3, LARGEST)])
def test_every_assignment_is_that_of_a_full_scan(spark, dims, k, spread):
    draw = np.random.default_rng(dims)
    rows = [(i, [int(x) for x in draw.integers(-spread, spread + 1, dims)]) for i in range(200)]
    rows += [(1000 + i, v) for i, (_, v) in enumerate(rows[:40])]  # equal vectors
    first = [v for _, v in rows[:k]]
    assigned, final, passes = centroids.cluster(vectors(spark, rows), first, 4)
    want, moved = plain(rows, first, 4)
    assert sorted(tuple(r) for r in assigned.collect()) == want and final == moved
    assert sum(passes[-1]["inertia"]) == sum(d for _, _, d in want) and sum(passes[-1]["n"]) == len(rows)


def test_ties_go_to_the_smaller_number_and_empty_clusters_stay(spark):
    rows = [(1, [0, 0]), (2, [4, 0]), (3, [2, 0])]
    first = [[0, 0], [4, 0], [4, 0], [50, 50]]
    assigned, final, _ = centroids.cluster(vectors(spark, rows), first, 0)
    assert sorted(tuple(r) for r in assigned.collect()) == [(1, 0, 0), (2, 1, 0), (3, 0, 4)]
    assigned, final, _ = centroids.cluster(vectors(spark, rows), first, 2)
    assert final == plain(rows, first, 2)[1] and final[3] == [50, 50]


def test_means_round_down(spark):
    rows = [(1, [-1, 3]), (2, [-2, 4])]
    assert centroids.cluster(vectors(spark, rows), [[0, 0]], 1)[1] == [[-2, 3]]


def test_loosening_is_a_bound_and_tighter_than_the_drift():
    draw = np.random.default_rng(7)
    tight = total = 0
    for dims in (2, 3, 16):
        for _ in range(40):
            old = draw.normal(0, 100, (6, dims))
            new = old + draw.normal(0, draw.choice([1, 10, 60]), (6, dims))
            radius = draw.uniform(1, 120, 6)
            bound = centroids.loosening(old, new, radius)
            drift = np.sqrt(((new - old) ** 2).sum(1))
            for i in range(6):
                ball = draw.normal(0, 1, (400, dims))
                ball *= radius[i] * draw.uniform(0, 1, (400, 1)) ** (1 / dims) / np.sqrt((ball**2).sum(1))[:, None]
                x = old[i] + ball
                nearer = max(float((np.sqrt(((x - old[j]) ** 2).sum(1)) - np.sqrt(((x - new[j]) ** 2).sum(1))).max()) for j in range(6) if j != i)
                full = max(drift[j] for j in range(6) if j != i)
                assert nearer <= bound[i] <= full * (1 + 1e-6) + 1e-3
                tight, total = tight + (bound[i] < 0.9 * full), total + 1
    assert tight > total / 4


def test_few_vectors_are_scanned_again(spark):
    draw = np.random.default_rng(3)
    centres = draw.integers(-2000, 2000, (10, 6))
    rows = [(i, [int(x) for x in centres[i % 10] + draw.integers(-60, 60, 6)]) for i in range(2000)]
    first = [rows[i][1] for i in range(10)]
    _, _, passes = centroids.cluster(vectors(spark, rows), first, 3)
    assert sum(passes[0]["scanned"]) == 2000 and sum(passes[1]["scanned"]) < 200


def test_odd_vectors(spark):
    good = [0.5] * 64
    rows = [(1, good), (2, None), (3, []), (4, [0.5] * 63), (5, [None] + good[1:]), (6, [float("nan")] + good[1:]), (7, [float("inf")] + good[1:]), (8, [1e30] + good[1:]), (None, good), (9, [-0.001] * 64), (1, good)]
    table = spark.createDataFrame([(i, v, 1, 2, "a", "b") for i, v in rows], TABLE)
    found = centroids.integer_vectors(table, 64, 256)
    assert sorted(found.select("vec_id", F.col("v")[0].alias("x")).collect(), key=str) == [(1, 128), (1, 128), (9, -1), (None, 128)]
    first = centroids.seeds(found, 40, "2")
    order = sorted([("1", 128), ("1", 128), ("9", -1)], key=lambda r: hashlib.sha256(f"2:{r[0]}".encode()).hexdigest())
    assert [v[0] for v in first] == [x for _, x in order] + [128]
    assigned, final, passes = centroids.cluster(found, first, 5)
    assert centroids.with_inertia(assigned, final, passes).count() == 4


def test_empty_table(spark):
    found = centroids.integer_vectors(spark.createDataFrame([], TABLE), 64, 256)
    rows = centroids.with_inertia(*centroids.cluster(found, centroids.seeds(found, 40, "2"), 5))
    assert rows.count() == 0 and "inertia" in rows.columns
