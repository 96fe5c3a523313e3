import random
from collections import Counter

import pytest
from pyspark.sql import functions as F
from tests.conftest import plan_of

from slotviews.operators.intervals import _bins, _level, join_contained, join_containing, matches, next_event
from slotviews.operators.joins import left_join_any, left_join_on
from slotviews.operators.limits import first_n_per_group

NAIVE = ("CartesianProduct", "BroadcastNestedLoopJoin")


def sample(seed, n, keys=("a", "b", "hot", None), spread=3000):
    """Rows in which one key has most of the rows and times repeat."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        key = "hot" if rng.random() < 0.5 else rng.choice(keys)
        rows.append((key, rng.choice([None] + [rng.randrange(spread)] * 30), i))
    return rows


def successors(rows, horizon):
    result = []
    for key, t, i in rows:
        later = [u for k, u, _ in rows if key is not None and k == key and t is not None and u is not None and u > t]
        result.append((key, t, i, None if t is None else min(later) if later else t + horizon))
    return result


def bag(df):
    return Counter(tuple(row) for row in df.collect())


@pytest.mark.parametrize("span", [1, 7, 250, 100000])
def test_next_event_equals_the_self_join(spark, span):
    rows = sample(1, 400)
    df = spark.createDataFrame(rows, "k string, t bigint, i int")
    assert bag(next_event(df, ["k"], "t", "nxt", 50, span)) == Counter(successors(rows, 50))


@pytest.mark.parametrize("span", [1, 40, 100000])
def test_interval_joins_equal_the_range_joins(spark, span):
    starts, points = sample(2, 150), sample(3, 300)
    intervals = successors(starts, 50)
    left = next_event(spark.createDataFrame(starts, "k string, s bigint, i int"), ["k"], "s", "e", 50, span)
    right = spark.createDataFrame(points, "k string, p bigint, j int")

    def inside(a, b):
        return a[0] is not None and a[0] == b[0] and None not in (a[1], a[3], b[1]) and a[1] <= b[1] <= a[3]

    containing = []
    for point in points:
        hits = [a for a in intervals if inside(a, point)]
        containing += [(*point, a[1], a[2], a[3]) for a in hits] or [(*point, None, None, None)]
    found = join_containing(right, left, ["k"], "p", "s", "e", span).select("k", "p", "j", "s", "i", "e")
    assert bag(found) == Counter(containing)

    contained = []
    for a in intervals:
        hits = [p for p in points if inside(a, p)]
        contained += [(*a, p[1], p[2]) for p in hits] or [(*a, None, None)]
    found = join_contained(left, right, ["k"], "s", "e", "p", span).select("k", "s", "i", "e", "p", "j")
    assert bag(found) == Counter(contained)


def overlapping(seed, n, reach):
    """Intervals that overlap, repeat, share starts, end before they start, or have no end."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        key = "hot" if rng.random() < 0.5 else rng.choice(["a", None])
        start = rng.choice([None, *[rng.randrange(-500, 3000)] * 20])
        end = rng.choice([None, *[(start or 0) + rng.choice([-5, 0, 3, 40, reach])] * 20])
        rows += [(key, start, i, end)] * rng.choice([1, 1, 2])
    return rows


@pytest.mark.parametrize("span, salts", [(1, 1), (1, 3), (60, 1), (60, 4), (100000, 2)])
def test_range_joins_of_overlapping_intervals(spark, span, salts):
    intervals, points = overlapping(7, 60, 2000), sample(8, 150)
    left = spark.createDataFrame(intervals, "k string, s bigint, i int, e bigint")
    right = spark.createDataFrame(points, "k string, p bigint, j int")

    def inside(a, b):
        return a[0] is not None and a[0] == b[0] and None not in (a[1], a[3], b[1]) and a[1] <= b[1] <= a[3]

    containing, contained = [], []
    for point in points:
        containing += [(*point, a[1], a[2], a[3]) for a in intervals if inside(a, point)] or [(*point, None, None, None)]
    for a in intervals:
        contained += [(*a, p[1], p[2]) for p in points if inside(a, p)] or [(*a, None, None)]
    found = join_containing(right, left, ["k"], "p", "s", "e", span).select("k", "p", "j", "s", "i", "e")
    assert bag(found) == Counter(containing)
    found = join_contained(left, right, ["k"], "s", "e", "p", span, salts).select("k", "s", "i", "e", "p", "j")
    assert bag(found) == Counter(contained)


def test_intervals_without_bounds(spark):
    ends = [(-(2**63), 2**63 - 1), (0, 2**63 - 1), (-(2**63), 0), (2**62, 2**62 + 10)]
    left = spark.createDataFrame([("k", *pair) for pair in ends], "k string, s bigint, e bigint")
    right = spark.createDataFrame([("k", p) for p in (-(2**63), -1, 0, 1, 2**62, 2**63 - 1)], "k string, p bigint")
    found = Counter((r.s, r.e, r.p) for r in join_contained(left, right, ["k"], "s", "e", "p").collect())
    assert found == Counter((s, e, p) for s, e in ends for p in (-(2**63), -1, 0, 1, 2**62, 2**63 - 1) if s <= p <= e)


def test_a_hot_key_meets_few_rows_in_each_bin(spark):
    """All points have one key; a bin's points and intervals stay few, whatever the table's size."""
    points = spark.range(20_000).selectExpr("'hot' AS k", "id * 1000 AS p")
    intervals = spark.range(20_000).selectExpr("'hot' AS k", "id * 1000 + 300 AS s", "id * 1000 + 300 + 40 * 60000 * (id % 2) AS e")
    found = matches(points, intervals, ["k"], "p", "s", "e", 600_000)
    assert found.count() == sum(max(0, min(19_999, (i * 1000 + 300 + 2_400_000 * (i % 2)) // 1000) - i) for i in range(20_000))
    bins = intervals.withColumn("l", _level(F.col("s"), F.col("e"), _bins(600_000)))
    assert bins.selectExpr("max(l)").first()[0] == 0


@pytest.mark.parametrize("contained", [False, True])
def test_range_joins_take_five_exchanges(spark, tmp_path, contained):
    spark.range(5).selectExpr("'k' AS k", "id AS s", "id + 5 AS e", "id AS i").write.parquet(f"{tmp_path}/i")
    spark.range(5).selectExpr("'k' AS k", "id AS p", "id AS j").write.parquet(f"{tmp_path}/p")
    left, right = spark.read.parquet(f"{tmp_path}/i"), spark.read.parquet(f"{tmp_path}/p")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        rows = join_contained(left, right, ["k"], "s", "e", "p") if contained else join_containing(right, left, ["k"], "p", "s", "e")
        plan = plan_of(rows)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("Exchange hashpartitioning") <= 5 and not any(name in plan for name in NAIVE)


def test_a_point_on_a_boundary_matches_twice(spark):
    starts = spark.createDataFrame([("k", 100), ("k", 200)], "k string, s bigint")
    points = spark.createDataFrame([("k", 200)], "k string, p bigint")
    found = join_containing(points, next_event(starts, ["k"], "s", "e"), ["k"], "p", "s", "e")
    assert sorted(row.s for row in found.collect()) == [100, 200]


def test_interval_plans_compare_no_pairs(spark):
    df = spark.createDataFrame(sample(4, 50), "k string, s bigint, i int")
    left = next_event(df, ["k"], "s", "e")
    right = df.withColumnsRenamed({"s": "p", "i": "j"})
    plan = plan_of(join_contained(left, right, ["k"], "s", "e", "p"))
    assert not any(name in plan for name in NAIVE)


def test_alternative_keys_equal_the_or_join(spark):
    rng = random.Random(5)
    draw = lambda n: rng.choice([None, *range(n)])
    left = [(draw(6), draw(6), i // 2) for i in range(60)]
    right = [(draw(6), draw(6), i // 2) for i in range(40)] * 2
    expected = []
    for a, b, i in left:
        hits = [r for r in right if (a is not None and a == r[0]) or (b is not None and b == r[1])]
        expected += [(a, b, i, *r) for r in hits] or [(a, b, i, None, None, None)]
    l = spark.createDataFrame(left, "a int, b int, i int")
    r = spark.createDataFrame(right, "x int, y int, j int")
    found = left_join_any(l, r, [{"x": "a"}, {"y": "b"}])
    assert bag(found.select("a", "b", "i", "x", "y", "j")) == Counter(expected)
    assert not any(name in plan_of(found) for name in NAIVE)


def test_left_join_on_computed_keys(spark):
    l = spark.createDataFrame([(1, None), (None, 2), (None, None)], "a int, b int")
    r = spark.createDataFrame([(1, "x"), (2, "y"), (None, "z")], "k int, v string")
    found = left_join_on(l, r, {"k": F.coalesce("a", "b")})
    assert found.columns == ["a", "b", "v"] and bag(found) == Counter([(1, None, "x"), (None, 2, "y"), (None, None, None)])


@pytest.mark.parametrize("n", [1, 5, 100])
def test_first_n_per_group(spark, n):
    rng = random.Random(6)
    rows = [("hot" if rng.random() < 0.7 else rng.choice("ab"), rng.randrange(10), i) for i in range(500)]
    found = first_n_per_group(spark.createDataFrame(rows, "g string, o int, i int"), ["g"], ["o", "i"], n, splits=4)
    expected = [row for g in ("hot", "a", "b") for row in sorted(r for r in rows if r[0] == g)[:n]]
    assert bag(found) == Counter(expected)
    assert "WindowGroupLimit" in plan_of(found)
