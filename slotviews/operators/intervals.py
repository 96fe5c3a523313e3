"""Next-event and interval joins that hold when one key has most of the rows.

The plain forms are a theta self join (quadratic per key) or a window over the whole
key (one task per key). Here time is cut into spans. For next events: inside a span a
key has at most one *distinct* time per time unit, so after ``distinct`` a window group
is bounded by the span length whatever the data volume; a second, much smaller window per
key carries the edge value from one non-empty span to the next. Rows are then joined back
by (keys, time), which spreads a hot key over all partitions. For intervals: a binned
equi join, see ``matches``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

HORIZON_MS = 300_000
SPAN_MS = 3_600_000

_T, _SPAN = "__t", "__span"


def _all_present(names: Sequence[str]) -> Column:
    test = F.lit(True)
    for name in names:
        test = test & F.col(name).isNotNull()
    return test


def _spanned(df: DataFrame, span: int) -> DataFrame:
    t = F.col(_T)
    return df.withColumn(_SPAN, t - F.pmod(t, F.lit(span)))


def _renamed(df: DataFrame, names: Sequence[str], prefix: str) -> DataFrame:
    return df.withColumnsRenamed({name: prefix + name for name in names})


def _equal(names: Sequence[str], prefix: str) -> Column:
    test = F.lit(True)
    for name in names:
        test = test & (F.col(name) == F.col(prefix + name))
    return test


def next_times(df: DataFrame, keys: Sequence[str], time: str, span: int = SPAN_MS) -> DataFrame:
    """Distinct (keys, time) with the next strictly later time of the same key.

    Columns: the keys, ``time`` and ``next_time`` (null for a key's last time).
    Rows with a null key or time have no successor and are left out.
    """
    times = df.select(*keys, F.col(time).alias(_T)).where(_all_present([*keys, _T]))
    times = _spanned(times.distinct(), span)
    inside = W.partitionBy(*keys, _SPAN).orderBy(_T)
    times = times.withColumns(
        {"next_time": F.lead(_T).over(inside), "__first": F.first(_T).over(inside)}
    )
    # the last time of a span is followed by the first one of the key's next span
    across = W.partitionBy(*keys).orderBy(_SPAN)
    edges = times.where("next_time IS NULL").withColumn("next_time", F.lead("__first").over(across))
    followed = times.where("next_time IS NOT NULL").unionByName(edges)
    return followed.select(*keys, F.col(_T).alias(time), "next_time")


def next_event(
    df: DataFrame,
    keys: Sequence[str],
    time: str,
    out: str = "next_time",
    horizon: int = HORIZON_MS,
    span: int = SPAN_MS,
) -> DataFrame:
    """Adds the next strictly later time of the same key, else ``time + horizon``."""
    following = next_times(df, keys, time, span)
    following = _renamed(following, [*keys, time, "next_time"], "__n_")
    joined = df.join(following, _equal([*keys, time], "__n_"), "left")
    return joined.select(
        *df.columns, F.coalesce("__n_next_time", F.col(time) + F.lit(horizon)).alias(out)
    )


def _bins(span: int) -> tuple[int, ...]:
    """Widths of the bin levels; above the last one a key has a single bin."""
    return span, 24 * span, 24 * 32 * span


def _level(start: Column, end: Column, widths: Sequence[int]) -> Column:
    """The first level at which an interval touches at most 33 bins."""
    length = F.try_subtract(end, start)  # null where it leaves 64 bits: the last level
    level = F.lit(len(widths))
    for number in reversed(range(len(widths))):
        level = F.when(length <= F.lit(32 * widths[number]), F.lit(number)).otherwise(level)
    return level


def _bin(t: Column, level: Column, widths: Sequence[int]) -> Column:
    """A bin's number; it never falls as time grows, so an interval touches those of its ends and all between."""
    number = F.lit(0).cast("bigint")
    for at, width in enumerate(widths):
        number = F.when(level == at, F.floor(t / F.lit(width))).otherwise(number)
    return number


def matches(
    points: DataFrame,
    intervals: DataFrame,
    keys: Sequence[str],
    time: str,
    start: str,
    end: str,
    span: int = SPAN_MS,
    salts: int = 1,
) -> DataFrame:
    """Inner join: each pair of a point row and an interval row that contains its time.

    Both ends are inclusive; intervals may overlap, repeat and be of any length. Time is
    cut into bins at several levels, each level's wider than the last. An interval is
    listed in the bins it touches at the one level where these are few, a point in its bin
    of every level, so a pair meets once, in an equi join on keys, level and bin. Long
    intervals thus cost a few rows and short ones compare with few points. A key with most
    of the points is spread by time; with ``salts`` its points in one bin are dealt over as
    many groups, and intervals are listed in each.

    Rows with a null key or time match nothing, nor do intervals that end before they
    start. Columns other than the keys must not clash; the keys are the points'.
    """
    widths = _bins(span)
    p, s, e = F.col(time).cast("bigint"), F.col(start).cast("bigint"), F.col(end).cast("bigint")
    levels = F.array(*map(F.lit, range(len(widths) + 1)))
    left = points.where(_all_present([*keys, time])).withColumn("__level", F.explode(levels))
    left = left.withColumn("__bin", _bin(p, F.col("__level"), widths))
    left = left.withColumn("__salt", F.pmod(F.xxhash64(*points.columns), F.lit(salts)) if salts > 1 else F.lit(0).cast("bigint"))
    right = intervals.where(_all_present([*keys, start, end]) & (F.col(start) <= F.col(end)))
    right = right.withColumn("__level", _level(s, e, widths))
    right = right.withColumn("__bin", F.explode(F.sequence(_bin(s, F.col("__level"), widths), _bin(e, F.col("__level"), widths))))
    right = right.withColumn("__salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint"))))
    shared = [*keys, "__level", "__bin", "__salt"]
    right = _renamed(right, shared, "__m_")
    inside = (F.col(start) <= F.col(time)) & (F.col(time) <= F.col(end))
    joined = left.join(right, _equal(shared, "__m_") & inside, "inner")
    return joined.drop("__level", "__bin", "__salt", *[f"__m_{name}" for name in shared])


def intervals_of_points(
    points: DataFrame,
    intervals: DataFrame,
    keys: Sequence[str],
    time: str,
    start: str,
    end: str,
    span: int = SPAN_MS,
) -> DataFrame:
    """Each interval row once per distinct point time in it; adds ``time``."""
    times = points.select(*keys, time).distinct()
    return matches(times, intervals, keys, time, start, end, span)


def points_in_intervals(
    points: DataFrame,
    intervals: DataFrame,
    keys: Sequence[str],
    time: str,
    start: str,
    end: str,
    span: int = SPAN_MS,
    salts: int = 1,
) -> DataFrame:
    """Each point row once per distinct interval around it; adds ``start`` and ``end``."""
    ends = intervals.select(*keys, start, end).distinct()
    return matches(points, ends, keys, time, start, end, span, salts)


def attach(left: DataFrame, tagged: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join of tagged rows on the keys, which are kept from the left side."""
    renamed = _renamed(tagged, keys, "__a_")
    joined = left.join(renamed, _equal(keys, "__a_"), "left")
    return joined.drop(*[f"__a_{name}" for name in keys])


def join_containing(
    points: DataFrame,
    intervals: DataFrame,
    keys: Sequence[str],
    time: str,
    start: str,
    end: str,
    span: int = SPAN_MS,
) -> DataFrame:
    """Left join: each point row with every interval row that contains its time.

    Intervals may overlap; see ``matches``. Rows of the points meet only their own result,
    by keys and time, so rows that cannot match and a hot key are split as in any join.
    Columns of ``intervals`` other than the keys must not clash with the points'.
    """
    tagged = intervals_of_points(points, intervals, keys, time, start, end, span)
    return attach(points, tagged, [*keys, time])


def join_contained(
    intervals: DataFrame,
    points: DataFrame,
    keys: Sequence[str],
    start: str,
    end: str,
    time: str,
    span: int = SPAN_MS,
    salts: int = 1,
) -> DataFrame:
    """Left join: each interval row with every point row inside it.

    Intervals may overlap; see ``matches``. ``salts`` deals the points of one key and bin
    over several groups. Columns of ``points`` other than the keys must not clash with the intervals'.
    """
    tagged = points_in_intervals(points, intervals, keys, time, start, end, span, salts)
    return attach(intervals, tagged, [*keys, start, end])
