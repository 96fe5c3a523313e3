"""First N rows per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def first_n_per_group(
    df: DataFrame, group: Sequence[str], order: Sequence[str], n: int, splits: int = 64
) -> DataFrame:
    """The first ``n`` rows of each group in the given order, exactly.

    Spark drops all but ``n`` rows per group and task before the shuffle, but a group
    present in every task would still send n rows per task to a single reducer. The
    group is therefore ranked in ``splits`` parts first, a task's rows all in one of them,
    so ``n`` rows per group leave a task; the second ranking sees at most ``splits * n``
    rows per group. The order should be total: then the parts do not show in the result.
    """
    part, rank = "__part", "__rank"
    in_part = W.partitionBy(*group, part).orderBy(*order)
    in_group = W.partitionBy(*group).orderBy(*order)
    return (
        df.withColumn(part, F.spark_partition_id() % splits)
        .withColumn(rank, F.row_number().over(in_part))
        .where(F.col(rank) <= n)
        .withColumn(rank, F.row_number().over(in_group))
        .where(F.col(rank) <= n)
        .drop(part, rank)
    )
