"""Key deduplication and latest-record selection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotviews.errors import DedupError
from slotviews.operators.columns import field_type


def dedup_by_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One (arbitrary) row per key tuple; a key may be a nested path.

    Runs as a hash aggregate that keeps a first row per key on the map side, so a
    key that holds most of the rows is reduced before the shuffle.
    """
    if not keys:
        return df
    unknown = [key for key in keys if field_type(df, key) is None]
    if unknown:
        raise DedupError(f"no field {', '.join(unknown)} to deduplicate by")
    if all(key in df.columns for key in keys):
        return df.dropDuplicates(list(keys))
    temporary = {f"__key_{i}": F.col(key) for i, key in enumerate(keys)}
    return df.withColumns(temporary).dropDuplicates(list(temporary)).drop(*temporary)


def latest_by(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The whole row with the greatest ``order`` per key (an upsert by key)."""
    rest = [name for name in df.columns if name not in keys]
    newest = F.max_by(F.struct(*rest), F.struct(*order)).alias("__newest")
    return df.groupBy(*keys).agg(newest).select(*keys, "__newest.*").select(*df.columns)
