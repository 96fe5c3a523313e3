"""Equi joins on computed keys and joins on alternative key sets."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def left_join_on(left: DataFrame, right: DataFrame, keys: Mapping[str, Column | str]) -> DataFrame:
    """Left join where each right column equals a column computed from the left.

    The right key columns are dropped from the result. The other column names of the
    two sides must differ.
    """
    names = {key: f"__k_{i}" for i, key in enumerate(keys)}
    keyed = right.withColumnsRenamed(names)
    tests = []
    for key, source in keys.items():
        column = F.col(source) if isinstance(source, str) else source
        tests.append(column == F.col(names[key]))
    return left.join(keyed, tests, "left").drop(*names.values())


def left_join_any(
    left: DataFrame,
    right: DataFrame,
    alternatives: Sequence[Mapping[str, str]],
) -> DataFrame:
    """Left join on ``alternatives[0] OR alternatives[1] OR ...``.

    Each alternative maps right columns to left columns that must all be equal. An
    OR condition has no equi key, so Spark would compare every pair of rows. Here the
    distinct left key tuples and the right rows are listed once for each alternative and
    meet in one equi join, on the alternative's number and its keys. A pair that an earlier
    alternative matches is left out of the later ones, so row multiplicities stay exact
    without generated row ids. The matches are then joined back by null-safe equality of
    the key tuple.
    """
    names = list(dict.fromkeys(name for keys in alternatives for name in keys.values()))
    tuples = left.select(*[F.col(name).alias(f"__l_{name}") for name in names]).distinct()

    def test(keys: Mapping[str, str]) -> Column:
        result = F.lit(True)
        for right_name, left_name in keys.items():
            result = result & (F.col(f"__l_{left_name}") == F.col(right_name))
        return result

    def listed(rows: DataFrame, side: str, keys_of) -> DataFrame:
        """The rows once for each alternative whose keys are all there; keys of the others are null."""
        number = f"__{side}_a"
        present = F.filter(F.array(*map(F.lit, range(len(alternatives)))), lambda i: _any([(i == n) & _present(keys_of(keys)) for n, keys in enumerate(alternatives)]))
        rows = rows.withColumn(number, F.explode(present))
        return rows.withColumns({f"__{side}_{n}_{k}": F.when(F.col(number) == n, F.col(name)) for n, keys in enumerate(alternatives) for k, name in enumerate(keys_of(keys))})

    lefts = listed(tuples, "t", lambda keys: [f"__l_{name}" for name in keys.values()])
    rights = listed(right, "r", list)
    same = F.col("__t_a") == F.col("__r_a")
    for n, keys in enumerate(alternatives):
        for k in range(len(keys)):
            same = same & F.col(f"__t_{n}_{k}").eqNullSafe(F.col(f"__r_{n}_{k}"))
    for n, keys in enumerate(alternatives[:-1]):
        same = same & ((F.col("__t_a") <= n) | ~F.coalesce(test(keys), F.lit(False)))
    matches = lefts.join(rights, same, "inner").select(*tuples.columns, *right.columns)

    same = F.lit(True)
    for name in names:
        same = same & F.col(name).eqNullSafe(F.col(f"__l_{name}"))
    return left.join(matches, same, "left").drop(*[f"__l_{name}" for name in names])


def _any(tests: Sequence[Column]) -> Column:
    result = F.lit(False)
    for test in tests:
        result = result | test
    return result


def _present(names: Sequence[str]) -> Column:
    return ~_any([F.col(name).isNull() for name in names])
