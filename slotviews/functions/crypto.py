"""Column encryption with Spark's own AES functions (no Python workers)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotviews.errors import SpecError
from slotviews.operators.columns import quoted


def encrypt(column: Column, key: str) -> Column:
    """Base64 cipher text of the value's text, on one line; null stays null."""
    return F.translate(F.base64(F.aes_encrypt(column.cast("string"), F.lit(key))), "\r\n", "")


def decrypt(column: Column, key: str) -> Column:
    return F.aes_decrypt(F.unbase64(column), F.lit(key)).cast("string")


def _checked(df: DataFrame, names: Sequence[str]) -> list[str]:
    unknown = [name for name in names if name not in df.columns]
    if unknown:
        # a nested name would leave the plain value in its struct
        raise SpecError(f"sensitive columns must be top-level columns: {', '.join(unknown)}")
    return list(names)


def encrypt_columns(df: DataFrame, names: Sequence[str], key: str) -> DataFrame:
    """Sensitive columns replaced in place by their cipher text."""
    return df.withColumns({n: encrypt(F.col(quoted(n)), key) for n in _checked(df, names)})


def decrypt_columns(
    df: DataFrame, names: Sequence[str], key: str, types: Mapping[str, str] | None = None
) -> DataFrame:
    """The reverse; ``types`` casts a decrypted column back to its former type."""
    types = types or {}
    plain = {n: decrypt(F.col(quoted(n)), key) for n in _checked(df, names)}
    return df.withColumns({n: c.cast(types[n]) if n in types else c for n, c in plain.items()})
