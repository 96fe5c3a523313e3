"""Operators on the column set: flattening, name encoding, defaults, row text."""

from __future__ import annotations

from collections.abc import Iterable
from urllib.parse import quote_plus, unquote_plus

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slotviews.errors import SpecError


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def leaf_paths(schema: T.StructType, prefix: tuple[str, ...] = ()) -> list[tuple[str, ...]]:
    paths = []
    for field in schema.fields:
        path = (*prefix, field.name)
        if isinstance(field.dataType, T.StructType):
            paths += leaf_paths(field.dataType, path)
        else:
            paths.append(path)
    return paths


def flatten(df: DataFrame) -> DataFrame:
    """Every leaf of nested structs as a column named ``outer_inner``."""
    return df.select(
        *[F.col(".".join(map(quoted, path))).alias("_".join(path)) for path in leaf_paths(df.schema)]
    )


def expand_structs(df: DataFrame, *structs: str) -> DataFrame:
    """Star expansion of one or more structs, in the given order."""
    return df.select(*[f"{name}.*" for name in structs])


def encode_name(name: str) -> str:
    # form encoding keeps letters, digits and . - * _ only
    return quote_plus(name, safe="*").replace("~", "%7E")


def encode_names(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({name: encode_name(name) for name in df.columns})


def decode_names(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({name: unquote_plus(name) for name in df.columns})


def ensure_client(df: DataFrame, client: str) -> DataFrame:
    return df if "client" in df.columns else df.withColumn("client", F.lit(client))


def fill_blank(df: DataFrame) -> DataFrame:
    """Null text becomes empty text; other types stay null."""
    return df.na.fill("")


def all_nullable(df: DataFrame) -> DataFrame:
    """The same rows with every top-level column declared nullable."""
    fields = [T.StructField(f.name, f.dataType, True) for f in df.schema]
    # the optimizer drops the empty side; the union is what makes the columns nullable
    return df.sparkSession.createDataFrame([], T.StructType(fields)).union(df)


def with_literals(df: DataFrame, **values) -> DataFrame:
    return df.withColumns({name: F.lit(value) for name, value in values.items()})


def row_text(names: Iterable[str], separator: str = "|") -> Column:
    """All values of a row as one text; nulls are written as ``null``."""
    texts = [F.coalesce(F.col(quoted(n)).cast("string"), F.lit("null")) for n in names]
    return F.concat_ws(separator, *texts)


def field_type(df: DataFrame, path: str) -> T.DataType | None:
    """Type of a dotted path, or None where the schema has no such field."""
    current: T.DataType = df.schema
    for name in path.split("."):
        if not isinstance(current, T.StructType) or name not in current.names:
            return None
        current = current[name].dataType
    return current


def field_exists(df: DataFrame, struct: str, field: str) -> Column:
    """True where the struct is present and its type has the field."""
    known = field_type(df, f"{struct}.{field}") is not None
    return F.when(F.col(struct).isNotNull(), F.lit(known)).otherwise(F.lit(False))


def field_value(df: DataFrame, struct: str, field: str) -> Column:
    """The field's text, or empty text where struct or field is missing."""
    if field_type(df, f"{struct}.{field}") is None:
        return F.lit("")
    return F.when(F.col(struct).isNotNull(), F.col(f"{struct}.{field}").cast("string")).otherwise(F.lit(""))


def require_columns(df: DataFrame, names: Iterable[str], purpose: str) -> None:
    missing = [name for name in names if name not in df.columns]
    if missing:
        raise SpecError(f"{purpose}: no column {', '.join(missing)}")
