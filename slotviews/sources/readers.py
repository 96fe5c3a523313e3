"""Readers of raw data, one per stored format.

Every reader has the form ``reader(spark, paths, conf) -> DataFrame``. ``conf`` is the
view's source configuration; ``schema`` in it (a StructType or DDL text) avoids the
inference pass that JSON formats otherwise need, ``seed`` (a sample JSON record) makes
sure that the sample's fields exist whatever the data holds.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slotviews.errors import ReadError, SpecError
from slotviews.functions.crypto import decrypt
from slotviews.functions.scalars import log_payload
from slotviews.sources.files import Files
from slotviews.sources.sequence_files import SequenceFileSource

Conf = Mapping[str, Any]
Reader = Callable[[SparkSession, Sequence[str], Conf], DataFrame]


def merge_schemas(first: T.DataType, second: T.DataType) -> T.DataType:
    """Fields of both schemas; where both know a field the first one's type stays."""
    if isinstance(first, T.StructType) and isinstance(second, T.StructType):
        fields = [
            T.StructField(f.name, merge_schemas(f.dataType, second[f.name].dataType) if f.name in second.names else f.dataType)
            for f in first
        ]
        return T.StructType(fields + [f for f in second if f.name not in first.names])
    if isinstance(first, T.ArrayType) and isinstance(second, T.ArrayType):
        return T.ArrayType(merge_schemas(first.elementType, second.elementType))
    return second if isinstance(first, T.NullType) else first


def schema_of_sample(spark: SparkSession, sample: str) -> T.StructType:
    """Schema of one JSON record."""
    ddl = spark.range(1).select(F.schema_of_json(F.lit(sample))).first()[0]
    return T.StructType.fromDDL(f"root {ddl}")["root"].dataType


#: a name in backticks, or what opens an object in the text of a variant's schema
_OBJECT = re.compile(r"(`(?:[^`]|``)*`)|\bOBJECT<")
_NO_NAME = "no name"


def _json_type(kind: T.DataType) -> T.DataType | None:
    """What JSON inference makes of a variant's type; None for an object without fields."""
    if isinstance(kind, T.StructType):
        types = [(name, _json_type(kind[name].dataType)) for name in sorted(kind.names) if name != _NO_NAME]
        fields = [T.StructField(name, kind) for name, kind in types if kind is not None]
        return T.StructType(fields) if fields else None
    if isinstance(kind, T.ArrayType):
        element = _json_type(kind.elementType)
        return None if element is None else T.ArrayType(element)
    if isinstance(kind, T.DecimalType):
        # whole numbers beyond 64 bits stay exact; all other numbers are doubles
        return kind if kind.scale == 0 and kind.precision > 18 else T.DoubleType()
    return T.StringType() if isinstance(kind, (T.NullType, T.VariantType)) else kind


def inferred_schema(lines: DataFrame, mode: str = "FAILFAST") -> T.StructType:
    """The schema that JSON inference finds for the text in ``value``, by one aggregate in the JVM.

    Records are parsed to variants whose types are merged with map-side partial results.
    Fields that are null everywhere, or of types that do not go together, are text. Blank
    lines count for nothing. A broken record, or one that names a field twice, is an error
    or, if ``mode`` is PERMISSIVE, adds the column for corrupt records. Whole numbers among
    decimals that are all whole (1 and 2.0) make a decimal without places, not a double.
    """
    given = lines.where(F.trim("value") != "")
    parse = F.try_parse_json if mode == "PERMISSIVE" else F.parse_json
    text, broken = given.select(parse("value").alias("v")).agg(F.schema_of_variant_agg("v"), F.count_if(F.col("v").isNull())).first()
    text = text.replace("<``: ", f"<`{_NO_NAME}`: ")  # the empty name sorts first
    kind = T.DataType.fromDDL(_OBJECT.sub(lambda m: m[1] or "STRUCT<", text))
    if not isinstance(kind, (T.StructType, T.NullType)):
        raise ReadError("records must be JSON objects")
    schema = (_json_type(kind) if isinstance(kind, T.StructType) else None) or T.StructType([])
    return schema.add(lines.sparkSession.conf.get("spark.sql.columnNameOfCorruptRecord"), "string") if broken else schema


def json_records(lines: DataFrame, conf: Conf) -> DataFrame:
    """JSON text in the single column ``value`` as columns.

    With a schema the text is parsed in one pass; otherwise all of it is read once more to
    infer the schema, and a seed's missing fields are added. A record that is no JSON, or
    does not fit the schema, is an error; ``mode = PERMISSIVE`` makes it a row of nulls.
    """
    spark = lines.sparkSession
    schema = conf.get("schema")
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    if schema is None:
        schema = inferred_schema(lines, _mode(conf))
        if conf.get("seed"):
            schema = merge_schemas(schema, schema_of_sample(spark, conf["seed"]))
    return lines.select(F.from_json("value", schema, {"mode": _mode(conf)}).alias("record")).select("record.*")


def _mode(conf: Conf) -> str:
    return conf.get("mode", "FAILFAST")


def xml_records(lines: DataFrame, conf: Conf) -> DataFrame:
    """XML text in the single column ``value`` as one struct named like its root.

    Broken records are errors, as for JSON.
    """
    if not conf.get("schema") or not conf.get("root"):
        raise SpecError("XML records need a schema and the name of their root element")
    return lines.select(F.from_xml("value", conf["schema"], {"mode": _mode(conf)}).alias(conf["root"]))


def _sequence_files(spark: SparkSession, paths: Sequence[str], kind: str, **options: str) -> DataFrame:
    """Values of all SequenceFiles at the paths (files, folders or patterns); hidden files are left out."""
    files = [found for path in paths for found in Files(spark, path).data_files(path)]
    if not files:
        raise ReadError(f"no SequenceFiles at {', '.join(paths)}")
    spark.dataSource.register(SequenceFileSource)
    return spark.read.format(SequenceFileSource.name()).options(files=json.dumps(files), kind=kind, **options).load()


def sequence_values(spark: SparkSession, paths: Sequence[str], **options: str) -> DataFrame:
    """Text values of SequenceFiles as the column ``value``; keys are dropped."""
    return _sequence_files(spark, paths, "text", **options)


def sequence_frames(spark: SparkSession, paths: Sequence[str], **options: str) -> DataFrame:
    """Binary values of SequenceFiles as the column ``frame``."""
    return _sequence_files(spark, paths, "binary", **options)


def _file_reader(spark: SparkSession, conf: Conf):
    """``base_path`` in ``conf`` makes folders of any depth below it readable at once."""
    return spark.read if conf.get("base_path") is None else spark.read.option("basePath", conf["base_path"])


def read_avro(spark: SparkSession, paths: Sequence[str], conf: Conf) -> DataFrame:
    """Avro with a fixed reader schema (needs Spark's avro package on the class path)."""
    reader = _file_reader(spark, conf).format("avro")
    if conf.get("avro_schema"):
        reader = reader.option("avroSchema", conf["avro_schema"])
    return reader.load(list(paths))


def read_json(spark: SparkSession, paths: Sequence[str], conf: Conf) -> DataFrame:
    reader = _file_reader(spark, conf)
    if conf.get("schema") is not None:
        reader = reader.schema(conf["schema"])
    return reader.json(list(paths))


def read_csv(spark: SparkSession, paths: Sequence[str], conf: Conf) -> DataFrame:
    """CSV with a header; all columns are text unless a schema is given."""
    reader = _file_reader(spark, conf).option("header", True).option("delimiter", conf.get("delimiter", ","))
    if conf.get("schema") is not None:
        reader = reader.schema(conf["schema"])
    return reader.csv(list(paths))


def read_parquet(spark: SparkSession, paths: Sequence[str], conf: Conf) -> DataFrame:
    return _file_reader(spark, conf).parquet(*paths)


def read_orc(spark: SparkSession, paths: Sequence[str], conf: Conf) -> DataFrame:
    return _file_reader(spark, conf).orc(list(paths))


def read_sequence_json(spark: SparkSession, paths: Sequence[str], conf: Conf) -> DataFrame:
    """SequenceFile of JSON texts, schema inferred and widened by the seed."""
    return json_records(sequence_values(spark, paths), conf)


def read_sequence_json_fixed(spark: SparkSession, paths: Sequence[str], conf: Conf) -> DataFrame:
    """SequenceFile of JSON texts with an explicit schema or the schema of a sample."""
    if conf.get("schema") is None and not conf.get("seed"):
        raise SpecError("this format needs a schema or a seed record")
    schema = conf.get("schema") or schema_of_sample(spark, conf["seed"])
    return json_records(sequence_values(spark, paths), {**conf, "schema": schema})


def _log_lines(spark: SparkSession, paths: Sequence[str], conf: Conf) -> DataFrame:
    if conf.get("container", "sequence") == "text":
        return spark.read.text(list(paths))
    return sequence_values(spark, paths)


def encrypted_payloads(lines: DataFrame, key: str) -> DataFrame:
    """``<prefix> - <base64 cipher text>`` lines to plain text, all in the JVM.

    A line without the separator is an error.
    """
    payload = log_payload(F.col("value"))
    broken = F.raise_error(F.lit("a log line has no payload"))
    return lines.select(decrypt(F.when(payload.isNotNull() | F.col("value").isNull(), payload).otherwise(broken), key).alias("value"))


def read_encrypted_json(spark: SparkSession, paths: Sequence[str], conf: Conf) -> DataFrame:
    """Encrypted log lines that hold JSON records."""
    return json_records(encrypted_payloads(_log_lines(spark, paths, conf), conf["key"]), conf)


def read_encrypted_xml(spark: SparkSession, paths: Sequence[str], conf: Conf) -> DataFrame:
    """Encrypted log lines that hold XML transcripts."""
    return xml_records(encrypted_payloads(_log_lines(spark, paths, conf), conf["key"]), conf)


def read_frames(spark: SparkSession, paths: Sequence[str], conf: Conf) -> DataFrame:
    """Binary log frames as the column ``frame``."""
    return sequence_frames(spark, paths)


READERS: dict[str, Reader] = {
    "AVRO": read_avro,
    "JSON": read_json,
    "CSV": read_csv,
    "PARQUET": read_parquet,
    "ORC": read_orc,
    "SEQ_JSON": read_sequence_json,
    "ASSIST_INTERACTIONS": read_encrypted_json,
    "ASSIST_INTERACTIONS_V2": read_sequence_json,
    "ASSIST_AGENTSTATS": read_encrypted_json,
    "ASSIST_TRANSCRIPTS": read_encrypted_xml,
    "ACTIVE_SHARE": read_sequence_json_fixed,
    "SESSIONIZED_BINLOG": read_frames,
}


# formats read by a Spark file source, which can take whole days of slots at once
FILE_FORMATS = ("AVRO", "JSON", "CSV", "PARQUET", "ORC")


def reader_of(fmt: str) -> Reader:
    try:
        return READERS[fmt.upper()]
    except KeyError:
        raise ReadError(f"no reader for format {fmt}") from None
