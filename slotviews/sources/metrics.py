"""The record a run leaves behind."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

RUN_SCHEMA = (
    "id string, eventSource string, eventTime bigint, "
    "body struct<viewName_keyword: string, clientName_keyword: string, nominal_time: bigint, "
    "processingExecution_time: string, dataPaths: array<string>>"
)


def metrics_json() -> Column:
    """A record with the fields of :data:`RUN_SCHEMA` as JSON text."""
    return F.to_json(F.struct("id", "eventSource", "eventTime", "body"))


def run_metrics(
    spark: SparkSession,
    run_id: str,
    source: str,
    view: str,
    client: str,
    nominal_time: int,
    executed_at: int,
    paths: Sequence[str],
) -> DataFrame:
    """One row with the run as JSON: ``key`` and ``value``, as a message sink takes it."""
    body = (view, client, nominal_time, str(executed_at), list(paths))
    record = spark.createDataFrame([(run_id, source, executed_at, body)], RUN_SCHEMA)
    return record.select(F.col("id").alias("key"), metrics_json().alias("value"))


def append_metrics(record: DataFrame, path: str) -> None:
    record.write.mode("append").parquet(path)


def send_metrics(record: DataFrame, servers: str, topic: str) -> None:
    """Writes to a Kafka topic (needs Spark's Kafka package on the class path)."""
    writer = record.write.format("kafka").option("kafka.bootstrap.servers", servers)
    writer.option("topic", topic).save()
