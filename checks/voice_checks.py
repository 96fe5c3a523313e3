"""Voice-session records and binary frame headers."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import check
from checks.tables import EVENTS_SQL, events
from slotviews.operators.voice import (
    CALL_COLUMNS,
    attribute_values,
    attribute_values_by_name,
    call_records,
    frame_header,
    label_seconds,
    split_label,
    transport_mode_id,
    uuid_time_ms,
)

MODES = ["tdm.nms", "voip.dc", "gateway", "socket.tellme", "unknown", "voip.tdm", "other"]
UUID = "printf('%08x-%04x-1%03x-8000-%012x', {low}, {mid}, {high}, user_id)"


def uuids(spark, sf_dir):
    """Events with a version 1 UUID of their time (100 ns ticks since 1582)."""
    ticks = "(epoch_ms * 10000 + 122192928000000000)"
    uuid = UUID.format(
        low=f"({ticks} & 4294967295)", mid=f"(shiftright({ticks}, 32) & 65535)", high=f"(shiftright({ticks}, 48) & 4095)"
    )
    return events(spark, sf_dir).withColumn("uuid", F.expr(uuid))


def recorded(spark, sf_dir):
    """Every event as a list of attributes, some repeated and some missing."""
    modes = ", ".join(f"'{mode}'" for mode in MODES)
    attributes = f"""filter(array(
        named_struct('key', 'uuid', 'value', uuid, 'timestamp', epoch_ms),
        named_struct('key', 'dnis', 'value', 'first', 'timestamp', epoch_ms),
        if(k % 2 = 0, named_struct('key', 'ani', 'value', concat('+1', user_id), 'timestamp', epoch_ms), NULL),
        named_struct('key', 'dnis', 'value', concat('d', k), 'timestamp', epoch_ms),
        named_struct('key', 'transport_mode', 'value', array({modes})[k % 7], 'timestamp', epoch_ms),
        if(k % 3 = 0, named_struct('key', 'termination', 'value', event_type, 'timestamp', epoch_ms), NULL),
        if(k % 5 <> 0, named_struct('key', if(k % 5 = 1, 'Log.Label', 'log.label'),
            'value', if(k % 5 = 2, event_type, concat(event_type, ':', user_id, ':', k)), 'timestamp', epoch_ms * 1000 + k), NULL),
        named_struct('key', 'not.wanted', 'value', 'x', 'timestamp', 0L)), a -> a IS NOT NULL)"""
    return uuids(spark, sf_dir).withColumn("attributes", F.expr(attributes))


SHOWN = ["uuid", "callStartTime", "dnis", "cpn", "endStatusCode", "transportModeId", "logLabel", "logMessage", "unix_timestamp", "host", "call_type"]
UUID_SQL = """printf('%08x-%04x-1%03x-8000-%012x', ticks & 4294967295, (ticks >> 32) & 65535, (ticks >> 48) & 4095, user_id)"""


@check(
    f"""WITH e AS ({EVENTS_SQL}), t AS (SELECT *, epoch_ms * 10000 + 122192928000000000 AS ticks FROM e)
    SELECT {UUID_SQL} AS uuid, epoch_ms AS "callStartTime", 'd' || k AS dnis,
      CASE WHEN k % 2 = 0 THEN '+1' || user_id ELSE 'ANI' END AS cpn,
      CASE WHEN k % 3 = 0 THEN event_type ELSE 'ENDSTATUSCODE' END AS "endStatusCode",
      CASE WHEN k % 7 < 6 THEN CAST(k % 7 + 1 AS VARCHAR) ELSE '' END AS "transportModeId",
      CASE WHEN k % 5 < 2 THEN 'LOGLABEL' WHEN k % 5 = 2 THEN event_type ELSE event_type || ':' || user_id END AS "logLabel",
      CASE WHEN k % 5 < 3 THEN '' ELSE CAST(k AS VARCHAR) END AS "logMessage",
      CASE WHEN k % 5 = 0 THEN '0.000000' ELSE (epoch_ms // 1000) || '.' || lpad(CAST((epoch_ms % 1000) * 1000 + k AS VARCHAR), 6, '0') END AS unix_timestamp,
      'HOST' AS host, '' AS call_type, 34 AS width FROM t"""
)
def call_record_columns(spark, sf_dir):
    rows = call_records(recorded(spark, sf_dir))
    return rows.select(*SHOWN, F.lit(len(rows.columns)).alias("width"))


@check(f"WITH e AS ({EVENTS_SQL}) SELECT event_id, CAST(epoch_ms AS DOUBLE) AS ms, CAST(NULL AS DOUBLE) AS short FROM e")
def uuid_time(spark, sf_dir):
    rows = uuids(spark, sf_dir)
    return rows.select("event_id", uuid_time_ms(F.col("uuid")).alias("ms"), uuid_time_ms(F.left("uuid", F.lit(12))).alias("short"))


@check(
    f"""WITH e AS ({EVENTS_SQL}) SELECT event_id, CASE WHEN k % 7 < 6 THEN CAST(k % 7 + 1 AS VARCHAR) ELSE '' END AS mode FROM e"""
)
def transport_modes(spark, sf_dir):
    names = F.array(*[F.lit(mode) for mode in MODES])
    return events(spark, sf_dir).select("event_id", transport_mode_id(F.get(names, F.col("k") % 7)).alias("mode"))


@check(
    f"""WITH e AS ({EVENTS_SQL}) SELECT event_id,
      CASE WHEN k % 3 = 0 THEN event_type WHEN k % 3 = 1 THEN event_type || ':' || user_id ELSE '' END AS label,
      CASE WHEN k % 3 = 0 THEN '' WHEN k % 3 = 1 THEN CAST(k AS VARCHAR) ELSE event_type END AS message FROM e"""
)
def label_split(spark, sf_dir):
    rows = events(spark, sf_dir)
    text = F.expr("CASE k % 3 WHEN 0 THEN event_type WHEN 1 THEN concat(event_type, ':', user_id, ':', k) ELSE concat(':', event_type) END")
    label, message = split_label(text)
    return rows.select("event_id", label.alias("label"), message.alias("message"))


@check(
    f"""WITH e AS ({EVENTS_SQL}) SELECT event_id, 'first,d' || k AS dnis, CASE WHEN k % 5 IN (3, 4) THEN 2 ELSE 1 END AS fields,
      CASE WHEN k % 5 = 0 THEN 0 ELSE 1 END AS labels,
      CASE WHEN k % 5 = 0 THEN 0 ELSE epoch_ms * 1000 + k END AS label_micros, 1 + CASE WHEN k % 2 = 0 THEN 1 ELSE 0 END AS names FROM e"""
)
def attribute_lists(spark, sf_dir):
    rows = recorded(spark, sf_dir)
    attributes = F.col("attributes")
    by_name = attribute_values_by_name(attributes, ["DNIS", "Ani"])
    label = F.get(attribute_values(attributes, "LOG.LABEL"), F.lit(0))
    return rows.select(
        "event_id",
        F.array_join(by_name["dnis"], ",").alias("dnis"),
        F.when(F.col("k") % 5 >= 3, F.size(F.split(label, ":")) - 1).otherwise(1).alias("fields"),
        F.size(attribute_values(attributes, "LOG.LABEL")).alias("labels"),
        (label_seconds(attributes) * 1000000).cast("bigint").alias("label_micros"),
        F.size(by_name).alias("names"),
    )


@check(
    f"""WITH e AS ({EVENTS_SQL}) SELECT 4 AS version, 46 + length(event_type) + 1 AS size, k - 50 AS log_class, CAST(user_id % 30000 AS INTEGER) AS log_name,
      CAST(epoch_ms * 1000 AS VARCHAR) AS written, CAST(epoch_ms * 1000 - 7 AS VARCHAR) AS created, 4294967295 - event_id AS event_id,
      printf('%08x-0000-1000-8000-%012x', k, event_id) AS uuid, CAST(length(event_type) + 1 AS INTEGER) AS host_size, event_type AS host FROM e"""
)
def frame_headers(spark, sf_dir):
    frame = """unhex(concat('04', printf('%08x', 46 + length(event_type) + 1),
        printf('%04x', if(k < 50, 65536 + k - 50, k - 50)), printf('%04x', user_id % 30000),
        printf('%016x', epoch_ms * 1000), printf('%016x', epoch_ms * 1000 - 7), printf('%08x', 4294967295 - event_id),
        printf('%08x00001000', k), printf('8000%012x', event_id), printf('%02x', length(event_type) + 1), hex(event_type), '00'))"""
    rows = events(spark, sf_dir).select(frame_header(F.expr(frame)).alias("h")).select("h.*")
    return rows.withColumns({name: F.col(name).cast("string") for name in ("written", "created")})
