"""Slots, slot tables and window replacement."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import check
from checks.tables import EVENTS_SQL, MONTH, events, table
from slotviews.operators.slots import Granularity, in_window, slot_frame, with_slot_columns
from slotviews.session import scratch_path
from slotviews.sources.slot_table import read_slots, read_window, slots_to_write, stored_slots, write_slots

SLOT_SQL = """CAST(year(ts) AS INTEGER) AS year, strftime(ts, '%m') AS month, strftime(ts, '%d') AS day,
    strftime(ts, '%H') AS hour, lpad(CAST(minute(ts) // 15 * 15 AS VARCHAR), 2, '0') AS min"""
DATA = ["event_id", "user_id", "event_type", "value", "props", "epoch_ms"]
DATA_SCHEMA = "event_id bigint, user_id bigint, event_type string, value double, props string, epoch_ms bigint"
HALF = ("202401080000", "202401220000")


def slotted(spark, sf_dir):
    return with_slot_columns(events(spark, sf_dir), "epoch_ms")


@check(f"SELECT event_id, {SLOT_SQL} FROM events")
def slot_columns(spark, sf_dir):
    return slotted(spark, sf_dir).select("event_id", "year", "month", "day", "hour", "min")


@check(f"SELECT year, month, day, hour, min, count(*) AS n FROM (SELECT {SLOT_SQL} FROM events) GROUP BY ALL")
def slot_counts(spark, sf_dir):
    return slotted(spark, sf_dir).groupBy("year", "month", "day", "hour", "min").agg(F.count("*").alias("n"))


@check(f"SELECT DISTINCT {SLOT_SQL} FROM events")
def slots_touched(spark, sf_dir):
    return slots_to_write(events(spark, sf_dir), "epoch_ms")


def _sequence_sql(step: int, slots: int) -> str:
    return f"""WITH e AS ({EVENTS_SQL}), c AS (SELECT epoch_ms // {step} * {step} AS slot_ms, count(*) AS n FROM e GROUP BY 1)
    SELECT s.slot_ms, strftime(make_timestamp(s.slot_ms * 1000), '%d%H%M') AS label, COALESCE(c.n, 0) AS n
    FROM (SELECT 1704067200000 + i * {step} AS slot_ms FROM range({slots}) t(i)) s LEFT JOIN c USING (slot_ms)"""


def _sequence(spark, sf_dir, granularity):
    step = int(granularity.value.total_seconds() * 1000)
    counts = events(spark, sf_dir).groupBy((F.col("epoch_ms") - F.pmod("epoch_ms", F.lit(step))).alias("slot_ms"))
    rows = slot_frame(spark, *MONTH, granularity).join(counts.agg(F.count("*").alias("n")), "slot_ms", "left")
    return rows.select("slot_ms", F.concat("day", "hour", "min").alias("label"), F.coalesce("n", F.lit(0)).alias("n"))


@check(_sequence_sql(900000, 31 * 96))
def slot_sequence(spark, sf_dir):
    return _sequence(spark, sf_dir, Granularity.FIFTEEN_MIN)


@check(_sequence_sql(3600000, 31 * 24))
def slot_sequence_hourly(spark, sf_dir):
    return _sequence(spark, sf_dir, Granularity.HOUR)


@check("SELECT event_id FROM events WHERE ts >= TIMESTAMP '2024-01-08 06:30:00' AND ts < TIMESTAMP '2024-01-22 17:45:00'")
def slot_range_filter(spark, sf_dir):
    return slotted(spark, sf_dir).where(in_window("202401080630", "202401221745")).select("event_id")


def written(spark, sf_dir, label, fmt="parquet"):
    location = scratch_path(spark, label)
    write_slots(events(spark, sf_dir).select(*DATA), location, "epoch_ms", "acme", fmt, *MONTH)
    return location


ROUNDTRIP_SQL = f"""WITH e AS ({EVENTS_SQL})
    SELECT event_id, user_id, event_type, value, props, epoch_ms, 'acme' AS client, {SLOT_SQL} FROM e"""


def _roundtrip(spark, sf_dir, fmt):
    location = written(spark, sf_dir, f"roundtrip-{fmt}", fmt)
    return read_slots(spark, location, "acme", fmt, *MONTH, schema=DATA_SCHEMA, partition_columns=True)


@check(ROUNDTRIP_SQL)
def slot_roundtrip_parquet(spark, sf_dir):
    return _roundtrip(spark, sf_dir, "parquet")


@check(ROUNDTRIP_SQL)
def slot_roundtrip_orc(spark, sf_dir):
    return _roundtrip(spark, sf_dir, "orc")


@check(ROUNDTRIP_SQL)
def slot_roundtrip_json(spark, sf_dir):
    return _roundtrip(spark, sf_dir, "json")


@check("SELECT doc_id, 1704067200000 + doc_id % 96 * 900000 AS at, text, lang, n_chars FROM documents")
def slot_roundtrip_csv(spark, sf_dir):
    """Whole texts, with line ends and quotes, over one day of slots."""
    docs = table(spark, sf_dir, "documents")
    rows = docs.select("doc_id", (F.lit(1704067200000) + F.col("doc_id") % 96 * 900000).alias("at"), "text", "lang", "n_chars")
    location, day = scratch_path(spark, "roundtrip-csv"), ("202401010000", "202401020000")
    write_slots(rows, location, "at", "acme", "csv", *day)
    return read_slots(spark, location, "acme", "csv", *day, schema=rows.schema)


@check(
    f"""WITH e AS ({EVENTS_SQL}) SELECT event_id, month, day, hour, min FROM (SELECT *, {SLOT_SQL} FROM e)
    WHERE ts >= TIMESTAMP '2024-01-08' AND ts < TIMESTAMP '2024-01-22'"""
)
def slot_window_pruned(spark, sf_dir):
    rows = read_window(spark, written(spark, sf_dir, "pruned"), "parquet", "acme", *HALF, schema=DATA_SCHEMA)
    return rows.select("event_id", "month", "day", "hour", "min")


@check(
    f"""WITH e AS ({EVENTS_SQL}) SELECT event_id, user_id, event_type, value, props, epoch_ms FROM e
    WHERE NOT (ts >= TIMESTAMP '2024-01-08' AND ts < TIMESTAMP '2024-01-22') OR event_type = 'purchase'"""
)
def window_replace(spark, sf_dir):
    location = written(spark, sf_dir, "replace")
    fewer = events(spark, sf_dir).where("event_type = 'purchase'").select(*DATA)
    write_slots(fewer, location, "epoch_ms", "acme", "parquet", *HALF, outside="drop")
    return read_slots(spark, location, "acme", "parquet", *MONTH, schema=DATA_SCHEMA)


@check(
    f"""WITH e AS ({EVENTS_SQL}), rows AS (SELECT event_id, user_id, event_type, value, props, epoch_ms, ts FROM e)
    SELECT * EXCLUDE ts FROM rows
    UNION ALL SELECT * EXCLUDE ts FROM rows WHERE NOT (ts >= TIMESTAMP '2024-01-08' AND ts < TIMESTAMP '2024-01-22')"""
)
def window_append_outside(spark, sf_dir):
    location = written(spark, sf_dir, "append")
    again = events(spark, sf_dir).select(*DATA)
    write_slots(again, location, "epoch_ms", "acme", "parquet", *HALF, outside="append")
    return read_slots(spark, location, "acme", "parquet", *MONTH, schema=DATA_SCHEMA)


@check(f"SELECT DISTINCT strftime(ts, '%Y%m%d%H') || lpad(CAST(minute(ts) // 15 * 15 AS VARCHAR), 2, '0') AS slot FROM events")
def slots_existing(spark, sf_dir):
    found = stored_slots(spark, written(spark, sf_dir, "existing"), "parquet", "acme", *MONTH)
    return found.select(F.concat(F.col("year").cast("string"), "month", "day", "hour", "min").alias("slot"))
