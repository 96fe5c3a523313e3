"""Readers of every raw format, over copies of the given tables in that format."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from checks.registry import check
from checks.tables import EVENTS_SQL, MONTH, events, table
from slotviews.functions.crypto import decrypt_columns, encrypt, encrypt_columns
from slotviews.operators.slots import with_slot_columns
from slotviews.plans.specs import Load, ViewSpec
from slotviews.plans.views import Workspace
from slotviews.session import scratch_path
from slotviews.sources.metrics import RUN_SCHEMA, metrics_json
from slotviews.sources.readers import (
    read_csv,
    read_encrypted_json,
    read_encrypted_xml,
    read_json,
    read_orc,
    read_parquet,
    read_sequence_json,
    read_sequence_json_fixed,
    reader_of,
)

KEY = "0123456789abcdef"
ORDERS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]
ORDERS_SQL = f"SELECT {', '.join(ORDERS)} FROM orders"
TURN_SQL = "SELECT conv_id, turn, role, text FROM conversations"


def orders(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(*ORDERS)


def exact_doubles(rows):
    # prices have two decimals; JSON inference reads whole ones as integers
    return rows.select(*ORDERS[:3], F.col("o_totalprice").cast("double").alias("o_totalprice"), ORDERS[4])


@check(ORDERS_SQL)
def json_scan(spark, sf_dir):
    path = scratch_path(spark, "json")
    orders(spark, sf_dir).write.json(path)
    return exact_doubles(read_json(spark, [path], {}))


@check(f"SELECT {', '.join(f'CAST({c} AS VARCHAR) AS {c}' for c in ORDERS if c != 'o_totalprice')} FROM orders")
def csv_scan(spark, sf_dir):
    path = scratch_path(spark, "csv")
    orders(spark, sf_dir).drop("o_totalprice").write.option("header", True).option("delimiter", "|").csv(path)
    return read_csv(spark, [path], {"delimiter": "|"})


@check(ORDERS_SQL)
def parquet_scan(spark, sf_dir):
    return read_parquet(spark, [f"{sf_dir}/orders.parquet"], {}).select(*ORDERS)


@check(ORDERS_SQL)
def orc_scan(spark, sf_dir):
    path = scratch_path(spark, "orc")
    orders(spark, sf_dir).write.orc(path)
    return read_orc(spark, [path], {})


def sequence_of(rows, path):
    pairs = rows.select(F.to_json(F.struct("*"))).rdd.map(lambda row: ("event", row[0]))
    pairs.saveAsSequenceFile(path)


@check("SELECT conv_id, turn, role, text, CAST(NULL AS VARCHAR) AS ticketId FROM conversations")
def sequence_scan(spark, sf_dir):
    path = scratch_path(spark, "sequence")
    sequence_of(table(spark, sf_dir, "conversations"), path)
    seed = json.dumps({"ticketId": "", "conv_id": 0})
    return read_sequence_json(spark, [path], {"seed": seed}).select("conv_id", "turn", "role", "text", "ticketId")


@check(TURN_SQL)
def sequence_scan_fixed(spark, sf_dir):
    path = scratch_path(spark, "sequence")
    sequence_of(table(spark, sf_dir, "conversations"), path)
    return read_sequence_json_fixed(spark, [path], {"schema": "conv_id bigint, turn bigint, role string, text string"})


@check(f"WITH e AS ({EVENTS_SQL}) SELECT event_id, user_id, event_type, k, CAST(NULL AS VARCHAR) AS queue FROM e")
def interactions_v2_scan(spark, sf_dir):
    """Interactions of the second version: nested records, some with fields that others lack."""
    path = scratch_path(spark, "interactions")
    rows = events(spark, sf_dir).select(F.struct("event_id", "user_id").alias("header"), F.struct("event_type", F.when(F.col("k") % 2 == 0, F.col("k")).alias("even"), F.when(F.col("k") % 2 == 1, F.col("k")).alias("odd")).alias("body"))
    sequence_of(rows, path)
    found = reader_of("ASSIST_INTERACTIONS_V2")(spark, [path], {"seed": json.dumps({"body": {"queue": ""}})})
    return found.select("header.event_id", "header.user_id", "body.event_type", F.coalesce("body.even", "body.odd").cast("int").alias("k"), "body.queue")


@check(f"SELECT {', '.join(ORDERS)} FROM orders")
def agent_statistics_scan(spark, sf_dir):
    """Encrypted JSON log lines in SequenceFiles."""
    path = scratch_path(spark, "statistics")
    line = F.concat(F.lit("[2024-01-01 00:00:00,000] - "), encrypt(F.to_json(F.struct(*ORDERS)), KEY))
    orders(spark, sf_dir).select(line).rdd.map(lambda row: ("line", row[0])).saveAsSequenceFile(path)
    return exact_doubles(reader_of("ASSIST_AGENTSTATS")(spark, [path], {"key": KEY}))


@check("SELECT conv_id, turn, hex(encode(text)) AS frame FROM conversations")
def frame_scan(spark, sf_dir):
    """Binary frames in SequenceFiles: a turn's number in eight bytes each, then its text."""
    path = scratch_path(spark, "frames")
    number = lambda name: F.unhex(F.lpad(F.hex(F.col(name).cast("bigint")), 16, "0"))
    rows = table(spark, sf_dir, "conversations").select(F.concat(number("conv_id"), number("turn"), F.encode("text", "utf-8")).alias("frame"))
    rows.rdd.map(lambda row: ("frame", row[0])).saveAsSequenceFile(path)
    frame = reader_of("SESSIONIZED_BINLOG")(spark, [path], {})
    part = lambda at: F.conv(F.hex(F.substring("frame", at, 8)), 16, 10).cast("bigint")
    return frame.select(part(1).alias("conv_id"), part(9).alias("turn"), F.hex(F.expr("substring(frame, 17)")).alias("frame"))


def _lines(rows, payload, path):
    line = F.concat(F.lit("[2024-01-01 00:00:00,000] - "), encrypt(payload, KEY))
    rows.select(line.alias("value")).write.text(path)


@check(TURN_SQL)
def encrypted_lines(spark, sf_dir):
    path = scratch_path(spark, "lines")
    _lines(table(spark, sf_dir, "conversations"), F.to_json(F.struct("conv_id", "turn", "role", "text")), path)
    return read_encrypted_json(spark, [path], {"container": "text", "key": KEY}).select("conv_id", "turn", "role", "text")


@check("""SELECT conv_id, turn, role, text || chr(10) || '<b class="x">&amp;</b>]]>' AS text FROM conversations""")
def xml_transcripts(spark, sf_dir):
    path = scratch_path(spark, "xml")
    rows = table(spark, sf_dir, "conversations")
    # markup, quotes and line ends of a turn are escaped, so the reader has entities to resolve
    told = F.concat("text", F.lit('\n<b class="x">&amp;</b>]]>'))
    for sign, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        told = F.replace(told, F.lit(sign), F.lit(entity))
    body = F.concat(
        *[part for name in ("conv_id", "turn", "role") for part in (F.lit(f"<{name}>"), F.col(name).cast("string"), F.lit(f"</{name}>"))],
        F.lit("<text>"),
        told,
        F.lit("</text>"),
    )
    _lines(rows, F.concat(F.lit("<transcript>"), body, F.lit("</transcript>")), path)
    schema = "conv_id bigint, turn bigint, role string, text string"
    conf = {"container": "text", "key": KEY, "schema": schema, "root": "transcript"}
    return read_encrypted_xml(spark, [path], conf).select("transcript.*")


@check("SELECT c_custkey, c_name, c_acctbal, c_mktsegment, 1 AS hidden FROM customer")
def encrypt_roundtrip(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    cipher = encrypt_columns(rows.withColumn("plain", F.col("c_name")), ["c_name", "c_acctbal"], KEY)
    plain = decrypt_columns(
        cipher.withColumn("hidden", (F.col("c_name") != F.col("plain")).cast("int")).drop("plain"),
        ["c_name", "c_acctbal"],
        KEY,
        {"c_acctbal": "double"},
    )
    return plain


@check("SELECT strftime(ts, '%m') AS month, strftime(ts, '%d') AS day, count(*) AS n, sum(user_id) AS users FROM events GROUP BY ALL")
def static_load(spark, sf_dir):
    root = scratch_path(spark, "static")
    rows = with_slot_columns(events(spark, sf_dir), "epoch_ms").drop("ts")
    rows.hint("rebalance", "year", "month", "day").write.partitionBy("year", "month", "day").parquet(f"{root}/raw/acme/events")
    spec = ViewSpec("AllEvents", "/raw/%s/events", "PARQUET", load=Load.STATIC, materialize=False)
    loaded = Workspace(spark, root).use(spec, "acme", *MONTH).df()
    two = [F.lpad(F.col(name).cast("string"), 2, "0").alias(name) for name in ("month", "day")]
    return loaded.groupBy(*two).agg(F.count("*").alias("n"), F.sum("user_id").alias("users"))


@check(f"WITH e AS ({EVENTS_SQL}) SELECT event_id, user_id, epoch_ms FROM e WHERE ts < TIMESTAMP '2024-01-22' AND ts >= TIMESTAMP '2024-01-08'")
def day_bucket_load(spark, sf_dir):
    root = scratch_path(spark, "days")
    rows = events(spark, sf_dir).select("event_id", "user_id", "epoch_ms", F.to_date("ts").alias("date"), F.lit("a").alias("part"))
    rows.hint("rebalance", "date").write.partitionBy("date", "part").parquet(f"{root}/feed/acme")
    spec = ViewSpec("Feed", "/feed/%s/", "PARQUET", day_bucket="date=<yyyy-mm-dd>/*", materialize=False)
    return Workspace(spark, root).use(spec, "acme", "202401080000", "202401220000").df()


@check("SELECT event_id, 'run' || (event_id % 10) AS id, 'View_' || event_type AS view, user_id AS nominal_time FROM events")
def run_metrics_parsed(spark, sf_dir):
    """The run record's JSON, for one run per event, read back by its schema."""
    rows = events(spark, sf_dir).select(
        "event_id",
        F.concat(F.lit("run"), F.col("event_id") % 10).alias("id"),
        F.lit("metrics").alias("eventSource"),
        F.col("epoch_ms").alias("eventTime"),
        F.struct(
            F.concat(F.lit("View_"), "event_type").alias("viewName_keyword"),
            F.lit("acme").alias("clientName_keyword"),
            F.col("user_id").alias("nominal_time"),
            F.col("epoch_ms").cast("string").alias("processingExecution_time"),
            F.array(F.lit("/raw/a"), F.lit("/raw/b")).alias("dataPaths"),
        ).alias("body"),
    )
    read = rows.select("event_id", F.from_json(metrics_json(), RUN_SCHEMA).alias("m"))
    return read.select("event_id", "m.id", F.col("m.body.viewName_keyword").alias("view"), F.col("m.body.nominal_time").alias("nominal_time"))
