"""Operators on the column set, deduplication and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import check
from checks.tables import events, table
from slotviews.functions.scalars import hide_listed, log_payload, register_functions, view_sql
from slotviews.operators.columns import (
    all_nullable,
    decode_names,
    encode_names,
    ensure_client,
    expand_structs,
    field_exists,
    field_value,
    fill_blank,
    flatten,
    row_text,
    with_literals,
)
from slotviews.operators.dedup import dedup_by_keys, latest_by
from slotviews.session import scratch_path


def nested_orders(spark, sf_dir):
    rows = table(spark, sf_dir, "orders")
    return rows.select(
        F.struct("o_orderkey", "o_custkey", F.struct("o_orderstatus", "o_orderpriority").alias("state")).alias("header"),
        F.struct("o_totalprice").alias("body"),
    )


@check(
    """SELECT o_orderkey AS header_o_orderkey, o_custkey AS header_o_custkey, o_orderstatus AS header_state_o_orderstatus,
    o_orderpriority AS header_state_o_orderpriority, o_totalprice AS body_o_totalprice FROM orders"""
)
def struct_flatten(spark, sf_dir):
    return flatten(nested_orders(spark, sf_dir))


@check("SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority, o_totalprice FROM orders")
def struct_star(spark, sf_dir):
    wide = expand_structs(nested_orders(spark, sf_dir), "header", "body")
    return wide.select("o_orderkey", "o_custkey", "state.*", "o_totalprice")


@check('SELECT p_partkey AS "part id", p_name AS "name (short)", p_retailprice AS "price/unit €" FROM part')
def name_codec(spark, sf_dir):
    rows = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("part id"), F.col("p_name").alias("name (short)"), F.col("p_retailprice").alias("price/unit €")
    )
    path = scratch_path(spark, "names")
    encode_names(rows).write.parquet(path)
    return decode_names(spark.read.parquet(path))


@check(
    """SELECT c_custkey, c_name, COALESCE(s_name, '') AS s_name, s_acctbal, 'acme' AS client
    FROM customer LEFT JOIN supplier ON c_custkey = s_suppkey"""
)
def fill_blank_and_client(spark, sf_dir):
    customers, suppliers = table(spark, sf_dir, "customer"), table(spark, sf_dir, "supplier")
    rows = customers.join(suppliers, customers.c_custkey == suppliers.s_suppkey, "left")
    rows = ensure_client(ensure_client(fill_blank(rows), "acme"), "other")
    return rows.select("c_custkey", "c_name", "s_name", "s_acctbal", "client")


@check("SELECT c_custkey || '|' || c_name || '|' || COALESCE(s_name, 'null') || '|' || c_nationkey AS row_data, 'customer' AS source, 7 AS version FROM customer LEFT JOIN supplier ON c_custkey = s_suppkey")
def row_as_text(spark, sf_dir):
    customers, suppliers = table(spark, sf_dir, "customer"), table(spark, sf_dir, "supplier")
    rows = customers.join(suppliers, customers.c_custkey == suppliers.s_suppkey, "left")
    rows = with_literals(rows.select("c_custkey", "c_name", "s_name", "c_nationkey"), source="customer", version=7)
    return rows.select(row_text(rows.columns[:4]).alias("row_data"), "source", "version")


@check("SELECT o_orderkey, TRUE AS has_status, FALSE AS has_other, o_orderstatus AS status, '' AS other FROM orders")
def field_functions(spark, sf_dir):
    rows = nested_orders(spark, sf_dir).withColumn("state", F.col("header.state"))
    return rows.select(
        "header.o_orderkey",
        field_exists(rows, "state", "o_orderstatus").alias("has_status"),
        field_exists(rows, "state", "o_clerk").alias("has_other"),
        field_value(rows, "state", "o_orderstatus").alias("status"),
        field_value(rows, "state", "o_clerk").alias("other"),
    )


@check("SELECT o_orderkey, TRUE AS has_status, FALSE AS has_other, o_orderstatus AS status, '' AS other, o_orderpriority AS priority FROM orders")
def sql_functions(spark, sf_dir):
    register_functions(spark, "0123456789abcdef")
    nested_orders(spark, sf_dir).createOrReplaceTempView("nested_orders")
    return view_sql(
        spark,
        """SELECT header.o_orderkey, isFieldExists(header.state, 'o_orderstatus') AS has_status,
        isFieldExists(header.state, 'o_clerk') AS has_other, getFieldValue(header.state, 'o_orderstatus') AS status,
        getFieldValue(header.state, 'o_clerk') AS other, decrypt(encrypt(header.state.o_orderpriority)) AS priority
        FROM nested_orders""",
    )


@check("SELECT l_orderkey, l_linenumber, 1 AS copies FROM lineitem GROUP BY l_orderkey, l_linenumber")
def dedup_keys(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem")
    kept = dedup_by_keys(rows.unionByName(rows), ["l_orderkey", "l_linenumber"])
    return kept.groupBy("l_orderkey", "l_linenumber").agg(F.count("*").cast("int").alias("copies"))


@check("SELECT o_custkey, o_orderstatus, 1 AS copies FROM orders GROUP BY o_custkey, o_orderstatus")
def dedup_nested_keys(spark, sf_dir):
    kept = dedup_by_keys(nested_orders(spark, sf_dir), ["header.o_custkey", "header.state.o_orderstatus"])
    kept = kept.select("header.o_custkey", "header.state.o_orderstatus", "body.o_totalprice")
    return kept.groupBy("o_custkey", "o_orderstatus").agg(F.count("*").cast("int").alias("copies"))


@check(
    """SELECT o_custkey, o_orderkey, o_orderstatus FROM orders
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1"""
)
def latest_per_key(spark, sf_dir):
    rows = latest_by(table(spark, sf_dir, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"])
    return rows.select("o_custkey", "o_orderkey", "o_orderstatus")


@check("SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber IN (1, 2, 3) THEN -1 ELSE l_linenumber END AS shown FROM lineitem")
def hidden_values(spark, sf_dir):
    rows = all_nullable(table(spark, sf_dir, "lineitem"))
    return rows.select("l_orderkey", "l_linenumber", hide_listed(F.col("l_linenumber"), [1, 2, 3]).alias("shown"))


@check("SELECT event_id, event_type AS payload FROM events")
def log_payloads(spark, sf_dir):
    line = F.concat(F.lit("[2024-01-01 00:00:00,000] -  "), "event_type", F.lit(" \r"))
    return events(spark, sf_dir).select("event_id", log_payload(line).alias("payload"))


@check("SELECT o_orderkey FROM orders WHERE (o_orderstatus = 'O' OR o_orderstatus = 'F') AND o_orderpriority LIKE '%-%' AND lower(o_orderpriority) LIKE '%high%' AND regexp_matches(o_orderpriority, '^[0-9]-') AND o_totalprice BETWEEN 1000 AND 400000")
def predicates(spark, sf_dir):
    nested_orders(spark, sf_dir).createOrReplaceTempView("nested_orders")
    return spark.sql(
        """SELECT header.o_orderkey FROM nested_orders
        WHERE (header.state.o_orderstatus == 'O' OR header.state.o_orderstatus == 'F')
        AND header.state.o_orderpriority LIKE '%-%' AND LOWER(header.state.o_orderpriority) LIKE '%high%'
        AND header.state.o_orderpriority REGEXP '^[0-9]-' AND body.o_totalprice BETWEEN 1000 AND 400000"""
    )


@check("SELECT event_id, TRUE AS past, TRUE AS one_moment FROM events")
def current_moment(spark, sf_dir):
    events(spark, sf_dir).createOrReplaceTempView("moment_events")
    return spark.sql("SELECT event_id, ts < now() AS past, now() = current_timestamp() AS one_moment FROM moment_events")
