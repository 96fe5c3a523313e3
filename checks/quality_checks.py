"""Violation rules, row tests, verdicts and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import check
from checks.tables import EVENTS_SQL, events, table
from slotviews.operators.quality import (
    Lookup,
    Metric,
    Rule,
    RuleSet,
    RowTest,
    Run,
    TestSet,
    check_rules,
    export_report,
    latest_status,
    metric_frame,
    run_row_tests,
    set_status,
    verdicts,
)
from slotviews.operators.dedup import latest_by
from slotviews.session import scratch_path

RUN = Run("job-1", "Orders", "acme", "199201010000", "199901010000", "2024-02-01T00:00:00.000Z")
ORDER_RULES = RuleSet(
    "ds-orders",
    "orders",
    "SELECT o.*, nullif(o_orderstatus, 'P') AS status FROM dq_orders o",
    "concat('order-', o_orderkey)",
    (
        Rule("r-price", "price is 'high'", "o_totalprice > 400000"),
        Rule("r-status", "status not open", "status <> 'O'"),
        Rule("r-priority", "urgent", "o_orderpriority LIKE '1-%'"),
        Rule("r-customer", "unknown customer", "NOT EXISTS (SELECT 1 FROM dq_customer WHERE c_custkey = o_custkey AND c_acctbal > 0)"),
    ),
)
LINE_RULES = RuleSet(
    "ds-lines",
    "lines",
    "SELECT l_orderkey, l_linenumber, l_quantity, l_discount FROM dq_lineitem",
    "concat(l_orderkey, '/', l_linenumber)",
    (Rule("r-quantity", "quantity", "l_quantity >= 49"), Rule("r-discount", "no discount", "l_discount = 0")),
)
CLEAN_RULES = RuleSet("ds-clean", "clean", "SELECT * FROM dq_orders", "o_orderkey", (Rule("r-none", "negative", "o_totalprice < 0"),))

HITS_SQL = """
    SELECT 'ds-orders' AS dq_data_set_id, 'r-price' AS rule_id, 'price is ''high''' AS rule_name, 'order-' || o_orderkey AS record_id
      FROM orders WHERE o_totalprice > 400000
    UNION ALL SELECT 'ds-orders', 'r-status', 'status not open', 'order-' || o_orderkey FROM orders WHERE nullif(o_orderstatus, 'P') <> 'O'
    UNION ALL SELECT 'ds-orders', 'r-priority', 'urgent', 'order-' || o_orderkey FROM orders WHERE o_orderpriority LIKE '1-%'
    UNION ALL SELECT 'ds-orders', 'r-customer', 'unknown customer', 'order-' || o_orderkey FROM orders
      WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)
    UNION ALL SELECT 'ds-lines', 'r-quantity', 'quantity', l_orderkey || '/' || l_linenumber FROM lineitem WHERE l_quantity >= 49
    UNION ALL SELECT 'ds-lines', 'r-discount', 'no discount', l_orderkey || '/' || l_linenumber FROM lineitem WHERE l_discount = 0
"""
VIOLATIONS_SQL = f"""SELECT 'job-1' AS jobId, 'Orders' AS view_id, 'acme' AS client, dq_data_set_id, rule_id, rule_name, record_id,
    '1992-01-01T00:00:00.000Z' AS data_segment_time_start, '1999-01-01T00:00:00.000Z' AS data_segment_time_end,
    '2024-02-01T00:00:00.000Z' AS evaluation_time FROM ({HITS_SQL})"""
SUMMARY_SQL = """SELECT 'job-1' AS "JobId", 'Orders' AS "View", 'acme' AS "Client", '1992-01-01T00:00:00.000Z' AS "DataSegmentStart",
    '1999-01-01T00:00:00.000Z' AS "DataSegmentEnd", {count} AS "ErrorCount", '{status}' AS "DQStatus",
    '2024-02-01T00:00:00.000Z' AS "DQEvaluationTime" """


def scoped(spark, sf_dir):
    for name in ("orders", "customer", "lineitem"):
        table(spark, sf_dir, name).createOrReplaceTempView(f"dq_{name}")


def result(spark, sf_dir, *rule_sets):
    scoped(spark, sf_dir)
    return check_rules(spark, rule_sets, RUN)


@check(VIOLATIONS_SQL)
def dq_violations(spark, sf_dir):
    return result(spark, sf_dir, ORDER_RULES, LINE_RULES, CLEAN_RULES).frame


LOOKUP_RULES = RuleSet(
    "ds-links",
    "links",
    "SELECT * FROM dq_orders",
    "o_orderkey",
    (
        Rule("r-customer", "no customer with money", "NOT has_money"),
        Rule("r-lines", "open without returned lines", "o_orderstatus = 'O' AND NOT returned"),
        Rule("r-priority", "neither priority nor customer of the list", "NOT listed AND NOT has_money"),
    ),
    lookups=(
        Lookup("has_money", "SELECT c_custkey FROM dq_customer WHERE c_acctbal > 0", {"c_custkey": "o_custkey"}),
        Lookup("returned", "SELECT l_orderkey FROM dq_lineitem WHERE l_returnflag = 'R'", {"l_orderkey": "o_orderkey"}, nulls=False),
        Lookup("listed", "SELECT nullif(c_mktsegment, 'BUILDING') AS segment FROM dq_customer", {"segment": "o_orderpriority"}),
    ),
)


@check(
    """SELECT 'r-customer' AS rule_id, o_orderkey::VARCHAR AS record_id FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)
    UNION ALL SELECT 'r-lines', o_orderkey::VARCHAR FROM orders WHERE o_orderstatus = 'O' AND NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R')
    UNION ALL SELECT 'r-priority', o_orderkey::VARCHAR FROM orders WHERE o_orderpriority NOT IN (SELECT nullif(c_mktsegment, 'BUILDING') FROM customer)
      AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)"""
)
def dq_lookup_rules(spark, sf_dir):
    return result(spark, sf_dir, LOOKUP_RULES).frame.select("rule_id", "record_id")


@check(f"SELECT dq_data_set_id, rule_id, count(*) AS errors FROM ({HITS_SQL}) GROUP BY ALL")
def dq_by_rule(spark, sf_dir):
    rows = result(spark, sf_dir, ORDER_RULES, LINE_RULES).frame
    return rows.groupBy("dq_data_set_id", "rule_id").agg(F.count("*").alias("errors"))


@check(
    f"""SELECT rule_id, record_id FROM ({HITS_SQL})
    QUALIFY row_number() OVER (PARTITION BY rule_id ORDER BY record_id, dq_data_set_id) <= 100"""
)
def dq_capped(spark, sf_dir):
    return result(spark, sf_dir, ORDER_RULES, LINE_RULES).capped(100).select("rule_id", "record_id")


@check(
    SUMMARY_SQL.format(count="count(*)", status="FAIL")
    + f" FROM ({HITS_SQL}) UNION ALL "
    + SUMMARY_SQL.format(count="count(*)", status="PASS")
    + " FROM orders WHERE o_totalprice < 0"
)
def dq_summary(spark, sf_dir):
    failed = result(spark, sf_dir, ORDER_RULES, LINE_RULES).summary()
    return failed.unionByName(result(spark, sf_dir, CLEAN_RULES).summary())


@check(f"""{SUMMARY_SQL.format(count="count(*)", status="FAIL")}, (SELECT count(DISTINCT rule_id) FROM ({HITS_SQL})) AS rules FROM ({HITS_SQL})""")
def dq_report(spark, sf_dir):
    """The stored report: status before and after, detail by rule, summary by job."""
    place = scratch_path(spark, "report")
    checked = result(spark, sf_dir, ORDER_RULES, LINE_RULES)
    set_status(spark, f"{place}/summary", "job-1", "In progress")
    summary = export_report(checked, f"{place}/detail", f"{place}/index", f"{place}/summary")
    detail = spark.read.json(f"{place}/detail/client=acme/job-1")
    rules = detail.agg(F.countDistinct("rule_id").alias("rules"))
    return summary.drop("updated_at").crossJoin(F.broadcast(rules))


TESTS = TestSet(
    "PerUser",
    "SELECT user_id, event_type, count(*) AS cnt FROM dq_events GROUP BY user_id, event_type",
    (
        RowTest("OnlyViews", "users do nothing but view", "event_type = 'view'", "concat('also does ', event_type)"),
        RowTest("Busy", "more than a dozen events", "cnt > 12", "concat(cnt, ' events')"),
    ),
)
KNOWN = TestSet(
    "Known", "SELECT event_id, event_type FROM dq_events", (RowTest("KnownType", "type is known", "event_type IS NOT NULL", "event_type"),)
)


def tested(spark, sf_dir):
    events(spark, sf_dir).createOrReplaceTempView("dq_events")
    return run_row_tests(spark, [TESTS, KNOWN], "Events", "acme", "202401010000", "202402010000")


@check(
    """WITH u AS (SELECT user_id, event_type, count(*) AS cnt FROM events GROUP BY ALL)
    SELECT 'Events' AS "table", 'acme' AS client, 'PerUser' AS "testDataSet", '2024-01-01' AS start_date,
      user_id || '|' || event_type || '|' || cnt AS row_data, event_type = 'view' AS first_pass,
      'also does ' || event_type AS first_message, cnt > 12 AS second_pass, event_type = 'view' AND cnt > 12 AS pass FROM u
    UNION ALL SELECT 'Events', 'acme', 'Known', '2024-01-01', event_id || '|' || event_type, TRUE, event_type, NULL, TRUE FROM events"""
)
def dq_row_tests(spark, sf_dir):
    return tested(spark, sf_dir).select(
        "table",
        "client",
        "testDataSet",
        F.col("startTime").cast("string").alias("start_date"),
        F.col("rowData").alias("row_data"),
        F.col("result.tests")[0]["pass"].alias("first_pass"),
        F.col("result.tests")[0]["description"].alias("first_message"),
        F.get(F.col("result.tests"), F.lit(1))["pass"].alias("second_pass"),
        F.col("dqPass").alias("pass"),
    )


@check(
    """SELECT 'acme' AS client, 'PerUser' AS "testDataSet", bool_and(event_type = 'view' AND cnt > 12) AS "dqResult", '00' AS hr
    FROM (SELECT user_id, event_type, count(*) AS cnt FROM events GROUP BY ALL)
    UNION ALL SELECT 'acme', 'Known', bool_and(event_type IS NOT NULL), '00' FROM events"""
)
def dq_verdicts(spark, sf_dir):
    return verdicts(tested(spark, sf_dir), hr="00")


@check("SELECT event_type, count(*) AS cnt FROM events GROUP BY event_type")
def dq_metric_frame(spark, sf_dir):
    events(spark, sf_dir).createOrReplaceTempView("dq_events")
    metric = Metric("per_type", "SELECT event_type, count(*) AS cnt, max(ts) AS last FROM dq_events GROUP BY event_type", ("event_type",), ("cnt",))
    return metric_frame(spark, metric)


@check(
    f"""WITH e AS ({EVENTS_SQL}) SELECT 'job-' || user_id AS job_id, event_type AS status FROM e
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY epoch_ms DESC, event_id DESC) = 1"""
)
def dq_latest_status(spark, sf_dir):
    rows = events(spark, sf_dir).select(
        F.concat(F.lit("job-"), "user_id").alias("job_id"), F.col("event_type").alias("status"), "epoch_ms", "event_id"
    )
    return latest_by(rows, ["job_id"], ["epoch_ms", "event_id"]).select("job_id", "status")


@check("SELECT event_id, event_type, TRUE AS passed, event_type AS message FROM events")
def dq_result_view(spark, sf_dir):
    """The rows of a test set stay in scope as a view, with their outcome."""
    tested(spark, sf_dir)
    return spark.sql("SELECT event_id, event_type, dqPass AS passed, result.tests[0].description AS message FROM DQResult_Events_Known")


@check("SELECT user_id || '|' || count(*) AS row_data, count(*) <= 20 AS passed FROM events WHERE event_type <> 'error' GROUP BY user_id")
def dq_imports_in_scope(spark, sf_dir):
    """A test set over a view that is no view's step: its imports are resolved into scope first."""
    from checks.tables import MONTH
    from checks.view_checks import RAW, view, workspace
    from slotviews.plans.specs import Import

    good = view("GoodEvents", [("GoodEvents", "SELECT * FROM RawEvents WHERE event_type <> 'error'")])
    workspace(spark, sf_dir).bring([Import(good), Import(RAW)], "acme", *MONTH)
    rules = TestSet("PerUser", "SELECT user_id, count(*) AS cnt FROM GoodEvents GROUP BY user_id", (RowTest("Few", "few events", "cnt <= 20", "cnt"),))
    rows = run_row_tests(spark, [rules], "Good", "acme", *MONTH)
    return rows.select(F.col("rowData").alias("row_data"), F.col("dqPass").alias("passed"))
