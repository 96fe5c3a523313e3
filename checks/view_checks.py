"""Views over raw slots: SQL chains, imports, stored children, and shipped views."""

from __future__ import annotations

from dataclasses import replace
from datetime import timedelta

from pyspark.sql import functions as F

from checks.registry import check
from checks.tables import EVENTS_SQL, MONTH, events
from slotviews.operators.quality import Rule, RuleSet, latest_status
from slotviews.operators.slots import SLOT_COLUMNS, with_slot_columns
from slotviews.plans.runs import Reports, run_view
from slotviews.plans.specs import ColumnSpec, Import, ViewSpec
from slotviews.plans.views import Workspace
from slotviews.session import scratch_path
from slotviews.sources.metrics import RUN_SCHEMA

KEY = "0123456789abcdef"
_roots: dict[tuple[str, str], str] = {}


def workspace(spark, sf_dir) -> Workspace:
    """A workspace whose raw data are the events, laid out in slots once."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _roots:
        root = scratch_path(spark, "workspace")
        rows = with_slot_columns(events(spark, sf_dir).drop("ts"), "epoch_ms")
        # thousands of small files: their number counts, not their bytes
        rows.repartition(spark.sparkContext.defaultParallelism, *SLOT_COLUMNS).write.partitionBy(*SLOT_COLUMNS).parquet(f"{root}/raw/acme/events")
        _roots[key] = root
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return Workspace(spark, _roots[key], KEY)


RAW = ViewSpec("RawEvents", "/raw/%s/events", "PARQUET", materialize=False)


def view(name, steps, imports=(Import(RAW),), **fields) -> ViewSpec:
    fields = {"uri": "/views", "fmt": "PARQUET", "materialize": False, **fields}
    return ViewSpec(name, imports=tuple(imports), steps=tuple(steps), **fields)


def run(spark, sf_dir, spec, start=MONTH[0], end=MONTH[1]):
    return workspace(spark, sf_dir).use(spec, "acme", start, end)


@check(
    f"""WITH e AS ({EVENTS_SQL}), a AS (SELECT * FROM e WHERE event_type <> 'error'),
    b AS (SELECT user_id, event_type, count(*) AS n FROM a GROUP BY ALL)
    SELECT user_id, sum(n) AS total, max(n) AS most FROM b GROUP BY user_id"""
)
def sql_chain(spark, sf_dir):
    steps = [
        ("Good", "SELECT * FROM RawEvents WHERE event_type <> 'error'"),
        ("PerType", "SELECT user_id, event_type, count(*) AS n FROM Good GROUP BY user_id, event_type"),
        ("PerUser", "SELECT user_id, sum(n) AS total, max(n) AS most FROM PerType GROUP BY user_id"),
    ]
    return run(spark, sf_dir, view("PerUser", steps)).df()


@check(
    """SELECT event_type, count(*) FILTER (ts >= TIMESTAMP '2024-01-16') AS later,
    count(*) FILTER (ts < TIMESTAMP '2024-01-16') AS earlier FROM events GROUP BY event_type"""
)
def import_relative(spark, sf_dir):
    half = timedelta(days=15)
    imports = [Import(RAW), Import(RAW, start_offset=-half, end_offset=-timedelta(days=16), alias="Before")]
    text = """SELECT event_type, count_if(later) AS later, count_if(NOT later) AS earlier
        FROM (SELECT event_type, true AS later FROM RawEvents UNION ALL SELECT event_type, false FROM Before)
        GROUP BY event_type"""
    return run(spark, sf_dir, view("Halves", [("Halves", text)], imports), "202401160000", "202402010000").df()


@check(
    """SELECT event_type, count(*) FILTER (ts < TIMESTAMP '2024-01-10 12:15:00') AS fixed, count(*) AS everything
    FROM events GROUP BY event_type"""
)
def import_fixed(spark, sf_dir):
    imports = [Import(RAW), Import(RAW, end="202401101215", alias="Opening")]
    text = """SELECT event_type, count_if(opening) AS fixed, count_if(NOT opening) AS everything
        FROM (SELECT event_type, false AS opening FROM RawEvents UNION ALL SELECT event_type, true FROM Opening)
        GROUP BY event_type"""
    return run(spark, sf_dir, view("Opening30", [("Opening30", text)], imports)).df()


PURCHASES = view(
    "Purchases",
    [("Purchases", "SELECT event_id, user_id, value, concat('user-', user_id) AS visitor, epoch_ms FROM RawEvents WHERE event_type = 'purchase'")],
    materialize=True,
    time_column="epoch_ms",
    columns=(ColumnSpec("visitor", sensitive=True), ColumnSpec("value", sensitive=True, type="double")),
)


@check(
    """SELECT 'user-' || user_id AS visitor, count(*) AS n, max(value) AS highest, TRUE AS hidden
    FROM events WHERE event_type = 'purchase' GROUP BY user_id"""
)
def prefer_materialized(spark, sf_dir):
    """A child written with encrypted columns, then read from its slots by a parent."""
    space = workspace(spark, sf_dir)
    child = space.use(PURCHASES, "acme", *MONTH)
    child.write()
    cipher = spark.read.parquet(f"{space.location(PURCHASES)}/client=acme")
    hidden = cipher.agg(F.bool_and(F.expr("visitor NOT LIKE 'user-%' AND try_cast(value AS double) IS NULL")).alias("hidden"))
    text = "SELECT visitor, count(*) AS n, max(value) AS highest FROM Purchases GROUP BY visitor"
    parent = view("Spenders", [("Spenders", text)], [Import(PURCHASES)], prefer_materialized=True)
    return space.use(parent, "acme", *MONTH).df().crossJoin(F.broadcast(hidden))


@check("SELECT 'user-' || user_id AS visitor, count(*) AS n, max(value) AS highest FROM events WHERE event_type = 'purchase' GROUP BY user_id")
def rebuild_child(spark, sf_dir):
    """The same parent without preferring stored data: the child is rebuilt."""
    text = "SELECT visitor, count(*) AS n, max(value) AS highest FROM Purchases GROUP BY visitor"
    return run(spark, sf_dir, view("Spenders", [("Spenders", text)], [Import(PURCHASES)])).df()


COUNTS = [("Interactive", "click"), ("Signups", "signup")]
PER_TIME_SQL = """SELECT strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS CheckDay, count(DISTINCT user_id) AS chats
    FROM events WHERE event_type = '{kind}' GROUP BY 1"""


def per_time(name: str, kind: str) -> ViewSpec:
    text = f"""SELECT count(DISTINCT user_id) AS chats, CheckDay FROM (
        SELECT user_id, from_unixtime(epoch_ms div 1000, 'yyyy-MM-dd HH:mm:ss') AS CheckDay
        FROM RawEvents WHERE event_type = '{kind}') t GROUP BY CheckDay"""
    return view(name, [(name, text)])


@check(PER_TIME_SQL.format(kind="click"))
def distinct_per_time(spark, sf_dir):
    return run(spark, sf_dir, per_time("Interactive", "click")).df()


@check(" UNION ".join(PER_TIME_SQL.format(kind=kind) for _, kind in COUNTS))
def union_views(spark, sf_dir):
    text = " UNION ".join(f"SELECT CheckDay, chats FROM {name}" for name, _ in COUNTS)
    report = view("Report", [("Report", text)], [Import(per_time(name, kind)) for name, kind in COUNTS])
    return run(spark, sf_dir, report).df()


@check("SELECT user_id, sum(value) AS spent, 'gold' AS tier FROM events WHERE event_type = 'purchase' GROUP BY user_id HAVING sum(value) > 100")
def code_builder(spark, sf_dir):
    def spenders(session, spec):
        rows = session.table("RawEvents").where("event_type = 'purchase'").groupBy("user_id")
        rows = rows.agg(F.sum("value").alias("spent")).where(F.col("spent") > int(spec.params["least"]))
        return rows.withColumn("tier", F.lit(spec.params["tier"]))

    spec = view("Gold", [], builder=spenders, params={"least": "100", "tier": "gold"})
    return run(spark, sf_dir, spec).df()


CHANNELS = {
    "OnlineInteractions": "header.channel == 'ONLINE'",
    "SpeechInteractions": "header.channel == 'SPEECH'",
    "OmniInteractions": "header.channel == 'OMNICHANNEL'",
    "WebSpeechInteractions": "header.channel == 'SPEECH' OR header.channel == 'WEB'",
}


@check(
    """WITH e AS (SELECT event_id, CASE event_type WHEN 'view' THEN 'ONLINE' WHEN 'click' THEN 'SPEECH'
      WHEN 'signup' THEN 'OMNICHANNEL' ELSE 'WEB' END AS channel FROM events)
    SELECT event_id, 'OnlineInteractions' AS view_name FROM e WHERE channel = 'ONLINE'
    UNION ALL SELECT event_id, 'SpeechInteractions' FROM e WHERE channel = 'SPEECH'
    UNION ALL SELECT event_id, 'OmniInteractions' FROM e WHERE channel = 'OMNICHANNEL'
    UNION ALL SELECT event_id, 'WebSpeechInteractions' FROM e WHERE channel IN ('SPEECH', 'WEB')"""
)
def channel_views(spark, sf_dir):
    channelled = view(
        "AllInteractions",
        [
            (
                "AllInteractions",
                """SELECT named_struct('event_id', event_id, 'channel', CASE event_type WHEN 'view' THEN 'ONLINE'
                WHEN 'click' THEN 'SPEECH' WHEN 'signup' THEN 'OMNICHANNEL' ELSE 'WEB' END) AS header FROM RawEvents""",
            )
        ],
    )
    found = None
    for name, test in CHANNELS.items():
        spec = view(name, [(name, f"SELECT * FROM AllInteractions WHERE {test}")], [Import(channelled)])
        rows = run(spark, sf_dir, spec).df().select("header.event_id", F.lit(name).alias("view_name"))
        found = rows if found is None else found.unionByName(rows)
    return found


@check("SELECT event_id, user_id, 'page ' || CAST(props->>'$.k' AS INTEGER) AS title FROM events WHERE event_type = 'view'")
def page_load_view(spark, sf_dir):
    nested = view(
        "RawWeb",
        [
            (
                "RawWeb",
                """SELECT named_struct('event_id', event_id, 'user_id', user_id) AS header,
                named_struct('page', if(event_type = 'view', named_struct('title', concat('page ', k)), NULL)) AS body FROM RawEvents""",
            )
        ],
    )
    spec = view("PageLoad", [("PageLoad", "SELECT header.*, body.page.* FROM RawWeb WHERE body.page IS NOT NULL")], [Import(nested)])
    return run(spark, sf_dir, spec).df()


@check(
    f"""WITH e AS ({EVENTS_SQL}) SELECT event_id, user_id, epoch_ms, k % 3 = 0 AS resolved, CASE WHEN k % 3 = 0 THEN 'agent' ELSE '' END AS resolver,
    'view' AS source FROM e WHERE event_type = 'purchase'"""
)
def resolution_view(spark, sf_dir):
    """Resolutions: the header's fields and what the nested body says, where it says something."""
    nested = view(
        "RawInteractions",
        [
            (
                "RawInteractions",
                """SELECT named_struct('event_id', event_id, 'user_id', user_id, 'epoch_ms', epoch_ms) AS header,
                named_struct('resolution', if(event_type = 'purchase', named_struct('resolved', k % 3 = 0,
                    'by', if(k % 3 = 0, 'agent', '')), NULL)) AS body FROM RawEvents""",
            )
        ],
    )
    text = """SELECT header.*, body.resolution.resolved, getFieldValue(body.resolution, 'by') AS resolver,
        if(isFieldExists(body.resolution, 'origin'), 'record', 'view') AS source
        FROM RawInteractions WHERE isFieldExists(body, 'resolution') AND body.resolution IS NOT NULL"""
    return run(spark, sf_dir, view("Resolution", [("Resolution", text)], [Import(nested)])).df()


@check("SELECT DISTINCT user_id, event_type FROM events")
def dedup_on_load(spark, sf_dir):
    spec = ViewSpec("RawEvents", "/raw/%s/events", "PARQUET", materialize=False, dedup_keys=("user_id", "event_type"))
    return run(spark, sf_dir, spec).df().select("user_id", "event_type")


SPENT_SQL = """purchases AS (SELECT event_id, user_id, value FROM events WHERE event_type = 'purchase'),
    hits AS (SELECT event_id FROM purchases WHERE value > 80)"""


@check(
    f"""WITH {SPENT_SQL}, kept AS (SELECT event_id::VARCHAR AS record_id FROM hits ORDER BY event_id::VARCHAR LIMIT 100)
    SELECT 'failing' AS job, CASE WHEN (SELECT count(*) FROM hits) > 0 THEN 'FAIL' ELSE 'PASS' END AS status,
      (SELECT count(*) FROM hits) AS errors, (SELECT count(*) FROM kept) AS sampled, (SELECT min(record_id) FROM kept) AS least,
      (SELECT max(record_id) FROM kept) AS greatest, 'Purchases' AS view, (SELECT count(*) FROM purchases) AS stored
    UNION ALL SELECT 'passing', 'PASS', 0, 0, NULL, NULL, 'Purchases', count(*) FROM purchases
    UNION ALL SELECT 'unchecked', 'NA', NULL, 0, NULL, NULL, 'Purchases', count(*) FROM purchases"""
)
def view_run(spark, sf_dir):
    """Three runs of one view: rules that fail, rules that pass, and no checks."""
    space, place = workspace(spark, sf_dir), scratch_path(spark, "runs")
    reports, checked = Reports.below(place), replace(PURCHASES, dq_enabled=True)
    for job, spec, rule in (("failing", checked, "value > 80"), ("passing", checked, "value IS NULL"), ("unchecked", PURCHASES, None)):
        sets = rule and [RuleSet("spent", "spent", "SELECT * FROM Purchases", "event_id", (Rule("r", "spent", rule),))]
        run_view(space.use(spec, "acme", *MONTH), job, reports, sets)
    status = latest_status(spark, reports.status).select(F.col("JobId").alias("job"), F.col("DQStatus").alias("status"), F.col("ErrorCount").alias("errors"))
    sample = spark.read.parquet(reports.sample).groupBy("job").agg(F.count("*").alias("sampled"), F.min("record_id").alias("least"), F.max("record_id").alias("greatest"))
    record = F.from_json("value", RUN_SCHEMA)
    records = spark.read.parquet(reports.metrics).select(F.col("key").alias("job"), record["body"]["viewName_keyword"].alias("view"))
    stored = space.use(PURCHASES, "acme", *MONTH).stored().agg(F.count("*").alias("stored"))
    rows = status.join(sample, "job", "left").join(records, "job").crossJoin(F.broadcast(stored))
    return rows.withColumn("sampled", F.coalesce("sampled", F.lit(0)))
