"""Next events, interval joins, alternative-key joins and the chat funnel."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import check
from checks.tables import EVENTS_SQL, chat_interactions, events, web_events
from slotviews.functions.flags import (
    cancel_latency_flags,
    termination_flags,
)
from slotviews.functions.scalars import base_session, operating_system
from slotviews.operators.intervals import join_contained, join_containing, next_event
from slotviews.operators.joins import left_join_any, left_join_on
from slotviews.plans.funnel import journey_funnel
from slotviews.session import scratch_path

NEXT_SQL = """
    SELECT a.user_id, a.epoch_ms, a.event_id, COALESCE(MIN(b.epoch_ms), a.epoch_ms + 300000) AS next_ms
    FROM {rows} a LEFT JOIN {rows} b ON a.user_id = b.user_id AND a.epoch_ms < b.epoch_ms
    GROUP BY a.user_id, a.epoch_ms, a.event_id
"""


def typed(spark, sf_dir, event_type):
    return events(spark, sf_dir).where(F.col("event_type") == event_type).select("user_id", "epoch_ms", "event_id")


@check(
    f"""WITH e AS ({EVENTS_SQL}), c AS (SELECT user_id, epoch_ms, event_id FROM e)
    {NEXT_SQL.format(rows="c")}"""
)
def next_event_per_user(spark, sf_dir):
    rows = events(spark, sf_dir).select("user_id", "epoch_ms", "event_id").distinct()
    return next_event(rows, ["user_id"], "epoch_ms", "next_ms")


@check(
    f"""WITH e AS ({EVENTS_SQL}),
    views AS (SELECT user_id, epoch_ms, event_id FROM e WHERE event_type = 'view'),
    pages AS ({NEXT_SQL.format(rows="views")})
    SELECT c.event_id, c.user_id, c.epoch_ms, p.event_id AS page_id, p.epoch_ms AS page_ms, p.next_ms
    FROM e c LEFT JOIN pages p ON c.user_id = p.user_id AND c.epoch_ms BETWEEN p.epoch_ms AND p.next_ms"""
)
def interval_join(spark, sf_dir):
    pages = next_event(typed(spark, sf_dir, "view"), ["user_id"], "epoch_ms", "next_ms")
    pages = pages.withColumnsRenamed({"event_id": "page_id", "epoch_ms": "page_ms"})
    points = events(spark, sf_dir).select("event_id", "user_id", "epoch_ms")
    return join_containing(points, pages, ["user_id"], "epoch_ms", "page_ms", "next_ms")


@check(
    f"""WITH e AS ({EVENTS_SQL}),
    clicks AS (SELECT user_id, epoch_ms, event_id FROM e WHERE event_type = 'click'),
    leads AS (SELECT *, 's' || user_id AS session FROM ({NEXT_SQL.format(rows="clicks")})),
    offers AS (SELECT event_id AS offer_id, epoch_ms AS offer_ms, 's' || user_id || '@@' || (k % 2) AS raw_session
               FROM e WHERE event_type <> 'click')
    SELECT b.session, b.epoch_ms, b.event_id, b.next_ms, c.offer_id, c.offer_ms, c.raw_session
    FROM leads b LEFT JOIN offers c
      ON b.session = split_part(c.raw_session, '@@', 1) AND c.offer_ms BETWEEN b.epoch_ms AND b.next_ms"""
)
def range_join_normalized(spark, sf_dir):
    leads = next_event(typed(spark, sf_dir, "click"), ["user_id"], "epoch_ms", "next_ms")
    leads = leads.select(F.concat(F.lit("s"), "user_id").alias("session"), "epoch_ms", "event_id", "next_ms")
    offers = (
        events(spark, sf_dir)
        .where("event_type <> 'click'")
        .select(
            F.col("event_id").alias("offer_id"),
            F.col("epoch_ms").alias("offer_ms"),
            F.concat(F.lit("s"), "user_id", F.lit("@@"), F.col("k") % 2).alias("raw_session"),
        )
        .withColumn("session", base_session(F.col("raw_session")))
    )
    return join_contained(leads, offers, ["session"], "epoch_ms", "next_ms", "offer_ms")


@check(
    f"""WITH e AS ({EVENTS_SQL}),
    stays AS (SELECT user_id, event_id AS stay_id, epoch_ms AS from_ms, epoch_ms + (k % 23) * (k % 29) * 3600000 AS to_ms FROM e WHERE event_type = 'view')
    SELECT c.event_id, c.user_id, c.epoch_ms, s.stay_id, s.from_ms, s.to_ms
    FROM e c LEFT JOIN stays s ON c.user_id = s.user_id AND c.epoch_ms BETWEEN s.from_ms AND s.to_ms WHERE c.event_type <> 'view'"""
)
def range_join_overlapping(spark, sf_dir):
    rows = events(spark, sf_dir)
    length = (F.col("k") % 23) * (F.col("k") % 29) * 3600000
    stays = rows.where("event_type = 'view'").select("user_id", F.col("event_id").alias("stay_id"), F.col("epoch_ms").alias("from_ms"), (F.col("epoch_ms") + length).alias("to_ms"))
    points = rows.where("event_type <> 'view'").select("event_id", "user_id", "epoch_ms")
    return join_containing(points, stays, ["user_id"], "epoch_ms", "from_ms", "to_ms")


@check(
    """SELECT o.o_orderkey, o.o_custkey, c.c_name, s.s_name
    FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey AND c.c_acctbal > 0
    LEFT JOIN supplier s ON COALESCE(c.c_nationkey, o.o_custkey) = s.s_suppkey"""
)
def coalesced_key_join(spark, sf_dir):
    from checks.tables import table

    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    customers = table(spark, sf_dir, "customer").where("c_acctbal > 0").select("c_custkey", "c_nationkey", "c_name")
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    rows = left_join_on(orders, customers, {"c_custkey": "o_custkey"})
    rows = left_join_on(rows, suppliers, {"s_suppkey": F.coalesce("c_nationkey", "o_custkey")})
    return rows.select("o_orderkey", "o_custkey", "c_name", "s_name")


@check(
    """SELECT c.c_custkey, c.c_nationkey, s.s_suppkey, s.s_name
    FROM customer c LEFT JOIN supplier s ON c.c_custkey = s.s_suppkey
      OR (c.c_nationkey = s.s_nationkey AND CAST(floor(c.c_acctbal / 100) AS BIGINT) = CAST(floor(s.s_acctbal / 100) AS BIGINT))"""
)
def or_join(spark, sf_dir):
    from checks.tables import table

    customers = table(spark, sf_dir, "customer").withColumn("c_band", F.floor(F.col("c_acctbal") / 100))
    suppliers = table(spark, sf_dir, "supplier").withColumn("s_band", F.floor(F.col("s_acctbal") / 100))
    rows = left_join_any(
        customers,
        suppliers,
        [{"s_suppkey": "c_custkey"}, {"s_nationkey": "c_nationkey", "s_band": "c_band"}],
    )
    return rows.select("c_custkey", "c_nationkey", "s_suppkey", "s_name")


@check(
    f"""WITH e AS ({EVENTS_SQL})
    SELECT user_id, event_type, min(epoch_ms) AS first_ms, max(epoch_ms) AS last_ms FROM e GROUP BY user_id, event_type"""
)
def first_last_by_key(spark, sf_dir):
    rows = events(spark, sf_dir).groupBy("user_id", "event_type")
    return rows.agg(F.min("epoch_ms").alias("first_ms"), F.max("epoch_ms").alias("last_ms"))


CODES_SQL = """CASE k % 9 WHEN 0 THEN 'VISITOR_LEAVE' WHEN 1 THEN 'VISITOR_UNAVAILABLE' WHEN 2 THEN 'OWNER_LEFT'
    WHEN 3 THEN 'SYSTEM_FAILURE' WHEN 4 THEN 'QUEUE_TIMEOUT' WHEN 5 THEN 'QUEUE_FULL'
    WHEN 6 THEN 'VISITOR_NON_RESPONSIVE_AUTO_TERMINATED' WHEN 7 THEN 'OTHER' END"""


# Fixed values, written out here once more so that an error in the library's own lists shows.
CODES = {
    "UserEnded": "'VISITOR_LEAVE'",
    "UserUnavailable": "'VISITOR_UNAVAILABLE'",
    "UserUnreachableAgentEnded": "'VISITOR_NON_RESPONSIVE_AUTO_TERMINATED'",
    "AgentLost": "'OWNER_UNREACHABLE', 'OWNER_ABRUPT_LOGOUT', 'OWNER_TIMEDOUT', 'OWNER_LEFT'",
    "PlatformFailure": """'ALLOCATION_TIMEOUT', 'ALLOCATION_FAILURE', 'VISITOR_INVITE_REJECTED', 'VISITOR_INVITE_FAILURE',
        'VISITOR_COLLAB_FAILURE', 'OWNER_INVITE_FAILURE', 'OWNER_COLLAB_FAILURE', 'ADDRESS_BOOK_FAILURE',
        'COLLABORATION_SERVER_FAILURE', 'INTERACTION_STATE_ERROR', 'INTERACTION_LIFECYCLE_ERROR', 'CACHE_FAILURE',
        'SYSTEM_FAILURE', 'UNCLASSIFIED_FAILURE', 'MONITORING_RECONCILE'""",
    "QueueTimeOut": "'QUEUE_TIMEOUT'",
    "QueueFull": "'QUEUE_FULL'",
}
STAGES = {
    "preQueued": "UserEnded UserUnavailable QueueFull PlatformFailure",
    "preConnected": "UserEnded UserUnavailable UserUnreachableAgentEnded AgentLost PlatformFailure QueueTimeOut",
    "preInteractive": "UserEnded UserUnavailable AgentLost PlatformFailure",
    "postInteractive": "UserEnded UserUnavailable UserUnreachableAgentEnded AgentLost PlatformFailure QueueTimeOut QueueFull",
}
LATENCIES = {
    "accpetToCancel1to5SecFlag": "<= 5000",
    "accpetToCancel6to10SecFlag": "BETWEEN 5001 AND 10000",
    "accpetToCancel11to15SecFlag": "BETWEEN 10001 AND 15000",
    "accpetToCancel16to30SecFlag": "BETWEEN 15001 AND 30000",
    "accpetToCancelMoreThan30SecFlag": "> 30000",
}
STATUSES = {"agentVisitorInactiveFlag": "NON_INTERACTIVE", "agentInactiveFlag": "AGENT_NON_INTERACTIVE", "visitorInactiveFlag": "VISITOR_NON_INTERACTIVE"}
_ALL = [code.strip() for codes in CODES.values() for code in codes.split(",")] + ["'OTHER'", "NULL"]
# each code in turn, whatever the stage times of a row are
EVERY_CODE_SQL = f"CASE event_id % {len(_ALL)} " + " ".join(f"WHEN {i} THEN {code}" for i, code in enumerate(_ALL)) + " END"


def _termination_sql(code: str, requested: str, started: str, interactive: str) -> str:
    before_start = f"{interactive} IS NULL AND {started} IS NULL"
    stages = {
        "preQueued": f"{before_start} AND {requested} IS NULL",
        "preConnected": f"{before_start} AND {requested} IS NOT NULL",
        "preInteractive": f"{interactive} IS NULL AND {started} IS NOT NULL",
        "postInteractive": f"{interactive} IS NOT NULL",
    }
    columns = []
    for stage, causes in STAGES.items():
        for cause in causes.split():
            reached = before_start if (stage, cause) == ("preQueued", "QueueFull") else stages[stage]
            columns.append(f"CASE WHEN {reached} AND {code} IN ({CODES[cause]}) THEN 1 ELSE 0 END AS {stage}{cause}Flag")
    return ",\n".join(columns)


def _latency_sql(code: str, gap: str) -> str:
    columns = []
    for name, test in LATENCIES.items():
        columns.append(f"CASE WHEN {code} IN ('VISITOR_LEAVE', 'VISITOR_UNAVAILABLE') AND {gap} {test} THEN 1 ELSE 0 END AS {name}")
    return ",\n".join(columns)


@check(
    f"""WITH e AS ({EVENTS_SQL}), s AS (
      SELECT event_id, {EVERY_CODE_SQL} AS code,
        CASE WHEN k % 2 = 0 THEN epoch_ms END AS requested,
        CASE WHEN k % 3 = 0 THEN epoch_ms END AS started,
        CASE WHEN k % 5 = 0 THEN epoch_ms END AS interactive FROM e)
    SELECT event_id, {_termination_sql("code", "requested", "started", "interactive")} FROM s"""
)
def termination_stage_flags(spark, sf_dir):
    rows = events(spark, sf_dir).selectExpr(
        "event_id",
        f"{EVERY_CODE_SQL} AS code",
        "CASE WHEN k % 2 = 0 THEN epoch_ms END AS requested",
        "CASE WHEN k % 3 = 0 THEN epoch_ms END AS started",
        "CASE WHEN k % 5 = 0 THEN epoch_ms END AS interactive",
    )
    flags = termination_flags(*[F.col(name) for name in ("code", "requested", "started", "interactive")])
    return rows.select("event_id", *[column.alias(name) for name, column in flags.items()])


@check(
    f"""WITH e AS ({EVENTS_SQL}), s AS (SELECT event_id, {CODES_SQL} AS code, CAST(round(value * 400) AS BIGINT) AS gap FROM e)
    SELECT event_id, gap, {_latency_sql("code", "gap")} FROM s"""
)
def latency_buckets(spark, sf_dir):
    rows = events(spark, sf_dir).selectExpr("event_id", f"{CODES_SQL} AS code", "CAST(round(value * 400) AS BIGINT) AS gap")
    flags = cancel_latency_flags(F.col("code"), F.col("gap"))
    return rows.select("event_id", "gap", *[column.alias(name) for name, column in flags.items()])


@check(
    """SELECT event_id, split_part('Mozilla/5.0 (X11 (' || event_type || ' ' || user_id, '(', 3) AS os FROM events"""
)
def user_agent_os(spark, sf_dir):
    agent = F.concat(F.lit("Mozilla/5.0 (X11 ("), "event_type", F.lit(" "), "user_id", F.lit(") like (Gecko) x"))
    return events(spark, sf_dir).select("event_id", operating_system(agent).alias("os"))


def _funnel_sql() -> str:
    """The funnel over the derived events, stage by stage, as plain joins."""
    suffixed = "'s' || user_id || '@@' || ((k // 4) % 2)"
    invite = "'inv' || ((k // 4) % 3)"
    code = "COALESCE(j.code, n.code)"
    gap = "(COALESCE(j.t, n.t, r.form_t, r.t, 0) - COALESCE(r.t, r.form_t, 0))"
    inactive = ",\n".join(f"CASE WHEN m.status = '{v}' THEN 1 ELSE 0 END AS {n}" for n, v in STATUSES.items())

    def notice(name: str, pattern: str, reached: str) -> str:
        return f"CASE WHEN {reached} AND f.t IS NULL AND lower(l.info) LIKE '%{pattern}%' THEN 1 ELSE 0 END AS {name}"

    return f"""
WITH e AS ({EVENTS_SQL}),
web AS (
  SELECT epoch_ms AS t, 'app' || (user_id % 3) AS app, 'v' || user_id AS tag,
    CASE WHEN event_type IN ('view', 'click') THEN 's' || user_id ELSE {suffixed} END AS session,
    CASE WHEN event_type = 'purchase' AND k % 5 = 0 THEN NULL ELSE 'client' || (user_id % 3) END AS client,
    {invite} AS invite, event_type AS kind, k
  FROM e WHERE event_type <> 'error'),
hot AS (
  SELECT DISTINCT t, app, tag, session, client,
    CASE WHEN k % 2 = 0 THEN 'g' || (k % 5) END AS grp,
    CASE WHEN k % 2 = 1 OR k % 10 = 2 THEN NULL WHEN k % 10 = 0 THEN 'null' ELSE 'r' || (k % 7) END AS rule,
    CASE WHEN k % 2 = 1 THEN 't' || (k % 3) END AS eval,
    CASE WHEN k % 2 = 1 AND k % 4 <> 1 THEN 'why' || (k % 3) END AS reason
  FROM web WHERE kind = 'click'),
hot_next AS (
  SELECT *, COALESCE((SELECT min(x.t) FROM hot x WHERE x.app = hot.app AND x.tag = hot.tag
    AND x.session = hot.session AND x.t > hot.t), t + 300000) AS next_t FROM hot),
page AS (
  SELECT DISTINCT t, app, tag, session, client, '/p/' || k AS url, 'page ' || (k % 10) AS title,
    CASE WHEN k % 2 = 0 THEN NULL ELSE '/r' END AS referrer,
    'OS ' || (k % 3) || '; x' AS os, 'Mozilla/5.0 (X11 (OS ' || (k % 3) || '; x) Engine (y)' AS agent,
    'b' || (k % 2) AS browser, 'd' || (k % 3) AS device
  FROM web WHERE kind = 'view'),
page_next AS (
  SELECT *, COALESCE((SELECT min(x.t) FROM page x WHERE x.app = page.app AND x.tag = page.tag
    AND x.session = page.session AND x.t > page.t), t + 300000) AS next_t FROM page),
offer AS (
  SELECT t, app, tag, session, split_part(session, '@@', 1) AS base, client, invite, 'type' || (k % 2) AS type
  FROM web WHERE kind = 'signup' AND k % 4 < 2),
notice AS (
  SELECT app, tag, split_part(session, '@@', 1) AS base, info, max(t) AS t FROM (
    SELECT *, 'a' || (k % 2) AS action, CASE k % 3 WHEN 0 THEN 'x queueAfterHours' WHEN 1 THEN 'caCheckFail y' END AS info
    FROM web WHERE kind = 'signup' AND k % 4 = 2 AND k % 8 = 2)
  WHERE info IS NOT NULL GROUP BY app, tag, session, client, action, info),
form AS (SELECT app, tag, session, t AS form_t FROM web WHERE kind = 'purchase' AND k % 3 = 2 AND k % 2 = 0),
answer AS (
  SELECT w.t, w.app, w.tag, w.session, w.client, w.invite,
    CASE WHEN k % 2 = 0 THEN 'ACCEPTED' ELSE 'DECLINED' END AS response, form.form_t
  FROM web w LEFT JOIN form ON form.app = w.app AND form.tag = w.tag AND form.session = w.session
  WHERE w.kind = 'purchase' AND w.k % 3 < 2),
screen AS (
  SELECT app, tag, session, k % 3 AS screen, max(t) AS t FROM web
  WHERE kind = 'signup' AND k % 8 = 3 GROUP BY app, tag, session, k % 3),
chat AS (
  SELECT epoch_ms AS t, event_id % 8 AS stage,
    CASE WHEN event_id % 8 = 5 AND k % 2 = 0 THEN 'x' || event_id ELSE 'i' || user_id || '-' || ((k // 4) % 3) END AS id,
    CASE k % 4 WHEN 0 THEN 'NON_INTERACTIVE' WHEN 1 THEN 'AGENT_NON_INTERACTIVE' WHEN 2 THEN 'VISITOR_NON_INTERACTIVE' ELSE '' END AS status,
    'client' || (user_id % 3) || '-acc' AS account, 'client' || (user_id % 3) AS owner,
    COALESCE({CODES_SQL}, 'NULL') AS code,
    CASE WHEN event_id % 8 = 5 AND k % 5 = 0 THEN NULL ELSE 'v' || user_id END AS vi,
    {invite} AS psid, 'q' || (k % 3) AS queue, k % 2 AS transfers,
    CASE WHEN k % 3 = 0 THEN NULL ELSE 'ACTIVE' END AS activity
  FROM e WHERE event_type = 'error'),
f AS (SELECT id, vi, psid, account, owner, min(t) AS t FROM chat WHERE stage = 0 GROUP BY ALL),
g AS (SELECT DISTINCT t, id, vi, psid, queue, transfers, account FROM chat WHERE stage = 1),
h AS (SELECT DISTINCT t, id, vi, queue, transfers, account FROM chat WHERE stage = 2),
m AS (SELECT DISTINCT t, id, vi, queue, transfers, account, status FROM chat WHERE stage = 3),
i AS (SELECT DISTINCT t, id, vi, queue, transfers, account FROM chat WHERE stage = 4),
j AS (SELECT DISTINCT t, id, vi, psid, queue, transfers, account, owner, code FROM chat WHERE stage = 5),
n AS (SELECT DISTINCT t, id, vi, queue, transfers, account, code, activity FROM chat WHERE stage = 6),
o AS (SELECT DISTINCT t, id, vi, psid, queue, account, owner FROM chat WHERE stage = 7)
SELECT
  b.t || ':' || b.session || ':' || COALESCE(c.invite, 'NONE') || ':' || COALESCE(f.id, o.id, 'NONE') AS uniqueRowId,
  b.t AS journeyStartTime, a.t AS pageLoadTimeEpochMillisUTC, b.tag AS visitorID,
  b.session AS visitorBrowserSessionId, b.app AS clientID, a.url AS pageLoadURL, a.title AS pageTitle,
  b.t AS hotleadTimeEpochMillisUTC, b.eval AS hotLeadEvalType, COALESCE(b.reason, 'NULL') AS hotLeadEvalFailureReason,
  b.grp AS targetGroupID, CASE WHEN COALESCE(b.rule, 'null') = 'null' THEN 'NULL' ELSE b.rule END AS ruleID,
  {notice("queueAfterHoursPriorInviteFlag", "queueafterhours", "c.t IS NULL")},
  {notice("caCheckFailPriorInviteFlag", "cacheckfail", "c.t IS NULL")},
  c.t AS inviteShownTimeEpochMillisUTC, COALESCE(c.invite, 'NULL') AS inviteID, COALESCE(c.type, 'NULL') AS inviteType,
  r.t AS inviteResponseTimeEpochMillisUTC, COALESCE(r.response, 'NULL') AS inviteResponseID,
  {notice("queueAfterHoursPostInviteResponseFlag", "queueafterhours", "r.t IS NOT NULL")},
  {notice("caCheckFailPostInviteResponseFlag", "cacheckfail", "r.t IS NOT NULL")},
  s.t AS pcfShownTimeEpochMillisUTC, r.form_t AS pcfSubmitTimeEpochMillisUTC,
  {notice("queueAfterHoursPostPCFSubmitFlag", "queueafterhours", "r.form_t IS NOT NULL")},
  {notice("caCheckFailPostPCFSubmitFlag", "cacheckfail", "r.form_t IS NOT NULL")},
  f.t AS chatRequestTimeEpochMillisUTC, COALESCE(f.id, o.id, 'NULL') AS interactionID,
  g.t AS chatStartedTimeEpochMillisUTC, h.t AS chatInteractiveTimeEpochMillisUTC,
  COALESCE(i.queue, 'NULL') AS chatDisposedQueueID, i.t AS chatDisposedTimeEpochMillisUTC,
  j.t AS chatCancelledTimeEpochMillisUTC, COALESCE({code}, 'NULL') AS chatCancelID, COALESCE(j.queue, 'NULL') AS chatCancelQueueID,
  {_termination_sql(code, "f.t", "g.t", "h.t")},
  0 AS resolvedFlag, 0 AS inScopeFlag,
  {inactive},
  COALESCE(n.activity, 'NULL') AS visitorActivityStatusAtDisconnect,
  {_latency_sql(code, gap)},
  CASE WHEN r.response = 'ACCEPTED' AND o.t IS NULL THEN 1 ELSE 0 END AS aivaChatFlag,
  n.t AS chatTerminatedTimeEpochMillisUTC, o.queue AS chatInitiatedQueueID,
  a.os AS operatingSystem, a.agent AS userAgent, a.browser AS browser, a.device AS deviceType
FROM hot_next b
LEFT JOIN page_next a ON a.app = b.app AND a.tag = b.tag AND a.session = b.session AND b.t BETWEEN a.t AND a.next_t
LEFT JOIN offer c ON c.app = b.app AND c.tag = b.tag AND c.base = b.session AND c.t BETWEEN b.t AND b.next_t
LEFT JOIN notice l ON l.app = b.app AND l.tag = b.tag AND l.base = b.session AND l.t BETWEEN b.t AND b.next_t
LEFT JOIN answer r ON r.app = c.app AND r.tag = c.tag AND r.session = c.session AND r.invite = c.invite
LEFT JOIN screen s ON s.app = c.app AND s.tag = c.tag AND s.session = c.session
LEFT JOIN f ON f.vi = c.tag AND f.psid = c.invite AND f.owner = COALESCE(r.client, c.client)
LEFT JOIN g ON g.id = f.id AND g.account = f.account
LEFT JOIN h ON h.id = COALESCE(g.id, f.id) AND h.account = COALESCE(g.account, f.account)
LEFT JOIN m ON m.id = COALESCE(g.id, f.id) AND m.account = COALESCE(g.account, f.account)
LEFT JOIN i ON i.id = COALESCE(h.id, g.id, f.id)
LEFT JOIN j ON (j.id = COALESCE(h.id, g.id, f.id) AND j.account = COALESCE(h.account, g.account, f.account))
  OR (j.vi = c.tag AND j.psid = c.invite AND j.owner = COALESCE(r.client, c.client))
LEFT JOIN n ON n.id = COALESCE(h.id, g.id, f.id) AND n.account = COALESCE(h.account, g.account, f.account)
LEFT JOIN o ON o.vi = c.tag AND o.psid = c.invite AND o.owner = COALESCE(r.client, c.client)
"""


@check(_funnel_sql())
def chat_funnel(spark, sf_dir):
    return journey_funnel(web_events(spark, sf_dir), chat_interactions(spark, sf_dir))


@check(_funnel_sql())
def chat_funnel_staged(spark, sf_dir):
    staging = scratch_path(spark, "funnel")
    return journey_funnel(web_events(spark, sf_dir), chat_interactions(spark, sf_dir), staging=staging)
