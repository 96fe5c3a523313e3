"""The given tables and the event records derived from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotviews.operators.slots import timestamp_to_ms
from slotviews.session import scratch_path

MONTH = ("202401010000", "202402010000")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with epoch milliseconds and the number in their properties."""
    rows = table(spark, sf_dir, "events")
    return rows.withColumns(
        {
            "epoch_ms": timestamp_to_ms("ts"),
            "k": F.get_json_object("props", "$.k").cast("int"),
        }
    )


# The same columns for the oracles. Milliseconds are truncated, as in Spark.
EVENTS_SQL = """
    SELECT *, epoch_us(ts) // 1000 AS epoch_ms, CAST(props->>'$.k' AS INTEGER) AS k FROM events
"""

WEB_TYPE = """
struct<
  header: struct<timeEpochMillisUTC: bigint, applicationId: string, associativeTag: string,
    channelSessionId: string, clientId: string, channel: string>,
  body: struct<
    typeSpecificBody: struct<body: struct<
      WebPageLoadEvent: struct<pageURL: string, pageTitle: string, navigationPath: string, referrerURL: string>,
      TargetDeterminationEvent: struct<targetGroupId: string, ruleId: string>,
      EvalConditionCheck: struct<evalType: string, evalFailureReason: string>,
      OnlineInvitationOfferEvent: struct<inviteId: string, inviteType: string>,
      OnlineInvitationResponseEvent: struct<inviteId: string, inviteType: string, response: string>,
      OnlineSurveySubmitEvent: struct<surveyId: string>,
      OnlineScreenLoadEvent: struct<screenId: string, screenTitle: string, screenType: string>,
      Application: struct<appEntity: string, appAction: string, appInfo: string>>>,
    customProperties: struct<
      userAgent: struct<value: struct<string: string>>,
      Browser: struct<value: struct<string: string>>,
      deviceType: struct<value: struct<string: string>>>>>
"""


def stored(rows: DataFrame, label: str) -> DataFrame:
    """The rows written to the shared scratch folder and read back, as a raw table is."""
    path = scratch_path(rows.sparkSession, label)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def web_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events but errors as nested web events of a visitor's browser session.

    view is a page load, click a hot lead, signup an invitation, notice or form
    screen, purchase an invitation response or a submitted form.
    """
    suffixed = "concat('s', user_id, '@@', (k div 4) % 2)"
    invite = "concat('inv', (k div 4) % 3)"
    rows = events(spark, sf_dir).where("event_type <> 'error'")
    rows = rows.selectExpr(
        f"""named_struct(
            'timeEpochMillisUTC', epoch_ms,
            'applicationId', concat('app', user_id % 3),
            'associativeTag', concat('v', user_id),
            'channelSessionId', if(event_type IN ('view', 'click'), concat('s', user_id), {suffixed}),
            'clientId', if(event_type = 'purchase' AND k % 5 = 0, NULL, concat('client', user_id % 3)),
            'channel', if(k % 8 = 2, 'OmniChannel', 'ONLINE')) AS header""",
        f"""named_struct(
            'typeSpecificBody', named_struct('body', named_struct(
                'WebPageLoadEvent', if(event_type = 'view', named_struct(
                    'pageURL', concat('/p/', k), 'pageTitle', concat('page ', k % 10),
                    'navigationPath', '/nav', 'referrerURL', if(k % 2 = 0, NULL, '/r')), NULL),
                'TargetDeterminationEvent', if(event_type = 'click' AND k % 2 = 0, named_struct(
                    'targetGroupId', concat('g', k % 5),
                    'ruleId', CASE k % 10 WHEN 0 THEN 'null' WHEN 2 THEN NULL ELSE concat('r', k % 7) END), NULL),
                'EvalConditionCheck', if(event_type = 'click' AND k % 2 = 1, named_struct(
                    'evalType', concat('t', k % 3),
                    'evalFailureReason', if(k % 4 = 1, NULL, concat('why', k % 3))), NULL),
                'OnlineInvitationOfferEvent', if(event_type = 'signup' AND k % 4 < 2, named_struct(
                    'inviteId', {invite}, 'inviteType', concat('type', k % 2)), NULL),
                'OnlineInvitationResponseEvent', if(event_type = 'purchase' AND k % 3 < 2, named_struct(
                    'inviteId', {invite}, 'inviteType', concat('type', k % 2),
                    'response', if(k % 2 = 0, 'ACCEPTED', 'DECLINED')), NULL),
                'OnlineSurveySubmitEvent', if(event_type = 'purchase' AND k % 3 = 2, named_struct(
                    'surveyId', if(k % 2 = 0, 'pcf', 'other')), NULL),
                'OnlineScreenLoadEvent', if(event_type = 'signup' AND k % 4 = 3, named_struct(
                    'screenId', concat('sc', k % 3), 'screenTitle', 'form',
                    'screenType', if(k % 8 = 3, 'PreChat', 'POST')), NULL),
                'Application', if(event_type = 'signup' AND k % 4 = 2, named_struct(
                    'appEntity', 'chat', 'appAction', concat('a', k % 2),
                    'appInfo', CASE k % 3 WHEN 0 THEN 'x queueAfterHours' WHEN 1 THEN 'caCheckFail y' ELSE 'other' END), NULL))),
            'customProperties', named_struct(
                'userAgent', named_struct('value', named_struct('string', concat('Mozilla/5.0 (X11 (OS ', k % 3, '; x) Engine (y)'))),
                'Browser', named_struct('value', named_struct('string', concat('b', k % 2))),
                'deviceType', named_struct('value', named_struct('string', concat('d', k % 3))))) AS body""",
    )
    return stored(rows.select(F.struct("*").cast(WEB_TYPE).alias("e")).select("e.*"), "web")


CHAT_TYPE = """
struct<eventRaisedTimeMillis: bigint, interactionId: string, eventType: string, participantInteractiveStatus: string,
  context: struct<account: string, client: string, terminationReason: string,
    data: struct<vi: string, psid: string, queue: string, queueTransferCount: bigint,
      VISITOR_STATUS_AT_TIME_OF_DISCONNECT: string>>>
"""


def chat_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All error events as chat interactions; the event id says which stage."""
    rows = events(spark, sf_dir).where("event_type = 'error'")
    rows = rows.selectExpr(
        "epoch_ms AS eventRaisedTimeMillis",
        """if(event_id % 8 = 5 AND k % 2 = 0, concat('x', event_id),
              concat('i', user_id, '-', (k div 4) % 3)) AS interactionId""",
        """CASE event_id % 8
             WHEN 0 THEN 'interaction/status/requested' WHEN 1 THEN 'interaction/status/started'
             WHEN 2 THEN 'interaction/status/interactive' WHEN 3 THEN 'interaction/status/noninteractive'
             WHEN 4 THEN 'interaction/status/disposed' WHEN 5 THEN 'interaction/status/cancelled'
             WHEN 6 THEN 'interaction/status/terminated' ELSE 'interaction/initiated' END AS eventType""",
        """CASE k % 4 WHEN 0 THEN 'NON_INTERACTIVE' WHEN 1 THEN 'agent_non_interactive'
             WHEN 2 THEN 'VISITOR_NON_INTERACTIVE' END AS participantInteractiveStatus""",
        """named_struct(
             'account', concat('client', user_id % 3, '-acc'), 'client', concat('client', user_id % 3),
             'terminationReason', CASE k % 9 WHEN 0 THEN 'VISITOR_LEAVE' WHEN 1 THEN 'visitor_unavailable'
                WHEN 2 THEN 'OWNER_LEFT' WHEN 3 THEN 'SYSTEM_FAILURE' WHEN 4 THEN 'QUEUE_TIMEOUT'
                WHEN 5 THEN 'QUEUE_FULL' WHEN 6 THEN 'VISITOR_NON_RESPONSIVE_AUTO_TERMINATED' WHEN 7 THEN 'OTHER' END,
             'data', named_struct(
                'vi', if(event_id % 8 = 5 AND k % 5 = 0, NULL, concat('v', user_id)),
                'psid', concat('inv', (k div 4) % 3), 'queue', concat('q', k % 3),
                'queueTransferCount', k % 2,
                'VISITOR_STATUS_AT_TIME_OF_DISCONNECT', if(k % 3 = 0, NULL, 'active'))) AS context""",
    )
    return stored(rows.select(F.struct("*").cast(CHAT_TYPE).alias("e")).select("e.*"), "chat")
