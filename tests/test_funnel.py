"""The funnel over hand-made journeys."""

import json
import random

import pytest
from checks.tables import CHAT_TYPE, WEB_TYPE
from pyspark.sql import functions as F
from tests.conftest import plan_of

from slotviews.functions.flags import CANCEL_BUCKETS, CAUSES, STAGE_CAUSES, cancel_latency_flags, termination_flags
from slotviews.plans import funnel
from slotviews.plans.funnel import journey_funnel, placed_marks

KINDS = {
    "page": ("WebPageLoadEvent", {"pageURL": "/p"}),
    "hot": ("TargetDeterminationEvent", {"targetGroupId": "g", "ruleId": "null"}),
    "offer": ("OnlineInvitationOfferEvent", {"inviteId": "i1", "inviteType": "chat"}),
    "answer": ("OnlineInvitationResponseEvent", {"inviteId": "i1", "response": "ACCEPTED"}),
    "form": ("OnlineSurveySubmitEvent", {"surveyId": "pcf"}),
    "screen": ("OnlineScreenLoadEvent", {"screenId": "s", "screenType": "prechat"}),
    "notice": ("Application", {"appInfo": "x queueAfterHours"}),
}


def web(kind, t, session="s1", tag="v1"):
    name, fields = KINDS[kind]
    raw = session if kind in ("page", "hot") else f"{session}@@x"
    header = {
        "timeEpochMillisUTC": t,
        "applicationId": "app",
        "associativeTag": tag,
        "channelSessionId": raw,
        "clientId": "acme",
        "channel": "omnichannel",
    }
    return json.dumps({"header": header, "body": {"typeSpecificBody": {"body": {name: fields}}}})


def chat(stage, t, reason=None, account="acme-1", interaction="c1", vi="v1", psid="i1"):
    kind = "interaction/initiated" if stage == "initiated" else f"interaction/status/{stage}"
    data = {"vi": vi, "psid": psid, "queue": "q"}
    return json.dumps(
        {
            "eventRaisedTimeMillis": t,
            "interactionId": interaction,
            "eventType": kind,
            "participantInteractiveStatus": "agent_non_interactive",
            "context": {"account": account, "terminationReason": reason, "data": data},
        }
    )


def parsed(spark, rows, kind):
    texts = spark.createDataFrame([(r,) for r in rows], "value string")
    return texts.select(F.from_json("value", kind).alias("r")).select("r.*")


def visit(tag):
    times = {"page": 1000, "hot": 2000, "offer": 3000, "screen": 4200, "answer": 4000, "form": 4500}
    return [web(kind, t, tag=tag) for kind, t in times.items()]


GAPS = {5000: 0, 5001: 1, 10001: 2, 15001: 3, 30000: 3, 30001: 4}
WEB = [
    *visit("whole"),
    *[row for gap in GAPS for row in visit(f"gap{gap}")],
    *visit("full"),
    *visit("noticed"),
    web("notice", 2500, tag="noticed"),
    *[web(kind, t, tag="boundary") for kind, t in (("page", 1000), ("page", 2000), ("hot", 2000))],
    *[web(kind, t, tag="late") for kind, t in (("hot", 1000), ("page", 302000), ("offer", 301001))],
    *[web(kind, t, tag="early notice") for kind, t in (("hot", 1000), ("notice", 1500), ("notice", 1600))],
]
STAGES = ("initiated", "requested", "started", "interactive", "noninteractive", "disposed")
CHAT = [
    *[chat(stage, 5000 + i, vi="whole") for i, stage in enumerate(STAGES)],
    chat("requested", 9000, vi="whole"),
    chat("terminated", 6000, "owner_left"),
    *[chat("cancelled", 4000 + gap, "visitor_leave", interaction="other", vi=f"gap{gap}") for gap in GAPS],
    chat("requested", 4900, vi="full", interaction="c2"),
    chat("cancelled", 5000, "QUEUE_FULL", vi=None, interaction="c2"),
]


@pytest.fixture(scope="module", params=["direct", "staged"])
def journeys(request, spark, tmp_path_factory):
    """Rows of the funnel by visitor."""
    staging = str(tmp_path_factory.mktemp("funnel") / "s") if request.param == "staged" else None
    found = journey_funnel(parsed(spark, WEB, WEB_TYPE), parsed(spark, CHAT, CHAT_TYPE), staging=staging)
    assert len(found.columns) == 74
    assert "CartesianProduct" not in plan_of(found) and "NestedLoop" not in plan_of(found)
    rows = {}
    for row in found.collect():
        rows.setdefault(row.visitorID, []).append(row)
    return rows


def test_whole_journey(journeys):
    (row,) = journeys["whole"]
    assert row.uniqueRowId == "2000:s1:i1:c1" and row.ruleID == "NULL" and row.pageLoadURL == "/p"
    assert (row.inviteResponseTimeEpochMillisUTC, row.pcfShownTimeEpochMillisUTC, row.pcfSubmitTimeEpochMillisUTC) == (4000, 4200, 4500)
    assert (row.chatRequestTimeEpochMillisUTC, row.chatStartedTimeEpochMillisUTC, row.chatInteractiveTimeEpochMillisUTC) == (5001, 5002, 5003)
    assert (row.agentInactiveFlag, row.chatDisposedQueueID, row.chatInitiatedQueueID, row.aivaChatFlag) == (1, "q", "q", 0)
    flags = {name: value for name, value in row.asDict().items() if name.startswith(("pre", "post")) and name.endswith("Flag")}
    assert [name for name, value in flags.items() if value] == ["postInteractiveAgentLostFlag"]
    assert row.chatCancelID == "OWNER_LEFT" and row.chatCancelQueueID == "NULL"


def test_cancel_latency(journeys):
    for gap, bucket in GAPS.items():
        (row,) = journeys[f"gap{gap}"]
        assert [row[name] for name in CANCEL_BUCKETS] == [int(i == bucket) for i in range(5)]
        assert row.preQueuedUserEndedFlag == 1 and row.aivaChatFlag == 1


def test_cancelled_with_a_full_queue(journeys):
    (row,) = journeys["full"]
    assert row.preQueuedQueueFullFlag == 1 and row.chatRequestTimeEpochMillisUTC == 4900


def test_hot_lead_on_a_page_boundary_matches_both_pages(journeys):
    assert sorted(row.pageLoadTimeEpochMillisUTC for row in journeys["boundary"]) == [1000, 2000]


def test_nothing_beyond_the_horizon(journeys):
    (row,) = journeys["late"]
    assert row.pageLoadURL is None and row.inviteID == "NULL" and row.interactionID == "NULL"


def test_notices(journeys):
    (row,) = journeys["early notice"]
    assert row.queueAfterHoursPriorInviteFlag == 1 and row.caCheckFailPriorInviteFlag == 0
    (row,) = journeys["noticed"]
    assert (row.queueAfterHoursPriorInviteFlag, row.queueAfterHoursPostInviteResponseFlag, row.queueAfterHoursPostPCFSubmitFlag) == (0, 1, 1)


def test_every_stage_and_cause(spark):
    reached = {"preQueued": (), "preConnected": ("f",), "preInteractive": ("f", "g"), "postInteractive": ("f", "g", "h")}
    rows = [(stage, cause, code) for stage in reached for cause, codes in CAUSES.items() for code in codes]
    df = spark.createDataFrame(rows, "stage string, cause string, code string")
    times = [F.when(F.col("stage").isin([s for s, seen in reached.items() if step in seen]), F.lit(9)) for step in "fgh"]
    flags = termination_flags(F.col("code"), *times)
    for row in df.select("stage", "cause", *[c.alias(n) for n, c in flags.items()]).collect():
        expected = {f"{row.stage}{row.cause}Flag"} if row.cause in STAGE_CAUSES[row.stage] else set()
        if row.cause == "QueueFull" and row.stage == "preConnected":
            expected = {"preQueuedQueueFullFlag"}
        assert {name for name in flags if row[name] == 1} == expected


def test_latency_needs_a_visitor_code(spark):
    flags = cancel_latency_flags(F.lit("OWNER_LEFT"), F.lit(1))
    assert sum(spark.range(1).select(*flags.values()).first()) == 0


def test_events_are_read_once_and_rows_move_little(spark, tmp_path, monkeypatch):
    parsed(spark, WEB, WEB_TYPE).write.parquet(f"{tmp_path}/raw-web")
    parsed(spark, CHAT, CHAT_TYPE).write.parquet(f"{tmp_path}/raw-chat")
    plans, store = [], funnel._store
    monkeypatch.setattr(funnel, "_store", lambda rows, *rest: (plans.append(plan_of(rows)), store(rows, *rest))[1])
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        found = journey_funnel(spark.read.parquet(f"{tmp_path}/raw-web"), spark.read.parquet(f"{tmp_path}/raw-chat"), staging=f"{tmp_path}/s")
        plans.append(plan_of(found))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert sum(plan.count("Exchange hashpartitioning") for plan in plans) <= 35
    assert [plan.count("FileScan") for plan in plans if "header" in plan or "eventRaised" in plan] == [1, 1]


@pytest.mark.parametrize("span", [1, 50, 100_000])
def test_marks_belong_to_what_holds_at_their_time(spark, span):
    draw = random.Random(span)
    rows = []
    for i in range(400):
        key = "hot" if draw.random() < 0.6 else draw.choice(["a", "b", None])
        rows.append((draw.choice(["hot", "page", "offer", "notice"]), "app", key, "s", draw.choice([None] + [draw.randrange(1500)] * 30)))
    df = spark.createDataFrame(rows, "kind string, app string, tag string, session string, t bigint")
    times = {(kind, tag): sorted({r[4] for r in rows if r[0] == kind and r[2] == tag and r[4] is not None}) for kind in ("hot", "page") for tag in ("hot", "a", "b")}

    def holding(kind, tag, t, horizon=30):
        starts = times[kind, tag]
        return [s for s in starts if s <= t <= min([x for x in starts if x > s], default=s + horizon)]

    want = {(tag, t): (sorted(holding("hot", tag, t)), sorted(holding("page", tag, t))) for _, _, tag, _, t in rows if tag is not None and t is not None}
    got = {(r.tag, r.t): (sorted(r.leads), sorted(r.pages)) for r in placed_marks(df, 30, span).collect()}
    assert got == want
