"""The digital chat funnel: one row per hot lead and what followed it.

Inputs are web events (nested ``header``/``body`` records) and chat interactions. The
result is a left-outer journey: hot lead, the page it happened on, notices, invitation,
response, form, chat request, chat stages and its end.

The journey is not joined step by step along one growing row set:

* the web events are read once, into a table of the few fields the funnel needs, by kind
  of event; the chat events once, into their distinct stages;
* hot leads, page loads, notices and invitations become marks on the visitor's time line.
  One ordered pass over the distinct marks of each visitor and span of time finds, for
  every mark, the hot leads and the page loads it belongs to (``placed_marks``). No
  interval is built and no pair is compared;
* pages, notices and invitations then meet their rows by visitor keys and time, and the
  hot leads by the lead's time. Left joins on keys that are null when the earlier step is
  missing are associative, so what follows an invitation is joined to the invitations
  alone, and the stages of a chat to the chat requests alone. Hot leads without an
  invitation, usually most rows, never meet the later joins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from slotviews.functions.flags import (
    cancel_latency_flags,
    flag,
    inactivity_flags,
    notice_flags,
    termination_flags,
)
from slotviews.functions.scalars import base_session, client_of_account, operating_system
from slotviews.operators.intervals import HORIZON_MS, SPAN_MS, attach
from slotviews.operators.joins import left_join_any, left_join_on
from slotviews.session import scratch_path

KEYS = ["app", "tag", "session"]
EVENT = "body.typeSpecificBody.body"
PROPERTY = "body.customProperties"

# Event type names of chat interactions by stage.
CHAT_EVENTS = {
    "requested": "interaction/status/requested",
    "started": "interaction/status/started",
    "interactive": "interaction/status/interactive",
    "noninteractive": "interaction/status/noninteractive",
    "disposed": "interaction/status/disposed",
    "cancelled": "interaction/status/cancelled",
    "terminated": "interaction/status/terminated",
    "initiated": "interaction/initiated",
}


def _event(name: str, field: str | None = None) -> Column:
    return F.col(f"{EVENT}.{name}" if field is None else f"{EVENT}.{name}.{field}")


def web_marks(web: DataFrame) -> DataFrame:
    """The web events the funnel needs: one row per event and kind, with the kind's fields."""
    target, check, page, offer = "TargetDeterminationEvent", "EvalConditionCheck", "WebPageLoadEvent", "OnlineInvitationOfferEvent"
    answer, survey, screen, application = "OnlineInvitationResponseEvent", "OnlineSurveySubmitEvent", "OnlineScreenLoadEvent", "Application"
    info, agent = _event(application, "appInfo"), F.col(f"{PROPERTY}.userAgent.value.string")
    noticed = _event(application).isNotNull() & (F.upper("header.channel") == "OMNICHANNEL") & (info.like("%queueAfterHours%") | info.like("%caCheckFail%"))
    kinds = {
        "hot": _event(target).isNotNull() | _event(check).isNotNull(),
        "page": _event(page).isNotNull(),
        "offer": _event(offer).isNotNull(),
        "notice": noticed,
        "answer": _event(answer).isNotNull(),
        "form": _event(survey).isNotNull() & (F.upper(_event(survey, "surveyId")) == "PCF"),
        "screen": _event(screen).isNotNull() & (F.upper(_event(screen, "screenType")) == "PRECHAT"),
    }
    fields = {
        "hot": {"b_group": _event(target, "targetGroupId"), "b_rule": _event(target, "ruleId"), "b_eval": _event(check, "evalType"), "b_reason": _event(check, "evalFailureReason")},
        "page": {
            "a_url": _event(page, "pageURL"),
            "a_title": _event(page, "pageTitle"),
            "a_path": _event(page, "navigationPath"),
            "a_referrer": _event(page, "referrerURL"),
            "a_os": operating_system(agent),
            "a_agent": agent,
            "a_browser": F.col(f"{PROPERTY}.Browser.value.string"),
            "a_device": F.col(f"{PROPERTY}.deviceType.value.string"),
        },
        "offer": {"c_invite": _event(offer, "inviteId"), "c_type": _event(offer, "inviteType")},
        "notice": {"l_entity": _event(application, "appEntity"), "l_action": _event(application, "appAction"), "l_info": info},
        "answer": {"d_invite": _event(answer, "inviteId"), "d_response": _event(answer, "response")},
        "screen": {"k_screen": _event(screen, "screenId"), "k_title": _event(screen, "screenTitle")},
    }
    header = {"t": "timeEpochMillisUTC", "app": "applicationId", "tag": "associativeTag", "session": "channelSessionId", "client": "clientId"}
    present = F.array_compact(F.array(*[F.when(test, F.lit(kind)) for kind, test in kinds.items()]))
    rows = web.select(F.explode(present).alias("kind"), *[F.col(f"header.{source}").alias(name) for name, source in header.items()], F.col("body"))
    chosen = [F.when(F.col("kind") == kind, column).alias(name) for kind, columns in fields.items() for name, column in columns.items()]
    return rows.select(*header, *chosen, "kind")


def placed_marks(marks: DataFrame, horizon: int = HORIZON_MS, span: int = SPAN_MS) -> DataFrame:
    """Which hot leads and page loads each mark belongs to: ``(keys, t, is_hot, leads, pages)``.

    A hot lead (page load) holds until the visitor's next strictly later one, both ends
    inclusive, and for ``horizon`` where none follows. So a mark belongs to the latest one
    that has begun and, where one begins exactly at the mark, to the one before it too.

    Marks are reduced to distinct times, of which a span holds a bounded number whatever a
    visitor's share of the rows. What reaches into a span from earlier and later spans comes
    from a second, small window over one row per visitor and span, and joins the span's
    marks as a row without a time.
    """
    point = F.col("kind").isin("notice", "offer")
    rows = marks.where(F.col("kind").isin("hot", "page") | point)
    rows = rows.withColumn("session", F.when(point, base_session(F.col("session"))).otherwise(F.col("session")))
    rows = rows.select(*KEYS, "t", (F.col("kind") == "hot").alias("hot"), (F.col("kind") == "page").alias("page")).dropna()
    rows = rows.withColumn("span", F.col("t") - F.pmod("t", F.lit(span)))
    at = {kind: F.when(F.col(kind), F.col("t")) for kind in ("hot", "page")}
    times = rows.groupBy(*KEYS, "span", "t").agg(F.max("hot").alias("hot"), F.max("page").alias("page"))
    edges = rows.groupBy(*KEYS, "span").agg(*[f(at[kind]).alias(f"{f.__name__}_{kind}") for kind in at for f in (F.max, F.min)])
    earlier = W.partitionBy(*KEYS).orderBy("span").rowsBetween(W.unboundedPreceding, -1)
    later = W.partitionBy(*KEYS).orderBy(F.desc("span")).rowsBetween(W.unboundedPreceding, -1)
    carried = edges.select(*KEYS, "span", *[c for kind in at for c in (F.max(f"max_{kind}").over(earlier).alias(f"from_{kind}"), F.min(f"min_{kind}").over(later).alias(f"to_{kind}"))])
    both = times.unionByName(carried, allowMissingColumns=True)
    inside = W.partitionBy(*KEYS, "span")
    upto = inside.orderBy("t").rowsBetween(W.unboundedPreceding, W.currentRow)
    before = inside.orderBy("t").rowsBetween(W.unboundedPreceding, -1)
    after = inside.orderBy(F.desc("t")).rowsBetween(W.unboundedPreceding, -1)
    found = both.withColumns({f"{end}_{kind}": F.max(f"{end}_{kind}").over(inside) for kind in at for end in ("from", "to")})
    found = found.withColumns(
        {
            name: F.coalesce(column, F.col(f"{end}_{kind}"))
            for kind in at
            for name, column, end in ((f"now_{kind}", F.max(at[kind]).over(upto), "from"), (f"old_{kind}", F.max(at[kind]).over(before), "from"), (f"next_{kind}", F.min(at[kind]).over(after), "to"))
        }
    )

    def holding(kind: str) -> Column:
        now, ended = F.col(f"now_{kind}"), F.col(f"next_{kind}").isNull() & (F.col("t") > F.col(f"now_{kind}") + horizon)
        return F.array_compact(F.array(F.when(~ended, now), F.when(F.col(kind), F.col(f"old_{kind}"))))

    return found.where("t IS NOT NULL").select(*KEYS, "t", F.col("hot").alias("is_hot"), holding("hot").alias("leads"), holding("page").alias("pages"))


def placed_points(marks: DataFrame, placed: DataFrame) -> DataFrame:
    """Notices and invitations once for each hot lead they belong to (``b_t``).

    Of the notices of one visitor session and text, the latest counts.
    """
    offers = marks.where("kind = 'offer'").select(*KEYS, "t", "client", "c_invite", "c_type", "kind")
    notices = marks.where("kind = 'notice'").groupBy(*KEYS, "client", "l_entity", "l_action", "l_info", "kind").agg(F.max("t").alias("t"))
    points = offers.unionByName(notices.select(*KEYS, "t", "l_info", "kind"), allowMissingColumns=True)
    points = points.withColumns({"raw_session": F.col("session"), "session": base_session(F.col("session"))})
    named = {name: f"at_{name}" for name in (*KEYS, "t")}
    around = placed.where(F.size("leads") > 0).select(*[F.col(name).alias(alias) for name, alias in named.items()], "leads")
    same = F.lit(True)
    for name, alias in named.items():
        same = same & (F.col(name) == F.col(alias))
    rows = points.join(around, same).withColumn("b_t", F.explode("leads"))
    return rows.select(*KEYS, "b_t", "t", "raw_session", "client", "c_invite", "c_type", "l_info", "kind")


#: of which fields, besides the interaction and the time, a stage's events are distinct
STAGE_FIELDS = {
    "requested": ("psid",),
    "started": ("psid", "queue", "transfers"),
    "interactive": ("queue", "transfers"),
    "noninteractive": ("queue", "transfers", "status"),
    "disposed": ("queue", "transfers"),
    "cancelled": ("psid", "queue", "transfers", "code"),
    "terminated": ("queue", "transfers", "code", "activity"),
    "initiated": ("psid", "queue"),
}


def chat_stages(chat: DataFrame) -> DataFrame:
    """Distinct interaction events of every stage; of a request, the first time."""
    stage = F.lit(None).cast("string")
    for name, kind in CHAT_EVENTS.items():
        stage = F.when(F.col("eventType") == kind, F.lit(name)).otherwise(stage)
    values = {
        "psid": F.col("context.data.psid"),
        "queue": F.col("context.data.queue"),
        "transfers": F.col("context.data.queueTransferCount"),
        "code": F.coalesce(F.upper("context.terminationReason"), F.lit("NULL")),
        "status": F.upper(F.coalesce("participantInteractiveStatus", F.lit(""))),
        "activity": F.upper("context.data.VISITOR_STATUS_AT_TIME_OF_DISCONNECT"),
    }
    rows = chat.withColumn("__stage", stage).where("__stage IS NOT NULL")
    kept = [F.when(F.col("__stage").isin([s for s, names in STAGE_FIELDS.items() if field in names]), value).alias(field) for field, value in values.items()]
    rows = rows.select(
        F.col("interactionId").alias("id"),
        F.col("context.data.vi").alias("vi"),
        F.col("context.account").alias("account"),
        F.col("context.client").alias("client"),
        *kept,
        F.col("eventRaisedTimeMillis").alias("t"),
        F.col("__stage").alias("stage"),
    )
    moment = F.when(F.col("stage") != "requested", F.col("t")).alias("moment")
    names = [c for c in rows.columns if c not in ("t", "stage")]
    return rows.groupBy(*names, moment, "stage").agg(F.min("t").alias("t")).select(*names, "t", "stage")


def _stage(stages: DataFrame, stage: str, prefix: str, *names: str) -> DataFrame:
    return stages.where(F.col("stage") == stage).select(*[F.col(name).alias(f"{prefix}_{name}") for name in names])


def chats(stages: DataFrame) -> DataFrame:
    """Chat requests with the later stages of the same interaction.

    A stage matches on interaction id and account of the request: ids coalesced over
    the stages reached so far can only be the request's own.
    """
    rows = _stage(stages, "requested", "f", "t", "id", "vi", "psid", "account", "client")
    both = lambda p: {f"{p}_id": "f_id", f"{p}_account": "f_account"}
    rows = left_join_on(rows, _stage(stages, "started", "g", "t", "id", "account"), both("g"))
    rows = left_join_on(rows, _stage(stages, "interactive", "h", "t", "id", "account"), both("h"))
    rows = left_join_on(rows, _stage(stages, "noninteractive", "m", "status", "id", "account"), both("m"))
    rows = left_join_on(rows, _stage(stages, "terminated", "n", "t", "id", "account", "code", "activity"), both("n"))
    return left_join_on(rows, _stage(stages, "disposed", "i", "t", "id", "queue"), {"i_id": "f_id"})


def invited_journeys(offers: DataFrame, marks: DataFrame, stages: DataFrame) -> DataFrame:
    """Invitations with their response, its form, their chat request and what came of it."""
    named = {"t": "c_t", "raw_session": "c_session", "client": "c_client"}
    rows = offers.select(*KEYS, "b_t", *[F.col(name).alias(alias) for name, alias in named.items()], "c_invite", "c_type")
    answers = marks.where("kind = 'answer'").select(*KEYS, F.col("t").alias("d_t"), F.col("client").alias("d_client"), "d_invite", "d_response", F.lit(True).alias("answered"))
    rows = left_join_on(rows, answers, {"app": "app", "tag": "tag", "session": "c_session", "d_invite": "c_invite"})
    # a form counts where its session has a response; that is no key, so rows are dealt by session once for both joins
    same = (F.col("e_app") == F.col("app")) & (F.col("e_tag") == F.col("tag")) & (F.col("e_session") == F.col("c_session"))
    forms = marks.where("kind = 'form'").select(*[F.col(name).alias(f"e_{name}") for name in KEYS], F.col("t").alias("e_t"))
    rows = rows.join(forms, same & F.col("answered"), "left").drop("e_app", "e_tag", "e_session", "answered")
    screens = marks.where("kind = 'screen'").select(*KEYS, "k_screen", "k_title", "t").repartition(*KEYS)
    screens = screens.groupBy(*KEYS, "k_screen", "k_title").agg(F.max("t").alias("k_t")).select(*KEYS, "k_t")
    rows = left_join_on(rows, screens, {"app": "app", "tag": "tag", "session": "c_session"})
    rows = rows.withColumn("owner", F.coalesce("d_client", "c_client"))
    requests = chats(stages).withColumn("f_owner", client_of_account(F.col("f_account")))
    rows = left_join_on(rows, requests, {"f_vi": "tag", "f_psid": "c_invite", "f_owner": "owner"})
    begun = _stage(stages, "initiated", "o", "t", "id", "vi", "psid", "queue", "account")
    begun = begun.select("o_t", "o_id", "o_vi", "o_psid", "o_queue", client_of_account(F.col("o_account")).alias("o_owner"))
    return left_join_on(rows, begun, {"o_vi": "tag", "o_psid": "c_invite", "o_owner": "owner"})


def cancelled_journeys(rows: DataFrame, stages: DataFrame) -> DataFrame:
    """Adds the cancellations of the request's interaction, or of the visitor's invitation."""
    cancelled = _stage(stages, "cancelled", "j", "t", "id", "account", "vi", "psid", "queue", "code")
    cancelled = cancelled.withColumn("j_owner", client_of_account(F.col("j_account")))
    return left_join_any(rows, cancelled, [{"j_id": "f_id", "j_account": "f_account"}, {"j_vi": "tag", "j_psid": "c_invite", "j_owner": "owner"}])


def _store(rows: DataFrame, path: str, by: str | None = None) -> DataFrame:
    writer = rows.write.partitionBy(by) if by else rows.write
    writer.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def journey_funnel(
    web: DataFrame,
    chat: DataFrame,
    horizon: int = HORIZON_MS,
    span: int = SPAN_MS,
    staging: str | None = None,
) -> DataFrame:
    """The funnel, 74 columns.

    What several branches need is stored once, in a ``staging`` folder on shared storage, a
    new one for each run (by default below ``spark.checkpoint.dir``): the events by kind,
    the placed marks, and the invitations with their requests. So web and chat events are
    read once, and a lost executor costs the work of one step.
    """
    folder = staging or scratch_path(web.sparkSession, "funnel")
    marks = _store(web_marks(web), f"{folder}/web", "kind")
    stages = _store(chat_stages(chat), f"{folder}/chat", "stage")
    placed = _store(placed_marks(marks, horizon, span), f"{folder}/placed")
    points = _store(placed_points(marks, placed), f"{folder}/points", "kind")
    invited = _store(invited_journeys(points.where("kind = 'offer'"), marks, stages), f"{folder}/requests")

    lead = [*KEYS, "b_t"]
    hot = marks.where("kind = 'hot'").select(*KEYS, F.col("t").alias("b_t"), F.col("client").alias("b_client"), "b_group", "b_rule", "b_eval", "b_reason")
    pages = marks.where("kind = 'page'").select(*KEYS, F.col("t").alias("a_t"), F.col("client").alias("a_client"), "a_url", "a_title", "a_path", "a_referrer", "a_os", "a_agent", "a_browser", "a_device")
    # dealt by what they are joined on, which also brings equal rows together
    hot, pages = hot.repartition(*lead).distinct(), pages.repartition(*KEYS, "a_t").distinct()
    seen = placed.where("is_hot").select(*[F.col(name).alias(f"p_{name}") for name in KEYS], F.col("t").alias("b_t"), F.explode("pages").alias("p_t"))
    on_page = pages.join(seen, [F.col(name) == F.col(f"p_{name}") for name in KEYS] + [F.col("a_t") == F.col("p_t")])
    on_page = on_page.drop("p_t", *[f"p_{name}" for name in KEYS])
    noticed = points.where("kind = 'notice'").select(*lead, "l_info")
    rows = attach(attach(attach(hot, on_page, lead), noticed, lead), cancelled_journeys(invited, stages), lead)
    return rows.select(*[column.alias(name) for name, column in funnel_columns().items()])


def funnel_columns() -> dict[str, Column]:
    """Output columns over the joined stage columns, in order.

    Their names are fixed values that readers of the view rely on.
    """
    c = F.col
    code = F.coalesce("j_code", "n_code")
    gap = F.coalesce("j_t", "n_t", "e_t", "d_t", F.lit(0)) - F.coalesce("d_t", "e_t", F.lit(0))
    not_requested = c("f_t").isNull()

    def or_null(*names: str) -> Column:
        return F.coalesce(*names, F.lit("NULL"))

    unique = F.concat_ws(
        ":", c("b_t").cast("string"), c("session"), F.coalesce("c_invite", F.lit("NONE")), F.coalesce("f_id", "o_id", F.lit("NONE"))
    )
    return {
        "uniqueRowId": F.when(c("b_t").isNotNull() & c("session").isNotNull(), unique),
        "journeyStartTime": c("b_t"),
        "pageLoadTimeEpochMillisUTC": c("a_t"),
        "visitorID": c("tag"),
        "visitorBrowserSessionId": c("session"),
        "clientID": c("app"),
        "pageLoadURL": c("a_url"),
        "pageTitle": c("a_title"),
        "hotleadTimeEpochMillisUTC": c("b_t"),
        "hotLeadEvalType": c("b_eval"),
        "hotLeadEvalFailureReason": or_null("b_reason"),
        "targetGroupID": c("b_group"),
        "ruleID": F.when(c("b_rule") == "null", "NULL").otherwise(or_null("b_rule")),
        **notice_flags(c("l_info"), "PriorInvite", c("c_t").isNull() & not_requested),
        "inviteShownTimeEpochMillisUTC": c("c_t"),
        "inviteID": or_null("c_invite"),
        "inviteType": or_null("c_type"),
        "inviteResponseTimeEpochMillisUTC": c("d_t"),
        "inviteResponseID": or_null("d_response"),
        **notice_flags(c("l_info"), "PostInviteResponse", c("d_t").isNotNull() & not_requested),
        "pcfShownTimeEpochMillisUTC": c("k_t"),
        "pcfSubmitTimeEpochMillisUTC": c("e_t"),
        **notice_flags(c("l_info"), "PostPCFSubmit", c("e_t").isNotNull() & not_requested),
        "chatRequestTimeEpochMillisUTC": c("f_t"),
        "interactionID": or_null("f_id", "o_id"),
        "chatStartedTimeEpochMillisUTC": c("g_t"),
        "chatInteractiveTimeEpochMillisUTC": c("h_t"),
        "chatDisposedQueueID": or_null("i_queue"),
        "chatDisposedTimeEpochMillisUTC": c("i_t"),
        "chatCancelledTimeEpochMillisUTC": c("j_t"),
        "chatCancelID": or_null("j_code", "n_code"),
        "chatCancelQueueID": or_null("j_queue"),
        **termination_flags(code, c("f_t"), c("g_t"), c("h_t")),
        # the source never reports a resolution
        "resolvedFlag": F.lit(0),
        "inScopeFlag": F.lit(0),
        **inactivity_flags(c("m_status")),
        "visitorActivityStatusAtDisconnect": or_null("n_activity"),
        **cancel_latency_flags(code, gap),
        "aivaChatFlag": flag(c("d_t").isNotNull() & (c("d_response") == "ACCEPTED") & c("o_t").isNull()),
        "chatTerminatedTimeEpochMillisUTC": c("n_t"),
        "chatInitiatedQueueID": c("o_queue"),
        "operatingSystem": c("a_os"),
        "userAgent": c("a_agent"),
        "browser": c("a_browser"),
        "deviceType": c("a_device"),
    }
