"""Flag columns of the chat journey: termination stage by cause, latency, notices."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Termination codes by cause.
CAUSES = {
    "UserEnded": ("VISITOR_LEAVE",),
    "UserUnavailable": ("VISITOR_UNAVAILABLE",),
    "UserUnreachableAgentEnded": ("VISITOR_NON_RESPONSIVE_AUTO_TERMINATED",),
    "AgentLost": ("OWNER_UNREACHABLE", "OWNER_ABRUPT_LOGOUT", "OWNER_TIMEDOUT", "OWNER_LEFT"),
    "PlatformFailure": (
        "ALLOCATION_TIMEOUT",
        "ALLOCATION_FAILURE",
        "VISITOR_INVITE_REJECTED",
        "VISITOR_INVITE_FAILURE",
        "VISITOR_COLLAB_FAILURE",
        "OWNER_INVITE_FAILURE",
        "OWNER_COLLAB_FAILURE",
        "ADDRESS_BOOK_FAILURE",
        "COLLABORATION_SERVER_FAILURE",
        "INTERACTION_STATE_ERROR",
        "INTERACTION_LIFECYCLE_ERROR",
        "CACHE_FAILURE",
        "SYSTEM_FAILURE",
        "UNCLASSIFIED_FAILURE",
        "MONITORING_RECONCILE",
    ),
    "QueueTimeOut": ("QUEUE_TIMEOUT",),
    "QueueFull": ("QUEUE_FULL",),
}

# The causes reported for each stage, in output order.
STAGE_CAUSES = {
    "preQueued": ("UserEnded", "UserUnavailable", "QueueFull", "PlatformFailure"),
    "preConnected": (
        "UserEnded",
        "UserUnavailable",
        "UserUnreachableAgentEnded",
        "AgentLost",
        "PlatformFailure",
        "QueueTimeOut",
    ),
    "preInteractive": ("UserEnded", "UserUnavailable", "AgentLost", "PlatformFailure"),
    "postInteractive": (
        "UserEnded",
        "UserUnavailable",
        "UserUnreachableAgentEnded",
        "AgentLost",
        "PlatformFailure",
        "QueueTimeOut",
        "QueueFull",
    ),
}

# Latency buckets in milliseconds, both ends inclusive.
CANCEL_BUCKETS = {
    "accpetToCancel1to5SecFlag": (None, 5000),
    "accpetToCancel6to10SecFlag": (5001, 10000),
    "accpetToCancel11to15SecFlag": (10001, 15000),
    "accpetToCancel16to30SecFlag": (15001, 30000),
    "accpetToCancelMoreThan30SecFlag": (30001, None),
}

# Inactivity flag by participant status.
INACTIVITY = {
    "agentVisitorInactiveFlag": "NON_INTERACTIVE",
    "agentInactiveFlag": "AGENT_NON_INTERACTIVE",
    "visitorInactiveFlag": "VISITOR_NON_INTERACTIVE",
}


def flag(test: Column) -> Column:
    """1 where the test holds, 0 where it does not or is null."""
    return F.when(test, 1).otherwise(0)


def termination_flags(code: Column, requested: Column, started: Column, interactive: Column) -> dict[str, Column]:
    """``<stage><cause>Flag`` columns from a code and three stage times.

    The stage is the last one the chat reached. A full queue before queueing counts
    whether or not a request was recorded.
    """
    before_start = interactive.isNull() & started.isNull()
    stages = {
        "preQueued": before_start & requested.isNull(),
        "preConnected": before_start & requested.isNotNull(),
        "preInteractive": interactive.isNull() & started.isNotNull(),
        "postInteractive": interactive.isNotNull(),
    }
    flags = {}
    for stage, causes in STAGE_CAUSES.items():
        for cause in causes:
            reached = before_start if (stage, cause) == ("preQueued", "QueueFull") else stages[stage]
            flags[f"{stage}{cause}Flag"] = flag(reached & code.isin(*CAUSES[cause]))
    return flags


def cancel_latency_flags(code: Column, gap_ms: Column) -> dict[str, Column]:
    """Time from acceptance to a cancellation by the visitor, in buckets."""
    left = code.isin(*CAUSES["UserEnded"], *CAUSES["UserUnavailable"])
    flags = {}
    for name, (low, high) in CANCEL_BUCKETS.items():
        inside = F.lit(True)
        if low is not None:
            inside = inside & (gap_ms >= low)
        if high is not None:
            inside = inside & (gap_ms <= high)
        flags[name] = flag(left & inside)
    return flags


def inactivity_flags(status: Column) -> dict[str, Column]:
    return {name: flag(status == value) for name, value in INACTIVITY.items()}


def notice_flags(info: Column, suffix: str, reached: Column) -> dict[str, Column]:
    """After-hours and capacity notices shown at one point of the journey."""
    text = F.lower(info)
    return {
        f"queueAfterHours{suffix}Flag": flag(reached & text.like("%queueafterhours%")),
        f"caCheckFail{suffix}Flag": flag(reached & text.like("%cacheckfail%")),
    }
