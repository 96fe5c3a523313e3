"""One run of a view: store it, check it, report on it, record it."""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass

from slotviews.operators.quality import RuleSet, Run, check_rules, export_report, set_status
from slotviews.operators.slots import epoch_ms
from slotviews.plans.views import Segment
from slotviews.sources.metrics import append_metrics, run_metrics


@dataclass(frozen=True)
class Reports:
    """Folders that a run adds to: rule hits, their sample, statuses, run records."""

    detail: str
    sample: str
    status: str
    metrics: str

    @classmethod
    def below(cls, root: str) -> "Reports":
        return cls(*(f"{root.rstrip('/')}/{name}" for name in ("detail", "sample", "status", "metrics")))


@dataclass(frozen=True)
class Outcome:
    """``status`` is PASS, FAIL, ERROR or NA; ``problem`` says what went wrong with a check."""

    slots: tuple[str, ...]
    status: str
    problem: str = ""


def run_view(
    segment: Segment,
    job_id: str,
    reports: Reports,
    rule_sets: Sequence[RuleSet] | None = None,
    outside: str = "error",
    evaluated_at: str | None = None,
    source: str = "slotviews",
) -> Outcome:
    """Runs a segment's view once.

    A view that is stored is written first, and rules see the rows as stored, under the
    view's name; otherwise they see the view. A view without checks has status NA. A
    check that fails to run, also for want of rules, gives ERROR and does not fail the
    run; a view that cannot be written does. Either way the run leaves its record.
    """
    spec, spark = segment.spec, segment.workspace.spark
    slots: list[str] = []
    paths: list[str] = []
    try:
        rows = segment.df()
        paths = list(segment.workspace.input_paths)
        if spec.stores:
            slots = segment.write(outside)
        if not spec.dq_enabled:
            set_status(spark, reports.status, job_id, "NA")
            return Outcome(tuple(slots), "NA")
        set_status(spark, reports.status, job_id, "In progress")
        try:
            if slots:
                rows = segment.stored()
            rows.createOrReplaceTempView(spec.name)
            timed = {"evaluated_at": evaluated_at} if evaluated_at else {}
            run = Run(job_id, spec.name, segment.client, *segment.window_ids, **timed)
            summary = export_report(check_rules(spark, rule_sets, run), reports.detail, reports.sample, reports.status)
            return Outcome(tuple(slots), summary.first()["DQStatus"])
        except Exception as error:
            set_status(spark, reports.status, job_id, "ERROR")
            return Outcome(tuple(slots), "ERROR", str(error))
    finally:
        now = int(time.time() * 1000)
        record = run_metrics(spark, job_id, source, spec.name, segment.client, epoch_ms(segment.start), now, paths)
        append_metrics(record, reports.metrics)
