import json
import os
from dataclasses import replace

import pytest
from pyspark.sql import functions as F
from tests.conftest import rows_of
from tests.test_views import DAY, KEY, RAW, space, view  # noqa: F401

from slotviews.errors import WriteError
from slotviews.operators.quality import Rule, RowTest, RuleSet, TestSet, latest_status, run_row_tests
from slotviews.plans.runs import Reports, run_view
from slotviews.plans.specs import ColumnSpec, Import

STORED = dict(materialize=True, time_column="t", dq_enabled=True, columns=(ColumnSpec("kind", sensitive=True),))


def rules(sql):
    return [RuleSet("ds", "ds", "SELECT * FROM Kinds", "id", (Rule("r", "rule", sql),))]


@pytest.fixture
def segment(space):  # noqa: F811
    return space.use(view("Kinds", "SELECT id, kind, t FROM Raw", **STORED), "acme", *DAY)


def status(spark, reports, job):
    return latest_status(spark, reports.status).where(F.col("JobId") == job).first()


def test_rules_see_the_rows_as_stored(spark, segment, tmp_path):
    reports = Reports.below(f"{tmp_path}/reports")
    done = run_view(segment, "j1", reports, rules("kind = 'x'"))
    assert (done.status, len(done.slots), status(spark, reports, "j1").ErrorCount) == ("FAIL", 2, 2)
    again = run_view(segment, "j1", reports, rules("kind = 'z'"))
    assert (again.status, status(spark, reports, "j1").DQStatus) == ("PASS", "PASS")
    records = [json.loads(r.value) for r in spark.read.parquet(reports.metrics).collect()]
    assert [r["body"]["viewName_keyword"] for r in records] == ["Kinds", "Kinds"] and all(r["body"]["dataPaths"] for r in records)


def test_a_check_that_cannot_run_does_not_fail_the_run(spark, segment, tmp_path):
    reports = Reports.below(f"{tmp_path}/reports")
    for job, sets in (("none", None), ("bad", rules("nope > 1"))):
        done = run_view(segment, job, reports, sets)
        assert done.status == status(spark, reports, job).DQStatus == "ERROR" and done.problem and done.slots
    assert segment.stored().count() == 4


def test_views_without_checks_or_without_slots(spark, space, tmp_path):  # noqa: F811
    reports = Reports.below(f"{tmp_path}/reports")
    plain = view("Kinds", "SELECT id, kind, t FROM Raw")
    assert run_view(space.use(plain, "acme", *DAY), "a", reports).status == "NA"
    checked = replace(plain, dq_enabled=True)
    done = run_view(space.use(checked, "acme", *DAY), "b", reports, rules("id > 2"))
    assert (done.slots, done.status) == ((), "FAIL")
    assert rows_of(latest_status(spark, reports.status).select("JobId", "DQStatus")) == [("a", "NA"), ("b", "FAIL")]


def test_a_failed_write_fails_the_run_and_is_recorded(spark, space, tmp_path):  # noqa: F811
    reports = Reports.below(f"{tmp_path}/reports")
    late = view("Kinds", "SELECT id, kind, t + 86400000 AS t FROM Raw", **STORED)
    with pytest.raises(WriteError):
        run_view(space.use(late, "acme", *DAY), "j", reports, rules("id > 2"))
    assert spark.read.parquet(reports.metrics).count() == 1


def test_row_tests_over_imports(spark, space):  # noqa: F811
    space.bring([Import(RAW), Import(view("Kinds", "SELECT DISTINCT kind FROM Raw"))], "acme", *DAY)
    sets = [TestSet("kinds", "SELECT kind FROM Kinds", (RowTest("short", "one letter", "length(kind) = 1", "kind"),))]
    rows = run_row_tests(spark, sets, "Kinds", "acme", *DAY)
    assert rows.count() == 2 and rows.where("NOT dqPass").count() == 0
    assert space.input_paths


def test_scratch_folders_can_be_cleared(spark, monkeypatch):
    from slotviews import session

    monkeypatch.setattr(session, "_given", [])  # those of other tests stay
    path = session.scratch_path(spark, "a")
    spark.range(3).write.parquet(path)
    session.scratch_path(spark, "unused")
    local = path.removeprefix("file://")
    assert os.path.exists(local) and session.clear_scratch(spark) == 1
    assert not os.path.exists(local) and session.clear_scratch(spark) == 0
