import os

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from tests.conftest import plan_of, rows_of

from slotviews.errors import ExportError, NoQualityDefinition, QualityError, SpecError
from slotviews.operators.limits import first_n_per_group
from slotviews.operators.quality import (
    VIOLATION_SCHEMA,
    Lookup,
    Metric,
    Rule,
    RuleSet,
    RowTest,
    Run,
    TestSet,
    check_rules,
    export_report,
    has_subquery,
    latest_status,
    metric_frame,
    run_row_tests,
    set_status,
    verdicts,
    violated_rules,
)

RUN = Run("job", "V", "acme", "202401010000", "202401020015")


@pytest.fixture
def visits(spark):
    rows = [(1, "ONLINE", 5), (2, "WEB", None), (3, None, 50), (4, "SPEECH", 60)]
    df = spark.createDataFrame(rows, "id int, channel string, n int")
    df.createOrReplaceTempView("visits")
    return df


def rules(*pairs):
    return RuleSet("ds", "data", "SELECT * FROM visits", "id", tuple(Rule(f"r{i}", name, sql) for i, (name, sql) in enumerate(pairs)))


def test_every_violation_is_a_row(spark, visits):
    found = check_rules(spark, [rules(("it's big", "n > 40"), ("channel", "channel IN ('SPEECH')"), ("known", "id IN (SELECT 1)"))], RUN)
    rows = found.frame.select("rule_id", "rule_name", "record_id")
    assert rows_of(rows) == [("r0", "it's big", "3"), ("r0", "it's big", "4"), ("r1", "channel", "4"), ("r2", "known", "1")]
    assert found.error_count() == 4
    row = found.frame.first()
    assert (row.jobId, row.view_id, row.client, row.dq_data_set_id) == ("job", "V", "acme", "ds")
    assert (row.data_segment_time_start, row.data_segment_time_end) == ("2024-01-01T00:00:00.000Z", "2024-01-02T00:15:00.000Z")


def test_plain_rules_share_one_scan(spark, tmp_path, visits):
    visits.write.parquet(f"{tmp_path}/v")
    spark.read.parquet(f"{tmp_path}/v").createOrReplaceTempView("visits")
    plan = plan_of(check_rules(spark, [rules(("a", "n > 1"), ("b", "n > 2"), ("c", "channel IS NULL"))], RUN).frame)
    assert plan.count("FileScan") == 1 and "Exchange" not in plan


def test_null_predicates_and_no_violations(spark, visits):
    clean = check_rules(spark, [rules(("null", "n <> n"), ("none", "id < 0"))], RUN)
    assert clean.error_count() == 0
    summary = clean.summary().first()
    assert (summary.DQStatus, summary.ErrorCount, summary.JobId) == ("PASS", 0, "job")
    for definition in ([], [RuleSet("e", "e", "SELECT 1", "1")]):
        empty = check_rules(spark, definition, RUN)
        assert [(f.name, f.dataType) for f in empty.frame.schema] == [(f.name, f.dataType) for f in StructType.fromDDL(VIOLATION_SCHEMA)]
        assert empty.summary().first().DQStatus == "PASS"


def test_bad_definitions(spark, visits):
    with pytest.raises(NoQualityDefinition):
        check_rules(spark, None, RUN)
    with pytest.raises(QualityError):
        check_rules(spark, [rules(("bad", "nope > 1"))], RUN)


def test_report(spark, tmp_path, visits):
    found = check_rules(spark, [rules(("all", "id > 0"), ("big", "n > 40"))], RUN)
    place = str(tmp_path)
    set_status(spark, f"{place}/s", "other", "NA")
    set_status(spark, f"{place}/s", "job", "In progress")
    assert latest_status(spark, f"{place}/s").where("JobId = 'job'").first().DQStatus == "In progress"
    summary = export_report(found, f"{place}/d", f"{place}/i", f"{place}/s", n=3)
    assert [(r.ErrorCount, r.DQStatus) for r in summary.collect()] == [(6, "FAIL")]
    assert rows_of(latest_status(spark, f"{place}/s").select("JobId", "DQStatus")) == [("job", "FAIL"), ("other", "NA")]
    capped = spark.read.parquet(f"{place}/i")
    assert rows_of(capped.select("rule_id", "record_id")) == [("r0", "1"), ("r0", "2"), ("r0", "3"), ("r1", "3"), ("r1", "4")]
    assert sorted(d for d in os.listdir(f"{place}/d/client=acme/job/dq_data_set_id=ds") if "=" in d) == ["rule_id=r0", "rule_id=r1"]
    with pytest.raises(SpecError):
        set_status(spark, f"{place}/s", "job", "Maybe")


def test_row_tests_and_verdicts(spark, visits):
    channel = RowTest("Channel", "known channel", "channel IN ('ONLINE', 'WEB')", "concat('found : ', channel)")
    big = RowTest("Big", "big", "n >= 5", "concat('n is ', n)")
    sets = [TestSet("all", "SELECT * FROM visits", (channel, big)), TestSet("ids", "SELECT id FROM visits", (RowTest("Id", "", "id > 0", "''"),))]
    rows = run_row_tests(spark, sets, "T", "acme", "202401010000", "202401020000")
    assert rows.columns == ["table", "client", "testDataSet", "testDataSetSQL", "startTime", "endTime", "rowData", "result", "dqPass"]
    first = {r.rowData: r for r in rows.where("testDataSet = 'all'").collect()}
    assert first["1|ONLINE|5"].dqPass and not first["2|WEB|null"].dqPass and not first["3|null|50"].dqPass
    tests = first["4|SPEECH|60"].result.tests
    assert [(t.testName, t["pass"], t.description) for t in tests] == [("Channel", False, "found : SPEECH"), ("Big", True, "n is 60")]
    assert spark.table("DQResult_T_ids").count() == 4
    assert rows_of(verdicts(rows, hr="07")) == [("acme", "all", False, "07"), ("acme", "ids", True, "07")]
    assert run_row_tests(spark, [], "T", "acme", *["202401010000"] * 2).columns == rows.columns


def test_metric(spark, visits):
    metric = Metric("m", "SELECT channel, count(*) AS cnt, 1 AS extra FROM visits GROUP BY channel", ("channel",), ("cnt",))
    assert metric_frame(spark, metric).columns == ["channel", "cnt"]
    with pytest.raises(SpecError):
        metric_frame(spark, Metric("m", "SELECT 1 AS a", ("a",), ("b",)))


def test_rules_plan_without_forced_broadcasts(spark, visits):
    spark.createDataFrame([(1,), (3,)], "known int").createOrReplaceTempView("known_ids")
    found = violated_rules(
        spark.table("visits"),
        [Rule("a", "unknown", "NOT EXISTS (SELECT 1 FROM known_ids WHERE known = id)"), Rule("b", "word", "channel = 'select'"), Rule("c", "big", "n > 40")],
        "id",
    )
    assert [has_subquery(spark, sql) for sql in ("a = 'select'", "a IN (SELECT 1)", "a > (select max(b) from t)", "`select` > 1")] == [False, True, True, False]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        assert rows_of(found.select("rule_id", "record_id")) == [("a", "2"), ("a", "4"), ("c", "3"), ("c", "4")]
        assert "Broadcast" not in plan_of(found.select("rule_id"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_lookups_keep_the_meaning_of_in_and_exists(spark, tmp_path):
    keys = [1, 2, 3, None, 5]
    spark.createDataFrame([(i, k, "ab"[i % 2]) for i, k in enumerate(keys)], "id int, k int, c string").write.parquet(f"{tmp_path}/d")
    data = spark.read.parquet(f"{tmp_path}/d")
    data.createOrReplaceTempView("data_rows")
    lists = {"plain": [1, 3, 3], "nulls": [2, None], "none": [], "only_null": [None]}
    for name, values in lists.items():
        spark.createDataFrame([(v, "a") for v in values], "y int, z string").createOrReplaceTempView(f"list_{name}")
    for name in lists:
        found = violated_rules(data, [Rule("in", "", "hit"), Rule("not", "", "NOT hit"), Rule("null", "", "hit IS NULL")], "id", [Lookup("hit", f"SELECT * FROM list_{name}", {"y": "k"})])
        where = {"in": f"k IN (SELECT y FROM list_{name})", "not": f"k NOT IN (SELECT y FROM list_{name})"}
        want = [(rule, str(r.id)) for rule, test in where.items() for r in spark.sql(f"SELECT id FROM data_rows WHERE {test}").collect()]
        decided = {i for _, i in want}
        want += [("null", str(i)) for i in range(len(keys)) if str(i) not in decided]
        assert rows_of(found.select("rule_id", "record_id")) == sorted(want), name
    pair = Lookup("pair", "SELECT * FROM list_plain", {"y": "k", "z": "c"})
    exists = Lookup("some", "SELECT * FROM list_nulls", {"y": "k"}, nulls=False)
    known = Lookup("known", "SELECT * FROM list_plain", {"y": "k + 0"})
    found = violated_rules(data, [Rule("pair", "", "NOT pair"), Rule("some", "", "NOT some"), Rule("known", "", "NOT known AND id > 0")], "id", [pair, exists, known])
    assert rows_of(found.select("rule_id", "record_id")) == [("known", "1"), ("known", "4"), ("pair", "1"), ("pair", "3"), ("pair", "4"), ("some", "0"), ("some", "2"), ("some", "3"), ("some", "4")]
    assert plan_of(found).count("FileScan") == 1
    with pytest.raises(SpecError):
        violated_rules(data, [Rule("a", "", "id")], "id", [Lookup("id", "SELECT 1 AS y", {"y": "k"})])


def test_a_task_sends_no_more_than_the_cap(spark):
    rows = spark.range(0, 4000, 1, 8).selectExpr("id % 2 AS rule", "id")
    first = first_n_per_group(rows, ["rule"], ["id"], 5)
    assert rows_of(first) == sorted((i % 2, i) for i in range(10))
    assert "WindowGroupLimit" in plan_of(first)
    salted = rows.selectExpr("rule", "spark_partition_id() % 64 AS part").distinct().groupBy("part").count()
    assert salted.count() == 8  # one part for each task


def test_a_rerun_replaces_its_sample(spark, tmp_path, visits):
    found, place = check_rules(spark, [rules(("all", "id > 0"))], RUN), str(tmp_path)
    for _ in range(2):
        export_report(found, f"{place}/d", f"{place}/i", f"{place}/s", n=3)
    assert spark.read.parquet(f"{place}/i").count() == 3


def test_a_report_is_written_without_a_sort(spark, tmp_path, visits, monkeypatch):
    """The plan of a partitioned write at the moment of the report's; the session's setting comes back."""
    sets = [RuleSet(name, "data", "SELECT * FROM visits", "id", (Rule("a", "", "id > 0"), Rule("b", "", "n > 40"))) for name in ("x", "y")]
    found, place, seen, write = check_rules(spark, sets, RUN), str(tmp_path), [], DataFrameWriter.json
    limit = "spark.sql.maxConcurrentOutputFileWriters"

    def watched(writer, path, *args, **options):
        plan = spark.sql("EXPLAIN INSERT INTO report_parts SELECT 'v', CAST(id AS STRING), channel FROM visits").first()[0]
        seen.append(("WriteFiles" in plan, "Sort" in plan, int(spark.conf.get(limit, "0"))))
        return write(writer, path, *args, **options)

    spark.sql(f"CREATE TABLE report_parts (v string, a string, b string) USING json PARTITIONED BY (a, b) LOCATION '{place}/t'")
    monkeypatch.setattr(DataFrameWriter, "json", watched)
    try:
        for before in (None, "1"):
            if before:
                spark.conf.set(limit, before)
            export_report(found, f"{place}/d", f"{place}/i", f"{place}/s")
            assert spark.conf.get(limit, None) == before
        with pytest.raises(ExportError):
            export_report(found, f"{place}/s/_SUCCESS/d", f"{place}/i", f"{place}/s")
        assert spark.conf.get(limit, None) == "1"
    finally:
        spark.conf.unset(limit)
        spark.sql("DROP TABLE report_parts")
    assert seen == [(True, False, 5)] * 3  # at its limit a task would sort
    stored = spark.read.json(f"{place}/d/client=acme/job").select("dq_data_set_id", "rule_id", F.col("record_id").cast("int"))
    assert rows_of(stored) == [(name, rule, i) for name in "xy" for rule, ids in (("a", (1, 2, 3, 4)), ("b", (3, 4))) for i in ids]
