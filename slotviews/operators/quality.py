"""Data quality: violation rules, row tests, verdicts, and their reports."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field, replace
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slotviews.errors import ExportError, NoQualityDefinition, QualityError, SpecError
from slotviews.functions.scalars import view_sql, with_fields_resolved
from slotviews.operators.columns import quoted, require_columns, row_text
from slotviews.operators.dedup import latest_by
from slotviews.operators.limits import first_n_per_group
from slotviews.operators.slots import check_window

# fixed values: column names that readers of the reports rely on
VIOLATION_SCHEMA = (
    "jobId string, view_id string, client string, dq_data_set_id string, rule_id string, "
    "rule_name string, record_id string, data_segment_time_start string, "
    "data_segment_time_end string, evaluation_time string"
)
DETAIL_CAP = 100


@dataclass(frozen=True)
class Rule:
    """``sql`` is a predicate that is true for a *violating* row."""

    id: str
    name: str
    sql: str
    description: str = ""


@dataclass(frozen=True)
class Lookup:
    """A flag that rules can use: whether a row's key is among those of a query.

    ``keys`` maps columns of ``sql`` to expressions over the data set. With one key the flag
    is what ``expression IN (query)`` would be: true, false, or null where no key is equal
    and either the expression or some key is null, so ``NOT flag`` is ``NOT IN``. With
    several keys, or where ``nulls`` is false, it is what ``EXISTS`` would be: true where a
    row of the query equals them all, else false.
    """

    name: str
    sql: str
    keys: Mapping[str, str]
    nulls: bool = True


@dataclass(frozen=True)
class RuleSet:
    """Rules over one data set; ``record_id`` is any expression over its columns.

    ``lookups`` add flags that the rules' predicates can name.
    """

    id: str
    name: str
    sql: str
    record_id: str
    rules: tuple[Rule, ...] = ()
    description: str = ""
    level: str = ""
    lookups: tuple[Lookup, ...] = ()


@dataclass(frozen=True)
class Run:
    """The run a check belongs to."""

    job_id: str
    view: str
    client: str
    start: str
    end: str
    evaluated_at: str = field(
        default_factory=lambda: datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%S.%f")[:-3] + "Z"
    )

    @property
    def bounds(self) -> tuple[str, str]:
        first, last = check_window(self.start, self.end)
        return tuple(f"{moment:%Y-%m-%dT%H:%M:%S.000Z}" for moment in (first, last))


# --- rule checks ---------------------------------------------------------------


def has_subquery(spark: SparkSession, predicate: str) -> bool:
    """Whether the parsed predicate holds a query, whatever its names and literals say."""
    parsed = spark._jsparkSession.sessionState().sqlParser().parseExpression(predicate)
    return spark._jvm.org.apache.spark.sql.catalyst.expressions.SubqueryExpression.hasSubquery(parsed)


def with_lookups(df: DataFrame, lookups: Sequence[Lookup]) -> DataFrame:
    """Adds the flag of each lookup by a left join on its distinct keys.

    Rows keep their number, as keys are distinct. Whether a lookup has keys at all, and
    whether one of them is null, is one row, computed from the lookup alone.
    """
    for lookup in lookups:
        if lookup.name in df.columns:
            raise SpecError(f"lookup {lookup.name} has the name of a column")
        names = {key: f"__{lookup.name}_{i}" for i, key in enumerate(lookup.keys)}
        keys = df.sparkSession.sql(lookup.sql).select(*[F.col(key).alias(name) for key, name in names.items()]).distinct()
        present, same = F.lit(True), F.lit(True)
        for key, name in names.items():
            present = present & F.col(name).isNotNull()
            same = same & (F.expr(lookup.keys[key]) == F.col(name))
        flag = F.coalesce("__hit", F.lit(False))
        rows = df.join(keys.where(present).withColumn("__hit", F.lit(True)), same, "left")
        if lookup.nulls and len(names) == 1:
            (key, name), = names.items()
            some = keys.agg((F.count("*") > 0).alias("__some"), F.coalesce(F.bool_or(F.col(name).isNull()), F.lit(False)).alias("__null"))
            rows = rows.crossJoin(F.broadcast(some))  # one row
            unknown = F.col("__some") & (F.expr(lookup.keys[key]).isNull() | F.col("__null"))
            flag = F.when(F.col("__hit"), True).when(~unknown, False)
        df = rows.select(*[F.col(quoted(c)) for c in df.columns], flag.alias(lookup.name))
    return df


def violated_rules(df: DataFrame, rules: Sequence[Rule], record_id: str, lookups: Sequence[Lookup] = ()) -> DataFrame:
    """(rule_id, rule_name, record_id) per violation, all rules in one pass.

    A null predicate is no violation. A rule that asks another data set is best written
    with a lookup's flag, which costs a join on keys and no further pass. A rule with a
    subquery in its text cannot be evaluated in a projection and runs as a filter, with a
    scan, of its own.
    """
    df = with_lookups(df, lookups)
    rules = [replace(rule, sql=with_fields_resolved(rule.sql, df.where)) for rule in rules]
    record_id = with_fields_resolved(record_id, df.selectExpr)
    plain = [rule for rule in rules if not has_subquery(df.sparkSession, rule.sql)]
    branches = []
    if plain:
        # clean rows, usually most, go no further than the scan
        violating = F.lit(False)
        for rule in plain:
            violating = violating | F.expr(rule.sql)
        hits = F.array(
            *[F.when(F.expr(rule.sql), F.struct(F.lit(rule.id).alias("rule_id"), F.lit(rule.name).alias("rule_name"))) for rule in plain]
        )
        rows = df.where(violating).select(F.explode(hits).alias("hit"), F.expr(record_id).cast("string").alias("record_id"))
        branches.append(rows.where("hit IS NOT NULL"))
    for rule in rules:
        if rule not in plain:
            hit = F.struct(F.lit(rule.id).alias("rule_id"), F.lit(rule.name).alias("rule_name")).alias("hit")
            branches.append(df.where(rule.sql).select(hit, F.expr(record_id).cast("string").alias("record_id")))
    result = branches[0]
    for branch in branches[1:]:
        result = result.unionByName(branch)
    return result.select("hit.*", "record_id")


@dataclass(frozen=True)
class RuleResult:
    """Violations of a run (lazy) and what is derived from them."""

    frame: DataFrame
    rule_sets: tuple[RuleSet, ...]
    run: Run

    def error_count(self) -> int:
        return self.frame.count()

    def capped(self, n: int = DETAIL_CAP) -> DataFrame:
        """At most ``n`` violations per rule, by record id."""
        return capped_violations(self.frame, n)

    def summary(self) -> DataFrame:
        return violation_summary(self.frame, self.run)


def check_rules(spark: SparkSession, rule_sets: Sequence[RuleSet] | None, run: Run) -> RuleResult:
    """Evaluates rule sets over the views in scope; every violation is one row."""
    if rule_sets is None:
        raise NoQualityDefinition(f"no data quality is defined for {run.view}")
    found = None
    for rule_set in rule_sets:
        if not rule_set.rules:
            continue
        try:
            hits = violated_rules(view_sql(spark, rule_set.sql), rule_set.rules, rule_set.record_id, rule_set.lookups)
        except Exception as error:
            raise QualityError(f"cannot evaluate data set {rule_set.name}: {error}") from error
        hits = hits.withColumn("dq_data_set_id", F.lit(rule_set.id))
        found = hits if found is None else found.unionByName(hits)
    if found is None:
        return RuleResult(spark.createDataFrame([], VIOLATION_SCHEMA), tuple(rule_sets), run)
    start, end = run.bounds
    tagged = found.select(
        F.lit(run.job_id).alias("jobId"),
        F.lit(run.view).alias("view_id"),
        F.lit(run.client).alias("client"),
        "dq_data_set_id",
        "rule_id",
        "rule_name",
        "record_id",
        F.lit(start).alias("data_segment_time_start"),
        F.lit(end).alias("data_segment_time_end"),
        F.lit(run.evaluated_at).alias("evaluation_time"),
    )
    return RuleResult(tagged, tuple(rule_sets), run)


def capped_violations(violations: DataFrame, n: int = DETAIL_CAP) -> DataFrame:
    order = ["record_id", *[c for c in violations.columns if c not in ("rule_id", "record_id")]]
    return first_n_per_group(violations, ["rule_id"], order, n)


def violation_summary(violations: DataFrame, run: Run) -> DataFrame:
    """One row per run, also when nothing was violated."""
    start, end = run.bounds
    return violations.agg(F.count("*").alias("ErrorCount")).select(
        F.lit(run.job_id).alias("JobId"),
        F.lit(run.view).alias("View"),
        F.lit(run.client).alias("Client"),
        F.lit(start).alias("DataSegmentStart"),
        F.lit(end).alias("DataSegmentEnd"),
        "ErrorCount",
        F.when(F.col("ErrorCount") > 0, "FAIL").otherwise("PASS").alias("DQStatus"),
        F.lit(run.evaluated_at).alias("DQEvaluationTime"),
    )


@contextmanager
def open_files(spark: SparkSession, n: int) -> Iterator[None]:
    """Lets tasks write ``n`` folders of a partitioned write at once, without a sort by folder."""
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name, None)
    spark.conf.set(name, n + 1)  # at its limit a task goes over to sorting
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def export_report(result: RuleResult, location: str, index_path: str, summary_path: str, n: int = DETAIL_CAP) -> DataFrame:
    """Stores all violations, the capped sample and the summary; returns the summary.

    The rules run once, into JSON below ``location/<job id>`` by data set and rule.
    Sample and summary are computed from what was written, not from the view again.
    A task holds one open file per rule and no rows: Spark would sort them by rule first,
    and as most columns are the same in all rows, a few shuffled megabytes are gigabytes.
    """
    run = result.run
    detail = f"{location}/client={run.client}/{run.job_id}"
    spark = result.frame.sparkSession
    try:
        # a few files per rule instead of one per rule and task; a hot rule is split
        parts = ("dq_data_set_id", "rule_id")
        with open_files(spark, sum(len(rule_set.rules) for rule_set in result.rule_sets)):
            result.frame.hint("rebalance", *parts).write.mode("overwrite").partitionBy(*parts).json(detail)
        stored = spark.read.schema(VIOLATION_SCHEMA).json(detail)
        # by job, so that a rerun replaces its sample
        capped_violations(stored, n).write.mode("overwrite").parquet(f"{index_path}/job={run.job_id}")
        append_status(violation_summary(stored, run), summary_path)
    except Exception as error:
        raise ExportError(f"cannot store the quality report of {run.view}: {error}") from error
    return latest_status(spark, summary_path).where(F.col("JobId") == run.job_id)


# --- run status ----------------------------------------------------------------

STATUSES = ("In progress", "ERROR", "NA", "PASS", "FAIL")
# fixed values: column names of the stored summary
SUMMARY_SCHEMA = (
    "JobId string, View string, Client string, DataSegmentStart string, DataSegmentEnd string, "
    "ErrorCount bigint, DQStatus string, DQEvaluationTime string, updated_at timestamp"
)


def append_status(rows: DataFrame, path: str) -> None:
    rows.withColumn("updated_at", F.current_timestamp()).write.mode("append").parquet(path)


def set_status(spark: SparkSession, path: str, job_id: str, status: str) -> None:
    if status not in STATUSES:
        raise SpecError(f"unknown status {status!r}")
    append_status(spark.createDataFrame([(job_id, status)], "JobId string, DQStatus string"), path)


def latest_status(spark: SparkSession, path: str) -> DataFrame:
    """The newest row per job: what an upsert by job id would hold."""
    rows = spark.read.schema(SUMMARY_SCHEMA).parquet(path)
    return latest_by(rows, ["JobId"], ["updated_at"])


# --- row tests -----------------------------------------------------------------


@dataclass(frozen=True)
class RowTest:
    """A test every row should pass; ``passes`` and ``message`` are SQL expressions."""

    name: str
    description: str
    passes: str
    message: str


@dataclass(frozen=True)
class TestSet:
    __test__ = False  # not a pytest class

    name: str
    sql: str
    tests: tuple[RowTest, ...]


@dataclass(frozen=True)
class Metric:
    """A monitored metric: dimensions and measures of a query."""

    name: str
    sql: str
    dims: tuple[str, ...]
    measures: tuple[str, ...]


def all_passed(tests: Column) -> Column:
    return F.forall(tests, lambda test: test["pass"])


def test_rows(df: DataFrame, test_set: TestSet) -> DataFrame:
    """Adds rowData, the result struct and dqPass to every row."""
    said = lambda text: F.expr(with_fields_resolved(text, df.selectExpr))
    outcomes = F.array(
        *[
            F.struct(
                F.lit(test_set.name).alias("testDateSetName"),
                F.lit(test.name).alias("testName"),
                F.lit(test.description).alias("testDesc"),
                F.coalesce(said(test.passes), F.lit(False)).alias("pass"),
                said(test.message).cast("string").alias("description"),
            )
            for test in test_set.tests
        ]
    )
    checked = df.withColumns({"rowData": row_text(df.columns), "__tests": outcomes})
    checked = checked.withColumn("dqPass", all_passed(F.col("__tests")))
    result = F.struct(F.col("dqPass"), F.col("__tests").alias("tests"))
    return checked.withColumn("result", result).drop("__tests")


test_rows.__test__ = False

# fixed values: column names of row-test results
ROW_RESULT_SCHEMA = (
    "table string, client string, testDataSet string, testDataSetSQL string, startTime date, endTime date, "
    "rowData string, result struct<dqPass: boolean, tests: array<struct<testDateSetName: string, testName: string, "
    "testDesc: string, pass: boolean, description: string>>>, dqPass boolean"
)


def run_row_tests(spark: SparkSession, test_sets: Sequence[TestSet], table: str, client: str, start: str, end: str) -> DataFrame:
    """Every row of every test set with its outcome.

    Each set's rows are also registered as the view ``DQResult_<table>_<set>``. The
    views the queries name must be in scope; ``Workspace.bring`` puts them there.
    """
    first, last = check_window(start, end)
    found = None
    for test_set in test_sets:
        rows = test_rows(view_sql(spark, test_set.sql), test_set)
        rows = rows.withColumns(
            {
                "testDataSet": F.lit(test_set.name),
                "testDataSetSQL": F.lit(test_set.sql),
                "startTime": F.lit(first.date()),
                "endTime": F.lit(last.date()),
                "client": F.lit(client),
                "table": F.lit(table),
            }
        )
        rows.createOrReplaceTempView(f"DQResult_{table}_{test_set.name}")
        rows = rows.select(
            "table", "client", "testDataSet", "testDataSetSQL", "startTime", "endTime", "rowData", "result", "dqPass"
        )
        found = rows if found is None else found.unionByName(rows)
    return spark.createDataFrame([], ROW_RESULT_SCHEMA) if found is None else found


def verdicts(results: DataFrame, **tags) -> DataFrame:
    """Whether all rows of a (client, data set) passed; tags become columns."""
    passed = results.groupBy("client", "testDataSet").agg(F.bool_and("dqPass").alias("dqResult"))
    return passed.withColumns({name: F.lit(value) for name, value in tags.items()})


def metric_frame(spark: SparkSession, metric: Metric) -> DataFrame:
    rows = view_sql(spark, metric.sql)
    names = [*metric.dims, *metric.measures]
    require_columns(rows, names, f"metric {metric.name}")
    return rows.select(*names)
