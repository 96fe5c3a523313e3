from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from tests.conftest import rows_of

from slotviews.errors import BuilderError, ReadError, SpecError
from slotviews.operators.slots import SLOT_COLUMNS, with_slot_columns
from slotviews.plans.specs import ColumnSpec, Import, Load, ViewSpec
from slotviews.plans.views import Workspace, import_window, source_of

KEY = "0123456789abcdef"
NOON = 1704110400000  # 2024-01-01 12:00
DAY = ("202401010000", "202401020000")
RAW = ViewSpec("Raw", "/raw/%s/events", "JSON", materialize=False)


@pytest.fixture
def space(spark, tmp_path):
    rows = spark.createDataFrame(
        [(1, "x", NOON), (2, "y", NOON + 60000), (2, "y", NOON + 60000), (3, "x", NOON + 3600000)], "id bigint, kind string, t bigint"
    )
    with_slot_columns(rows, "t").write.partitionBy(*SLOT_COLUMNS).json(f"{tmp_path}/raw/acme/events")
    return Workspace(spark, str(tmp_path), KEY)


def view(name, text, *imports, **fields):
    fields = {"uri": "/views", "fmt": "PARQUET", "materialize": False, **fields}
    return ViewSpec(name, imports=imports or (Import(RAW),), steps=((name, text),), **fields)


def test_raw_window_and_dedup(space):
    assert space.use(RAW, "acme", *DAY).df().count() == 4
    assert space.use(RAW, "acme", "202401011200", "202401011215").df().count() == 3
    assert space.use(RAW, "acme", "202401011300", "202401011300").df().count() == 1
    assert space.use(RAW, "acme", *DAY).df().columns == ["id", "kind", "t"]
    keyed = ViewSpec("Raw", "/raw/%s/events", "JSON", materialize=False, dedup_keys=("id",))
    assert space.use(keyed, "acme", *DAY).df().count() == 3
    with pytest.raises(ReadError, match="no input"):
        space.use(RAW, "acme", "202402010000", "202402020000").df()


def test_client_folders_and_static_load(space):
    spec = ViewSpec("Raw", "/raw/%s/events", "JSON", materialize=False, load=Load.STATIC, client_folders={"c1": "acme"})
    loaded = space.use(spec, "c1", "199901010000", "199901010000").df()
    assert loaded.count() == 4 and set(SLOT_COLUMNS) <= set(loaded.columns)


def test_steps_builders_and_their_failures(space):
    chain = ViewSpec(
        "Last", "/v", materialize=False, imports=(Import(RAW),), steps=(("First", "SELECT DISTINCT id FROM Raw"), ("Last", "SELECT id * 2 AS d FROM First"))
    )
    assert rows_of(space.use(chain, "acme", *DAY).df()) == [(2,), (4,), (6,)]
    built = ViewSpec(
        "B", "/v", materialize=False, imports=(Import(RAW),), params={"n": "7"}, builder=lambda s, spec: s.table("Raw").select(F.lit(int(spec.params["n"])))
    )
    assert space.use(built, "acme", *DAY).df().first()[0] == 7
    with pytest.raises(BuilderError):
        space.use(view("Bad", "SELECT nope FROM Raw"), "acme", *DAY).df()


def test_import_windows():
    start, end = datetime(2024, 1, 2), datetime(2024, 1, 3)
    assert import_window(Import(RAW), start, end) == (start, end)
    assert import_window(Import(RAW, start="202401010000"), start, end) == (datetime(2024, 1, 1), end)
    assert import_window(Import(RAW, end="202401021200"), start, end) == (start, datetime(2024, 1, 2, 12))
    week = Import(RAW, start_offset=timedelta(days=-7), end_offset=timedelta(days=-7))
    assert import_window(week, start, end) == (datetime(2023, 12, 26), datetime(2023, 12, 27))
    with pytest.raises(SpecError):
        import_window(Import(RAW, start="202401050000"), start, end)


def test_same_view_for_two_windows(space):
    early = Import(RAW, end="202401011300", alias="Early")
    both = view("Both", "SELECT (SELECT count(*) FROM Raw) AS a, (SELECT count(*) FROM Early) AS b", Import(RAW), early)
    assert tuple(space.use(both, "acme", *DAY).df().first()) == (4, 3)


@pytest.mark.parametrize(
    "imports, materialize, prefer, root, source",
    [
        (True, None, True, True, "built"),
        (True, None, True, False, "stored"),
        (True, True, True, False, "stored"),
        (True, False, True, False, "built"),
        (True, True, False, False, "built"),
        (False, None, True, True, "stored"),
        (False, False, True, False, "raw"),
        (False, None, False, False, "raw"),
    ],
)
def test_where_rows_come_from(imports, materialize, prefer, root, source):
    spec = ViewSpec("V", "/v", imports=(Import(RAW),) if imports else (), materialize=materialize)
    assert source_of(spec, prefer, root) == source


def test_stored_child_is_read_and_not_rebuilt(space):
    child = view(
        "Child",
        "SELECT id, concat('n', id) AS name, t FROM Raw",
        materialize=True,
        time_column="t",
        columns=(ColumnSpec("name", sensitive=True), ColumnSpec("id", sensitive=True, type="bigint")),
    )
    text = "SELECT id, name FROM Child"
    stored, rebuilt = (view("P", text, Import(child), prefer_materialized=p) for p in (True, False))
    with pytest.raises(ReadError, match="no slots"):
        space.use(stored, "acme", *DAY).df()
    assert len(space.use(child, "acme", *DAY).write()) == 2
    assert "name" not in [r.name for r in space.spark.read.parquet(f"{space.location(child)}/client=acme").collect()]
    expected = [(1, "n1"), (2, "n2"), (2, "n2"), (3, "n3")]
    assert rows_of(space.use(stored, "acme", *DAY).df()) == expected
    assert rows_of(space.use(rebuilt, "acme", *DAY).df()) == expected
    space.use(child, "acme", "202401011300", "202401011400").write()
    assert rows_of(space.use(stored, "acme", *DAY).df()) == expected
    assert len(space.input_paths) > 0


def test_three_levels_with_mixed_materialization(space):
    """A report over two counts: one is not stored and is expanded, one is read."""
    text = "SELECT count(DISTINCT id) AS chats, t FROM Raw GROUP BY t"
    c311 = view("C311", text, materialize=True, time_column="t")
    c312 = view("C312", text, materialize=True, time_column="t")
    c310 = view("C310", "SELECT chats, t FROM C312", Import(c312))
    report = view(
        "Report", "SELECT chats, t FROM C310 UNION SELECT chats, t FROM C311", Import(c310), Import(c311), prefer_materialized=True
    )
    for spec in (c311, c312):
        space.use(spec, "acme", *DAY).write()
    segment = space.use(report, "acme", *DAY)
    assert rows_of(segment.df()) == [(1, NOON), (1, NOON + 60000), (1, NOON + 3600000)]
    assert segment.schema().names == ["chats", "t"] and segment.window_ids == DAY
    assert not any("raw" in path for path in space.input_paths)


def test_spec_checks(space):
    with pytest.raises(SpecError, match="time column"):
        space.use(view("V", "SELECT 1", materialize=True), "acme", *DAY)
    with pytest.raises(SpecError, match="cannot be stored"):
        space.use(ViewSpec("V", "/v", materialize=True), "acme", *DAY)
    with pytest.raises(SpecError):
        space.use(RAW, "acme", "202401010007", "202401020000")
    loop = view("Loop", "SELECT 1")
    object.__setattr__(loop, "imports", (Import(loop),))
    with pytest.raises(SpecError, match="imports itself"):
        space.use(loop, "acme", *DAY).df()
    assert loop.dq_enabled is False and loop.load is Load.RELATIVE and ViewSpec("d", "/").stores
