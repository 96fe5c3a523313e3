import os

import pytest
from pyspark.sql import functions as F
from tests.conftest import plan_of, rows_of

from slotviews.errors import ReadError, SpecError, WriteError
from slotviews.sources.files import Files
from slotviews.sources.slot_table import (
    covering_folders,
    read_slots,
    read_window,
    slots_to_write,
    stored_format,
    stored_slots,
    table_location,
    write_slots,
)

ROWS = [
    ("north", "acc-7", "1622704805000", "a"),
    ("north", "acc-7", "1622704805000", "b"),
    ("north", "acc-7", "1622806260000", "c"),
    ("north", "acc-7", "1622807410000", "d"),
    ("north", "acc-7", "1622804699000", "e"),
    ("north", "acc-7", "1622804699000", "f"),
]
WINDOW = ("202106030000", "202106050000")
SCHEMA = "account string, at_ms string, note string"


@pytest.fixture
def rows(spark):
    return spark.createDataFrame(ROWS, "client string, account string, at_ms string, note string")


def markers(location):
    return sorted(os.path.relpath(root, location) for root, _, files in os.walk(location) if "_SUCCESS" in files)


@pytest.mark.parametrize("fmt", ["json", "csv", "parquet", "orc"])
def test_round_trip(spark, rows, tmp_path, fmt):
    location = str(tmp_path)
    written = write_slots(rows, location, "at_ms", "north", fmt, *WINDOW)
    assert written == [
        "year=2021/month=06/day=03/hour=07/min=15",
        "year=2021/month=06/day=04/hour=11/min=00",
        "year=2021/month=06/day=04/hour=11/min=30",
        "year=2021/month=06/day=04/hour=11/min=45",
    ]
    assert markers(location) == [f"client=north/{slot}" for slot in written]
    back = read_slots(spark, location, "north", fmt, *WINDOW)
    assert rows_of(back.select("account", "at_ms", "note")) == sorted(row[1:] for row in ROWS)
    full = read_slots(spark, location, "north", fmt, *WINDOW, schema=SCHEMA, partition_columns=True)
    assert {(r.client, r.month, r.day, r.hour, r.min) for r in full.where("note = 'a'").collect()} == {("north", "06", "03", "07", "15")}
    assert not os.path.exists(f"{location}/_staging") or os.listdir(f"{location}/_staging") == []


def test_odd_names_nulls_and_missing_client(spark, tmp_path):
    df = spark.createDataFrame([("x", None, 1622704805000, None)], "`place id` string, `place (full)` string, `time ms` bigint, n int")
    write_slots(df, str(tmp_path), "time ms", "007", "parquet", *WINDOW)
    stored = spark.read.parquet(f"{tmp_path}/client=007/year=2021/month=06/day=03/hour=07/min=15")
    assert stored.columns == ["place+id", "place+%28full%29", "time+ms", "n"]
    back = read_slots(spark, str(tmp_path), "007", "parquet", *WINDOW, partition_columns=True)
    assert back.columns[:4] == ["place id", "place (full)", "time ms", "n"]
    assert tuple(back.first())[:4] == ("x", "", 1622704805000, None)
    assert back.first().client == "007"


def test_replacing_a_window_removes_slots_without_rows(spark, rows, tmp_path):
    location = str(tmp_path)
    write_slots(rows, location, "at_ms", "north", "parquet", *WINDOW)
    fewer = rows.where("note = 'c'").withColumn("note", F.lit("new"))
    write_slots(fewer, location, "at_ms", "north", "parquet", "202106041100", "202106041200")
    back = read_slots(spark, location, "north", "parquet", *WINDOW)
    assert sorted(r.note for r in back.collect()) == ["a", "b", "new"]
    assert len(markers(location)) == 2


def test_an_empty_result_clears_the_window(spark, rows, tmp_path):
    write_slots(rows, str(tmp_path), "at_ms", "north", "parquet", *WINDOW)
    write_slots(rows.where("false"), str(tmp_path), "at_ms", "north", "parquet", *WINDOW)
    with pytest.raises(ReadError, match="no slots"):
        read_slots(spark, str(tmp_path), "north", "parquet", *WINDOW)


def test_rows_outside_the_window(spark, rows, tmp_path):
    day = ("202106030000", "202106040000")
    with pytest.raises(WriteError, match="outside"):
        write_slots(rows, f"{tmp_path}/e", "at_ms", "north", "parquet", *day)
    assert markers(f"{tmp_path}/e") == []
    write_slots(rows, f"{tmp_path}/d", "at_ms", "north", "parquet", *day, outside="drop")
    assert read_slots(spark, f"{tmp_path}/d", "north", "parquet", *WINDOW).count() == 2
    for expected in (6, 10):
        write_slots(rows, f"{tmp_path}/a", "at_ms", "north", "parquet", *day, outside="append")
        assert read_slots(spark, f"{tmp_path}/a", "north", "parquet", *WINDOW).count() == expected
    with pytest.raises(SpecError):
        write_slots(rows, f"{tmp_path}/x", "at_ms", "north", "parquet", *day, outside="maybe")


def test_refused_rows(spark, rows, tmp_path):
    with pytest.raises(WriteError, match="other clients"):
        write_slots(rows, str(tmp_path), "at_ms", "south", "parquet", *WINDOW)
    with pytest.raises(WriteError, match="valid time"):
        write_slots(rows.withColumn("at_ms", F.lit("soon")), str(tmp_path), "at_ms", "north", "parquet", *WINDOW)
    with pytest.raises(WriteError, match="no time column"):
        write_slots(rows, str(tmp_path), "when", "north", "parquet", *WINDOW)


def test_incomplete_and_missing_slots(spark, rows, tmp_path):
    location = str(tmp_path)
    slots = write_slots(rows, location, "at_ms", "north", "parquet", *WINDOW)
    with pytest.raises(ReadError, match="missing"):
        read_slots(spark, location, "north", "parquet", *WINDOW, require_all=True)
    os.remove(f"{location}/client=north/{slots[0]}/_SUCCESS")
    with pytest.raises(ReadError, match="not complete"):
        read_slots(spark, location, "north", "parquet", *WINDOW)
    later = ("202106040000", "202106050000")
    assert read_slots(spark, location, "north", "parquet", *later).count() == 4


def test_window_read_prunes_partitions(spark, rows, tmp_path):
    write_slots(rows, str(tmp_path), "at_ms", "north", "parquet", *WINDOW)
    part = read_window(spark, str(tmp_path), "parquet", "north", "202106041100", "202106041145")
    assert sorted(r.note for r in part.collect()) == ["c", "e", "f"]
    # a predicate on partition columns only leaves no filter above the scan
    assert "Filter" not in plan_of(part).split("FileScan")[0]
    assert len(part.select(F.input_file_name()).distinct().collect()) == 2


def test_a_big_slot_is_written_in_several_files(spark, tmp_path):
    rows = spark.range(400000).select(
        F.when(F.col("id") % 3 == 0, F.lit(1622704805000)).otherwise(1622704805000 + F.col("id") * 100).alias("t"),
        F.sha2(F.col("id").cast("string"), 512).alias("text"),
    )
    saved = {}
    changes = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "2MB", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1MB"}
    for name, value in changes.items():
        saved[name] = spark.conf.get(name, None)
        spark.conf.set(name, value)
    try:
        write_slots(rows, str(tmp_path), "t", "c", "parquet", "202106030715", "202106040000", outside="append")
    finally:
        for name, value in saved.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
    hot = os.listdir(f"{tmp_path}/client=c/year=2021/month=06/day=03/hour=07/min=15")
    assert sum(name.endswith(".parquet") for name in hot) > 1
    assert read_window(spark, str(tmp_path), "parquet", "c", "202106030000", "202106060000").count() == 400000


def test_covering_folders():
    day = [f"year=2024/month=01/day=01/hour={h:02}/min={m:02}" for h in range(24) for m in (0, 15, 30, 45)]
    found = ["year=2024/month=01/day=01/hour=03/min=15", "year=2024/month=01/day=01/hour=05/min=00"]
    assert covering_folders(found, "202401010000", "202401020000") == ["year=2024/month=01/day=01"]
    assert covering_folders(found, "202401010300", "202401010515") == ["year=2024/month=01/day=01/hour=03", found[1]]
    assert covering_folders(day, "202401010000", "202401020000") == ["year=2024/month=01/day=01"]


def test_names(spark, rows):
    assert table_location("/root/", "/views/x/", "V") == "/root/views/x/view=V"
    assert [stored_format(f) for f in ("PARQUET", "avro", "SEQ_JSON", "csv")] == ["parquet", "json", "json", "csv"]
    assert slots_to_write(rows, "at_ms").count() == 4


TEXTS = ["two\nlines", 'a "quoted" one', "back\\slash", " spaces around ", "comma, and; more", "\r\nreturn", "tab\there", "# first", '"', "é 漢字", "\\\"mix\\\n\"", "\rend"]


@pytest.mark.parametrize("fmt", ["json", "csv", "parquet", "orc"])
def test_any_text_comes_back(spark, tmp_path, fmt):
    rows = spark.createDataFrame([(i, 1622704805000 + i * 600000, text) for i, text in enumerate(TEXTS)], "id bigint, at bigint, note string")
    write_slots(rows, str(tmp_path), "at", "c", fmt, *WINDOW)
    back = read_slots(spark, str(tmp_path), "c", fmt, *WINDOW, schema="id bigint, at bigint, note string")
    assert {r.id: r.note for r in back.collect()} == dict(enumerate(TEXTS))
    again = read_window(spark, str(tmp_path), fmt, "c", *WINDOW, schema="id bigint, at bigint, note string")
    assert {r.id: r.note for r in again.collect()} == dict(enumerate(TEXTS))


def test_a_window_without_length_is_its_slot(spark, rows, tmp_path):
    slot = ("202106030715", "202106030715")
    write_slots(rows, str(tmp_path), "at_ms", "north", "parquet", *slot, outside="drop")
    assert sorted(r.note for r in read_slots(spark, str(tmp_path), "north", "parquet", *slot).collect()) == ["a", "b"]
    write_slots(rows, str(tmp_path), "at_ms", "north", "parquet", *slot, outside="drop")
    assert read_window(spark, str(tmp_path), "parquet", "north", *slot).count() == 2


@pytest.mark.parametrize("outside", ["error", "drop", "append"])
@pytest.mark.parametrize("bad", [None, "soon"])
def test_rows_without_a_time_are_never_dropped(spark, rows, tmp_path, outside, bad):
    more = rows.unionByName(spark.createDataFrame([("north", "acc-7", bad, "g")], rows.schema))
    with pytest.raises(WriteError, match="valid time"):
        write_slots(more, str(tmp_path), "at_ms", "north", "parquet", *WINDOW, outside=outside)
    assert markers(str(tmp_path)) == []


def test_slots_that_are_appended_to_lose_their_marker_first(spark, rows, tmp_path, monkeypatch):
    location, day = str(tmp_path), ("202106030000", "202106040000")
    write_slots(rows, location, "at_ms", "north", "parquet", *day, outside="append")
    complete = markers(location)
    monkeypatch.setattr(Files, "rename", lambda *_: False)
    with pytest.raises(WriteError, match="cannot move"):
        write_slots(rows, location, "at_ms", "north", "parquet", *day, outside="append")
    assert len(complete) == 4 and markers(location) == []


def test_stored_slots_as_rows(spark, rows, tmp_path):
    write_slots(rows, str(tmp_path), "at_ms", "north", "parquet", *WINDOW)
    found = stored_slots(spark, str(tmp_path), "parquet", "north", "202106040000", "202106050000")
    assert rows_of(found) == [(2021, "06", "04", "11", m) for m in ("00", "30", "45")]


def test_moves_are_whole_folders_where_nothing_stays(spark, tmp_path, monkeypatch):
    moved = []
    rename = Files.rename
    monkeypatch.setattr(Files, "rename", lambda self, a, b: moved.append(b.split("client=c/")[1]) or rename(self, a, b))
    start = 1622678400000  # 2021-06-03 00:00
    rows = spark.range(0, 400).selectExpr(f"{start} + id * 900000 AS at", "id")
    write_slots(rows, str(tmp_path), "at", "c", "parquet", "202106030000", "202106080000")
    assert sorted(moved) == [f"year=2021/month=06/day=0{d}" for d in range(3, 8)]
    moved.clear()
    write_slots(rows.where("id < 100"), str(tmp_path), "at", "c", "parquet", "202106030000", "202106040130", outside="drop")
    assert sorted(moved) == ["year=2021/month=06/day=03", "year=2021/month=06/day=04/hour=00"]
    assert read_slots(spark, str(tmp_path), "c", "parquet", "202106030000", "202106080000").count() == 398
    with pytest.raises(ReadError, match="missing"):
        read_slots(spark, str(tmp_path), "c", "parquet", "202106040000", "202106040130", require_all=True)
    assert read_slots(spark, str(tmp_path), "c", "parquet", "202106040130", "202106080000").count() == 400 - 102


STEPS = ("mkdirs", "touch", "delete", "rename")


def test_a_write_that_breaks_anywhere_is_never_read(spark, tmp_path, monkeypatch):
    """The second write of a window is killed at every file-system call in turn."""
    frame = lambda texts: spark.createDataFrame([(1622704805000 + i * 900_000, t) for i, t in enumerate(texts)], "at bigint, note string")
    window, schema = ("202106030700", "202106030900"), "at bigint, note string"
    old, new = ["a", "b", "c"], ["x", None, "z"]
    real, calls = {name: getattr(Files, name) for name in STEPS}, []

    def killed(name, at):
        def call(self, *args):
            calls.append(name)
            if len(calls) > at and "_staging" not in args[0]:
                raise KeyboardInterrupt
            return real[name](self, *args)

        return call

    at, finished = 0, False
    while not finished:
        location = f"{tmp_path}/{at}"
        write_slots(frame(old), location, "at", "c", "parquet", *window)
        calls.clear()
        with monkeypatch.context() as patch:
            for name in STEPS:
                patch.setattr(Files, name, killed(name, at))
            try:
                write_slots(frame(new).where("note IS NOT NULL"), location, "at", "c", "parquet", *window)
                finished = True
            except KeyboardInterrupt:
                pass
        try:
            notes = sorted(r.note for r in read_slots(spark, location, "c", "parquet", *window, schema=schema).collect())
            assert notes in (old, ["x", "z"]), (at, calls)
        except ReadError as error:
            assert "not complete" in str(error)
            with pytest.raises(ReadError):
                read_window(spark, location, "parquet", "c", *window, schema=schema)
            # other windows can be read, and a rerun repairs this one
            write_slots(frame(["later"]).selectExpr("at + 86400000 AS at", "note"), location, "at", "c", "parquet", "202106040700", "202106040900")
            assert read_slots(spark, location, "c", "parquet", "202106040700", "202106040900").count() == 1
            write_slots(frame(["x", "z"]), location, "at", "c", "parquet", *window)
            assert sorted(r.note for r in read_slots(spark, location, "c", "parquet", *window, schema=schema).collect()) == ["x", "z"]
        at += 3 if at > 6 else 1
    assert at > 6
