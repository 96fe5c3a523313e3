from datetime import datetime

import pytest
from pyspark.sql import functions as F

from slotviews.errors import SpecError
from slotviews.operators import slots
from slotviews.operators.slots import Granularity

TIMES = ["1622704805000", "1622704805000", "1622806260000", "1622807410000", "1622804699000", "1622804699000"]


def test_slot_columns_of_text_times(spark):
    df = spark.createDataFrame([(t,) for t in TIMES + ["x", None, "-1"]], "at_ms string")
    rows = slots.with_slot_columns(df, "at_ms").collect()
    assert [tuple(row)[1:] for row in rows] == [
        (2021, "06", "03", "07", "15"),
        (2021, "06", "03", "07", "15"),
        (2021, "06", "04", "11", "30"),
        (2021, "06", "04", "11", "45"),
        (2021, "06", "04", "11", "00"),
        (2021, "06", "04", "11", "00"),
        (None,) * 5,
        (None,) * 5,
        (1969, "12", "31", "23", "45"),
    ]


def test_slot_columns_ignore_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        df = slots.with_slot_columns(spark.createDataFrame([(1622704805000,)], "t bigint"), "t")
        assert tuple(df.first())[1:] == (2021, "06", "03", "07", "15")
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_hourly_folders_glob_over_quarters():
    folders = slots.window_folders("202305070000", "202305080000", Granularity.HOUR)
    assert len(folders) == 24
    assert folders[0] == "year=2023/month=05/day=07/hour=00/min=*"
    assert folders[-1] == "year=2023/month=05/day=07/hour=23/min=*"


def test_quarter_folders():
    folders = slots.window_folders("202305070030", "202305080015")
    assert len(folders) == 95
    assert folders[0] == "year=2023/month=05/day=07/hour=00/min=30"
    assert folders[-1] == "year=2023/month=05/day=08/hour=00/min=00"


def test_empty_window_still_has_its_start():
    assert slots.window_steps("202305070030", "202305070030") == [datetime(2023, 5, 7, 0, 30)]


def test_day_buckets_cover_every_day_touched():
    pattern = "<yyyy-mm-dd>/*/*"
    assert slots.day_bucket_folders(pattern, "202302270000", "202303010000") == ["2023-02-27/*/*", "2023-02-28/*/*"]
    assert slots.day_bucket_folders(pattern, "202302271200", "202303010600") == [
        "2023-02-27/*/*",
        "2023-02-28/*/*",
        "2023-03-01/*/*",
    ]


@pytest.mark.parametrize("bad", ["20230507", "202305070007", "201713100000", None, "20230507000x"])
def test_bad_slot_ids(bad):
    with pytest.raises(SpecError):
        slots.parse_slot(bad)


def test_window_must_not_be_reversed():
    with pytest.raises(SpecError):
        slots.check_window("202305080000", "202305070000")


@pytest.mark.parametrize(
    "start, end",
    [("202401010000", "202401020000"), ("202312311530", "202401010145"), ("202401010100", "202401010100"), ("202401010015", "202401010230")],
)
def test_range_predicate_equals_time_comparison(spark, start, end):
    first, last = (slots.epoch_ms(slots.parse_slot(s)) for s in (start, end))
    rows = spark.range(first - 20 * slots.SLOT_MS, last + 20 * slots.SLOT_MS, slots.SLOT_MS).withColumnRenamed("id", "t")
    rows = slots.with_slot_columns(rows, "t")
    found = {row.t for row in rows.where(slots.in_window(start, end)).collect()}
    assert found == set(range(first, max(last, first + 1), slots.SLOT_MS))  # the start slot is always in


def test_slot_frame_matches_steps(spark):
    for granularity in (Granularity.FIFTEEN_MIN, Granularity.HOUR, Granularity.DAY):
        frame = slots.slot_frame(spark, "202401010000", "202401030000", granularity)
        steps = [slots.epoch_ms(s) for s in slots.window_steps("202401010000", "202401030000", granularity)]
        assert sorted(row.slot_ms for row in frame.collect()) == steps
    assert slots.slot_frame(spark, "202401010000", "202401010000").count() == 1


def test_timestamp_to_ms_truncates(spark):
    df = spark.sql("select timestamp_ntz'2024-01-01 00:00:07.179575' as ts")
    assert df.select(slots.timestamp_to_ms("ts")).first()[0] == 1704067207179
    assert df.select(slots.slot_start(F.lit(1704067207179))).first()[0] == 1704067200000
