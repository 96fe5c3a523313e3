from pyspark.sql import functions as F

from slotviews.operators import voice

UUID = "00000000-1234-11ea-8000-000000000000"


def record(spark, *attributes):
    df = spark.createDataFrame([(list(attributes),)], f"attributes {voice.ATTRIBUTES_TYPE}")
    return voice.call_records(df)


def test_defaults(spark):
    rows = record(spark)
    assert rows.columns == [name for name, _, _ in voice.CALL_COLUMNS] and len(rows.columns) == 34
    row = rows.first()
    assert (row.uuid, row.dnis, row.cpn, row.key) == ("UUID", "DNIS", "ANI", "KEY")
    assert (row.logLabel, row.logMessage, row.call_type, row.devlog_size, row.transportModeId) == ("LOGLABEL", "", "", "", "")
    assert row.callStartTime is None and row.unix_timestamp == "0.000000"


def test_attributes(spark):
    row = record(
        spark,
        ("uuid", UUID, 1),
        ("dnis", "1", 1),
        ("dnis", "2", 2),
        ("transport_mode", "gateway", 1),
        ("log.label", "a:b:c", 5),
        ("LOG.LABEL", "other", 1500000),
        ("termination", "ok", 1),
    ).first()
    assert (row.dnis, row.transportModeId, row.endStatusCode) == ("2", "3", "ok")
    assert (row.logLabel, row.logMessage, row.unix_timestamp) == ("a:b", "c", "1.500000")
    assert row.callStartTime == 1574982513582


def test_uuid_times(spark):
    df = spark.createDataFrame([(UUID,), ("short",), (None,), ("ffffffff-ffff-ffff-8000-000000000000",)], "u string")
    assert [r[0] for r in df.select(voice.uuid_time_ms(F.col("u"))).collect()] == [1574982513582.08, None, None, None]


def test_modes(spark):
    names = [*voice.TRANSPORT_MODES, "carrier pigeon", None]
    df = spark.createDataFrame([(n,) for n in names], "m string")
    assert [r[0] for r in df.select(voice.transport_mode_id(F.col("m"))).collect()] == ["1", "2", "3", "4", "5", "6", "", ""]


def test_labels(spark):
    df = spark.createDataFrame([("a:b:c",), ("plain",), (":x",), ("x:",)], "l string")
    rows = df.select(*voice.split_label(F.col("l"))).collect()
    assert [tuple(r) for r in rows] == [("a:b", "c"), ("plain", ""), ("", "x"), ("x", "")]


def test_attribute_values(spark):
    df = spark.createDataFrame([([("A", "1", 0), ("b", "2", 0), ("a", "3", 0)],)], f"attributes {voice.ATTRIBUTES_TYPE}")
    values = voice.attribute_values(F.col("attributes"), "a")
    by_name = voice.attribute_values_by_name(F.col("attributes"), ["B", "a", "zz"])
    assert tuple(df.select(values, by_name).first()) == (["1", "3"], {"a": ["1", "3"], "b": ["2"]})


def test_frame_header(spark):
    host = b"host-1\x00"
    frame = (
        bytes([4])
        + (53).to_bytes(4, "big")
        + (-2).to_bytes(2, "big", signed=True)
        + (7).to_bytes(2, "big")
        + (2**63 + 5).to_bytes(8, "big")
        + (1704067200000000).to_bytes(8, "big")
        + (2**32 - 1).to_bytes(4, "big")
        + bytes(range(16))
        + bytes([len(host)])
        + host
        + b"body"
    )
    df = spark.createDataFrame([(bytearray(frame),)], "frame binary")
    h = df.select(voice.frame_header(F.col("frame")).alias("h")).first().h
    assert (h.version, h.size, h.log_class, h.log_name, h.event_id) == (4, 53, -2, 7, 2**32 - 1)
    assert (int(h.written), int(h.created)) == (2**63 + 5, 1704067200000000)
    assert (h.uuid, h.host_size, h.host) == ("00010203-0405-0607-0809-0a0b0c0d0e0f", 7, "host-1")
    empty = spark.createDataFrame([(bytearray(frame[:45] + b"\x00"),)], "frame binary")
    assert empty.select(voice.frame_header(F.col("frame")).alias("h")).first().h.host == ""
