import json

import pytest
from pyspark.sql import functions as F
from tests.conftest import rows_of

from slotviews.errors import ReadError, SpecError
from slotviews.functions.crypto import decrypt, encrypt
from slotviews.functions.scalars import register_functions
from slotviews.session import SETTINGS
from slotviews.sources.metrics import RUN_SCHEMA, append_metrics, run_metrics
from slotviews.sources.readers import encrypted_payloads, inferred_schema, json_records, merge_schemas, reader_of, schema_of_sample, sequence_frames, sequence_values
from slotviews.sources.sequence_files import vint

KEY = "0123456789abcdef"


@pytest.fixture
def sequence(spark, tmp_path):
    records = [{"id": 1, "context": {"vi": "v1"}}, {"id": 2, "extra": "e"}]
    path = f"{tmp_path}/sequence"
    spark.sparkContext.parallelize([("k", json.dumps(r)) for r in records], 2).saveAsSequenceFile(path)
    return path


SEED = json.dumps({"id": 0, "context": {"vi": "", "psid": ""}, "eventType": "dummy"})


@pytest.mark.parametrize("codec", [None, "DefaultCodec", "GzipCodec", "BZip2Codec"])
@pytest.mark.parametrize("kind", ["RECORD", "BLOCK"])
def test_sequence_files_split_at_sync_marks(spark, tmp_path, codec, kind):
    texts = ["", "é 漢字 🙂", "x" * 30_000] + [f"line {i} " + "y" * (i % 700) for i in range(1500)]
    path = f"{tmp_path}/s"
    if codec and kind == "RECORD":  # Spark's own call always makes blocks
        pairs = spark.sparkContext.parallelize([(str(i), t) for i, t in enumerate(texts)], 1)
        options = {"mapreduce.output.fileoutputformat.outputdir": path, "mapreduce.output.fileoutputformat.compress": "true", "mapreduce.output.fileoutputformat.compress.codec": f"org.apache.hadoop.io.compress.{codec}", "mapreduce.output.fileoutputformat.compress.type": "RECORD", "mapreduce.job.outputformat.class": "org.apache.hadoop.mapreduce.lib.output.SequenceFileOutputFormat", "mapreduce.job.output.key.class": "org.apache.hadoop.io.Text", "mapreduce.job.output.value.class": "org.apache.hadoop.io.Text"}
        pairs.saveAsNewAPIHadoopDataset(options)
    else:
        spark.sparkContext.parallelize([(str(i), t) for i, t in enumerate(texts)], 1).saveAsSequenceFile(path, codec and f"org.apache.hadoop.io.compress.{codec}")
    whole = sequence_values(spark, [path])
    assert sorted(r.value for r in whole.collect()) == sorted(texts)
    for size in (999, 20_000, 150_000):
        rows = sequence_values(spark, [f"{tmp_path}/*"], split_bytes=str(size))
        assert sorted(r.value for r in rows.collect()) == sorted(texts)
    if not codec:
        used = sequence_values(spark, [path], split_bytes="100000").selectExpr("spark_partition_id() AS p").distinct().count()
        assert used > 2
    assert "RDD" not in whole._jdf.queryExecution().optimizedPlan().toString()


def test_sequence_files_of_bytes_and_wrong_files(spark, tmp_path):
    frames = [bytes([i % 256]) * (i % 50) for i in range(300)]
    spark.sparkContext.parallelize([("k", bytearray(f)) for f in frames], 3).saveAsSequenceFile(f"{tmp_path}/b")
    rows = sequence_frames(spark, [f"{tmp_path}/b"], split_bytes="500")
    assert sorted(bytes(r.frame) for r in rows.collect()) == sorted(frames)
    with pytest.raises(ReadError):
        sequence_frames(spark, [f"{tmp_path}/none"])
    spark.createDataFrame([("no sequence",)], "value string").write.text(f"{tmp_path}/t")
    with pytest.raises(Exception, match="not a SequenceFile"):
        sequence_values(spark, [f"{tmp_path}/t"]).collect()


@pytest.mark.parametrize("number, data", [(0, b"\x00"), (127, b"\x7f"), (-112, b"\x90"), (128, b"\x8f\x80"), (-113, b"\x87\x70"), (65536, b"\x8d\x01\x00\x00")])
def test_numbers_of_variable_length(number, data):
    assert vint(b"x" + data + b"y", 1) == (number, 1 + len(data))


def test_seed_adds_fields_but_no_row(spark, sequence):
    for fmt in ("SEQ_JSON", "ASSIST_INTERACTIONS_V2"):
        rows = reader_of(fmt)(spark, [sequence], {"seed": SEED})
        assert set(rows.columns) == {"id", "context", "extra", "eventType"}
        assert set(rows.schema["context"].dataType.names) == {"vi", "psid"}
        assert rows_of(rows.select("id", "context.vi", "extra")) == [(1, "v1", None), (2, None, "e")]


def test_fixed_schema(spark, sequence):
    rows = reader_of("ACTIVE_SHARE")(spark, [sequence, sequence], {"schema": "id bigint, other string"})
    assert sorted(r.id for r in rows.collect()) == [1, 1, 2, 2] and rows.columns == ["id", "other"]
    assert reader_of("ACTIVE_SHARE")(spark, [sequence], {"seed": SEED}).columns == ["context", "eventType", "id"]
    with pytest.raises(SpecError):
        reader_of("ACTIVE_SHARE")(spark, [sequence], {})


@pytest.mark.parametrize("fmt", ["ASSIST_INTERACTIONS", "ASSIST_AGENTSTATS"])
def test_encrypted_lines_in_sequence_files(spark, tmp_path, fmt):
    plain = spark.createDataFrame([('{"id": 1}',), ('{"id": 2, "note": "- a -b"}',)], "j string")
    lines = plain.select(F.concat(F.lit("[2024-01-01 00:00:00,000] - "), encrypt(F.col("j"), KEY))).collect()
    spark.sparkContext.parallelize([("k", row[0]) for row in lines], 1).saveAsSequenceFile(f"{tmp_path}/s")
    rows = reader_of(fmt)(spark, [f"{tmp_path}/s"], {"key": KEY, "seed": SEED})
    assert rows_of(rows.select("id", "note")) == [(1, None), (2, "- a -b")]
    assert "eventType" in rows.columns


def test_encrypted_xml(spark, tmp_path):
    xml = "<chat><id>7</id><line who='a'>hi &amp; bye</line><line who='b'>ok</line></chat>"
    spark.createDataFrame([(xml,)], "x string").select(F.concat(F.lit("p - "), encrypt(F.col("x"), KEY))).write.text(f"{tmp_path}/x")
    schema = "id bigint, line array<struct<_VALUE: string, _who: string>>"
    conf = {"container": "text", "key": KEY, "schema": schema, "root": "chat"}
    row = reader_of("ASSIST_TRANSCRIPTS")(spark, [f"{tmp_path}/x"], conf).first()
    assert row.chat.id == 7 and [(line._who, line._VALUE) for line in row.chat.line] == [("a", "hi & bye"), ("b", "ok")]
    with pytest.raises(SpecError):
        reader_of("ASSIST_TRANSCRIPTS")(spark, [f"{tmp_path}/x"], {"container": "text", "key": KEY})


RECORDS = [
    ['{"a":1,"b":null,"c":[],"d":{},"e":1.0,"f":1e2,"g":12345678901234567890,"a b":1,"x`y":2,"p>q":3,"OBJECT":{"z":1}}'],
    ['{"a":1}', '{"a":1.5}', '{"a":"x"}'], ['{"a":1}', '{"a":1.5}'], ['{"a":12345678901234567890}', '{"a":5}'], ['{"a":12345678901234567890}', '{"a":1e3}'],
    ['{"a":[1,"x"]}', '{"a":{"k":1}}'], ['{"a":[{"k":1},{"k":2.5,"l":true}]}', '{"a":null}'], ['{"a":{}}', '{"a":{"b":[{}]}}', '{"c":0.1234567890123456789012345678901234567890}'],
    ['{"t":"2024-01-01"}', '{"Q":1,"r":"x"}'], [], ['{"1a":1,"\u00fc":2,"a.b":1,"select":1,"":4}', "", "  "], ['{"`OBJECT<":1,"n":[[1],[null,2.5]]}'],
]


@pytest.mark.parametrize("records", RECORDS)
def test_schema_is_that_of_json_inference(spark, tmp_path, records):
    lines = spark.createDataFrame([(r,) for r in records], "value string")
    lines.write.text(f"{tmp_path}/j")
    want = spark.read.option("mode", "FAILFAST").json(f"{tmp_path}/j").schema
    assert inferred_schema(lines).simpleString() == want.simpleString()


def test_inference_of_broken_records(spark):
    lines = spark.createDataFrame([('{"a": 1}',), ("{broken",), (None,)], "value string")
    with pytest.raises(Exception, match="MALFORMED|broken"):
        inferred_schema(lines)
    assert inferred_schema(lines, "PERMISSIVE").simpleString() == "struct<a:bigint,_corrupt_record:string>"
    rows = json_records(lines, {"mode": "PERMISSIVE"}).collect()
    assert sorted((r.a or 0, r._corrupt_record or "") for r in rows) == [(0, ""), (0, "{broken"), (1, "")]
    with pytest.raises(ReadError):
        inferred_schema(spark.createDataFrame([("[1]",)], "value string"))
    plan = lines.select(F.schema_of_variant_agg(F.try_parse_json("value")))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan


def test_rare_fields_and_broken_records_survive_or_raise(spark, tmp_path):
    records = [json.dumps({"id": i}) for i in range(500)] + [json.dumps({"id": 500, "rare": "x"})]
    lines = spark.createDataFrame([(r,) for r in records], "value string")
    assert json_records(lines, {}).where("rare = 'x'").count() == 1
    for broken in ("{not json", '{"id": "text"}'):
        bad = spark.createDataFrame([('{"id": 1}',), (broken,)], "value string")
        with pytest.raises(Exception):
            json_records(bad, {"schema": "id bigint"}).collect()
    assert json_records(bad, {"schema": "id bigint", "mode": "PERMISSIVE"}).count() == 2
    with pytest.raises(Exception, match="payload"):
        encrypted_payloads(spark.createDataFrame([("no separator",)], "value string"), KEY).collect()
    assert encrypted_payloads(spark.createDataFrame([(None,)], "value string"), KEY).first()[0] is None


def test_no_plan_shows_the_key(spark):
    spark.conf.set("spark.sql.redaction.string.regex", SETTINGS["spark.sql.redaction.string.regex"])
    try:
        register_functions(spark, KEY)
        df = spark.range(3).selectExpr("encrypt(cast(id as string)) AS c").select(decrypt(F.col("c"), KEY).alias("p"), "c")
        for mode in ("simple", "extended", "formatted"):
            text = spark.sparkContext._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)
            assert KEY not in text and KEY.encode().hex() not in text.lower() and "redacted" in text
        assert rows_of(df.select("p")) == [("0",), ("1",), ("2",)]
    finally:
        spark.conf.unset("spark.sql.redaction.string.regex")


def test_binary_frames(spark, tmp_path):
    spark.sparkContext.parallelize([("k", bytearray(b"\x04\x00\x01"))]).saveAsSequenceFile(f"{tmp_path}/b")
    assert bytes(reader_of("SESSIONIZED_BINLOG")(spark, [f"{tmp_path}/b"], {}).first().frame) == b"\x04\x00\x01"


def test_plain_formats(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "n int, s string")
    df.write.json(f"{tmp_path}/j"), df.write.orc(f"{tmp_path}/o"), df.write.parquet(f"{tmp_path}/p")
    df.write.option("header", True).option("delimiter", ";").csv(f"{tmp_path}/c")
    assert rows_of(reader_of("json")(spark, [f"{tmp_path}/j"], {})) == [(1, "a"), (2, "b")]
    assert reader_of("JSON")(spark, [f"{tmp_path}/j"], {"schema": "s string"}).columns == ["s"]
    assert rows_of(reader_of("CSV")(spark, [f"{tmp_path}/c"], {"delimiter": ";"})) == [("1", "a"), ("2", "b")]
    for fmt, part in (("ORC", "o"), ("PARQUET", "p")):
        assert rows_of(reader_of(fmt)(spark, [f"{tmp_path}/{part}"], {})) == [(1, "a"), (2, "b")]
    with pytest.raises(ReadError):
        reader_of("TSV")


def test_avro_where_its_package_is_present(spark, tmp_path):
    df = spark.createDataFrame([(1, "a")], "n int, s string")
    try:
        df.write.format("avro").save(f"{tmp_path}/a")
    except Exception:
        pytest.skip("no avro package on the class path")
    schema = '{"type":"record","name":"r","fields":[{"name":"s","type":["string","null"]}]}'
    assert rows_of(reader_of("AVRO")(spark, [f"{tmp_path}/a"], {"avro_schema": schema})) == [("a",)]


def test_schema_merge(spark):
    merged = merge_schemas(schema_of_sample(spark, '{"a": 1, "b": {"c": "x"}}'), schema_of_sample(spark, '{"a": "t", "b": {"d": 1}, "e": [1]}'))
    assert merged.simpleString() == "struct<a:bigint,b:struct<c:string,d:bigint>,e:array<bigint>>"


def test_run_metrics(spark, tmp_path):
    record = run_metrics(spark, "run-1", "metrics", "View", "acme", 1704067200000, 1704067300000, ["/a", "/b"])
    row = record.first()
    assert row.key == "run-1" and json.loads(row.value)["body"] == {
        "viewName_keyword": "View",
        "clientName_keyword": "acme",
        "nominal_time": 1704067200000,
        "processingExecution_time": "1704067300000",
        "dataPaths": ["/a", "/b"],
    }
    append_metrics(record, f"{tmp_path}/m"), append_metrics(record, f"{tmp_path}/m")
    stored = spark.read.parquet(f"{tmp_path}/m").select(F.from_json("value", RUN_SCHEMA).alias("m"))
    assert [r.m.eventTime for r in stored.collect()] == [1704067300000] * 2
