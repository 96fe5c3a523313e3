import base64
import glob
import gzip
import hashlib

import pytest
from helpers import table_rows
from pyspark.sql import functions as F

from slotviews.llm import warc

PAGES = "page_id bigint, url string, html string, offset string, file string, digest string"


def expected(rows, least=0):
    out = []
    for page, _, html in rows:
        payload = (html or "").encode()
        same = [p for p, _, h in rows if (h or "").encode() == payload and p is not None]
        first = max(same, default=None)
        revisit = len(payload) >= least and first is not None and (page is None or page < first)
        out.append((page, len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode(), "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=str)


def written(spark, rows, **options):
    return warc.write_archives(spark.createDataFrame([(*r, "x", "y", "z") for r in rows], PAGES), **options)


def found(df):
    return sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in df.collect()), key=str)


ODD = [(1, "http://a/ b\n", "<p>é</p>"), (2, None, None), (3, "u", ""), (4, "u", "<p>é</p>"), (5, "u", "\r\n\r\nx: y\r\n\r\n"), (5, "u", "other"), (None, "u", "<p>é</p>"), (None, None, "alone"), (6, "u", "x" * 300_000), (7, "u", "twice"), (7, "u", "twice")]


@pytest.mark.parametrize("least", [0, 5])
def test_odd_pages(spark, least):
    index = written(spark, ODD, min_revisit_bytes=least)
    records = warc.read_records(index)
    assert found(records) == expected(ODD, least)
    payloads = {r.payload_digest: bytes(r.payload).decode() for r in records.filter("record_type = 'response'").collect()}
    assert set(payloads.values()) == {h or "" for _, _, h in ODD}


def test_given_table_and_selection(spark):
    rows = table_rows("pages", "page_id, url, html")
    index = written(spark, rows + [(1000 + p, u, h) for p, u, h in rows])
    both = rows + [(1000 + p, u, h) for p, u, h in rows]
    assert found(warc.read_records(index)) == expected(both)
    some = warc.read_records(index, F.col("page_id") % 7 == 3)
    assert found(some) == [r for r in expected(both) if r[0] % 7 == 3]
    assert warc.read_records(index, F.lit(False)).count() == 0


def test_archives_are_plain_warc(spark, tmp_path):
    index = written(spark, ODD, folder=str(tmp_path / "out"))
    data = b"".join(gzip.decompress(open(f, "rb").read()) for f in glob.glob(str(tmp_path / "out" / "*.warc.gz")))
    assert data.count(b"WARC/1.1\r\nWARC-Type: ") == len(ODD) == index.count()
    for row in index.collect():
        with open(row.file.removeprefix("file://"), "rb") as file:
            file.seek(row.offset)
            assert gzip.decompress(file.read(row.length)).startswith(b"WARC/1.1\r\n")


def test_empty_table(spark):
    assert warc.read_records(written(spark, [])).count() == 0
