"""WARC archives of pages: records, an index of byte ranges, and reads of selected records."""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slotviews.llm.common import stored
from slotviews.session import scratch_path

ARCHIVE_BYTES = 1_000_000_000
#: ranges closer than this are read together, up to READ_BYTES at once
GAP_BYTES = 64_000
READ_BYTES = 8_000_000
#: of records that a task reads, about
TASK_BYTES = 32_000_000

INDEX = "page_id bigint, url string, digest string, payload_bytes bigint, record_type string, refers_to bigint, file string, offset bigint, length bigint"
RECORD = "page_id bigint, url string, record_type string, refers_to bigint, payload_bytes bigint, payload_digest string, payload binary"


def _digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _urn(page_id) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _record(page_id, url, payload: bytes, digest: str, refers_to, revisit: bool) -> bytes:
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", _urn(page_id)),
        ("WARC-Date", "1970-01-01T00:00:00Z"),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("X-Payload-Length", str(len(payload))),
    ]
    if url is not None:
        fields.append(("WARC-Target-URI", "".join(c if c > " " else f"%{ord(c):02X}" for c in url)))
    if revisit:
        fields += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("WARC-Refers-To", _urn(refers_to))]
        payload = b""
    fields += [("Content-Type", "text/html; charset=utf-8"), ("Content-Length", str(len(payload)))]
    head = "WARC/1.1\r\n" + "".join(f"{name}: {value}\r\n" for name, value in fields) + "\r\n"
    return gzip.compress(head.encode() + payload + b"\r\n\r\n", 1, mtime=0)


def _parse(member: bytes) -> tuple:
    head, _, rest = gzip.decompress(member).partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    number = lambda urn: int(urn[10:-1]) if urn and urn[10:-1] else None
    payload = rest[: int(fields["Content-Length"])]
    if fields["WARC-Type"] == "revisit":
        size, digest, payload = int(fields["X-Payload-Length"]), fields["WARC-Payload-Digest"][5:], None
    else:
        size, digest = len(payload), _digest(payload)
    return number(fields["WARC-Record-ID"]), fields.get("WARC-Target-URI"), fields["WARC-Type"], number(fields.get("WARC-Refers-To")), size, digest, payload


def _uri(spark: SparkSession, path: str) -> str:
    """The folder's full address, for readers and writers inside tasks."""
    jvm = spark._jvm.org.apache.hadoop.fs.Path(path)
    full = jvm.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(jvm).toString()
    return "file://" + full[5:] if full.startswith("file:/") and not full.startswith("file://") else full


def write_archives(pages: DataFrame, folder: str | None = None, min_revisit_bytes: int = 0) -> DataFrame:
    """Writes one record for each row of ``(page_id, url, html)`` and returns the stored index.

    Of records with equal payloads of at least ``min_revisit_bytes`` bytes, that with the
    largest page_id is the response and the others revisit it. Digests are grouped
    without payloads, with map-side sums; the join back to the pages splits a digest that
    many pages have. Every task writes files of its own under a new name, one gzip
    member for each record, and reports offsets: a task that runs again leaves unnamed
    files and a right index.

    A null html is an empty payload. A null page_id sorts below all ids. Rows that repeat
    the largest page_id with the same payload are all responses. A null url leaves the
    field out; white space in a url is escaped. Other columns are not read.
    """
    spark = pages.sparkSession
    folder = _uri(spark, folder or scratch_path(spark, "warc"))
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    rows = rows.withColumn("_hash", F.sha1("html"))
    first = rows.filter(F.octet_length("html") >= min_revisit_bytes).groupBy("_hash").agg(F.count(F.lit(1)).alias("_n"), F.max("page_id").alias("_first")).filter("_n > 1 AND _first IS NOT NULL")
    dealt = rows.join(first.select("_hash", "_first"), "_hash", "left").select("page_id", "url", "html", F.when(F.coalesce(F.col("page_id") < F.col("_first"), F.col("_first").isNotNull()), F.col("_first")).alias("refers_to"))

    def task(batches):
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        stream, name, offset = None, "", 0
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if stream is None or offset > ARCHIVE_BYTES:
                    if stream is not None:
                        stream.close()
                    name, offset = f"pages-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.gz", 0
                    stream = store.open_output_stream(f"{root}/{name}", compression=None)
                payload, refers = row["html"].encode(), row["refers_to"]
                digest = _digest(payload)
                record = _record(row["page_id"], row["url"], payload, digest, refers, refers is not None)
                stream.write(record)
                out.append((row["page_id"], row["url"], digest, len(payload), "response" if refers is None else "revisit", refers, f"{folder}/{name}", offset, len(record)))
                offset += len(record)
            if out:
                yield _batch(out, [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()], INDEX)
        if stream is not None:
            stream.close()

    return stored(dealt.mapInArrow(task, INDEX), "warc-index")


def _batch(rows: list[tuple], types: list[pa.DataType], schema: str) -> pa.RecordBatch:
    names = [field.split()[0] for field in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)


def read_records(index: DataFrame, selected: Column | None = None) -> DataFrame:
    """The records of the index rows that ``selected`` keeps (all by default).

    The index alone decides what is read: its rows are sorted by file and offset, ranges
    that touch or nearly touch become one read, and only those bytes are fetched. A file
    is dealt out in stretches, so a large one is read by many tasks. Digest and length
    of a response are computed from the bytes read; a revisit states those of the
    payload it stands for. An empty selection gives no rows.
    """
    rows = index if selected is None else index.filter(selected)
    rows = rows.select("file", "offset", "length", F.floor(F.col("offset") / READ_BYTES).alias("_part"))
    # the index is small where the archives are not, so the tasks are told by the archives' bytes
    size = rows.agg(F.sum("length")).first()[0] or 0
    rows = rows.repartition(max(1, -(-size // TASK_BYTES)), "file", "_part").sortWithinPartitions("file", "offset").select("file", "offset", "length")

    def task(batches):
        from pyarrow import fs

        def fetch(ranges):
            name, start, end = ranges[0][0], ranges[0][1], ranges[-1][1] + ranges[-1][2]
            store, path = fs.FileSystem.from_uri(name)
            with store.open_input_file(path) as file:
                data = file.read_at(end - start, start)
            return _batch([_parse(data[o - start : o - start + n]) for _, o, n in ranges], [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()], RECORD)

        held = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and (row[0] != held[-1][0] or row[1] - held[-1][1] - held[-1][2] > GAP_BYTES or row[1] + row[2] - held[0][1] > READ_BYTES):
                    yield fetch(held)
                    held = []
                held.append(row)
        if held:
            yield fetch(held)

    return rows.mapInArrow(task, RECORD)
