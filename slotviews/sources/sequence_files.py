"""SequenceFiles as a Spark data source that gives Arrow batches.

Spark reads SequenceFiles as RDDs only, whose pairs Python gets one by one. This source
cuts files into splits at their sync marks, so one large file is read by many tasks, and
hands on batches of values; keys are skipped. Files are listed with Hadoop's file systems
and opened with Arrow's, which know local disks, HDFS and the large object stores.
"""

from __future__ import annotations

import bz2
import gzip
import json
import struct
import sys
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

# tasks carry the code they run, so executors need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SPLIT_BYTES = 64_000_000
BATCH_BYTES, BATCH_ROWS = 4_000_000, 10_000
CHUNK = 1_000_000
# fixed values of the file format
ESCAPE, SYNC_BYTES = b"\xff\xff\xff\xff", 16
CODECS = {"DefaultCodec": zlib.decompress, "DeflateCodec": zlib.decompress, "GzipCodec": gzip.decompress, "BZip2Codec": bz2.decompress}


def vint(data: bytes, at: int) -> tuple[int, int]:
    """A number of variable length and the position behind it."""
    first = data[at] - 256 if data[at] > 127 else data[at]
    if first >= -112:
        return first, at + 1
    size, negative = (-120 - first, True) if first < -120 else (-112 - first, False)
    value = int.from_bytes(data[at + 1 : at + 1 + size], "big")
    return (~value if negative else value), at + 1 + size


class Bytes:
    """Forward reading of an open file, a chunk at a time."""

    def __init__(self, file, at: int):
        self.file, self.start, self.data, self.pos = file, at, b"", 0
        file.seek(at)

    @property
    def at(self) -> int:
        return self.start + self.pos

    def take(self, n: int) -> bytes:
        if self.pos + n > len(self.data):
            rest = self.data[self.pos :]
            self.start, self.pos = self.at, 0
            self.data = rest + self.file.read(max(n - len(rest), CHUNK))
            if len(self.data) < n:
                raise EOFError("a SequenceFile ends within a record")
        self.pos += n
        return self.data[self.pos - n : self.pos]

    def more(self) -> bool:
        if self.pos == len(self.data):
            self.start, self.pos, self.data = self.at, 0, self.file.read(CHUNK)
        return self.pos < len(self.data)

    def vint(self) -> int:
        first = self.take(1)
        signed = first[0] - 256 if first[0] > 127 else first[0]
        size = 0 if signed >= -112 else -120 - signed if signed < -120 else -112 - signed
        return vint(first + self.take(size), 0)[0]

    def text(self) -> str:
        return self.take(self.vint()).decode()


class Header:
    """What stands before a file's records."""

    def __init__(self, source: Bytes):
        if source.take(3) != b"SEQ" or source.take(1)[0] != 6:
            raise ValueError("not a SequenceFile of version 6")
        source.text()  # the class of keys
        self.value_class = source.text().rsplit(".", 1)[-1]
        self.compressed, self.blocks = source.take(1) == b"\1", source.take(1) == b"\1"
        codec = source.text().rsplit(".", 1)[-1] if self.compressed else None
        if codec and codec not in CODECS:
            raise ValueError(f"no codec {codec} for SequenceFiles")
        if self.value_class not in ("Text", "BytesWritable"):
            raise ValueError(f"no values of class {self.value_class}")
        self.unpack = CODECS[codec] if codec else bytes
        for _ in range(2 * struct.unpack(">i", source.take(4))[0]):
            source.text()
        self.sync, self.end = source.take(SYNC_BYTES), source.at

    def value(self, data: bytes) -> bytes:
        if self.value_class == "Text":
            return data[vint(data, 0)[1] :]
        return data[4:]


def first_sync(file, sync: bytes, at: int, size: int) -> int | None:
    """Where the first sync mark at or behind a position begins, with its escape."""
    mark, carried = ESCAPE + sync, b""
    file.seek(at)
    while at < size:
        data = carried + file.read(CHUNK)
        found = data.find(mark)
        if found >= 0:
            return at - len(carried) + found
        at += len(data) - len(carried)
        carried = data[-len(mark) + 1 :]
    return None


def values(file, size: int, start: int, end: int) -> Iterator[bytes]:
    """Values of the records whose last sync mark begins in ``start`` to ``end``.

    Records before a file's first mark belong to the split at 0.
    """
    header = Header(Bytes(file, 0))
    at = header.end if start == 0 else first_sync(file, header.sync, max(start, header.end), size)
    if at is None or at >= max(end, header.end + 1):
        return
    source = Bytes(file, at)
    while source.more():
        place, size_or_escape = source.at, source.take(4)
        if size_or_escape == ESCAPE:
            if source.take(SYNC_BYTES) != header.sync:
                raise ValueError("a SequenceFile has a wrong sync mark")
            if place >= end:
                return
            if not header.blocks:
                continue
            count = source.vint()
            for _ in range(2):
                source.take(source.vint())  # lengths of keys, keys
            lengths, data = header.unpack(source.take(source.vint())), header.unpack(source.take(source.vint()))
            place = at = 0
            for _ in range(count):
                length, place = vint(lengths, place)
                yield header.value(data[at : at + length])
                at += length
        else:
            (length,), (key,) = struct.unpack(">i", size_or_escape), struct.unpack(">i", source.take(4))
            yield header.value(header.unpack(source.take(length)[key:]))


@dataclass
class Split(InputPartition):
    path: str
    size: int
    start: int
    end: int


class SequenceFileReader(DataSourceReader):
    def __init__(self, options, binary: bool):
        self.files, self.binary = json.loads(options["files"]), binary
        self.split_bytes = int(options.get("split_bytes", SPLIT_BYTES))

    def partitions(self) -> list[Split]:
        step = self.split_bytes
        return [Split(path, size, at, min(at + step, size)) for path, size in self.files for at in range(0, size, step)]

    def read(self, split: Split) -> Iterator[pa.RecordBatch]:
        if "://" in split.path or split.path.startswith("file:"):
            system, path = fs.FileSystem.from_uri(split.path.replace("file:/", "file:///", 1) if "://" not in split.path else split.path)
        else:
            system, path = fs.LocalFileSystem(), split.path
        held, size = [], 0
        with system.open_input_file(path) as file:
            for value in values(file, split.size, split.start, split.end):
                held.append(value)
                size += len(value)
                if size > BATCH_BYTES or len(held) == BATCH_ROWS:
                    yield self.batch(held)
                    held, size = [], 0
        if held:
            yield self.batch(held)

    def batch(self, held: list[bytes]) -> pa.RecordBatch:
        if self.binary:
            return pa.RecordBatch.from_arrays([pa.array(held, pa.binary())], ["frame"])
        return pa.RecordBatch.from_arrays([pa.array([v.decode(errors="replace") for v in held], pa.string())], ["value"])


class SequenceFileSource(DataSource):
    """Options: ``files``, a JSON list of paths and sizes; ``kind``, text or binary; ``split_bytes``."""

    @classmethod
    def name(cls) -> str:
        return "slotviews_sequence"

    def schema(self) -> str:
        return "frame binary" if self.options.get("kind") == "binary" else "value string"

    def reader(self, schema) -> SequenceFileReader:
        return SequenceFileReader(self.options, self.options.get("kind") == "binary")
