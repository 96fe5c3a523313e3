"""Removal of long byte strings that start earlier, with families of sampled suffix arrays.

Every window of ``length`` bytes samples one of the suffixes that start in it: the one
whose first GRAM bytes have the smallest hash. Equal windows sample at equal places, so
they meet wherever their suffixes meet, and about three suffixes in a hundred remain.
The windows that sample one suffix form a stretch of text around it.

1. Suffixes are dealt out by the hash of their first bytes. A task keeps, for its share,
   a logarithmic family of arrays: batches of suffixes in document order are sorted,
   scanned against the levels that are there, and merged with levels of equal size. A
   stretch that occurred before is removed whole.
2. Where equal suffixes stand in different stretches (at the ends of repeated passages),
   the bytes of the first occurrence of each stretch are compared window by window, in a
   second round of the same kind.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotviews.llm.common import Hashed, mix, shuffle_partitions, stored, text_slices

GRAM = 32
BATCH = 1 << 16
BLOCK_SUFFIXES = 1_000_000
BLOCK_DOCS = 60_000  # owners in a block are two-byte numbers
NO_ID = np.iinfo(np.int64).min
_PLACE = np.uint64(2**31 - 1)

_MOVED = "part int, block bigint, grams binary, stretches binary, owners binary, starts binary, widths binary, docs binary, hashes binary"
_FOUND = "doc_id bigint, text_hash bigint, whole binary, open binary"
_OPEN = "part int, docs binary, hashes binary, starts binary, sizes binary, bytes binary"
_NAMES = tuple(field.split()[0] for field in _MOVED.split(", "))


def stretches(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Text, first and last window start, suffix hash and stretch hash of each sampled suffix."""
    gram = min(GRAM, length)
    none = np.empty(0, np.int64)
    if len(data) < length:
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    hashed = Hashed(data)
    at = np.arange(len(data) - gram + 1)
    own = hashed.of(at, at + gram)
    # the place in the low bits makes the leftmost of equal hashes the smallest
    least, span = (own & ~_PLACE) | at.astype(np.uint64), 1
    while span < length - gram + 1:
        step = min(span, length - gram + 1 - span)
        least, span = np.minimum(least[: len(least) - step], least[step:]), span + step
    window = np.arange(len(least))
    text = np.searchsorted(offsets, window, "right") - 1
    inside = window + length <= offsets[text + 1]
    window, text, sampled = window[inside], text[inside], (least[inside] & _PLACE).astype(np.int64)
    if not len(window):
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    edge = np.flatnonzero(np.concatenate(([True], (np.diff(sampled) != 0) | (np.diff(text) != 0))))
    first, last = window[edge], window[np.append(edge[1:], len(window)) - 1]
    return text[edge], first, last, own[sampled[edge]], hashed.of(first, last + length)


class Family:
    """Sorted arrays of keys with the document of their first occurrence, by level."""

    def __init__(self):
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []

    def scan(self, keys: np.ndarray) -> np.ndarray:
        """The smallest document that holds each key, or the largest integer."""
        least = np.full(len(keys), np.iinfo(np.int64).max)
        for known, docs in self.levels:
            at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
            least = np.where(known[at] == keys, np.minimum(least, docs[at]), least)
        return least

    def add(self, keys: np.ndarray, docs: np.ndarray) -> np.ndarray:
        """Scans a batch against the levels and itself, then takes it in."""
        order = np.lexsort((docs, keys))
        first = np.concatenate(([True], np.diff(keys[order]) != 0))
        array = keys[order][first], docs[order][first]
        least = np.minimum(self.scan(keys), array[1][np.searchsorted(array[0], keys)])
        while self.levels and len(self.levels[-1][0]) <= len(array[0]):
            older = self.levels.pop()
            keys, docs = np.concatenate((older[0], array[0])), np.concatenate((older[1], array[1]))
            order = np.lexsort((docs, keys))
            first = np.concatenate(([True], np.diff(keys[order]) != 0))
            array = keys[order][first], docs[order][first]
        self.levels.append(array)
        return least


def started_earlier(keys: np.ndarray, docs: np.ndarray, rows: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Whether a key occurs in a smaller document, or earlier in the same row."""
    earlier, family = np.zeros(len(keys), bool), Family()
    order = np.argsort(docs, kind="stable")
    for i in range(0, len(order), BATCH):
        batch = order[i : i + BATCH]
        earlier[batch] = family.add(keys[batch], docs[batch]) < docs[batch]
    # a row that is given twice brings the same start twice, which is not an earlier one
    order = np.lexsort((starts, rows, keys))
    edge = np.ones(len(keys), bool)
    edge[1:] = (keys[order][1:] != keys[order][:-1]) | (rows[order][1:] != rows[order][:-1])
    least = starts[order][edge][np.cumsum(edge) - 1]
    earlier[order] |= starts[order] > least
    return earlier


def _moved(rows: list[dict]) -> pa.RecordBatch:
    types = [pa.int32(), pa.int64()] + [pa.binary()] * 7
    return pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in rows], t) for n, t in zip(_NAMES, types, strict=True)], list(_NAMES))


def _cut(values: np.ndarray, size: int) -> bytes:
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :size]).tobytes()


def _uncut(data: bytes, size: int) -> np.ndarray:
    out = np.zeros((len(data) // size, 8), np.uint8)
    out[:, :size] = np.frombuffer(data, np.uint8).reshape(-1, size)
    return out.reshape(-1).view("<u8")


def _deal(parts: int, length: int):
    def task(batches):
        block = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 24
        docs, found, held = [], [], 0

        def out():
            nonlocal docs, found, held, block
            owner, first, last, gram, stretch = (np.concatenate(c) for c in zip(*found, strict=True)) if found else [np.empty(0, np.int64)] * 5
            part = (gram.astype(np.uint64) % np.uint64(parts)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            bounds = np.searchsorted(part[order], np.arange(parts + 1))
            ids, hashes = (np.array(c, np.int64) for c in zip(*docs, strict=True))
            rows = []
            for p in np.flatnonzero(np.diff(bounds)):
                own = order[bounds[p] : bounds[p + 1]]
                docs_of = ids[owner[own]]
                rows.append({"part": int(p), "block": block, "grams": _cut(gram[own] >> np.uint64(16), 6), "stretches": _cut(stretch[own], 6), "owners": owner[own].astype(np.uint16).tobytes(), "starts": first[own].astype(np.uint32).tobytes(), "widths": (last - first)[own].astype(np.uint16 if length > 255 else np.uint8).tobytes(), "docs": _packed(docs_of)})
            rows.append({"part": block % parts, "block": block, "docs": ids.tobytes(), "hashes": hashes.tobytes()})
            docs, found, held, block = [], [], 0, block + 1
            return _moved(rows)

        for batch in batches:
            ids = batch.column(0).fill_null(int(NO_ID)).to_numpy(zero_copy_only=False)
            hashes = batch.column(2).to_numpy()
            for first, last, data, offsets in text_slices(batch.column(1)):
                text, a, b, gram, stretch = stretches(data, offsets, length)
                if len(docs) + last - first > BLOCK_DOCS or held > BLOCK_SUFFIXES:
                    yield out()
                found.append((text + len(docs), a - offsets[text], b - offsets[text], gram, stretch))
                docs += zip(ids[first:last].tolist(), hashes[first:last].tolist(), strict=True)
                held += len(a)
        if docs:
            yield out()

    return task


def _packed(docs: np.ndarray) -> bytes:
    """Document ids of suffixes, as runs: neighbours mostly share theirs."""
    import zlib

    return zlib.compress(np.diff(docs, prepend=0).tobytes(), 1)


def _unpacked(data: bytes) -> np.ndarray:
    import zlib

    return np.cumsum(np.frombuffer(zlib.decompress(data), np.int64))


def _match(length: int):
    """All suffixes of some parts: what goes back are whole stretches and open ones."""

    def task(batches):
        columns: list[list] = [[] for _ in range(7)]
        for batch in batches:
            for i, row in enumerate(batch.to_pylist()):
                if row["hashes"] is not None:
                    yield batch.slice(i, 1)
                    continue
                grams = _uncut(row["grams"], 6)
                columns[0].append(grams)
                columns[1].append(_uncut(row["stretches"], 6))
                columns[2].append(np.frombuffer(row["owners"], np.uint16))
                columns[3].append(np.frombuffer(row["starts"], np.uint32).astype(np.int64))
                columns[4].append(np.frombuffer(row["widths"], np.uint16 if length > 255 else np.uint8).astype(np.int64))
                columns[5].append(_unpacked(row["docs"]))
                columns[6].append(np.full(len(grams), row["block"]))
        if not columns[0]:
            return
        grams, stretch, owners, starts, widths, docs, blocks = map(np.concatenate, columns)
        del columns
        keys = mix(grams) + stretch
        earlier = started_earlier(keys, docs, blocks * 65536 + owners, starts)
        pairs = np.unique(np.stack((grams, keys), 1), axis=0)[:, 0]
        names, variants = np.unique(pairs, return_counts=True)
        several = variants[np.searchsorted(names, grams)] > 1
        for keep, kind in ((earlier, "widths"), (~earlier & several, "grams")):
            at = np.flatnonzero(keep)
            if not len(at):
                continue
            at = at[np.argsort(blocks[at], kind="stable")]
            edge = np.flatnonzero(np.concatenate(([True], np.diff(blocks[at]) != 0)))
            rows = []
            for a, b in zip(edge, [*edge[1:], len(at)], strict=True):
                own = at[a:b]
                row = {"part": 0, "block": int(blocks[own[0]]), "owners": owners[own].tobytes(), "starts": starts[own].astype(np.uint32).tobytes(), "widths": widths[own].astype(np.uint16).tobytes()}
                if kind == "grams":  # open stretches take along what deals them out
                    row["grams"] = (grams[own] & np.uint64(2**31 - 1)).astype(np.int32).tobytes()
                rows.append(row)
                if len(rows) == 200:
                    yield _moved(rows)
                    rows = []
            if rows:
                yield _moved(rows)

    return task


def union(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Overlapping or touching ranges as one."""
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order]) if len(ends) else ends
    edge = np.flatnonzero(np.concatenate(([True], starts[1:] > ends[:-1]))) if len(starts) else np.empty(0, int)
    return starts[edge], ends[np.append(edge[1:], len(starts)) - 1] if len(edge) else ends


def _return(length: int):
    """Whole blocks: each document's removed ranges and open stretches."""

    def task(batches):
        blocks: dict[int, list] = {}
        for batch in batches:
            for row in batch.to_pylist():
                blocks.setdefault(row["block"], []).append(row)
        for rows in blocks.values():
            own = next(r for r in rows if r["hashes"] is not None)
            docs, hashes = np.frombuffer(own["docs"], np.int64), np.frombuffer(own["hashes"], np.int64)
            sides = []
            for open_ in (False, True):
                some = [r for r in rows if r["hashes"] is None and (r["grams"] is not None) == open_]
                owners = np.concatenate([np.frombuffer(r["owners"], np.uint16) for r in some] or [np.empty(0, np.uint16)])
                starts = np.concatenate([np.frombuffer(r["starts"], np.uint32) for r in some] or [np.empty(0, np.uint32)]).astype(np.int64)
                widths = np.concatenate([np.frombuffer(r["widths"], np.uint16) for r in some] or [np.empty(0, np.uint16)]).astype(np.int64)
                grams = np.concatenate([np.frombuffer(r["grams"], np.int32) for r in some if open_] or [np.zeros(len(owners), np.int32)]).astype(np.int64)
                order = np.argsort(owners, kind="stable")
                bounds = np.searchsorted(owners[order], np.arange(len(docs) + 1))
                sides.append((starts[order], widths[order], grams[order], bounds))
            out = []
            for d in np.flatnonzero((np.diff(sides[0][3]) > 0) | (np.diff(sides[1][3]) > 0)):
                s, w, _, bounds = (x[sides[0][3][d] : sides[0][3][d + 1]] if i < 3 else x for i, x in enumerate(sides[0]))
                a, b = union(s, s + w + length)
                s, w, g, bounds = (x[sides[1][3][d] : sides[1][3][d + 1]] if i < 3 else x for i, x in enumerate(sides[1]))
                out.append((None if docs[d] == NO_ID else int(docs[d]), int(hashes[d]), np.stack((a, b), 1).tobytes(), np.stack((s, w, g), 1).tobytes()))
            for i in range(0, len(out), 2000):
                d, h, a, b = zip(*out[i : i + 2000], strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(d, pa.int64()), pa.array(h, pa.int64()), pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["doc_id", "text_hash", "whole", "open"])

    return task


def _open(parts: int, length: int):
    """The bytes of open stretches, dealt out by their suffix."""

    def task(batches):
        for batch in batches:
            held: dict[int, list] = {}
            for doc, hashed, text, opened in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                data = (text or "").encode()
                for packed in opened:
                    for start, width, gram in np.frombuffer(packed, np.int64).reshape(-1, 3).tolist():
                        held.setdefault(gram % parts, []).append((NO_ID if doc is None else doc, hashed, start, data[start : start + width + length]))
            if held:
                rows = [(part, *(np.array(c, np.int64).tobytes() for c in list(zip(*own, strict=True))[:3]), np.array([len(x[3]) for x in own], np.int32).tobytes(), b"".join(x[3] for x in own)) for part, own in held.items()]
                names = [field.split()[0] for field in _OPEN.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), [pa.int32()] + [pa.binary()] * 5, strict=True)], names)

    return task


def _windows(length: int):
    """Ranges of windows of open stretches that start earlier."""

    def task(batches):
        found: list[tuple] = []
        for batch in batches:
            for row in batch.to_pylist():
                sizes = np.frombuffer(row["sizes"], np.int32).astype(np.int64)
                begin = np.concatenate(([0], np.cumsum(sizes)))
                hashed = Hashed(np.frombuffer(row["bytes"], np.uint8))
                counts = sizes - length + 1
                own = np.repeat(np.arange(len(sizes)), counts)
                at = np.arange(len(own)) - np.repeat(np.cumsum(counts) - counts, counts)
                start = begin[:-1][own] + at
                docs, hashes, starts = (np.frombuffer(row[n], np.int64)[own] for n in ("docs", "hashes", "starts"))
                found.append((hashed.of(start, start + length), docs, hashes, starts + at))
        if not found:
            return
        keys, docs, hashes, starts = map(np.concatenate, zip(*found, strict=True))
        del found
        rows = mix(docs.view(np.uint64)) ^ hashes.view(np.uint64)
        at = np.flatnonzero(started_earlier(keys, docs, rows, starts))
        at = at[np.lexsort((starts[at], hashes[at], docs[at]))]
        same = (np.diff(docs[at]) == 0) & (np.diff(hashes[at]) == 0) & (np.diff(starts[at]) <= 1)
        edge = np.flatnonzero(np.concatenate(([True], ~same))) if len(at) else np.empty(0, int)
        last = at[np.append(edge[1:], len(at)) - 1] if len(edge) else edge
        first = at[edge]
        ids = pa.array(docs[first], pa.int64(), mask=docs[first] == NO_ID)
        yield pa.RecordBatch.from_arrays([ids, pa.array(hashes[first]), pa.array(starts[first]), pa.array(starts[last] + length)], ["doc_id", "text_hash", "start", "end"])

    return task


def earlier_strings(docs: DataFrame, length: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, text, removed)`` for each row; ``removed`` has ranges ``start, end`` of UTF-8 bytes.

    A byte is removed if a string of ``length`` bytes that covers it also starts earlier:
    in a document with a smaller id, or before it in the same row. Strings are judged on
    the input and never cross documents. Ranges are maximal and sorted.

    Texts cross a shuffle twice: to fetch the bytes of open stretches and to meet the
    ranges. Suffixes travel as about 20 bytes each. A suffix that many documents share
    is one of many in its task; stretches are held as sorted arrays, never as groups.

    A null text is empty. Texts shorter than ``length`` stay whole. A row without an id
    comes before all others. Rows with equal ids never remove from each other, so of
    repeated rows each keeps what a single one would. Other columns are not read.
    """
    spark = docs.sparkSession
    parts = shuffle_partitions(spark)
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = rows.withColumn("text_hash", F.xxhash64("text"))
    dealt = rows.mapInArrow(_deal(4 * parts, length), _MOVED).repartition(parts, "part")
    back = dealt.mapInArrow(_match(length), _MOVED).repartition(parts, "block")
    found = stored(back.mapInArrow(_return(length), _FOUND), "stretches")
    found = found.groupBy("doc_id", "text_hash").agg(F.collect_set("whole").alias("whole"), F.collect_set("open").alias("open"))
    key = lambda other: rows["doc_id"].eqNullSafe(other["doc_id"]) & (rows["text_hash"] == other["text_hash"])

    opened = found.filter(F.exists("open", lambda x: F.octet_length(x) > 0))
    opened = rows.join(opened, key(opened)).select(rows["doc_id"], rows["text_hash"], rows["text"], "open")
    windows = opened.mapInArrow(_open(4 * parts, length), _OPEN).repartition(parts, "part")
    windows = windows.mapInArrow(_windows(length), "doc_id bigint, text_hash bigint, start bigint, end bigint")
    windows = windows.groupBy("doc_id", "text_hash").agg(F.collect_set(F.struct("start", "end")).alias("windows"))
    both = found.select("doc_id", "text_hash", "whole").withColumn("windows", F.expr("cast(null as array<struct<start:bigint,end:bigint>>)"))
    both = both.unionByName(windows.withColumn("whole", F.expr("cast(null as array<binary>)"))).groupBy("doc_id", "text_hash").agg(F.first("whole", True).alias("whole"), F.first("windows", True).alias("windows"))

    def merge(batches):
        for batch in batches:
            whole, parts_ = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            out = []
            for packed, ranges in zip(whole, parts_, strict=True):
                pairs = [np.frombuffer(p, np.int64).reshape(-1, 2) for p in packed or ()]
                pairs.append(np.array([(r["start"], r["end"]) for r in ranges or ()], np.int64).reshape(-1, 2))
                pairs = np.concatenate(pairs)
                a, b = union(pairs[:, 0], pairs[:, 1])
                out.append([{"start": s, "end": e} for s, e in zip(a.tolist(), b.tolist(), strict=True)])
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, kind)], ["doc_id", "text_hash", "removed"])

    ranges = stored(both.mapInArrow(merge, "doc_id bigint, text_hash bigint, removed array<struct<start:bigint,end:bigint>>"), "ranges")
    empty = F.expr("cast(array() as array<struct<start:bigint,end:bigint>>)")
    return rows.join(ranges, key(ranges), "left").select(rows["doc_id"], F.coalesce(rows["text"], F.lit("")).alias("text"), F.coalesce("removed", empty).alias("removed"))


def kept_bytes(rows: DataFrame) -> DataFrame:
    """Adds to ``earlier_strings`` what a document keeps, as bytes in ``kept``."""
    data, ranges = F.col("text").cast("binary"), F.col("removed")
    starts = F.concat(F.array(F.lit(0).cast("bigint")), F.transform(ranges, lambda r: r["end"]))
    ends = F.concat(F.transform(ranges, lambda r: r["start"]), F.array(F.octet_length("text").cast("bigint")))
    piece = F.zip_with(starts, ends, lambda a, b: F.hex(F.substring(data, (a + 1).cast("int"), (b - a).cast("int"))))
    return rows.withColumn("kept", F.unhex(F.array_join(piece, "")))
