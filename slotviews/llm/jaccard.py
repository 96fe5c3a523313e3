"""Exact Jaccard join of word n-gram sets, and the components of its links.

1. Tasks hash every text's n-grams. A *class* is a set of n-grams; documents with equal
   sets share it. N-grams are dealt out by hash, packed in blocks, and counted over all
   classes. Those that occur once cannot be shared and are dropped.
2. N-grams are ordered from rare to frequent. Two sets that are similar enough share one
   of the first few in that order (the prefix), so only classes with a repeated n-gram in
   the prefix stay *active*. Passages that many documents share stand at the end of the
   order and bring no candidates.
3. Active classes that share a prefix n-gram, directly or through others, form a block. A
   block is cut into size bands and its bands into chunks, so that a large group of near
   copies becomes many tiles: pairs of chunks whose sizes can link. A class travels once
   for each tile it belongs to, once in all if its block is small.
4. Inside a tile, pairs are bounded from above by the bit counts of hashed bitmaps; what
   remains is intersected exactly on the sorted arrays. ``linked_pairs`` compares all pairs
   of a tile; for ``linked_components`` links that close a circle are not looked for.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotviews.llm.common import Words, components, mix, shuffle_partitions, stored, text_slices

BLOCK_NGRAMS = 1_500_000
BLOCK_CLASSES = 60_000  # owners of n-grams in a block are two-byte numbers
LOW_BITS = 40  # of an n-gram's hash, besides the part it is dealt to
MOST_COUNTED = 65_535  # the order needs no larger counts
TILE = 1024  # classes of a chunk, about
NO_ID = np.iinfo(np.int64).min

_MOVED = "part int, block bigint, grams binary, owners binary, counts binary, docs binary, doc_owners binary, classes binary, sizes binary"
_SETS = "doc_id bigint, text_hash bigint, class bigint, n int, grams binary, prefix array<bigint>"


def bands(percent: int) -> np.ndarray:
    """Lower bounds of the size bands: linked sets lie in one band or in two next ones."""
    bounds = [1]
    while bounds[-1] < 2**31:
        bounds.append(bounds[-1] * 100 // percent + 1)
    return np.array(bounds)


def _row(part, block, **columns):
    return (part, block, *(columns.get(name) for name in ("grams", "owners", "counts", "docs", "doc_owners", "classes", "sizes")))


def _moved(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int32(), pa.int64()] + [pa.binary()] * 7
    names = [field.split()[0] for field in _MOVED.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)


def _low(grams: np.ndarray) -> bytes:
    return np.ascontiguousarray(grams.astype("<u8").view(np.uint8).reshape(-1, 8)[:, : LOW_BITS // 8]).tobytes()


def _high(part: int, low: bytes) -> np.ndarray:
    out = np.zeros((len(low) * 8 // LOW_BITS, 8), np.uint8)
    out[:, : LOW_BITS // 8] = np.frombuffer(low, np.uint8).reshape(-1, LOW_BITS // 8)
    return out.reshape(-1).view("<u8") + np.uint64(part << LOW_BITS)


def _hash_texts(parts: int, words: int):
    """Texts to blocks of n-grams by part, and one row of each block's documents."""

    def task(batches):
        block = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 24
        docs, ids, sets, held = [], {}, [], 0

        def out():
            nonlocal docs, ids, sets, held, block
            grams = np.concatenate(sets)
            owners = np.repeat(np.arange(len(sets), dtype=np.uint16), [len(s) for s in sets])
            part = ((grams >> np.uint64(LOW_BITS)) % np.uint64(parts)).astype(np.int32)
            order = np.argsort(part, kind="stable")
            grams, owners, bounds = grams[order], owners[order], np.searchsorted(part[order], np.arange(parts + 1))
            rows = [_row(p, block, grams=_low(grams[a:b]), owners=owners[a:b].tobytes()) for p, (a, b) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)) if b > a]
            doc_ids, hashes, doc_owners = zip(*docs, strict=True)
            own = {"docs": np.array(doc_ids + hashes, np.int64).tobytes(), "doc_owners": np.array(doc_owners, np.uint16).tobytes()}
            sizes = np.array([len(s) for s in sets], np.int32)
            rows.append(_row(block % parts, block, classes=np.array(list(ids), np.int64).tobytes(), sizes=sizes.tobytes(), **own))
            docs, ids, sets, held, block = [], {}, [], 0, block + 1
            return _moved(rows)

        for batch in batches:
            doc_ids = batch.column(0).fill_null(int(NO_ID)).to_numpy(zero_copy_only=False)
            hashes = batch.column(2).to_numpy(zero_copy_only=False)
            for first, last, data, offsets in text_slices(batch.column(1)):
                grams, bounds = Words(data, offsets).shingles(words)
                for i in range(last - first):
                    own = np.unique(grams[bounds[i] : bounds[i + 1]])
                    name = int.from_bytes(hashlib.blake2b(own.tobytes(), digest_size=8).digest(), "little", signed=True)
                    if name not in ids:
                        ids[name] = len(ids)
                        sets.append(own)
                        held += len(own)
                    docs.append((doc_ids[first + i], hashes[first + i], ids[name]))
                    if held > BLOCK_NGRAMS or len(docs) >= BLOCK_CLASSES:
                        yield out()
        if docs:
            yield out()

    return task


def _count(batches):
    """All blocks of some parts: the n-grams that occur again go back to their blocks."""
    grams, owners, blocks = [], [], []
    for batch in batches:
        for part, block, low, own, classes, row in zip(*(batch.column(i).to_pylist() for i in (0, 1, 2, 3, 7)), range(batch.num_rows), strict=True):
            if classes is not None:
                yield batch.slice(row, 1)
            else:
                grams.append(_high(part, low))
                owners.append(np.frombuffer(own, np.uint16))
                blocks.append(block)
    if not grams:
        return
    at = np.repeat(np.arange(len(blocks), dtype=np.int32), [len(g) for g in grams])
    grams, owners = np.concatenate(grams), np.concatenate(owners)
    order = np.argsort(grams)
    edge = np.flatnonzero(np.concatenate(([True], np.diff(grams[order]) != 0)))
    runs = np.diff(np.append(edge, len(grams)))
    counts = np.empty(len(grams), np.int64)
    counts[order] = np.repeat(runs, runs)
    keep = np.flatnonzero(counts > 1)
    blocks = np.array(blocks, np.int64)
    keep = keep[np.argsort(blocks[at[keep]], kind="stable")]
    of = blocks[at[keep]]
    if not len(of):
        return
    starts = np.flatnonzero(np.concatenate(([True], np.diff(of) != 0)))
    rows = []
    for a, b in zip(starts, np.append(starts[1:], len(of)), strict=True):
        chosen = keep[a:b]
        rows.append(_row(0, int(of[a]), grams=grams[chosen].tobytes(), owners=owners[chosen].tobytes(), counts=np.minimum(counts[chosen], MOST_COUNTED).astype(np.uint16).tobytes()))
        if len(rows) == 500:
            yield _moved(rows)
            rows = []
    if rows:
        yield _moved(rows)


def _sets(percent: int):
    """Whole blocks: every document with its class, and the active classes' repeated n-grams."""
    def task(batches):
        blocks: dict[int, list] = {}
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                blocks.setdefault(row[1], []).append(row[2:])
        for rows in blocks.values():
            docs, doc_owners, classes, sizes = next((np.frombuffer(r[3], np.int64), np.frombuffer(r[4], np.uint16), np.frombuffer(r[5], np.int64), np.frombuffer(r[6], np.int32)) for r in rows if r[5] is not None)
            parts = [r for r in rows if r[5] is None]
            grams = np.concatenate([np.frombuffer(r[0], np.uint64) for r in parts] or [np.empty(0, np.uint64)])
            owners = np.concatenate([np.frombuffer(r[1], np.uint16) for r in parts] or [np.empty(0, np.uint16)])
            counts = np.concatenate([np.frombuffer(r[2], np.uint16) for r in parts] or [np.empty(0, np.uint16)])
            order = np.lexsort((grams, counts, owners))
            grams, bounds = grams[order], np.searchsorted(owners[order], np.arange(len(classes) + 1))
            repeated = np.diff(bounds)
            prefix = sizes - -(-percent * sizes // 100) + 1 - (sizes - repeated)
            docs, hashes = docs.reshape(2, -1)
            none = [None] * len(docs)
            ids = pa.array(docs, pa.int64(), mask=docs == NO_ID)
            yield pa.RecordBatch.from_arrays([ids, pa.array(hashes), pa.array(classes[doc_owners]), pa.array(sizes[doc_owners]), pa.array(none, pa.binary()), pa.array(none, pa.list_(pa.int64()))], ["doc_id", "text_hash", "class", "n", "grams", "prefix"])
            out = []
            for c in np.flatnonzero((prefix > 0) & (repeated > 0)):
                own = grams[bounds[c] : bounds[c + 1]]
                out.append((int(classes[c]), int(sizes[c]), np.sort(own).tobytes(), own[: prefix[c]].view(np.int64).tolist()))
            for i in range(0, len(out), 2000):
                c, n, g, p = zip(*out[i : i + 2000], strict=True)
                yield pa.RecordBatch.from_arrays([pa.nulls(len(c), pa.int64()), pa.nulls(len(c), pa.int64()), pa.array(c), pa.array(n, pa.int32()), pa.array(g, pa.binary()), pa.array(p, pa.list_(pa.int64()))], ["doc_id", "text_hash", "class", "n", "grams", "prefix"])

    return task


def _tiled(placed: DataFrame, percent: int) -> DataFrame:
    """Each row of ``(class, n, grams, root)`` once for each of its tiles.

    ``side`` is 0 where all pairs of a tile count; else only pairs of side 1 and side 2.
    """
    bounds = F.array(*(F.lit(int(b)) for b in bands(percent)))
    rows = placed.withColumn("band", F.size(F.filter(bounds, lambda b: b <= F.col("n"))))
    counts = rows.groupBy("root", "band").agg(F.count(F.lit(1)).alias("k"))
    counts = counts.groupBy("root").agg(F.map_from_entries(F.collect_list(F.struct("band", F.ceil(F.col("k") / TILE).cast("int")))).alias("chunks"), F.sum("k").alias("k"))
    rows = rows.join(counts, "root")
    chunks = lambda band: F.coalesce(F.try_element_at("chunks", band), F.lit(0))
    own = F.pmod(F.xxhash64("class"), chunks(F.col("band"))).cast("int")

    def tile(band, a, other, b, side):
        return F.struct(F.xxhash64("root", band, a, other, b).alias("tile"), side.cast("int").alias("side"))

    def upto(n):
        return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.expr("cast(array() as array<int>)"))

    band, below, above = F.col("band"), F.col("band") - 1, F.col("band") + 1
    side = lambda j: F.when(j == own, 0).when(j > own, 1).otherwise(2)
    tiles = F.concat(
        F.transform(upto(chunks(band)), lambda j: tile(band, F.least(own, j), band, F.greatest(own, j), side(j))),
        F.transform(upto(chunks(above)), lambda j: tile(band, own, above, j, F.lit(1))),
        F.transform(upto(chunks(below)), lambda j: tile(below, j, band, own, F.lit(2))),
    )
    whole = F.array(tile(F.lit(0), F.lit(0), F.lit(0), F.lit(0), F.lit(0)))
    return rows.select("class", "n", "grams", F.explode(F.when(F.col("k") <= TILE, whole).otherwise(tiles)).alias("t")).select("t.tile", "t.side", "class", "n", "grams")


def shared_counts(own: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of a sorted array with others, by looking their values up in it."""
    values = np.concatenate(others)
    at = np.minimum(np.searchsorted(own, values), len(own) - 1)
    ends = np.cumsum([len(other) for other in others])
    return np.diff(np.concatenate(([0], np.cumsum(own[at] == values)[ends - 1])))


def tile_links(side: np.ndarray, name: np.ndarray, n: np.ndarray, grams: list[np.ndarray], percent: int, every: bool = False) -> list[tuple[int, int, int]]:
    """Links of a tile as ``(a, b, shared n-grams)``.

    Without ``every``, pairs that other links of the tile connect are not looked at.
    """
    order = np.argsort(n, kind="stable")
    side, name, n, grams = side[order], name[order], n[order].astype(np.int64), [grams[i] for i in order]
    m = np.array([len(g) for g in grams])
    known, ids = np.unique(np.concatenate(grams), return_inverse=True)
    sets = np.split(ids, np.cumsum(m)[:-1])
    words = int(np.clip(2 ** int(m.max() - 1).bit_length() // 64, 2, 256))
    bits = (mix(known) % np.uint64(words * 64)).astype(np.int64)[ids]
    signs = np.zeros((len(n), words), np.uint64)
    np.bitwise_or.at(signs, (np.repeat(np.arange(len(n)), m), bits >> 6), np.uint64(1) << (bits & 63).astype(np.uint64))
    group, links = np.arange(len(n)), []
    for i in range(len(n)):
        last = np.searchsorted(n, n[i] * 100 // percent, "right")
        open_pair = (side[i + 1 : last] != side[i]) | (side[i] == 0)
        if not every:
            open_pair &= group[i + 1 : last] != group[i]
        other = i + 1 + np.flatnonzero(open_pair)
        if not len(other):
            continue
        need = -(-percent * (n[other] + n[i]) // (100 + percent))
        apart = signs[other]
        most = np.minimum(m[i] - np.bitwise_count(signs[i] & ~apart).sum(1, dtype=np.int64), m[other] - np.bitwise_count(apart & ~signs[i]).sum(1, dtype=np.int64))
        other, need = other[most >= need], need[most >= need]
        if not len(other):
            continue
        shared = shared_counts(sets[i], [sets[j] for j in other])
        for j, common in zip(other[shared >= need], shared[shared >= need], strict=True):
            if every or group[j] != group[i]:
                links.append((int(name[i]), int(name[j]), int(common)))
                group[group == group[j]] = group[i]
    return links


def _compare(percent: int, every: bool):
    """All rows of some tiles to links."""

    def task(batches):
        tiles: dict[int, list] = {}
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                tiles.setdefault(row[0], []).append(row[1:])
        for rows in tiles.values():
            if len(rows) > 1:
                side, name, n, grams = zip(*rows, strict=True)
                found = tile_links(np.array(side), np.array(name), np.array(n), [np.frombuffer(g, np.uint64) for g in grams], percent, every)
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found, strict=True)], ["a", "b", "shared"])

    return task


def _classes_and_links(docs: DataFrame, words: int, percent: int, every: bool, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """``(doc_id, n_shingles, class, text_hash)`` of each row, and ``(a, b, shared)`` of linked classes."""
    spark = docs.sparkSession
    parts = shuffle_partitions(spark)
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text")).withColumn("hash", F.xxhash64("text"))
    dealt = rows.mapInArrow(_hash_texts(4 * parts, words), _MOVED).repartition(parts, "part")
    back = dealt.mapInArrow(_count, _MOVED).repartition(parts, "block")
    sets = stored(back.mapInArrow(_sets(percent), _SETS), "sets")
    active = stored(sets.filter("grams IS NOT NULL").dropDuplicates(["class"]), "active")
    shared = active.select("class", F.explode("prefix").alias("gram"))
    first = shared.groupBy("gram").agg(F.min("class").alias("first"), F.count(F.lit(1)).alias("k")).filter("k > 1")
    blocks = components(shared.join(first, "gram").select(F.col("first").alias("a"), F.col("class").alias("b")).distinct())
    placed = active.select("class", "n", "grams").join(blocks.withColumnRenamed("node", "class"), "class")
    tiles = _tiled(placed, percent).select("tile", "side", "class", "n", "grams").repartition(parts, "tile")
    links = tiles.mapInArrow(_compare(percent, every), "a bigint, b bigint, shared bigint")
    members = sets.filter("grams IS NULL").select("doc_id", F.col("n").cast("bigint").alias("n_shingles"), "class", "text_hash")
    return members, links


def linked_pairs(docs: DataFrame, words: int = 5, percent: int = 75, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """The join itself: ``members (doc_id, n_shingles, class, text_hash)`` and ``links (a, b, shared, similarity)``.

    A class is a set of n-grams, and every row has one (null where it has none); equal sets
    are one class and need no link. ``links`` has every pair of different classes, ``a``
    below ``b``, whose intersection is ``percent`` hundredths of their union or more, with
    the size of the intersection. See ``linked_components`` for sets, nulls and repeats.
    """
    members, links = _classes_and_links(docs, words, percent, True, id_col, text_col)
    members = stored(members.withColumn("class", F.when(F.col("n_shingles") > 0, F.col("class"))), "members")
    sizes = members.filter("class IS NOT NULL").groupBy("class").agg(F.max("n_shingles").alias("n"))
    links = links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "shared").distinct()
    for side in ("a", "b"):
        links = links.join(sizes.select(F.col("class").alias(side), F.col("n").alias(f"n_{side}")), side)
    similarity = F.col("shared") / (F.col("n_a") + F.col("n_b") - F.col("shared"))
    return members, links.select("a", "b", "shared", similarity.alias("similarity"))


def linked_components(docs: DataFrame, words: int = 5, percent: int = 75, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_shingles, component_id, text_hash, first)`` for each row.

    Words are runs of bytes other than white space, A-Z in lower case. A set has the
    distinct runs of ``words`` words; a shorter text has its whole sequence as one; a text
    without words, or a null one, has none and is linked with nothing. Two documents link
    when the sizes of intersection and union are ``percent`` to 100 or more. The
    component's id is the smallest document id that links reach.

    N-grams are compared by 40 bits and the part they are dealt to, classes by 64 bits.
    Equal sets, also of repeated rows or of rows with equal ids, are linked. A row without
    an id is placed with its links, never names a component, and has none of its own.
    ``text_hash`` is ``xxhash64`` of the text; ``first`` marks the rows of a component with
    the smallest id and, of those, the smallest hash, rows without an id last: one document,
    as often as its row is given. Other columns are not read.
    """
    members, links = _classes_and_links(docs, words, percent, False, id_col, text_col)
    groups = components(links.select("a", "b"))
    some = members.filter("n_shingles > 0").join(groups.withColumnRenamed("node", "class"), "class", "left")
    some = some.withColumn("root", F.coalesce("root", "class"))
    place = F.struct(F.col("doc_id").isNull().alias("lost"), "doc_id", "text_hash")
    least = some.groupBy("root").agg(F.min(place).alias("least"))
    some = some.join(least, "root").select("doc_id", "n_shingles", F.col("least.doc_id").alias("component_id"), "text_hash", place.eqNullSafe(F.col("least")).alias("first"))
    lone = members.filter("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"), "text_hash", F.lit(True).alias("first"))
    return some.unionByName(lone)
