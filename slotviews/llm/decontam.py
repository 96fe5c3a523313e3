"""Benchmark passages in documents: SimHash windows, Hamming blocks, exact verification."""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotviews.llm.common import NOT_WORD, Words, mix, sent, text_slices

#: text of the items that one pass over the documents takes along; more items, more passes
ITEM_BYTES = 32_000_000
BITS, BLOCKS = 64, 8
#: two bags of similarity 0.75 differ in at most 11 of 64 bits on average, 3 of deviation
RADIUS = 23
NEAR = RADIUS // BLOCKS  # within the radius, one of the blocks differs by this at most

_COPY = np.uint64(0x9E3779B97F4A7C15)

HITS = "doc_id bigint, text_hash bigint, item_id bigint, similarity double, distance int, start bigint, end bigint"


class Shingled:
    """Shingles of texts with weights: the number of bytes of their words."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, words: int):
        self.words = Words(data, offsets, NOT_WORD)
        self.grams, self.bounds = self.words.shingles(words)
        counts = np.diff(self.words.first)
        docs = np.repeat(np.arange(len(counts)), np.diff(self.bounds))
        self.at = self.words.first[:-1][docs] + np.arange(len(self.grams)) - self.bounds[:-1][docs]
        sums = np.concatenate(([0], np.cumsum(self.words.end - self.words.start)))
        self.weights = sums[self.at + np.minimum(counts[docs], words)] - sums[self.at]


def signs(grams: np.ndarray, weights: np.ndarray, copies: np.ndarray) -> np.ndarray:
    """For each shingle the root of its weight, added or taken away by the bits of its hash.

    With roots, and a hash of its own for each further copy of a shingle, the angle between
    two sums follows from the similarity of the bags, whatever single weights are. Roots are
    whole 1/256, so that sums do not depend on their order.
    """
    bits = np.unpackbits(mix(grams + copies.astype(np.uint64) * _COPY).view(np.uint8).reshape(-1, 8), axis=1)
    roots = np.rint(256 * np.sqrt(weights)).astype(np.int64)[:, None]
    return np.where(bits, roots, -roots)


def copies(grams: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """How many equal shingles stand before each one in the window that it ends, and behind it in the one it starts."""
    order = np.argsort(grams, kind="stable")
    edge = np.ones(len(grams), bool)
    edge[1:] = grams[order][1:] != grams[order][:-1]
    none = np.zeros(len(grams), np.int64)
    if edge.all():
        return none, none
    # equal shingles are neighbours here, in the order of the text
    key, rank = np.cumsum(edge) * (len(grams) + size + 1) + order + size, np.arange(len(grams))
    before, behind = none, none.copy()
    before[order] = rank - np.searchsorted(key, np.maximum(key - size + 1, key - order))
    behind[order] = np.searchsorted(key, np.minimum(key + size, key - order + len(grams))) - rank - 1
    return before, behind


def windows(grams: np.ndarray, weights: np.ndarray, size: int) -> np.ndarray:
    """Sums of signs of each window of ``size`` shingles."""
    before, behind = copies(grams, size)
    come = np.zeros((len(grams) + 1, BITS), np.int64)
    np.cumsum(signs(grams, weights, before), axis=0, out=come[1:])
    gone = come
    if before.any():
        gone = np.zeros_like(come)
        np.cumsum(signs(grams, weights, behind), axis=0, out=gone[1:])
    return come[size:] - gone[: len(gone) - size]


def simhash(sums: np.ndarray) -> np.ndarray:
    return np.packbits(sums > 0, axis=-1).reshape(-1, BITS // 8)


def similarity(a: np.ndarray, wa: np.ndarray, b: np.ndarray, wb: np.ndarray) -> tuple[int, int]:
    """Weights of the intersection and of the union of two bags of shingles."""
    grams = np.concatenate((a, b))
    weights, side = np.concatenate((wa, wb)), np.repeat([0, 1], [len(a), len(b)])
    names, inverse = np.unique(grams, return_inverse=True)
    counts = np.zeros((2, len(names)), np.int64)
    np.add.at(counts, (side, inverse), 1)
    weight = np.zeros(len(names), np.int64)
    weight[inverse] = weights
    return int((counts.min(0) * weight).sum()), int((counts.max(0) * weight).sum())


class Items:
    """A block of benchmark items: their shingles, and for each length an index of SimHash blocks."""

    def __init__(self, ids: list, texts: list[str], words: int):
        encoded = [t.encode() for t in texts]
        offsets = np.concatenate(([0], np.cumsum([len(t) for t in encoded], dtype=np.int64)))
        s = Shingled(np.frombuffer(b"".join(encoded), np.uint8), offsets, words)
        self.ids, self.words = ids, words
        self.length = np.diff(s.words.first)
        self.own = [(s.grams[a:b], s.weights[a:b]) for a, b in zip(s.bounds[:-1], s.bounds[1:], strict=True)]
        self.hashes = np.concatenate([simhash(windows(g, w, len(g))) for g, w in self.own] or [np.empty((0, 8), np.uint8)])
        owner = np.repeat(np.arange(len(ids)), [len(g) for g, _ in self.own])
        pairs = np.unique(np.stack((s.grams, self.length[owner].astype(np.uint64)), 1), axis=0)
        self.seeds, self.seed_length = np.ascontiguousarray(pairs[:, 0]), pairs[:, 1].astype(np.int64)
        self.may = np.zeros(1 << 22, bool)
        self.may[self.seeds & np.uint64(self.may.size - 1)] = True
        short = np.flatnonzero((self.length > 0) & (self.length < words))
        self.short: dict[int, dict[int, list[int]]] = {}
        for item in short.tolist():
            self.short.setdefault(int(self.length[item]), {}).setdefault(int(self.own[item][0][0]), []).append(item)
        self.tables = {int(n): self._table(np.flatnonzero(self.length == n)) for n in np.unique(self.length) if n}

    def _table(self, items: np.ndarray) -> list[list[np.ndarray]]:
        """For each block and value, the items whose block is near."""
        apart = np.bitwise_count(np.arange(256, dtype=np.uint8)[:, None, None] ^ self.hashes[items][None])
        return [[items[apart[value, :, block] <= NEAR] for value in range(256)] for block in range(BLOCKS)]

    def near(self, length: int, hashes: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each window the items of its length within the radius, and how far they are."""
        table = self.tables[length]
        for window, value in enumerate(hashes):
            items = np.unique(np.concatenate([table[block][value[block]] for block in range(BLOCKS)]))
            far = np.bitwise_count(self.hashes[items] ^ value).sum(1, dtype=np.int64)
            if (good := far <= RADIUS).any():
                yield window, items[good], far[good]

    def search(self, s: Shingled, doc: int, percent: int) -> Iterator[tuple[int, int, int, float, int]]:
        """Item, first and last word, similarity and distance of each item's best window."""
        a, b = s.bounds[doc : doc + 2]
        grams, weights = s.grams[a:b], s.weights[a:b]
        total = int(s.words.first[doc + 1] - s.words.first[doc])
        at = np.flatnonzero(self.may[grams & np.uint64(self.may.size - 1)])
        left, right = np.searchsorted(self.seeds, grams[at], "left"), np.searchsorted(self.seeds, grams[at], "right")
        lengths = np.concatenate([self.seed_length[i:j] for i, j in zip(left, right, strict=True)] or [np.empty(0, np.int64)])
        seeded = np.repeat(at, right - left)
        for length in np.unique(lengths):
            size = max(min(int(length), total) - self.words + 1, 1)  # shingles of a window
            own = np.unique(seeded[lengths == length])
            reach = np.zeros(len(grams) + 1, np.int64)  # windows that hold a seed
            np.add.at(reach, np.maximum(own - size + 1, 0), 1)
            np.add.at(reach, own + 1, -1)
            starts = np.flatnonzero(np.cumsum(reach)[: len(grams) - size + 1])
            best: dict[int, tuple] = {}
            for part in np.split(starts, np.arange(4096, len(starts), 4096)):
                if not len(part):
                    continue
                low = int(part[0])
                sums = windows(grams[low : part[-1] + size], weights[low : part[-1] + size], size)
                for window, items, far in self.near(int(length), simhash(sums[part - low])):
                    start = int(part[window])
                    for item, distance in zip(items, far, strict=True):
                        both, either = similarity(grams[start : start + size], weights[start : start + size], *self.own[item])
                        if 100 * both >= percent * either and (item not in best or both / either > best[item][2]):
                            best[item] = (start, start + min(int(length), total), both / either, int(distance))
            yield from ((item, *found) for item, found in best.items())


    def short_hits(self, s: Shingled) -> Iterator[tuple[int, int, int, int]]:
        """Text, item, first and last word of the first place of items below ``words`` words.

        Such an item is a single shingle, so a window is equal or has similarity 0. Texts
        below ``words`` words themselves are compared in ``search`` if they are as long.
        """
        for n, items in self.short.items():
            grams, bounds = s.words.shingles(n)
            at = np.flatnonzero(np.isin(grams, np.fromiter(items, np.uint64)))
            docs = np.searchsorted(bounds, at, "right") - 1
            seen = set()
            for doc, place in zip(docs.tolist(), at.tolist(), strict=True):
                start, total = place - int(bounds[doc]), int(s.words.first[doc + 1] - s.words.first[doc])
                for item in items[int(grams[place])]:
                    if total > n and (doc, item) not in seen:
                        seen.add((doc, item))
                        yield doc, item, start, start + n


def benchmark_hits(docs: DataFrame, benchmark: DataFrame, words: int = 5, percent: int = 75, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", short_items: bool = False) -> DataFrame:
    """One row for each document and benchmark item that it holds, with the best window.

    Words are lower case runs of letters, digits and non-ASCII characters. For every item,
    the document's windows of as many words that share a shingle with an item are hashed
    (a window without one has similarity 0). Blocks of the 64-bit SimHash find all items
    within RADIUS bits of a window, and the weighted similarity of both bags of shingles,
    by bytes of words, decides: ``percent`` or more. ``start`` and ``end`` are characters of
    the document; of equally similar windows the first counts. ``text_hash`` is the
    document's ``xxhash64`` and tells rows with equal ids apart.

    An item below ``words`` words is a single shingle. It hits texts of just its words, and
    with ``short_items`` also every longer text that holds them in a row.

    Items travel in blocks of bounded size, one pass over the documents for each block;
    nothing else leaves the tasks. Null and empty texts and items hit nothing. Repeated
    document rows give a row each, repeated items count once. Other columns are not read.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col(item_col).cast("bigint").alias("item_id"), F.col(item_text_col).cast("string").alias("text")).filter("text IS NOT NULL").distinct()
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // ITEM_BYTES))
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = rows.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))

    def task_of(carried):
        def task(batches):
            index, out = pickle.loads(carried.value), []
            for batch in batches:
                ids, hashes = batch.column(0), batch.column(2)
                for first, last, data, offsets in text_slices(batch.column(1)):
                    s = Shingled(data, offsets, index.words)
                    seeded = np.flatnonzero(index.may[s.grams & np.uint64(index.may.size - 1)])
                    seeded = seeded[np.isin(s.grams[seeded], index.seeds)]
                    near = np.unique(np.searchsorted(s.bounds, seeded, "right") - 1)
                    hits = [(doc, *hit) for doc in near for hit in index.search(s, doc, percent)]
                    if short_items:
                        hits += [(*hit, 1.0, 0) for hit in index.short_hits(s)]
                    for doc, item, start, end, share, distance in hits:
                        base = s.words.first[doc]
                        a, b = s.words.start[base + start], s.words.end[base + end - 1]
                        begin = len(data[offsets[doc] : a].tobytes().decode())
                        text = len(data[a:b].tobytes().decode())
                        out.append((ids[first + doc].as_py(), hashes[first + doc].as_py(), index.ids[item], share, distance, begin, begin + text))
                if out:
                    types = [pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.int32(), pa.int64(), pa.int64()]
                    names = [field.split()[0] for field in HITS.split(", ")]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names)
                    out = []

        return task

    found = None
    for block in range(blocks):
        some = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).orderBy("item_id", "text").collect()
        carried = sent(spark, Items([r["item_id"] for r in some], [r["text"] for r in some], words))
        hits = rows.mapInArrow(task_of(carried), HITS)
        found = hits if found is None else found.unionByName(hits)
    return found
