"""What several operators share: stored tables, text batches, word hashes, order, components."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from slotviews.session import scratch_path

SLICE_BYTES = 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Writes the rows under the shared checkpoint folder and reads them back.

    Cuts the lineage: a lost executor costs no recomputation of what stands before.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def forget(spark: SparkSession, path: str) -> None:
    """Removes a folder of ``scratch_path`` that nothing reads any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def sent(spark: SparkSession, value) -> Broadcast:
    """A broadcast whose bytes carry the value's code along; ``pickle.loads`` restores it."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(value))


# ---------------------------------------------------------------- columns


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once, also where lambdas repeat it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def unused(df: DataFrame, name: str) -> str:
    """``name``, with underscores until no column is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("bigint"), lambda a, x: a + x)


def running(lengths: Column, chunk: int = 256) -> Column:
    """Sums of an array from its start up to each element.

    The sums before every ``chunk`` elements are computed first, so a long array does not
    cost its square.
    """

    def within(lengths: Column) -> Column:
        chunks = F.sequence(F.lit(0), F.floor(F.size(lengths) / chunk).cast("int"))
        sums = F.transform(chunks, lambda c: total(F.slice(lengths, c * chunk + 1, F.lit(chunk))))
        bases = let(sums, lambda s: F.transform(s, lambda _, c: total(F.slice(s, F.lit(1), c))))

        def upto(bases: Column) -> Column:
            own = lambda i: F.floor(i / chunk).cast("int")
            return F.transform(lengths, lambda _, i: F.get(bases, own(i)) + total(F.slice(lengths, own(i) * chunk + 1, i % chunk + 1)))

        return let(bases, upto)

    return let(lengths, within)


def running_max(values: Column, chunk: int = 256) -> Column:
    """Largest value of an array from its start up to each element, in the way of ``running``."""

    def within(values: Column) -> Column:
        chunks = F.sequence(F.lit(0), F.floor(F.size(values) / chunk).cast("int"))
        tops = F.transform(chunks, lambda c: F.array_max(F.slice(values, c * chunk + 1, F.lit(chunk))))
        bases = let(tops, lambda t: F.transform(t, lambda _, c: F.array_max(F.slice(t, F.lit(1), c))))
        own = lambda i: F.floor(i / chunk).cast("int")
        return let(bases, lambda b: F.transform(values, lambda _, i: F.greatest(F.get(b, own(i)), F.array_max(F.slice(values, own(i) * chunk + 1, i % chunk + 1)))))

    return let(values, within)


PIECE = 4096


def pieces(text: Column) -> Column:
    """A text in pieces of PIECE characters, for ``cut``."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))


def cut(pieces: Column, start: Column, end: Column) -> Column:
    """Characters ``start`` to ``end`` of a text in pieces; a substring would walk from the text's start each time."""
    first = F.floor(start / PIECE).cast("int")
    near = F.array_join(F.slice(pieces, first + 1, F.floor(end / PIECE).cast("int") - first + 1), "")
    return F.substring(near, (start % PIECE + 1).cast("int"), (end - start).cast("int"))


#: with larger components a sum of squares or products of 64 of them could leave 64 bits
LARGEST = 2**27


def scaled(vector: Column, scale: int) -> Column:
    """The floor of ``scale`` times each component; null where that is no integer up to LARGEST."""
    of = lambda x: x.cast("double") * scale
    return F.transform(vector, lambda x: F.when(F.abs(of(x)) <= LARGEST, F.floor(of(x))))


def whole(vector: Column) -> Column:
    """Whether an array is there and all its components are integers up to LARGEST."""
    return F.coalesce(F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) <= LARGEST)), F.lit(False))


# ---------------------------------------------------------------- texts in tasks


def text_slices(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Rows ``first`` to ``last`` with their bytes and offsets, about SLICE_BYTES at a time.

    A longer text makes a slice of its own. A null text is an empty one.
    """
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    if not len(column):
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(offsets, offsets[first] + SLICE_BYTES, "right")) - 1
        last = min(max(last, first + 1), len(column))
        yield first, last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit integers, one to one."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_BASE = 0x5851F42D4C957F2D
_BACK = pow(_BASE, -1, 2**64)


class Powers:
    """base**0 … base**(n-1) modulo 2**64, remembered in each task."""

    def __init__(self):
        self.known: dict[int, np.ndarray] = {}

    def __reduce__(self):
        return Powers, ()

    def __call__(self, base: int, n: int) -> np.ndarray:
        if base not in self.known or len(self.known[base]) < n:
            row = np.full(max(n, SLICE_BYTES + SLICE_BYTES // 4), base, np.uint64)
            row[0] = 1
            self.known[base] = np.cumprod(row, dtype=np.uint64)
        return self.known[base][:n]


powers = Powers()


class Hashed:
    """Polynomial prefix hashes of bytes: the hash of any substring in constant time."""

    def __init__(self, data: np.ndarray):
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE[data] * powers(_BASE, len(data)), out=self.sums[1:])
        self.back = powers(_BACK, len(data) + 1)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.back[start] + (end - start).astype(np.uint64))


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)


def byte_set(*ranges: tuple[int, int]) -> np.ndarray:
    inside = np.zeros(256, bool)
    for low, high in ranges:
        inside[low : high + 1] = True
    return inside


#: space and the control characters that count as white space
SPACES = byte_set((0x20, 0x20), (0x09, 0x0D))
#: everything below 128 that is neither a letter nor a digit
NOT_WORD = ~byte_set((48, 57), (65, 90), (97, 122), (128, 255))


class Words:
    """Words of a slice of texts: starts, ends, hashes, and each text's first word."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, between: np.ndarray = SPACES):
        data = lower_ascii(data)
        gap = between[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True  # a text's first byte can start a word, whatever stands before
        inside = ~gap
        before = np.concatenate(([False], inside[:-1]))[: len(data)]
        after = np.concatenate((inside[1:], [False]))[: len(data)]
        self.start = np.flatnonzero(inside & (~before | edge[:-1]))
        self.end = np.flatnonzero(inside & (~after | edge[1:])) + 1
        self.hash = Hashed(data).of(self.start, self.end)
        self.first = np.searchsorted(self.start, offsets)  # of each text, and the end

    def shingles(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of n words in a row, by first word; and for each text their bounds.

        A text of fewer words has its whole sequence as one; a text without words none.
        """
        counts = np.diff(self.first)
        k = np.where(counts == 0, 0, np.maximum(counts - n + 1, 1))
        bounds = np.concatenate(([0], np.cumsum(k)))
        doc = np.repeat(np.arange(len(counts)), k)
        at = self.first[:-1][doc] + (np.arange(bounds[-1]) - bounds[:-1][doc])
        padded = np.concatenate((self.hash, np.zeros(n, np.uint64)))
        out = np.zeros(len(at), np.uint64)
        for i in range(n):
            out += np.where(i < counts[doc], padded[at + i], np.uint64(0)) * np.uint64(pow(_BASE, i + 1, 2**64))
        return mix(out + np.minimum(counts, n).astype(np.uint64)[doc]), bounds


# ---------------------------------------------------------------- order


def with_next(df: DataFrame, id_col: str, columns: list[str], block_rows: int = 4096, derive: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Adds ``next_<c>`` of the row with the next larger id; after the last comes the first.

    Ids are cut into blocks of about ``block_rows`` rows and each block is ordered by
    itself; it borrows the first row of the block behind it. Rows without an id come
    first; equal ids are ordered by ``columns``. ``derive`` adds columns to each row once.
    """
    low, high, rows = df.agg(F.min(id_col), F.max(id_col), F.count(F.lit(1))).first()
    width = max(1, -(-((high or 0) - (low or 0) + 1) * block_rows // max(rows, 1)))
    block = F.coalesce(F.floor((F.col(id_col) - F.lit(low or 0)) / F.lit(width)).cast("bigint"), F.lit(-1))
    rows_in = df.withColumn("__next_block", block)
    # one row a block: the window over all of them orders a few thousandths of the rows
    heads = rows_in.groupBy("__next_block").agg(F.min(id_col).alias("__next_head"))
    order = Window.orderBy("__next_block")
    heads = heads.select("__next_head", F.lag("__next_block").over(order).alias("__next_into"), F.max("__next_block").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("__next_last"))
    heads = heads.select("__next_head", F.coalesce("__next_into", "__next_last").alias("__next_into"))
    if rows / block_rows * 16 < 64_000_000:
        heads = F.broadcast(heads)
    borrowed = df.join(heads, df[id_col].eqNullSafe(heads["__next_head"])).select(*[df[c] for c in df.columns], F.col("__next_into").alias("__next_block"), F.lit(1).alias("__next_ghost"))
    both = rows_in.withColumn("__next_ghost", F.lit(0)).unionByName(borrowed)
    both = derive(both) if derive else both
    window = Window.partitionBy("__next_block").orderBy("__next_ghost", F.col(id_col).asc_nulls_first(), *columns)
    leads = {f"next_{c}": F.lead(c).over(window) for c in columns}
    return both.withColumns(leads).filter("__next_ghost = 0").drop("__next_block", "__next_ghost")


# ---------------------------------------------------------------- components


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for the nodes of undirected ``(a, b)`` edges; root is the smallest node.

    Rounds of two steps until nothing changes: every node links its larger neighbours to
    its smallest one, then its smaller neighbours and itself to the smallest. A round
    costs two aggregates; the number of rounds grows with the logarithm of a chain. A
    node's neighbours are never collected, they meet only their minimum.
    """
    edges = stored(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    seen = None
    while True:
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        edges = stored(small.select("e.*").filter("u <> v").distinct(), "edges")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(edges.select("v", "v").distinct())
        seen = now
