"""k-means over integer vectors, with bounds that geometry keeps tight when centroids move."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotviews.llm.common import forget, scaled, whole
from slotviews.session import scratch_path

STATE = "part string, vec_id bigint, v array<int>, cluster int, distance bigint, lower double, n bigint, scanned bigint, change array<bigint>"


def distances(rows: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows to all centroids."""
    top = max(int(np.abs(rows).max(initial=0)), int(np.abs(centroids).max(initial=0)), 1)
    if 4 * rows.shape[1] * top * top < 2**53:  # every sum is an exact double
        rows, centroids = rows.astype(np.float64), centroids.astype(np.float64)
    square = (rows * rows).sum(1)[:, None] + (centroids * centroids).sum(1)
    return (square - 2 * (rows @ centroids.T)).astype(np.int64)


def scan(rows: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nearest centroid (smallest number first), its squared distance, and a lower bound of the second's distance."""
    nearest, own, lower = [], [], []
    step = max(1, 2_000_000 // len(centroids))
    for at in range(0, len(rows), step):
        all_of = distances(rows[at : at + step], centroids)
        best = all_of.argmin(1)
        nearest.append(best)
        own.append(all_of[np.arange(len(best)), best])
        second = np.partition(all_of, 1, axis=1)[:, 1].astype(np.float64) if len(centroids) > 1 else np.full(len(best), np.inf)
        lower.append(np.sqrt(second) * (1 - 1e-12))
    empty = np.empty(0, np.int64)
    return np.concatenate([empty, *nearest]), np.concatenate([empty, *own]), np.concatenate([empty.astype(float), *lower])


def loosening(old: np.ndarray, new: np.ndarray, radius: np.ndarray) -> np.ndarray:
    """For each cluster, how much nearer any other moved centroid can have come to its vectors.

    A cluster's vectors lie in the ball of its radius around its old centroid m. Take a
    centroid that moves from a to b by a length D, with the midpoint o, and a vector x. The
    points with |x-a| - |x-b| = s form one branch of a hyperbola with foci a and b; it lies
    inside its asymptotes, which leave o at an angle whose cosine to the line a-b is s / D.
    So |x-a| - |x-b| is at most D times the cosine of x's own angle at o (and at most 0
    behind o), and in the plane of m and the line no point of the ball has a smaller angle
    than the tangent from o: the angle of m less arcsin(radius / |m-o|). Only a ball that
    holds o, or is crossed by the line ahead of o, needs the whole drift D.
    """
    old, new = old.astype(np.float64), new.astype(np.float64)
    worst = np.zeros(len(old))
    slack = 1e-9 * max(1.0, float(np.abs(old).max(initial=0)), float(np.abs(new).max(initial=0)))
    for j in range(len(old)):
        axis = new[j] - old[j]
        drift = float(np.sqrt(axis @ axis))
        if not drift:
            continue
        out = old - (old[j] + new[j]) / 2
        far = np.sqrt((out * out).sum(1))
        safe = np.maximum(far, 1e-300)
        angle = np.arccos(np.clip(out @ axis / (safe * drift), -1, 1)) - np.arcsin(np.minimum(1, radius / safe))
        gain = np.where(radius >= far, drift, drift * np.maximum(0, np.cos(np.maximum(0, angle))))
        gain = np.minimum(drift, gain) * (1 + 1e-9) + slack
        gain[j] = 0  # a vector's own centroid is measured exactly
        worst = np.maximum(worst, gain)
    return worst


def _assign(centroids: np.ndarray, loosen: np.ndarray | None):
    """A pass over all vectors; each task ends with its counts, changed sums and distances."""
    k, dims = centroids.shape

    def batch_of(rows: int, **columns) -> pa.RecordBatch:
        types = {"part": pa.string(), "vec_id": pa.int64(), "v": pa.list_(pa.int32()), "cluster": pa.int32(), "distance": pa.int64(), "lower": pa.float64(), "n": pa.int64(), "scanned": pa.int64(), "change": pa.list_(pa.int64())}
        return pa.RecordBatch.from_arrays([columns[c] if c in columns else pa.nulls(rows, t) for c, t in types.items()], names=list(types))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        change, count = np.zeros((k, dims), np.int64), np.zeros(k, np.int64)
        total, widest, scanned = [0] * k, np.zeros(k, np.int64), np.zeros(k, np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            v = batch.column("v")
            rows = v.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dims)
            if loosen is None:
                cluster, own, lower = scan(rows, centroids)
                moved, before = np.arange(len(rows)), None
                open_rows = moved
            else:
                before = batch.column("cluster").to_numpy(zero_copy_only=False)
                cluster, gap = before.astype(np.int64), rows - centroids[before]
                own = (gap * gap).sum(1)
                lower = batch.column("lower").to_numpy(zero_copy_only=False) - loosen[cluster]
                open_rows = np.flatnonzero(np.sqrt(own.astype(np.float64)) * (1 + 1e-12) >= lower)
                cluster[open_rows], own[open_rows], lower[open_rows] = scan(rows[open_rows], centroids)
                moved = np.flatnonzero(cluster != before)
                np.subtract.at(change, before[moved], rows[moved])
            np.add.at(change, cluster[moved], rows[moved])
            count += np.bincount(cluster, minlength=k)
            scanned += np.bincount(cluster[open_rows], minlength=k)
            np.maximum.at(widest, cluster, own)
            part = np.zeros(k, np.int64)
            np.add.at(part, cluster, own)
            total = [a + int(b) for a, b in zip(total, part, strict=True)]
            yield batch_of(len(rows), part=pa.array(["rows"] * len(rows)), vec_id=batch.column("vec_id"), v=v, cluster=pa.array(cluster, pa.int32()), distance=pa.array(own), lower=pa.array(lower))
        for kind, value in (("sums", total), ("widest", widest)):
            extra = {"n": pa.array(count), "scanned": pa.array(scanned), "change": pa.array(list(change), pa.list_(pa.int64()))} if kind == "sums" else {}
            yield batch_of(k, part=pa.array([kind] * k), cluster=pa.array(range(k), pa.int32()), distance=pa.array([int(x) for x in value], pa.int64()), **extra)

    return run


def _totals(spark: SparkSession, path: str, k: int, dims: int):
    """Per cluster: rows, scanned rows, change of the sums, sum and maximum of distances; k rows reach the driver."""
    wide = "decimal(38,0)"
    parts = spark.read.schema(STATE).parquet(path)
    sums = parts.filter("part = 'sums'").groupBy("cluster").agg(F.sum("n"), F.sum("scanned"), F.sum(F.col("distance").cast(wide)), *[F.sum(F.col("change")[i].cast(wide)) for i in range(dims)])
    n, scanned, inertia, change = [0] * k, [0] * k, [0] * k, [[0] * dims for _ in range(k)]
    for row in sums.collect():
        n[row[0]], scanned[row[0]], inertia[row[0]], change[row[0]] = row[1], row[2], int(row[3]), [int(x) for x in row[4:]]
    widest = [0] * k
    for row in parts.filter("part = 'widest'").groupBy("cluster").agg(F.max("distance")).collect():
        widest[row[0]] = row[1]
    return n, scanned, inertia, change, widest


def cluster(vectors: DataFrame, centroids: list[list[int]], rounds: int) -> tuple[DataFrame, list[list[int]], list[dict]]:
    """``(vec_id, cluster, distance)`` of all ``vectors (vec_id, v)``, the final centroids, and figures by pass.

    ``v`` holds integers of at most ``common.LARGEST``, as many in every row as in every centroid. Each
    round assigns all vectors and replaces every centroid that has some by the floor of
    their mean; then vectors are assigned once more. Ties go to the smaller number.

    A vector keeps its cluster and a lower bound of its distance to every other centroid.
    A pass lowers that bound by what ``loosening`` proves for its cluster, measures its own
    centroid exactly, and scans all centroids only where the two leave a doubt; so every
    assignment is that of a full scan. Floating bounds carry a margin, distances are exact.

    Passes write the vectors with their state as Parquet and read the previous pass; nothing
    is shuffled. A task adds up what its vectors change, and only those sums, k rows of the
    table's width, reach the driver. States before the last are removed once they are read.
    The figures hold inertia, rows and scanned rows by cluster. Without vectors there are no
    centroids and no rows.
    """
    if not centroids:
        return vectors.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("bigint").alias("distance")).limit(0), [], []
    spark, k = vectors.sparkSession, len(centroids)
    dims, now, loosen, passes = len(centroids[0]), [list(c) for c in centroids], None, []
    sums, source, before = [[0] * dims for _ in range(k)], vectors.select("vec_id", "v"), None
    for _ in range(rounds + 1):
        path = scratch_path(spark, "assigned")
        source.mapInArrow(_assign(np.array(now, np.int64), loosen), STATE).write.partitionBy("part").parquet(path)
        if before:
            forget(spark, before)
        n, scanned, inertia, change, widest = _totals(spark, path, k, dims)
        passes.append({"n": n, "scanned": scanned, "inertia": inertia})
        sums = [[a + b for a, b in zip(x, y, strict=True)] for x, y in zip(sums, change, strict=True)]
        source, before = spark.read.schema(STATE).parquet(path).filter("part = 'rows'").select("vec_id", "v", "cluster", "distance", "lower"), path
        if len(passes) <= rounds:
            moved = [[s // count for s in row] if count else old for row, count, old in zip(sums, n, now, strict=True)]
            loosen = loosening(np.array(now, np.int64), np.array(moved, np.int64), np.sqrt(np.array(widest, np.float64)) * (1 + 1e-12))
            now = moved
    return source.select("vec_id", "cluster", "distance"), now, passes


def integer_vectors(rows: DataFrame, dims: int, scale: int, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``(vec_id, v)`` with ``v`` the floor of ``scale`` times each component.

    Rows take part whose vector has ``dims`` components, none null or non-finite, and none
    whose integer is beyond ``common.LARGEST``, as its squared distances would not fit into 64 bits.
    """
    v = scaled(F.col(vector_col), scale)
    rows = rows.select(F.col(id_col).cast("bigint").alias("vec_id"), v.alias("v"))
    return rows.filter((F.size("v") == dims) & whole(F.col("v"))).select("vec_id", F.col("v").cast("array<int>").alias("v"))


def seeds(vectors: DataFrame, k: int, salt: str) -> list[list[int]]:
    """The ``k`` vectors with the smallest sha256 of ``salt:vec_id``; rows without an id come last, ties go by vector."""
    drawn = F.sha2(F.concat(F.lit(f"{salt}:"), F.col("vec_id").cast("string")), 256)
    first = vectors.select(drawn.alias("drawn"), "v").orderBy(F.col("drawn").asc_nulls_last(), "v").limit(k)
    return [list(row["v"]) for row in first.collect()]


def with_inertia(assigned: DataFrame, centroids: list[list[int]], passes: list[dict]) -> DataFrame:
    """Adds the sums of distances of its cluster and of all, and the centroid, to each row."""
    inertia = passes[-1]["inertia"] if passes else []
    rows = [(i, inertia[i], sum(inertia), c) for i, c in enumerate(centroids)]
    each = assigned.sparkSession.createDataFrame(rows, "cluster int, cluster_inertia bigint, inertia bigint, centroid array<bigint>")
    return assigned.join(each, "cluster")
