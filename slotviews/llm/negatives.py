"""Hard negatives: threshold joins of anchors with all rows, lowered until windows are full."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slotviews.llm.common import stored, whole

#: rows and anchors that meet in one group of a task, at most about
TILE_ROWS, BLOCK_ANCHORS = 65_536, 16_384
#: least number of tiles, so that small tables use many tasks
LEAST_TILES = 48
#: dimensions that an index adds at a time
CHUNK = 8
#: rows and anchors of one array of partial scores
SLAB, GROUP = 8192, 256
FOUND = "anchor_id bigint, anchor_key bigint, slot int, vec_id bigint, key bigint, score bigint"


class Index:
    """Rows by dimension, without the dimensions that norms of the rest cover.

    Dimensions stand by falling weight and are added in chunks. A row is listed in a chunk
    while the norm of its components from that chunk on, times the largest such norm of the
    anchors, reaches the lowest threshold; where it does not, what is left out cannot lift
    any score to the threshold by itself. Rows stand by the number of their chunks, so the
    list of a chunk is a prefix. A row in no list meets no anchor.
    """

    def __init__(self, rows: np.ndarray):
        self.order = np.argsort(-(rows.astype(np.float64) ** 2).sum(0), kind="stable")
        self.exact_rows, self.rows = rows, rows[:, self.order].astype(np.float64)
        self.bounds = [*range(0, rows.shape[1], CHUNK), rows.shape[1]]
        self.tails = self.norms(self.rows)
        self.top = int(np.abs(rows).max(initial=1))

    def norms(self, rows: np.ndarray) -> np.ndarray:
        """Norm of the components from each bound on, a little too large."""
        squares = np.cumsum((rows**2)[:, ::-1], axis=1)[:, ::-1]
        squares = np.concatenate((squares, np.zeros((len(rows), 1))), axis=1)[:, self.bounds]
        return np.sqrt(squares) * (1 + 1e-9)

    def reach(self, anchors: np.ndarray, thresholds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All pairs ``(anchor, row, score)`` whose score is at least the anchor's threshold."""
        sent = anchors[:, self.order].astype(np.float64)
        rests, last = self.norms(sent), len(self.bounds) - 1
        lists = (rests.max(0) * self.tails >= thresholds.min()).cumprod(axis=1)[:, :-1].sum(1)
        # full sums of doubles are exact below 2**53
        whole = self.rows.shape[1] * self.top * max(1, int(np.abs(anchors).max(initial=0))) < 2**53
        doubt = 1e-6 + 1e-12 * rests[:, 0].max() * self.tails[:, 0]
        live = np.argsort(-lists, kind="stable")
        live = live[: int((lists > 0).sum())]
        partial = np.zeros((len(sent), len(live)))
        pairs = []
        for c in range(last):
            if not len(live):
                break
            dims = slice(self.bounds[c], self.bounds[c + 1])
            partial += sent[:, dims] @ self.rows[live, dims].T
            ended = lists[live] == c + 1
            possible = partial + rests[:, c + 1, None] * self.tails[live, c + 1] + doubt[live] >= thresholds[:, None]
            if ended.any():
                a, x = np.nonzero(possible & ended)
                done = c + 1 == last and whole
                pairs.append((a, live[x], partial[a, x].astype(np.int64) if done else self.scores(anchors, a, live[x])))
            stay = possible.any(0) & ~ended
            if not stay.all():
                live, partial, possible = live[stay], partial[:, stay], possible[:, stay]
            if possible.size and possible.sum() * 16 < possible.size:  # few are left: finish them one by one
                a, x = np.nonzero(possible)
                pairs.append((a, live[x], self.scores(anchors, a, live[x])))
                break
        if not pairs:
            return (np.empty(0, np.int64),) * 3
        a, x, score = (np.concatenate(p) for p in zip(*pairs, strict=True))
        keep = score >= thresholds[a]
        return a[keep], x[keep], score[keep]

    def scores(self, anchors: np.ndarray, a: np.ndarray, x: np.ndarray, step: int = 16_384) -> np.ndarray:
        """Exact scores of single pairs."""
        out = [(anchors[a[i : i + step]] * self.exact_rows[x[i : i + step]]).sum(1) for i in range(0, len(a), step)]
        return np.concatenate([np.empty(0, np.int64), *out])


def _first(anchor: np.ndarray, slot: np.ndarray, ids: np.ndarray, keys: np.ndarray, score: np.ndarray, n: int) -> np.ndarray:
    """Places of the first ``n`` of each anchor and slot: higher scores, then smaller ids."""
    order = np.lexsort((keys, ids, -score, slot, anchor))
    a, s = anchor[order], slot[order]
    starts = np.flatnonzero(np.concatenate(([True], (a[1:] != a[:-1]) | (s[1:] != s[:-1])))) if len(order) else order
    nth = np.arange(len(order)) - np.repeat(starts, np.diff(np.append(starts, len(order))))
    return order[nth < n]


def _matrix(column: pa.ChunkedArray, dims: int) -> np.ndarray:
    """Integer rows; missing components at the end are 0."""
    column = column.combine_chunks()
    sizes = np.diff(column.offsets.to_numpy()) if len(column) else np.empty(0, np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(column), dims), np.int64)
    at = np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[np.repeat(np.arange(len(column)), sizes), np.arange(len(flat)) - at] = flat
    return out


def _tile(dims: int, same_label: bool, n: int):
    """What one tile of rows finds for one block of anchors: the first ``n`` of each slot."""

    names = ["anchor_id", "anchor_key", "slot", "vec_id", "key", "score"]
    types = [np.int64, np.int64, np.int32, np.int64, np.int64, np.int64]

    def found(group: pa.Table) -> pa.Table:
        is_anchor = np.array(group.column("is_anchor"))
        split = [group.filter(pa.array(~is_anchor)), group.filter(pa.array(is_anchor))]
        ids, keys, labels = ([np.array(t.column(c)) for t in split] for c in ("vec_id", "key", "label"))
        rows, anchors = (_matrix(t.column("v"), dims) for t in split)
        low, high = split[1].column("low").to_pylist(), split[1].column("high").to_pylist()
        floors = np.array([min(x) for x in low], np.int64)
        order = np.lexsort((floors, labels[1]))
        labelled = labels[1][order]
        cuts = np.flatnonzero(labelled[1:] != labelled[:-1]) + 1 if same_label else []
        groups = [part[i : i + GROUP] for part in np.split(order, cuts) for i in range(0, len(part), GROUP)]
        slabs, out = {}, [tuple(np.empty(0, t) for t in types)]
        for chosen in groups:
            side = labels[1][chosen[0]] if same_label else None
            if side not in slabs:
                if same_label:
                    slabs.clear()  # anchors come by label
                among = np.flatnonzero(labels[0] == side) if same_label else np.arange(len(rows))
                slabs[side] = [(among[i : i + SLAB], Index(rows[among[i : i + SLAB]])) for i in range(0, len(among), SLAB)]
            lows = [(np.array(low[i], np.int64), np.array(high[i], np.int64)) for i in chosen]
            width = max(len(x) for x, _ in lows)
            # slots that an anchor does not have can hold no score
            lo = np.array([np.pad(x, (0, width - len(x)), constant_values=2**62) for x, _ in lows])
            hi = np.array([np.pad(x, (0, width - len(x)), constant_values=-(2**62)) for _, x in lows])
            wanted, best = floors[chosen].copy(), np.empty((0, 4), np.int64)  # anchor, slot, row, score
            for among, index in slabs[side]:
                a, x, score = index.reach(anchors[chosen], wanted)
                x = among[x]
                own = (ids[1][chosen][a] == ids[0][x]) & (keys[1][chosen][a] == keys[0][x])
                fits = ~own if same_label else labels[1][chosen][a] != labels[0][x]
                a, x, score = a[fits], x[fits], score[fits]
                for slot in range(width):
                    inside = (lo[a, slot] <= score) & (score <= hi[a, slot])
                    best = np.concatenate((best, np.stack((a[inside], np.full(inside.sum(), slot), x[inside], score[inside]), 1)))
                best = best[_first(best[:, 0], best[:, 1], ids[0][best[:, 2]], keys[0][best[:, 2]], best[:, 3], n)]
                if width == 1:  # what is full asks for no less than it has
                    full, first = np.bincount(best[:, 0], minlength=len(chosen)) >= n, np.full(len(chosen), 2**62)
                    np.minimum.at(first, best[:, 0], best[:, 3])
                    wanted = np.where(full, np.maximum(wanted, first), wanted)
            a, x = chosen[best[:, 0]], best[:, 2]
            out.append((ids[1][a], keys[1][a], best[:, 1], ids[0][x], keys[0][x], best[:, 3]))
        return pa.table({name: np.concatenate(c).astype(t) for name, t, c in zip(names, types, zip(*out, strict=True), strict=True)})

    return found


class Search:
    """Rows and sizes that all threshold joins of one run share."""

    def __init__(self, rows: DataFrame, is_anchor: Column):
        self.rows = stored(rows, "vectors")
        self.anchors = self.rows.filter(is_anchor)
        size = self.rows.agg(F.count(F.lit(1)), F.count_if(is_anchor), F.max(F.size("v")), F.percentile_approx(_norm(), 0.5, 1000)).first()
        self.n_rows, self.n_anchors, self.dims, self.usual_norm = size[0], size[1], max(1, size[2] or 0), float(size[3] or 0)

    def join(self, asked: DataFrame, same_label: bool, n: int) -> DataFrame:
        """The first ``n`` rows of each slot of ``asked`` anchors (with arrays ``low`` and ``high``).

        Rows are dealt into tiles and anchors into blocks, by hashes of their keys. Every
        block meets every tile in a group of its own, of bounded size; a group returns at
        most ``n`` rows for each anchor and slot.
        """
        tiles = max(LEAST_TILES, -(-self.n_rows // TILE_ROWS))
        blocks = max(1, -(-self.n_anchors // BLOCK_ANCHORS))
        dealt = lambda n: F.pmod(F.xxhash64("vec_id", "key"), F.lit(n)).cast("int")
        every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
        names = ["vec_id", "key", "label", "v"]
        nothing = F.lit(None).cast("array<bigint>")
        rows = self.rows.select(dealt(tiles).alias("tile"), every(blocks).alias("block"), F.lit(False).alias("is_anchor"), *names, nothing.alias("low"), nothing.alias("high"))
        anchors = asked.select(every(tiles).alias("tile"), dealt(blocks).alias("block"), F.lit(True).alias("is_anchor"), *names, "low", "high")
        # the number is stated, as the rows are few bytes for the work they make
        both = rows.unionByName(anchors).repartition(min(tiles * blocks, 20_000), "tile", "block")
        found = both.groupBy("tile", "block").applyInArrow(_tile(self.dims, same_label, n), FOUND)
        place = Window.partitionBy("anchor_id", "anchor_key", "slot").orderBy(F.desc("score"), "vec_id", "key")
        return found.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= n)


def _norm() -> Column:
    return F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x))


#: thresholds of the search for positives, in products of the anchor's norm and the usual one; then none
POSITIVE_LEVELS = (0.5, 0.2, None)
#: thresholds of the search for negatives, in hundredths of the positive's score; then the window's end
NEGATIVE_LEVELS = (85, 70, None)
NO_LIMIT = 2**61


def _lowered(search: Search, ask, levels, same_label: bool, n: int, slots: DataFrame, label: str) -> DataFrame:
    """Joins at falling thresholds until every slot has ``n`` rows or the last level is done.

    ``slots (anchor_id, anchor_key, slot, ...)`` are searched, ``ask(slots, level)`` gives
    their ``low`` and ``high``. A slot that has ``n`` rows at or above a threshold needs no
    lower one, so only the others go on.
    """
    key = ["anchor_id", "anchor_key", "slot"]
    done, rest = None, slots
    for level in levels:
        limits = ask(rest, level).groupBy("anchor_id", "anchor_key").agg(F.sort_array(F.collect_list(F.struct("slot", "low", "high"))).alias("slots"))
        # a slot that is full stays in the arrays as one that nothing fits, so slots keep their numbers
        upto = F.sequence(F.lit(0), F.element_at("slots", -1)["slot"])
        of = lambda i: F.get(F.filter("slots", lambda s: s["slot"] == i), F.lit(0))
        limits = limits.select(F.col("anchor_id").alias("vec_id"), F.col("anchor_key").alias("key"), F.transform(upto, lambda i: F.coalesce(of(i)["low"], F.lit(2**62))).alias("low"), F.transform(upto, lambda i: F.coalesce(of(i)["high"], F.lit(-(2**62)))).alias("high"))
        asked = search.anchors.join(limits, ["vec_id", "key"])
        found = stored(search.join(asked, same_label, n), label)
        if level is not None:
            full = found.groupBy(*key).count().filter(F.col("count") >= n).select(*key)
            part = found.join(full, key, "left_semi")
            rest = stored(rest.join(full, key, "left_anti"), label + "-open")
        else:
            part = found
        done = part if done is None else done.unionByName(part)
        if level is None or rest.isEmpty():
            return done
    return done


def hard_negatives(rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 3, window: tuple[int, int] = (50, 95)) -> DataFrame:
    """For each anchor and each of its first positives, the first negatives within a window of scores.

    ``rows (vec_id, label, v)`` are integer vectors, scores their inner products; higher
    scores come first, then smaller ids. An anchor's positives are its first ``positives``
    other rows of its label. A negative has another label and a score of ``window``
    hundredths of the positive's score: with 50 and 95, a positive score p asks for scores
    from p/2 to 0.95 p, both inclusive. A positive score of 0 asks for 0, a negative one for
    nothing. Returns ``anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score`` with ranks from 1.

    Both searches are joins above a threshold (``Index``) that starts high and falls for the
    anchors whose windows are not full yet; the last level is the window's true end, so the
    result is exact. Anchors and rows meet in groups of bounded size (``Search.join``),
    whatever the labels: a label that all rows have is dealt like any other.

    Rows with a null id, label, vector or component take no part, nor do those with a
    component beyond ``common.LARGEST``, whose scores may not fit into 64 bits. Missing components at
    the end of a shorter vector are 0. Rows that repeat throughout count once; rows with
    equal ids and different labels or vectors are rows of their own, and such an anchor
    counts as often. Ties of equal ids go by hash. Other columns are not read.
    """
    usable = rows.filter("vec_id IS NOT NULL AND label IS NOT NULL").filter(whole(F.col("v")))
    usable = usable.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("label").cast("bigint").alias("label"), F.col("v").cast("array<int>").alias("v")).distinct()
    search = Search(usable.withColumn("key", F.xxhash64("label", "v")), is_anchor)

    def above(slots: DataFrame, level: float | None) -> DataFrame:
        low = F.lit(-NO_LIMIT) if level is None else F.ceil(F.lit(level * search.usual_norm) * F.col("norm"))
        return slots.withColumns({"low": low.cast("bigint"), "high": F.lit(NO_LIMIT)})

    anchors = search.anchors.select(F.col("vec_id").alias("anchor_id"), F.col("key").alias("anchor_key"), F.lit(0).alias("slot"), _norm().alias("norm"))
    near = stored(_lowered(search, above, POSITIVE_LEVELS, True, positives, anchors, "positives"), "positive-rows")

    def inside(slots: DataFrame, level: int | None) -> DataFrame:
        p = F.col("positive_score")
        exact = lambda percent: p.cast("decimal(20,0)") * percent / F.lit(100).cast("decimal(3,0)")
        share = lambda percent: F.ceil(exact(percent)).cast("bigint")
        low, high = share(window[0]), F.floor(exact(window[1])).cast("bigint")
        return slots.withColumns({"low": low if level is None else F.greatest(low, share(level)), "high": high})

    wanted = near.select("anchor_id", "anchor_key", (F.col("rank") - 1).alias("slot"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    windows = stored(wanted.filter("positive_score >= 0"), "windows")
    far = _lowered(search, inside, NEGATIVE_LEVELS, False, negatives, windows, "negatives")
    far = far.select("anchor_id", "anchor_key", "slot", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    return windows.join(far, ["anchor_id", "anchor_key", "slot"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
