"""Random forests whose trees are grown side by side.

Values are cut into bins, so that a row to learn from is a byte a feature. All rows as bytes are
broadcast, and a task grows some of the trees, each of them over all rows: no tree's counts are
shuffled, and the folds of a cross-validation are grown in one job.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEPTH = 8
#: At most so many bins a feature, and so many rows (by hash) whose values place their edges.
BINS, EDGE_ROWS = 32, 1 << 16
#: More rows than these aren't broadcast (a byte a feature and row).
MATRIX_ROWS = 1 << 24
#: Trees a task, and rows counted at once, so that they stay in a core's cache.
TASK_TREES, SLICE = 25, 1 << 16
#: While there are so many rows a node, they are kept side by side by node and counted node by node.
NODE_ROWS = 1024
_CODES = 2 * BINS
#: A row's codes take 6 bits of a byte each; the other two hold how often it is drawn, less 1.
_CODE, _MOST = _CODES - 1, 256 // _CODES
#: How often a row is drawn, by 16 random bits: the Poisson distribution with mean 1.
_DRAWN = np.searchsorted(np.cumsum([1 / (np.e * float(np.prod(np.arange(1, k + 1)))) for k in range(9)]), (np.arange(1 << 16) + 0.5) / (1 << 16)).astype(np.uint8)


@dataclass(frozen=True)
class Forest:
    """Whole binary trees: at each inner node a bin of `feature` above `cut` goes right. `share`
    is that of label 1 at each end; `weight` what each feature's splits gained, by tree."""

    edges: list[np.ndarray]
    feature: np.ndarray
    cut: np.ndarray
    share: np.ndarray
    weight: np.ndarray

    def scores(self, values: list[np.ndarray]) -> np.ndarray:
        """The mean over the trees of the share of label 1 at each row's end; a list of columns."""
        rows, width = len(values[0]), len(values)
        bins = np.stack([binned(e, v) for e, v in zip(self.edges, values, strict=True)], 1).ravel()
        total, at_once = np.zeros(rows), max(1, SLICE // max(rows, 1))
        inner, ends = self.feature.shape[1], self.share.shape[1]
        place = np.arange(rows) * width
        for t in range(0, len(self.feature), at_once):
            feature, cut, share = (x[t : t + at_once].ravel() for x in (self.feature.astype(np.int64), self.cut, self.share))
            first = np.arange(0, len(feature), inner)[:, None]
            node, step = np.repeat(first, rows, 1), 1 - first
            for _ in range(DEPTH):
                right = bins.take(place + feature.take(node)) > cut.take(node)
                node += node + step
                node += right
            total += share.take(node + (first // inner) * (ends - inner) - inner).sum(0)
        return total / len(self.feature)

    def importances(self) -> np.ndarray:
        """Gains as shares of each tree's, their mean over the trees; they sum to 1 if there is any split."""
        sums = self.weight.sum(1, keepdims=True)
        mean = np.divide(self.weight, sums, out=np.zeros_like(self.weight), where=sums > 0).mean(0)
        return mean / (mean.sum() or 1)


def binned(edges: np.ndarray, values: np.ndarray) -> np.ndarray:
    """How many edges lie below each value; no number lies above all."""
    return np.searchsorted(edges, values).astype(np.uint8)


def edges_of(values: np.ndarray) -> np.ndarray:
    """At most BINS - 1 edges, halfway between neighbouring values: all of these, or those that part about as many rows each."""
    known, counts = np.unique(values, return_counts=True)
    middle = known[:-1] + (known[1:] - known[:-1]) / 2
    if len(known) > BINS:
        upto = np.cumsum(counts)
        middle = middle[np.unique(np.searchsorted(upto, len(values) * np.arange(1, BINS) / BINS).clip(0, len(middle) - 1))]
    return middle


def grown(codes: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(feature, cut, share, weight) of a tree on rows of 2 * bin + label for each feature.

    Each row is drawn by a Poisson distribution; both labels weigh the same before that. Of the
    splits on a root's share of the features, drawn anew for each node, the one with the least Gini
    impurity is taken, if it is less than before.
    """
    n, width = codes.shape
    ones = np.count_nonzero(codes[:, 0] & 1)
    side = 1 / max(n - ones, 1), 1 / max(ones, 1)
    tried = int(np.ceil(np.sqrt(width)))
    feature, cut, weight = np.zeros((1 << DEPTH) - 1, np.uint8), np.full((1 << DEPTH) - 1, 255, np.uint8), np.zeros(width)
    share = np.zeros(1 << DEPTH)
    drawn = _DRAWN.take(rng.integers(0, 1 << 16, n, np.uint16))
    if not drawn.any():
        drawn = np.ones(n, np.uint8)
    rows, open_ = _drawn_rows(codes, drawn), np.ones(1, bool)
    place, bounds = np.arange(min(len(rows), SLICE)) * rows.shape[1], [0, len(rows)]
    for level in range(DEPTH):
        nodes = 1 << level
        i = np.arange(nodes)
        some = np.ascontiguousarray(rng.random((nodes, width)).argsort(1)[:, :tried].T)
        if bounds and len(rows) < nodes * NODE_ROWS:
            at, times = np.repeat(i.astype(np.uint8), np.diff(bounds)), (rows[:, 0] // _CODES + 1).astype(float)
            rows, bounds = rows & np.uint8(_CODE), None
        if bounds:
            counts = _node_counts(rows, bounds, some)
        else:
            counts = np.zeros((tried, nodes * _CODES))
            for a in range(0, len(rows), SLICE):
                flat, node, w = rows[a : a + SLICE].ravel(), at[a : a + SLICE].astype(np.int64), times[a : a + SLICE]
                here, first = place[: len(node)], node * _CODES
                for j in range(tried):
                    counts[j] += np.bincount(first + flat.take(here + some[j].take(node)), w, nodes * _CODES)
        # By label: what lies left of each cut, the whole node, and what lies right.
        parts = counts.reshape(tried, nodes, BINS, 2)
        l0, l1 = (np.cumsum(parts[..., c] * side[c], 2) for c in (0, 1))
        w0, w1 = l0[0, :, -1], l1[0, :, -1]
        r0, r1 = w0[:, None] - l0, w1[:, None] - l1
        least = 0.5 * min(side)
        l, r = l0 + l1, r0 + r1
        score = np.where((l > least) & (r > least), (l0 * l0 + l1 * l1) / np.maximum(l, least) + (r0 * r0 + r1 * r1) / np.maximum(r, least), -1)
        score = score.transpose(1, 0, 2).reshape(nodes, -1)
        best = score.argmax(1)
        j, b = best // BINS, best % BINS
        before = (w0 * w0 + w1 * w1) / np.maximum(w0 + w1, least)
        gain = score[i, best] - before
        split = open_ & (gain > 1e-9 * before)
        own, won = some[j, i], np.flatnonzero(split)
        feature[nodes - 1 + won], cut[nodes - 1 + won] = own[won], b[won]
        np.add.at(weight, own[won], gain[won])
        # A node without a split goes left all the way down.
        span = 1 << (DEPTH - level)
        if not level:
            share[0] = w1[0] / (w0[0] + w1[0])
        at_best = j[won], won, b[won]
        share[won * span], share[won * span + span // 2] = l1[at_best] / l[at_best], r1[at_best] / r[at_best]
        if not len(won) or level == DEPTH - 1:
            break
        open_ = np.repeat(split, 2)
        if bounds:
            rows, bounds = _parted(rows, bounds, split, own, 2 * b + 1)
            continue
        if np.count_nonzero(split.take(at)) < len(at) * 7 // 8:
            stay = np.flatnonzero(split.take(at))
            rows, times, at = rows.take(stay, 0), times.take(stay), at.take(stay)
        limit, after = np.where(split, 2 * b + 1, 255), np.empty_like(at)
        for a in range(0, len(rows), SLICE):
            node = at[a : a + SLICE].astype(np.int64)
            after[a : a + SLICE] = 2 * node + (rows[a : a + SLICE].ravel().take(place[: len(node)] + own.take(node)) > limit.take(node))
        at = after
    return feature, cut, share, weight


def _drawn_rows(codes: np.ndarray, drawn: np.ndarray) -> np.ndarray:
    """The rows that are drawn, with how often in the upper bits of each byte; those drawn more often than these hold are there again.

    Rows are as wide as a whole number of words, which are copied fastest.
    """
    kept, parts = np.flatnonzero(drawn), []
    while len(kept):
        times = drawn.take(kept)
        rows = codes.take(kept, 0)
        if odd := rows.shape[1] % 8:
            rows = np.pad(rows, ((0, 0), (0, 8 - odd)))
        rows.view(np.uint64)[...] |= _TIMES.take(times)[:, None]
        parts.append(rows)
        more = times > _MOST
        kept = kept[more]
        drawn[kept] -= _MOST
    return parts[0] if len(parts) == 1 else np.concatenate(parts)


#: By how often a row is drawn, the upper bits of every byte of a word.
_TIMES = np.array([min(max(t - 1, 0), _MOST - 1) * int.from_bytes(bytes([_CODES] * 8), "little") for t in range(256)], np.uint64)


def _node_counts(rows: np.ndarray, bounds: list[int], some: np.ndarray) -> np.ndarray:
    """For each of `some` features of each node the rows by code, as often as they are drawn."""
    found = np.zeros((*some.shape, 256), np.int64)
    for i, tried in enumerate(some.T.tolist()):
        if bounds[i] < bounds[i + 1]:
            here = rows[bounds[i] : bounds[i + 1]]
            for j, f in enumerate(tried):
                found[j, i] = np.bincount(here[:, f], minlength=256)
    by_times = found.reshape(*some.shape, _MOST, _CODES)
    return sum(by_times[:, :, t] * (t + 1.0) for t in range(_MOST)).reshape(len(some), -1)


def _parted(rows: np.ndarray, bounds: list[int], split: np.ndarray, own: np.ndarray, limit: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """The rows of the nodes below, side by side; those of nodes without a split are left out."""
    parts, upto = [], [0]
    for i, (divided, f, most) in enumerate(zip(split.tolist(), own.tolist(), limit.tolist(), strict=True)):
        if not divided:
            upto += [upto[-1]] * 2
            continue
        here = rows[bounds[i] : bounds[i + 1]]
        right = (here[:, f] & np.uint8(_CODE)) > most
        parts += [here.take(np.flatnonzero(side), 0) for side in (~right, right)]
        upto += [upto[-1] + len(parts[-2]), upto[-1] + len(here)]
    return np.concatenate(parts), upto


def matrix(usable: DataFrame, features: Sequence[str], label: str, fold: str | None) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """(edges, codes, folds) of the rows, in an order that only hangs on what they hold. Runs two jobs."""
    features, cols = list(features), [F.col(f).cast("double").alias(f"f{i}") for i, f in enumerate(features)]
    numbers = usable.select(*cols, F.col(label).cast("int").alias("label"), (F.col(fold) if fold else F.lit(0)).cast("int").alias("fold"))
    names = [f"f{i}" for i in range(len(features))]
    numbers = numbers.dropna(subset=names)
    edge_rows = numbers.orderBy(F.xxhash64(*names, "label", "fold")).limit(EDGE_ROWS).select(*names).toArrow()
    edges = [edges_of(edge_rows[n].to_numpy()) for n in names]

    def coded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            bins = np.stack([binned(e, b[n].to_numpy()) for e, n in zip(edges, names, strict=True)], 1)
            codes = bins * np.uint8(2) + b["label"].to_numpy(np.uint8)[:, None]
            yield pd.DataFrame({"codes": [codes.tobytes()], "folds": [b["fold"].to_numpy(np.int32).tobytes()]})

    blocks = numbers.mapInPandas(coded, "codes binary, folds binary").collect()
    codes = np.frombuffer(b"".join(bytes(b.codes) for b in blocks), np.uint8).reshape(-1, len(names))
    folds = np.frombuffer(b"".join(bytes(b.folds) for b in blocks), np.int32)
    order = np.lexsort((*codes.T, folds))
    # Counting many equal codes in a row is slow.
    order = order[np.random.default_rng(0).permutation(len(order))]
    return edges, codes[order], folds[order]


def forests(usable: DataFrame, features: Sequence[str], label: str, trees: int, seed: int, fold: str | None = None, without: Sequence[int | None] = (None,)) -> list[Forest]:
    """A forest for each of `without`: on all rows of `usable`, but those of that fold.

    `usable` has labels 0 and 1 and no nulls among the features; rows that hold no number aren't
    used. At most MATRIX_ROWS rows.
    """
    sc = usable.sparkSession.sparkContext
    edges, codes, folds = matrix(usable, features, label, fold)
    if not len(codes):
        raise ValueError("no rows to learn from")
    shared = sc.broadcast((codes, folds))

    def grow(work: tuple[int | None, int]) -> list[tuple]:
        out, first = work
        codes, folds = shared.value
        mine = codes if out is None else codes[folds != out]
        made = [grown(mine, np.random.default_rng([seed, 0 if out is None else 1 + out, t])) for t in range(first, min(first + TASK_TREES, trees))]
        return [np.stack(x) for x in zip(*made, strict=True)]

    work = [(out, first) for out in without for first in range(0, trees, TASK_TREES)]
    done = sc.parallelize(work, len(work)).map(grow).collect()
    shared.unpersist()
    each = len(work) // len(without)
    return [Forest(edges, *(np.concatenate(x) for x in zip(*done[i * each : (i + 1) * each], strict=True))) for i in range(len(without))]


def scored(df: DataFrame, features: Sequence[str], models: dict[int, Forest], fold: str | None = None) -> Column:
    """The score of a row by the forest of its fold, or by the only one; null where a feature is, or where its fold has none."""
    shared = df.sparkSession.sparkContext.broadcast(models)

    @F.pandas_udf("double")
    def score(fold: pd.Series, *values: pd.Series) -> pd.Series:
        out, folds = np.full(len(fold), np.nan), fold.to_numpy()
        for k in np.unique(folds):
            if (model := shared.value.get(int(k))) is not None:
                mine = folds == k
                out[mine] = model.scores([v.to_numpy(float)[mine] for v in values])
        return pd.Series(out)

    whole, which = F.lit(True), (F.col(fold) if fold else F.lit(0)).cast("int")
    for f in features:
        whole = whole & F.col(f).isNotNull()
    return F.when(whole & which.isin(*models), score(which, *[F.col(f).cast("double") for f in features]))
