"""All folds and candidates of a classifier search at once (C-2).

Logistic regression: the models descend in lock step, and one scan adds up
loss and gradient of all that have not arrived yet. Forests: the first n trees
of a large forest are a forest of n trees, and a deep tree cut at depth d is a
tree of depth d, so one forest per fold holds every candidate.

Labels are integers from 0, features are numbers; a missing value raises an
error. Folds are numbered from 0 in the column ``fold``.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Callable, Generator, Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanwork.operators.blocks import as_point
from gleanwork.session import scratch_path, settle, side_by_side

TOLERANCE = 1e-6  # largest entry of the gradient of the mean loss at the end
_MEMORY = 10  # steps that shape the next one
_CELLS = 2_000_000  # numbers of one kernel call


def _points(folded: DataFrame, columns: Sequence[str], label: str) -> DataFrame:
    """``<x, y, fold>``, written once for all scans."""
    return settle(
        folded.select(
            as_point(columns).alias("x"), F.col(label).cast("int").alias("y"), F.col("fold").cast("int")
        )
    )


def _added_up(points: DataFrame, work: Callable, size: int, width: int) -> np.ndarray:
    """The sum of ``work(x, y, fold)``, a flat vector of ``size``, over all rows.

    A task holds one vector and sends its entries that are not 0; ``width`` is
    the size of the work per row, which bounds the rows of one call.
    """
    step = max(1, _CELLS // width)

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            rows = batch.num_rows
            if not rows:
                continue
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(rows, -1)
            y, fold = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("y", "fold"))
            for a in range(0, rows, step):
                part = slice(a, a + step)
                total += work(x[part], y[part], fold[part])
        filled = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(filled), pa.array(total[filled])], names=["i", "v"])

    parts = points.mapInArrow(add_up, "i bigint, v double").groupBy("i").agg(F.sum("v").alias("v"))
    total = np.zeros(size)
    for row in parts.collect():
        total[row["i"]] = row["v"]
    return total


class _Shape:
    """Classes, rows per fold, and mean and spread of every feature."""

    def __init__(self, points: DataFrame, d: int, folds: int):
        gaps = F.exists("x", lambda v: v.isNull() | F.isnan(v))
        about = points.agg(
            F.max("y").alias("top"), F.count_if(gaps | F.col("y").isNull()).alias("gaps")
        ).first()
        if about["gaps"]:
            raise ValueError(f"{about['gaps']} rows lack a feature or their label")

        def work(x: np.ndarray, y: np.ndarray, fold: np.ndarray) -> np.ndarray:
            counts = np.bincount(fold, minlength=folds).astype(float)
            return np.concatenate([counts, x.sum(axis=0), (x * x).sum(axis=0)])

        total = _added_up(points, work, folds + 2 * d, d)
        self.classes = max((about["top"] or 0) + 1, 2)
        self.per_fold = total[:folds]
        n = max(self.per_fold.sum(), 1.0)
        self.mean = total[folds : folds + d] / n
        spread = np.sqrt(np.maximum(total[folds + d :] / n - self.mean**2, 0.0))
        self.spread = np.where(spread > 1e-9 * np.maximum(np.abs(self.mean), 1e-300), spread, 1.0)

    def scaled(self, x: np.ndarray) -> np.ndarray:
        return (x - self.mean) / self.spread


# --- logistic regression ----------------------------------------------------


def _way_down(slope: np.ndarray, past: Sequence[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Minus the slope, bent by the curvature that past steps saw (L-BFGS)."""
    if not past:
        return -slope / max(1.0, np.abs(slope).sum())
    way, shares = -slope, []
    for step, change in reversed(past):
        share = (step @ way) / (step @ change)
        shares.append(share)
        way = way - share * change
    step, change = past[-1]
    way = way * ((step @ change) / (change @ change))
    for (step, change), share in zip(past, reversed(shares)):
        way = way + (share - (change @ way) / (step @ change)) * step
    return way


def descent(
    start: np.ndarray, tolerance: float = TOLERANCE
) -> Generator[np.ndarray, tuple[float, np.ndarray], np.ndarray]:
    """Yields points, is sent their value and slope, returns the lowest point.

    For convex functions. Ends where the slope is at most ``tolerance``, or
    where numbers of this precision see no way down; it has no other limit.
    """
    at = start
    value, slope = yield at
    past: deque = deque(maxlen=_MEMORY)
    while np.abs(slope).max() > tolerance:
        way = _way_down(slope, past)
        gain = way @ slope
        if gain >= 0:
            past.clear()
            way = _way_down(slope, past)
            gain = way @ slope
        length = 1.0
        while True:
            if -gain * length <= 1e-15 * max(1.0, abs(value)):
                return at
            to = at + length * way
            new_value, new_slope = yield to
            if new_value <= value + 1e-4 * length * gain:
                break
            length /= 2
        step, change = to - at, new_slope - slope
        if step @ change > 0:
            past.append((step, change))
        at, value, slope = to, new_value, new_slope
    return at


def lock_step(runs: Sequence[Generator], answer: Callable[[dict], dict]) -> list:
    """Results of all ``runs``. What the open ones ask is answered together."""
    asked = {m: next(run) for m, run in enumerate(runs)}
    ends: dict = {}
    while asked:
        for m, reply in answer(asked).items():
            try:
                asked[m] = runs[m].send(reply)
            except StopIteration as end:
                ends[m] = end.value
                del asked[m]
    return [ends[m] for m in range(len(runs))]


def _logits(x: np.ndarray, models: np.ndarray) -> np.ndarray:
    """Rows x models x classes; ``models`` is models x lines x (features, 1).
    With one line the first class has logit 0."""
    z = np.einsum("nd,mld->nml", x, models[:, :, :-1], optimize=True) + models[:, :, -1]
    return np.concatenate([np.zeros_like(z), z], axis=2) if models.shape[1] == 1 else z


def fitted_logistic(
    points: DataFrame, shape: _Shape, settings: Sequence[tuple[int, float]]
) -> np.ndarray:
    """One model per ``(left out fold, C)``: lines x (features, intercept) on
    centred and scaled features.

    The objective is the mean loss plus half the squared coefficients, in
    units of the given features, over C times the rows; intercepts are free.
    Two classes have one line, more have one each.
    """
    d = len(shape.mean)
    lines = 1 if shape.classes == 2 else shape.classes
    left_out = np.array([fold for fold, _ in settings])
    rows = np.maximum(shape.per_fold.sum() - shape.per_fold[left_out], 1.0)
    size = lines * (d + 1)

    def answer(asked: dict[int, np.ndarray]) -> dict[int, tuple[float, np.ndarray]]:
        open_models = list(asked)
        models = np.stack([asked[m] for m in open_models]).reshape(-1, lines, d + 1)
        out = left_out[open_models]
        count = len(open_models)

        def work(x: np.ndarray, y: np.ndarray, fold: np.ndarray) -> np.ndarray:
            x = shape.scaled(x)
            z = _logits(x, models)
            z -= z.max(axis=2, keepdims=True)
            share = np.exp(z)
            norm = share.sum(axis=2)
            taken = fold[:, None] != out[None, :]
            own = np.arange(len(y))
            loss = ((np.log(norm) - z[own, :, y]) * taken).sum(axis=0)
            share /= norm[:, :, None]
            share[own, :, y] -= 1.0
            share *= taken[:, :, None]
            pull = share[:, :, 1:] if lines == 1 else share
            along = (pull.reshape(len(y), -1).T @ x).reshape(count, lines, d)
            slope = np.concatenate([along, pull.sum(axis=0)[:, :, None]], axis=2)
            return np.concatenate([loss, slope.ravel()])

        total = _added_up(points, work, count * (size + 1), count * shape.classes + d)
        loss, slopes = total[:count], total[count:].reshape(count, lines, d + 1)
        replies = {}
        for i, m in enumerate(open_models):
            weight = 1.0 / (settings[m][1] * rows[m])
            coef = models[i, :, :-1] / shape.spread
            slope = slopes[i] / rows[m]
            slope[:, :-1] += weight * coef / shape.spread
            replies[m] = (loss[i] / rows[m] + weight / 2 * (coef**2).sum(), slope.ravel())
        return replies

    found = lock_step([descent(np.zeros(size)) for _ in settings], answer)
    return np.stack(found).reshape(-1, lines, d + 1)


def logistic_scores(
    folded: DataFrame, columns: Sequence[str], label: str, cs: Sequence[float], folds: int
) -> list[list[float | None]]:
    """Accuracy per fold and value of C; None for a fold without rows."""
    points = _points(folded, columns, label)
    shape = _Shape(points, len(columns), folds)
    settings = [(fold, c) for fold in range(folds) for c in cs]
    models = fitted_logistic(points, shape, settings)
    left_out = np.array([fold for fold, _ in settings])

    def hits(x: np.ndarray, y: np.ndarray, fold: np.ndarray) -> np.ndarray:
        made = _logits(shape.scaled(x), models).argmax(axis=2)
        return ((made == y[:, None]) & (fold[:, None] == left_out)).sum(axis=0).astype(float)

    found = _added_up(points, hits, len(settings), len(settings) * shape.classes + len(columns))
    return _shares(found.reshape(folds, len(cs)), shape.per_fold)


def _shares(hits: np.ndarray, rows: np.ndarray) -> list[list[float | None]]:
    return [[float(h / n) if n else None for h in line] for line, n in zip(hits, rows)]


# --- forests ----------------------------------------------------------------


class _Tree:
    """A grown tree as arrays over its nodes; the root is node 0."""

    def __init__(self, nodes: Sequence):
        nodes = sorted(nodes, key=lambda node: node["id"])
        stats = np.array([node["impurityStats"] for node in nodes])
        self.votes = stats / np.maximum(stats.sum(axis=1, keepdims=True), 1.0)  # no rows, no vote
        self.class_of = np.array([int(node["prediction"]) for node in nodes])
        self.left = np.array([node["leftChild"] for node in nodes])
        self.right = np.array([node["rightChild"] for node in nodes])
        self.feature = np.array([max(node["split"]["featureIndex"], 0) for node in nodes])
        cuts = [node["split"]["leftCategoriesOrThreshold"] for node in nodes]
        self.cut = np.array([cut[0] if cut else 0.0 for cut in cuts])
        self.depth = np.zeros(len(nodes), dtype=int)
        for i in range(len(nodes)):  # parents have smaller numbers
            if self.left[i] >= 0:
                self.depth[[self.left[i], self.right[i]]] = self.depth[i] + 1

    def ends(self, depth: int) -> np.ndarray:
        """Whether each node is a leaf of the tree cut at ``depth``. Leaves of
        one parent and class become one, as when a tree is grown to there."""
        leaf = (self.left < 0) | (self.depth >= depth)
        for i in np.flatnonzero(~leaf)[::-1]:
            a, b = self.left[i], self.right[i]
            leaf[i] = leaf[a] and leaf[b] and self.class_of[a] == self.class_of[b]
        return leaf


def _grown(points: DataFrame, trees: int, depth: int, seed: int) -> list[_Tree]:
    """The trees of one forest. Its saved form names the classes of inner nodes."""
    vectors = points.select(array_to_vector("x").alias("v"), "y").persist()
    forest = RandomForestClassifier(
        featuresCol="v",
        labelCol="y",
        numTrees=trees,
        maxDepth=depth,
        impurity="gini",
        featureSubsetStrategy="sqrt",
        seed=seed,
    ).fit(vectors)
    vectors.unpersist()
    path = scratch_path(points.sparkSession, "forest")
    forest.write().save(path)
    # At most trees x 2^(depth + 1) nodes, whatever the number of rows.
    nodes = points.sparkSession.read.parquet(f"{path}/data").collect()
    return [_Tree([n["nodeData"] for n in nodes if n["treeID"] == t]) for t in range(trees)]


def forest_scores(
    folded: DataFrame,
    columns: Sequence[str],
    label: str,
    tried: Sequence[Mapping],
    folds: int,
    seed: int = 0,
) -> list[list[float | None]]:
    """Accuracy per fold and candidate; None for a fold without rows.

    A candidate of n trees of depth d is judged on the first n trees of the
    largest forest, cut at d, with classes voted as the whole forest does.
    """
    points = _points(folded, columns, label)
    shape = _Shape(points, len(columns), folds)
    sizes = [int(t["n_estimators"]) for t in tried]
    depths = sorted({int(t["max_depth"]) for t in tried})
    place = {(s, int(t["max_depth"])): [] for s, t in zip(sizes, tried)}
    for i, (s, t) in enumerate(zip(sizes, tried)):
        place[(s, int(t["max_depth"]))].append(i)

    def score_fold(fold: int) -> np.ndarray:
        if not 0 < shape.per_fold[fold] < shape.per_fold.sum():
            return np.zeros(len(tried))
        train, test = points.filter(F.col("fold") != fold), points.filter(F.col("fold") == fold)
        trees = _grown(train, max(sizes), depths[-1], seed)
        ends = [[tree.ends(d) for d in depths] for tree in trees]

        def hits(x: np.ndarray, y: np.ndarray, _: np.ndarray) -> np.ndarray:
            found = np.zeros(len(tried))
            rows = np.arange(len(x))
            votes = np.zeros((len(depths), len(x), trees[0].votes.shape[1]))
            for t, tree in enumerate(trees):
                for j in range(len(depths)):
                    node = np.zeros(len(x), dtype=int)
                    for _level in range(depths[j]):
                        goes_left = x[rows, tree.feature[node]] <= tree.cut[node]
                        below = np.where(goes_left, tree.left[node], tree.right[node])
                        node = np.where(ends[t][j][node], node, below)
                    votes[j] += tree.votes[node]
                    for i in place.get((t + 1, depths[j]), ()):
                        found[i] = (votes[j].argmax(axis=1) == y).sum()
            return found

        return _added_up(test, hits, len(tried), len(depths) * shape.classes + len(columns))

    found = np.stack(side_by_side(score_fold, range(folds)))
    return _shares(found, shape.per_fold)
