"""Training of many models at once: every setting and fold in the same passes over the rows.

Rows are (row long, label double, fold int, features array<double>). A model
leaves out the rows of its own fold; fold ``ALL`` leaves out none. Each pass
adds up, in every task, what all models need, and Spark adds up the tasks;
the driver holds the models alone, whose size does not depend on the rows.
"""

from __future__ import annotations

import pickle
import zlib
from collections.abc import Iterator, Mapping, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import RDD
from pyspark.sql import DataFrame

from marketloom.operators import blocks

ALL = -1
_HASH = np.uint64(0x9E3779B97F4A7C15)


class Rows(NamedTuple):
    """Rows of a batch in memory."""

    row: np.ndarray
    label: np.ndarray
    fold: np.ndarray
    features: np.ndarray

    @classmethod
    def of(cls, batch: pa.RecordBatch) -> Rows:
        x = np.asarray(batch.column("features").flatten(), np.float64).reshape(batch.num_rows, -1)
        return cls(np.asarray(batch.column("row")), np.asarray(batch.column("label"), np.float64), np.asarray(batch.column("fold")), x)

    def inside(self, folds: np.ndarray) -> np.ndarray:
        """1 where a model learns from a row, by row and model."""
        return (self.fold[:, None] != folds[None, :]).astype(np.float64)


# Logistic regression


class Linear(NamedTuple):
    """Logistic models: weights with the constant last, the fold left out, and penalties of each."""

    weights: np.ndarray  # models x (width + 1)
    folds: np.ndarray
    l1: np.ndarray
    l2: np.ndarray

    def scores(self, rows: Rows) -> np.ndarray:
        return _sigmoid(_with_one(rows.features) @ self.weights.T)

    def only(self, places: Sequence[int]) -> Linear:
        return Linear(*(x[list(places)] for x in self))


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1.0 + np.tanh(0.5 * z))


def _with_one(x: np.ndarray) -> np.ndarray:
    return np.column_stack([x, np.ones(len(x))])


def violation(weights: np.ndarray, gradient: np.ndarray, l1: float, l2: float) -> np.ndarray:
    """How far each weight is from its optimality condition; the constant (last) has no penalty."""
    own = gradient + l2 * np.append(weights[:-1], 0.0)
    slack = np.maximum(np.abs(own) - l1, 0.0)
    return np.abs(np.where(np.append(weights[:-1], 0.0) != 0, own + l1 * np.sign(weights) * np.append(np.ones(len(weights) - 1), 0.0), np.append(slack[:-1], abs(own[-1]))))


def _newton(b: np.ndarray, g: np.ndarray, h: np.ndarray, l1: float, l2: float) -> np.ndarray:
    """Where the quadratic model of the loss around ``b`` plus the penalty is least, by coordinates if there is an L1 part."""
    ridge = np.append(np.full(len(b) - 1, l2), 0.0)
    h = h + np.eye(len(b)) * 1e-10
    if not l1:
        return b - np.linalg.solve(h + np.diag(ridge), g + ridge * b)
    z = b.copy()
    slope = g.copy()  # of the quadratic model at z
    soft = np.append(np.full(len(b) - 1, l1), 0.0)
    for _ in range(1_000):
        most = 0.0
        for j in range(len(z)):
            curve = h[j, j] + ridge[j]
            u = z[j] - (slope[j] + ridge[j] * z[j]) / curve
            to = np.sign(u) * max(abs(u) - soft[j] / curve, 0.0)
            if to != z[j]:
                most = max(most, abs(to - z[j]))
                slope += h[:, j] * (to - z[j])
                z[j] = to
        if most < 1e-12:
            break
    return z


def fit_linear(rows: DataFrame, penalties: Sequence[tuple[float, float]], folds: Sequence[int], width: int, tolerance: float = 1e-8, passes: int = 100) -> Linear:
    """A logistic model for each (l1, l2) penalty of the summed loss and fold, penalty by penalty.

    Every pass sums loss, gradient and curvature of all models; each then
    moves by a proximal Newton step, halved while the loss has grown. It ends
    when no condition of optimality is off by ``tolerance`` per row.
    """
    pairs = [(p, f) for p in penalties for f in folds]
    l1, l2 = np.array([p[0] for p, _ in pairs]), np.array([p[1] for p, _ in pairs])
    left = np.array([f for _, f in pairs])
    at = np.zeros((len(pairs), width + 1))
    best, goal = at.copy(), np.full(len(pairs), np.inf)
    with blocks.stored(rows, Rows.of) as kept:
        _fit_linear(kept, at, best, goal, left, l1, l2, width, tolerance, passes)
    return Linear(best, left, l1, l2)


def _fit_linear(kept: RDD[Rows], at: np.ndarray, best: np.ndarray, goal: np.ndarray, left: np.ndarray, l1: np.ndarray, l2: np.ndarray, width: int, tolerance: float, passes: int) -> None:
    """The passes of ``fit_linear``: ``best`` gets the weights."""
    todo = np.arange(len(at))
    for _ in range(passes):

        def add(batch: Rows, at=at[todo], left=left[todo], todo=todo) -> dict[int, np.ndarray]:
            x = _with_one(batch.features)
            z, inside = x @ at.T, batch.inside(left)
            p = _sigmoid(z)
            gradient = ((p - batch.label[:, None]) * inside).T @ x
            loss = ((np.logaddexp(0.0, z) - batch.label[:, None] * z) * inside).sum(axis=0)
            curve = p * (1 - p) * inside
            rows_of = inside.sum(axis=0)
            return {int(m): np.concatenate([[loss[i], rows_of[i]], gradient[i], (x.T @ (curve[:, i, None] * x)).ravel()]) for i, m in enumerate(todo)}

        sums = blocks.summed(kept, add)
        going = []
        for m in todo.tolist():
            if m not in sums:
                continue  # no rows
            loss, n, g, h = sums[m][0], sums[m][1], sums[m][2 : width + 3], sums[m][width + 3 :].reshape(width + 1, -1)
            value = loss + l1[m] * np.abs(at[m, :-1]).sum() + 0.5 * l2[m] * (at[m, :-1] ** 2).sum()
            if value > goal[m] + 1e-12 * max(1.0, abs(goal[m])):
                at[m] = 0.5 * (at[m] + best[m])
                going.append(m)
                continue
            goal[m], best[m] = value, at[m]
            if violation(at[m], g, l1[m], l2[m]).max() > tolerance * max(n, 1.0):
                at[m] = _newton(at[m], g, h, l1[m], l2[m])
                going.append(m)
        todo = np.array(going, int)
        if not going:
            break


# Networks of one hidden layer


class Networks(NamedTuple):
    """Networks after each asked number of epochs: per setting and fold a flat vector of weights."""

    hidden: list[int]
    weights: list[np.ndarray]

    def scores(self, rows: Rows) -> np.ndarray:
        x = _with_one(rows.features)
        return np.column_stack([_forward(x, h, w)[1] for h, w in zip(self.hidden, self.weights)])

    def only(self, places: Sequence[int]) -> Networks:
        return Networks([self.hidden[i] for i in places], [self.weights[i] for i in places])


def _forward(x: np.ndarray, hidden: int, flat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    cut = x.shape[1] * hidden
    act = np.tanh(x @ flat[:cut].reshape(x.shape[1], hidden))
    return act, _sigmoid(act @ flat[cut:-1] + flat[-1])


def fit_networks(rows: DataFrame, settings: Sequence[tuple[int, float, int]], folds: Sequence[int], width: int, seed: int) -> Networks:
    """A network for each (hidden, step, epochs) and fold: tanh units, gradient descent on the mean loss of all rows.

    An epoch is one pass for all networks; settings that differ in epochs
    alone are stops of the same run.
    """
    kinds = sorted({(h, s) for h, s, _ in settings})
    runs = [(h, s, f) for h, s in kinds for f in folds]
    weights = []
    for h, s, _ in runs:
        rng = np.random.Generator(np.random.PCG64([seed, h]))
        weights.append(np.concatenate([rng.standard_normal((width + 1) * h) * 0.3, rng.standard_normal(h) * 0.3, [0.0]]))
    kept: dict[tuple[int, float, int, int], np.ndarray] = {}
    left = np.array([f for _, _, f in runs])
    stops = {e for _, _, e in settings}
    with blocks.stored(rows, Rows.of) as kept_rows:
        for epoch, total in _epochs(kept_rows, runs, left, weights, max(stops)):
            done = 0
            for m, (_, step, _) in enumerate(runs):
                size = len(weights[m])
                own, n = total[done : done + size], total[done + size]
                weights[m] = weights[m] - step * own / max(n, 1.0)
                done += size + 1
            if epoch in stops:
                kept |= {(h, s, epoch, f): weights[m] for m, (h, s, f) in enumerate(runs)}
    asked = [(h, kept.get((h, s, e, f), weights[runs.index((h, s, f))])) for h, s, e in settings for f in folds]
    return Networks([h for h, _ in asked], [w for _, w in asked])


def _epochs(rows: RDD[Rows], runs: list[tuple[int, float, int]], left: np.ndarray, weights: list[np.ndarray], epochs: int) -> Iterator[tuple[int, np.ndarray]]:
    """After each pass the gradients and numbers of rows of all networks, which stand in ``weights``."""
    for epoch in range(1, epochs + 1):

        def add(batch: Rows, weights=tuple(weights)) -> dict[int, np.ndarray]:
            total: np.ndarray | float = 0.0
            for a in range(0, len(batch.label), 2_000):  # so that what is between stays in the cache
                own, out = Rows(*(v[a : a + 2_000] for v in batch)), []
                x, inside = _with_one(own.features), own.inside(left)
                for m, ((hidden, _, _), flat) in enumerate(zip(runs, weights)):
                    act, p = _forward(x, hidden, flat)
                    off = (p - own.label) * inside[:, m]
                    out += [None, act.T @ off, [off.sum(), inside[:, m].sum()]]
                    back = np.subtract(1.0, np.multiply(act, act, out=act), out=act)
                    back *= off[:, None]
                    out[-3] = ((x.T @ back) * flat[x.shape[1] * hidden : -1]).ravel()
                total = total + np.concatenate(out)
            return {0: total}

        total = blocks.summed(rows, add).get(0)
        if total is None:
            break
        yield epoch, total


# Forests


class Trees(NamedTuple):
    """Trees as heaps: node i has children 2i + 1 (values up to the cut) and 2i + 2.

    All arrays are trees x nodes; ``feature`` is -1 where a node has no split.
    """

    feature: np.ndarray
    cut: np.ndarray
    weight: np.ndarray
    share: np.ndarray
    gain: np.ndarray

    def ends(self, x: np.ndarray, which: np.ndarray, levels: int) -> np.ndarray:
        """The node in each tree of ``which`` where each row ends, at ``levels`` or where there is no split."""
        feature, cut, flat = self.feature.ravel(), self.cut.ravel(), np.ascontiguousarray(x).ravel()
        root = (which * self.feature.shape[1])[None, :]
        row = (np.arange(len(x)) * x.shape[1])[:, None]
        node = np.zeros((len(x), len(which)), np.int64)
        for _ in range(levels):
            at = root + node
            f = feature.take(at)
            node = np.where(f >= 0, 2 * node + 1 + (flat.take(row + np.maximum(f, 0)) > cut.take(at)), node)
        return node

    def shares(self, which: np.ndarray, depth: int, split: int) -> np.ndarray:
        """For each node the share where its rows stop: there, or in a node above that is at the depth or too small to split."""
        share = self.share[which]
        on = (self.feature[which] >= 0) & (self.weight[which] >= split)  # rows go on from here
        for level in range(1, share.shape[1].bit_length()):
            own = np.arange(2**level - 1, 2 ** (level + 1) - 1)
            above = (own - 1) // 2
            come = on[:, above] & (level <= depth)
            share[:, own] = np.where(come, share[:, own], share[:, above])
            on[:, own] &= come
        return share


class Forest(NamedTuple):
    """Trees of every minimal leaf and fold, and the settings (trees, depth, min_leaf, min_split) by fold that read them."""

    trees: Trees
    leaf: np.ndarray  # of each tree
    fold: np.ndarray
    asked: list[tuple[tuple[int, int, int, int], int]]

    def scores(self, rows: Rows) -> np.ndarray:
        """Mean share of label 1 in the node where a row stops: at the depth, or where a node is too small to split."""
        out = np.empty((len(rows.label), len(self.asked)))
        for leaf, fold in sorted({(s[2], f) for s, f in self.asked}):
            which = np.flatnonzero((self.leaf == leaf) & (self.fold == fold))
            mine = [(i, s) for i, (s, f) in enumerate(self.asked) if (s[2], f) == (leaf, fold)]
            kinds = sorted({(s[1], s[3]) for _, s in mine})
            node = self.trees.ends(rows.features, which, max(d for d, _ in kinds))
            at = (np.arange(len(which)) * self.trees.share.shape[1])[None, :] + node
            value = {k: self.trees.shares(which, *k).ravel().take(at) for k in kinds}
            for i, (n, depth, _, split) in mine:
                out[:, i] = value[depth, split][:, :n].mean(axis=1)
        return out

    def only(self, places: Sequence[int]) -> Forest:
        """For scores: with the trees that these settings read, without gains."""
        asked = [self.asked[i] for i in places]
        read = {(s[2], f) for s, f in asked}
        which = [t for t, kind in enumerate(zip(self.leaf.tolist(), self.fold.tolist())) if kind in read]
        return Forest(Trees(*(x[which] for x in self.trees[:4]), np.empty(0)), self.leaf[which], self.fold[which], asked)

    def importances(self, width: int) -> np.ndarray:
        """Share of each feature in the trees' gains, each tree's adding up to one, averaged."""
        total = np.zeros((len(self.leaf), width))
        rows, nodes = np.nonzero(self.trees.feature >= 0)
        np.add.at(total, (rows, self.trees.feature[rows, nodes]), self.trees.gain[rows, nodes])
        each = total.sum(axis=1, keepdims=True)
        mean = np.where(each > 0, total / np.where(each > 0, each, 1.0), 0.0).mean(axis=0)
        return mean / mean.sum() if mean.sum() else mean


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_POISSON = np.cumsum([np.exp(-1.0) / np.prod(np.arange(1.0, k + 1)) for k in range(12)])


def draws(row: np.ndarray, trees: np.ndarray, seed: int) -> np.ndarray:
    """How often each tree draws each row: Poisson(1) from a hash of row and tree."""
    x = _mixed(row.view(np.uint64)[:, None] + _mixed((trees + 1).astype(np.uint64) * _HASH + np.uint64(seed))[None, :])
    return np.searchsorted(_POISSON, (x >> np.uint64(11)).astype(np.float64) * 2.0**-53, "right")


def looked_at(tree: np.ndarray, node: np.ndarray, width: int, count: int, seed: int) -> np.ndarray:
    """``count`` different features for each node of a tree, by hashes of tree, node and feature."""
    keys = _mixed(_mixed(tree.astype(np.uint64) * _HASH + np.uint64(seed + 7))[:, None] + (node.astype(np.uint64) * np.uint64(width))[:, None] + np.arange(width, dtype=np.uint64)[None, :])
    return np.sort(np.argsort(keys, axis=1, kind="stable")[:, :count], axis=1)


def cuts_of(rows: DataFrame, width: int, bins: int) -> list[np.ndarray]:
    """Up to ``bins`` - 1 cut points of each feature, at approximate quantiles of all rows. Runs jobs.

    They are looked for in partitions of 50,000 rows, so that those of a small
    table do not depend on how it lies.
    """
    wide = rows.coalesce(max(1, -(-rows.count() // 50_000))).selectExpr(*[f"features[{j}] as f{j}" for j in range(width)])
    found = wide.approxQuantile([f"f{j}" for j in range(width)], [i / bins for i in range(1, bins)], 0.1 / bins)
    return [np.unique(x) for x in found]


def fit_forest(
    rows: DataFrame, settings: Sequence[tuple[int, int, int, int]], folds: Sequence[int], width: int, seed: int, bins: int = 32, tries: int | None = None
) -> Forest:
    """A forest for each (trees, depth, min_leaf, min_split) and fold.

    Trees grow level by level. A pass sends every row down the trees so far
    and counts, per tree, node, looked-at feature and bin, the drawn rows and
    those of label 1; the counts of a tree meet in one task, which picks the
    splits of largest Gini gain whose sides hold ``min_leaf`` drawn rows. Only
    leaf sizes and folds need trees of their own: fewer trees are the first
    ones, a smaller depth stops early, and so does a larger minimal split.
    Trees that differ in leaf size alone are counted once until their splits
    differ.
    Ties go to the first feature, then the lowest cut.
    """
    n_trees, depth = max(s[0] for s in settings), max(s[1] for s in settings)
    tries = tries or max(1, int(np.sqrt(width)))
    kinds = [(leaf, fold) for leaf in sorted({s[2] for s in settings}) for fold in folds]
    leaf = np.repeat([k[0] for k in kinds], n_trees)
    left = np.repeat([k[1] for k in kinds], n_trees)
    number = np.tile(np.arange(n_trees), len(kinds))  # trees of all kinds draw alike
    nodes = 2 ** (depth + 1) - 1
    shape = (len(leaf), nodes)
    trees = Trees(np.full(shape, -1, np.int16), np.zeros(shape), np.zeros(shape), np.zeros(shape), np.zeros(shape))
    cuts = cuts_of(rows, width, bins)
    spark = rows.sparkSession

    for level in range(depth + 1):
        first, many_nodes, last = 2**level - 1, 2**level, level == depth
        used, cells = (1, 1) if last else (tries, bins)  # the last level only needs each node's sums
        kind = np.min_scalar_type(many_nodes * used * cells)
        alike = _alike(trees, left, number, first)
        # Only the splits above this level are needed.
        sent = spark.sparkContext.broadcast((Trees(*(x[:, : 2**level] for x in trees[:2]), *[np.empty(0)] * 3), left, number, cuts, alike))

        def count(batches: Iterator[pa.RecordBatch], sent=sent, level=level, first=first, many_nodes=many_nodes, last=last, used=used, cells=cells, kind=kind) -> Iterator[pa.RecordBatch]:
            above, left, number, cuts, alike = sent.value
            spots = np.repeat(np.arange(n_trees), many_nodes), np.tile(np.arange(first, first + many_nodes), n_trees)
            features = looked_at(*spots, width, tries, seed).reshape(n_trees, many_nodes, tries)
            split_by = above.feature.astype(np.int64)

            for own in _gathered(batches):
                bin_of = np.column_stack([np.searchsorted(c, own.features[:, j], "left") for j, c in enumerate(cuts)]).astype(np.int64)
                x, bin_of = own.features.ravel(), bin_of.ravel()
                drawn = np.concatenate([draws(own.row[a : a + 10_000], np.arange(n_trees), seed).astype(np.uint8) for a in range(0, len(own.row), 10_000)]).T.copy()
                outside = {f: own.fold != f for f in set(left.tolist())}
                found: list[tuple[int, bytes, bytes, bytes]] = []
                for t in alike:
                    i = np.flatnonzero((drawn[number[t]] > 0) & outside[left[t]])
                    node, at = np.zeros(len(i), np.int64), i * width
                    for _ in range(level):
                        f = split_by[t].take(node)
                        if f.min(initial=0) < 0:
                            on = f >= 0
                            i, node, at, f = i[on], node[on], at[on], f[on]
                        f += at
                        right = x.take(f) > above.cut[t].take(node)
                        node += node
                        node += 1
                        node += right
                    if not len(i):
                        continue
                    place = node - first
                    w = drawn[number[t]].take(i).astype(np.float64)
                    weighted = w * own.label.take(i)
                    if not last:
                        looked = features[number[t]]
                        place = np.concatenate([(place * used + k) * bins + bin_of.take(at + looked[:, k].take(place)) for k in range(used)])
                    counts = [np.bincount(place, np.tile(v, used), many_nodes * used * cells) for v in (w, weighted)]
                    some = np.flatnonzero(counts[0])
                    found.append((t, some.astype(kind).tobytes(), *(_packed(c[some]) for c in counts)))
                    if len(found) == 200:
                        yield _tree_counts(found)
                        found = []
                if found:
                    yield _tree_counts(found)

        def pick(batches: Iterator[pa.RecordBatch], sent=sent, first=first, many_nodes=many_nodes, used=used, cells=cells, kind=kind) -> Iterator[pa.RecordBatch]:
            number, alike = sent.value[2], sent.value[4]
            now, found = None, []
            sums = np.zeros((2, many_nodes * used * cells))

            def done() -> None:
                if now is not None:
                    node = np.arange(first, first + many_nodes)
                    looked = looked_at(np.full(many_nodes, number[now]), node, width, tries, seed)[:, :used]
                    found.extend(_splits(sums.reshape(2, -1, cells), first, looked, [(t, int(leaf[t])) for t in alike[now]]))

            for batch in batches:
                for tree, at, *counts in zip(*(c.to_pylist() for c in batch.columns)):
                    if tree != now:
                        done()
                        now = tree
                        sums[:] = 0.0
                    at = np.frombuffer(at, kind)
                    for total, c in zip(sums, counts):
                        total[at] += _unpacked(c, len(at))
            done()
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*found)], ["tree", "node", "feature", "bin", "weight", "positive", "gain"])

        counted = rows.mapInArrow(count, "tree int, cells binary, drawn binary, positive binary").repartition("tree").sortWithinPartitions("tree")
        best = counted.mapInArrow(pick, "tree int, node int, feature int, bin int, weight double, positive double, gain double").toPandas()
        sent.unpersist()
        t, v = best.tree.to_numpy(), best.node.to_numpy()
        trees.weight[t, v], trees.share[t, v] = best.weight, best.positive / best.weight
        split = (best.feature >= 0).to_numpy()
        if level == depth or not split.any():
            break
        f, b = best.feature.to_numpy()[split], best.bin.to_numpy()[split]
        trees.feature[t[split], v[split]] = f
        trees.cut[t[split], v[split]] = [cuts[j][k] for j, k in zip(f, b)]
        trees.gain[t[split], v[split]] = best.gain.to_numpy()[split]
    return Forest(trees, leaf, left, [(s, f) for s in settings for f in folds])


def _gathered(batches: Iterator[pa.RecordBatch], most: int = 50_000) -> Iterator[Rows]:
    """The rows of a task together, or ``most`` and a batch of them at a time."""
    held: list[Rows] = []
    for batch in batches:
        if batch.num_rows:
            held.append(Rows.of(batch))
        if sum(len(r.label) for r in held) >= most:
            yield Rows(*map(np.concatenate, zip(*held)))
            held = []
    if held:
        yield Rows(*map(np.concatenate, zip(*held)))


def _alike(trees: Trees, left: np.ndarray, number: np.ndarray, nodes: int) -> dict[int, list[int]]:
    """Trees by the first one that draws the same rows and has the same splits in the first ``nodes`` nodes."""
    by: dict[tuple, list[int]] = {}
    for t in range(len(left)):
        by.setdefault((left[t], number[t], trees.feature[t, :nodes].tobytes(), trees.cut[t, :nodes].tobytes()), []).append(t)
    return {ts[0]: ts for ts in by.values()}


def _packed(sums: np.ndarray) -> bytes:
    """In as few bytes as the largest number needs; as doubles if they are not all whole."""
    with np.errstate(invalid="ignore"):
        whole = sums.astype(np.uint32)
    return (sums.astype(np.min_scalar_type(whole.max())) if (whole == sums).all() else sums).tobytes()


def _unpacked(data: bytes, count: int) -> np.ndarray:
    size = len(data) // count
    return np.frombuffer(data, np.float64 if size == 8 else f"u{size}").astype(np.float64)


def _tree_counts(found: list[tuple[int, bytes, bytes, bytes]]) -> pa.RecordBatch:
    tree, *data = zip(*found)
    return pa.RecordBatch.from_arrays([pa.array(tree, pa.int32()), *(pa.array(d, pa.binary()) for d in data)], ["tree", "cells", "drawn", "positive"])


def _splits(sums: np.ndarray, first: int, looked: np.ndarray, trees: list[tuple[int, int]]) -> Iterator[tuple[np.ndarray, ...]]:
    """For each tree with its least leaf the best split of each node; feature -1 where none gains.

    ``sums`` has the drawn rows and those of label 1 by (node, place of the
    looked-at feature) and bin.
    """
    some = np.flatnonzero(sums[0].any(axis=1))
    if not len(some):
        return
    dense = np.moveaxis(sums[:, some], 0, -1)
    place, k = some // looked.shape[1], some % looked.shape[1]
    node, feature = first + place, looked[place, k]
    total = dense.sum(axis=1)
    low = np.cumsum(dense, axis=1)[:, : max(1, dense.shape[1] - 1)]
    high = total[:, None] - low
    impurity = lambda x: x[..., 1] * (x[..., 0] - x[..., 1]) / np.maximum(x[..., 0], 1e-300)
    # Rounded so that the order of sums makes no difference.
    gains = np.round(impurity(total)[:, None] - impurity(low) - impurity(high), 9)
    for tree, least in trees:
        gain = np.where((low[..., 0] < least) | (high[..., 0] < least), -1.0, gains)
        cut = gain.argmax(axis=1)
        best = gain[np.arange(len(some)), cut]
        order = np.lexsort((feature, -best, node))
        top = order[np.flatnonzero(np.diff(node[order], prepend=-1))]
        yield (
            np.full(len(top), tree, np.int32), node[top].astype(np.int32), np.where(best[top] > 0, feature[top], -1).astype(np.int32),
            cut[top].astype(np.int32), total[top, 0], total[top, 1], best[top],
        )


def scored(rows: DataFrame, model: Linear | Networks | Forest, places: Mapping[int, Sequence[int]] | None = None) -> DataFrame:
    """(fold, label, scores): of every row, the score of each model; with ``places``, of those named for the row's fold alone."""
    # Each executor keeps a copy on its disk, and heaps of trees are mostly empty. One fold's at a time, for the driver's memory.
    packed = lambda part: zlib.compress(pickle.dumps(part, pickle.HIGHEST_PROTOCOL), 1)
    sent = rows.sparkSession.sparkContext.broadcast({f: packed(model.only(p)) for f, p in places.items()} if places else {None: packed(model)})

    def of(models: dict, own: Rows) -> np.ndarray:
        if None in models:
            return models[None].scores(own)
        out = None
        for fold in np.unique(own.fold).tolist():
            here = np.flatnonzero(own.fold == fold)
            scores = models[fold].scores(Rows(*(v[here] for v in own)))
            out = np.empty((len(own.label), scores.shape[1])) if out is None else out
            out[here] = scores
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = {f: pickle.loads(zlib.decompress(m)) for f, m in sent.value.items()}
        for batch in batches:
            if not batch.num_rows:
                continue
            found = [of(models, Rows.of(batch.slice(a, 5_000))) for a in range(0, batch.num_rows, 5_000)]
            flat = np.concatenate(found)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(flat) + 1, dtype=np.int32) * flat.shape[1]), pa.array(flat.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("fold"), batch.column("label"), lists], ["fold", "label", "scores"])

    return rows.mapInArrow(run, "fold int, label double, scores array<double>")
