"""Models trained together against models trained one by one."""

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from marketloom.operators import many
from marketloom.operators import models as ML
from marketloom.plans.registered import all_queries

WIDTH = 4


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(5)
    x = np.round(rng.standard_normal((400, WIDTH)), 2)
    y = (x[:, 0] + 0.5 * x[:, 1] * x[:, 2] + 0.7 * rng.standard_normal(400) > 0).astype(float)
    df = spark.createDataFrame([(i * 7919, float(b), i % 3, a.tolist()) for i, (a, b) in enumerate(zip(x, y))], "row long, label double, fold int, features array<double>")
    df = df.repartition(6).persist()
    yield df, x, y
    df.unpersist()


def test_linear_models_are_those_of_single_fits(table):
    df, _, _ = table
    penalties = [(0.0, 1.0), (20.0, 5.0), (3.0, 0.1), (1e4, 0.0)]
    found = many.fit_linear(df, penalties, [0, 1, 2, many.ALL], WIDTH)
    for i, (l1, l2) in enumerate(penalties):
        for j, fold in enumerate([0, 1, 2, many.ALL]):
            part = df.filter(F.col("fold") != fold).select("label", array_to_vector("features").alias("features"))
            n = part.count()
            alone = LogisticRegression(regParam=(l1 + l2) / n, elasticNetParam=l1 / (l1 + l2), standardization=False, tol=1e-12, maxIter=500).fit(part)
            assert np.allclose(found.weights[4 * i + j], [*alone.coefficients.toArray(), alone.intercept], atol=2e-4)
    assert (found.weights[-4:, :-1] == 0).all() and (found.weights[4:8, :-1] == 0).any()


def test_separable_classes_and_one_class(spark):
    rows = [(i, float(i >= 10), i % 2, [float(i - 10)]) for i in range(20)] + [(99, 1.0, 2, [3.0])]
    df = spark.createDataFrame(rows, "row long, label double, fold int, features array<double>")
    found = many.fit_linear(df, [(0.0, 0.001)], [0, many.ALL], 1)
    assert np.isfinite(found.weights).all() and (found.scores(many.Rows(None, None, None, np.array([[9.0], [-9.0]])))[0] > 0.99).all()
    assert np.isfinite(many.fit_linear(df.filter("label = 1"), [(0.0, 1.0)], [many.ALL], 1).weights).all()
    assert (many.fit_linear(df.limit(0), [(0.0, 1.0)], [many.ALL], 1).weights == 0).all()


def test_networks_are_plain_gradient_descent(table):
    df, x, y = table
    found = many.fit_networks(df, [(3, 0.5, 10), (3, 0.5, 25), (2, 0.1, 25)], [1, many.ALL], WIDTH, seed=4)
    for k, (hidden, step, epochs) in enumerate([(3, 0.5, 10), (3, 0.5, 25), (2, 0.1, 25)]):
        for j, fold in enumerate([1, many.ALL]):
            keep = np.arange(400) % 3 != fold
            xs, ys = np.column_stack([x, np.ones(400)])[keep], y[keep]
            rng = np.random.Generator(np.random.PCG64([4, hidden]))
            w1, w2, b = rng.standard_normal((WIDTH + 1) * hidden).reshape(WIDTH + 1, hidden) * 0.3, rng.standard_normal(hidden) * 0.3, 0.0
            for _ in range(epochs):
                act = np.tanh(xs @ w1)
                off = (1 / (1 + np.exp(-(act @ w2 + b))) - ys) / len(ys)
                back = np.outer(off, w2) * (1 - act**2)
                w1, w2, b = w1 - step * xs.T @ back, w2 - step * act.T @ off, b - step * off.sum()
            assert np.allclose(found.weights[2 * k + j], np.concatenate([w1.ravel(), w2, [b]]))


def plain_tree(x, y, w, cuts, tree, nodes, least, depth, tries, seed, node=0):
    """{node: (weight, share, feature, cut)} by trying all cuts."""
    total, pos = w.sum(), (w * y).sum()
    out = {node: (total, pos / total, -1, 0.0)}
    if depth == 0:
        return out
    gini = lambda m: (w[m] * y[m]).sum() * (w[m] * (1 - y[m])).sum() / max(w[m].sum(), 1e-300)
    best = (0.0, None, None)
    for f in many.looked_at(np.array([tree]), np.array([node]), x.shape[1], tries, seed)[0]:
        for c in cuts[f]:
            left = x[:, f] <= c
            if w[left].sum() >= least and w[~left].sum() >= least:
                gain = round(gini(np.ones(len(x), bool)) - gini(left) - gini(~left), 9)
                if gain > best[0]:
                    best = (gain, f, c)
    if best[1] is None:
        return out
    out[node] = (total, pos / total, best[1], best[2])
    left = x[:, best[1]] <= best[2]
    for side, child in ((left, 2 * node + 1), (~left, 2 * node + 2)):
        out |= plain_tree(x[side], y[side], w[side], cuts, tree, nodes, least, depth - 1, tries, seed, child)
    return out


def test_forests_are_those_of_single_trees(table):
    df, x, y = table
    asked = [(n, d, leaf, split) for n in (3, 5) for d in (2, 4) for leaf in (1, 9) for split in (2, 40)]
    found = many.fit_forest(df, asked, [0, many.ALL], WIDTH, seed=3, bins=16)
    cuts = many.cuts_of(df, WIDTH, 16)
    rows = np.arange(400) * 7919
    nodes = found.trees.feature.shape[1]
    walked = {}
    for t, (leaf, fold) in enumerate(zip(found.leaf, found.fold)):
        number = t % 5
        keep = np.arange(400) % 3 != fold
        w = many.draws(rows, np.array([number]), 3)[:, 0] * keep
        on = w > 0
        want = plain_tree(x[on], y[on], w[on].astype(float), cuts, number, nodes, leaf, 4, 2, 3)
        walked[leaf, fold, number] = want
        for v in range(nodes):
            if v in want:
                weight, share, feature, cut = want[v]
                assert found.trees.weight[t, v] == weight and found.trees.share[t, v] == pytest.approx(share)
                assert found.trees.feature[t, v] == feature and (feature < 0 or found.trees.cut[t, v] == cut)
            else:
                assert found.trees.feature[t, v] == -1 and found.trees.weight[t, v] == 0
    scores = found.scores(many.Rows(rows, y, np.arange(400) % 3, x))
    for i, ((n, depth, leaf, split), fold) in enumerate(found.asked):
        for r in range(0, 400, 37):
            values = []
            for number in range(n):
                tree, v = walked[leaf, fold, number], 0
                for _ in range(depth):
                    weight, _, f, c = tree[v]
                    if f < 0 or weight < split:
                        break
                    v = 2 * v + 1 + (x[r, f] > c)
                values.append(tree[v][1])
            assert scores[r, i] == pytest.approx(np.mean(values))
    assert found.importances(WIDTH).sum() == pytest.approx(1.0) and found.importances(WIDTH).argmax() == 0


def test_poisson_draws():
    drawn = many.draws(np.arange(20_000), np.arange(20), 1)
    for k in range(5):
        assert (drawn == k).mean() == pytest.approx(np.exp(-1) / np.prod(np.arange(1, k + 1)), abs=0.003)
    assert abs(np.corrcoef(drawn[:, 0], drawn[:, 1])[0, 1]) < 0.03


def test_the_full_grids_end(spark):
    """Every setting of the registered cross-validation, fitted."""
    rows = all_queries()["model_cv"](spark, "/root/testdata/sf0.001").collect()
    count = sum(len(ML.settings(g)) for g in ML.GRIDS.values())
    assert len(rows) == 5 * count == 160 and all(0 <= r.auc <= 1 and 0 <= r.accuracy <= 1 for r in rows)


def test_small_tables_train_on_all_cores_alike(spark):
    """A small training table lies in more than one partition, and trees and weights do not depend on how it lies."""
    rng = np.random.default_rng(4)
    x = rng.normal(size=(3000, 3)).round(1)
    data = [(i, float(v[0] + 0.5 * rng.normal() > 0), i % 3, v.tolist()) for i, v in enumerate(x)]
    one = spark.createDataFrame(data, "row long, label double, fold int, features array<double>").coalesce(1)
    dealt = ML.compact(one, len(data))
    assert dealt.rdd.getNumPartitions() == min(3, spark.sparkContext.defaultParallelism)
    a, b = (many.fit_forest(df, [(4, 3, 2, 2), (4, 3, 1, 2)], [0, 1, many.ALL], 3, 42) for df in (one, dealt))
    assert all(np.array_equal(u, v) for u, v in zip(a.trees, b.trees))
    assert a.trees.feature.max() >= 0 and (a.trees.weight[:, 0] > 1500).all()
    c, d = (many.fit_networks(df, [(3, 0.1, 2), (3, 0.1, 4)], [0, many.ALL], 3, 42) for df in (one, dealt))
    assert all(u == pytest.approx(v, abs=1e-12) for u, v in zip(c.weights, d.weights))
    assert not np.allclose(c.weights[0], c.weights[2])


def test_holdout_trains_on_all_cores(spark, monkeypatch):
    """The hold-out's tuning passes over a small table use more than one task."""
    df = spark.range(2500).selectExpr("id", "cast(id % 2 as double) label", "(id % 2) * 2 + sin(id) * 3 x", "cos(id) y").coalesce(1)
    parts, fit = [], many.fit_networks
    monkeypatch.setattr(many, "fit_networks", lambda rows, *rest: parts.append(rows.rdd.getNumPartitions()) or fit(rows, *rest))
    results, _ = ML.run_models(df, "id", ["x", "y"], grids={ML.MLP: {"hidden": [2], "step": [0.1], "epochs": [2]}}, k=2)
    assert parts == [min(2, spark.sparkContext.defaultParallelism)]
    assert sorted(r.fold for r in results.collect()) == ["1", "2", "holdout"]


def test_rows_are_scored_by_the_models_of_their_fold_alone(spark, monkeypatch):
    """A setting's score of a row comes from the model that left its fold out, and no other model is run for it."""
    rng = np.random.default_rng(6)
    data = [(i, float(i % 3 == 0), i % 2, rng.normal(size=2).tolist()) for i in range(200)]
    df = spark.createDataFrame(data, "row long, label double, fold int, features array<double>")
    asked = [(3, 2, 1, 2), (2, 3, 4, 30)]
    for model in (many.fit_linear(df, [(0.0, 1.0), (5.0, 1.0)], [0, 1, many.ALL], 2), many.fit_networks(df, [(2, 0.1, 2), (3, 0.1, 2)], [0, 1, many.ALL], 2, 1), many.fit_forest(df, asked, [0, 1, many.ALL], 2, 1)):
        batch = many.Rows(np.array([r[0] for r in data]), np.array([r[1] for r in data]), np.array([r[2] for r in data]), np.array([r[3] for r in data]))
        every = model.scores(batch)
        found = many.scored(df.coalesce(1), model, {0: [0, 3], 1: [1, 4]}).collect()
        assert [r.fold for r in found] == [r[2] for r in data] and [len(r.scores) for r in found] == [2] * 200
        assert np.allclose([r.scores for r in found], [every[i, [f, 3 + f]] for i, f in enumerate(batch.fold)], atol=1e-12)
        assert np.allclose(model.only([5]).scores(batch)[:, 0], every[:, 5], atol=1e-12)
    assert len(model.leaf) == 18 and len(model.only([5]).trees.share) == 3  # of two leaf sizes and three folds, one

    sizes, score = [], many.scored
    monkeypatch.setattr(many, "scored", lambda rows, model, *places: sizes.append(len(model.folds)) or score(rows, model, *places))
    _, predict = ML.searched(df, ML.LR, {"C": [0.1, 1.0]}, 2, whole=True)
    assert predict(df, {"C": 1.0}).count() == 200 and sizes == [6, 1]


def test_trees_alike_are_counted_once(spark):
    """Trees of two leaf sizes share their counts as long as their splits are the same, and counts take few bytes."""
    feature, cut = np.array([[0, 1, -1], [0, 2, -1], [0, 1, -1], [0, 1, -1]], np.int16), np.zeros((4, 3))
    trees = many.Trees(feature, cut, cut, cut, cut)
    left, number = np.array([0, 0, 0, 1]), np.array([0, 0, 0, 0])
    assert many._alike(trees, left, number, 1) == {0: [0, 1, 2], 3: [3]}
    assert many._alike(trees, left, number, 3) == {0: [0, 2], 1: [1], 3: [3]}
    for sums, size in (([0.0, 255.0], 1), ([3.0, 256.0], 2), ([70_000.0, 1.0], 4), ([0.5, 1.0], 8), ([-1.0, 2.0], 8), ([float("nan"), 2.0], 8), ([2.0**32, 1.0], 8)):
        data = many._packed(np.array(sums))
        assert len(data) == 2 * size and np.array_equal(many._unpacked(data, 2), sums, equal_nan=True)
