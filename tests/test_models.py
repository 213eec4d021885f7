import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from marketloom.operators import cluster as C
from marketloom.operators import metrics as M
from marketloom.operators import models as ML
from marketloom.operators import split as SP

QUICK = settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))


def pairwise(rows):
    pos, neg = [s for s, y in rows if y], [s for s, y in rows if not y]
    if not pos or not neg:
        return None
    return sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg))


def test_auc_with_ties(spark):
    rows = list(zip((0.1, 0.4, 0.4, 0.4, 0.8, 0.8, 0.3), (0, 0, 1, 1, 1, 0, 0)))
    df = spark.createDataFrame(rows, "s double, y int")
    assert M.auc(df, "s", "y").first().auc == pytest.approx(0.708333, abs=1e-6)
    assert M.auc(df.filter("y = 1"), "s", "y").first().auc is None


@QUICK
@given(st.lists(st.tuples(st.integers(0, 6), st.integers(0, 1)), min_size=1, max_size=40), st.integers(1, 9))
def test_auc_is_the_pairwise_probability(spark, rows, buckets):
    df = spark.createDataFrame([(float(s), y) for s, y in rows], "s double, y int")
    got, want = M.auc(df, "s", "y", buckets=buckets).first().auc, pairwise(rows)
    assert got is None if want is None else got == pytest.approx(want)


def test_grouped_auc_with_a_hot_group_and_a_hot_score(spark):
    rng = random.Random(3)
    rows = [("hot", 0.5 if rng.random() < 0.5 else rng.random(), rng.randint(0, 1)) for _ in range(600)]
    rows += [("cold", rng.random() * 9, rng.randint(0, 1)) for _ in range(50)] + [("one", 1.0, 1)]
    df = spark.createDataFrame(rows, "g string, s double, y int").repartition(16)
    got = {r.g: r.auc for r in M.auc(df, "s", "y", ["g"], buckets=32).collect()}
    assert got["one"] is None
    for g in ("hot", "cold"):
        assert got[g] == pytest.approx(pairwise([(s, y) for h, s, y in rows if h == g]))


@pytest.mark.parametrize("partitions", [1, 64])
def test_folds_and_holdout(spark, partitions):
    rows = [(i, i % 3 == 0) for i in range(301)]
    df = spark.createDataFrame(rows, "id long, y boolean").repartition(partitions)
    folds = SP.stratified_folds(df, "id", "y", k=5).collect()
    assert sorted(r.id for r in folds) == list(range(301))
    for y in (True, False):
        sizes = [sum(r.fold == f and r.y == y for r in folds) for f in range(5)]
        assert max(sizes) - min(sizes) <= 1
    held = SP.stratified_holdout(df, "id", "y").collect()
    assert {y: sum(r.is_train for r in held if r.y == y) for y in (True, False)} == {True: 80, False: 160}
    # Positions equal those of a plain sort by hash.
    from hashlib import md5

    order = sorted((md5(f"42|{i}".encode()).hexdigest(), i) for i, y in rows if y)
    assert {r.id: r.fold for r in folds if r.y} == {i: n % 5 for n, (_, i) in enumerate(order)}


def test_leakage_scan(spark):
    rows = [(i % 2, 5.0 - i % 2, float(i % 7), 1.0) for i in range(100)]
    df = spark.createDataFrame(rows, "y int, inverse double, noise double, same double")
    leaks = {r.feature: r.leaks for r in M.leakage_scan(df, ["inverse", "noise", "same"], "y").collect()}
    assert leaks == {"inverse": True, "noise": False, "same": False}
    with pytest.raises(ValueError, match="is_active_status"):
        M.check_names(["x", "is_active_status"])


def test_model_summary(spark):
    rows = [("a", "1", 0.9), ("a", "2", None), ("a", "holdout", 0.6), ("b", "1", 0.8), ("b", "2", 0.7), ("b", "holdout", 0.7)]
    df = spark.createDataFrame(rows, "model string, fold string, auc double")
    by_holdout = {r.model: (r.cv_auc, r.best) for r in M.model_summary(df).collect()}
    assert by_holdout == {"a": (0.9, False), "b": (0.75, True)}
    assert {r.model for r in M.model_summary(df, by="cv").collect() if r.best} == {"a"}


POINTS = [(0.0, 0.0), (0.1, 0.0), (0.0, 0.1), (10.0, 10.0), (10.1, 10.0), (10.0, 10.1), (20.0, 20.0), (20.1, 20.0), (20.0, 20.1)]


def test_kmeans_separates_clusters(spark):
    df = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(POINTS)], "id int, x double, y double").repartition(3)
    segments = {r.id: r.segment for r in C.kmeans_segments(df, ["x", "y"], k=3, seeds=(1, 2, 3)).collect()}
    groups = [{segments[i] for i in range(g, g + 3)} for g in (0, 3, 6)]
    assert all(len(g) == 1 for g in groups) and len(set.union(*groups)) == 3


def test_kmeans_ends_at_a_fixed_point(spark):
    """Every point is at its nearest mean, missing values and repeated points too; no rows give no rows."""
    rng = random.Random(2)
    rows = [(i, rng.gauss(i % 3 * 2, 1), rng.gauss(i % 2, 1)) for i in range(300)] + [(1000 + i, 0.5, 0.5) for i in range(100)]
    df = spark.createDataFrame(rows, "id int, x double, y double")
    got = C.kmeans_segments(df.repartition(5), ["x", "y"], k=5, seeds=(3, 4), key="id").collect()
    again = C.kmeans_segments(df.coalesce(1), ["x", "y"], k=5, seeds=(3, 4), key="id").collect()
    assert sorted(got) == sorted(again)
    xs = [[r.x for r in got], [r.y for r in got]]
    mean, sd = [sum(v) / 400 for v in xs], [(sum(a * a for a in v) / 400 - (sum(v) / 400) ** 2) ** 0.5 for v in xs]
    z = [((r.x - mean[0]) / sd[0], (r.y - mean[1]) / sd[1]) for r in got]
    groups = {s: [p for p, r in zip(z, got) if r.segment == s] for s in {r.segment for r in got}}
    centre = {s: (sum(a for a, _ in g) / len(g), sum(b for _, b in g) / len(g)) for s, g in groups.items()}
    far = lambda p, s: (p[0] - centre[s][0]) ** 2 + (p[1] - centre[s][1]) ** 2
    assert all(far(p, r.segment) <= min(far(p, s) for s in centre) + 1e-6 for p, r in zip(z, got)) and len(centre) == 5
    odd = spark.createDataFrame([(1, None, 1.0), (2, float("nan"), 1.0), (3, 1.0, 1.0)], "id int, x double, y double")
    assert {r.segment for r in C.kmeans_segments(odd, ["x", "y"], k=4, seeds=(1,), key="id").collect()} <= set(range(4))
    assert not C.kmeans_segments(odd.limit(0), ["x", "y"]).collect()


def test_lloyd_steps_never_raise_the_cost(spark):
    rng = random.Random(5)
    rows = [(i, [rng.random(), rng.random(), rng.random()]) for i in range(80)]
    df = spark.createDataFrame(rows, "id int, v array<double>")
    centres = spark.createDataFrame([(0, rows[0][1]), (1, rows[1][1]), (2, [9.0, 9.0, 9.0])], "segment int, centre array<double>")
    costs = []
    for _ in range(3):
        costs.append(C.assign_nearest(df, "v", centres).agg(F.sum("distance")).first()[0])
        moved = C.lloyd_step(df, "v", centres)
        kept = {r.segment: r for r in moved.collect()}
        centres = spark.createDataFrame([(s, r.centre) for s, r in kept.items()], "segment int, centre array<double>")
    assert costs == sorted(costs, reverse=True)
    assert kept[2].n == 0 and kept[2].centre == [9.0, 9.0, 9.0]


def test_nearest_tie_goes_to_the_lowest_segment(spark):
    df = spark.createDataFrame([([1.0],)], "v array<double>")
    centres = spark.createDataFrame([(1, [2.0]), (0, [0.0])], "segment int, centre array<double>")
    assert C.assign_nearest(df, "v", centres).first().segment == 0


GRIDS = {ML.LR: {"C": [0.1, 1.0], "elastic": [0.0, 0.5]}, ML.RF: {"trees": [5], "depth": [3], "min_leaf": [1]}, ML.MLP: {"hidden": [3], "step": [0.1], "epochs": [15]}}


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(9)
    rows = []
    for i in range(200):
        a, b = rng.gauss(0, 1), rng.gauss(0, 1)
        rows.append((i, a, b, int(a + 0.5 * rng.gauss(0, 1) > 0)))
    return spark.createDataFrame(rows, "id int, a double, b double, label int")


def test_run_models(spark, labelled):
    results, importances = ML.run_models(labelled, "id", ["a", "b"], grids=GRIDS, k=3)
    rows = results.collect()
    assert sorted((r.model, r.fold) for r in rows) == sorted((m, f) for m in GRIDS for f in ("1", "2", "3", "holdout"))
    assert all(0 <= r.auc <= 1 and 0 <= r.accuracy <= 1 for r in rows)
    assert all(r.auc > 0.75 for r in rows if r.model == ML.LR)
    top = ML.top_importances(importances, 2).collect()
    assert {r.feature for r in importances.filter("rank = 1").collect()} == {"a"} and top[0].feature == "a"


def test_too_few_rows_and_default_setting(spark, labelled):
    assert ML.run_models(labelled.limit(20), "id", ["a", "b"], grids=GRIDS) is None
    none = spark.createDataFrame([(0, "{}", None)], "setting int, params string, auc double")
    assert ML.best_setting(none) == ({}, None)
    tie = spark.createDataFrame([(1, '{"C": 2}', 0.7), (0, '{"C": 1}', 0.7)], "setting int, params string, auc double")
    assert ML.best_setting(tie) == ({"C": 1}, 0.7)


def test_holdout_is_the_same_for_features_and_models(spark):
    """The split depends on ids and classes only, not on the other columns or their types."""
    rows = [(f"NCT{i}", "Completed" if i % 3 else "Active", float(i)) for i in range(90)]
    trials = spark.createDataFrame(rows, "nct_id string, status string, x double")
    from marketloom.operators.features import with_label

    labelled = with_label(trials)
    first = {r.nct_id for r in SP.stratified_holdout(labelled, "nct_id", "label").collect() if r.is_train}
    doubled = labelled.select("x", "nct_id", F.col("label").cast("double")).repartition(9)
    assert first == {r.nct_id for r in SP.stratified_holdout(doubled, "nct_id", "label").collect() if r.is_train}
    assert len(first) == 72
