"""Classifiers, grid search, hold-out evaluation and importances."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from itertools import product

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.storagelevel import StorageLevel

from marketloom.functions import vocabulary as V
from marketloom.operators import blocks, many, metrics
from marketloom.operators.features import zscore_apply, zscore_fit
from marketloom.operators.split import stratified_folds, stratified_holdout

KINDS = ("Logistic Regression", "Random Forest", "Neural Network")
LR, RF, MLP = KINDS
GRIDS: dict[str, Mapping[str, Sequence]] = {LR: V.LR_GRID, RF: V.RF_GRID, MLP: V.MLP_GRID}
Params = dict[str, float]


def settings(grid: Mapping[str, Sequence]) -> list[Params]:
    """Every combination of a grid, in the order of its keys."""
    return [dict(zip(grid, values)) for values in product(*grid.values())]


def train(kind: str, rows: DataFrame, grid: Sequence[Mapping[str, float]], folds: Sequence[int], width: int, seed: int = V.SEED):
    """One model for each setting and fold, setting by setting, trained together (``operators.many``).

    ``C`` is the inverse penalty of the summed logistic loss, ``elastic`` the
    share of its L1 part. Forests draw rows by Poisson weights and try
    sqrt(width) features a node. The network has one layer of tanh units and
    plain gradient descent. Runs the passes.
    """
    if kind == LR:
        penalties = [(p.get("elastic", 0.0) / p.get("C", 1.0), (1.0 - p.get("elastic", 0.0)) / p.get("C", 1.0)) for p in grid]
        return many.fit_linear(rows, penalties, folds, width)
    if kind == RF:
        return many.fit_forest(rows, [(p.get("trees", 200), p.get("depth", 6), p.get("min_leaf", 1), p.get("min_split", 2)) for p in grid], folds, width, seed)
    if kind == MLP:
        return many.fit_networks(rows, [(p.get("hidden", 8), p.get("step", 0.1), p.get("epochs", 300)) for p in grid], folds, width, seed)
    raise ValueError(f"unknown classifier {kind!r}")


def training_rows(df: DataFrame, fold_col: str | None = None) -> DataFrame:
    """The rows that ``train`` takes, of ``features`` (vector or array), ``label`` and perhaps a fold.

    ``row`` tells rows apart when a forest draws them; without such a column
    their place in ``df`` does, which then has to be stored.
    """
    row = F.col("row") if "row" in df.columns else F.monotonically_increasing_id()
    vector = not isinstance(df.schema["features"].dataType, T.ArrayType)
    return df.select(
        row.cast("long").alias("row"),
        F.col("label").cast("double").alias("label"),
        (F.col(fold_col) if fold_col else F.lit(0)).cast("int").alias("fold"),
        (vector_to_array("features") if vector else F.col("features")).alias("features"),
    )


def assemble(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """``df`` with the dense inputs as one vector column ``features``."""
    metrics.check_names(features)
    return VectorAssembler(inputCols=list(features), outputCol="features").transform(df)


def compact(df: DataFrame, rows: int, rows_per_task: int = 50_000) -> DataFrame:
    """As many partitions as a training table of ``rows`` is worth: each fit runs many short jobs, on all cores."""
    return blocks.spread(df, rows, rows_per_task)


def grid_search(df: DataFrame, kind: str, grid: Mapping[str, Sequence], width: int, fold_col: str = "fold", seed: int = V.SEED) -> DataFrame:
    """One row per setting and fold: (model, setting, params, fold, auc, accuracy).

    ``df`` has ``features``, ``label`` and a fold column, and should be cached.
    All settings and folds are trained in the same passes; each row then gets
    its score from every setting's model that left its fold out. Figures are
    not rounded, so that close settings do not tie. A fold with one class has
    a NULL auc. Runs jobs; what comes back to the driver is models and one row
    per setting and fold.
    """
    return searched(df, kind, grid, width, fold_col, seed)[0]


def searched(df: DataFrame, kind: str, grid: Mapping[str, Sequence], width: int, fold_col: str = "fold", seed: int = V.SEED, whole: bool = False):
    """The table of ``grid_search`` and, with ``whole``, a function that scores other rows.

    The function takes (rows, setting) and gives (label, score) by that
    setting's model of all rows of ``df``, which is trained along.
    """
    rows = training_rows(df, fold_col)
    folds = sorted(r[0] for r in rows.select("fold").distinct().collect())
    listed, trained = settings(grid), [*folds, *[many.ALL] * whole]
    model = train(kind, rows, listed, trained, width, seed)
    outside = {f: [i * len(trained) + k for i in range(len(listed))] for k, f in enumerate(folds)}
    found = many.scored(rows, model, outside).select("label", "fold", F.posexplode("scores").alias("setting", "score"))
    named = found.select(F.col("setting").cast("string").alias("model"), (F.col("fold") + 1).cast("string").alias("fold"), "score", "label")
    # The metrics pass over the predictions several times; the models run once.
    predictions = named.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        measured = metrics.model_table(predictions, digits=None).collect()
    finally:
        predictions.unpersist()
    params = [json.dumps(p) for p in listed]
    table = [(kind, int(r["model"]), params[int(r["model"])], r["fold"], r["auc"], r["accuracy"]) for r in measured]
    results = df.sparkSession.createDataFrame(
        table, "model string, setting int, params string, fold string, auc double, accuracy double"
    )

    def predict(test: DataFrame, params: Mapping[str, float]) -> DataFrame:
        place = listed.index(dict(params)) * len(trained) + len(folds)
        return many.scored(training_rows(test), model.only([place])).select("label", F.col("scores")[0].alias("score"))

    return results, predict if whole else None


def best_setting(results: DataFrame) -> tuple[Params, float | None]:
    """Setting with the highest mean AUC over its folds; the first one wins ties.

    Folds without an AUC do not count; without any, the defaults (no parameters)
    are returned. Reads one row.
    """
    means = results.groupBy("setting", "params").agg(F.avg("auc").alias("auc"))
    top = means.filter(F.col("auc").isNotNull()).orderBy(F.desc("auc"), "setting").limit(1).collect()
    return (json.loads(top[0]["params"]), top[0]["auc"]) if top else ({}, None)


def feature_importance(train_on: DataFrame, features: Sequence[str], seed: int = V.SEED) -> DataFrame:
    """(model, feature, value, rank): coefficients and forest importances.

    Both models have fixed settings; ``rank`` is by absolute value within the
    model, since the two scales do not compare. ``train_on`` holds the
    standardised vector as ``scaled`` and the raw one as ``features``.
    """
    width = len(features)
    raw = training_rows(train_on)
    linear = train(LR, training_rows(train_on.drop("features").withColumnRenamed("scaled", "features")), [{"C": 1.0}], [many.ALL], width, seed)
    forest = train(RF, raw, [{"trees": 200, "depth": 8}], [many.ALL], width, seed)
    values = [("LR", f, float(v)) for f, v in zip(features, linear.weights[0])]
    values += [("RF", f, float(v)) for f, v in zip(features, forest.importances(width))]
    ranked = [
        (m, f, v, sum(1 for n, g, w in values if n == m and (-abs(w), g) < (-abs(v), f)) + 1) for m, f, v in values
    ]
    return train_on.sparkSession.createDataFrame(ranked, "model string, feature string, value double, rank int")


def top_importances(importances: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` largest values of both models together, by absolute value."""
    return importances.orderBy(F.abs("value").desc(), "model", "feature").limit(n)


def run_models(
    df: DataFrame,
    id_col: str,
    features: Sequence[str],
    label: str = "label",
    grids: Mapping[str, Mapping[str, Sequence]] = GRIDS,
    k: int = V.FOLDS,
    seed: int = V.SEED,
) -> tuple[DataFrame, DataFrame] | None:
    """Tuned cross-validation and hold-out results, and importances.

    An 80/20 stratified hold-out stays out of the tuning; inputs are scaled with
    the training rows' moments. Per model the best setting's folds are reported,
    then the hold-out. Returns ``(results, importances)``, or None below 30 rows.
    Runs jobs.
    """
    columns = [id_col, *features]
    split = stratified_holdout(df.select(*columns, F.col(label).cast("double").alias("label")), id_col, "label", seed=seed)
    split = split.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        train, test = split.filter("is_train"), split.filter(~F.col("is_train"))
        rows = train.count()
        if split.count() < V.MIN_MODEL_ROWS:
            return None
        stats = zscore_fit(train, features)

        def prepare(part: DataFrame, *keep: str) -> DataFrame:
            raw = assemble(part, features).withColumnRenamed("features", "raw")
            scaled = assemble(zscore_apply(raw, stats, features, eps=1e-9), features)
            ready = scaled.select(F.xxhash64(id_col).alias("row"), "label", *keep, "raw", F.col("features").alias("scaled"))
            return compact(ready, rows).persist(StorageLevel.MEMORY_AND_DISK)

        folds = prepare(stratified_folds(train.drop("is_train"), id_col, "label", k, seed), "fold")
        held = prepare(test)
        try:
            results = None
            for kind, grid in grids.items():
                # Trees do not depend on the scale of their inputs.
                vector = "raw" if kind == RF else "scaled"
                inputs = folds.select("row", "label", "fold", F.col(vector).alias("features"))
                found, predict = searched(inputs, kind, grid, len(features), seed=seed, whole=True)
                params, _ = best_setting(found)
                if not params:
                    # No fold has an AUC: report the folds at the defaults.
                    found, predict = searched(inputs, kind, {}, len(features), seed=seed, whole=True)
                wanted = F.lit(json.dumps(params))
                chosen = found.filter(F.col("params") == wanted).select("model", "fold", "auc", "accuracy")
                cv = metrics.rounded(chosen)
                outside = held.select("row", "label", F.col(vector).alias("features"))
                named = predict(outside, params).select(F.lit(kind).alias("model"), F.lit("holdout").alias("fold"), "score", "label")
                part = cv.unionByName(metrics.model_table(named))
                # The result is a handful of rows; fixing them here frees the caches.
                fixed = df.sparkSession.createDataFrame(part.collect(), part.schema)
                results = fixed if results is None else results.unionByName(fixed)
            importances = feature_importance(
                folds.select("row", "label", "scaled", F.col("raw").alias("features")), features, seed
            )
        finally:
            folds.unpersist()
            held.unpersist()
    finally:
        split.unpersist()
    return results, importances
