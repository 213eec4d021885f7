"""AUC, accuracy, leakage scan and model summaries over prediction tables."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketloom.functions import vocabulary as V
from marketloom.functions.columns import flag, ratio


# Ranges of scores that are ranked apart; a range holds distinct scores only.
SCORE_RANGES = 200


def _ranged(counts: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    """The counts with ``_range``, the number of their score's range at approximate quantiles of the distinct scores.

    The cuts come from a mergeable quantile sketch over the counts, in a
    scalar subquery that needs all their columns: so it is the same plan, and
    the counts' shuffle is used for both. A row is compared with every
    ``step``-th cut, then with those up to the next.
    """
    if buckets < 2:
        return counts.withColumn("_range", F.lit(0))
    step = math.isqrt(buckets)
    finite = F.when(F.abs("_score") < float("inf"), F.col("_score"))
    sketch = F.percentile_approx(finite, [i / buckets for i in range(1, buckets)], 20 * buckets)
    found = counts.agg(sketch.alias("cuts"), F.max(F.struct(*keys, "_score", "_pos", "_neg")).alias("rest"))
    cuts = F.coalesce("cuts", F.array().cast("array<double>"))
    heads = F.filter(cuts, lambda c, i: i % step == step - 1)
    both = found.select(F.struct(cuts.alias("cuts"), heads.alias("heads"), "rest").alias("s")).scalar()
    below = lambda c: c <= F.col("_score")
    placed = counts.withColumn("_cuts", both).withColumn("_head", F.size(F.filter("_cuts.heads", below)))
    inside = F.size(F.filter(F.slice("_cuts.cuts", F.col("_head") * step + 1, F.lit(step)), below))
    return placed.withColumn("_range", F.col("_head") * step + inside).drop("_cuts", "_head")


def auc(
    df: DataFrame,
    score: str,
    label: str,
    group: Sequence[str] = (),
    buckets: int = SCORE_RANGES,
    cut: float | None = None,
    overall: str | None = None,
) -> DataFrame:
    """Area under the ROC curve, ties counted half; NULL with one class only.

    Rows without a score (NULL or NaN) take no part, here and in
    ``accuracy_at``; infinite scores do.

    ``cut`` adds the accuracy of ``score >= cut`` from the same counts, and
    ``overall``, for one text group, a row of that name over all groups.

    Rows are counted per distinct score first, in one scan. The scores are
    then cut into ranges at approximate quantiles; each range ranks its own
    scores, and only one row per range is put in order overall. Any cuts give
    the exact result, they just balance the work.
    """
    keys = list(group)
    scored = df.select(*keys, F.col(score).cast("double").alias("_score"), F.col(label).alias("_label")).filter(
        F.col("_score").isNotNull() & ~F.isnan("_score")
    )
    counts = scored.groupBy(*keys, "_score").agg(
        F.count_if(F.col("_label") == 1).cast("double").alias("_pos"),
        F.count_if(F.col("_label") == 0).cast("double").alias("_neg"),
    )
    ranged = _ranged(counts, keys, buckets)
    if overall is not None:
        (name,) = keys
        whole = ranged.groupBy("_score", "_range").agg(F.sum("_pos").alias("_pos"), F.sum("_neg").alias("_neg"))
        ranged = ranged.unionByName(whole.withColumn(name, F.lit(overall)))
    inside = Window.partitionBy(*keys, "_range").orderBy("_score").rowsBetween(Window.unboundedPreceding, -1)
    below = F.coalesce(F.sum("_neg").over(inside), F.lit(0.0))
    per_range = (
        ranged.withColumn("_wins", F.col("_pos") * (below + F.col("_neg") / 2.0))
        .groupBy(*keys, "_range")
        .agg(
            F.sum("_wins").alias("_wins"),
            F.sum("_pos").alias("_pos"),
            F.sum("_neg").alias("_neg"),
            F.sum(F.when(F.col("_score") >= (cut or 0.0), F.col("_pos")).otherwise(F.col("_neg"))).alias("_hits"),
        )
    )
    # One row per range and group from here on.
    across = Window.partitionBy(*(keys or [F.lit(0)])).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges_below = F.coalesce(F.sum("_neg").over(across), F.lit(0.0))
    total = per_range.withColumn("_wins", F.col("_wins") + F.col("_pos") * ranges_below).groupBy(*keys)
    accuracy = [] if cut is None else [ratio(F.sum("_hits"), F.sum("_pos") + F.sum("_neg")).alias("accuracy")]
    return total.agg(
        F.sum("_pos").cast("bigint").alias("n_pos"),
        F.sum("_neg").cast("bigint").alias("n_neg"),
        ratio(F.sum("_wins"), F.sum("_pos") * F.sum("_neg")).alias("auc"),
        *accuracy,
    )


def accuracy_at(df: DataFrame, score: str, label: str, cut: float = 0.5, group: Sequence[str] = ()) -> DataFrame:
    """Share of the rows with a score where ``score >= cut`` agrees with the label."""
    df = df.filter(F.col(score).isNotNull() & ~F.isnan(F.col(score).cast("double")))
    hit = (F.col(score) >= cut).cast("int") == F.col(label)
    totals = [F.count(F.lit(1)).alias("n"), F.avg(flag(hit).cast("double")).alias("accuracy")]
    return df.groupBy(*group).agg(*totals) if group else df.agg(*totals)


def check_names(columns: Sequence[str], banned: Sequence[str] = V.LEAKING_NAMES) -> None:
    """Raise if a feature is known to be derived from the label."""
    leaked = sorted(set(columns) & set(banned))
    if leaked:
        raise ValueError(f"features derived from the label: {', '.join(leaked)}")


def leakage_scan(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    threshold: float = 0.99,
    banned: Sequence[str] = V.LEAKING_NAMES,
) -> DataFrame:
    """AUC of every feature on its own; a near perfect one gives the label away."""
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("v")) for c in features])
    long = df.select(F.col(label).alias("label"), F.explode(pairs).alias("p")).select("label", "p.feature", "p.v")
    scan = auc(long, "v", "label", ["feature"])
    separation = F.greatest(F.col("auc"), F.lit(1.0) - F.col("auc"))
    suspect = (separation > threshold) | F.col("feature").isin(list(banned))
    return scan.select("feature", "auc", separation.alias("separation"), F.coalesce(suspect, F.lit(False)).alias("leaks"))


def model_table(
    predictions: DataFrame, score: str = "score", label: str = "label", cut: float = 0.5, digits: int | None = 4
) -> DataFrame:
    """(model, fold, auc, accuracy) out of predictions keyed by model and fold.

    ``fold`` is text: the number of a fold or ``holdout``. ``digits=None`` leaves
    the figures as they are, for choosing between models.
    """
    keys = ["model", "fold"]
    measured = auc(predictions, score, label, keys, cut=cut).select(*keys, "auc", "accuracy")
    return measured if digits is None else rounded(measured, digits)


def rounded(table: DataFrame, digits: int = 4) -> DataFrame:
    """A model table with figures for reports."""
    return table.withColumns({c: F.round(c, digits) for c in ("auc", "accuracy")})


def model_summary(results: DataFrame, by: str = "holdout") -> DataFrame:
    """Mean CV AUC and hold-out AUC per model; ``best`` marks the top model ``by`` either.

    One-class folds have no AUC and are left out of the mean. Ties go to the
    alphabetically first model.
    """
    held = F.col("fold") == "holdout"
    per_model = results.groupBy("model").agg(
        F.avg(F.when(~held, F.nanvl(F.col("auc"), F.lit(None)))).alias("cv_auc"),
        F.max(F.when(held, F.col("auc"))).alias("holdout_auc"),
    )
    column = {"holdout": "holdout_auc", "cv": "cv_auc"}[by]
    # One row per model is left, so one window over all of them is small.
    rank = F.struct(-F.coalesce(F.col(column), F.lit(-1.0)), F.col("model"))
    best = F.min_by("model", rank).over(Window.partitionBy(F.lit(0)))
    return per_model.withColumn("best", F.col("model") == best)
