"""Repeatable stratified splits without a task per class."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketloom.functions import vocabulary as V
from marketloom.functions.columns import hash_order

# Three hex digits: 4096 buckets per class, of equal size up to chance.
BUCKET_DIGITS = 3


def class_positions(df: DataFrame, id_col: str, label: str, seed: int = V.SEED) -> DataFrame:
    """``df`` with ``position`` in its class's hash order and ``class_size``.

    A window over the class would sort a class in one task. Here rows are
    ranked inside buckets of their hash prefix, and each bucket is shifted by
    the sizes of the buckets before it: the same positions, in many tasks. The
    bucket sizes are ``classes x 4096`` rows at most. ``id_col`` must be unique.
    """
    digest = hash_order(seed, F.col(id_col))
    hashed = df.withColumns({"_hash": digest, "_bucket": F.substring(digest, 1, BUCKET_DIGITS)})
    sizes = hashed.groupBy(label, "_bucket").agg(F.count(F.lit(1)).alias("_size"))
    in_class = Window.partitionBy(label)
    before = in_class.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        F.col(label).alias("_label"),
        F.col("_bucket").alias("_in"),
        F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"),
        F.sum("_size").over(in_class).alias("class_size"),
    )
    local = F.row_number().over(Window.partitionBy(label, "_bucket").orderBy("_hash", id_col)) - 1
    ranked = hashed.withColumn("_local", local)
    joined = ranked.join(offsets, ranked[label].eqNullSafe(F.col("_label")) & (F.col("_bucket") == F.col("_in")))
    return joined.select(*df.columns, (F.col("_offset") + F.col("_local")).alias("position"), "class_size")


def stratified_folds(df: DataFrame, id_col: str, label: str, k: int = V.FOLDS, seed: int = V.SEED) -> DataFrame:
    """``df`` with ``fold`` in 0..k-1; class counts of two folds differ by one at most."""
    placed = class_positions(df, id_col, label, seed)
    return placed.select(*df.columns, (F.col("position") % k).cast("int").alias("fold"))


def stratified_holdout(
    df: DataFrame, id_col: str, label: str, train_share: float = V.TRAIN_SHARE, seed: int = V.SEED
) -> DataFrame:
    """``df`` with ``is_train``: the first ``floor(share * n)`` rows of each class."""
    placed = class_positions(df, id_col, label, seed)
    taken = F.col("position") < F.floor(F.lit(train_share) * F.col("class_size"))
    return placed.select(*df.columns, taken.alias("is_train"))
