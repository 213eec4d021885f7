"""Pivot, top-n per group and latest-period reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def pivot_wide(
    df: DataFrame, x: str, series: str | None, y: str, values: Sequence[str] = (), order: str | Sequence[str] = ()
) -> DataFrame:
    """One row per ``x``, one column per series value; the last row by ``order`` wins.

    The series values are found by a job; Spark limits their number
    (``spark.sql.pivotMaxValues``). If ``values`` are given they set the
    columns, and a series that they leave out is an error. Without ``series`` the result has the one column ``y``. Missing
    cells are NULL. Numeric ``x`` sort before text, by value.
    """
    order = [order] if isinstance(order, str) else list(order)
    last = F.max_by(F.col(y), F.struct(*order) if len(order) > 1 else F.col(order[0])) if order else F.last(y)
    grouped = df.groupBy(x)
    if series is None:
        wide = grouped.agg(last.alias(y))
    elif values:
        others = df.filter(~F.col(series).isin(list(values))).select(series).distinct().take(5)
        if others:
            raise ValueError(f"series without a column: {[r[0] for r in others]}")
        wide = grouped.pivot(series, list(values)).agg(last)
    else:
        wide = grouped.pivot(series).agg(last)
    return wide.orderBy(*axis_order(F.col(x)))


def axis_order(c: Column) -> list[Column]:
    """Sort order of an axis: numbers by value first, then text."""
    text = c.cast("string")
    number = text.try_cast("double")
    return [number.isNull(), number, text]


def top_per_group(df: DataFrame, group: str | Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """First ``n`` rows of each group.

    A plain ``row_number <= n`` lets Spark cut every group to ``n`` rows per
    task before the shuffle, so a hot group sends no more than a cold one.
    """
    group = [group] if isinstance(group, str) else list(group)
    ranked = df.withColumn("rank", F.row_number().over(Window.partitionBy(*group).orderBy(*order)))
    return ranked.filter(F.col("rank") <= n)


def latest_top(df: DataFrame, period: str, value: str, n: int, ties: Sequence[str]) -> DataFrame:
    """The ``n`` largest rows of the latest period.

    One pass: the first ``n`` rows by period and value, of which those of an
    earlier period than the first are left out.
    """
    top = df.filter(F.col(period).isNotNull()).orderBy(F.desc(period), F.desc(value), *ties).limit(n)
    latest = F.max(period).over(Window.partitionBy(F.lit(0)))  # over n rows
    kept = top.withColumn("_latest", latest).filter(F.col(period) == F.col("_latest")).drop("_latest")
    return kept.orderBy(F.desc(value), *ties)


def segment_profile(df: DataFrame, segment: str, features: Sequence[str], digits: int = 4) -> DataFrame:
    """Row count and mean of each feature per segment."""
    means = [F.round(F.avg(f), digits).alias(f"avg_{f}") for f in features]
    return df.groupBy(segment).agg(F.count(F.lit(1)).alias("n"), *means)
