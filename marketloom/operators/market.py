"""Market queries over a sales fact: shares, growth, launches, signals.

All of them work on a table at the grain (keys, period). ``period_totals``
brings any fact to that grain; from there on a key has at most one row per
period, so no window or join below ever sees a hot key's raw rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketloom.functions.columns import ratio


def period_totals(
    fact: DataFrame,
    keys: Sequence[str],
    measures: Mapping[str, Column],
    dimension: DataFrame | None = None,
    on: str | None = None,
    fact_cols: Sequence[str] = (),
) -> DataFrame:
    """Sums of ``measures`` per ``keys``, some of which come from ``dimension``.

    The fact is summed per (``on``, ``fact_cols``) before the join, whose kind
    is left to Spark: however many rows one join key
    holds, each task sends one row per key and period into the shuffle, and the
    join itself has no skew left.
    """
    sums = [F.sum(c).alias(n) for n, c in measures.items()]
    if dimension is None:
        return fact.groupBy(*keys).agg(*sums)
    partial = fact.groupBy(on, *fact_cols).agg(*sums)
    return partial.join(dimension, on).groupBy(*keys).agg(*[F.sum(n).alias(n) for n in measures])


def count_totals(
    fact: DataFrame,
    keys: Sequence[str],
    measures: Mapping[str, Column],
    dimension: DataFrame,
    on: str,
    fact_cols: Sequence[str] = (),
    count_as: str = "n",
) -> DataFrame:
    """Row count and sums per ``keys``, counted before the dimension join."""
    return period_totals(fact, keys, {count_as: F.lit(1), **measures}, dimension, on, fact_cols)


def distribution(df: DataFrame, keys: Sequence[str], value: str, count_as: str, sum_as: str) -> DataFrame:
    """``COUNT(*)`` and a sum per key combination."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_as), F.sum(value).alias(sum_as))


def share_of_period(df: DataFrame, period: str, value: str, share_as: str = "share_pct", digits: int = 2) -> DataFrame:
    """Each row's share of its period's total, in percent.

    Totals are a two-phase aggregate joined back; a window over the period
    would put a whole period in one task.
    """
    totals = df.groupBy(period).agg(F.sum(value).alias("_period_total"))
    share = F.round(F.lit(100.0) * ratio(F.col(value), F.col("_period_total")), digits)
    return df.join(totals, period).withColumn(share_as, share).drop("_period_total")


def growth(
    df: DataFrame, keys: Sequence[str], period: str, value: str, growth_as: str = "yoy_growth_pct", digits: int = 1
) -> DataFrame:
    """Change against the previous row of the same key, in percent.

    The first row of a key and rows after a zero give NULL. "Previous" means
    the previous row present, not the previous calendar period.
    """
    w = Window.partitionBy(*keys).orderBy(period)
    current = F.col(value).cast("double")
    before = F.lag(value).over(w).cast("double")
    return df.withColumn(growth_as, F.round(F.lit(100.0) * ratio(current - before, before), digits))


def launch_curve(df: DataFrame, keys: Sequence[str], period: str, index_as: str = "years_since_launch") -> DataFrame:
    """Index of the period since the key's first period, starting at 1."""
    first = F.min(period).over(Window.partitionBy(*keys))
    return df.withColumn(index_as, (F.col(period) - first + F.lit(1)).cast("int"))


def base_vs_latest(
    df: DataFrame,
    keys: Sequence[str],
    period: str,
    value: str,
    base: int,
    real: Column | None = None,
    base_as: str = "value_base",
    latest_as: str = "value_latest",
) -> DataFrame:
    """Value in ``base`` next to the value in the latest period, per key.

    The latest period is the last one with rows that satisfy ``real``; so are
    the base rows, while latest rows are taken whatever their provenance. Keys
    missing in either period are dropped.

    ``df`` is read once if it ends in a shuffle, as ``period_totals`` does:
    the latest period is a scalar subquery over the very same plan, whose
    shuffle Spark reuses. So nothing is filtered before the sums, which
    would make two plans of it; rows are few at this grain.
    """
    is_base = F.col(period) == F.lit(base)
    if real is not None:
        is_base = is_base & real
    return (
        df.withColumn("_is_latest", F.col(period) == latest_period(df, period, value, keys, real))
        .groupBy(*keys)
        .agg(
            F.sum(F.when(is_base, F.col(value))).alias(base_as),
            F.sum(F.when(F.col("_is_latest"), F.col(value))).alias(latest_as),
        )
        .filter(F.col(base_as).isNotNull() & F.col(latest_as).isNotNull())
    )


def latest_period(df: DataFrame, period: str, value: str, keys: Sequence[str], real: Column | None = None) -> Column:
    """The last period with rows that satisfy ``real``, as a scalar subquery that needs all columns of ``df``.

    Column pruning would else give the subquery a plan, and scan, of its own.
    """
    wanted = F.col(period) if real is None else F.when(real, F.col(period))
    return df.agg(F.struct(F.max(wanted).alias("latest"), F.max(F.struct(*keys, value)).alias("rest")).alias("s")).scalar()["latest"]


def signal_rollup(
    df: DataFrame, keys: Sequence[str], reports: str, serious: str, limit: int | None = 20
) -> DataFrame:
    """Report and serious totals with the serious rate, largest first.

    Ties are ordered by the keys, so a ``limit`` always keeps the same rows.
    """
    rolled = (
        df.groupBy(*keys)
        .agg(F.sum(reports).alias("total_reports"), F.sum(serious).alias("serious_reports"))
        .filter(F.col("total_reports") > 0)
        .withColumn(
            "serious_rate_pct",
            F.round(F.lit(100.0) * ratio(F.col("serious_reports"), F.col("total_reports")), 1),
        )
        .orderBy(F.desc("total_reports"), *keys)
    )
    return rolled if limit is None else rolled.limit(limit)


def market_size(
    df: DataFrame, period: str, value: str, where: Column, flag: str = "is_simulated", scale: float = 1000.0
) -> DataFrame:
    """Value of one market in a larger unit, with its provenance flag kept."""
    size = F.round(F.col(value).cast("double") / F.lit(scale), 2).alias("market_usd_bn")
    return df.filter(where).select(period, size, flag)
