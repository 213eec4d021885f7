"""Trend, growth, back-test and forecast of many short series at once.

Input is a long table at the grain (key, period). A series is as long as there
are periods, so it fits in a task; the number of series is what grows. All
operators share one shuffle by key: the windows put each series in order, and
the aggregates behind them reuse that partitioning.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketloom.functions import vocabulary as V


def indexed(df: DataFrame, keys: Sequence[str], period: str, value: str) -> DataFrame:
    """Columns keys, period, v, idx (0..n-1 in period order) and n."""
    series = df.select(*keys, period, F.col(value).cast("double").alias("v")).filter(F.col("v").isNotNull())
    whole = Window.partitionBy(*keys)
    position = F.row_number().over(whole.orderBy(period)) - 1
    return series.withColumns({"idx": position, "n": F.count(F.lit(1)).over(whole)})


def _line(where: Column | None = None) -> tuple[Column, Column]:
    """Slope and intercept of v over idx; a single point is a flat line."""
    x = F.col("idx") if where is None else F.when(where, F.col("idx"))
    y = F.col("v") if where is None else F.when(where, F.col("v"))
    several = F.count(y) > 1
    return (
        F.when(several, F.regr_slope(y, x)).otherwise(F.lit(0.0)),
        F.when(several, F.regr_intercept(y, x)).otherwise(F.avg(y)),
    )


def growth_rate(last: Column, first: Column, steps: Column) -> Column:
    """Compound growth per step; first values below 1e-9 count as 1e-9."""
    base = last / F.greatest(first, F.lit(1e-9))
    return F.pow(base, F.lit(1.0) / F.greatest(steps, F.lit(1))) - F.lit(1.0)


def _at(position: Column, value: str = "v") -> Column:
    return F.max(F.when(F.col("idx") == position, F.col(value)))


def ols_trend(df: DataFrame, keys: Sequence[str], period: str, value: str) -> DataFrame:
    """Least-squares line of each series over its index."""
    slope, intercept = _line()
    return (
        indexed(df, keys, period, value)
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n"), slope.alias("slope"), intercept.alias("intercept"))
    )


def cagr(df: DataFrame, keys: Sequence[str], period: str, value: str) -> DataFrame:
    """Compound growth rate of each series from its first to its last value.

    First and last are picked by partial aggregates, no ordering needed.
    """
    v = F.col(value).cast("double")
    ends = df.filter(v.isNotNull()).groupBy(*keys).agg(
        F.min_by(v, F.col(period)).alias("first_value"),
        F.max_by(v, F.col(period)).alias("last_value"),
        F.count(F.lit(1)).alias("n"),
    )
    return ends.withColumn("cagr", growth_rate(F.col("last_value"), F.col("first_value"), F.col("n") - 1))


def mape(actual: Column, predicted: Column) -> Column:
    """Mean absolute percentage error as an aggregate; zero actuals do not count."""
    usable = actual != 0
    return F.lit(100.0) * F.avg(F.when(usable, F.abs(actual - predicted) / F.abs(F.nullif(actual, F.lit(0.0)))))


def compounded(last: Column, rate: Column, step: Column, damp: float) -> Column:
    """Damped growth path of the back-test: every step builds on the one before.

    ``last * prod_{k<=step} (1 + rate * damp**k)``, ``step`` counting from 0.
    """
    factor = F.aggregate(
        F.sequence(F.lit(0), step), F.lit(1.0), lambda acc, k: acc * (F.lit(1.0) + rate * F.pow(F.lit(damp), k))
    )
    return last * factor


def backtest(
    df: DataFrame,
    keys: Sequence[str],
    period: str,
    value: str,
    hold: int = V.BACKTEST_HOLD,
    damp: float = V.GROWTH_DAMPING,
) -> DataFrame:
    """Percentage error of the trend and of the ensemble on the last periods.

    Up to ``hold`` periods are held out, keeping two for the fit; series of one
    or two points get NULL errors. The ensemble is the mean of the line and of
    the compounding damped growth path.
    """
    series = indexed(df, keys, period, value).withColumn(
        "hold", F.least(F.lit(hold), F.greatest(F.col("n") - 2, F.lit(0)))
    )
    fitted = F.col("idx") < F.col("n") - F.col("hold")
    slope, intercept = _line(fitted)
    held = F.collect_list(F.when(~fitted, F.struct("idx", "v")))
    fits = series.groupBy(*keys).agg(
        F.max("n").alias("n"),
        F.max("hold").alias("hold"),
        slope.alias("slope"),
        intercept.alias("intercept"),
        _at(F.lit(0)).alias("first_value"),
        _at(F.col("n") - F.col("hold") - 1).alias("last_value"),
        held.alias("held"),
    )
    fits = fits.withColumns(
        {
            "rate": growth_rate(F.col("last_value"), F.col("first_value"), F.col("n") - F.col("hold") - 1),
            # At most ``hold`` points, so the list is as small as the parameter.
            "point": F.explode_outer("held"),
        }
    )
    step = (F.col("point.idx") - (F.col("n") - F.col("hold"))).cast("int")
    line = F.col("slope") * F.col("point.idx") + F.col("intercept")
    path = F.when(F.col("point").isNotNull(), compounded(F.col("last_value"), F.col("rate"), step, damp))
    tested = fits.select(
        *keys, "n", "hold", F.col("point.v").alias("actual"), line.alias("line"), ((line + path) / 2.0).alias("ensemble")
    )
    return tested.groupBy(*keys).agg(
        F.max("n").alias("n"),
        F.max("hold").alias("hold"),
        mape(F.col("actual"), F.col("line")).alias("mape_ols"),
        mape(F.col("actual"), F.col("ensemble")).alias("mape_ensemble"),
    )


def forecast(
    df: DataFrame,
    keys: Sequence[str],
    period: str,
    value: str,
    horizon: int = V.FORECAST_HORIZON,
    damp: float = V.GROWTH_DAMPING,
    start: int | None = None,
) -> DataFrame:
    """Mean of the line and of damped growth from the last value, never below 0.

    Unlike in the back-test, each step restarts from the last value:
    ``last * (1 + rate * damp**step)``, ``step`` counting from 1. Periods follow
    each series' last one, or begin at ``start`` for all.
    """
    slope, intercept = _line()
    fits = (
        indexed(df, keys, period, value)
        .groupBy(*keys)
        .agg(
            F.max("n").alias("n"),
            slope.alias("slope"),
            intercept.alias("intercept"),
            _at(F.lit(0)).alias("first_value"),
            _at(F.col("n") - 1).alias("last_value"),
            F.max(period).alias("last_period"),
        )
        .withColumn("rate", growth_rate(F.col("last_value"), F.col("first_value"), F.col("n") - 1))
    )
    steps = fits.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(horizon))))
    line = F.col("slope") * (F.col("n") + F.col("step") - 1) + F.col("intercept")
    damped = F.col("last_value") * (F.lit(1.0) + F.col("rate") * F.pow(F.lit(damp), F.col("step")))
    base = F.col("last_period") if start is None else F.lit(start - 1)
    return steps.select(
        *keys, (base + F.col("step")).cast("int").alias(period), F.greatest(F.lit(0.0), (line + damped) / 2.0).alias(value)
    )


def _sums(points: Column) -> Column:
    """Regression sums (n, x, y, xx, xy) of (idx, v) points."""
    start = F.struct(*[F.lit(0.0).alias(c) for c in ("n", "x", "y", "xx", "xy")])

    def add(s: Column, p: Column) -> Column:
        x, y = p["idx"].cast("double"), p["v"]
        return F.struct(
            (s["n"] + 1.0).alias("n"), (s["x"] + x).alias("x"), (s["y"] + y).alias("y"), (s["xx"] + x * x).alias("xx"), (s["xy"] + x * y).alias("xy")
        )

    return F.aggregate(points, start, add)


def _fitted(s: Column) -> tuple[Column, Column]:
    """Slope and intercept out of regression sums; a single point is a flat line."""
    spread = s["n"] * s["xx"] - s["x"] * s["x"]
    slope = F.when(s["n"] > 1, (s["n"] * s["xy"] - s["x"] * s["y"]) / F.nullif(spread, F.lit(0.0))).otherwise(F.lit(0.0))
    return slope, (s["y"] - slope * s["x"]) / F.nullif(s["n"], F.lit(0.0))


def forecast_table(
    df: DataFrame,
    keys: Sequence[str],
    period: str,
    value: str,
    horizon: int = V.FORECAST_HORIZON,
    hold: int = V.BACKTEST_HOLD,
    damp: float = V.GROWTH_DAMPING,
    start: int | None = None,
) -> DataFrame:
    """Actual rows followed by forecast rows that carry the back-test error.

    The figures are those of ``forecast`` and ``backtest``, from one aggregate
    per series and so one scan of ``df``: a series, as long as there are
    periods, is put in order once; the back-test's line takes the last
    ``hold`` points off the regression sums of all.
    """
    point = F.struct(F.col(period).alias("t"), F.col(value).cast("double").alias("v"))
    series = df.groupBy(*keys).agg(F.sort_array(F.collect_list(point)).alias("rows"))
    known = F.filter("rows", lambda p: p["v"].isNotNull())
    series = series.withColumn("pts", F.transform(known, lambda p, i: F.struct(i.alias("idx"), p["t"].alias("t"), p["v"].alias("v"))))
    series = series.withColumn("n", F.size("pts"))
    series = series.withColumn("h", F.least(F.lit(hold), F.greatest(F.col("n") - 2, F.lit(0))))
    kept = (F.col("n") - F.col("h")).alias("kept")
    series = series.select("*", kept, _sums(F.col("pts")).alias("whole"), F.slice("pts", F.col("n") - F.col("h") + 1, F.col("h")).alias("held"))
    series = series.withColumn("off", _sums(F.col("held")))
    series = series.withColumn("part", F.struct(*[(F.col(f"whole.{c}") - F.col(f"off.{c}")).alias(c) for c in ("n", "x", "y", "xx", "xy")]))
    slope, intercept = _fitted(F.col("whole"))
    part_slope, part_intercept = _fitted(F.col("part"))
    at = lambda i: F.get("pts", i)["v"]
    series = series.withColumns(
        {
            "slope": slope, "intercept": intercept, "part_slope": part_slope, "part_intercept": part_intercept, "last": at(F.col("n") - 1),
            "rate": growth_rate(at(F.col("n") - 1), at(F.lit(0)), F.col("n") - 1),
            "part_rate": growth_rate(at(F.col("kept") - 1), at(F.lit(0)), F.col("kept") - 1),
        }
    )

    def error(p: Column) -> Column:
        line = F.col("part_slope") * p["idx"] + F.col("part_intercept")
        path = compounded(at(F.col("kept") - 1), F.col("part_rate"), (p["idx"] - F.col("kept")).cast("int"), damp)
        return F.abs(p["v"] - (line + path) / 2.0) / F.abs(p["v"])

    errors = F.transform(F.filter("held", lambda p: p["v"] != 0), error)
    mean = F.lit(100.0) * F.aggregate(errors, F.lit(0.0), lambda s, e: s + e) / F.nullif(F.size(errors), F.lit(0))
    base = F.get("pts", F.col("n") - 1)["t"] if start is None else F.lit(start - 1)

    def ahead(k: Column) -> Column:
        line = F.col("slope") * (F.col("n") + k - 1) + F.col("intercept")
        damped = F.col("last") * (F.lit(1.0) + F.col("rate") * F.pow(F.lit(damp), k))
        return F.struct(
            (base + k).cast("int").alias("t"), F.greatest(F.lit(0.0), (line + damped) / 2.0).alias("v"), F.lit("forecast").alias("type"), F.col("mape").alias("mape")
        )

    actual = F.transform("rows", lambda p: F.struct(p["t"].cast("int").alias("t"), p["v"].alias("v"), F.lit("actual").alias("type"), F.lit(None).cast("double").alias("mape")))
    steps = F.when(F.col("n") > 0, F.transform(F.sequence(F.lit(1), F.lit(horizon)), ahead))
    both = series.withColumn("mape", F.round(mean, 2)).select(*keys, F.explode(F.concat(actual, F.coalesce(steps, F.slice(actual, 1, 0)))).alias("r"))
    return both.select(
        *keys, F.col("r.t").alias(period), F.round("r.v", 1).alias(value), F.col("r.type").alias("type"), F.col("r.mape").alias("mape_backtest_pct")
    )
