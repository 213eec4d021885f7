"""A/B comparison, bootstrap, power and sample size."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.functions import vocabulary as V
from marketloom.functions.columns import ratio
from marketloom.functions.probability import normal_quantile, normal_two_sided, student_t_two_sided


def _side_by_side(df: DataFrame, arm: str, values: Sequence[str], arms: Sequence, keys: Sequence[str] = ()) -> DataFrame:
    """One row with ``value_a``, ``value_b`` out of one row per arm."""
    picks = [
        F.max(F.when(F.col(arm) == F.lit(a), F.col(v))).alias(f"{v}_{side}") for v in values for a, side in zip(arms, "ab")
    ]
    return df.groupBy(*keys).agg(*picks) if keys else df.agg(*picks)


def welch(df: DataFrame, arm: str, value: str, arms: Sequence = (0, 1)) -> DataFrame:
    """Welch's t-test of two arms: one row.

    One pass of count, mean and sample variance per arm; the rest works on two
    rows. ``t`` is 0 without variance. ``p_value`` is two-sided from Student's
    t, ``p_normal`` from the normal approximation.
    """
    per_arm = (
        df.filter(F.col(arm).isin(list(arms)))
        .groupBy(arm)
        .agg(F.count(value).alias("n"), F.avg(value).alias("mean"), F.var_samp(value).alias("var"))
    )
    row = _side_by_side(per_arm, arm, ("n", "mean", "var"), arms)
    ea, eb = F.col("var_a") / F.col("n_a"), F.col("var_b") / F.col("n_b")
    se = F.sqrt(ea + eb)
    t = F.when(se > 0, (F.col("mean_a") - F.col("mean_b")) / F.nullif(se, F.lit(0.0))).otherwise(F.lit(0.0))
    freedom = (ea + eb) ** 2 / (ea**2 / (F.col("n_a") - 1) + eb**2 / (F.col("n_b") - 1) + F.lit(1e-12))
    enough = (F.col("n_a") > 1) & (F.col("n_b") > 1)
    row = row.withColumns({"t_stat": F.when(enough, t), "dof": F.when(enough, freedom)})
    return row.withColumns(
        {"p_normal": normal_two_sided(F.col("t_stat")), "p_value": student_t_two_sided(F.col("t_stat"), F.col("dof"))}
    )


# Replicate weights drawn from one SHA-256 digest: eight numbers of 32 bits.
DRAWS_PER_DIGEST = 8


def _poisson_cuts() -> list[str]:
    """``P(X <= k)`` of Poisson(1) in units of 2**-32, as 8 hex digits.

    Fixed-width hex digits sort like the number, so a draw is compared with the
    cuts byte by byte and never converted.
    """
    cuts, cdf, term = [], 0.0, math.exp(-1.0)
    for k in range(1, 40):
        cdf += term
        term /= k
        cut = math.ceil(cdf * 2.0**32)
        if cut >= 2**32:
            return cuts
        cuts.append(f"{cut:08x}")
    return cuts


def _poisson_weight(draw: Column) -> Column:
    chain = None
    cuts = _poisson_cuts()
    for weight, cut in enumerate(cuts):
        below = draw < F.lit(bytearray(cut.encode()))
        chain = F.when(below, F.lit(weight)) if chain is None else chain.when(below, F.lit(weight))
    return chain.otherwise(F.lit(len(cuts)))


def _interval(means: DataFrame, arm: str, n_boot: int, level: float, arms: Sequence) -> DataFrame:
    """Order statistics of the mean difference b - a; at most ``n_boot`` values."""
    diffs = _side_by_side(means, arm, ("mean",), arms, ["rep"]).select((F.col("mean_b") - F.col("mean_a")).alias("diff"))
    tail = (1.0 - level) / 2.0
    # A replicate that gives an arm no weight has no difference; ranks count the others.
    ordered = diffs.filter("diff is not null").agg(F.sort_array(F.collect_list("diff")).alias("ordered"))
    rank = lambda share: F.floor(F.round(F.size("ordered") * share, 9)).cast("int")
    return ordered.select(F.get("ordered", rank(tail)).alias("ci_low"), F.get("ordered", rank(1.0 - tail) - 1).alias("ci_high"))


def bootstrap_ci(
    df: DataFrame,
    arm: str,
    value: str,
    ids: Sequence[str],
    n_boot: int = V.BOOTSTRAP_REPLICATES,
    seed: int = V.SEED,
    level: float = V.BOOTSTRAP_LEVEL,
    arms: Sequence = (0, 1),
) -> DataFrame:
    """Percentile interval of mean(b) - mean(a) by a Poisson bootstrap.

    Resampling with replacement gives every row a near Poisson(1) count per
    replicate; the count comes from a hash of (seed, ids, replicate), so it does
    not depend on partitioning or retries. One digest serves eight replicates.
    Rows are exploded and summed within the scan's stage, and each task sends
    ``arms x n_boot / 8`` rows on, however many it read.
    """
    blocks = math.ceil(n_boot / DRAWS_PER_DIGEST)
    rows = df.filter(F.col(arm).isin(list(arms)) & F.col(value).isNotNull()).select(
        F.col(arm).alias("_arm"),
        F.col(value).cast("double").alias("_value"),
        F.concat_ws("|", F.lit(str(seed)), *[F.col(i).cast("string") for i in ids]).alias("_id"),
    )
    # A small file is read by one task, and each row costs hundreds of digests.
    rows = rows.repartition(df.sparkSession.sparkContext.defaultParallelism)
    # As bytes, a draw is cut out by position; text would be walked from its start.
    digest = F.sha2(F.concat_ws("|", "_id", F.col("_block").cast("string")), 256).cast("binary")
    exploded = rows.select("_arm", "_value", "_id", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("_block"))
    digests = exploded.select("_arm", "_value", "_block", digest.alias("_digest"))
    span = range(DRAWS_PER_DIGEST)
    draws = digests.select(
        "_arm", "_value", "_block", *[F.substring("_digest", 8 * j + 1, 8).alias(f"_d{j}") for j in span]
    )
    weights = draws.select("_arm", "_value", "_block", *[_poisson_weight(F.col(f"_d{j}")).alias(f"_w{j}") for j in span])
    sums = weights.groupBy("_arm", "_block").agg(
        *[F.sum(f"_w{j}").alias(f"_n{j}") for j in span],
        *[F.sum(F.col(f"_w{j}") * F.col("_value")).alias(f"_s{j}") for j in span],
    )
    replicates = F.array(*[F.struct(F.lit(j).alias("j"), F.col(f"_n{j}").alias("n"), F.col(f"_s{j}").alias("s")) for j in span])
    means = (
        sums.select("_arm", "_block", F.explode(replicates).alias("r"))
        .select(
            F.col("_arm").alias(arm),
            (F.col("_block") * DRAWS_PER_DIGEST + F.col("r.j")).alias("rep"),
            ratio(F.col("r.s"), F.col("r.n")).alias("mean"),
        )
        .filter(F.col("rep") < n_boot)
    )
    return _interval(means, arm, n_boot, level, arms)


# Attempts of a draw; one in a hundred thousand billion needs more, and gets the mean.
ATTEMPTS = 16
# Below this mean a draw inverts the distribution function, above it accepts or rejects.
SMALL_MEAN = 10.0


def _log_factorial(k: Column) -> Column:
    """ln k! by Stirling's series ten numbers further on."""
    x = k + 10.0
    series = x * F.log(x) - x + 0.5 * F.log(F.lit(2.0 * math.pi) * x) + 1.0 / (12.0 * x) - 1.0 / (360.0 * x * x * x) + 1.0 / (1260.0 * x * x * x * x * x)
    product = k + 1.0
    for i in range(2, 11):
        product = product * (k + float(i))
    return series - F.log(product)


def poisson_draw(mean: Column, *key: Column) -> Column:
    """A Poisson number of the given mean from MD5 hashes of the key, as a double: equal keys draw alike, in SQL too.

    Small means invert the distribution function. Others take a transformed
    uniform number that lies close to the distribution (Hoermann's PTRS) and
    accept it by the exact ratio, which most attempts pass; each attempt has
    two uniform numbers from a digest of its own.
    """
    text = F.concat_ws("|", *key)

    def uniform(digest: Column, at: int) -> Column:
        return (F.conv(F.substring(digest, at, 13), 16, 10).cast("double") + 0.5) / 2.0**52

    def digest(t: Column) -> Column:
        return F.md5(F.concat_ws("|", text, t.cast("string")))

    root = F.sqrt(mean)
    b = 0.931 + 2.53 * root
    a = -0.059 + 0.02483 * b
    inverse = 1.1239 + 1.1328 / (b - 3.4)
    fast = 0.9277 - 3.6224 / (b - 2.0)

    def attempt(state: Column, t: Column) -> Column:
        u, v = uniform(digest(t), 1) - 0.5, uniform(digest(t), 14)
        us = 0.5 - F.abs(u)
        k = F.floor((2.0 * a / us + b) * u + mean + 0.43).cast("double")
        ratio_of = F.log(v) + F.log(inverse) - F.log(a / (us * us) + b)
        exact = ratio_of <= -mean + k * F.log(mean) - _log_factorial(F.greatest(k, F.lit(0.0)))
        good = ((us >= 0.07) & (v <= fast)) | ((k >= 0) & ~((us < 0.013) & (v > us)) & exact)
        return F.when(state.isNotNull(), state).when(good, k)

    def below(state: Column, k: Column) -> Column:
        # (number of values the uniform number is not below, probability of the next, sum so far)
        found = F.when(state["u"] >= state["sum"] + state["p"], state["k"] + 1.0).otherwise(state["k"])
        return F.struct(found.alias("k"), (state["p"] * mean / (k + 1)).alias("p"), (state["sum"] + state["p"]).alias("sum"), state["u"].alias("u"))

    start = F.struct(F.lit(0.0).alias("k"), F.exp(-mean).alias("p"), F.lit(0.0).alias("sum"), uniform(digest(F.lit(0)), 1).alias("u"))
    inverted = F.aggregate(F.sequence(F.lit(0), F.lit(79)), start, below)["k"]
    tried = F.aggregate(F.sequence(F.lit(0), F.lit(ATTEMPTS - 1)), F.lit(None).cast("double"), attempt)
    return F.when(mean < SMALL_MEAN, inverted).otherwise(F.coalesce(tried, F.floor(mean).cast("double")))


def bootstrap_ci_counts(
    df: DataFrame,
    arm: str,
    value: str,
    n_boot: int = V.BOOTSTRAP_REPLICATES,
    seed: int = V.SEED,
    level: float = V.BOOTSTRAP_LEVEL,
    arms: Sequence = (0, 1),
) -> DataFrame:
    """The same interval for a value with few distinct levels, such as an outcome.

    Rows are first counted per (arm, value). ``n`` equal rows weigh a sum of n
    Poisson(1) counts, which is one Poisson(n) count (``poisson_draw``), so
    nothing is lost and the cost no longer depends on the number of rows.
    """
    counted = (
        df.filter(F.col(arm).isin(list(arms)) & F.col(value).isNotNull())
        .groupBy(F.col(arm).alias("_arm"), F.col(value).alias("_value"))
        .agg(F.count(F.lit(1)).cast("double").alias("_n"))
        .select("*", F.explode(F.sequence(F.lit(0), F.lit(n_boot - 1))).alias("rep"))
    )
    weight = poisson_draw(F.col("_n"), F.lit(str(seed)), *[F.col(c).cast("string") for c in ("_arm", "_value", "rep")])
    # The alias must not be a column's name: within a lambda it would stand for the new column.
    drawn = counted.select("_arm", F.col("_value").cast("double").alias("_number"), "rep", weight.alias("_w"))
    means = drawn.groupBy(F.col("_arm").alias(arm), "rep").agg(ratio(F.sum(F.col("_w") * F.col("_number")), F.sum("_w")).alias("mean"))
    return _interval(means, arm, n_boot, level, arms)


def _quick_z(alpha: float, power: float) -> float:
    """Sum of both quantiles; the usual 5 % and 80 % each at four digits."""
    z_alpha = V.Z_QUICK_ALPHA_05 if alpha == 0.05 else normal_quantile(1.0 - alpha)
    return z_alpha + (V.Z_QUICK_POWER_80 if power == 0.80 else normal_quantile(power))


def needed_per_arm(base: Column, effect: Column, alpha: float = 0.05, power: float = 0.80) -> Column:
    """Rows per arm to find ``effect`` on a rate (one-sided z, unpooled variance)."""
    other = base + effect
    variance = base * (F.lit(1.0) - base) + other * (F.lit(1.0) - other)
    return F.ceil(variance * F.lit(_quick_z(alpha, power) ** 2) / F.nullif(effect * effect, F.lit(0.0))).cast("bigint")


def power_by_group(
    df: DataFrame, group: str, outcome: str, effects: Sequence[float], alpha: float = 0.05, power: float = 0.80
) -> DataFrame:
    """Rows per arm for each effect, from each group's observed base rate."""
    rates = df.groupBy(group).agg(F.avg(F.col(outcome).cast("double")).alias("base_rate"))
    grid = rates.select(group, "base_rate", F.explode(F.array(*[F.lit(float(e)) for e in effects])).alias("effect"))
    return grid.withColumn("n_per_arm", needed_per_arm(F.col("base_rate"), F.col("effect"), alpha, power))


def _z_pair(alpha: float, power: float, two_sided: bool) -> tuple[float, float]:
    if alpha == 0.05:
        z_alpha = V.Z_TWO_SIDED_05 if two_sided else V.Z_ONE_SIDED_05
    else:
        z_alpha = normal_quantile(1.0 - alpha / (2.0 if two_sided else 1.0))
    return z_alpha, V.Z_POWER_80 if power == 0.80 else normal_quantile(power)


def size_two_proportions(p1: Column, p2: Column, alpha: float = 0.05, power: float = 0.80, two_sided: bool = True) -> Column:
    """Rows per arm for two rates, pooled under the null and unpooled otherwise."""
    z_alpha, z_power = _z_pair(alpha, power, two_sided)
    pooled = (p1 + p2) / 2.0
    null = F.lit(z_alpha) * F.sqrt(F.lit(2.0) * pooled * (F.lit(1.0) - pooled))
    alternative = F.lit(z_power) * F.sqrt(p1 * (F.lit(1.0) - p1) + p2 * (F.lit(1.0) - p2))
    gap = p2 - p1
    return F.ceil((null + alternative) ** 2 / F.nullif(gap * gap, F.lit(0.0))).cast("bigint")


def size_continuous(
    mean1: Column, mean2: Column, sd: Column, alpha: float = 0.05, power: float = 0.80, two_sided: bool = True
) -> Column:
    """Rows per arm for two means with a common standard deviation."""
    z = sum(_z_pair(alpha, power, two_sided))
    gap = mean2 - mean1
    return F.ceil(F.lit(2.0 * z**2) * sd * sd / F.nullif(gap * gap, F.lit(0.0))).cast("bigint")


def sample_size(
    scenarios: DataFrame, kind: str, alpha: float = 0.05, power: float = 0.80, two_sided: bool = True
) -> DataFrame:
    """``n_per_arm`` and ``total_n`` for each scenario row.

    ``two_proportion`` needs columns p1 and p2, ``continuous`` mean1, mean2, sd.
    """
    if kind == "two_proportion":
        n = size_two_proportions(F.col("p1"), F.col("p2"), alpha, power, two_sided)
    elif kind == "continuous":
        n = size_continuous(F.col("mean1"), F.col("mean2"), F.col("sd"), alpha, power, two_sided)
    else:
        raise ValueError(f"unknown kind {kind!r}")
    return scenarios.withColumns({"type": F.lit(kind), "n_per_arm": n}).withColumn("total_n", F.col("n_per_arm") * 2)


def ab_summary(
    df: DataFrame,
    arm: str,
    value: str,
    ids: Sequence[str] = (),
    arms: Sequence = (0, 1),
    n_boot: int = V.BOOTSTRAP_REPLICATES,
    seed: int = V.SEED,
    base_rate: float | None = 0.052,
    method: str = "counts",
    provenance: int | None = None,
) -> DataFrame:
    """One row with rates, lift, Welch test, interval and needed rows per arm.

    The first arm is the control. ``base_rate=None`` takes the control's own
    rate for the power formula. ``method="counts"`` bootstraps counted values,
    for outcomes on very large tables.
    """
    if method == "rows":
        interval = bootstrap_ci(df, arm, value, ids, n_boot, seed, arms=arms)
    else:
        interval = bootstrap_ci_counts(df, arm, value, n_boot, seed, arms=arms)
    both = interval.select(F.struct("ci_low", "ci_high").alias("ci")).scalar()
    row = welch(df, arm, value, arms).withColumn("ci", both)
    control, test = F.col("mean_a"), F.col("mean_b")
    percent = lambda c, digits: F.round(F.lit(100.0) * c, digits)
    base = control if base_rate is None else F.lit(base_rate)
    return row.select(
        F.col("n_a").alias("n_control"),
        F.col("n_b").alias("n_test"),
        percent(control, 2).alias("conv_control_pct"),
        percent(test, 2).alias("conv_test_pct"),
        percent(ratio(test - control, control), 2).alias("lift_pct"),
        F.round("t_stat", 3).alias("t_stat"),
        F.round("p_value", 4).alias("p_value"),
        percent(F.col("ci.ci_low"), 2).alias("ci_low_pct"),
        percent(F.col("ci.ci_high"), 2).alias("ci_high_pct"),
        needed_per_arm(base, test - control).alias("needed_n"),
        *([] if provenance is None else [F.lit(provenance).alias("is_simulated")]),
    )
