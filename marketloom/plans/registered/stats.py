"""Statistics over events: arms are even and odd users."""

from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import functions as F

from marketloom.operators import stats as S

from .base import QuerySet, table

SET = QuerySet()


def arms(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id",
        "event_type",
        (F.col("user_id") % 2).cast("int").alias("arm"),
        "value",
        F.when(F.col("event_type") == "purchase", 1).otherwise(0).alias("bought"),
        F.when(F.col("value") > 90, 1).otherwise(0).alias("high"),
    )


def welch_sql(value: str) -> str:
    return f"""
    WITH a AS (SELECT user_id % 2 AS arm, {value} AS v FROM events),
    s AS (SELECT COUNT(v) FILTER (WHERE arm = 0) AS n_a, COUNT(v) FILTER (WHERE arm = 1) AS n_b,
                 AVG(v) FILTER (WHERE arm = 0) AS mean_a, AVG(v) FILTER (WHERE arm = 1) AS mean_b,
                 VAR_SAMP(v) FILTER (WHERE arm = 0) AS var_a, VAR_SAMP(v) FILTER (WHERE arm = 1) AS var_b FROM a),
    t AS (SELECT *, (mean_a - mean_b) / sqrt(var_a / n_a + var_b / n_b) AS t,
                 pow(var_a / n_a + var_b / n_b, 2)
                 / (pow(var_a / n_a, 2) / (n_a - 1) + pow(var_b / n_b, 2) / (n_b - 1) + 1e-12) AS dof FROM s),
    grid AS (SELECT i, CASE WHEN i = 0 OR i = 4000 THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END AS weight
             FROM range(4001) r(i)),
    area AS (SELECT SUM(weight * exp(lgamma((dof + 1) / 2) - lgamma(dof / 2)) / sqrt(dof * pi())
                        * pow(1 + pow(abs(t) * i / 4000, 2) / dof, -(dof + 1) / 2)) * abs(any_value(t)) / 4000 / 3 AS inside
             FROM t, grid),
    e AS (SELECT 1 / (1 + 0.3275911 * abs(t) / sqrt(2.0)) AS u FROM t)
    SELECT n_a, n_b, mean_a, mean_b, var_a, var_b, t AS t_stat, dof,
           ((((1.061405429 * u - 1.453152027) * u + 1.421413741) * u - 0.284496736) * u + 0.254829592) * u
             * exp(-t * t / 2) AS p_normal,
           1 - 2 * inside AS p_value
    FROM t, area, e
    """


@SET.add(
    "welch_t",
    f"""
    SELECT CAST(n_a AS BIGINT) AS n_a, CAST(n_b AS BIGINT) AS n_b, ROUND(mean_a, 6) AS mean_a, ROUND(mean_b, 6) AS mean_b,
           ROUND(var_a, 4) AS var_a, ROUND(var_b, 4) AS var_b, ROUND(t_stat, 6) AS t_stat, ROUND(dof, 4) AS dof,
           ROUND(p_normal, 6) AS p_normal, ROUND(p_value, 6) AS p_value FROM ({welch_sql('value')})
    """,
)
def welch_t(spark, sf_dir):
    digits = {"mean_a": 6, "mean_b": 6, "var_a": 4, "var_b": 4, "t_stat": 6, "dof": 4, "p_normal": 6, "p_value": 6}
    row = S.welch(arms(spark, sf_dir), "arm", "value")
    return row.select("n_a", "n_b", *[F.round(c, d).alias(c) for c, d in digits.items()])


def bootstrap_sql(value: str) -> str:
    """2000 replicates; the cuts are the Poisson(1) distribution function."""
    cuts = ", ".join(f"exp(-1.0::DOUBLE) * ({' + '.join(f'1.0::DOUBLE / factorial({i})' for i in range(k + 1))})" for k in range(13))
    return f"""
    WITH cuts AS MATERIALIZED (SELECT [{cuts}] AS c),
    d AS (SELECT user_id % 2 AS arm, {value} AS v, b, sha256('42|' || event_id || '|' || b) AS digest
          FROM events, range(250) r(b)),
    w AS (SELECT arm, v, b, j, ('0x' || substr(digest, CAST(8 * j + 1 AS INT), 8))::BIGINT / 4294967296.0::DOUBLE AS u
          FROM d, range(8) s(j)),
    m AS (SELECT b * 8 + j AS rep, arm, SUM(k * v) / SUM(k) AS mean
          FROM (SELECT arm, v, b, j, len(list_filter(c, lambda x: u >= x)) AS k FROM w, cuts) GROUP BY 1, 2),
    o AS (SELECT list_sort(list(diff)) AS diffs FROM (
          SELECT MAX(mean) FILTER (WHERE arm = 1) - MAX(mean) FILTER (WHERE arm = 0) AS diff FROM m GROUP BY rep))
    SELECT diffs[51] AS ci_low, diffs[1950] AS ci_high FROM o
    """


@SET.add("bootstrap_ci", f"SELECT ROUND(ci_low, 6) AS ci_low, ROUND(ci_high, 6) AS ci_high FROM ({bootstrap_sql('value')})")
def bootstrap_ci(spark, sf_dir):
    interval = S.bootstrap_ci(arms(spark, sf_dir), "arm", "value", ["event_id"])
    return interval.select(F.round("ci_low", 6).alias("ci_low"), F.round("ci_high", 6).alias("ci_high"))


BOUGHT = "CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END"


def counted_bootstrap_sql(value: str) -> str:
    """2000 replicates of counted values; every count here is large enough for draws by acceptance."""
    uniform = lambda at: f"((('0x' || substr(digest, {at}, 13))::BIGINT + 0.5) / 4503599627370496.0::DOUBLE)"
    x = "(greatest(k, 0) + 10.0::DOUBLE)"
    product = " * ".join(f"(greatest(k, 0) + {i}.0::DOUBLE)" for i in range(1, 11))
    log_factorial = (
        f"({x} * ln({x}) - {x} + 0.5 * ln(2 * pi() * {x}) + 1 / (12 * {x}) - 1 / (360 * pow({x}, 3)) + 1 / (1260 * pow({x}, 5)) - ln({product}))"
    )
    return f"""
    WITH n AS (SELECT user_id % 2 AS arm, {value} AS v, CAST(COUNT(*) AS DOUBLE) AS n FROM events GROUP BY 1, 2),
    h AS (SELECT *, 0.931::DOUBLE + 2.53::DOUBLE * sqrt(n) AS b FROM n),
    d AS (SELECT *, -0.059::DOUBLE + 0.02483::DOUBLE * b AS a, md5('42|' || arm || '|' || v || '|' || rep || '|' || t) AS digest
          FROM h, range(2000) r(rep), range(16) s(t)),
    u AS (SELECT *, {uniform(1)} - 0.5 AS u, {uniform(14)} AS w FROM d),
    k AS (SELECT *, 0.5 - abs(u) AS us, floor((2 * a / (0.5 - abs(u)) + b) * u + n + 0.43::DOUBLE) AS k FROM u),
    g AS (SELECT *, (us >= 0.07 AND w <= 0.9277::DOUBLE - 3.6224::DOUBLE / (b - 2)) OR (k >= 0 AND NOT (us < 0.013 AND w > us)
              AND ln(w) + ln(1.1239::DOUBLE + 1.1328::DOUBLE / (b - 3.4::DOUBLE)) - ln(a / (us * us) + b) <= -n + k * ln(n) - {log_factorial}) AS good
          FROM k),
    c AS (SELECT arm, v, rep, arg_min(k, t) AS k FROM g WHERE good GROUP BY 1, 2, 3),
    m AS (SELECT rep, arm, SUM(k * v) / SUM(k) AS mean FROM c GROUP BY 1, 2),
    o AS (SELECT list_sort(list(diff)) AS diffs FROM (
          SELECT MAX(mean) FILTER (WHERE arm = 1) - MAX(mean) FILTER (WHERE arm = 0) AS diff FROM m GROUP BY rep))
    SELECT diffs[51] AS ci_low, diffs[1950] AS ci_high FROM o
    """


@SET.add("bootstrap_ci_counts", f"SELECT ROUND(ci_low, 9) AS ci_low, ROUND(ci_high, 9) AS ci_high FROM ({counted_bootstrap_sql(BOUGHT)})")
def bootstrap_ci_counts(spark, sf_dir):
    """Bounds from counted values: the same draws in SQL."""
    interval = S.bootstrap_ci_counts(arms(spark, sf_dir), "arm", "bought")
    return interval.select(F.round("ci_low", 9).alias("ci_low"), F.round("ci_high", 9).alias("ci_high"))


def ab_sql(interval: str) -> str:
    return f"""
    SELECT CAST(n_a AS BIGINT) AS n_control, CAST(n_b AS BIGINT) AS n_test, ROUND(100 * mean_a, 2) AS conv_control_pct,
           ROUND(100 * mean_b, 2) AS conv_test_pct, ROUND(100 * ((mean_b - mean_a) / NULLIF(mean_a, 0)), 2) AS lift_pct,
           ROUND(t_stat, 3) AS t_stat, ROUND(p_value, 4) AS p_value,
           ROUND(100 * ci_low, 2) AS ci_low_pct, ROUND(100 * ci_high, 2) AS ci_high_pct,
           CAST(ceil((0.052 * 0.948 + (0.052 + mean_b - mean_a) * (1 - 0.052 - mean_b + mean_a))
                * pow(1.6449 + 0.8416, 2) / pow(mean_b - mean_a, 2)) AS BIGINT) AS needed_n, 0 AS is_simulated
    FROM ({welch_sql(BOUGHT)}), ({interval})
    """


@SET.add("ab_summary", ab_sql(bootstrap_sql(BOUGHT)))
def ab_summary(spark, sf_dir):
    """Every event is drawn in every replicate."""
    return S.ab_summary(arms(spark, sf_dir), "arm", "bought", ["event_id"], method="rows", provenance=0)


def counted_ab_summary(spark, sf_dir):
    """The same row with the interval of ``bootstrap_ci_counts``."""
    return S.ab_summary(arms(spark, sf_dir), "arm", "bought", provenance=0)


@SET.add(
    "power_by_group",
    """
    SELECT event_type, ROUND(p, 6) AS base_rate, effect,
           CAST(ceil((p * (1 - p) + (p + effect) * (1 - p - effect)) * pow(1.6449 + 0.8416, 2) / (effect * effect)) AS BIGINT)
             AS n_per_arm
    FROM (SELECT event_type, AVG(CASE WHEN value > 90 THEN 1.0 ELSE 0.0 END) AS p FROM events GROUP BY 1),
         (VALUES (0.01::DOUBLE), (0.02), (0.05)) e(effect)
    """,
)
def power_by_group(spark, sf_dir):
    sizes = S.power_by_group(arms(spark, sf_dir), "event_type", "high", [0.01, 0.02, 0.05])
    return sizes.withColumn("base_rate", F.round("base_rate", 6))


PAIRS = ((0.05, 0.80), (0.01, 0.90), (0.10, 0.95))


def _pairs_sql() -> str:
    """The usual pair with its four-digit quantiles, the others with the real ones."""
    inverse = NormalDist().inv_cdf
    z = {(0.05, 0.80): 1.6449 + 0.8416}
    rows = ", ".join(f"({a}::DOUBLE, {p}::DOUBLE, {z.get((a, p), inverse(1 - a) + inverse(p))!r}::DOUBLE)" for a, p in PAIRS)
    return f"""
    SELECT event_type, alpha, power, effect,
           CAST(ceil((p * (1 - p) + (p + effect) * (1 - p - effect)) * z * z / (effect * effect)) AS BIGINT) AS n_per_arm
    FROM (SELECT event_type, AVG(CASE WHEN value > 90 THEN 1.0 ELSE 0.0 END) AS p FROM events GROUP BY 1),
         (VALUES (0.01::DOUBLE), (0.02), (0.05)) e(effect), (VALUES {rows}) t(alpha, power, z)
    """


@SET.add("power_pairs", _pairs_sql())
def power_pairs(spark, sf_dir):
    """Needed rows for three pairs of error and power."""
    parts = [
        S.power_by_group(arms(spark, sf_dir), "event_type", "high", [0.01, 0.02, 0.05], a, p).select(
            "event_type", F.lit(a).alias("alpha"), F.lit(p).alias("power"), "effect", "n_per_arm"
        )
        for a, p in PAIRS
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@SET.add(
    "sample_size_grid",
    """
    WITH g AS (SELECT event_type, AVG(CASE WHEN value > 90 THEN 1.0 ELSE 0.0 END) AS p, AVG(value) AS m,
                      STDDEV_SAMP(value) AS sd FROM events GROUP BY 1),
    e AS (SELECT * FROM (VALUES (0.05::DOUBLE), (0.1), (0.2)) v(effect)),
    n AS (
      SELECT event_type, effect, 'two_proportion' AS type,
             ceil(pow(1.959964 * sqrt(2 * (p + effect / 2) * (1 - p - effect / 2))
                      + 0.841621 * sqrt(p * (1 - p) + (p + effect) * (1 - p - effect)), 2) / pow(effect, 2)) AS n
      FROM g, e
      UNION ALL
      SELECT event_type, effect, 'continuous', ceil(2 * pow(1.959964 + 0.841621, 2) * sd * sd / pow(m * effect, 2)) FROM g, e)
    SELECT event_type, effect, type, CAST(n AS BIGINT) AS n_per_arm, CAST(2 * n AS BIGINT) AS total_n FROM n
    """,
)
def sample_size_grid(spark, sf_dir):
    groups = arms(spark, sf_dir).groupBy("event_type").agg(
        F.avg("high").alias("p1"), F.avg("value").alias("mean1"), F.stddev_samp("value").alias("sd")
    )
    grid = groups.withColumn("effect", F.explode(F.array(*[F.lit(e) for e in (0.05, 0.1, 0.2)])))
    grid = grid.withColumns({"p2": F.col("p1") + F.col("effect"), "mean2": F.col("mean1") * (1 + F.col("effect"))})
    both = S.sample_size(grid, "two_proportion").unionByName(S.sample_size(grid, "continuous"))
    return both.select("event_type", "effect", "type", "n_per_arm", "total_n")
