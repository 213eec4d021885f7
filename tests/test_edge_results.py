"""Results at the edges: missing order values, infinite scores, small samples, other test levels."""

import math

import pytest
from pyspark.sql import functions as F

from marketloom.functions.probability import student_t_two_sided
from marketloom.operators import metrics, reshape, stats, warehouse


def test_first_row_of_a_key_without_order_values(spark):
    df = spark.createDataFrame([("a", None, "x"), ("b", 2, "y"), ("b", None, "z")], "k string, o int, v string")
    assert sorted(tuple(r) for r in warehouse.keep_first(df, ["k"], ["o"]).collect()) == [("a", None, "x"), ("b", 2, "y")]


def test_rows_needed_fall_with_alpha_and_rise_with_power(spark):
    row = spark.range(1).select(
        *[stats.needed_per_arm(F.lit(0.05), F.lit(0.02), a, p).alias(f"n{i}") for i, (a, p) in enumerate([(0.01, 0.8), (0.05, 0.8), (0.1, 0.8), (0.05, 0.9), (0.05, 0.95)])]
    ).first()
    assert row.n0 > row.n1 > row.n2 and row.n1 < row.n3 < row.n4
    assert row.n1 == 1741


def test_auc_with_infinite_and_missing_scores(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(-inf, 0), (0.2, 0), (0.6, 1), (inf, 1), (None, 1), (nan, 0)]
    df = spark.createDataFrame(rows, "score double, label int")
    got = metrics.auc(df, "score", "label", cut=0.5).first()
    assert (got.n_pos, got.n_neg, got.auc, got.accuracy) == (2, 2, 1.0, 1.0)
    assert tuple(metrics.accuracy_at(df, "score", "label").first()) == (4, 1.0)


def test_interval_of_three_rows_an_arm(spark):
    df = spark.createDataFrame([(i, i % 2, float(i)) for i in range(6)], "id int, arm int, value double")
    got = stats.bootstrap_ci(df, "arm", "value", ["id"]).first()
    assert None not in tuple(got) and got.ci_low <= 1.0 <= got.ci_high


def test_pivot_finds_its_series(spark):
    df = spark.createDataFrame([(1, "a", 2.0), (1, "b", 3.0)], "x int, s string, y double")
    assert reshape.pivot_wide(df, "x", "s", "y").columns == ["x", "a", "b"]
    with pytest.raises(ValueError, match="b"):
        reshape.pivot_wide(df, "x", "s", "y", ["a"])


def test_t_tail_is_one_method_for_all_sizes(spark):
    rows = [(1.0, 1.0), (2.0, 2.0), (8.0, 1e13), (5.5, 2e6), (0.0, 3.0), (float("inf"), 4.0), (1e200, 1.0)]
    df = spark.createDataFrame(rows, "t double, df double")
    p = [r[0] for r in df.select(student_t_two_sided(F.col("t"), F.col("df"))).collect()]
    normal = math.erfc(5.5 / math.sqrt(2))
    second_order = normal * (1 + (5.5**4 + 5.5**2) / (4 * 2e6))
    want = [0.5, 1 - 2 / math.sqrt(6), math.erfc(8 / math.sqrt(2)), second_order, 1.0, 0.0, 0.0]
    assert p == pytest.approx(want, rel=1e-5)
    assert p[:3] == pytest.approx(want[:3], rel=1e-9)


def test_close_settings_are_not_rounded_into_a_tie(spark):
    df = spark.range(40001).select(
        F.lit("m").alias("model"), F.lit("1").alias("fold"), F.col("id").cast("double").alias("score"), (F.col("id") == 20001).cast("int").alias("label")
    )
    assert metrics.model_table(df).first().auc == 0.5
    assert metrics.model_table(df, digits=None).first().auc == pytest.approx(20001 / 40000)
