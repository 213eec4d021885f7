"""Forecast queries over all years of the sales."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketloom.operators import forecast as FC
from marketloom.operators import market

from .base import BRAND_SALES_SQL, QuerySet, brand_sales, money, table

SET = QuerySet()
ARGS = (["brand_id"], "year", "revenue")


def per_customer(spark, sf_dir):
    """Ragged series: many customers have orders in a few years only."""
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("custkey"), F.year("o_orderdate").alias("year"), money("o_totalprice").alias("price")
    )
    return market.period_totals(orders, ["custkey", "year"], {"revenue": F.col("price")})


SERIES_SQL = f"""
SELECT brand_id, year, CAST(revenue AS DOUBLE) AS v, row_number() OVER (PARTITION BY brand_id ORDER BY year) - 1 AS i,
       COUNT(*) OVER (PARTITION BY brand_id) AS n FROM ({BRAND_SALES_SQL})
"""
CUSTOMER_SERIES_SQL = """
SELECT custkey, year, v, row_number() OVER (PARTITION BY custkey ORDER BY year) - 1 AS i,
       COUNT(*) OVER (PARTITION BY custkey) AS n FROM (
  SELECT o_custkey AS custkey, CAST(year(o_orderdate) AS INTEGER) AS year,
         CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS v FROM orders GROUP BY 1, 2)
"""


@SET.add(
    "ols_trend",
    f"""
    SELECT custkey, CAST(COUNT(*) AS BIGINT) AS n,
           ROUND(CASE WHEN COUNT(*) > 1 THEN regr_slope(v, i) ELSE 0 END, 4) AS slope,
           ROUND(CASE WHEN COUNT(*) > 1 THEN regr_intercept(v, i) ELSE AVG(v) END, 4) AS intercept
    FROM ({CUSTOMER_SERIES_SQL}) GROUP BY 1
    """,
)
def ols_trend(spark, sf_dir):
    trend = FC.ols_trend(per_customer(spark, sf_dir), ["custkey"], "year", "revenue")
    return trend.select("custkey", "n", F.round("slope", 4).alias("slope"), F.round("intercept", 4).alias("intercept"))


@SET.add(
    "cagr",
    f"""
    SELECT custkey, ROUND(arg_min(v, year), 2) AS first_value, ROUND(arg_max(v, year), 2) AS last_value,
           CAST(COUNT(*) AS BIGINT) AS n,
           ROUND(pow(arg_max(v, year) / greatest(arg_min(v, year), 1e-9), 1.0 / greatest(COUNT(*) - 1, 1)) - 1, 6) AS cagr
    FROM ({CUSTOMER_SERIES_SQL}) GROUP BY 1
    """,
)
def cagr(spark, sf_dir):
    rates = FC.cagr(per_customer(spark, sf_dir), ["custkey"], "year", "revenue")
    digits = {"first_value": 2, "last_value": 2, "cagr": 6}
    return rates.select("custkey", "n", *[F.round(c, d).alias(c) for c, d in digits.items()])


def backtest_sql(series: str, key: str) -> str:
    """Two held-out periods at most, so the compounding is written out."""
    return f"""
    WITH s AS (SELECT *, least(2, greatest(n - 2, 0)) AS hold FROM ({series})),
    f AS (SELECT {key}, any_value(n) AS n, any_value(hold) AS hold, any_value(n - hold) AS m,
                 CASE WHEN any_value(n - hold) > 1 THEN regr_slope(v, i) FILTER (WHERE i < n - hold) ELSE 0 END AS slope,
                 CASE WHEN any_value(n - hold) > 1 THEN regr_intercept(v, i) FILTER (WHERE i < n - hold)
                      ELSE AVG(v) FILTER (WHERE i < n - hold) END AS intercept,
                 MAX(v) FILTER (WHERE i = 0) AS first, MAX(v) FILTER (WHERE i = n - hold - 1) AS last FROM s GROUP BY 1),
    g AS (SELECT *, pow(last / greatest(first, 1e-9), 1.0 / greatest(m - 1, 1)) - 1 AS rate FROM f),
    p AS (SELECT s.{key}, s.v, g.slope * s.i + g.intercept AS line,
                 CASE WHEN s.i = g.m THEN last * (1 + rate) ELSE last * (1 + rate) * (1 + rate * 0.8) END AS path
          FROM s JOIN g ON g.{key} = s.{key} WHERE s.i >= g.m)
    SELECT g.{key} AS {key}, CAST(any_value(g.n) AS BIGINT) AS n, CAST(any_value(g.hold) AS BIGINT) AS hold,
           100 * AVG(CASE WHEN v <> 0 THEN abs(v - line) / abs(v) END) AS mape_ols,
           100 * AVG(CASE WHEN v <> 0 THEN abs(v - (line + path) / 2) / abs(v) END) AS mape_ensemble
    FROM g LEFT JOIN p ON p.{key} = g.{key} GROUP BY 1
    """


@SET.add(
    "backtest_mape",
    f"""
    SELECT custkey, n, hold, ROUND(mape_ols, 4) AS mape_ols, ROUND(mape_ensemble, 4) AS mape_ensemble
    FROM ({backtest_sql(CUSTOMER_SERIES_SQL, 'custkey')})
    """,
)
def backtest_mape(spark, sf_dir):
    tested = FC.backtest(per_customer(spark, sf_dir), ["custkey"], "year", "revenue")
    return tested.select(
        "custkey", "n", F.col("hold").cast("bigint").alias("hold"), *[F.round(c, 4).alias(c) for c in ("mape_ols", "mape_ensemble")]
    )


FORECAST_SQL = f"""
SELECT f.brand_id AS brand_id, CAST(last_year + h AS INTEGER) AS year,
       greatest(0.0, (slope * (n + h - 1) + intercept
                      + last * (1 + (pow(last / greatest(first, 1e-9), 1.0 / greatest(n - 1, 1)) - 1) * pow(0.8, h))) / 2) AS revenue
FROM (SELECT brand_id, any_value(n) AS n, regr_slope(v, i) AS slope, regr_intercept(v, i) AS intercept,
             arg_min(v, i) AS first, arg_max(v, i) AS last, MAX(year) AS last_year FROM ({SERIES_SQL}) GROUP BY 1) f,
     range(1, 7) r(h)
"""


@SET.add("forecast", f"SELECT brand_id, year, ROUND(revenue, 2) AS revenue FROM ({FORECAST_SQL})")
def forecast(spark, sf_dir):
    return FC.forecast(brand_sales(spark, sf_dir), *ARGS).withColumn("revenue", F.round("revenue", 2))


@SET.add(
    "forecast_table",
    f"""
    SELECT brand_id, year, ROUND(v, 1) AS revenue, 'actual' AS type, CAST(NULL AS DOUBLE) AS mape_backtest_pct FROM ({SERIES_SQL})
    UNION ALL
    SELECT f.brand_id, f.year, ROUND(f.revenue, 1), 'forecast', ROUND(b.mape_ensemble, 2)
    FROM ({FORECAST_SQL}) f JOIN ({backtest_sql(SERIES_SQL, 'brand_id')}) b ON b.brand_id = f.brand_id
    """,
)
def forecast_table(spark, sf_dir):
    return FC.forecast_table(brand_sales(spark, sf_dir), *ARGS)
