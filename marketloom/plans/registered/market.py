"""Market queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketloom.operators import market, reshape

from .base import (
    BRAND_SALES_FLAGGED_SQL,
    BRAND_SALES_SQL,
    QuerySet,
    as_money,
    brand_sales,
    money,
    table,
)

SET = QuerySet()


@SET.add(
    "share_of_period",
    f"""
    WITH s AS ({BRAND_SALES_SQL}), t AS (SELECT year, SUM(revenue) AS total FROM s GROUP BY year)
    SELECT brand_id, s.year AS year, ROUND(CAST(revenue AS DOUBLE), 2) AS revenue,
           ROUND(100.0 * CAST(revenue AS DOUBLE) / NULLIF(CAST(total AS DOUBLE), 0), 2) AS share_pct
    FROM s JOIN t ON s.year = t.year ORDER BY year, revenue DESC, brand_id
    """,
)
def share_of_period(spark, sf_dir):
    shares = market.share_of_period(brand_sales(spark, sf_dir), "year", "revenue")
    return shares.select("brand_id", "year", as_money("revenue"), "share_pct").orderBy(
        "year", F.desc("revenue"), "brand_id"
    )


@SET.add(
    "yoy_growth",
    f"""
    WITH s AS ({BRAND_SALES_FLAGGED_SQL}), r AS (
      SELECT brand_id, year, CAST(revenue AS DOUBLE) AS revenue,
             LAG(CAST(revenue AS DOUBLE)) OVER (PARTITION BY brand_id ORDER BY year) AS before
      FROM s WHERE is_simulated = 0)
    SELECT brand_id, year, ROUND(revenue, 2) AS revenue,
           ROUND(100.0 * ((revenue - before) / NULLIF(before, 0)), 1) AS yoy_growth_pct
    FROM r ORDER BY brand_id, year
    """,
)
def yoy_growth(spark, sf_dir):
    sales = brand_sales(spark, sf_dir, flagged=True).filter("is_simulated = 0")
    grown = market.growth(sales, ["brand_id"], "year", "revenue")
    return grown.select("brand_id", "year", as_money("revenue"), "yoy_growth_pct").orderBy("brand_id", "year")


@SET.add(
    "launch_curve",
    """
    WITH s AS (
      SELECT o_custkey AS custkey, CAST(year(o_orderdate) AS INTEGER) AS year,
             SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS revenue
      FROM orders GROUP BY 1, 2),
    f AS (SELECT custkey, MIN(year) AS launch_year FROM s GROUP BY 1)
    SELECT s.custkey AS custkey, CAST(s.year - f.launch_year + 1 AS INTEGER) AS years_since_launch,
           ROUND(CAST(revenue AS DOUBLE), 2) AS revenue
    FROM s JOIN f ON f.custkey = s.custkey JOIN customer ON c_custkey = s.custkey
    WHERE c_mktsegment = 'BUILDING'
    """,
)
def launch_curve(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("custkey"), F.year("o_orderdate").alias("year"), money("o_totalprice").alias("price")
    )
    segment = (
        table(spark, sf_dir, "customer").filter("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("custkey"))
    )
    totals = market.period_totals(orders, ["custkey", "year"], {"revenue": F.col("price")})
    curve = market.launch_curve(totals.join(segment, "custkey"), ["custkey"], "year")
    return curve.select("custkey", "years_since_launch", as_money("revenue"))


@SET.add(
    "base_vs_latest",
    f"""
    WITH s AS ({BRAND_SALES_FLAGGED_SQL}), latest AS (SELECT MAX(year) AS y FROM s WHERE is_simulated = 0),
    b AS (SELECT brand_id, SUM(revenue) AS revenue FROM s WHERE year = 1996 AND is_simulated = 0 GROUP BY 1),
    l AS (SELECT brand_id, SUM(revenue) AS revenue FROM s WHERE year = (SELECT y FROM latest) GROUP BY 1)
    SELECT b.brand_id AS brand_id, ROUND(CAST(b.revenue AS DOUBLE), 2) AS rev_1996,
           ROUND(CAST(l.revenue AS DOUBLE), 2) AS rev_latest
    FROM b JOIN l ON l.brand_id = b.brand_id
    """,
)
def base_vs_latest(spark, sf_dir):
    sales = brand_sales(spark, sf_dir, flagged=True)
    compared = market.base_vs_latest(
        sales,
        ["brand_id"],
        "year",
        "revenue",
        base=1996,
        real=F.col("is_simulated") == 0,
        base_as="rev_1996",
        latest_as="rev_latest",
    )
    return compared.select("brand_id", as_money("rev_1996"), as_money("rev_latest")).orderBy(
        F.desc("rev_latest"), "brand_id"
    )


@SET.add(
    "signal_rollup",
    """
    SELECT cohort, event_type, total_reports, serious_reports,
           ROUND(100.0 * serious_reports / NULLIF(total_reports, 0), 1) AS serious_rate_pct
    FROM (SELECT CAST(user_id % 10 AS BIGINT) AS cohort, event_type, CAST(COUNT(*) AS BIGINT) AS total_reports,
                 CAST(SUM(CASE WHEN value > 90 THEN 1 ELSE 0 END) AS BIGINT) AS serious_reports
          FROM events GROUP BY 1, 2)
    WHERE total_reports > 0
    ORDER BY total_reports DESC, cohort, event_type LIMIT 20
    """,
)
def signal_rollup(spark, sf_dir):
    reports = table(spark, sf_dir, "events").select(
        (F.col("user_id") % 10).alias("cohort"),
        "event_type",
        F.lit(1).alias("reports"),
        F.when(F.col("value") > 90, 1).otherwise(0).alias("serious"),
    )
    return market.signal_rollup(reports, ["cohort", "event_type"], "reports", "serious", limit=20)


@SET.add(
    "pipeline_distribution",
    """
    SELECT c_mktsegment AS company, o_orderstatus AS phase, CAST(COUNT(*) AS BIGINT) AS trial_count,
           ROUND(CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE), 2) AS total_enrollment
    FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1, 2
    """,
)
def pipeline_distribution(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("custkey"), F.col("o_orderstatus").alias("phase"), money("o_totalprice").alias("price")
    )
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("custkey"), F.col("c_mktsegment").alias("company")
    )
    spread = market.count_totals(
        orders,
        ["company", "phase"],
        {"total_enrollment": F.col("price")},
        customers,
        on="custkey",
        fact_cols=["phase"],
        count_as="trial_count",
    )
    return spread.select("company", "phase", "trial_count", as_money("total_enrollment")).orderBy("company", "phase")


@SET.add(
    "latest_topn",
    f"""
    WITH s AS ({BRAND_SALES_SQL})
    SELECT brand_id, year, ROUND(CAST(revenue AS DOUBLE), 2) AS revenue FROM s
    WHERE year = (SELECT MAX(year) FROM s) ORDER BY s.revenue DESC, brand_id LIMIT 3
    """,
)
def latest_topn(spark, sf_dir):
    top = reshape.latest_top(brand_sales(spark, sf_dir), "year", "revenue", 3, ["brand_id"])
    return top.select("brand_id", "year", as_money("revenue"))


@SET.add(
    "pivot_wide",
    """
    SELECT o_orderpriority, arg_max(o_totalprice, o_orderkey) FILTER (WHERE o_orderstatus = 'O') AS O,
           arg_max(o_totalprice, o_orderkey) FILTER (WHERE o_orderstatus = 'P') AS P,
           arg_max(o_totalprice, o_orderkey) FILTER (WHERE o_orderstatus = 'F') AS F
    FROM orders GROUP BY 1
    """,
)
def pivot_wide(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return reshape.pivot_wide(orders, "o_orderpriority", "o_orderstatus", "o_totalprice", ["O", "P", "F"], "o_orderkey")


@SET.add(
    "pivot_single",
    f"""
    SELECT year, ROUND(CAST(MAX(revenue) AS DOUBLE), 2) AS revenue
    FROM (SELECT year, arg_max(revenue, brand_id) AS revenue FROM ({BRAND_SALES_SQL}) GROUP BY year) GROUP BY year
    """,
)
def pivot_single(spark, sf_dir):
    sales = brand_sales(spark, sf_dir).withColumn("revenue", F.round(F.col("revenue").cast("double"), 2))
    return reshape.pivot_wide(sales, "year", None, "revenue", order="brand_id")
