"""Key-figure queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketloom.operators import kpi as K
from marketloom.operators import market
from marketloom.operators import metrics as M
from marketloom.operators import stats as S
from marketloom.operators import text as X

from .base import BRAND_SALES_SQL, QuerySet, brand_sales, money, table
from .market import SET as MARKET
from .market import base_vs_latest, pipeline_distribution, signal_rollup
from .models import RESULTS_SQL, predictions
from .stats import BOUGHT, ab_sql, counted_ab_summary, counted_bootstrap_sql
from .text import documents

SET = QuerySet()

SHARES_SQL = f"""
SELECT brand_id, year, CAST(revenue AS DOUBLE) AS revenue,
       ROUND(100.0 * CAST(revenue AS DOUBLE) / CAST(SUM(revenue) OVER (PARTITION BY year) AS DOUBLE), 2) AS share_pct
FROM ({BRAND_SALES_SQL})
"""


def shares(spark, sf_dir):
    return market.share_of_period(brand_sales(spark, sf_dir), "year", "revenue").withColumn(
        "revenue", F.col("revenue").cast("double")
    )


def growth(spark, sf_dir):
    return market.growth(brand_sales(spark, sf_dir), ["brand_id"], "year", "revenue")


@SET.add(
    "kpi_leader",
    f"""
    SELECT year AS period, brand_id AS key, ROUND(revenue, 2) AS value, share_pct AS share FROM ({SHARES_SQL}) s
    WHERE year = (SELECT MAX(year) FROM ({SHARES_SQL})) ORDER BY s.revenue DESC, brand_id LIMIT 1
    """,
)
def kpi_leader(spark, sf_dir):
    top = K.leader(shares(spark, sf_dir), "year", "brand_id", "revenue", "share_pct")
    return top.withColumn("value", F.round("value", 2))


GROWTH_SQL = f"""
SELECT brand_id, year, ROUND(100.0 * ((v - before) / NULLIF(before, 0)), 1) AS yoy_growth_pct FROM (
  SELECT brand_id, year, CAST(revenue AS DOUBLE) AS v, LAG(CAST(revenue AS DOUBLE)) OVER (PARTITION BY brand_id ORDER BY year) AS before
  FROM ({BRAND_SALES_SQL})) WHERE before IS NOT NULL
"""


@SET.add("kpi_growth", f"SELECT * FROM ({GROWTH_SQL}) ORDER BY brand_id DESC, year DESC LIMIT 6")
def kpi_growth(spark, sf_dir):
    latest = K.latest_growth(growth(spark, sf_dir), ["brand_id", "year"], "yoy_growth_pct")
    return latest.select("brand_id", "year", "yoy_growth_pct")


def text_sql(kpi: str, key: str, value: str, source: str) -> str:
    return f"SELECT '{kpi}' AS kpi, {key} AS key, {value} AS value FROM ({source})"


LEADER_SQL = f"SELECT * FROM ({SHARES_SQL}) WHERE year = (SELECT MAX(year) FROM ({SHARES_SQL})) ORDER BY revenue DESC, brand_id LIMIT 1"
SIGNAL_SQL = """
SELECT cohort || ' ' || event_type AS k, n, ROUND(100.0 * s / n, 1) AS rate FROM (
  SELECT user_id % 10 AS cohort, event_type, COUNT(*) AS n, SUM(CASE WHEN value > 90 THEN 1 ELSE 0 END) AS s FROM events GROUP BY 1, 2)
ORDER BY n DESC, cohort, event_type LIMIT 1
"""
AB_FIGURES = (
    "n_control", "n_test", "conv_control_pct", "conv_test_pct", "lift_pct", "t_stat", "p_value", "ci_low_pct", "ci_high_pct",
    "needed_n", "is_simulated",
)


@SET.add(
    "kpi_table",
    " UNION ALL ".join(
        [
            text_sql("latest_year", "'year'", "CAST(year AS VARCHAR)", LEADER_SQL),
            text_sql("leader_revenue", "brand_id", "format('{:,.1f}', revenue)", LEADER_SQL),
            text_sql("leader_share_pct", "brand_id", "CAST(share_pct AS VARCHAR)", LEADER_SQL),
            text_sql(
                "growth_pct",
                "brand_id || ' ' || year",
                "CAST(yoy_growth_pct AS VARCHAR)",
                f"SELECT * FROM ({GROWTH_SQL}) ORDER BY brand_id DESC, year DESC LIMIT 6",
            ),
            text_sql(
                "revenue_since_1996",
                "'house ' || brand_id",
                "format('{:,.1f}', rev_1996) || ' -> ' || format('{:,.1f}', rev_latest)",
                f"SELECT * FROM ({MARKET.oracles['base_vs_latest']}) ORDER BY rev_latest DESC, brand_id LIMIT 4",
            ),
            text_sql(
                "ab_test",
                "f.name",
                "f.figure",
                "SELECT unnest([" + ", ".join(f"{{'name': '{c}', 'figure': CAST({c} AS VARCHAR)}}" for c in AB_FIGURES) + "]) AS f "
                f"FROM ({ab_sql(counted_bootstrap_sql(BOUGHT))})",
            ),
            text_sql("top_signal_reports", "k", "format('{:,}', n)", SIGNAL_SQL),
            text_sql("top_signal_serious_pct", "k", "CAST(rate AS VARCHAR)", SIGNAL_SQL),
            text_sql(
                "company_trials",
                "'BUILDING'",
                "CAST(n AS VARCHAR)",
                "SELECT COUNT(*) AS n FROM orders JOIN customer ON c_custkey = o_custkey WHERE c_mktsegment = 'BUILDING'",
            ),
            text_sql(
                "simulated_market_bn",
                "CAST(y AS VARCHAR)",
                "format('{:,.1f}', v)",
                "SELECT year(o_orderdate) AS y, ROUND(CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / 1e6, 2) AS v "
                "FROM orders GROUP BY 1 ORDER BY 1 DESC LIMIT 1",
            ),
            text_sql(
                "model_cv_auc",
                "model",
                "CAST(ROUND(AVG(auc), 3) AS VARCHAR)",
                f"SELECT * FROM ({RESULTS_SQL}) WHERE fold <> 'holdout'",
            )
            + " GROUP BY model",
            text_sql(
                "best_model",
                "model",
                "CAST(ROUND(cv, 3) AS VARCHAR)",
                f"SELECT model, AVG(auc) AS cv FROM ({RESULTS_SQL}) WHERE fold <> 'holdout' GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1",
            ),
            text_sql(
                "top_keyword",
                "w",
                "CAST(n AS VARCHAR)",
                "SELECT w, COUNT(*) AS n FROM (SELECT unnest(regexp_extract_all(lower(text), '[a-z][a-z-]{2,}')) AS w FROM documents) "
                "WHERE w NOT IN ('the', 'and', 'for', 'with') GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5",
            ),
            text_sql(
                "sample_size",
                "event_type",
                "CAST(CAST(ceil(pow(1.959964 * sqrt(2 * (p + 0.05) * (0.95 - p)) + 0.841621 * sqrt(p * (1 - p) + (p + 0.1) * (0.9 - p)), 2) "
                "/ pow(0.1, 2)) AS BIGINT) AS VARCHAR)",
                "SELECT event_type, AVG(CASE WHEN value > 90 THEN 1.0 ELSE 0.0 END) AS p FROM events GROUP BY 1",
            ),
        ]
    ),
)
def kpi_table(spark, sf_dir):
    """One table of key figures from ten result tables: all but the importances, whose fit has a query of its own."""
    yearly = table(spark, sf_dir, "orders").groupBy(F.year("o_orderdate").alias("year")).agg(
        F.round(F.sum(money("o_totalprice")).cast("double") / F.lit(1e6), 2).alias("market_usd_bn")
    )
    rates = table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("scenario")).agg(
        F.avg(F.when(F.col("value") > 90, 1.0).otherwise(0.0)).alias("p1")
    )
    results = {
        "brand_share": shares(spark, sf_dir).withColumnsRenamed({"brand_id": "brand_name", "revenue": "revenue_usd_m"}),
        "brand_growth": growth(spark, sf_dir).select(
            F.col("brand_id").alias("molecule"), F.col("brand_id").alias("brand_name"), "year", "yoy_growth_pct"
        ),
        "brand_base_vs_latest": base_vs_latest(spark, sf_dir).select(
            F.lit("house").alias("company"), F.col("brand_id").alias("brand_name"), "rev_1996", "rev_latest"
        ),
        "ab_summary": counted_ab_summary(spark, sf_dir),
        "safety_signals": signal_rollup(spark, sf_dir),
        "trial_pipeline": pipeline_distribution(spark, sf_dir),
        "simulated_market": yearly,
        "model_summary": M.model_summary(M.model_table(predictions(spark, sf_dir)), by="cv"),
        "sample_sizes": S.sample_size(rates.withColumn("p2", F.col("p1") + F.lit(0.1)), "two_proportion"),
        "keywords": X.top_keywords(documents(spark, sf_dir), "text", "lang", stopwords=("the", "and", "for", "with")),
    }
    return K.kpi_table(results, company="BUILDING")
