"""The named analysis queries over the star schema, and their runner."""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.functions import vocabulary as V
from marketloom.operators import market
from marketloom.operators.warehouse import real_only
from marketloom.sources.delimited import scan_csv, write_result

Tables = Mapping[str, DataFrame]
CatalogueQuery = Callable[[Tables], DataFrame]


def _sales_with_brand(t: Tables) -> DataFrame:
    brands = t["dim_brand"].drop("is_simulated")
    return real_only(t["fact_brand_sales"]).join(brands, "brand_id")


def brand_share(t: Tables) -> DataFrame:
    shares = market.share_of_period(_sales_with_brand(t), "year", "revenue_usd_m")
    return shares.select("company", "brand_name", "year", "revenue_usd_m", "share_pct").orderBy(
        "year", F.desc("revenue_usd_m"), "brand_name"
    )


def brand_growth(t: Tables) -> DataFrame:
    grown = market.growth(_sales_with_brand(t), ["brand_id", "region_id"], "year", "revenue_usd_m")
    return grown.select("molecule", "brand_name", "year", "revenue_usd_m", "yoy_growth_pct").orderBy(
        "molecule", "year", "brand_name"
    )


def brand_launches(t: Tables, company: str = "Eli Lilly") -> DataFrame:
    curve = market.launch_curve(_sales_with_brand(t).filter(F.col("company") == company), ["brand_id"], "year")
    return curve.select("brand_name", "years_since_launch", "revenue_usd_m").orderBy("brand_name", "years_since_launch")


def brand_base_vs_latest(t: Tables, base: int = 2022) -> DataFrame:
    compared = market.base_vs_latest(
        t["fact_brand_sales"], ["brand_id"], "year", "revenue_usd_m", base,
        real=F.col("is_simulated") == 0, base_as=f"rev_{base}", latest_as="rev_latest",
    )
    named = compared.join(t["dim_brand"].select("brand_id", "company", "brand_name"), "brand_id")
    return named.select("company", "brand_name", f"rev_{base}", "rev_latest").orderBy(F.desc("rev_latest"), "brand_name")


def safety_signals(t: Tables) -> DataFrame:
    return market.signal_rollup(real_only(t["fact_events"]), ["molecule", "event_type"], "report_count", "serious_count")


def trial_pipeline(t: Tables) -> DataFrame:
    spread = market.distribution(real_only(t["fact_trials"]), ["company", "phase"], "enrollment", "trial_count", "total_enrollment")
    return spread.orderBy("company", "phase")


def simulated_market(t: Tables, region: str = V.MARKET_REGION) -> DataFrame:
    where = (F.col("region_id") == region) & (F.col("is_simulated") == 1)
    return market.market_size(t["fact_brand_sales"], "year", "revenue_usd_m", where).orderBy("year")


CATALOGUE: dict[str, CatalogueQuery] = {
    "brand_share": brand_share,
    "brand_growth": brand_growth,
    "brand_launches": brand_launches,
    "brand_base_vs_latest": brand_base_vs_latest,
    "safety_signals": safety_signals,
    "trial_pipeline": trial_pipeline,
    "simulated_market": simulated_market,
}


def run_all(
    spark: SparkSession,
    tables: Tables,
    out_dir: str,
    catalogue: Mapping[str, CatalogueQuery] = CATALOGUE,
    on_error: str = "skip",
    format: str = "csv",
) -> DataFrame:
    """Run the queries in order and write each result below ``out_dir``.

    A failing query is recorded and the others go on (``on_error="raise"``
    stops instead). Returns one status row per query, with
    the number of rows written. Runs jobs.
    """
    status = []
    for position, (name, query) in enumerate(catalogue.items(), start=1):
        start = time.monotonic()
        try:
            rows = write_result(query(tables), f"{out_dir}/{name}", format)
            state, message = "written" if rows else "empty", ""
        except (PySparkException, Py4JJavaError, KeyError) as exc:
            if on_error == "raise":
                raise
            rows, state, message = None, "failed", f"{type(exc).__name__}: {str(exc).splitlines()[0]}"
        status.append((position, name, state, rows, message, round(time.monotonic() - start, 3)))
    return spark.createDataFrame(status, "position int, query string, state string, rows long, message string, seconds double")


def stored_results(
    spark: SparkSession, tables: Tables, out_dir: str, status: DataFrame, catalogue: Mapping[str, CatalogueQuery] = CATALOGUE
) -> dict[str, DataFrame]:
    """The CSV results ``run_all`` has written, with the queries' own types.

    Later steps read these small tables instead of running the queries again.
    """
    written = [r["query"] for r in status.filter("state = 'written'").select("query").collect()]
    return {name: scan_csv(spark, f"{out_dir}/{name}", catalogue[name](tables).schema) for name in written}
