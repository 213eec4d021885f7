"""The whole run: ingest, star schema, analyses, results."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom import schemas
from marketloom.functions import vocabulary as V
from marketloom.operators import forecast, kpi, metrics, models, stats
from marketloom.operators.cluster import kmeans_segments
from marketloom.operators.features import trial_feature_names, trial_features, with_label
from marketloom.operators.reshape import segment_profile
from marketloom.operators.split import stratified_holdout
from marketloom.operators.text import top_keywords
from marketloom.operators.warehouse import build_star, real_only, refresh
from marketloom.plans.catalogue import run_all, stored_results
from marketloom.sources.delimited import POSITION, read_csv, scan_csv, write_result
from marketloom.sources.landed import ingest_events, ingest_trials


@dataclass(frozen=True)
class Inputs:
    """Paths of the raw inputs; the last two tables are optional."""

    sales: str
    market: str
    trial_pages: str
    trial_sample: str
    event_pages: str
    event_sample: str
    people: str | None = None
    campaign: str | None = None


# The two design scenarios of the report.
SCENARIOS = (("response 55% vs 45%", "two_proportion", 0.45, 0.55), ("change 1.1 vs 0.6, sd 1", "continuous", 0.6, 1.1))


def sample_sizes(spark: SparkSession) -> DataFrame:
    rows = spark.createDataFrame(list(SCENARIOS), "scenario string, kind string, a double, b double")
    rates = rows.filter("kind = 'two_proportion'").select("scenario", F.col("a").alias("p1"), F.col("b").alias("p2"))
    means = rows.filter("kind = 'continuous'").select(
        "scenario", F.col("a").alias("mean1"), F.col("b").alias("mean2"), F.lit(1.0).alias("sd")
    )
    kept = ["scenario", "type", "n_per_arm", "total_n"]
    return (
        stats.sample_size(rates, "two_proportion").select(*kept).union(stats.sample_size(means, "continuous").select(*kept))
    )


def run(
    spark: SparkSession,
    inputs: Inputs,
    out_dir: str,
    grids=models.GRIDS,
    segments: int = V.SEGMENTS,
    horizon_start: int | None = None,
) -> dict[str, DataFrame]:
    """Run every stage, write tables and results below ``out_dir``, return the results.

    Steps without enough data (models below 30 trials) or without their input
    are left out. If the trial sample is used, its malformed rows are written
    to ``quarantine``. Runs jobs.
    """
    trials = ingest_trials(spark, inputs.trial_pages, inputs.trial_sample)
    taken = trials.select("_source").first()
    if taken is None or taken[0] == "fallback":
        write_result(read_csv(spark, inputs.trial_sample, schemas.FACT_TRIALS)[1], f"{out_dir}/quarantine/trials")
    sources = {
        "sales": scan_csv(spark, inputs.sales, schemas.RAW_SALES, position=POSITION),
        "market": scan_csv(spark, inputs.market, schemas.RAW_MARKET, position=POSITION),
        "trials": trials,
        "events": ingest_events(spark, inputs.event_pages, inputs.event_sample),
    }
    star = refresh(build_star(sources), f"{out_dir}/warehouse")
    status = run_all(spark, star, f"{out_dir}/query_results")
    results = stored_results(spark, star, f"{out_dir}/query_results", status)
    results["status"] = status
    results["keywords"] = top_keywords(star["fact_trials"], "indication", "molecule")
    results["sample_sizes"] = sample_sizes(spark)
    series = real_only(star["fact_brand_sales"]).groupBy("brand_id", "year").agg(F.sum("revenue_usd_m").alias("revenue_usd_m"))
    results["forecast"] = forecast.forecast_table(series, ["brand_id"], "year", "revenue_usd_m", start=horizon_start)

    # The models split the same rows by the same hash, so the hold-out stays unseen here too.
    split = stratified_holdout(with_label(star["fact_trials"]), "nct_id", "label")
    featured = trial_features(star["fact_trials"], fit_on=split.filter("is_train"))
    fitted = models.run_models(featured, "nct_id", trial_feature_names(), grids=grids)
    if fitted:
        results["model_results"], results["importances"] = fitted
        results["model_summary"] = metrics.model_summary(results["model_results"], by="holdout")
    if inputs.people:
        people = spark.read.parquet(inputs.people)
        results["segments"] = kmeans_segments(people, list(V.SEGMENT_FEATURES), segments)
        results["segment_profile"] = segment_profile(results["segments"], "segment", list(V.SEGMENT_FEATURES))
    if inputs.campaign:
        campaign = spark.read.parquet(inputs.campaign)
        results["ab_summary"] = stats.ab_summary(campaign, "arm", "converted", provenance=1)
    # The brief shows the penetration next to the market's size.
    brief = dict(results)
    if "simulated_market" in brief:
        penetration = sources["market"].select("year", "penetration_pct")
        brief["simulated_market"] = brief["simulated_market"].join(penetration, "year")
    results["kpi"] = kpi.kpi_table(brief)
    for name in ("keywords", "sample_sizes", "forecast", "model_results", "importances", "segments", "segment_profile", "ab_summary", "kpi"):
        if name in results:
            write_result(results[name], f"{out_dir}/{name}")
    return results
