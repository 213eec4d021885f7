"""Key figures as one long table (kpi, key, value)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.functions.columns import thousands


def leader(df: DataFrame, period: str, key: str, value: str, share: str) -> DataFrame:
    """The largest row of the latest period: one row (period, key, value, share).

    One pass: the best row is the maximum by (period, value), then by first key.
    """
    found = F.struct(*[F.col(c).alias(n) for c, n in ((period, "period"), (key, "key"), (value, "value"), (share, "share"))])
    top = df.groupBy(key).agg(F.max_by(found, F.struct(period, value)).alias("r"))
    rank = F.struct(-F.col("r.period"), -F.col("r.value"), F.col("r.key"))
    return top.agg(F.min_by("r", rank).alias("r")).select("r.*").filter(F.col("period").isNotNull())


def latest_growth(df: DataFrame, order: Sequence[str], growth: str, n: int = 6) -> DataFrame:
    """The last ``n`` rows by ``order`` that have a growth figure."""
    known = df.filter(F.col(growth).isNotNull())
    return known.orderBy(*[F.desc(c) for c in order]).limit(n)


def _line(df: DataFrame, kpi: str, key, value) -> DataFrame:
    return df.select(F.lit(kpi).alias("kpi"), key.cast("string").alias("key"), value.cast("string").alias("value"))


def kpi_table(results: Mapping[str, DataFrame], company: str = "Eli Lilly") -> DataFrame:
    """Key figures out of the result tables that are present.

    Known results: ``brand_share``, ``brand_growth``, ``brand_base_vs_latest``,
    ``safety_signals``, ``trial_pipeline``, ``simulated_market``, ``ab_summary``,
    ``model_summary``, ``importances``, ``sample_sizes`` and ``keywords``. All
    parts are small aggregates; they are computed when the table is.
    """
    parts: list[DataFrame] = []
    if "brand_share" in results:
        top = leader(results["brand_share"], "year", "brand_name", "revenue_usd_m", "share_pct")
        parts.append(_line(top, "latest_year", F.lit("year"), F.col("period")))
        parts.append(_line(top, "leader_revenue", F.col("key"), thousands(F.col("value"))))
        parts.append(_line(top, "leader_share_pct", F.col("key"), F.col("share")))
    if "brand_growth" in results:
        rows = latest_growth(results["brand_growth"], ["molecule", "year", "brand_name"], "yoy_growth_pct")
        parts.append(_line(rows, "growth_pct", F.concat_ws(" ", "brand_name", "year"), F.col("yoy_growth_pct")))
    if "brand_base_vs_latest" in results:
        df = results["brand_base_vs_latest"]
        base = next(c for c in df.columns if c.startswith("rev_") and c != "rev_latest")
        rows = df.orderBy(F.desc("rev_latest"), "brand_name").limit(4)
        change = F.concat_ws(" -> ", thousands(F.col(base)), thousands(F.col("rev_latest")))
        parts.append(_line(rows, f"revenue_since_{base[4:]}", F.concat_ws(" ", "company", "brand_name"), change))
    if "safety_signals" in results:
        df = results["safety_signals"]
        keys = [c for c in df.columns if c not in ("total_reports", "serious_reports", "serious_rate_pct")]
        top = df.orderBy(F.desc("total_reports"), *keys).limit(1)
        parts.append(_line(top, "top_signal_reports", F.concat_ws(" ", *keys), thousands(F.col("total_reports"), 0)))
        parts.append(_line(top, "top_signal_serious_pct", F.concat_ws(" ", *keys), F.col("serious_rate_pct")))
    if "trial_pipeline" in results:
        own = results["trial_pipeline"].filter(F.col("company") == company)
        total = own.agg(F.coalesce(F.sum("trial_count"), F.lit(0)).alias("n"))
        parts.append(_line(total, "company_trials", F.lit(company), F.col("n")))
    if "simulated_market" in results:
        df = results["simulated_market"]
        last = df.agg(F.max_by("market_usd_bn", "year").alias("v"), F.max("year").alias("year")).filter("year IS NOT NULL")
        parts.append(_line(last, "simulated_market_bn", F.col("year"), thousands(F.col("v"))))
        if "penetration_pct" in df.columns:
            share = df.agg(F.max_by("penetration_pct", "year").alias("v"), F.max("year").alias("year"))
            parts.append(_line(share, "simulated_penetration_pct", F.col("year"), F.col("v")))
    if "ab_summary" in results:
        df = results["ab_summary"]
        figures = F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("string").alias("figure")) for c in df.columns])
        parts.append(_line(df.select(F.explode(figures).alias("f")), "ab_test", F.col("f.name"), F.col("f.figure")))
    if "model_summary" in results:
        df = results["model_summary"]
        parts.append(_line(df, "model_cv_auc", F.col("model"), F.round("cv_auc", 3)))
        parts.append(_line(df.filter("best"), "best_model", F.col("model"), F.round("cv_auc", 3)))
    if "importances" in results:
        top = results["importances"].orderBy(F.abs("value").desc(), "model", "feature").limit(3)
        parts.append(_line(top, "top_feature", F.concat_ws("|", "model", "feature"), F.round("value", 2)))
    if "sample_sizes" in results:
        parts.append(_line(results["sample_sizes"], "sample_size", F.col("scenario"), F.col("n_per_arm")))
    if "keywords" in results:
        words = results["keywords"].filter(F.col("scope") == "ALL").orderBy(F.desc("count"), "keyword").limit(5)
        parts.append(_line(words, "top_keyword", F.col("keyword"), F.col("count")))
    if not parts:
        raise ValueError("no known result table was given")
    table = parts[0]
    for part in parts[1:]:
        table = table.unionByName(part)
    return table
