"""Star-schema construction."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom import schemas
from marketloom.functions import vocabulary as V
from marketloom.functions.columns import text_or_empty
from marketloom.sources.delimited import POSITION


def time_dimension(sources: Sequence[DataFrame], period: str = "year") -> DataFrame:
    """Distinct periods of all sources, with their decade.

    Each source is reduced to its own distinct periods before the union.
    """
    periods = None
    for source in sources:
        own = source.select(F.col(period).cast("int").alias("year")).distinct()
        periods = own if periods is None else periods.union(own)
    decade = (F.floor(F.col("year") / 10) * 10).cast("int").cast("string")
    return periods.distinct().select("year", decade.alias("decade")).orderBy("year")


def region_dimension(spark: SparkSession, rows: Sequence[tuple[str, str, str]] = V.REGIONS) -> DataFrame:
    """A constant dimension; its size is that of the literal."""
    return spark.createDataFrame(list(rows), schemas.DIM_REGION)


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of each key by ``order``; NULL order values come last.

    ``min_by`` keeps one candidate row per key and task, so a hot key costs no
    more than a cold one; ``order`` must be unique within a key for the result
    to be repeatable.
    """
    others = [c for c in df.columns if c not in keys]
    rank = F.struct(*[part for i, c in enumerate(order) for part in (F.isnull(c).alias(f"_null{i}"), F.col(c).alias(f"_order{i}"))])
    first = df.groupBy(*keys).agg(F.min_by(F.struct(*others), rank).alias("_first"))
    return first.select(*[F.col(c) if c in keys else F.col(f"_first.{c}").alias(c) for c in df.columns])


def insert_or_ignore(target: DataFrame, new: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``target`` plus the new keys of ``new``; rows already there stay as they are.

    ``new`` is first reduced to one row per key, which also takes the skew out
    of the anti join.
    """
    fresh = keep_first(new, keys, order).join(target.select(*keys), list(keys), "left_anti")
    return target.unionByName(fresh.select(*target.columns))


def conform(df: DataFrame, constants: Mapping[str, object], scaled: Mapping[str, tuple[str, float]], columns: Sequence[str]) -> DataFrame:
    """Bring a source to the fact's columns: constants, unit conversions, order."""
    for name, value in constants.items():
        df = df.withColumn(name, F.lit(value))
    for name, (source, factor) in scaled.items():
        df = df.withColumn(name, F.col(source).cast("double") * F.lit(factor))
    return df.select(*columns)


def real_only(df: DataFrame) -> DataFrame:
    return df.filter(F.col("is_simulated") == 0)


def simulated_only(df: DataFrame) -> DataFrame:
    return df.filter(F.col("is_simulated") == 1)


def sales_fact(sales: DataFrame, market: DataFrame) -> DataFrame:
    """Brand sales plus the simulated market as a virtual brand, one row per key.

    Of rows that agree in brand, region and period the first one in the input
    stays if both sources carry ``POSITION``, as an insert that ignores known
    keys would have it; without positions it is the one of smallest values.
    """
    columns = schemas.FACT_SALES.fieldNames()
    placed = [POSITION] if POSITION in sales.columns and POSITION in market.columns else []
    own = sales.withColumn("scripts_units", F.coalesce(F.col("scripts_units"), F.lit(0)))
    own = own.select(*columns, *placed, F.lit(0).alias("_source_rank"))
    virtual = conform(
        market,
        {"brand_id": V.MARKET_BRAND, "region_id": V.MARKET_REGION, "scripts_units": 0, "is_simulated": 1},
        {"revenue_usd_m": ("market_usd_bn", V.MARKET_SCALE)},
        [*columns, *placed],
    ).withColumn("_source_rank", F.lit(1))
    both = own.unionByName(virtual)
    order = ["_source_rank", *(placed or ["revenue_usd_m", "scripts_units", "is_simulated"])]
    return keep_first(both, ["brand_id", "region_id", "year"], order).drop("_source_rank", *placed)


def build_star(sources: Mapping[str, DataFrame], brand_order: Sequence[str] | None = None) -> dict[str, DataFrame]:
    """All star tables out of ``sales``, ``market``, ``trials`` and ``events``.

    A brand is described by its first row: in the input if the sales carry
    ``POSITION``, else by ``brand_order`` (year and region).
    """
    sales, market = sources["sales"], sources["market"]
    brand_order = brand_order or ([POSITION] if POSITION in sales.columns else ["year", "region_id"])
    trials, events = sources["trials"], sources["events"]
    brand_columns = schemas.DIM_BRAND.fieldNames()
    brands = keep_first(sales.select(*dict.fromkeys([*brand_columns, *brand_order])), ["brand_id"], list(brand_order))
    texts = ("title", "design", "endpoint", "recruitment")
    conformed = trials.select(
        *[
            text_or_empty(F.col(c)).alias(c) if c in texts
            else F.coalesce(F.col(c), F.lit(0)).alias(c) if c in ("start_year", "enrollment")
            else F.col(c)
            for c in schemas.FACT_TRIALS.fieldNames()
        ]
    )
    return {
        "dim_time": time_dimension([sales, market]),
        "dim_region": region_dimension(sales.sparkSession),
        "dim_brand": brands.select(*brand_columns),
        "fact_brand_sales": sales_fact(sales, market),
        "fact_trials": keep_first(conformed, ["nct_id"], ["start_year", "title", "status", "enrollment"]),
        "fact_events": events.select(*schemas.FACT_EVENTS.fieldNames()).withColumn("molecule", F.lower("molecule")),
    }


def refresh(tables: Mapping[str, DataFrame], folder: str) -> dict[str, DataFrame]:
    """Rewrite every table below ``folder`` and read it back. Runs jobs.

    Facts are partitioned by provenance, so a query for real rows never opens a
    file of simulated ones.
    """
    written = {}
    for name, df in tables.items():
        path = f"{folder}/{name}"
        writer = df.write.mode("overwrite")
        if "is_simulated" in df.columns and name.startswith("fact_"):
            writer = writer.partitionBy("is_simulated")
        writer.parquet(path)
        written[name] = df.sparkSession.read.schema(df.schema).parquet(path)
    return written
