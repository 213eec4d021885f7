from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.operators import market

Query = Callable[[SparkSession, str], DataFrame]


class QuerySet:
    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.oracles: dict[str, str] = {}

    def add(self, name: str, oracle: str | None = None) -> Callable[[Query], Query]:
        def register(query: Query) -> Query:
            self.queries[name] = query
            if oracle is not None:
                self.oracles[name] = oracle
            return query

        return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def net_price() -> Column:
    """Exact net line value, so that sums do not depend on their order."""
    price = F.col("l_extendedprice").cast("decimal(18,2)")
    return price * (F.lit(1).cast("decimal(4,2)") - F.col("l_discount").cast("decimal(4,2)"))


def money(name: str) -> Column:
    return F.col(name).cast("decimal(18,2)")


def brand_sales(spark: SparkSession, sf_dir: str, flagged: bool = False) -> DataFrame:
    """Sales fact (brand_id, year[, is_simulated], revenue) of lines and parts.

    Line status F stands in for reported rows, anything else for simulated ones.
    """
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("partkey"),
        F.year("l_shipdate").alias("year"),
        F.when(F.col("l_linestatus") == "F", 0).otherwise(1).alias("is_simulated"),
        net_price().alias("net"),
    )
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("partkey"), F.col("p_brand").alias("brand_id"))
    grain = ["year", "is_simulated"] if flagged else ["year"]
    return market.period_totals(
        lines, ["brand_id", *grain], {"revenue": F.col("net")}, parts, on="partkey", fact_cols=grain
    )


def as_money(c: str) -> Column:
    """Exact totals as doubles, for results."""
    return F.round(F.col(c).cast("double"), 2).alias(c)


# SQL texts shared by the oracles.
NET_SQL = "CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))"
BRAND_SALES_SQL = f"""
SELECT p_brand AS brand_id, CAST(year(l_shipdate) AS INTEGER) AS year, SUM({NET_SQL}) AS revenue
FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1, 2
"""
BRAND_SALES_FLAGGED_SQL = f"""
SELECT p_brand AS brand_id, CAST(year(l_shipdate) AS INTEGER) AS year,
       CASE WHEN l_linestatus = 'F' THEN 0 ELSE 1 END AS is_simulated, SUM({NET_SQL}) AS revenue
FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1, 2, 3
"""
