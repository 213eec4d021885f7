"""What plans read, what positions and counted writes keep."""

import csv
import random

import pytest
from pyspark.sql import functions as F

from marketloom import schemas
from marketloom.operators import warehouse as W
from marketloom.plans.registered import all_queries
from marketloom.sources import delimited
from tests import fixtures as X

SF = "/root/testdata/sf0.001"


def executed_scans(df, column):
    """How many scans with a column the plan ran, subqueries among them; only final plans turn columns into rows."""
    df.collect()
    lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
    return sum("ColumnarToRow" in a and f"FileScan parquet [{column}" in b for a, b in zip(lines, lines[1:]))


@pytest.mark.parametrize("name", ["base_vs_latest", "latest_topn"])
def test_latest_period_reports_scan_the_fact_once(spark, name):
    assert executed_scans(all_queries()[name](spark, SF), "l_") == 1


@pytest.mark.parametrize("name, column", [("forecast_table", "l_"), ("mann_whitney_auc", "doc_id"), ("provenance_split", "l_")])
def test_other_reports_scan_their_tables_once(spark, name, column):
    # Documents and labels both have the column.
    assert executed_scans(all_queries()[name](spark, SF), column) == (2 if column == "doc_id" else 1)


def test_first_rows_are_those_of_a_sequential_read(spark, tmp_path):
    """Two files with repeated keys, each read in many blocks."""
    header, *lines = X.SALES.strip().splitlines()
    rng = random.Random(1)
    names = header.split(",")
    rows = [dict(zip(names, r)) for r in csv.reader(lines)]
    folder = tmp_path / "sales"
    folder.mkdir()
    written = []
    for file in ("b.csv", "a.csv"):
        own = []
        for i in range(3000):
            r = dict(rng.choice(rows))
            r["revenue_usd_m"] = str(i + (0.5 if file == "a.csv" else 0))
            r["brand_name"] = f"{r['brand_name']} {rng.randint(0, 10**6)}"
            own.append(r)
        with open(folder / file, "w", newline="", encoding="utf-8") as f:
            out = csv.DictWriter(f, names)
            out.writeheader()
            out.writerows(own)
        written.append(own)
    in_order = written[1] + written[0]
    first, brand = {}, {}
    for r in in_order:
        first.setdefault((r["brand_id"], r["region_id"], int(r["year"])), float(r["revenue_usd_m"]))
        brand.setdefault(r["brand_id"], r["brand_name"])
    (tmp_path / "market.csv").write_text(X.MARKET, encoding="utf-8")
    was = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        sales = delimited.scan_csv(spark, str(folder), schemas.RAW_SALES, position=delimited.POSITION)
        assert sales.rdd.getNumPartitions() > 8
        market = delimited.scan_csv(spark, str(tmp_path / "market.csv"), schemas.RAW_MARKET, position=delimited.POSITION)
        fact = W.sales_fact(sales.repartition(5), market)
        got = {(r.brand_id, r.region_id, r.year): r.revenue_usd_m for r in fact.collect()}
        assert {k: got[k] for k in first} == first and fact.columns == schemas.FACT_SALES.fieldNames()
        brands = W.keep_first(sales.repartition(7), ["brand_id"], [delimited.POSITION])
        assert {r.brand_id: r.brand_name for r in brands.collect()} == brand
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", was)


def test_counted_writes(spark, tmp_path):
    df = spark.range(100).repartition(4).withColumn("x", F.col("id") * 2)
    path = str(tmp_path / "r")
    assert delimited.write_result(df, path) == 100
    assert delimited.write_result(df.filter("id < 0"), path) == 0 and spark.read.option("header", True).csv(path).count() == 100
    assert delimited.write_result(df.filter("id < 7"), path, "parquet") == 7 and spark.read.parquet(path).count() == 7
    assert [p.name for p in tmp_path.iterdir()] == ["r"] and not spark.sparkContext._jsc.getPersistentRDDs()


@pytest.mark.parametrize("name", ["tfidf_scores", "text_features"])
def test_text_scores_scan_the_corpus_twice(spark, name):
    df = all_queries()[name](spark, SF)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("\n+- == Initial Plan ==")[0].splitlines()
    scans = [b.split("FileScan parquet ")[1].split("]")[0] for a, b in zip(plan, plan[1:]) if "ColumnarToRow" in a and "FileScan" in b]
    # Once for the vocabulary with its counts, once for the scores.
    assert len(scans) == 2 and sum(s.startswith("[text#") for s in scans) == 1
