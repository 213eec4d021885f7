import pytest
from pyspark.sql import functions as F

from marketloom import schemas
from marketloom.operators import market, reshape
from marketloom.operators import warehouse as W
from marketloom.plans import catalogue
from marketloom.sources import delimited, landed
from tests import fixtures as X


def csv_files(folder):
    texts = {"sales": X.SALES, "market": X.MARKET, "events": X.EVENTS, "trials": X.trials_csv()}
    for name, text in texts.items():
        (folder / f"{name}.csv").write_text(text, encoding="utf-8")
    return {name: str(folder / f"{name}.csv") for name in texts}


@pytest.fixture(scope="module")
def star(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("raw")
    paths = csv_files(folder)
    sources = {
        "sales": delimited.scan_csv(spark, paths["sales"], schemas.RAW_SALES),
        "market": delimited.scan_csv(spark, paths["market"], schemas.RAW_MARKET),
        "trials": landed.ingest_trials(spark, str(folder / "none"), paths["trials"]),
        "events": landed.ingest_events(spark, str(folder / "none"), paths["events"]),
    }
    return W.refresh(W.build_star(sources), str(folder / "warehouse"))


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_star_tables(star):
    assert {n: t.count() for n, t in star.items()} == {
        "dim_time": 9, "dim_region": 2, "dim_brand": 5, "fact_brand_sales": 21, "fact_trials": 10, "fact_events": 12,
    }
    assert sorted(rows(star["dim_time"]))[0] == (2022, "2020")
    assert W.simulated_only(star["fact_brand_sales"]).count() == 8
    assert star["fact_brand_sales"].filter("scripts_units IS NULL").isEmpty()


def test_brand_share(star):
    share = {(r.brand_name.split()[0].lower(), r.year): r.share_pct for r in catalogue.brand_share(star).collect()}
    assert len(share) == 13
    assert [share[(b, 2024)] for b in ("ozempic", "mounjaro", "wegovy", "trulicity", "zepbound")] == [36.80, 24.21, 17.63, 11.02, 10.34]
    assert [share[(b, 2022)] for b in ("ozempic", "trulicity", "mounjaro")] == [40.81, 35.91, 23.28]


def test_brand_growth(star):
    grown = {}
    for r in catalogue.brand_growth(star).collect():
        grown.setdefault(r.brand_name.split()[0].lower(), []).append(r.yoy_growth_pct)
    assert grown == {
        "trulicity": [None, -4.2, -26.4], "ozempic": [None, 63.8, 26.6], "wegovy": [None, 85.1],
        "mounjaro": [None, 99.5, 19.8], "zepbound": [None, 2698.3],
    }


def test_brand_launches(star):
    years = {}
    for r in catalogue.brand_launches(star).collect():
        years.setdefault(r.brand_name.split()[0], []).append(r.years_since_launch)
    assert years == {"Mounjaro": [1, 2, 3], "Trulicity": [1, 2, 3], "Zepbound": [1, 2]}


def test_base_vs_latest(star):
    assert [(r.rev_2022, r.rev_latest) for r in catalogue.brand_base_vs_latest(star).collect()] == [(8457, 17530), (4824, 11532), (7441, 5250)]


def test_safety_signals(star):
    got = rows(catalogue.safety_signals(star))
    assert len(got) == 8
    assert got[:4] == [
        ("semaglutide", "Gastrointestinal", 32350, 7640, 23.6),
        ("tirzepatide", "Gastrointestinal", 25040, 5550, 22.2),
        ("semaglutide", "Nausea & Vomiting", 24320, 4850, 19.9),
        ("tirzepatide", "Nausea & Vomiting", 19500, 3620, 18.6),
    ]


def test_trial_pipeline_and_market(star):
    assert rows(catalogue.trial_pipeline(star)) == [("Eli Lilly", "Phase 3", 7, 7689), ("Novo Nordisk", "Phase 3", 3, 20975)]
    market_rows = rows(catalogue.simulated_market(star))
    assert (market_rows[0], market_rows[-1], len(market_rows)) == ((2023, 1.2, 1), (2030, 11.6, 1), 8)


def test_run_all_goes_on_after_a_failure(spark, star, tmp_path):
    broken = {**catalogue.CATALOGUE, "broken": lambda t: t["dim_time"].select("nope"), "last": lambda t: t["dim_time"]}
    states = {r.query: r.state for r in catalogue.run_all(spark, star, str(tmp_path / "out"), broken).collect()}
    assert states["broken"] == "failed" and states["last"] == "written"
    assert sum(s == "written" for s in states.values()) == 8
    with pytest.raises(Exception, match="nope"):
        catalogue.run_all(spark, star, str(tmp_path / "out2"), broken, on_error="raise")


def test_real_rows_read_one_partition(star):
    plan = W.real_only(star["fact_brand_sales"])._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(is_simulated" in plan


def test_growth_uses_the_previous_row_and_skips_zero(spark):
    df = spark.createDataFrame([("a", 2020, 0.0), ("a", 2021, 10.0), ("a", 2023, 15.0), ("b", 2020, 1.0)], "k string, y int, v double")
    got = [tuple(r) for r in market.growth(df, ["k"], "y", "v").orderBy("k", "y").select("k", "y", "yoy_growth_pct").collect()]
    assert got == [("a", 2020, None), ("a", 2021, None), ("a", 2023, 50.0), ("b", 2020, None)]


def test_keep_first_and_insert_or_ignore(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("b", 5, None), ("b", 6, "z")], "k string, o int, v string")
    first = W.keep_first(df, ["k"], ["o"])
    assert sorted(rows(first), key=str) == [("a", 1, "y"), ("b", 5, None)]
    new = spark.createDataFrame([("b", 1, "n"), ("c", 2, "p"), ("c", 1, "q")], "k string, o int, v string")
    assert sorted(rows(W.insert_or_ignore(first, new, ["k"], ["o"])), key=str) == [("a", 1, "y"), ("b", 5, None), ("c", 1, "q")]


def test_pivot_last_wins_and_numbers_sort_first(spark):
    data = [("10", "s", 1.0, 1), ("9", "s", 2.0, 2), ("x", "t", 3.0, 3), ("9", "s", 4.0, 4)]
    df = spark.createDataFrame(data, "x string, g string, y double, o int")
    assert rows(reshape.pivot_wide(df, "x", "g", "y", ["s", "t"], "o")) == [("9", 4.0, None), ("10", 1.0, None), ("x", None, 3.0)]
    assert rows(reshape.pivot_wide(df, "x", None, "y", order="o")) == [("9", 4.0), ("10", 1.0), ("x", 3.0)]


def test_base_vs_latest_latest_row_may_be_simulated(spark):
    data = [("a", 2022, 1.0, 0), ("a", 2024, 5.0, 1), ("b", 2022, 2.0, 0), ("b", 2024, 3.0, 0), ("c", 2025, 9.0, 1)]
    df = spark.createDataFrame(data, "k string, y int, v double, is_simulated int")
    got = market.base_vs_latest(df, ["k"], "y", "v", 2022, F.col("is_simulated") == 0)
    assert sorted(rows(got)) == [("a", 1.0, 5.0), ("b", 2.0, 3.0)]


@pytest.mark.parametrize("partitions", [1, 8, 64])
def test_partition_invariance(spark, partitions):
    data = [(f"k{i % 7}", 2000 + i % 5, float(i * 37 % 101)) for i in range(400)]
    df = spark.createDataFrame(data, "k string, y int, v double").repartition(partitions)
    totals = market.period_totals(df, ["k", "y"], {"v": F.col("v")})
    shares = market.share_of_period(totals, "y", "v")
    per_year = {r.y: r.s for r in shares.groupBy("y").agg(F.sum("share_pct").alias("s")).collect()}
    assert all(abs(s - 100) < 0.05 for s in per_year.values())
    assert sum(r.v for r in totals.collect()) == sum(v for _, _, v in data)


def test_totals_are_the_same_with_and_without_broadcast(spark):
    lines = spark.createDataFrame([(0 if i % 3 else i, i % 4, i) for i in range(300)], "k int, y int, v long")
    names = spark.range(300).select(F.col("id").cast("int").alias("k"), F.concat(F.lit("b"), F.col("id") % 5).alias("b"))

    def totals():
        return market.period_totals(lines, ["b", "y"], {"v": F.col("v")}, names, on="k", fact_cols=["y"])

    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    small = sorted(rows(totals()))
    assert "BroadcastHashJoin" in totals()._jdf.queryExecution().toString()
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10")
        assert sorted(rows(totals())) == small
        assert "SortMergeJoin" in totals()._jdf.queryExecution().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
