import json

from marketloom.operators import kpi as K
from marketloom.operators import models as ML
from marketloom.plans import pipeline
from tests import fixtures as X
from tests.test_warehouse import csv_files


def test_whole_run(spark, tmp_path):
    paths = csv_files(tmp_path)
    people = [(i, 30.0 + i % 40, 20.0 + i % 17, 10.0 * (i % 9), i % 2, i % 3 % 2, i % 5 % 2) for i in range(60)]
    spark.createDataFrame(
        people, "patient_id int, age double, bmi double, income_k double, glp1_aware int, cost_sensitive int, tech_savvy int"
    ).write.parquet(str(tmp_path / "people"))
    campaign = [(i, i % 2, int(i % 20 == 0 or i % 11 == 1)) for i in range(400)]
    spark.createDataFrame(campaign, "user_id int, arm int, converted int").write.parquet(str(tmp_path / "campaign"))
    pages = tmp_path / "pages"
    pages.mkdir()
    studies = [X.study(f"NCT{i:03d}", f"Tirzepatide study {i % 4}", ("PHASE3",), f"20{10 + i % 10}-01", 50 + i) for i in range(40)]
    for i, s in enumerate(studies):
        if i % 2:
            s["protocolSection"]["statusModule"]["overallStatus"] = "RECRUITING"
    (pages / "1.json").write_text(json.dumps({"studies": studies}))
    grids = {ML.LR: {"C": [1.0], "elastic": [0.0]}, ML.RF: {"trees": [5], "depth": [3], "min_leaf": [1]}}
    inputs = pipeline.Inputs(
        paths["sales"], paths["market"], str(pages), paths["trials"], str(tmp_path / "none"), paths["events"],
        str(tmp_path / "people"), str(tmp_path / "campaign"),
    )
    out = tmp_path / "out"
    results = pipeline.run(spark, inputs, str(out), grids=grids, horizon_start=2025)
    assert {r.state for r in results["status"].collect()} == {"written"}
    kpis = {(r.kpi, r.key): r.value for r in results["kpi"].collect()}
    assert kpis[("leader_revenue", "Ozempic (semaglutide T2D)")] == "17,530.0"
    assert kpis[("leader_share_pct", "Ozempic (semaglutide T2D)")] == "36.8"
    assert kpis[("company_trials", "Eli Lilly")] == "40"
    assert kpis[("simulated_market_bn", "2030")] == "11.6" and kpis[("simulated_penetration_pct", "2030")] == "2.0"
    assert kpis[("sample_size", "response 55% vs 45%")] == "392"
    assert kpis[("ab_test", "n_control")] == "200"
    written = {p.name for p in out.iterdir()}
    assert {"warehouse", "query_results", "keywords", "forecast", "model_results", "segments", "ab_summary", "kpi"} <= written
    assert sum(r.n for r in results["segment_profile"].collect()) == 60


def test_small_trial_set_leaves_models_out(spark, tmp_path):
    paths = csv_files(tmp_path)
    inputs = pipeline.Inputs(paths["sales"], paths["market"], str(tmp_path / "no"), paths["trials"], str(tmp_path / "no"), paths["events"])
    results = pipeline.run(spark, inputs, str(tmp_path / "out"))
    assert "model_results" not in results and "segments" not in results
    assert results["forecast"].count() == 43
    assert not (tmp_path / "out" / "quarantine").exists()


def test_malformed_trials_do_not_stop_the_run(spark, tmp_path):
    paths = csv_files(tmp_path)
    (tmp_path / "trials.csv").write_text(X.trials_csv(quoted=False))
    inputs = pipeline.Inputs(paths["sales"], paths["market"], str(tmp_path / "no"), paths["trials"], str(tmp_path / "no"), paths["events"])
    results = pipeline.run(spark, inputs, str(tmp_path / "out"))
    assert spark.read.option("header", True).csv(str(tmp_path / "out" / "quarantine" / "trials")).count() == 10
    states = {r.query: r.state for r in results["status"].collect()}
    assert states["trial_pipeline"] == "empty" and states["brand_share"] == "written"


def test_leader_is_of_the_latest_year(spark):
    df = spark.createDataFrame([(2023, "a", 9.0, 90.0), (2024, "b", 5.0, 60.0), (2024, "c", 5.0, 40.0)], "y int, k string, v double, s double")
    assert [tuple(r) for r in K.leader(df, "y", "k", "v", "s").collect()] == [(2024, "b", 5.0, 60.0)]
    assert K.leader(df.limit(0), "y", "k", "v", "s").collect() == []
