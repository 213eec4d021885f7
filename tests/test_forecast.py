import pytest

from marketloom.operators import forecast as FC
from tests import fixtures as X


@pytest.fixture(scope="module")
def sales(spark):
    rows = [line.split(",") for line in X.SALES.splitlines()[1:]]
    return spark.createDataFrame([(r[0], int(r[6]), float(r[7])) for r in rows], "brand_id string, year int, revenue double").repartition(5)


ARGS = (["brand_id"], "year", "revenue")


def test_backtest(sales):
    rows = {r.brand_id: r for r in FC.backtest(sales, *ARGS).collect()}
    got = {k: (round(r.mape_ols, 2), round(r.mape_ensemble, 2)) for k, r in rows.items() if r.hold}
    assert got == {"mounjaro": (25.08, 45.79), "trulicity": (29.92, 30.05), "ozempic": (9.78, 19.60)}
    assert {k for k, r in rows.items() if r.mape_ensemble is None and r.mape_ols is None} == {"zepbound", "wegovy"}


def test_forecast(sales):
    table = FC.forecast(sales, *ARGS, start=2025).collect()
    got = {(r.brand_id, r.year): round(r.revenue, 1) for r in table}
    assert len(got) == 30
    want = {
        "mounjaro": (15969.2, 22660.5), "trulicity": (4497.1, 1984.3), "ozempic": (23024.6, 32292.8),
        "wegovy": (13187.2, 20917.7), "zepbound": (60455.9, 36590.3),
    }
    assert {b: (got[(b, 2025)], got[(b, 2030)]) for b in want} == want


def test_table(sales):
    rows = FC.forecast_table(sales, *ARGS).collect()
    assert (len(rows), sum(r.type == "actual" for r in rows)) == (43, 13)
    assert all(r.mape_backtest_pct is None for r in rows if r.type == "actual")
    assert {r.mape_backtest_pct for r in rows if r.type == "forecast" and r.brand_id == "mounjaro"} == {45.79}


def path(values, hold):
    """Plain restatement of the compounding growth path."""
    head = values[: len(values) - hold]
    rate = (head[-1] / max(head[0], 1e-9)) ** (1 / max(len(head) - 1, 1)) - 1
    out, current = [], head[-1]
    for i in range(hold):
        current *= 1 + rate * 0.8**i
        out.append(current)
    return out


@pytest.mark.parametrize("n, hold", [(1, 0), (2, 0), (3, 1), (5, 2)])
def test_series_lengths(spark, n, hold):
    values = [10.0, 14.0, 13.0, 20.0, 26.0][:n]
    df = spark.createDataFrame([("s", 2000 + i, v) for i, v in enumerate(values)], "k string, t int, v double")
    row = FC.backtest(df, ["k"], "t", "v").first()
    assert (row.n, row.hold) == (n, hold)
    if not hold:
        assert row.mape_ols is None and row.mape_ensemble is None
    else:
        head = values[: n - hold]
        m = len(head)
        mx, my = (m - 1) / 2, sum(head) / m
        sxx = sum((x - mx) ** 2 for x in range(m))
        slope = sum((x - mx) * (y - my) for x, y in enumerate(head)) / sxx if sxx else 0.0
        line = [slope * (m + i) + my - slope * mx for i in range(hold)]
        errors = [abs(a - (o + c) / 2) / a for a, o, c in zip(values[-hold:], line, path(values, hold))]
        assert row.mape_ensemble == pytest.approx(100 * sum(errors) / hold)
    trend = FC.ols_trend(df, ["k"], "t", "v").first()
    assert (trend.slope, trend.intercept) == ((0.0, 10.0) if n == 1 else (trend.slope, trend.intercept))
    assert all(r.v >= 0 for r in FC.forecast(df, ["k"], "t", "v").collect())


def test_floor_and_zero_actuals(spark):
    df = spark.createDataFrame([("s", i, v) for i, v in enumerate([100.0, 10.0, 0.0, 0.0])], "k string, t int, v double")
    assert {r.v for r in FC.forecast(df, ["k"], "t", "v").collect()} == {0.0}
    assert FC.backtest(df, ["k"], "t", "v").first().mape_ols is None
