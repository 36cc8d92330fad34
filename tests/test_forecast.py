import numpy as np
from pyspark.sql import functions as F

from trendlens.operators import forecast
from trendlens.params import Params

SERIES = "discipline string, word string, ys array<double>, max_year int"


def _fit(spark, ys, max_year=2019):
    df = spark.createDataFrame([("d", "w", [float(y) for y in ys], max_year)], SERIES)
    return forecast.fit_series(df).first()


def _brute_holt(ys):
    """Grid x exact least squares over (L0, B0) by direct recursion (NumPy)."""
    best = None
    y = np.asarray(ys, dtype=float)
    for a in forecast.ALPHAS:
        for b in forecast.BETAS:
            # one-step errors are affine in (L0, B0): e = z - A @ [L0, B0]
            cols = []
            for basis in ((0.0, 0.0), (1.0, 0.0), (0.0, 1.0)):
                l, t = basis
                preds = []
                for obs in y:
                    f = l + t
                    preds.append(f)
                    l_new = a * obs + (1 - a) * f
                    t = b * (l_new - l) + (1 - b) * t
                    l = l_new
                cols.append(np.array(preds))
            z = y - cols[0]
            A = np.stack([cols[1] - cols[0], cols[2] - cols[0]], axis=1)
            sol, *_ = np.linalg.lstsq(A, z, rcond=None)
            sse = float(np.sum((z - A @ sol) ** 2))
            if best is None or sse < best[0] - 1e-9:
                best = (sse, a, b)
    return best


def test_fixture_series_holt(spark):
    r = _fit(spark, [3, 5, 4, 8, 9, 12, 11, 15])
    assert (r["model"], r["alpha"], r["beta"]) == ("holt", 0.1, 0.0)
    assert abs(r["sse"] - 9.811415857268571) < 1e-9
    assert abs(r["level"] - 14.171694357720638) < 1e-9
    assert abs(r["trend"] - 1.6544375994224478) < 1e-9


def test_fixture_series_sparse(spark):
    r = _fit(spark, [0, 0, 7, 0, 6, 0, 9, 2])
    assert (r["alpha"], r["beta"]) == (0.1, 0.0)
    assert abs(r["sse"] - 95.72747282727946) < 1e-9
    assert abs(r["level"] - 4.814135116772128) < 1e-9
    assert abs(r["trend"] - 0.523801856451599) < 1e-9


def test_fold_matches_brute_force(spark):
    rng = np.random.default_rng(7)
    for _ in range(4):
        ys = list(rng.integers(0, 30, size=10).astype(float))
        ys[3] = ys[5] = ys[7] = 5.0          # enough non-zero years for Holt
        r = _fit(spark, ys)
        sse, a, b = _brute_holt(ys)
        assert abs(r["sse"] - sse) < 1e-6 * max(1.0, sse)
        assert (r["alpha"], r["beta"]) == (a, b)


def test_ses_for_sparse_series(spark):
    r = _fit(spark, [0, 0, 0, 0, 0, 0, 0, 5])
    assert r["model"] == "ses" and r["trend"] == 0.0


def test_floor_rules(spark):
    p = Params()
    df = spark.createDataFrame([(100.0, -5.0), (0.0, 1.9), (10.0, 12.7), (7.0, float("nan"))], "last double, v double")
    got = [r[0] for r in df.select(forecast.floored(F.col("v"), F.col("last"), p)).collect()]
    assert got == [85, 3, 12, 7]


def test_no_forecast_past_target(spark):
    df = spark.createDataFrame([("d", "w", [1.0, 2.0, 3.0], 2026)], SERIES)
    assert forecast.forecast_rows(forecast.fit_series(df)).count() == 0


def test_forecast_rows_years_and_floor(spark):
    df = spark.createDataFrame([("d", "w", [3.0, 5.0, 4.0, 8.0, 9.0, 12.0, 11.0, 15.0], 2024)], SERIES)
    rows = forecast.forecast_rows(forecast.fit_series(df)).orderBy("publish_year").collect()
    assert [r["publish_year"] for r in rows] == [2025, 2026]
    assert all(r["count"] >= 3 and r["count"] >= int(15 * 0.85) for r in rows)
