"""Per-series trend forecast (Holt linear trend / simple exponential smoothing), fully distributed.

For fixed smoothing weights (alpha, beta) every Holt state is affine in the unknown initial level
L0 and trend B0:  level = p + q*L0 + r*B0,  trend = u + v*L0 + w*B0.  One `aggregate` fold over
the series carries (p, q, r, u, v, w) plus the normal-equation sums of the one-step errors, so the
least-squares (L0, B0) and the SSE come out in closed form. The weights are chosen on a fixed
grid (alpha 0.1..1.0, beta 0.0..1.0): all grid fits for a series are one `transform` inside
the row, the best (smallest SSE, then smallest alpha, beta) one `aggregate` more. No shuffle,
no Python, no driver loop: the work is one narrow projection over the series table.

Simple exponential smoothing is the same fold with the trend fixed at 0 (a 1x1 system).
A series with at least 3 non-zero years gets Holt, otherwise SES.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendlens.params import Params

ALPHAS = tuple(a / 10 for a in range(1, 11))   # 0.1 .. 1.0
BETAS = tuple(b / 10 for b in range(0, 11))    # 0.0 .. 1.0
MIN_DET = 1e-9
HOLT_MIN_NONZERO = 3

_SUMS = ("s_aa", "s_ac", "s_cc", "s_az", "s_cz", "s_zz")


def _lit(x: float) -> Column:
    return F.lit(float(x))


def _holt_fold(ys: Column, alpha: Column, beta: Column) -> Column:
    init = F.struct(*[_lit(v).alias(k) for k, v in
                      (("p", 0), ("q", 1), ("r", 0), ("u", 0), ("v", 0), ("w", 1))],
                    *[_lit(0).alias(k) for k in _SUMS])

    def step(s: Column, y: Column) -> Column:
        fd = s["p"] + s["u"]          # one-step forecast = fd + fa*L0 + fc*B0
        fa = s["q"] + s["v"]
        fc = s["r"] + s["w"]
        z = y - fd                    # error = z - fa*L0 - fc*B0
        one_a = _lit(1) - alpha
        one_b = _lit(1) - beta
        p2 = alpha * y + one_a * fd
        q2 = one_a * fa
        r2 = one_a * fc
        return F.struct(
            p2.alias("p"), q2.alias("q"), r2.alias("r"),
            (beta * (p2 - s["p"]) + one_b * s["u"]).alias("u"),
            (beta * (q2 - s["q"]) + one_b * s["v"]).alias("v"),
            (beta * (r2 - s["r"]) + one_b * s["w"]).alias("w"),
            (s["s_aa"] + fa * fa).alias("s_aa"),
            (s["s_ac"] + fa * fc).alias("s_ac"),
            (s["s_cc"] + fc * fc).alias("s_cc"),
            (s["s_az"] + fa * z).alias("s_az"),
            (s["s_cz"] + fc * z).alias("s_cz"),
            (s["s_zz"] + z * z).alias("s_zz"),
        )

    def finish(s: Column) -> Column:
        det = s["s_aa"] * s["s_cc"] - s["s_ac"] * s["s_ac"]
        l0 = (s["s_az"] * s["s_cc"] - s["s_cz"] * s["s_ac"]) / det
        b0 = (s["s_cz"] * s["s_aa"] - s["s_az"] * s["s_ac"]) / det
        ok = F.abs(det) >= _lit(MIN_DET)
        return F.struct(
            alpha.alias("alpha"), beta.alias("beta"),
            F.when(ok, s["s_zz"] - (l0 * s["s_az"] + b0 * s["s_cz"])).alias("sse"),
            F.when(ok, s["p"] + s["q"] * l0 + s["r"] * b0).alias("level"),
            F.when(ok, s["u"] + s["v"] * l0 + s["w"] * b0).alias("trend"),
        )

    return F.aggregate(ys, init, step, finish)


def _ses_fold(ys: Column, alpha: Column) -> Column:
    init = F.struct(_lit(0).alias("p"), _lit(1).alias("q"),
                    _lit(0).alias("s_aa"), _lit(0).alias("s_az"), _lit(0).alias("s_zz"))

    def step(s: Column, y: Column) -> Column:
        z = y - s["p"]
        one_a = _lit(1) - alpha
        return F.struct(
            (alpha * y + one_a * s["p"]).alias("p"),
            (one_a * s["q"]).alias("q"),
            (s["s_aa"] + s["q"] * s["q"]).alias("s_aa"),
            (s["s_az"] + s["q"] * z).alias("s_az"),
            (s["s_zz"] + z * z).alias("s_zz"),
        )

    def finish(s: Column) -> Column:
        l0 = s["s_az"] / s["s_aa"]
        ok = F.abs(s["s_aa"]) >= _lit(MIN_DET)
        return F.struct(
            alpha.alias("alpha"), _lit(0).alias("beta"),
            F.when(ok, s["s_zz"] - l0 * s["s_az"]).alias("sse"),
            F.when(ok, s["p"] + s["q"] * l0).alias("level"),
            F.when(ok, _lit(0)).alias("trend"),
        )

    return F.aggregate(ys, init, step, finish)


def _best(fits: Column) -> Column:
    """First fit with the smallest SSE in grid order (alpha asc, beta asc); NULL SSEs skipped."""
    def keep(best: Column, cur: Column) -> Column:
        better = cur["sse"].isNotNull() & (best["sse"].isNull() | (cur["sse"] < best["sse"]))
        return F.when(better, cur).otherwise(best)
    return F.aggregate(fits, fits[0], keep)


def _grid(pairs) -> Column:
    return F.array(*[F.struct(_lit(a).alias("alpha"), _lit(b).alias("beta")) for a, b in pairs])


def holt_fit(ys: Column) -> Column:
    grid = _grid([(a, b) for a in ALPHAS for b in BETAS])
    return _best(F.transform(grid, lambda g: _holt_fold(ys, g["alpha"], g["beta"])))


def ses_fit(ys: Column) -> Column:
    grid = _grid([(a, 0.0) for a in ALPHAS])
    return _best(F.transform(grid, lambda g: _ses_fold(ys, g["alpha"])))


def nonzero(ys: Column) -> Column:
    return F.size(F.filter(ys, lambda y: y != _lit(0)))


def fit_series(series: DataFrame) -> DataFrame:
    """Discipline, word, model ('holt'|'ses'), alpha, beta, sse, level, trend, last, max_year."""
    is_holt = nonzero(F.col("ys")) >= HOLT_MIN_NONZERO
    fit = F.when(is_holt, holt_fit(F.col("ys"))).otherwise(ses_fit(F.col("ys")))
    return series.select(
        "discipline", "word",
        F.when(is_holt, F.lit("holt")).otherwise(F.lit("ses")).alias("model"),
        fit.alias("_fit"),
        F.element_at("ys", -1).alias("last"),
        "max_year",
    ).select("discipline", "word", "model",
             F.col("_fit.alpha").alias("alpha"), F.col("_fit.beta").alias("beta"),
             F.col("_fit.sse").alias("sse"), F.col("_fit.level").alias("level"),
             F.col("_fit.trend").alias("trend"), "last", "max_year")


def horizon(history: DataFrame, params: Params = Params()) -> DataFrame:
    """one row: max_year, target_year, steps (<= 0 means no forecast)."""
    return history.agg(F.max("publish_year").alias("max_year")).select(
        "max_year", F.lit(params.target_year).alias("target_year"),
        (F.lit(params.target_year) - F.col("max_year")).alias("steps"))


def floored(value: Column, last: Column, params: Params) -> Column:
    """A failed fit (NULL/NaN) repeats the last value; then
    max(floor, trunc(last*damp), trunc(value)), truncating toward zero.
    The value is rounded to 6 places first so 11.9999999999 counts as 12."""
    v = F.when(value.isNull() | F.isnan(value), last).otherwise(value)
    return F.greatest(F.lit(params.floor).cast("long"),
                      (last * _lit(params.damp)).cast("long"),
                      F.round(v, 6).cast("long"))


def forecast_rows(fits: DataFrame, params: Params = Params()) -> DataFrame:
    """discipline, publish_year, word, count for each year max_year+1 .. target_year."""
    steps = F.sequence(F.lit(1), F.lit(params.target_year) - F.col("max_year"))
    ahead = fits.filter(F.col("max_year") < params.target_year) \
        .select("*", F.explode(steps).alias("_h"))
    value = F.col("level") + F.col("_h").cast("double") * F.col("trend")
    return ahead.select(
        "discipline",
        (F.col("max_year") + F.col("_h")).cast("int").alias("publish_year"),
        "word",
        floored(value, F.col("last"), params).alias("count"),
    )
