"""Forecasters over many daily series: autoregressive ridge, seasonal ridge, and the ensemble of both with boosted trees.

Each fitted per-series model is a row of a table, so models are saved, loaded and joined like data. Groups
handed to Python are single daily series (one row per calendar day at most).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from brightloom.operators.boosting import fit_gbt, forecast_gbt
from brightloom.operators.forecast_frames import HORIZON, LOOKBACK, Z, accuracy, blend, inverse_rmse_weights, split_by_time, with_horizon
from brightloom.staging import stage
from brightloom.unions import union_all

AR_MODEL = "series_id string, low double, width double, coef array<double>, sigma double, recent array<double>, last_ds date"


def ridge(x: np.ndarray, y: np.ndarray, alpha: float) -> np.ndarray:
    """Ridge coefficients; the first column is the intercept and is not shrunk."""
    penalty = alpha * np.eye(x.shape[1])
    penalty[0, 0] = 0.0
    return np.linalg.lstsq(x.T @ x + penalty, x.T @ y, rcond=None)[0]


def _windows(scaled: np.ndarray, lookback: int) -> tuple[np.ndarray, np.ndarray]:
    frames = np.lib.stride_tricks.sliding_window_view(scaled, lookback + 1)
    return np.column_stack([np.ones(len(frames)), frames[:, :-1]]), frames[:, -1]


# --- autoregressive ridge -------------------------------------------------------------------------


def fit_ar(series: DataFrame, lookback: int = LOOKBACK, alpha: float = 1.0) -> DataFrame:
    """One model row per series that has more than ``lookback`` days."""

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.dropna(subset=["y"]).sort_values("ds")
        y = pdf["y"].to_numpy(dtype="float64")
        if len(y) <= lookback:
            return pd.DataFrame(columns=["series_id", "low", "width", "coef", "sigma", "recent", "last_ds"])
        low, width = y.min(), (y.max() - y.min()) or 1.0
        scaled = (y - low) / width
        x, target = _windows(scaled, lookback)
        coef = ridge(x, target, alpha)
        sigma = float(np.std(target - x @ coef)) * width
        row = (pdf["series_id"].iloc[0], low, width, coef.tolist(), sigma, scaled[-lookback:].tolist(), pdf["ds"].iloc[-1])
        return pd.DataFrame([row], columns=["series_id", "low", "width", "coef", "sigma", "recent", "last_ds"])

    return series.select("series_id", "ds", "y").groupBy("series_id").applyInPandas(fit, AR_MODEL)


def _recurse(coef: np.ndarray, recent: Sequence[float], steps: int) -> np.ndarray:
    """The next ``steps`` scaled values, each fed back; a model that runs away is left to (its error then says so)."""
    known = np.empty(len(recent) + steps)
    known[: len(recent)] = recent
    with np.errstate(over="ignore", invalid="ignore"):
        for i in range(steps):
            known[len(recent) + i] = coef[0] + coef[1:] @ known[i : len(recent) + i]
    return known[len(recent) :]


def forecast_ar(models: DataFrame, horizon: int | DataFrame = HORIZON, level: float = 0.95) -> DataFrame:
    """Recursive forecast of every model row; bounds are the training residuals' deviation times z."""
    z = Z[level]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            parts = []
            for m in pdf.itertuples(index=False):
                yhat = _recurse(np.asarray(m.coef), m.recent, m.horizon) * m.width + m.low
                days = pd.date_range(pd.Timestamp(m.last_ds) + pd.Timedelta(days=1), periods=m.horizon).date
                parts.append(pd.DataFrame({
                    "series_id": m.series_id, "model": "ar", "ds": days, "yhat": yhat,
                    "lower": yhat - z * m.sigma, "upper": yhat + z * m.sigma,
                }))
            yield pd.concat(parts) if parts else pd.DataFrame(columns=["series_id", "model", "ds", "yhat", "lower", "upper"])

    return with_horizon(models, horizon).mapInPandas(run, "series_id string, model string, ds date, yhat double, lower double, upper double")


# --- seasonal ridge -------------------------------------------------------------------------------

# Fixed values: (name, period in days, Fourier order).
SEASONS = (("weekly", 7.0, 3), ("yearly", 365.25, 10), ("monthly", 30.5, 5), ("quarterly", 91.25, 8))


def fourier(ds: Column, period: float, order: int, name: str) -> list[Column]:
    """Sine and cosine terms of the day number since 1970."""
    day = F.unix_date(ds)
    out = []
    for k in range(1, order + 1):
        angle = F.lit(2.0) * F.pi() * F.lit(float(k)) * day / F.lit(float(period))
        out += [F.sin(angle).alias(f"{name}_sin_{k}"), F.cos(angle).alias(f"{name}_cos_{k}")]
    return out


def _seasonal_design(frame: DataFrame, holidays: DataFrame | None) -> DataFrame:
    """Add ``x``: intercept, trend, Fourier terms and a holiday flag. Needs start_ds and span."""
    trend = F.datediff("ds", "start_ds") / F.greatest(F.col("span"), F.lit(1))
    terms = [F.lit(1.0), trend.cast("double")]
    for name, period, order in SEASONS:
        terms += fourier(F.col("ds"), period, order, name)
    if holidays is not None:
        # a calendar of holidays: one row per day at most
        frame = frame.join(holidays.select("ds", F.lit(1.0).alias("holiday")).distinct(), "ds", "left")
        terms.append(F.coalesce(F.col("holiday"), F.lit(0.0)))
    return frame.withColumn("x", F.array(*terms))


def with_span(series: DataFrame) -> DataFrame:
    """Days with a value, with ``start_ds`` and ``span`` (days from the first to the last) of their series."""
    whole = W.partitionBy("series_id")
    frame = series.filter("y IS NOT NULL").withColumn("start_ds", F.min("ds").over(whole))
    return frame.withColumn("span", F.datediff(F.max("ds").over(whole), F.col("start_ds")))


def _soft(v: float, by: float) -> float:
    return float(np.sign(v) * max(0.0, abs(v) - by))


def _hinge(day: np.ndarray, at: np.ndarray, span: int) -> np.ndarray:
    return np.maximum(0.0, day[:, None] - np.asarray(at, np.float64)[None, :]) / max(span, 1)


def trend_breaks(x: np.ndarray, y: np.ndarray, day: np.ndarray, span: int, alpha: float, candidates: int = 25, share: float = 0.8) -> list[int]:
    """Days (since the first) after which the slope changes: a sparse choice among hinges in the first ``share`` of the days.

    The other terms are taken out first (the Schur complement of X'X), so the hinges alone are left to coordinate descent with an
    absolute penalty at the level of noise. Neighbouring choices are one break; its day is then the one that explains most, and it
    stays if it lowers the Bayesian information criterion by more than the cost of a day and a slope.
    """
    n, last = len(y), share * day[-1]
    spots = np.unique(np.round(np.linspace(0, last, candidates + 2)[1:-1])).astype(int)
    if n < 4 * x.shape[1] or not len(spots) or span < 2:
        return []
    penalty = alpha * np.eye(x.shape[1])
    penalty[0, 0] = 0.0
    base = np.linalg.pinv(x.T @ x + penalty)
    clear = lambda v: v - x @ (base @ (x.T @ v))
    h, rest = clear(_hinge(day, spots, span)), clear(y)
    gram, moment = h.T @ h, h.T @ rest
    noise = 1.4826 * float(np.median(np.abs(np.diff(rest)))) / np.sqrt(2)  # of neighbouring days, which no slow trend reaches
    size = np.sqrt(np.maximum(np.diag(gram), 1e-12))
    level = max(noise, 1e-9) * np.sqrt(2 * np.log(len(spots) + 1))
    slope = np.zeros(len(spots))
    for _ in range(500):
        before = slope.copy()
        for j in range(len(spots)):
            slope[j] = _soft(moment[j] - gram[j] @ slope + gram[j, j] * slope[j], level * size[j]) / (size[j] * size[j])
        if np.abs(slope - before).max() <= 1e-7 * max(1.0, np.abs(slope).max()):
            break
    step = int(spots[1] - spots[0]) if len(spots) > 1 else int(last)
    groups: list[list[int]] = []
    for j in np.flatnonzero(np.abs(slope) * size > level):
        if groups and spots[j] - spots[groups[-1][-1]] <= 2 * step and np.sign(slope[j]) == np.sign(slope[groups[-1][-1]]):
            groups[-1].append(int(j))
        else:
            groups.append([int(j)])
    found = [int(round(np.average(spots[g], weights=np.abs(slope[g])))) for g in groups]
    for _ in range(2):  # each break moves to its best day while the others stand
        for i in range(len(found)):
            others = _hinge(day, found[:i] + found[i + 1 :], span)
            taken = np.linalg.qr(clear(others))[0] if others.shape[1] else np.zeros((n, 0))
            window = np.arange(max(1, found[i] - 2 * step), min(int(last), found[i] + 2 * step) + 1)
            trial = clear(_hinge(day, window, span))
            trial = trial - taken @ (taken.T @ trial)
            left = rest - taken @ (taken.T @ rest)
            gain = (trial.T @ left) ** 2 / np.maximum((trial * trial).sum(axis=0), 1e-12)
            found[i] = int(window[gain.argmax()])
    found = sorted(set(found))
    while found:  # drop the break that explains least while the criterion gets better
        every = clear(_hinge(day, found, span))
        rss = lambda m: float(np.sum((rest - m @ np.linalg.lstsq(m, rest, rcond=None)[0]) ** 2)) if m.shape[1] else float(np.sum(rest**2))
        whole = rss(every)
        without = [rss(np.delete(every, i, axis=1)) for i in range(len(found))]
        least = int(np.argmin(without))
        if n * np.log(without[least] / max(whole, 1e-300)) > 4 * np.log(n):
            break
        del found[least]
    return found


SEASONAL_MODEL = "series_id string, start_ds date, span int, coef array<double>, sigma double, last_ds date, breaks array<int>, slopes array<double>"


def fit_seasonal(series: DataFrame, alpha: float = 1.0, holidays: DataFrame | None = None, candidates: int = 25) -> DataFrame:
    """One row per series: trend with breaks (at most ``candidates`` are looked for; 0 for a straight one) plus seasons."""

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("ds")
        x, y = np.array(pdf["x"].tolist(), dtype="float64"), pdf["y"].to_numpy(dtype="float64")
        scale, span = float(np.std(y)) or 1.0, int(pdf["span"].iloc[0])
        day = (pd.to_datetime(pdf["ds"]) - pd.Timestamp(pdf["start_ds"].iloc[0])).dt.days.to_numpy()
        breaks = trend_breaks(x, y / scale, day, span, alpha, candidates) if candidates else []
        bent = np.column_stack([x, _hinge(day, breaks, span)])
        coef = ridge(bent, y / scale, alpha) * scale if not breaks else _bent_ridge(bent, y / scale, alpha, len(breaks)) * scale
        row = (pdf["series_id"].iloc[0], pdf["start_ds"].iloc[0], span, coef[: x.shape[1]].tolist(), float(np.std(y - bent @ coef)), pdf["ds"].iloc[-1],
               breaks, coef[x.shape[1] :].tolist())
        return pd.DataFrame([row], columns=[c.split()[0] for c in SEASONAL_MODEL.split(", ")])

    design = _seasonal_design(with_span(series), holidays).select("series_id", "ds", "y", "start_ds", "span", "x")
    return design.groupBy("series_id").applyInPandas(fit, SEASONAL_MODEL)


def _bent_ridge(x: np.ndarray, y: np.ndarray, alpha: float, breaks: int) -> np.ndarray:
    """Ridge in which trend and breaks are not shrunk: they have been chosen already, and shrinking one bends the others."""
    penalty = alpha * np.eye(x.shape[1])
    free = [0, 1, *range(x.shape[1] - breaks, x.shape[1])]
    penalty[free, free] = 0.0
    return np.linalg.lstsq(x.T @ x + penalty, x.T @ y, rcond=None)[0]


def forecast_seasonal(
    models: DataFrame, horizon: int | DataFrame = HORIZON, level: float = 0.95, holidays: DataFrame | None = None
) -> DataFrame:
    """Forecast of every model row; ``breaks`` and ``slopes`` may be missing."""
    days = F.explode(F.sequence(F.date_add("last_ds", 1), F.date_add("last_ds", F.col("horizon"))))
    frame = _seasonal_design(with_horizon(models, horizon).withColumn("ds", days), holidays)
    add = lambda s, v: s + v
    yhat = F.aggregate(F.zip_with("x", "coef", lambda a, b: a * b), F.lit(0.0), add)
    if "breaks" in models.columns:
        since = F.datediff("ds", "start_ds")
        bend = F.zip_with("breaks", "slopes", lambda d, s: s * F.greatest(F.lit(0), since - d) / F.greatest(F.col("span"), F.lit(1)))
        yhat = yhat + F.aggregate(bend, F.lit(0.0), add)
    half = F.col("sigma") * F.lit(Z[level])
    return frame.select("series_id", F.lit("seasonal").alias("model"), "ds", yhat.alias("yhat"), half.alias("h")).select(
        "series_id", "model", "ds", "yhat", (F.col("yhat") - F.col("h")).alias("lower"), (F.col("yhat") + F.col("h")).alias("upper")
    )


# --- ensemble -------------------------------------------------------------------------------------

PARTS = ("series", "ar", "seasonal", "trees", "weights", "metrics")


@dataclass(frozen=True)
class Ensemble:
    """Fitted models (a row per series; a series too short for a model has no row there), weights and metrics of the holdout."""

    series: DataFrame
    ar: DataFrame | None = None
    seasonal: DataFrame | None = None
    trees: DataFrame | None = None
    weights: DataFrame | None = None
    metrics: DataFrame | None = None

    def forecasts(self, horizon: int | DataFrame = HORIZON) -> DataFrame:
        """Rows of every model, see ``MODEL_COLUMNS``."""
        each = ((self.ar, forecast_ar), (self.seasonal, forecast_seasonal), (self.trees, forecast_gbt))
        parts = [forecast(models, horizon) for models, forecast in each if models is not None]
        if not parts:
            raise ValueError("the ensemble has no model")
        return union_all(*parts)

    def forecast(self, horizon: int | DataFrame = HORIZON, renormalise: bool = False) -> DataFrame:
        return blend(self.forecasts(horizon), self.weights, renormalise)

    def save(self, path: str) -> None:
        """Write every part under ``path``; what is missing there is missing after loading."""
        there = [name for name in PARTS if getattr(self, name) is not None]
        for name in there:
            getattr(self, name).write.mode("overwrite").parquet(f"{path}/{name}")
        self.series.sparkSession.createDataFrame([(n,) for n in there], "part string").write.mode("overwrite").parquet(f"{path}/parts")


def load_ensemble(spark: SparkSession, path: str) -> Ensemble:
    there = {r[0] for r in spark.read.parquet(f"{path}/parts").collect()}
    return Ensemble(**{name: spark.read.parquet(f"{path}/{name}") for name in PARTS if name in there})


def _fitted(series: DataFrame, trees: int, depth: int) -> Ensemble:
    return Ensemble(series, stage(fit_ar(series), "ar"), stage(fit_seasonal(series), "seasonal"), stage(fit_gbt(series, trees, depth), "trees") if trees else None)


def holdout_horizon(train: DataFrame, test: DataFrame) -> DataFrame:
    """(series_id, horizon): calendar days from the end of training to the last day of the holdout."""
    last = train.filter("y IS NOT NULL").groupBy("series_id").agg(F.max("ds").alias("a"))
    return last.join(test.groupBy("series_id").agg(F.max("ds").alias("b")), "series_id").select("series_id", F.datediff("b", "a").alias("horizon"))


def fit_ensemble(series: DataFrame, horizon: int = HORIZON, train_share: float = 0.8, trees: int = 1000, depth: int = 6) -> Ensemble:
    """Models are fitted on the first part of each series and judged on all of the rest; the weights then blend models
    refitted on the whole series. A model that a series is too short for has no weight there; failed jobs are not hidden."""
    series = stage(series, "series")
    split = split_by_time(series, train_share)
    train = stage(split.filter("part = 'train'").select("series_id", "ds", "y"), "train")
    test = stage(split.filter("part = 'test'").select("series_id", "ds", "y"), "test")
    first = _fitted(train, trees, depth)
    metrics = stage(accuracy(test, first.forecasts(stage(holdout_horizon(train, test), "horizon"))), "metrics")
    weights = stage(inverse_rmse_weights(metrics), "weights")
    return replace(_fitted(series, trees, depth), weights=weights, metrics=metrics)


def ensemble(series: DataFrame, horizon: int = HORIZON, renormalise: bool = False, **options) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(blended forecast, weights, holdout metrics), see ``fit_ensemble``."""
    fitted = fit_ensemble(series, horizon, **options)
    return fitted.forecast(horizon, renormalise), fitted.weights, fitted.metrics


# --- persistence ----------------------------------------------------------------------------------


def save_models(models: DataFrame, path: str) -> None:
    models.write.mode("overwrite").parquet(path)


def load_models(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


