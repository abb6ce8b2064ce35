"""Search for the settings of the forecasters: races of trials by successive halving, with later trials drawn where earlier ones did well.

Trials are rows of a table. A rung is one job over (series, model, trial): every trial still in the race is fitted on the first part of
its series with the rung's budget and judged on all days of the rest; the better third goes to the next rung, which has three times the
budget. For the second round of a series and model, points drawn around its good trials are ranked by the density of good trials over
that of the others, and the best of them are raced in turn. The budget of the trees is their number; that of the other models is the
number of training days, the latest first. A setting that cannot be fitted has an infinite error.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window as W, functions as F

from brightloom.functions.calendar import FORECAST_CALENDAR
from brightloom.operators.boosting import GBT_FEATURES, feed_back, grow
from brightloom.operators.forecast_frames import forecast_features, split_by_time
from brightloom.operators.forecast_models import SEASONS, _recurse, _seasonal_design, _windows, ridge, with_span
from brightloom.staging import stage
from brightloom.unions import union_all

KEEP = 3  # one in so many trials goes on, with so many times the budget


@dataclass(frozen=True)
class Setting:
    """A number that a trial chooses: an integer, or a real number on a logarithmic scale."""

    name: str
    low: float
    high: float
    whole: bool = True

    def value(self, u: float) -> float:
        if self.whole:
            return float(min(int(self.low + u * (self.high - self.low + 1)), int(self.high)))
        return float(self.low * (self.high / self.low) ** u)

    def place(self, value: float) -> float:
        if self.whole:
            return (value - self.low + 0.5) / (self.high - self.low + 1)
        return float(np.log(value / self.low) / np.log(self.high / self.low))


@dataclass(frozen=True)
class Model:
    """``error(train, test, budget, **settings)``: frames with y and x (features of the model), in the order of days."""

    settings: tuple[Setting, ...]
    error: Callable[..., float]
    frame: Callable[[DataFrame], DataFrame] | None = None  # adds x: array<double>

    def values(self, u: Sequence[float]) -> dict[str, float]:
        return {s.name: s.value(x) for s, x in zip(self.settings, u)}


def _rmse(off: np.ndarray) -> float:
    found = float(np.sqrt(np.mean(off * off))) if len(off) else float("inf")
    return found if np.isfinite(found) else float("inf")


def _latest(train: pd.DataFrame, budget: float) -> pd.DataFrame:
    return train.iloc[len(train) - int(np.ceil(len(train) * budget)) :]


def _ar_error(train: pd.DataFrame, test: pd.DataFrame, budget: float, lookback: float, alpha: float) -> float:
    y, lookback = _latest(train, budget)["y"].to_numpy(), int(lookback)
    if len(y) <= lookback:
        return float("inf")
    low, width = y.min(), (y.max() - y.min()) or 1.0
    scaled = (y - low) / width
    x, target = _windows(scaled, lookback)
    with np.errstate(over="ignore", invalid="ignore"):
        return _rmse(_recurse(ridge(x, target, alpha), scaled[-lookback:], len(test)) * width + low - test["y"].to_numpy())


def _seasonal_error(train: pd.DataFrame, test: pd.DataFrame, budget: float, alpha: float, **orders: float) -> float:
    train = _latest(train, budget)
    keep, at = [0, 1], 2
    for name, _, order in SEASONS:
        keep += range(at, at + 2 * int(orders[name]))
        at += 2 * order
    a, b = (np.array(d["x"].tolist(), np.float64)[:, keep] for d in (train, test))
    y = train["y"].to_numpy()
    scale = float(np.std(y)) or 1.0
    return _rmse(b @ ridge(a, y / scale, alpha) * scale - test["y"].to_numpy())


def _gbt_error(train: pd.DataFrame, test: pd.DataFrame, budget: float, trees: float, depth: float, rate: float) -> float:
    x = np.array(train["x"].tolist(), np.float64)
    whole = ~np.isnan(x).any(axis=1)
    if whole.sum() < 2:
        return float("inf")
    made = grow(x[whole], train["y"].to_numpy()[whole], max(1, int(np.ceil(trees * budget))), int(depth), rate)
    calendar = np.array(test["x"].tolist(), np.float64)[:, -len(FORECAST_CALENDAR) :]
    return _rmse(np.array(feed_back(made, train["y"].tolist(), calendar)) - test["y"].to_numpy())


def _repeat_error(train: pd.DataFrame, test: pd.DataFrame, budget: float, period: float) -> float:
    y, period = train["y"].to_numpy(), int(period)  # nothing is fitted, so there is no budget
    if len(y) < period:
        return float("inf")
    return _rmse(y[len(y) - period + np.arange(len(test)) % period] - test["y"].to_numpy())


def _seasonal_frame(days: DataFrame) -> DataFrame:
    return _seasonal_design(with_span(days), None)


def _gbt_frame(days: DataFrame) -> DataFrame:
    return forecast_features(days).withColumn("x", F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))) for c in GBT_FEATURES]))


MODELS = {
    "ar": Model((Setting("lookback", 7, 90), Setting("alpha", 1e-3, 1e3, False)), _ar_error),
    "seasonal": Model((Setting("alpha", 1e-3, 1e3, False), *(Setting(name, 0, order) for name, _, order in SEASONS)), _seasonal_error, _seasonal_frame),
    "gbt": Model((Setting("trees", 100, 2000), Setting("depth", 3, 8), Setting("rate", 0.01, 0.3, False)), _gbt_error, _gbt_frame),
    "repeat": Model((Setting("period", 1, 60),), _repeat_error),
}

TRIALS = "series_id string, model string, round int, trial int, u array<double>"
SCORED = "series_id string, model string, round int, trial int, u array<double>, rmse double"


def _rng(*parts) -> np.random.Generator:
    return np.random.default_rng(zlib.crc32("|".join(map(str, parts)).encode()))


def _density(points: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Mean of normal kernels around ``points``, with a floor so that empty regions stay possible."""
    width = max(0.08, 0.5 * len(points) ** -0.3)
    away = (at[:, None, :] - points[None, :, :]) / width
    return np.exp(-0.5 * (away * away).sum(axis=2)).mean(axis=1) / width ** points.shape[1] + 0.05


def propose(tried: np.ndarray, errors: np.ndarray, n: int, rng: np.random.Generator) -> np.ndarray:
    """``n`` points of the unit cube where good trials (the best third) are dense in comparison with the others."""
    order = np.argsort(errors, kind="stable")
    good, bad = np.split(tried[order], [max(1, len(order) // KEEP)])
    drawn = good[rng.integers(0, len(good), 24 * n)] + rng.normal(0, 0.15, (24 * n, tried.shape[1]))
    drawn = np.abs(drawn)  # reflected at both ends
    drawn = np.clip(np.where(drawn > 1, 2 - drawn, drawn), 0, 1)
    ratio = _density(good, drawn) / (_density(bad, drawn) if len(bad) else 1.0)
    return drawn[np.argsort(-ratio, kind="stable")[:n]]


def _start(series: DataFrame, models: Sequence[str], trials: int, seed: int, given: dict[str, Sequence[dict]]) -> DataFrame:
    def draw(batches):
        for pdf in batches:
            rows = []
            for sid in pdf["series_id"]:
                for model in models:
                    space = MODELS[model].settings
                    if model in given:
                        points = [[s.place(asked[s.name]) for s in space] for asked in given[model]]
                    else:
                        points = _rng(seed, sid, model).random((trials, len(space))).tolist()
                    rows += [(sid, model, 0, i, u) for i, u in enumerate(points)]
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in TRIALS.split(", ")])

    return series.select("series_id").distinct().mapInPandas(draw, TRIALS)


def _next(scored: DataFrame, trials: int, seed: int) -> DataFrame:
    def draw(key, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("trial")
        made = propose(np.array(pdf["u"].tolist()), pdf["rmse"].to_numpy(), trials, _rng(seed, *key, int(pdf["round"].max()) + 1))
        first = int(pdf["trial"].max()) + 1
        return pd.DataFrame({"series_id": key[0], "model": key[1], "round": int(pdf["round"].max()) + 1, "trial": first + np.arange(len(made)), "u": made.tolist()})

    return scored.groupBy("series_id", "model").applyInPandas(draw, TRIALS)


def _judge(days: DataFrame, trials: DataFrame, budget: float, lanes: int) -> DataFrame:
    """Errors of all trials. A group holds one series and some of a model's trials, so a series travels at most ``lanes`` times per model."""

    def run(key, pdf: pd.DataFrame, todo: pd.DataFrame) -> pd.DataFrame:
        pdf, model = pdf.sort_values("ds"), MODELS[key[1]]
        train, test = pdf[pdf["part"] == "train"], pdf[pdf["part"] == "test"]
        todo = todo.sort_values("trial", ignore_index=True)
        todo["rmse"] = [model.error(train, test, budget, **model.values(u)) if len(train) and len(test) else float("inf") for u in todo["u"]]
        return todo[[c.split()[0] for c in SCORED.split(", ")]]

    tasks = 4 * int(days.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    lane = F.pmod(F.col("trial"), F.lit(lanes)).cast("int")
    todo = trials.withColumn("lane", lane)
    used = todo.select(F.col("series_id").alias("_s"), F.col("model").alias("_m"), F.col("lane").alias("at")).distinct()
    rows = days.join(used, (F.col("series_id") == F.col("_s")) & (F.col("model") == F.col("_m"))).drop("_s", "_m")
    # both sides of the cogroup share a table, so their keys have names of their own
    keys, own = ["series_id", "model", "at"], ["series_id", "model", "lane"]
    # fitting is long and rows are few: the number of tasks is given, so that they are not put together
    return rows.repartition(tasks, *keys).groupBy(*keys).cogroup(todo.repartition(tasks, *own).groupBy(*own)).applyInPandas(run, SCORED)


def search(
    series: DataFrame, models: Sequence[str] = ("ar", "seasonal", "gbt"), trials: int = 27, rounds: int = 2, train_share: float = 0.8, seed: int = 42,
    given: dict[str, Sequence[dict]] | None = None, lanes: int = 8,
) -> DataFrame:
    """Every trial at every rung that it reached: series_id, model, round, trial, rung, budget, rmse, kept, best, setting.

    ``kept`` marks trials that went on (or, at the last rung, all); ``best`` the one with the least error at the full budget, the first of
    equals. ``given`` lists the settings of the first round of a model instead of drawing them.
    """
    known = series.filter("y IS NOT NULL").select("series_id", "ds", F.col("y").cast("double").alias("y"))
    days = stage(split_by_time(known, train_share).select("series_id", "ds", "y", "part"), "days")
    frames = []
    for name in models:
        framed = MODELS[name].frame(days) if MODELS[name].frame else days.withColumn("x", F.array().cast("array<double>"))
        frames.append(framed.select("series_id", F.lit(name).alias("model"), "ds", "y", "part", "x"))
    frames = stage(union_all(*frames), "frames")
    results, racing = [], stage(_start(days, models, trials, seed, given or {}), "trials")
    for r in range(rounds):
        first = None
        # a third goes on each time, so a round has as many rungs as the largest field allows
        field = max([trials, *(len(g) for g in (given or {}).values())]) if r == 0 else trials
        rungs = 1
        while KEEP**rungs <= field:
            rungs += 1
        for rung in range(rungs):
            budget = float(KEEP) ** (rung - rungs + 1)
            scored = stage(_judge(frames, racing, budget, lanes), "scored")
            by = W.partitionBy("series_id", "model").orderBy("rmse", "trial")  # one row per trial
            size = F.count(F.lit(1)).over(W.partitionBy("series_id", "model"))
            last = rung == rungs - 1
            kept = F.lit(1) if last else (F.row_number().over(by) <= F.ceil(size / KEEP)).cast("int")
            scored = stage(scored.withColumns({"rung": F.lit(rung), "budget": F.lit(budget), "kept": kept, "last": F.lit(last)}), "rung")
            results.append(scored)
            first = first or scored
            racing = scored.filter("kept = 1").select("series_id", "model", "round", "trial", "u")
        if r < rounds - 1:
            racing = stage(_next(first, trials, seed), "trials")
    every = union_all(*results)
    order = F.row_number().over(W.partitionBy("series_id", "model", "last").orderBy("rmse", "trial"))
    setting = F.lit(None).cast("map<string,double>")
    for name in models:
        space = MODELS[name].settings
        parts = []
        for i, s in enumerate(space):
            u = F.col("u")[i]
            whole = F.least(F.floor(F.lit(float(s.low)) + u * F.lit(float(s.high - s.low + 1))).cast("double"), F.lit(float(s.high)))
            parts += [F.lit(s.name), whole if s.whole else F.lit(float(s.low)) * F.pow(F.lit(s.high / s.low), u)]
        setting = F.when(F.col("model") == name, F.create_map(*parts)).otherwise(setting)
    best = (F.col("last") & (order == 1)).cast("int")
    return every.select("series_id", "model", "round", "trial", "rung", "budget", "rmse", "kept", best.alias("best"), setting.alias("setting"))
