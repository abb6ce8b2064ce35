"""Boosted regression trees of daily series, one model for each series.

A series is one row a day, so its training table is bounded by the calendar and is grown in one task; many series run side by side. Every
feature is cut into bins once; a level of a tree is then two histograms (gradients and counts) over (node, feature, bin) and one running
sum over bins. Forecasts feed each day back: the next day's lags and moving statistics are taken from the days forecast before it.
A model is a row of a table, like those of the other forecasters.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window as W, functions as F

from brightloom.functions.calendar import FORECAST_CALENDAR, forecast_calendar
from brightloom.operators.forecast_frames import HORIZON, LAGS, WINDOWS, Z, forecast_features, with_horizon

_MOVING = [f"rolling_{s}_{w}" for w in WINDOWS for s in ("mean", "std", "min", "max")]
GBT_FEATURES = [*(f"lag_{k}" for k in LAGS), *_MOVING, *FORECAST_CALENDAR]
GBT_MODEL = (
    "series_id string, base double, depth int, feature array<int>, number array<double>, gain array<double>, recent array<double>, "
    "last_ds date, trees int"
)
BINS = 64


def bin_edges(column: np.ndarray, bins: int = BINS) -> np.ndarray:
    """Upper ends of the bins but the last: halfway between neighbouring values, at quantiles if there are more values than bins."""
    values = np.unique(column)
    if len(values) > bins:
        picked = np.quantile(column, np.arange(1, bins) / bins)
        low = np.unique(np.clip(np.searchsorted(values, picked, side="right"), 1, len(values) - 1))
    else:
        low = np.arange(1, len(values))
    return (values[low - 1] + values[low]) / 2


class Trees:
    """Trees of one depth as arrays of (tree, node): children of node h are 2h+1 and 2h+2; ``feature`` is -1 at leaves.

    ``number`` holds the threshold of inner nodes (rows above it go right) and the value of leaves.
    """

    def __init__(self, base: float, depth: int, feature: np.ndarray, number: np.ndarray, gain: np.ndarray):
        self.base, self.depth, self.gain = base, depth, gain
        self.feature, self.number = feature.reshape(-1, 2 ** (depth + 1) - 1), number.reshape(-1, 2 ** (depth + 1) - 1)

    def predict(self, row: np.ndarray) -> float:
        """All trees go down together, one level at a time."""
        tree, at = np.arange(len(self.feature)), np.zeros(len(self.feature), np.int64)
        for _ in range(self.depth):
            f = self.feature[tree, at]
            at = np.where(f >= 0, 2 * at + 1 + (row[f] > self.number[tree, at]), at)
        return self.base + float(self.number[tree, at].sum())


def grow(x: np.ndarray, y: np.ndarray, trees: int, depth: int, rate: float, shrink: float = 1.0, least: int = 1, bins: int = BINS) -> Trees:
    """Least-squares boosting: each tree splits where G_l^2 / (n_l + shrink) + G_r^2 / (n_r + shrink) - G^2 / (n + shrink) is largest."""
    n, k = x.shape
    edges = [bin_edges(x[:, j], bins) for j in range(k)]
    width = max(2, 1 + max(map(len, edges)))
    cut = np.full((k, width), np.inf)
    for j, e in enumerate(edges):
        cut[j, : len(e)] = e
    binned = np.column_stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)])
    place = binned + np.arange(k) * width
    base, total = float(y.mean()), 2 ** (depth + 1) - 1
    feature, number, gain = np.full((trees, total), -1, np.int32), np.zeros((trees, total)), np.zeros(k)
    left = y - base
    for t in range(trees):
        node, open_ = np.zeros(n, np.int64), np.arange(n)
        for level in range(depth):
            first, nodes = 2**level - 1, 2**level
            own = node[open_] - first
            spot = (own[:, None] * (k * width) + place[open_]).ravel()
            size = nodes * k * width
            g = np.bincount(spot, weights=np.repeat(left[open_], k), minlength=size).reshape(nodes, k, width)
            h = np.bincount(spot, minlength=size).reshape(nodes, k, width)
            gl, hl = g.cumsum(axis=2), h.cumsum(axis=2)
            gt, ht = gl[:, :, -1:], hl[:, :, -1:]
            gr, hr = gt - gl, ht - hl
            better = gl * gl / (hl + shrink) + gr * gr / (hr + shrink) - gt * gt / (ht + shrink)
            better = np.where((hl >= least) & (hr >= least), better, 0.0).reshape(nodes, k * width)
            best = better.argmax(axis=1)
            most = better[np.arange(nodes), best]
            split = most > 1e-12
            if not split.any():
                break
            f, b = np.divmod(best, width)
            feature[t, first : first + nodes][split] = f[split]
            number[t, first : first + nodes][split] = cut[f, b][split]
            np.add.at(gain, f[split], most[split])
            open_ = open_[split[own]]
            own = node[open_] - first
            node[open_] = 2 * node[open_] + 1 + (binned[open_, f[own]] > b[own])
        there = np.bincount(node, minlength=total)
        value = rate * np.bincount(node, weights=left, minlength=total) / (there + shrink)
        leaf = feature[t] < 0
        number[t, leaf] = value[leaf]
        left = left - value[node]
    return Trees(base, depth, feature, number, gain)


def _moving(recent: np.ndarray) -> list[float]:
    """Lags and moving statistics of the day after ``recent``."""
    out = [recent[-k] for k in LAGS]
    for w in WINDOWS:
        frame = recent[-w:]
        out += [frame.mean(), frame.std(ddof=1), frame.min(), frame.max()]
    return out


def feed_back(model: Trees, known: Sequence[float], calendar: Sequence[Sequence[float]]) -> list[float]:
    """A value for each row of ``calendar``, one day after the other, each known to the days after it."""
    behind, known, n = max(*LAGS, *WINDOWS), list(known), len(known)
    for parts in calendar:
        known.append(model.predict(np.array([*_moving(np.array(known[-behind:])), *parts])))
    return known[n:]


def fit_gbt(series: DataFrame, trees: int = 1000, depth: int = 6, rate: float = 0.1, bins: int = BINS) -> DataFrame:
    """One model row per series that has more than 31 days with a value; days without one are left out."""
    days = series.filter("y IS NOT NULL").select("series_id", "ds", F.col("y").cast("double").alias("y"))
    # training is long and the rows are few, so small partitions must not be put together again: their number is given
    tasks = 4 * int(series.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    frame = forecast_features(days.repartition(tasks, "series_id"))
    behind = max(*LAGS, *WINDOWS)

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("ds")
        whole = pdf.dropna(subset=GBT_FEATURES)
        if len(whole) < 2:
            return pd.DataFrame(columns=[c.split()[0] for c in GBT_MODEL.split(", ")])
        made = grow(whole[GBT_FEATURES].to_numpy(np.float64), whole["y"].to_numpy(np.float64), trees, depth, rate, bins=bins)
        return pd.DataFrame([{
            "series_id": pdf["series_id"].iloc[0], "base": made.base, "depth": depth, "feature": made.feature.ravel().tolist(),
            "number": made.number.ravel().tolist(), "gain": made.gain.tolist(), "recent": pdf["y"].tolist()[-behind:], "last_ds": pdf["ds"].iloc[-1], "trees": trees,
        }])

    return frame.select("series_id", "ds", "y", *GBT_FEATURES).groupBy("series_id").applyInPandas(fit, GBT_MODEL)


def forecast_gbt(models: DataFrame, horizon: DataFrame | int = HORIZON, level: float = 0.95) -> DataFrame:
    """Feedback forecast of every model row; bounds are z times a tenth of the forecasts' deviation."""
    days = F.sequence(F.date_add("last_ds", 1), F.date_add("last_ds", F.col("horizon")))
    calendar = F.transform(days, lambda d: F.array(*[c.cast("double") for c in forecast_calendar(d).values()]))
    rows = with_horizon(models, horizon).filter("horizon > 0").withColumns({"days": days, "calendar": calendar})

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        m = pdf.iloc[0]
        model = Trees(m["base"], int(m["depth"]), np.asarray(m["feature"], np.int32), np.asarray(m["number"], np.float64), np.zeros(0))
        return pd.DataFrame({"series_id": m["series_id"], "ds": list(m["days"]), "yhat": feed_back(model, m["recent"], m["calendar"])})

    # a model is one row of about a megabyte; grouping gives a task one at a time
    made = rows.groupBy("series_id").applyInPandas(run, "series_id string, ds date, yhat double")
    half = F.lit(Z[level] * 0.1) * F.stddev_pop("yhat").over(W.partitionBy("series_id"))
    return made.withColumn("h", half).select(
        "series_id", F.lit("gbt").alias("model"), "ds", "yhat", (F.col("yhat") - F.col("h")).alias("lower"), (F.col("yhat") + F.col("h")).alias("upper")
    )


def gbt_importances(models: DataFrame, features: Sequence[str] = GBT_FEATURES) -> DataFrame:
    """(series_id, feature, importance): share of each feature in the gain of a model's splits; 0 if it has none."""
    names = F.array(*[F.lit(f) for f in features])
    total = F.aggregate("gain", F.lit(0.0), lambda s, v: s + v)
    each = models.select("series_id", total.alias("total"), F.explode(F.arrays_zip(names.alias("feature"), F.col("gain").alias("gain"))).alias("each"))
    return each.select("series_id", F.col("each.feature").alias("feature"), F.coalesce(F.try_divide(F.col("each.gain"), F.col("total")), F.lit(0.0)).alias("importance"))
