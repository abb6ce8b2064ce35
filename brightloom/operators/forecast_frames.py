"""Frames for forecasting many daily series at once: (series_id, ds, y).

A daily series has at most one row per calendar day, so windows and groups by ``series_id`` are bounded by
the length of the calendar, whatever the number of source rows; the rows are summed to days first, with
partial sums before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from brightloom.functions.calendar import forecast_calendar
from brightloom.unions import union_all

LOOKBACK = 60
HORIZON = 90
LAGS = (1, 7, 30)
WINDOWS = (7, 14, 30)
Z = {0.8: 1.2815515655446004, 0.9: 1.6448536269514722, 0.95: 1.96}  # fixed values
MODEL_COLUMNS = ["series_id", "model", "ds", "yhat", "lower", "upper"]


def by_day(*more: str):
    return W.partitionBy("series_id", *more).orderBy("ds")


def daily_series(df: DataFrame, series: Column, date: Column, value: Column, fill: float | None = None,
                 fill_gaps: bool = False) -> DataFrame:
    """Sum to one row per series and day; optionally add the missing days of each series with ``fill``."""
    days = df.groupBy(series.alias("series_id"), F.to_date(date).alias("ds")).agg(F.sum(value).alias("y"))
    days = days.filter(F.col("ds").isNotNull())
    if not fill_gaps:
        return days
    spans = days.groupBy("series_id").agg(F.min("ds").alias("a"), F.max("ds").alias("b"))
    calendar = spans.select("series_id", F.explode(F.sequence("a", "b")).alias("ds"))
    filled = calendar.join(days, ["series_id", "ds"], "left")
    return filled.withColumn("y", F.coalesce("y", F.lit(fill))) if fill is not None else filled


def split_by_time(series: DataFrame, train_share: float = 0.8) -> DataFrame:
    """Add ``position`` (1-based), ``size`` and ``part``: the first int(size * share) days train."""
    size = F.count(F.lit(1)).over(W.partitionBy("series_id"))
    numbered = series.withColumns({"position": F.row_number().over(by_day()).cast("long"), "size": size})
    train = F.col("position") <= F.floor(F.col("size") * F.lit(train_share))
    return numbered.withColumn("part", F.when(train, "train").otherwise("test"))


def tail(series: DataFrame, n: int) -> DataFrame:
    """Last ``n`` days of each series."""
    back = F.row_number().over(W.partitionBy("series_id").orderBy(F.desc("ds")))
    return series.withColumn("_back", back).filter(F.col("_back") <= n).drop("_back")


def sequences(series: DataFrame, length: int = LOOKBACK) -> DataFrame:
    """The previous ``length`` values of each day that has that many, as an array, with the day's value."""
    previous = F.collect_list("y").over(by_day().rowsBetween(-length, -1))
    return series.withColumn("history", previous).filter(F.size("history") == length)


def scaled_series(series: DataFrame) -> DataFrame:
    """Add ``y_low``, ``y_high`` and ``y_scaled`` in [0, 1] per series; a constant series scales to 0."""
    whole = W.partitionBy("series_id")
    s = series.withColumns({"y_low": F.min("y").over(whole), "y_high": F.max("y").over(whole)})
    width = F.col("y_high") - F.col("y_low")
    return s.withColumn("y_scaled", (F.col("y") - F.col("y_low")) / F.when(width == 0, 1.0).otherwise(width))


def unscale(scaled: Column, low: Column, high: Column) -> Column:
    width = high - low
    return scaled * F.when(width == 0, 1.0).otherwise(width) + low


def forecast_features(
    series: DataFrame, include_current: bool = False, lags: Sequence[int] = LAGS, windows: Sequence[int] = WINDOWS
) -> DataFrame:
    """Lags, full-window mean/std/min/max and calendar columns per series.

    With ``include_current=False`` a frame ends the day before, so the target day cannot leak.
    """
    made: dict[str, Column] = {f"lag_{k}": F.lag("y", k).over(by_day()) for k in lags}
    for w in windows:
        frame = by_day().rowsBetween(-(w - 1), 0) if include_current else by_day().rowsBetween(-w, -1)
        full = F.count("y").over(frame) == w
        for name, fn in (("mean", F.avg), ("std", F.stddev_samp), ("min", F.min), ("max", F.max)):
            made[f"rolling_{name}_{w}"] = F.when(full, fn("y").over(frame))
    return series.withColumns(made).withColumns(forecast_calendar("ds"))


def complete_rows(frame: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return frame.dropna(subset=list(columns) if columns else None)


def future_days(series: DataFrame, horizon: int = HORIZON) -> DataFrame:
    """The next ``horizon`` days of each series with their step number."""
    last = series.groupBy("series_id").agg(F.max("ds").alias("last_ds"))
    days = F.sequence(F.date_add("last_ds", 1), F.date_add("last_ds", horizon))
    return last.select("series_id", F.posexplode(days).alias("step", "ds")).withColumn("step", F.col("step") + 1)


def with_horizon(models: DataFrame, horizon: int | DataFrame) -> DataFrame:
    """Add ``horizon``: one number for all series, or (series_id, horizon) rows, a row per series."""
    if isinstance(horizon, DataFrame):
        return models.join(horizon.select("series_id", F.col("horizon").cast("int").alias("horizon")), "series_id")
    return models.withColumn("horizon", F.lit(int(horizon)))


def naive_forecast(series: DataFrame, lag: int, model: str) -> DataFrame:
    """Each day's forecast is the value ``lag`` rows earlier; bounds are 5 % around it."""
    y = F.lag("y", lag).over(by_day())
    return series.select("series_id", F.lit(model).alias("model"), "ds", y.alias("yhat")).filter(
        "yhat IS NOT NULL"
    ).withColumns({"lower": F.col("yhat") * 0.95, "upper": F.col("yhat") * 1.05})


def history_plus(series: DataFrame, forecast: DataFrame) -> DataFrame:
    """History followed by forecast days, with a flag telling which is which."""
    past = series.select("series_id", "ds", "y", F.lit(0).alias("is_forecast"))
    return union_all(past, forecast.select("series_id", "ds", F.col("yhat").alias("y"), F.lit(1).alias("is_forecast")))


def accuracy(actual: DataFrame, forecast: DataFrame) -> DataFrame:
    """MAE, RMSE, MAPE %, R2 and interval coverage per (series, model). MAPE skips days with y = 0."""
    both = forecast.join(actual.select("series_id", "ds", "y"), ["series_id", "ds"])
    err = F.col("y") - F.col("yhat")
    inside = (F.col("y") >= F.col("lower")) & (F.col("y") <= F.col("upper"))
    return both.groupBy("series_id", "model").agg(
        F.avg(F.abs(err)).alias("mae"),
        F.sqrt(F.avg(err * err)).alias("rmse"),
        (F.avg(F.abs(F.try_divide(err, F.col("y")))) * 100).alias("mape"),
        (1 - F.try_divide(F.sum(err * err), F.var_pop("y") * F.count("y"))).alias("r2"),
        F.avg(inside.cast("double")).alias("coverage"),
        F.count(F.lit(1)).alias("n_days"),
    )


def inverse_rmse_weights(metrics: DataFrame) -> DataFrame:
    """(series_id, model, weight): (1/rmse) over the sum of 1/rmse; models without error share everything."""
    whole = W.partitionBy("series_id")  # one row per model
    perfect = F.when(F.col("rmse") == 0, 1.0).otherwise(0.0)
    inverse = F.coalesce(F.try_divide(F.lit(1.0), F.col("rmse")), F.lit(0.0))
    n_perfect = F.sum(perfect).over(whole)
    weight = F.when(n_perfect > 0, perfect / F.when(n_perfect > 0, n_perfect).otherwise(1.0)).otherwise(
        F.try_divide(inverse, F.sum(inverse).over(whole))
    )
    return metrics.select("series_id", "model", weight.alias("weight"))


def blend(forecasts: DataFrame, weights: DataFrame, renormalise: bool = False) -> DataFrame:
    """Weighted sum of the models' forecasts and bounds per (series, day).

    A model without a weight, or without a forecast for the day, is left out; its weight is not given to
    the others unless ``renormalise``.
    """
    rows = forecasts.join(weights, ["series_id", "model"])
    total = F.sum("weight") if renormalise else F.lit(1.0)
    return rows.groupBy("series_id", "ds").agg(
        *[F.try_divide(F.sum(F.col("weight") * F.col(c)), total).alias(c) for c in ("yhat", "lower", "upper")],
        F.count(F.lit(1)).alias("n_models"),
    )


def forecast_table(blended: DataFrame) -> DataFrame:
    """Published form: date, predicted_sales, lower_bound, upper_bound per series."""
    return blended.select(
        "series_id", F.col("ds").alias("date"), F.col("yhat").alias("predicted_sales"),
        F.col("lower").alias("lower_bound"), F.col("upper").alias("upper_bound"),
    )


def with_levels(forecast: DataFrame, levels: Sequence[float] = (0.8, 0.9, 0.95)) -> DataFrame:
    """Bounds at further levels, from the 95 % half-widths."""
    out = forecast
    for level in levels:
        ratio, tag = Z[level] / Z[0.95], f"{round(level * 100)}"
        out = out.withColumns(
            {
                f"lower_{tag}": F.col("yhat") - (F.col("yhat") - F.col("lower")) * ratio,
                f"upper_{tag}": F.col("yhat") + (F.col("upper") - F.col("yhat")) * ratio,
            }
        )
    return out
