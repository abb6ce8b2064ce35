"""Rolling-origin backtests, and forecast bounds taken from their errors.

A backtest cuts every series at several days, fits each model on what lies before a cut and compares its forecast with what follows.
All cuts are series of their own in one job. The bounds of a forecast are then quantiles of those errors (split conformal
prediction): of n errors of a model at about the same step, the ceil((n + 1) level)-th smallest absolute one. They hold the asked share of
days if errors of coming days are like those of the backtest, whatever their distribution.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from brightloom.operators.forecast_frames import HORIZON
from brightloom.staging import stage
from brightloom.unions import union_all

LEVELS = (0.8, 0.9, 0.95)
#: (days of many series, rows of (series_id, horizon)) -> rows of (series_id, model, ds, yhat)
Forecaster = Callable[[DataFrame, DataFrame], DataFrame]


def cut_offs(series: DataFrame, cuts: int, horizon: int) -> DataFrame:
    """(series_id, cut, cut_ds): the last days of ``cuts`` training parts; ``horizon`` days apart, the last (0) ``horizon`` days before the end."""
    ends = series.groupBy("series_id").agg(F.max("ds").alias("end"))
    numbered = ends.select("series_id", "end", F.explode(F.sequence(F.lit(0), F.lit(cuts - 1))).alias("cut"))
    return numbered.select("series_id", "cut", F.date_sub("end", (F.col("cut") + 1) * horizon).alias("cut_ds"))


def rolling_origin(series: DataFrame, forecasters: Sequence[Forecaster], cuts: int = 6, horizon: int = HORIZON) -> DataFrame:
    """(series_id, model, cut, step, ds, y, yhat): days that follow each cut and have a value, with the forecasts made at the cut.

    Series that a cut leaves without days, or with too few for a model, have no rows of it. ``step`` counts calendar days from the cut.
    """
    series = stage(series.select("series_id", "ds", "y"), "series")
    at = stage(cut_offs(series, cuts, horizon), "cuts")
    known = series.join(at, "series_id").filter("ds <= cut_ds")
    # names of the cut series: the number of the cut, a colon, and the whole name
    named = stage(known.select(F.concat(F.col("cut").cast("string"), F.lit(":"), "series_id").alias("series_id"), "ds", "y"), "cut-series")
    # a series may have no value on the day of the cut; its forecast still reaches ``horizon`` days beyond it
    end = F.date_add(F.max("cut_ds"), horizon)
    ahead = known.groupBy("cut", "series_id").agg(F.datediff(end, F.max("ds")).alias("horizon"))
    ahead = stage(ahead.select(F.concat(F.col("cut").cast("string"), F.lit(":"), "series_id").alias("series_id"), "horizon"), "horizons")
    made = union_all(*[f(named, ahead).select("series_id", "model", "ds", "yhat") for f in forecasters])
    back = made.select(
        F.substring_index("series_id", ":", 1).cast("int").alias("cut"), F.expr("substring(series_id, instr(series_id, ':') + 1)").alias("series_id"), "model", "ds", "yhat")
    judged = back.join(at, ["series_id", "cut"]).withColumn("step", F.datediff("ds", "cut_ds")).filter(F.col("step").between(1, horizon))
    return judged.join(series.filter("y IS NOT NULL"), ["series_id", "ds"]).select("series_id", "model", "cut", "step", "ds", "y", "yhat")


def step_band(step: Column, days: int) -> Column:
    """Steps are put together ``days`` at a time: errors grow slowly with the step, and one step alone has one error per cut."""
    return F.floor((step - 1) / F.lit(days)).cast("int")


def conformal_widths(errors: DataFrame, levels: Sequence[float] = LEVELS, days: int = 15) -> DataFrame:
    """(series_id, model, band, level, n, width) from rows of ``rolling_origin``; the largest error where there are too few for the level.

    A group holds at most (cuts x days) errors.
    """
    banded = errors.withColumn("band", step_band(F.col("step"), days))
    groups = banded.groupBy("series_id", "model", "band").agg(F.sort_array(F.collect_list(F.abs(F.col("y") - F.col("yhat")))).alias("off"))
    each = groups.select("*", F.explode(F.array(*[F.lit(float(v)) for v in levels])).alias("level"), F.size("off").cast("long").alias("n"))
    place = F.least(F.ceil(F.round((F.col("n") + 1) * F.col("level"), 9)), F.col("n")).cast("int")
    return each.select("series_id", "model", "band", "level", "n", F.element_at("off", place).alias("width"))


def with_bounds(forecasts: DataFrame, widths: DataFrame, days: int = 15) -> DataFrame:
    """Rows of (series_id, model, step, yhat, ...) with ``lower`` and ``upper`` for each level. Steps beyond the backtest take its last band."""
    last = widths.groupBy("series_id", "model").agg(F.max("band").alias("last"))
    placed = forecasts.drop("lower", "upper").join(last, ["series_id", "model"]).withColumn("band", F.least(step_band(F.col("step"), days), F.col("last"))).drop("last")
    both = placed.join(widths.select("series_id", "model", "band", "level", "width"), ["series_id", "model", "band"])
    return both.withColumns({"lower": F.col("yhat") - F.col("width"), "upper": F.col("yhat") + F.col("width")}).drop("width", "band")


def coverage(judged: DataFrame) -> DataFrame:
    """(series_id, model, level, n_days, coverage, mean_width, r2) of rows with y, yhat and bounds."""
    off = F.col("y") - F.col("yhat")
    inside = F.col("y").between(F.col("lower"), F.col("upper")).cast("double")
    return judged.groupBy("series_id", "model", "level").agg(
        F.count(F.lit(1)).alias("n_days"), F.avg(inside).alias("coverage"), F.avg(F.col("upper") - F.col("lower")).alias("mean_width"),
        (1 - F.try_divide(F.sum(off * off), F.var_pop("y") * F.count("y"))).alias("r2"))


def backtest(series: DataFrame, forecasters: Sequence[Forecaster], cuts: int = 6, horizon: int = HORIZON, levels: Sequence[float] = LEVELS, days: int = 15) -> tuple[DataFrame, DataFrame]:
    """(widths from all cuts but the latest, coverage of the bounds that they give for the latest cut, which they have not seen)."""
    errors = stage(rolling_origin(series, forecasters, cuts, horizon), "errors")
    widths = stage(conformal_widths(errors.filter("cut > 0"), levels, days), "widths")
    return widths, coverage(with_bounds(errors.filter("cut = 0"), widths, days))


def repeat_forecast(period: int, model: str = "repeat") -> Forecaster:
    """The last ``period`` rows over and over."""

    def made(series: DataFrame, horizon: DataFrame) -> DataFrame:
        back = F.row_number().over(W.partitionBy("series_id").orderBy(F.desc("ds")))
        tail = series.withColumns({"back": back, "end": F.max("ds").over(W.partitionBy("series_id"))}).filter(F.col("back") <= period)
        tail = tail.join(horizon, "series_id").withColumn("first", F.lit(period) - F.col("back") + 1).filter("first <= horizon")
        steps = F.explode(F.sequence(F.col("first").cast("int"), F.col("horizon").cast("int"), F.lit(period)))
        return tail.select("series_id", "end", "y", steps.alias("step")).select(
            "series_id", F.lit(model).alias("model"), F.expr("date_add(end, step)").alias("ds"), F.col("y").alias("yhat"))

    return made

