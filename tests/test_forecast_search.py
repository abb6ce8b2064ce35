import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from brightloom.operators import backtest as bt, forecast_frames as ff, forecast_models as fm, forecast_search as fs


def frame(spark, values, start="2021-01-01", name="s"):
    days = pd.date_range(start, periods=len(values)).date
    return spark.createDataFrame([(name, d, None if v is None else float(v)) for d, v in zip(days, values)], "series_id string, ds date, y double")


# --- search ----------------------------------------------------------------------------------------


def test_settings_cover_their_range():
    whole, real = fs.Setting("a", 3, 5), fs.Setting("b", 0.01, 100, False)
    assert {whole.value(u) for u in np.linspace(0, 1, 50)} == {3, 4, 5}
    assert real.value(0) == pytest.approx(0.01) and real.value(1) == pytest.approx(100)
    assert [whole.value(whole.place(v)) for v in (3, 4, 5)] == [3, 4, 5] and real.value(real.place(7.5)) == pytest.approx(7.5)


def test_proposals_go_where_errors_are_small():
    rng = np.random.default_rng(5)
    tried = rng.random((27, 2))
    made = fs.propose(tried, ((tried - [0.2, 0.7]) ** 2).sum(axis=1), 50, rng)
    assert made.shape == (50, 2) and (made >= 0).all() and (made <= 1).all()
    assert np.abs(made - [0.2, 0.7]).mean() < 0.75 * np.abs(rng.random((500, 2)) - [0.2, 0.7]).mean()


def test_races_halve_and_repeat(spark):
    rng = np.random.default_rng(2)
    y = 100 + 20 * np.sin(2 * np.pi * np.arange(300) / 7) + rng.normal(size=300)
    df = fm.union_all(frame(spark, y, name="week"), frame(spark, y[:40], name="short"), frame(spark, [1.0], name="one"))
    done = fs.search(df, trials=9).toPandas()
    again = fs.search(df, trials=9).toPandas()
    order = ["series_id", "model", "rung", "trial"]
    cols = [*order, "rmse", "kept", "best"]
    pd.testing.assert_frame_equal(done.sort_values(order)[cols].reset_index(drop=True), again.sort_values(order)[cols].reset_index(drop=True))
    for (_, model), part in done.groupby(["series_id", "model"]):
        assert part.groupby(["round", "rung"]).size().tolist() == [9, 3, 1, 9, 3, 1] and part["best"].sum() == 1
        for _, rung in part[part["rung"] < 2].groupby(["round", "rung"]):
            assert rung[rung["kept"] == 1]["rmse"].max() <= rung[rung["kept"] == 0]["rmse"].min()
        assert sorted(part["trial"].unique()) == list(range(18))
    assert (done[done["series_id"] == "one"]["rmse"] == np.inf).all()
    week = done[(done["series_id"] == "week") & (done["best"] == 1)].set_index("model")["rmse"]
    assert (week < 6).all()


def test_errors_are_those_of_the_library_models(spark):
    rng = np.random.default_rng(3)
    df = frame(spark, 50 + np.arange(260) * 0.1 + 5 * np.sin(np.arange(260) / 3) + rng.normal(size=260))
    given = {"ar": [{"lookback": 14, "alpha": 2.0}], "gbt": [{"trees": 100, "depth": 3, "rate": 0.1}], "seasonal": [{"alpha": 1.0, "weekly": 3, "yearly": 10, "monthly": 5, "quarterly": 8}]}
    done = {r["model"]: r["rmse"] for r in fs.search(df, trials=1, rounds=1, given=given).collect()}
    split = ff.split_by_time(df)
    train, test = (split.filter(F.col("part") == p).select("series_id", "ds", "y") for p in ("train", "test"))
    ahead = fm.holdout_horizon(train, test)
    made = fm.union_all(fm.forecast_ar(fm.fit_ar(train, 14, 2.0), ahead), fm.forecast_gbt(fm.fit_gbt(train, 100, 3), ahead))
    want = {r["model"]: r["rmse"] for r in ff.accuracy(test, made).collect()}
    assert done["ar"] == pytest.approx(want["ar"]) and done["gbt"] == pytest.approx(want["gbt"]) and np.isfinite(done["seasonal"])


# --- breaks of the trend ----------------------------------------------------------------------------


@pytest.mark.parametrize("at, slopes", [([730], (0.2, -0.5)), ([300, 900], (0.0, 0.6, -0.2)), ([], (0.3,))])
def test_planted_breaks_are_found(spark, at, slopes):
    day, rng = np.arange(1461 + 60), np.random.default_rng(7)
    trend = slopes[0] * day + sum((b - a) * np.maximum(0, day - d) for d, a, b in zip(at, slopes, slopes[1:]))
    y = 500 + trend + 20 * np.sin(2 * np.pi * day / 7) + 15 * np.sin(2 * np.pi * day / 365.25)
    df = frame(spark, (y + rng.normal(0, 5, len(day)))[:1461])
    models = fm.fit_seasonal(df).cache()
    row = models.first()
    assert len(row.breaks) == len(at) and all(abs(a - b) <= 8 for a, b in zip(row.breaks, at))
    made = fm.forecast_seasonal(models, 60).orderBy("ds").toPandas()["yhat"].to_numpy()
    assert np.abs(made - y[1461:]).mean() < 5
    straight = fm.fit_seasonal(df, candidates=0).first()
    assert straight.breaks == [] and (not at or straight.sigma > 1.5 * row.sigma)


def test_short_and_constant_series_have_no_breaks(spark):
    both = fm.union_all(frame(spark, [3.0] * 500, name="flat"), frame(spark, [1.0, 2.0, None, 4.0], name="few"))
    rows = {r.series_id: r for r in fm.fit_seasonal(both).collect()}
    assert rows["flat"].breaks == [] and rows["few"].breaks == []


# --- backtests --------------------------------------------------------------------------------------


def test_cuts_see_nothing_of_what_follows(spark):
    y = np.arange(200, dtype=float)
    errors = bt.rolling_origin(fm.union_all(frame(spark, y, name="a:b"), frame(spark, y[:25], name="c")), [bt.repeat_forecast(1)], cuts=3, horizon=20).toPandas()
    assert set(errors["series_id"]) == {"a:b", "c"} and set(errors[errors["series_id"] == "c"]["cut"]) == {0}
    assert len(errors[errors["series_id"] == "a:b"]) == 60 and (errors["y"] - errors["yhat"] == errors["step"]).all()


def test_widths_are_exact_quantiles(spark):
    rng = np.random.default_rng(4)
    rows = [("s", "m", c, s, float(rng.normal()), 0.0) for c in range(5) for s in range(1, 31)]
    errors = spark.createDataFrame(rows, "series_id string, model string, cut int, step int, y double, yhat double")
    got = {(r.band, r.level): (r.n, r.width) for r in bt.conformal_widths(errors).collect()}
    for band in (0, 1):
        off = sorted(abs(r[4]) for r in rows if (r[3] - 1) // 15 == band)
        for level in bt.LEVELS:
            assert got[band, level] == (75, off[min(75, int(np.ceil(76 * level - 1e-9))) - 1])
    few = bt.conformal_widths(errors.filter("cut = 0 AND step < 4")).collect()
    assert all(r.width == max(abs(x[4]) for x in rows if x[2] == 0 and x[3] < 4) for r in few)


def test_bounds_cover_the_asked_share(spark):
    rng = np.random.default_rng(6)
    y = 10 + rng.standard_t(3, size=1500)
    df = fm.union_all(*[frame(spark, 10 + rng.standard_t(3, size=1500), name=f"s{i}") for i in range(4)], frame(spark, y, name="s9"))
    widths, judged = bt.backtest(df, [lambda s, h: fm.forecast_ar(fm.fit_ar(s), h)], cuts=8)
    share = judged.groupBy("level").agg((F.sum(F.col("coverage") * F.col("n_days")) / F.sum("n_days")).alias("share")).collect()
    assert len(share) == 3 and all(abs(r["share"] - r["level"]) < 0.06 for r in share)
    assert widths.filter("width <= 0").count() == 0
