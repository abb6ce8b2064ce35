import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from brightloom.operators import boosting as bo, forecast_frames as ff, forecast_models as fm
from brightloom.sources.generators import synthetic_series


@pytest.fixture(scope="module")
def series(spark):
    from brightloom.staging import stage

    return stage(synthetic_series(spark.range(2), "id"), "series")


def holdout(series, days=30):
    cut = ff.split_by_time(series).withColumn("back", F.col("size") - F.col("position"))
    return cut.filter(F.col("back") >= days).select("series_id", "ds", "y"), cut.filter(F.col("back") < days).select("series_id", "ds", "y")


def rmse(test, forecast):
    return ff.accuracy(test, forecast).agg(F.avg("rmse")).first()[0]


def test_generated_series_follow_the_trend(series):
    pdf = series.filter("series_id = '0'").orderBy("ds").toPandas()
    assert len(pdf) == 1461 and abs(pdf["y"].mean() - 1250) < 20


@pytest.mark.parametrize("model", ["ar", "seasonal"])
def test_models_beat_the_value_of_a_week_ago(spark, series, model):
    train, test = holdout(series)
    last_week = ff.tail(train, 7).select("series_id", (F.dayofyear("ds") % 7).alias("d"), F.col("y").alias("yhat"))
    naive = test.select("series_id", "ds", (F.dayofyear("ds") % 7).alias("d")).join(last_week, ["series_id", "d"]).select(
        "series_id", F.lit("naive").alias("model"), "ds", "yhat", F.col("yhat").alias("lower"), F.col("yhat").alias("upper"))
    made = fm.forecast_ar(fm.fit_ar(train), 30) if model == "ar" else fm.forecast_seasonal(fm.fit_seasonal(train), 30)
    assert rmse(test, made) < rmse(test, naive)
    assert made.filter("lower >= yhat OR upper <= yhat").count() == 0
    assert made.groupBy("series_id").count().filter("count <> 30").count() == 0


def naive_trees(x, y, trees, depth, rate):
    """Boosting by trying every threshold between neighbouring values of every feature."""
    left, out = y - y.mean(), []

    def tree(rows, deep):
        best = (1e-12, None, None)
        for j in range(x.shape[1]):
            values = np.unique(x[rows, j])
            for cut in (values[:-1] + values[1:]) / 2:
                a, b = rows[x[rows, j] <= cut], rows[x[rows, j] > cut]
                gain = sum(left[r].sum() ** 2 / (len(r) + 1) * s for r, s in ((a, 1), (b, 1), (rows, -1)))
                best = max(best, (gain, j, cut), key=lambda g: g[0])
        if deep == 0 or best[1] is None:
            return float(rate * left[rows].sum() / (len(rows) + 1))
        side = x[rows, best[1]] <= best[2]
        return best[1], best[2], tree(rows[side], deep - 1), tree(rows[~side], deep - 1)

    def value(node, row):
        while isinstance(node, tuple):
            node = node[2] if row[node[0]] <= node[1] else node[3]
        return node

    for _ in range(trees):
        out.append(tree(np.arange(len(y)), depth))
        left = left - np.array([value(out[-1], row) for row in x])
    return lambda row: y.mean() + sum(value(t, row) for t in out)


def test_trees_equal_exhaustive_search():
    rng = np.random.default_rng(3)
    x = rng.integers(0, 12, (70, 4)).astype(float)
    y = x[:, 0] * 2 + (x[:, 1] > 5) * 7 + rng.normal(size=70)
    made, want = bo.grow(x, y, 8, 3, 0.3), naive_trees(x, y, 8, 3, 0.3)
    for row in np.vstack([x[:20], rng.uniform(-1, 13, (20, 4)).round(2) + 0.003]):
        assert made.predict(row) == pytest.approx(want(row), abs=1e-9)


def test_bins_of_many_values_lie_at_quantiles():
    column = np.r_[np.random.default_rng(1).normal(size=5000), [0.25] * 3000]
    edges = bo.bin_edges(column, 16)
    counts = np.bincount(np.searchsorted(edges, column), minlength=len(edges) + 1)
    assert len(edges) <= 15 and (np.delete(counts, np.searchsorted(edges, 0.25)) <= 1000).all() and counts[np.searchsorted(edges, 0.25)] >= 3000


def test_trees_feed_forecasts_back(spark, series):
    train, test = holdout(series)
    models = bo.fit_gbt(train, trees=60, depth=4).cache()
    made = bo.forecast_gbt(models, 30)
    assert made.count() == 60 and rmse(test, made) < 120
    shares = bo.gbt_importances(models).groupBy("series_id").agg(F.sum("importance"), F.count("*")).collect()
    assert all(abs(r[1] - 1) < 1e-9 and r[2] == len(bo.GBT_FEATURES) for r in shares)
    # the second day is forecast from the first: a model that repeats the last value by lag_1 alone stays on it
    first = made.filter("series_id = '0'").orderBy("ds").toPandas()["yhat"]
    known = train.filter("series_id = '0'").orderBy("ds").toPandas()
    m = models.filter("series_id = '0'").first()
    trees = bo.Trees(m.base, m.depth, np.array(m.feature), np.array(m.number), np.zeros(0))
    longer = spark.createDataFrame([("0", d, float(v)) for d, v in zip([*known["ds"], *pd.date_range(known["ds"].iloc[-1] + pd.Timedelta(days=1), periods=3).date], [*known["y"], *first[:2], 0.0])], "series_id string, ds date, y double")
    row = ff.forecast_features(longer).orderBy(F.desc("ds")).first()
    assert trees.predict(np.array([float(row[c]) for c in bo.GBT_FEATURES])) == pytest.approx(first[2])


def test_short_series_give_no_model(spark):
    df = spark.createDataFrame([("s", pd.Timestamp("2024-01-01").date(), 1.0)], "series_id string, ds date, y double")
    assert fm.fit_ar(df).count() == 0 and fm.fit_seasonal(df).count() == 1


def test_weights_and_blend(spark):
    m = spark.createDataFrame([("s", "a", 1.0), ("s", "b", 3.0), ("t", "a", 0.0), ("t", "b", 2.0)], "series_id string, model string, rmse double")
    w = {(r[0], r[1]): r[2] for r in ff.inverse_rmse_weights(m).collect()}
    assert w == {("s", "a"): 0.75, ("s", "b"): 0.25, ("t", "a"): 1.0, ("t", "b"): 0.0}
    day = pd.Timestamp("2024-01-01").date()
    f = spark.createDataFrame([("s", m_, day, 8.0, 7.0, 9.0) for m_ in ("a", "b")], "series_id string, model string, ds date, yhat double, lower double, upper double")
    same = ff.blend(f, ff.inverse_rmse_weights(m)).first()
    assert (same["yhat"], same["lower"], same["upper"]) == (8.0, 7.0, 9.0)
    one = f.filter("model = 'a'")
    assert ff.blend(one, ff.inverse_rmse_weights(m)).first()["yhat"] == 6.0
    assert ff.blend(one, ff.inverse_rmse_weights(m), renormalise=True).first()["yhat"] == 8.0


def test_union_below_a_broadcast_join_keeps_keys_together(spark, series):
    """Two branches partitioned alike, joined with a small table and grouped by the partition key."""
    both = fm.union_all(ff.naive_forecast(series, 7, "a"), ff.naive_forecast(series, 1, "b"))
    test = ff.split_by_time(series).filter("part = 'test'").select("series_id", "ds", "y")
    made = ff.blend(both, ff.inverse_rmse_weights(ff.accuracy(test, both))).collect()
    assert len(made) == len({(r["series_id"], r["ds"]) for r in made})


def test_saved_models_forecast_the_same(spark, series, tmp_path):
    models = fm.fit_ar(series)
    fm.save_models(models, str(tmp_path / "m"))
    a = fm.forecast_ar(models, 5).orderBy("series_id", "ds").toPandas()
    b = fm.forecast_ar(fm.load_models(spark, str(tmp_path / "m")), 5).orderBy("series_id", "ds").toPandas()
    np.testing.assert_allclose(a["yhat"], b["yhat"])


def test_features_do_not_see_the_target(spark, series):
    base = ff.forecast_features(series).orderBy("series_id", "ds").limit(200).toPandas()
    first = base[base["series_id"] == "0"].reset_index(drop=True)
    assert first["rolling_mean_7"][7] == pytest.approx(first["y"][:7].mean())
    assert np.isnan(first["rolling_mean_7"][6])
    now = ff.forecast_features(series, include_current=True).filter("series_id = '0'").orderBy("ds").limit(10).toPandas()
    assert now["rolling_mean_7"][6] == pytest.approx(first["y"][:7].mean())


def test_gaps_are_filled(spark):
    df = spark.createDataFrame([("s", "2024-01-01", 1.0), ("s", "2024-01-04", 2.0)], "s string, d string, v double")
    got = ff.daily_series(df, F.col("s"), F.col("d"), F.col("v"), fill=0.0, fill_gaps=True).orderBy("ds").collect()
    assert [r["y"] for r in got] == [1.0, 0.0, 0.0, 2.0]


def test_holidays_enter_the_seasonal_model(spark, series):
    days = series.select("ds").distinct().filter("month(ds) = 12 AND day(ds) = 24")
    lifted = series.join(days.withColumn("h", F.lit(1)), "ds", "left").withColumn("y", F.col("y") + F.coalesce("h", F.lit(0)) * 900).drop("h")
    ahead = spark.createDataFrame([(pd.Timestamp("2024-01-10").date(),)], "ds date")
    made = fm.forecast_seasonal(fm.fit_seasonal(lifted, holidays=days), 20, holidays=fm.union_all(days, ahead))
    pdf = made.filter("series_id = '0'").orderBy("ds").toPandas()
    assert pdf["yhat"][9] - pdf["yhat"][8] > 400


def test_whole_holdout_is_judged(spark, series):
    fitted = fm.fit_ensemble(series, trees=2, depth=2)
    size = {r[0]: r[1] for r in ff.split_by_time(series).filter("part = 'test'").groupBy("series_id").count().collect()}
    judged = fitted.metrics.collect()
    assert len(judged) == 6 and all(m["n_days"] == size[m["series_id"]] > 200 for m in judged)


def test_growing_series_are_not_held(spark):
    days = pd.date_range("2020-01-01", periods=400).date
    df = spark.createDataFrame([("g", d, float(np.exp(i / 60))) for i, d in enumerate(days)], "series_id string, ds date, y double")
    made = fm.forecast_ar(fm.fit_ar(df, alpha=1e-6)).orderBy("ds").toPandas()["yhat"].to_numpy()
    assert len(set(made)) == 90 and made[-1] > 3 * np.exp(399 / 60)


def test_series_around_zero_are_kept(spark):
    days = pd.date_range("2020-01-01", periods=400).date
    rows = [("z", d, float((-1) ** i)) for i, d in enumerate(days)] + [("none", d, 0.0) for d in days]
    df = spark.createDataFrame(rows, "series_id string, ds date, y double")
    made = bo.forecast_gbt(bo.fit_gbt(df, trees=3, depth=3), 3)
    assert sorted((r[0], r[1]) for r in made.groupBy("series_id").count().collect()) == [("none", 3), ("z", 3)]


def test_short_series_have_fewer_models_and_ensembles_are_saved(spark, series, tmp_path):
    short = series.filter("series_id = '0' AND ds < '2020-02-20'").withColumn("series_id", F.lit("short"))
    fitted = fm.fit_ensemble(fm.union_all(series, short), trees=3, depth=2)
    models = {r[0]: r[1] for r in fitted.weights.groupBy("series_id").count().collect()}
    assert models == {"0": 3, "1": 3, "short": 2}  # 40 days: too few for the autoregression, enough for trees
    fitted.save(str(tmp_path / "e"))
    loaded = fm.load_ensemble(spark, str(tmp_path / "e"))
    a, b = (x.forecast(20).orderBy("series_id", "ds").toPandas()["yhat"] for x in (fitted, loaded))
    np.testing.assert_allclose(a, b)


def test_failed_jobs_are_not_taken_for_missing_models(spark, series, monkeypatch):
    def broken(*_, **__):
        raise RuntimeError("executor lost")

    monkeypatch.setattr(fm, "fit_gbt", broken)
    with pytest.raises(RuntimeError):
        fm.fit_ensemble(series)
